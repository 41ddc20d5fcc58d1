"""WARC archives with a record index (dealt operator 5).

Writing makes one gzip member per record, in files of about ``file_bytes``,
and returns the index: file, offset, length, URL, payload digest and record
type of each record. Reading starts from (any selection of) the index: its
rows are sorted by file and offset, dealt over tasks by range, and neighbouring
byte ranges are joined into one read when the gap between them is small.

Of records with equal payloads of at least ``revisit_bytes`` bytes, the one
with the largest page_id is the response and the others are revisits of it
(they hold its headers, no payload). Cases: null html is an empty payload; a
null url writes no target header and reads back null, and a URL's control
characters and blanks are percent-encoded in the header; rows that share the
largest page_id are all responses; null page_ids come before all others; an
empty table gives no file and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, open_input, scratch_path, sized_join, sliced

#: Fixed value: the profile the WARC standard names for such revisits.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "path string, offset long, length long, url string, payload_digest string, page_id long, record_type string"
_INDEX_ARROW = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string())])


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def header_safe(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, revisit_of: int | None, revisit: bool, date: str) -> tuple[bytes, str]:
    """An uncompressed record and its payload digest in hex."""
    sha1 = hashlib.sha1(payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {header_safe(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1.digest()).decode()}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(revisit_of)}", f"X-Refers-To-Page-ID: {revisit_of}"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        block += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n", sha1.hexdigest()


def parse_record(data: bytes) -> dict:
    """Headers and payload of an uncompressed record; the response's digest is computed anew from its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    named = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(named["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = named["WARC-Type"] == "revisit"
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    known = base64.b32decode(named["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if not revisit and (len(payload) != length or hashlib.sha1(payload).hexdigest() != known):
        raise ValueError(f"damaged record {named['WARC-Record-ID']}")
    return {
        "page_id": int(named["X-Page-ID"]) if "X-Page-ID" in named else None,
        "url": named.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": known,
        "record_type": named["WARC-Type"],
        "refers_to": int(named["X-Refers-To-Page-ID"]) if revisit else None,
        "payload": None if revisit else payload,
    }


def write_warc(pages: DataFrame, folder: str, revisit_bytes: int = 1000, file_bytes: int = 256 << 20, date: str = "2020-01-01T00:00:00Z", level: int = 1) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives under ``folder`` (shared); returns the written index.

    A file's name holds the task attempt, and only the attempts that counted
    are in the index, so a repeated task does no harm.
    """
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.expr("coalesce(cast(html as string), '')").alias("html"))
    keyed = base.withColumn("payload", F.sha2("html", 256))
    large = keyed.where(F.expr(f"octet_length(html) >= {revisit_bytes}"))
    groups = large.groupBy("payload").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("payload", "first_id")
    groups = materialize(groups, pages.sparkSession, "payload-groups")
    decided = sized_join(keyed, groups, ["payload"]).select("page_id", "url", "html", "first_id", F.expr("first_id is not null and not (page_id <=> first_id)").alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        context = TaskContext.get()
        files, top = fs.FileSystem.from_uri(folder)
        out, path, offset, roll = None, "", 0, 0
        try:
            for batch in sliced(batches, "html"):
                rows = []
                for r in batch.to_pylist():
                    if out is None:
                        name = f"pages-{context.partitionId():06d}-{roll:05d}-{context.taskAttemptId()}.warc.gz"
                        files.create_dir(top, recursive=True)
                        out, path, offset = files.open_output_stream(f"{top}/{name}", compression=None), f"{folder.rstrip('/')}/{name}", 0
                    plain, digest = record_bytes(r["page_id"], r["url"], r["html"].encode(), r["first_id"], r["revisit"], date)
                    member = zlib.compressobj(level, wbits=31)
                    record = member.compress(plain) + member.flush()
                    out.write(record)
                    url = None if r["url"] is None else header_safe(r["url"])
                    rows.append((path, offset, len(record), url, digest, r["page_id"], "revisit" if r["revisit"] else "response"))
                    offset += len(record)
                    if offset >= file_bytes:
                        out.close()
                        out, roll = None, roll + 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _INDEX_ARROW, strict=True)], schema=_INDEX_ARROW)
        finally:
            if out is not None:
                out.close()

    return materialize(decided.mapInArrow(write, INDEX), pages.sparkSession, "warc-index")


def read_records(index: DataFrame, with_payload: bool = False, max_gap: int = 64 << 10, max_read: int = 8 << 20, task_bytes: int = 16 << 20) -> DataFrame:
    """The records that ``index`` names, read from their archives.

    Ranges of one file that lie at most ``max_gap`` bytes apart are read at
    once, up to ``max_read`` bytes (one record may be longer). A task reads
    about ``task_bytes``.
    """
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * with_payload
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        path, held = None, []
        for batch in batches:
            for p, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length")), strict=True):
                if held and (p != path or offset - sum(held[-1]) > max_gap or offset + length - held[0][0] > max_read):
                    yield path, held
                    held = []
                path = p
                held.append((offset, length))
        if held:
            yield path, held

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, handle = None, None
        for path, held in spans(batches):
            if path != opened:
                if handle:
                    handle.close()
                opened, handle = path, open_input(path)
            start = held[0][0]
            data = memoryview(handle.read_at(sum(held[-1]) - start, start))
            rows = [parse_record(zlib.decompress(data[a - start : a - start + n], wbits=31)) for a, n in held]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in fields], schema=pa.schema(fields))

    # the index is small, so its own size must not set the number of tasks
    total = index.agg(F.sum("length")).first()[0] or 0
    ranges = index.select("path", "offset", "length").repartitionByRange(total // task_bytes + 1, "path", "offset").sortWithinPartitions("path", "offset")
    return ranges.mapInArrow(read, schema)


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read every record back through the index."""
    return read_records(write_warc(pages, scratch_path(spark, "warc")))
