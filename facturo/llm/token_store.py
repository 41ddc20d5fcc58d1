"""Token-id files with Elias-Fano document boundaries (dealt operator 1).

A file holds one run of documents in ascending doc_id order: the concatenated
ids in the narrowest unsigned type the vocabulary needs, the token boundaries
and the doc_ids as Elias-Fano sequences. An Elias-Fano sequence of n values
below u takes about n * (2 + log2(u / n)) bits; ``select`` finds a value from
one 32-bit sample per 256 values and a scan of a few words, so no table of
64-bit offsets exists on disk or in memory. Where each file starts in the
corpus is one sum over the manifest, which has a row per file. Files are read
back through ``select`` alone: no boundary table is unpacked.

Cases: null or empty text gives a document of the end id alone; null doc_ids
come first; rows with equal or no doc_id keep the order of the input and may
stand in several files; repeated rows are all kept; an empty table gives no
file and an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, open_input, scratch_path, sliced, write_bytes
from .tokens import word_ids

MAGIC = b"EFIDS001"
SAMPLE = 256


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bits of each value, packed, lowest bit first."""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


class EliasFano:
    """A non-decreasing sequence of unsigned integers."""

    def __init__(self, n: int, width: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.width, self.low, self.high, self.samples = n, width, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        high[ones] = 1
        return cls(n, width, b"".join(pack_bits(values[i : i + 65536], width) for i in range(0, n, 65536)), np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = struct.pack("<QBQQQ", self.n, self.width, len(self.low), len(self.high), len(self.samples))
        return head + self.low + self.high + self.samples.tobytes()

    @classmethod
    def from_buffer(cls, data: memoryview) -> tuple[EliasFano, int]:
        n, width, low, high, samples = struct.unpack_from("<QBQQQ", data)
        a = struct.calcsize("<QBQQQ")
        b, c = a + low, a + low + high
        end = c + 4 * samples
        return cls(n, width, data[a:b], data[b:c], np.frombuffer(data[c:end], "<u4")), end

    def select(self, i: int) -> int:
        """Value i, from the sample before it and a scan of the high bits."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = at // 8
        word = self.high[byte] >> (at % 8) << (at % 8)
        while (ones := int(word).bit_count()) <= left:
            left -= ones
            byte += 1
            word = self.high[byte]
        for bit in range(8):
            if word >> bit & 1:
                if not left:
                    break
                left -= 1
        return ((byte * 8 + bit - i) << self.width) | self._low(i)

    def _low(self, i: int) -> int:
        if not self.width:
            return 0
        a = i * self.width
        part = int.from_bytes(self.low[a // 8 : (a + self.width + 7) // 8], "little")
        return part >> (a % 8) & ((1 << self.width) - 1)

    def decode(self) -> np.ndarray:
        """All values; blocks of high bits keep the memory near that of the result."""
        ones = np.concatenate([np.empty(0, np.int64), *(np.flatnonzero(np.unpackbits(np.frombuffer(self.high[i : i + 65536], np.uint8), bitorder="little")) + 8 * i for i in range(0, len(self.high), 65536))])
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.width)
        if self.width:
            for i in range(0, self.n, 65536):
                m = min(65536, self.n - i)
                a = i * self.width // 8
                bits = np.unpackbits(np.frombuffer(self.low[a : a + (m * self.width + 7) // 8], np.uint8), bitorder="little")[: m * self.width]
                weights = np.uint64(1) << np.arange(self.width, dtype=np.uint64)
                out[i : i + m] |= (bits.reshape(m, self.width).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
        return out


def token_file(doc_ids: list[int | None], bounds: np.ndarray, ids: list[bytes], width: int) -> list[bytes]:
    """The parts of one file. ``bounds``: end of each document in ids; null doc_ids stand first."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    base = int(known[0]) if len(known) else 0
    order = EliasFano.of((known - np.int64(base)).view(np.uint64)).to_bytes()
    ends = EliasFano.of(bounds).to_bytes()
    head = struct.pack("<8sBQqQQ", MAGIC, width, nulls, base, len(order), len(ends))
    return [head, order, ends, *ids]


class TokenFile:
    """A file read back: ``doc_ids``, ``bounds`` (select gives a document's end) and the id array."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, width, self.nulls, self.base, order, ends = struct.unpack_from("<8sBQqQQ", view)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = struct.calcsize("<8sBQqQQ")
        self.order, _ = EliasFano.from_buffer(view[at : at + order])
        self.bounds, _ = EliasFano.from_buffer(view[at + order : at + order + ends])
        self.ids = np.frombuffer(view[at + order + ends :], f"<u{width}")

    def __len__(self) -> int:
        return self.bounds.n

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.base + self.order.select(i - self.nulls)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i - 1) if i else 0 : self.bounds.select(i)]


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, file_tokens: int = 16_000_000) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into token files under ``folder`` (shared); returns the written manifest.

    One range exchange on doc_id and row number orders the corpus, so even
    rows of one doc_id are dealt over tasks; each task then writes its range as files of about ``file_tokens`` ids (one document is never cut).
    A file's name holds the task attempt, and the manifest names the files of
    the attempts that counted, so a repeated task leaves only unused files.
    Manifest: part, roll, path, n_docs, n_tokens; (part, roll) is corpus order.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = word_ids(tokenizer_path)
        end = np.array([end_id], encoder.dtype).tobytes()
        context = TaskContext.get()
        part, roll, size = context.partitionId(), 0, encoder.dtype.itemsize
        doc_ids: list[int | None] = []
        ends: list[int] = []
        ids: list[bytes] = []
        total = 0

        def flush() -> pa.RecordBatch:
            name = f"ids-{part:06d}-{roll:05d}-{context.taskAttemptId()}.bin"
            path = write_bytes(folder, name, token_file(doc_ids, np.array(ends, dtype=np.uint64), ids, size))
            return pa.RecordBatch.from_pydict({"part": [part], "roll": [roll], "path": [path], "n_docs": [len(doc_ids)], "n_tokens": [total]}, schema=pa.schema([("part", pa.int32()), ("roll", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

        for batch in sliced(batches, "text"):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = encoder.encode(text)
                total += len(found) // size + 1
                doc_ids.append(doc)
                ends.append(total)
                ids += (found, end)
                if total >= file_tokens:
                    yield flush()
                    roll, total = roll + 1, 0
                    doc_ids, ends, ids = [], [], []
        if doc_ids:
            yield flush()

    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("at"))
    ordered = numbered.repartitionByRange("doc_id", "at").sortWithinPartitions("doc_id", "at")
    files = ordered.select("doc_id", "text").mapInArrow(write, "part int, roll int, path string, n_docs long, n_tokens long")
    return materialize(files, docs.sparkSession, "token-manifest")


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of the files in ``manifest``: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids (uint32 bytes)."""
    before = Window.orderBy("part", "roll").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).select("path", "base")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with open_input(path) as f:
                    file = TokenFile(f.read())
                start = 0
                for first in range(0, len(file), 4096):
                    docs = range(first, min(first + 4096, len(file)))
                    ends = [file.bounds.select(i) for i in docs]
                    starts = [start, *ends[:-1]]
                    start = ends[-1]
                    ids = [file.ids[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends, strict=True)]
                    columns = [[file.doc_id(i) for i in docs], [base + a for a in starts], [len(x) // 4 for x in ids], [zlib.crc32(x) for x in ids]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns] + [pa.array(ids, pa.binary())] * with_ids, schema=pa.schema(fields))

    # a task per file: the manifest is small, so its size must not set the number of tasks
    return based.repartition(max(1, manifest.count()), "path").mapInArrow(read, schema)


def token_index(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder and return what ``read_token_files`` finds there."""
    return read_token_files(write_token_files(docs, scratch_path(spark, "token-files"), tokenizer_path, end_id))
