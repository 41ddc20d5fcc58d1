"""Byte-level BPE over whole texts, long ones in overlapping chunks (dealt operator 13).

1. A text longer than ``chunk`` characters is cut into chunks that reach
   ``overlap`` characters into the next one; chunks are rows, so a long text
   is spread over tasks. A shorter text is one piece and is encoded in place.
2. Every chunk is pre-tokenised by itself, from its first character on. The
   pattern looks at nothing left of a match, so two runs over the same text agree
   from the first boundary that both have. Boundaries near the end of a chunk
   could still move with what follows it, and those behind blanks can't be cut
   at without a change before them; neither count.
3. Neighbouring chunks are stitched at the first boundary that both have in
   their overlap, an equi-join of the chunks' boundary lists. Where there is
   none (one run of letters, signs or blanks longer than the overlap), the
   chunks of the text are merged and looked at again, until all neighbours meet; so
   every stitch is a true boundary, by induction from the start of the text.
4. Each piece between stitches is encoded by the tiktoken library, and a text's
   pieces are joined in order. Ids are little-endian unsigned 32-bit integers.
   Decoding puts the bytes of the ids one after the other; they need not be
   valid UTF-8 before the end.

Cases: null and empty texts have no ids and decode to no bytes; repeated rows and
null doc_ids each keep their row; an empty table gives an empty result; the
strings of special tokens are ordinary text; columns of any name are carried.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, materialize, sized_join, sliced

#: Characters of a chunk, and how far it reaches into the next one.
CHUNK, OVERLAP = 32_768, 2_048
#: A boundary this near to the end of a chunk may change with the text behind it: contractions look two characters on.
MARGIN = 4


def default_ranks() -> str:
    """Path of the installed byte-level rank file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@functools.lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})


@functools.lru_cache(maxsize=2)
def _token_bytes(path: str) -> pa.Array:
    """Bytes of every id in order; ids that the file does not have stand for none."""
    ranks = _ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return pa.array(out, pa.large_binary())


def boundaries(text: str, pattern: str) -> np.ndarray:
    """Where the pre-tokens of ``text`` end, but for ends behind a blank before its end: cut there, a run of blanks would match as one."""
    import regex

    ends = np.cumsum([len(t) for t in regex.compile(pattern).findall(text)], dtype=np.int64)
    return np.array([e for e in ends if e == len(text) or not text[e - 1].isspace()], dtype=np.int64)


def encode_text(text: str, path: str, pattern: str) -> bytes:
    return array("I", _encoding(path, pattern).encode_ordinary(text)).tobytes() if text else b""


def decode_ids(ids: bytes, path: str) -> bytes:
    """The bytes of ids, one after the other."""
    if not ids:
        return b""
    found = _token_bytes(path).take(pa.Array.from_buffers(pa.uint32(), len(ids) // 4, [None, pa.py_buffer(ids)]))
    _, ends, data = found.buffers()
    return data.to_pybytes()[: np.frombuffer(ends, np.int64)[len(found)]]


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Written segments of ``long`` (at, row, text): at, start, stop, last, row (of the first one only) and text from start to overlap behind stop."""
    schema = T.StructType([T.StructField("at", T.LongType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("last", T.BooleanType()), T.StructField("row", long.schema["row"].dataType), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 1 << 20, 64):
            for i, (at, text) in enumerate(zip(batch.column("at").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                row = batch.column("row").slice(i, 1)
                for start in range(0, len(text), chunk):
                    last = start + chunk >= len(text)
                    own = row if start == 0 else pa.nulls(1, row.type)
                    values = [pa.array([at], pa.int64()), pa.array([start], pa.int64()), pa.array([len(text) if last else start + chunk], pa.int64()), pa.array([last]), own, pa.array([text[start : start + chunk + overlap]], pa.string())]
                    yield pa.RecordBatch.from_arrays(values, names=schema.names)

    cut = long.select("at", "row", "text").mapInArrow(run, schema)
    return materialize(cut.repartition("at", "start"), long.sparkSession, "bpe-chunks")


def _meetings(segments: DataFrame, overlap: int, pattern: str) -> DataFrame:
    """Written (at, stop, cut): for every segment but a text's last, where it meets the next one (null: nowhere)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 4 << 20, 1024):
            heads, tails = [], []
            for start, stop, last, text in zip(*[batch.column(c).to_pylist() for c in ("start", "stop", "last", "text")], strict=True):
                ends = start + np.concatenate([[0], boundaries(text, pattern)])
                heads.append(ends[ends <= start + overlap])
                # a text that ends within the overlap ends the next segment as well
                tails.append([] if last else ends[(ends >= stop) & ((ends <= start + len(text) - MARGIN) | (len(text) < stop - start + overlap))])
            arrays = [batch.column("at"), batch.column("start"), batch.column("stop"), batch.column("last"), pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["at", "start", "stop", "last", "head", "tail"])

    ends = materialize(segments.select("at", "start", "stop", "last", "text").mapInArrow(run, "at long, start long, stop long, last boolean, head array<long>, tail array<long>"), segments.sparkSession, "bpe-boundaries")
    heads = ends.where("start > 0").select("at", F.col("start").alias("stop"), "head")
    both = ends.where("not last").select("at", "stop", "tail").join(heads, ["at", "stop"], "left")
    return materialize(both.select("at", "stop", F.array_min(F.array_intersect("tail", "head")).alias("cut")), segments.sparkSession, "bpe-cuts")


def _merged(segments: DataFrame, cuts: DataFrame) -> DataFrame:
    """Segments after those that do not meet became one; ``cuts``: _meetings()."""
    begins = cuts.where("cut is not null").select("at", F.col("stop").alias("start"), F.lit(1).alias("begins"))
    chained = segments.join(begins, ["at", "start"], "left").withColumn("chain", F.expr("sum(coalesce(begins, 0)) over (partition by at order by start)")).drop("begins")
    schema = segments.schema

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("start")
        places = zip(*[table.column(c).to_pylist() for c in ("start", "stop", "text")], strict=True)
        text = "".join(text if i == table.num_rows - 1 else text[: stop - start] for i, (start, stop, text) in enumerate(places))
        first, last = table.slice(0, 1), table.slice(table.num_rows - 1, 1)
        values = {"text": pa.array([text], pa.string()), "stop": last.column("stop"), "last": last.column("last")}
        return pa.table([values[name] if name in values else first.column(name) for name in schema.names], names=schema.names)

    return materialize(chained.groupBy("at", "chain").applyInArrow(run, schema), segments.sparkSession, "bpe-merged")


def _stitched(segments: DataFrame, overlap: int, pattern: str) -> list[tuple[DataFrame, DataFrame]]:
    """(segments, cuts) whose neighbours all meet; texts that need no merging are set aside in each round."""
    spark, out = segments.sparkSession, []
    while True:
        cuts = _meetings(segments, overlap, pattern)
        apart = materialize(cuts.where("cut is null").select("at").distinct(), spark, "bpe-open")
        if apart.isEmpty():
            return [*out, (segments, cuts)]
        out.append((sized_join(segments, apart, ["at"], "left_anti"), sized_join(cuts, apart, ["at"], "left_anti")))
        segments = _merged(sized_join(segments, apart, ["at"], "left_semi"), sized_join(cuts, apart, ["at"], "left_semi"))


def _encoded_pieces(segments: DataFrame, cuts: DataFrame, path: str, pattern: str) -> DataFrame:
    """at, start, row and ids of the piece of each segment between its two stitches."""
    cuts = cuts.select("at", "stop", "cut")
    into = cuts.select("at", F.col("stop").alias("start"), F.col("cut").alias("cut_in"))
    places = segments.select("at", "start", "stop").join(into, ["at", "start"], "left").join(cuts, ["at", "stop"], "left")
    places = materialize(places.select("at", "start", F.expr("coalesce(cut_in, 0L)").alias("cut_in"), F.coalesce("cut", "stop").alias("cut_out")), segments.sparkSession, "bpe-pieces")
    few = places.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    placed = segments.join(F.broadcast(places) if few else places, ["at", "start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 4 << 20, 1024):
            ids = [encode_text(text[a - start : b - start], path, pattern) for start, text, a, b in zip(*[batch.column(c).to_pylist() for c in ("start", "text", "cut_in", "cut_out")], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("at"), batch.column("start"), batch.column("row"), pa.array(ids, pa.binary())], names=["at", "start", "row", "ids"])

    schema = T.StructType([T.StructField("at", T.LongType()), T.StructField("start", T.LongType()), segments.schema["row"], T.StructField("ids", T.BinaryType())])
    return placed.select("at", "start", "row", "text", "cut_in", "cut_out").mapInArrow(run, schema)


def _joined(pieces: DataFrame) -> DataFrame:
    """row and ids of each text from its pieces in order: a group is one text's ids."""
    schema = T.StructType([pieces.schema["row"], T.StructField("ids", T.BinaryType())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("start")
        ids = b"".join(table.column("ids").to_pylist())
        return pa.table([table.column("row").slice(0, 1), pa.array([ids], pa.binary())], names=["row", "ids"])

    return pieces.groupBy("at").applyInArrow(run, schema)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, carry: list[str] | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """row (a struct of the columns ``carry``, by default all) and ids (binary) of every row of ``docs`` (text)."""
    path, pattern = path or default_ranks(), pattern or default_pattern()
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("row"), F.expr("coalesce(cast(text as string), '')").alias("text"))
    schema = T.StructType([base.schema["row"], T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 4 << 20, 4096):
            ids = [encode_text(text, path, pattern) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(ids, pa.binary())], names=["row", "ids"])

    whole = base.where(F.char_length("text") <= chunk).mapInArrow(run, schema)
    segments = _chunks(base.withColumn("at", F.monotonically_increasing_id()).where(F.char_length("text") > chunk), chunk, overlap)
    for own, cuts in _stitched(segments, overlap, pattern):
        whole = whole.unionAll(_joined(_encoded_pieces(own, cuts, path, pattern)))
    return whole


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """All columns of ``encoded`` (row, ids) and bytes (binary), what the ids stand for."""
    path = path or default_ranks()
    schema = T.StructType([*encoded.schema.fields, T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "ids", 4 << 20, 4096):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([decode_ids(i, path) for i in batch.column("ids").to_pylist()], pa.binary())], names=schema.names)

    return encoded.mapInArrow(run, schema)


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of ``docs`` (doc_id, text), encoded and decoded again."""
    both = decode(encode(docs, path, carry=["doc_id"]), path)
    return both.select("row.doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
