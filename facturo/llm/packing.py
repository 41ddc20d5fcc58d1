"""Best-fit packing with dominance reduction (dealt operator 9).

Documents become pieces of at most ``capacity`` tokens. How many pieces have
each length is a table of at most ``capacity`` rows however many documents
there are, so the plan is made from that table: first Martello and Toth's
reduction fixes sets of pieces that dominate every other set with the same
largest piece (they can be closed without costing a sequence), then best-fit
decreasing packs what is left. Both work on lengths with counts. Spark then
deals the pieces of each length over the plan's places by their rank among
equal lengths, found with per-bucket counts so that no length, however
frequent, is ranked in one task.

Cases: a null or empty text is the end id alone, a piece of one token;
repeated rows are separate pieces; null doc_ids are packed like others; an
empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, sliced
from .tokens import word_ids

#: A bin group: how many bins, and what each holds as (length, copies).
Group = tuple[int, list[tuple[int, int]]]


def _sums_between(counts: dict[int, int], low: int, high: int) -> bool:
    """Whether lengths with these counts have a sum in (low, high]."""
    mask = (1 << (high + 1)) - 1
    wanted = mask ^ ((1 << (low + 1)) - 1)
    reach = 1
    for size, count in counts.items():
        if size > high:
            continue
        left, step = min(count, high // size), 1
        while left:
            take = min(step, left)
            reach |= (reach << (size * take)) & mask
            left -= take
            step *= 2
        if reach & wanted:
            return True
    return False


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[Group], dict[int, int]]:
    """Fix sets of at most three pieces that dominate; returns the closed bins and the counts left.

    For each length s from the largest, with room r = capacity - s, a set
    {s} + F may be fixed when the pieces of any other fitting set can be exchanged, part for
    part, into the places of F (Martello and Toth's criterion):

    - nothing left fits in r: {s};
    - the largest fitting length k has no other sum of pieces in (k, r]: every
      other set's companions go into k's place: {s, k} (this holds for k = r);
    - at most two pieces fit beside s, a is the largest that leaves room for a
      second and b the largest beside it, and no piece above b is the smaller
      of a fitting pair nor one above a fits at all: {s, a, b}.

    Removing pieces only removes alternatives, so a set is fixed as many times
    as its pieces allow before looking again.
    """
    left = {s: c for s, c in counts.items() if c > 0}
    sizes = sorted(left)
    closed: list[Group] = []

    def take(size: int, n: int) -> None:
        left[size] -= n
        if not left[size]:
            del left[size]
            sizes.pop(bisect.bisect_left(sizes, size))

    s = capacity + 1
    while sizes and sizes[0] < s:
        if s not in left:
            s = sizes[bisect.bisect_left(sizes, s) - 1]
        room = capacity - s
        at = bisect.bisect_right(sizes, room)
        if at and sizes[0] <= room - sizes[at - 1] and 3 * sizes[0] <= room and left[sizes[0]] > 3:
            s -= 1  # the smallest length fits beside the largest, and three times: no rule holds
            continue
        if at and sizes[at - 1] == room != s:
            n = min(left[s], left[room])
            closed.append((n, [(s, 1), (room, 1)]))
            take(s, n)
            take(room, n)
            continue
        # all pieces left that fit beside s, without the copy of s being placed
        others = {x: left[x] - (x == s) for x in sizes[:at]}
        others = {x: c for x, c in others.items() if c}
        k = max(others, default=0)
        if not k:
            held = {s: 1}
        elif k == room or (min(others) > room - k and not _sums_between(others, k, room)):
            held = {s: 1, k: 1} if k != s else {s: 2}
        elif pair := _dominant_pair(others, room):
            held = defaultdict(int)
            for x in (s, *pair):
                held[x] += 1
        else:
            s -= 1  # s stays for best fit, and an alternative for smaller ones
            continue
        n = min(left[x] // c for x, c in held.items())
        closed.append((n, list(held.items())))
        for x, c in held.items():
            take(x, n * c)
    return closed, left


def _dominant_pair(others: dict[int, int], room: int) -> tuple[int, int] | None:
    """(a, b) that no other companions of a piece exceed place by place, if there are such."""
    sizes = sorted(others)
    pool = [x for x in sizes for _ in range(min(others[x], 3))][:3]
    if len(pool) >= 3 and sum(pool) <= room:
        return None  # three companions fit
    a = sizes[-1]
    rest = others | {a: others[a] - 1}
    b = max((x for x, c in rest.items() if c and a + x <= room), default=0)
    if not b:
        return None
    second = max((x for x in sizes if x > b and 2 * x <= room and (others[x] > 1 or any(y > x and x + y <= room for y in sizes))), default=0)
    return (a, b) if not second else None


def best_fit(counts: dict[int, int], capacity: int) -> list[Group]:
    """Best-fit decreasing over lengths with counts; a step fills a whole group of equal bins."""
    groups: dict[int, list[Group]] = defaultdict(list)  # by room left
    rooms: list[int] = []

    def add(room: int, n: int, held: list[tuple[int, int]]) -> None:
        if n:
            if not groups[room]:
                bisect.insort(rooms, room)
            groups[room].append((n, held))

    for s in sorted(counts, reverse=True):
        left = counts[s]
        while left:
            at = bisect.bisect_left(rooms, s)
            if at == len(rooms):
                room, n, held = capacity, math.ceil(left / (capacity // s)), []
            else:
                room = rooms[at]
                n, held = groups[room].pop()
                if not groups[room]:
                    rooms.pop(at)
            fit = room // s
            full = min(n, left // fit)
            add(room - fit * s, full, [*held, (s, fit)])
            left -= full * fit
            if full < n:
                part = min(left, fit)
                if part:
                    add(room - part * s, 1, [*held, (s, part)])
                add(room, n - full - bool(part), held)
                left -= part
    return [g for room in rooms for g in groups[room]]


def plan_places(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs of places (length, low, high, copies, sequence, offset).

    The pieces of a length with ranks low to high - 1 go, ``copies`` to a
    sequence, into consecutive sequences from ``sequence`` on, at ``offset``.
    """
    closed, rest = reduce_dominated(counts, capacity)
    ranks: dict[int, int] = defaultdict(int)
    runs, sequence = [], 0
    for n, held in closed + best_fit(rest, capacity):
        offset = 0
        for size, copies in held:
            runs.append((size, ranks[size], ranks[size] + n * copies, copies, sequence, offset))
            ranks[size] += n * copies
            offset += size * copies
        sequence += n
    return runs


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Encode documents (doc_id, text), append ``end_id`` and cut those over ``capacity``.

    Columns doc_id, piece, start, length, ids_crc32 and, if asked for, ids
    (little-endian uint32 bytes).
    """
    names = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer_path)
        for batch in sliced(batches, "text"):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(np.frombuffer(encoder.encode(text), encoder.dtype), encoder.dtype.type(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity].tobytes()
                    rows.append((doc, piece, start, len(part) // 4, zlib.crc32(part), part)[: len(names)])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), names, strict=True)], schema=pa.schema(names))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


def place_pieces(pieces: DataFrame, spark: SparkSession, capacity: int = 4096) -> DataFrame:
    """Add sequence_id and offset to ``pieces``, a written table with a row number ``number`` in it (it is read twice).

    At most ``capacity`` rows (lengths with counts) reach the driver.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    bucket_rows = max(200, math.isqrt(sum(counts.values())))
    buckets = spark.createDataFrame([(s, -(-n // bucket_rows)) for s, n in counts.items()], "length long, buckets long")
    runs = spark.createDataFrame(plan_places(counts, capacity), "length long, low long, high long, copies long, sequence long, at long")
    keyed = pieces.join(F.broadcast(buckets), "length").withColumn("bucket", F.expr("pmod(xxhash64(number), buckets)"))
    sizes = keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    up_to = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row per bucket
    before = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("number")
    ranked = keyed.withColumn("rank", F.row_number().over(inside) - 1).join(before, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.join(F.broadcast(runs), (ranked["length"] == runs["length"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).drop(runs["length"])
    return placed.select(
        *[c for c in pieces.columns if c != "number"],
        F.expr("sequence + (rank - low) div copies").alias("sequence_id"),
        F.expr("at + (rank - low) % copies * length").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; one row per piece."""
    spark = docs.sparkSession
    pieces = cut_pieces(docs, tokenizer_path, capacity, end_id, with_ids).withColumn("number", F.monotonically_increasing_id())
    return place_pieces(materialize(pieces, spark, "pieces"), spark, capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences of pieces with ids: sequence_id, doc_ids and ids (uint32 bytes), at most ``capacity`` tokens each."""
    held = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return placed.groupBy("sequence_id").agg(held.alias("held")).select("sequence_id", F.col("held.doc_id").alias("doc_ids"), F.expr("aggregate(held, cast('' as binary), (x, y) -> concat(x, y.ids))").alias("ids"))
