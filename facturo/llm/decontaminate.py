"""Benchmark decontamination by greedy string tiling (dealt operator 6).

A text is contaminated by a benchmark item when tiles, non-overlapping word
sequences of at least ``SEED`` words that both have, cover at least
``COVERAGE`` of the item's words, in whatever order they stand in the text.

1. Every text's five-word windows are looked up in a bitmap of the items'
   windows (fixed size, so bounded for any benchmark). Runs of hits, usually
   none, leave the scan with their word hashes; texts themselves never move.
2. Runs of equal texts collapse; the windows of runs are joined with the
   items' windows (exact seeds), which gives (text, run, item) candidates.
3. Each candidate pair is tiled: word windows of length s, hashed by running
   Karp-Rabin, find common sequences; the longest are marked first, and s is
   halved down to the seed length.

Cases: null and empty texts and items, and items of fewer than five words,
match nothing; rows with equal text are judged alike; repeated items are one
item each; an empty table or benchmark leaves all documents alone.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, packed, sized_join, sliced
from .shingles import mix, window_hashes, word_hashes

#: Words in a seed, and least words in a tile.
SEED = 5
#: Share of an item's words that tiles must cover.
COVERAGE = 0.5
#: Bits of the window bitmap (2 MB).
BITMAP_BITS = 1 << 24
#: Pairs tiled by one task.
PAIRS_PER_TASK = 500
_BASE = 0xD1342543DE82EF95
_TILE = "item_start int, text_start long, words int"


def running_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every ``size`` words in a row, from one prefix sum."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    powers = np.full(len(words) + 1, _BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers[:-1], out=sums[1:])
    inverse = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    inverse[0] = 1
    return mix((sums[size:] - sums[:-size]) * np.multiply.accumulate(inverse))


def tile(item: np.ndarray, runs: list[tuple[int, np.ndarray]], least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in the item, start in the text, words) between an item and a text's runs (start, words)."""
    free_item = np.ones(len(item), dtype=bool)
    free_runs = [np.ones(len(w), dtype=bool) for _, w in runs]
    tiles: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), max((len(w) for _, w in runs), default=0)))
    while True:
        matches = _matches(item, runs, free_item, free_runs, size)
        matches.sort(key=lambda m: (-m[3], m[0], m[1], m[2]))
        marked = False
        for p, r, t, n in matches:
            # a match that an earlier tile overlaps is looked for again
            if free_item[p : p + n].all() and free_runs[r][t : t + n].all():
                free_item[p : p + n] = False
                free_runs[r][t : t + n] = False
                tiles.append((p, runs[r][0] + t, n))
                marked = True
        if not marked:
            if size == least:
                return sorted(tiles)
            size = max(least, size // 2)


def _matches(item: np.ndarray, runs: list[tuple[int, np.ndarray]], free_item: np.ndarray, free_runs: list[np.ndarray], size: int) -> list[tuple[int, int, int, int]]:
    """Maximal common sequences of at least ``size`` free words: (item start, run, start in run, words)."""
    at: dict[int, list[int]] = defaultdict(list)
    for p, h in enumerate(running_hashes(item, size).tolist()):
        if free_item[p : p + size].all():
            at[h].append(p)
    found = []
    for r, (_, words) in enumerate(runs):
        free = free_runs[r]
        reach: dict[int, int] = {}  # on each diagonal, the end of the last match: its inside is not listed again
        for t, h in enumerate(running_hashes(words, size).tolist()):
            for p in at.get(h, ()):
                if reach.get(p - t, -1) >= t + size or not free[t : t + size].all() or not np.array_equal(item[p : p + size], words[t : t + size]):
                    continue
                n = size
                while p + n < len(item) and t + n < len(words) and free_item[p + n] and free[t + n] and item[p + n] == words[t + n]:
                    n += 1
                reach[p - t] = t + n
                found.append((p, r, t, n))
    return found


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, words) of the items that have a seed, as a written table; repeated items once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            words, counts = word_hashes(batch.column("text").to_pylist())
            ends = np.cumsum(counts)
            lists = [words[e - c : e].view(np.int64) for e, c in zip(ends, counts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(lists, pa.list_(pa.int64()))], names=["item_id", "words"])

    base = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    # texts under one item_id are told apart by number
    items = base.mapInArrow(run, "item_id long, words array<long>").where(f"size(words) >= {SEED}").distinct()
    return materialize(items.withColumn("item", F.monotonically_increasing_id()), benchmark.sparkSession, "items")


def _windows(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct (keys, seed) of a frame's words."""
    names = [f.name for f in frame.select(*keys).schema.fields]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.select(*keys).schema.fields) + ", seed long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(window_hashes(np.array(w, dtype=np.int64).view(np.uint64), SEED)).view(np.int64) for w in batch.column("words").to_pylist()]
            index = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            seeds = pa.array(np.concatenate([np.empty(0, np.int64), *found]))
            yield pa.RecordBatch.from_arrays([*(batch.column(n).take(index) for n in names), seeds], names=[*names, "seed"])

    return frame.select(*keys, "words").mapInArrow(run, schema)


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """BITMAP_BITS flags; at most BITMAP_BITS / 64 words reach the driver."""
    words = seeds.select(F.expr(f"pmod(seed, {BITMAP_BITS})").alias("bit")).groupBy(F.expr("shiftright(bit, 6)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits"))
    flags = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    for word, bits in words.collect():
        flags[word] = bits
    return np.unpackbits(flags.view(np.uint8), bitorder="little")


def _runs(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Written table of the runs of window hits: doc_id, text_key, run, start, words."""
    flags = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap, bitorder="little"))
    mask = np.uint64(BITMAP_BITS - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            words, counts = word_hashes(batch.column("text").to_pylist())
            bits = window_hashes(words, SEED) & mask
            hits = flags.value[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8) & 1
            at = np.flatnonzero(hits)
            ends = np.cumsum(counts)
            text = np.searchsorted(ends, at, side="right")
            inside = at + SEED <= ends[text] if len(at) else np.empty(0, bool)
            at, text = at[inside], text[inside]
            if not len(at):
                continue
            first = np.flatnonzero((np.diff(at, prepend=-9) > 1) | (np.diff(text, prepend=-1) != 0))
            last = np.append(first[1:], len(at)) - 1
            owner = text[first]
            begin = (ends - counts)[owner]
            number = np.arange(len(first)) - np.searchsorted(owner, owner)
            lists = [words[a : b + SEED].view(np.int64) for a, b in zip(at[first], at[last], strict=True)]
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("text_key").take(take), pa.array(number.astype(np.int32)), pa.array(at[first] - begin), pa.array(lists, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "run", "start", "words"],
            )

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null").withColumn("text_key", F.unhex(F.md5("text")))
    return materialize(keyed.mapInArrow(run, "doc_id long, text_key binary, run int, start long, words array<long>"), docs.sparkSession, "runs")


def _tiled(pairs: DataFrame) -> DataFrame:
    """(text_key, item_id, item, item_words, covered, tiles) for rows of (.., item_words array, runs array)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                item = np.array(r["words"], dtype=np.int64).view(np.uint64)
                runs = sorted(((x["start"], np.array(x["words"], dtype=np.int64).view(np.uint64)) for x in r["runs"]), key=lambda x: x[0])
                tiles = tile(item, runs)
                rows.append((r["text_key"], r["item_id"], len(item), sum(n for _, _, n in tiles), [{"item_start": p, "text_start": t, "words": n} for p, t, n in tiles]))
            tile_type = pa.struct([("item_start", pa.int32()), ("text_start", pa.int64()), ("words", pa.int32())])
            types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(tile_type)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["text_key", "item_id", "item_words", "covered", "tiles"])

    return pairs.mapInArrow(run, f"text_key binary, item_id long, item_words long, covered long, tiles array<struct<{_TILE.replace(' ', ':').replace(',:', ',')}>>")


def tiled_pairs(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key) of the texts with runs, and their written tilings with every item that shares a seed."""
    spark = docs.sparkSession
    items = benchmark_items(benchmark)
    seeds = materialize(_windows(items, ["item"]), spark, "item-seeds")
    runs = _runs(docs, _bitmap(seeds))
    texts = runs.select("doc_id", "text_key").distinct()
    one_each = runs.groupBy("text_key", "run").agg(F.min(F.struct("start", "words")).alias("held")).select("text_key", "run", "held.start", "held.words")
    one_each = materialize(one_each, spark, "text-runs")
    by_seed = seeds.groupBy("seed").agg(F.collect_list("item").alias("items"))
    shared = sized_join(_windows(one_each, ["text_key", "run"]), by_seed, ["seed"], "inner")
    pairs = materialize(shared.select("text_key", "run", F.explode("items").alias("item")).distinct(), spark, "pairs")
    held = pairs.join(one_each, ["text_key", "run"]).groupBy("text_key", "item").agg(F.collect_list(F.struct("start", "words")).alias("runs"))
    # items of at most some hundred words each: 20,000 rows are some 20 MB
    full = sized_join(held, items.select("item", "item_id", "words"), ["item"], "inner", max_rows=20_000)
    # tiling costs far more than its input's size tells, so the number of tasks follows the number of pairs
    dealt = full.select("text_key", "item_id", "words", "runs").repartition(pairs.count() // PAIRS_PER_TASK + 1, "text_key", "item_id")
    return texts, materialize(_tiled(dealt), spark, "tilings")


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, item_words, covered, coverage, tiles) for every contaminated document and its items."""
    texts, tilings = tiled_pairs(docs, benchmark)
    hits = tilings.withColumn("coverage", F.col("covered") / F.col("item_words")).where(F.col("coverage") >= coverage)
    return texts.join(hits, "text_key").select("doc_id", "item_id", "item_words", "covered", "coverage", "tiles")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` without a contaminated text, with all their columns."""
    _, tilings = tiled_pairs(docs, benchmark)
    bad = tilings.where(F.col("covered") >= coverage * F.col("item_words")).select("text_key").distinct()
    keyed = packed(docs, text_key="unhex(md5(coalesce(cast(text as string), '')))")
    return sized_join(keyed, bad, ["text_key"], "left_anti").select("row.*")
