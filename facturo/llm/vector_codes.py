"""Vector codes by product quantisation, nearest entries found by Orchard's search (dealt operator 11).

1. Rows whose vector is null or holds a null, NaN or infinite component go. A
   component x becomes the integer floor(scale * x). The integer vector is cut
   into ``parts`` equal consecutive parts.
2. Each part position has a codebook, at first that part of the rows with the
   smallest ids. A round assigns every part to the nearest entry (squared
   Euclidean distance, ties to the lower index) and moves each entry to the
   componentwise floor(sum / count) of its parts; unused entries stay. Tasks add
   up their own parts, so a round shuffles one row an entry and task, and
   the driver holds nothing but the codebooks, whose size is fixed.
3. Nearest entries: for every entry its neighbours sorted by distance are kept.
   A search walks the list of the best entry so far, marks what it has
   compared, jumps to the list of any improved entry, and stops where the list
   is farther than twice the current distance (four times, squared): by the
   triangle inequality nothing beyond can be as near. Distances are exact
   integers, so ties are found too. All searches of a batch walk their lists
   side by side, a few neighbours at a time.

The table is read once for the first entries, once a round and once for the
codes; nothing of its size is written. A costly plan is best written first.

Cases: an empty table, or one without usable vectors, gives an empty result;
with fewer rows than entries the codebooks are smaller; of equal ids the lesser
integer vector comes first, null ids last; repeated rows each get their code.
The dimension is that of the smallest id; vectors of another length go, as do
null ones. A dimension that the parts do not divide is filled up with zeros.
Components of any finite size are computed exactly (beyond 64 bits in Python
integers); an error beyond a long is given as the greatest long.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, sized_join

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors searched at once.
BATCH = 2048
#: Neighbours of a list that are compared in one step.
STEP = 16
#: Sums are added up in Spark in digits of this many bits.
DIGIT_BITS = 60
_LONG = (1 << 63) - 1


def usable(vector: str) -> str:
    """SQL: whether the vector column is neither null nor holds null or non-finite components."""
    return f"{vector} is not null and forall({vector}, x -> x is not null and not isnan(x) and abs(cast(x as double)) < double('Infinity'))"


def integers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x): 64-bit integers, or Python ones if squared distances could exceed 64 bits."""
    x = np.asarray(vectors, dtype=np.float64)
    limit = 2.0**28 / max(1, x.shape[-1]) ** 0.5 / scale
    if x.size == 0 or np.abs(x).max() < limit:
        return np.floor(x * scale).astype(np.int64)
    exact = [[(p * scale) // q for p, q in (float(v).as_integer_ratio() for v in row)] for row in x]
    return np.array(exact, dtype=object).reshape(x.shape)


def _narrow(values: list | np.ndarray) -> np.ndarray:
    """64-bit integers where distances fit, else Python ones."""
    a = np.array(values, dtype=object)
    wide = a.size and max(abs(v) for v in a.ravel()) >= 2.0**28 / max(1, a.shape[-1]) ** 0.5
    return a if wide else a.astype(np.int64)


def _cut(x: np.ndarray, parts: int) -> np.ndarray:
    """(n, parts, width) of (n, dimension) integers, filled up with zeros."""
    short = -x.shape[1] % parts
    if short:
        x = np.concatenate([x, np.zeros((len(x), short), dtype=x.dtype)], axis=1)
    return x.reshape(len(x), parts, x.shape[1] // parts)


def _squares(differences: np.ndarray) -> np.ndarray:
    return (differences**2).sum(axis=1) if differences.dtype == object else np.einsum("ij,ij->i", differences, differences)


class Lists:
    """Entries of one codebook, and for each its neighbours (itself first) by distance, ties by index."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gaps = np.array([_squares(entries - e) for e in entries]).reshape(len(entries), len(entries))
        self.order = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.order, axis=1)
        # where every search starts: a few entries spread over the codebook
        self.seeds = np.arange(0, len(entries), max(1, int(len(entries) ** 0.5)))

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each query (ties: the lower) and its squared distance, by Orchard's search."""
        n, k = len(queries), len(self.entries)
        entries = self.entries
        if entries.dtype != queries.dtype:
            entries, queries = entries.astype(object), queries.astype(object)
        marked = np.zeros((n, k), dtype=bool)
        marked[:, self.seeds] = True
        first = np.stack([_squares(queries - entries[s]) for s in self.seeds], axis=1)
        start = first.argmin(axis=1)
        best, least = self.seeds[start], first[np.arange(n), start]
        at = np.zeros(n, dtype=np.int64)
        open_ = np.arange(n)
        while len(open_):
            spot = at[open_, None] + np.arange(STEP)
            inside = spot < k
            spot = np.minimum(spot, k - 1)
            own = best[open_, None]
            near = inside & (self.gaps[own, spot] <= 4 * least[open_, None]).astype(bool)
            entry = self.order[own, spot]
            query, place = np.nonzero(near & ~marked[open_[:, None], entry])
            found, rows = entry[query, place], open_[query]
            marked[rows, found] = True
            # of each query's new entries the nearest, ties to the lower index; others count as farther than any
            far = least[open_].max() + 1
            distance = np.full(entry.shape, far, dtype=least.dtype)
            distance[query, place] = _squares(queries[rows] - entries[found])
            nearest = distance.min(axis=1)
            found = np.where((distance == nearest[:, None]).astype(bool), entry, k).min(axis=1)
            better = (nearest < least[open_]).astype(bool) | ((nearest == least[open_]).astype(bool) & (found < best[open_]))
            moved = open_[better]
            best[moved], least[moved] = found[better], nearest[better]
            # an improved entry's list is walked from its start, the others go on while inside the bound
            at[open_] += STEP
            at[moved] = 0
            open_ = open_[better | (near.all(axis=1) & (at[open_] < k))]
        return best, least


def _pack(books: list[np.ndarray]) -> tuple:
    return tuple(tuple(tuple(int(v) for v in entry) for entry in book) for book in books)


@functools.lru_cache(maxsize=2)
def _lists(books: tuple) -> list[Lists]:
    return [Lists(_narrow(book).reshape(len(book), len(book[0]))) for book in books]


def _vectors(column: pa.Array, dimension: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dimension)


def _searched(batches: Iterator[pa.RecordBatch], books: tuple, dimension: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[np.ndarray], list[np.ndarray]]]:
    """Of each slice: the rows, their integer parts, and for each position the nearest entries and distances."""
    lists = _lists(books)
    for whole in batches:
        for start in range(0, whole.num_rows, BATCH):
            batch = whole.slice(start, BATCH)
            cut = _cut(integers(_vectors(batch.column("vector"), dimension), scale), len(books))
            found = [own.nearest(cut[:, p]) for p, own in enumerate(lists)]
            yield batch, cut, [f[0] for f in found], [f[1] for f in found]


def _digits(value: int) -> list[int]:
    """Digits of DIGIT_BITS bits, the last one signed."""
    out = []
    while not -(1 << DIGIT_BITS) <= value < 1 << DIGIT_BITS:
        out.append(value & ((1 << DIGIT_BITS) - 1))
        value >>= DIGIT_BITS
    return [*out, value]


def _sums(vectors: DataFrame, books: tuple, dimension: int, scale: int) -> list:
    """For each part and entry in use: (part, entry, digit, count, sums). One row a task, entry and digit is shuffled."""
    width = len(books[0][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[None] * len(book) for book in books]
        count = np.zeros((len(books), len(books[0])), dtype=np.int64)
        for _, cut, codes, _ in _searched(batches, books, dimension, scale):
            for p, code in enumerate(codes):
                order = np.argsort(code, kind="stable")
                used, first = np.unique(code[order], return_index=True)
                added = np.add.reduceat(cut[order, p], first, axis=0) if len(first) and width else np.zeros((len(used), width), dtype=np.int64)
                count[p] += np.bincount(code, minlength=count.shape[1])
                for entry, row in zip(used, added.tolist(), strict=True):
                    old = total[p][entry]
                    total[p][entry] = row if old is None else [a + b for a, b in zip(old, row, strict=True)]
        rows = []
        for p, sums in enumerate(total):
            for entry, values in enumerate(sums):
                if values is None:
                    continue
                digits = [_digits(v) for v in values]
                for k in range(max([1, *map(len, digits)])):
                    rows.append((p, entry, k, int(count[p, entry]) if k == 0 else 0, [d[k] if k < len(d) else 0 for d in digits]))
        for start in range(0, len(rows), 4096):
            part = list(zip(*rows[start : start + 4096], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int32()), pa.array(part[1], pa.int32()), pa.array(part[2], pa.int32()), pa.array(part[3], pa.int64()), pa.array(part[4], pa.list_(pa.int64()))], names=["part", "entry", "digit", "n", "sums"])

    partial = vectors.mapInArrow(run, "part int, entry int, digit int, n long, sums array<long>")
    added = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    # at most parts * entries rows a digit, whatever the table's size
    return partial.groupBy("part", "entry", "digit").agg(F.sum("n").alias("n"), *added).collect()


def _moved(books: tuple, sums: list) -> tuple:
    """The codebooks after every entry in use went to the floored mean of its parts."""
    width = len(books[0][0])
    counts: dict[tuple[int, int], int] = {}
    totals: dict[tuple[int, int], list[int]] = {}
    for row in sums:
        key = (row["part"], row["entry"])
        counts[key] = counts.get(key, 0) + row["n"]
        old = totals.setdefault(key, [0] * width)
        totals[key] = [v + (int(row[f"s{i}"]) << (DIGIT_BITS * row["digit"])) for i, v in enumerate(old)]
    return tuple(tuple(tuple(v // counts[p, e] for v in totals[p, e]) if (p, e) in counts else entry for e, entry in enumerate(book)) for p, book in enumerate(books))


def _usable_rows(df: DataFrame, vector: str) -> DataFrame:
    """row (all input columns) and vector, of the rows that stay."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    return rows.where(F.expr(usable(f"row.`{vector}`"))).withColumn("vector", F.expr(f"transform(row.`{vector}`, x -> cast(x as double))"))


def codebooks(df: DataFrame, vector: str = "embedding", order: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[tuple, int]:
    """(codebooks, dimension): for each part position its entries as tuples of integers; empty without usable vectors."""
    kept = _usable_rows(df, vector).select(F.col(f"row.`{order}`").alias("id"), "vector")
    by = [F.col("id").asc_nulls_last(), F.expr(f"transform(vector, x -> floor({scale}D * x))"), "vector"]
    least = kept.orderBy(*by).limit(1).collect()
    if not least:
        return (), 0
    dimension = len(least[0]["vector"])
    vectors = kept.where(F.size("vector") == dimension)
    first = [r["vector"] for r in vectors.orderBy(*by).limit(entries).collect()]
    cut = _cut(integers(np.array(first, dtype=np.float64).reshape(len(first), dimension), scale), parts)
    books = _pack([cut[:, p] for p in range(parts)])
    for _ in range(rounds):
        books = _moved(books, _sums(vectors.select("vector"), books, dimension, scale))
    return books, dimension


def digest(books: tuple) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()


def compressed(df: DataFrame, books: tuple, dimension: int, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """row (all input columns), code (entry indexes in part order, one byte each) and error (long) of every usable vector."""
    rows = _usable_rows(df, vector)
    schema = T.StructType([rows.schema["row"], T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    if not books:
        return rows.where("false").select("row", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, codes, distances in _searched(batches, books, dimension, scale):
            code = np.stack(codes, axis=1).astype(np.uint8)
            total = sum(d.astype(object) for d in distances)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array([min(int(t), _LONG) for t in total], pa.int64())], names=["row", "code", "error"])

    return rows.where(F.size("vector") == dimension).mapInArrow(run, schema)


def decoded(codes: DataFrame, books: tuple, dimension: int, scale: int = SCALE) -> DataFrame:
    """row, code, error and approximation (array of double) of compressed() rows: the entries that the code names, over scale."""
    schema = T.StructType([*codes.schema.fields, T.StructField("approximation", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [[v / scale for p, e in enumerate(code) for v in books[p][e]][:dimension] for code in batch.column("code").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.list_(pa.float64()))], names=schema.names)

    return codes.mapInArrow(run, schema)


def vector_codes(df: DataFrame, vector: str = "embedding", order: str = "vec_id", label: str = "label") -> DataFrame:
    """One row a usable vector: id, code as hex, error, label_error (errors summed over equal labels) and the codebooks' digest."""
    books, dimension = codebooks(df, vector, order)
    coded = compressed(df, books, dimension, vector)
    own = coded.select(F.col(f"row.`{order}`").alias(order), F.col(f"row.`{label}`").isNull().alias("unlabelled"), F.coalesce(F.col(f"row.`{label}`").cast("string"), F.lit("")).alias("label_text"), "code", "error")
    own = materialize(own, df.sparkSession, "vector-codes")
    sums = own.groupBy("unlabelled", "label_text").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    both = sized_join(own, sums, ["unlabelled", "label_text"])
    return both.select(order, F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle_sql(rounds: int = ROUNDS, parts: int = PARTS, dimension: int = 64, entries: int = ENTRIES, scale: int = SCALE) -> str:
    """DuckDB SQL for vector_codes() over ``embeddings`` of the given dimension: every part against every entry."""
    width = dimension // parts
    nearest = "select p.vec_id, p.part, p.x, arg_min(c.entry, (c.gap - 2 * list_inner_product(p.x, c.c), c.entry)) as entry, min(p.own + c.gap - 2 * list_inner_product(p.x, c.c)) as d from p join {book} c on c.part = p.part group by all"
    steps = [
        f"kept as materialized (select vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::double)) as v from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        f"p as materialized (select vec_id, part, x, list_inner_product(x, x) as own from (select vec_id, unnest(range({parts})) as part, v[part * {width} + 1 : part * {width} + {width}] as x from kept))",
        f"first as (select vec_id, row_number() over (order by vec_id) - 1 as entry from kept qualify entry < {entries})",
        "c0 as materialized (select part, entry, x as c, own as gap from p join first using (vec_id))",
    ]
    for r in range(rounds):
        steps += [
            f"n{r} as materialized ({nearest.format(book=f'c{r}')})",
            f"m{r} as (select part, entry, i, floor(sum(x[i]::hugeint)::double / count(*)) as v from (select part, entry, x, unnest(range(1, {width + 1})) as i from n{r}) group by all)",
            f"u{r} as (select part, entry, list(v order by i) as c from m{r} group by all)",
            f"c{r + 1} as materialized (select b.part, b.entry, coalesce(u.c, b.c) as c, list_inner_product(coalesce(u.c, b.c), coalesce(u.c, b.c)) as gap from c{r} b left join u{r} u using (part, entry))",
        ]
    steps += [
        f"last as materialized ({nearest.format(book=f'c{rounds}')})",
        "coded as (select vec_id, string_agg(lower(format('{:02x}', entry::int)), '' order by part) as code, sum(d)::bigint as error from last group by vec_id)",
        f"book as (select sha256(string_agg(v::bigint::varchar, ',' order by part, entry, i)) as codebooks_sha256 from (select part, entry, unnest(c) as v, unnest(range({width})) as i from c{rounds}))",
    ]
    # sums below 2^53 divide exactly enough for their floor
    return "with " + ",\n".join(steps) + "\nselect vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256 from coded join (select vec_id, label from kept) using (vec_id), book"
