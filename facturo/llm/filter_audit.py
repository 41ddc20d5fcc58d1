"""Filter interaction audit by counting paths through the lattice of filter sets (dealt operator 12).

1. Each text is measured once: a bit for each filter that it fails. The copy
   filter needs the whole table: texts meet by a SHA-256 digest, of which only
   the least doc_id is kept, combined in each task before the shuffle.
2. Documents with the same part, failed filters and labels are only counted:
   at most 32 x 4 rows a part are left, whatever the table's size.
3. The states of the lattice are the sets of filters already applied; an edge
   adds one filter and removes the documents that fail it and none before. Path
   counts run forward (orders that reach a state) and backward (orders that
   leave it); forward of an edge's start times backward of its end is the number
   of orders that use it. An edge's removals, weighted by that, sum to a
   filter's Shapley numerator; the rows of every order read the same edges.

Filters, by the order of their letters: A under 50 words; B 100 * distinct words
< 65 * words; C 100 * [A-Z] characters > 5 * code points; D any of #$%&*|; E equal to
the text of a row with a smaller doc_id. Words are maximal runs of other
characters than \\x20 and \\x09-\\x0D.

Cases: null texts are empty (equal to each other and to empty ones); a null
doc_id is smaller than none and has no labels; rows with equal doc_id are not
copies of each other by themselves; a document has a label if any of its label rows says
so; null sources and empty ones are one part, the empty string; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

LETTERS = "ABCDE"
#: Keys with more than this share of all rows are joined apart; there are fewer of them than its inverse.
HOT_SHARE = 1 / 100_000
_BLANKS = r"\x20\x09-\x0D"

# The failure conditions of a text alone, over words (array), chars, capitals and the text.
CONDITIONS = {
    "A": "size(words) < 50",
    "B": "100L * size(array_distinct(words)) < 65L * size(words)",
    "C": "100L * capitals > 5L * chars",
    "D": "text rlike '[#$%&*|]'",
}
MEASURES = ["n", "good", "toxic"]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text and mask (bit i: fails filter i; not yet the copy filter) of every row."""
    text = "coalesce(cast(text as string), '')"
    base = docs.select(F.expr("cast(doc_id as bigint)").alias("doc_id"), F.expr("coalesce(cast(source as string), '')").alias("part"), F.expr(text).alias("text"))
    words = F.filter(F.split("text", f"[{_BLANKS}]+"), lambda w: w != "")
    base = base.select("doc_id", "part", "text", words.alias("words"), F.expr("char_length(text)").cast("long").alias("chars"), F.expr("char_length(text) - char_length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))").cast("long").alias("capitals"))
    mask = " + ".join(f"if({CONDITIONS[c]}, {1 << i}, 0)" for i, c in enumerate(LETTERS) if c in CONDITIONS)
    return base.select("doc_id", "part", F.expr("unhex(sha2(text, 256))").alias("digest"), F.expr(mask).alias("mask"))


def _joined(rows: DataFrame, keyed: DataFrame, key: str, total: int) -> DataFrame:
    """Left join of written ``rows`` to ``keyed`` (one row a key, and ``rows_of``: rows that have it); hot keys are split off.

    Keys of more than HOT_SHARE of all rows number under 1 / HOT_SHARE, so they
    are broadcast; any other key fits a task. Null keys match nothing.
    """
    hot = F.broadcast(keyed.where(F.col("rows_of") > total * HOT_SHARE).drop("rows_of"))
    rest = keyed.where(F.col("rows_of") <= total * HOT_SHARE).drop("rows_of")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in rest.schema.fields if f.name != key]
    names = [*rows.columns, *[c for c in rest.columns if c != key]]
    apart = rows.where(f"{key} is not null").join(hot, key, "inner").select(names)
    others = rows.where(f"{key} is not null").join(hot, key, "left_anti").join(rest, key, "left").select(names)
    return apart.unionAll(others).unionAll(rows.where(f"{key} is null").select(*rows.columns, *none))


def failed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask of all filters, good and toxic (0 or 1) of every row of ``docs`` (doc_id, text, source)."""
    spark = docs.sparkSession
    rows = materialize(measured(docs), spark, "audit-rows")
    total = rows.count()
    copies = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows_of")).where("rows_of > 1")
    marked = _joined(rows, materialize(copies, spark, "audit-copies"), "digest", total)
    marked = marked.select("doc_id", "part", F.expr(f"mask + if(coalesce(doc_id > least, false), {1 << LETTERS.index('E')}, 0)").alias("mask"))
    says = [F.max(F.expr(f"if({c} = 1, 1, 0)")).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    labelled = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(*says)
    # rows of each doc_id that has a label: usually one; a hot one is split off
    counts = rows.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows_of"))
    labelled = materialize(labelled.join(counts, "doc_id"), spark, "audit-labels")
    found = _joined(materialize(marked, spark, "audit-marked"), labelled, "doc_id", total)
    return found.select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def counted(masks: DataFrame) -> DataFrame:
    """For each part and mask the number of documents, of good and of toxic ones."""
    return masks.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic"))


def path_counts(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """(forward, backward): orders that reach each state from none applied, and that lead from it to all applied."""
    states = 1 << filters
    forward, backward = np.zeros(states, dtype=np.int64), np.zeros(states, dtype=np.int64)
    forward[0] = backward[states - 1] = 1
    for state in range(states):
        for f in range(filters):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in reversed(range(states)):
        for f in range(filters):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return forward, backward


def lattice(counts: np.ndarray, filters: int) -> tuple[np.ndarray, np.ndarray]:
    """Of counts by mask, shape (2^filters, k): those that pass each state, (2^filters, k), and those that each edge removes, (2^filters, filters, k)."""
    states = 1 << filters
    # documents whose mask lies within a set, summed over one filter at a time
    within = counts.copy()
    for f in range(filters):
        has = np.flatnonzero(np.arange(states) >> f & 1)
        within[has] += within[has ^ (1 << f)]
    passing = within[states - 1 - np.arange(states)]
    removed = np.zeros((states, filters, counts.shape[1]), dtype=np.int64)
    for f in range(filters):
        start = np.flatnonzero(~np.arange(states) >> f & 1)
        removed[start, f] = passing[start] - passing[start | 1 << f]
    return passing, removed


def audit_rows(counts: np.ndarray, letters: str = LETTERS) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every order and step."""
    n = len(letters)
    forward, backward = path_counts(n)
    passing, removed = lattice(counts, n)
    states = np.arange(1 << n)
    shapley = [sum(int(forward[s]) * int(backward[s | 1 << f]) * int(removed[s, f, 0]) for s in states if not s >> f & 1) for f in range(n)]
    failing = [int(counts[states >> f & 1 == 1, 0].sum()) for f in range(n)]
    out = []
    for order in itertools.permutations(range(n)):
        state = 0
        for step, f in enumerate(order, 1):
            gone, good, toxic = (int(v) for v in removed[state, f])
            out.append(("".join(letters[i] for i in order), step, int(passing[state | 1 << f, 0]), gone, failing[f] - gone, int(counts[1 << f, 0]), good, toxic, shapley[f]))
            state |= 1 << f
    return out


def audit(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row a part, order and step from (part, mask, good, toxic) rows; a part's counts by mask, 32 at most, meet in one row."""
    states = 1 << len(letters)
    by_part = counted(masks).groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                counts = np.zeros((states, len(MEASURES)), dtype=np.int64)
                for row in found:
                    counts[row["mask"]] = [row[m] for m in MEASURES]
                columns = list(zip(*audit_rows(counts, letters), strict=True))
                arrays = [pa.array([part] * len(columns[0]), pa.string()), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[2:]]]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"])

    return by_part.mapInArrow(run, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(failed(docs, labels))


def oracle_sql() -> str:
    """DuckDB SQL for filter_audit() over ``documents`` and ``labels``: every order walked step by step."""
    bits = {c: 1 << i for i, c in enumerate(LETTERS)}
    bit = " ".join(f"when '{c}' then {b}" for c, b in bits.items())
    return rf"""
with t as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents),
w as (select *, list_filter(string_split_regex(text, '[{_BLANKS}]+'), lambda x: x <> '') as words, min(doc_id) over (partition by text) as least from t),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
m as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
        (len(words) < 50)::int * {bits['A']} + (100 * len(list_distinct(words)) < 65 * len(words))::int * {bits['B']}
        + (100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text))::int * {bits['C']}
        + regexp_matches(text, '[#$%&*|]')::int * {bits['D']} + coalesce(w.doc_id > least, false)::int * {bits['E']} as mask
      from w left join l on w.doc_id = l.doc_id),
c as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by all),
f as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
o as (select a.f || b.f || c.f || d.f || e.f as filter_order from f a, f b, f c, f d, f e
      where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s as (select filter_order, step, filter_order[step] as letter,
        list_sum([case x {bit} end for x in string_split(filter_order[:step - 1], '') if x <> '']) as before,
        case filter_order[step] {bit} end as own
      from o, (select unnest(range(1, 6)) as step)),
r as (select part, filter_order, step, letter,
        sum(n) filter (mask & (coalesce(before, 0)::int | own) = 0) as kept,
        sum(n) filter (mask & coalesce(before, 0)::int = 0 and mask & own <> 0) as removed,
        sum(n) filter (mask & coalesce(before, 0)::int <> 0 and mask & own <> 0) as redundant,
        sum(n) filter (mask = own) as unique_fails,
        sum(good) filter (mask & coalesce(before, 0)::int = 0 and mask & own <> 0) as good_lost,
        sum(toxic) filter (mask & coalesce(before, 0)::int = 0 and mask & own <> 0) as toxic_lost
      from c, s group by all)
select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
       coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
       coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
       coalesce(sum(removed) over (partition by part, letter), 0)::bigint as shapley
from r
"""
