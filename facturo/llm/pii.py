"""Personal data by patterns and bootstrapped contexts (dealt operator 10; DataFrame operations only).

Base spans are the leftmost non-overlapping matches of a pattern per kind that
pass a check; a match that fails is dropped. They are the seeds of the
bootstrap: the word before and the word after a seed are lexical patterns, and
so are those of every candidate, a token that looks like an identifier and
overlaps no base span. Patterns and instances (span texts) form a graph that
is scored in rounds, until no pattern and no instance is added and the scores settle:

- a pattern's confidence is the summed confidence of its distinct instances
  over their number plus one, and it counts only with ``SUPPORT`` confident
  instances and ``PATTERN_CONFIDENCE``;
- a candidate's confidence is the chance that not all of its patterns are
  wrong, so one trusted pattern suffices; seeds keep confidence one.

Candidates that end at ``INSTANCE_CONFIDENCE`` are added as spans of kind
``id`` wherever they stand. Only seeds, candidates and their two neighbouring
words leave the scan. Sums are combined in each task before their shuffles,
and scores are joined back by ``sized_join``, so a very common word is no hot
spot. A document's own spans are ordered together.

Positions are in code points, ends exclusive. Cases: null and empty texts have
no spans; rows are told apart by number, so repeated rows and null doc_ids
each give a row; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, sized_join

# The kinds in order, and what each matches. The forms below find the
# same matches as the plain patterns, without retrying the inside of a failed run.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: An identifier-like token: a run with a digit that ends in a letter or digit; signs behind it do not belong to it.
ADDED = "id"
CANDIDATE = r"(?<![A-Za-z0-9_@=/+.:%-])(?=[A-Za-z0-9_@=/+.:%-]{7})(?=[A-Za-z_@=/+.:%-]*+[0-9])[_@=/+.:%-]*+[A-Za-z0-9]++(?:[_@=/+.:%-]++[A-Za-z0-9]++)*+"
#: Signs a candidate needs.
CANDIDATE_LENGTH = 7
#: Digits a candidate needs.
CANDIDATE_DIGITS = 3
#: Scores are settled when their sum grows by less than this share in a round.
SETTLED = 1e-4
SUPPORT, PATTERN_CONFIDENCE, INSTANCE_CONFIDENCE = 5, 0.6, 0.5


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    turned = F.reverse(_digits(match))
    digit = lambda i: F.substring(turned, i + 1, F.lit(1)).cast("int")
    doubled = lambda i: F.when(digit(i) > 4, digit(i) * 2 - 9).otherwise(digit(i) * 2)
    total = F.aggregate(F.sequence(F.lit(0), F.length(turned) - 1), F.lit(0), lambda s, i: s + F.when(i % 2 == 0, digit(i)).otherwise(doubled(i)))
    return total % 10 == 0


def _passes(kind: Column, match: Column) -> Column:
    """Whether a match passes its kind's check."""
    n = F.length(_digits(match))
    part = lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.substring(F.concat(F.lit("0"), F.regexp_replace(p, "^0+", "")), 1, 4).cast("int") <= 255)
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", F.forall(F.split(match, r"\."), part))
        .when(kind == "card", F.when(n.between(12, 19), _luhn(match)).otherwise(False))
        .when(kind == "phone", n.between(9, 15))
        .otherwise((n >= CANDIDATE_DIGITS) & (F.length(match) >= CANDIDATE_LENGTH))
    )


def _found(kind: str, pattern: str, text: Column, gate: Column) -> list[Column]:
    """Matches of a pattern, and of each stretch between them its length, last word and first word."""
    matches = F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    stretch = lambda p: F.struct(
        F.length(p).alias("len"),
        # from the end backwards, so a long stretch is not searched
        F.lower(F.reverse(F.regexp_extract(F.reverse(p), r"\A\s*+(\S++)", 1))).alias("tail"),
        F.lower(F.regexp_extract(p, r"\A\s*+(\S++)", 1)).alias("head"),
    )
    stretches = F.when(gate, F.transform(F.split(text, pattern, -1), stretch))
    return [matches.alias(f"{kind}_m"), stretches.alias(f"{kind}_p")]


def _between(matches: Column, stretches: Column) -> Column:
    return F.transform(matches, lambda x, i: F.struct(x.alias("m"), stretches[i].alias("b"), stretches[i + 1].alias("a")))


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def found_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written tables: rows (at, doc_id) of all documents, and spans (at, kind, start, end, match, tail, head)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digit = text.rlike("[0-9]")
    gates = {"email": text.contains("@"), "ip": digit, "card": digit, "phone": text.contains("+"), ADDED: digit}
    patterns = PATTERNS | {ADDED: CANDIDATE}
    found = [c for k, p in patterns.items() for c in _found(k, p, text, gates[k])]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("at"), *found)
    rows = materialize(rows, spark, "matches")

    every = None
    for kind in patterns:
        m, p = F.col(f"{kind}_m"), F.col(f"{kind}_p")
        zipped = _between(m, p)
        one = rows.where(F.size(m) > 0).select("at", F.lit(kind).alias("kind"), F.posexplode(zipped).alias("pos", "z"))
        one = one.select("at", "kind", "pos", F.col("z.m").alias("match"), F.col("z.b").alias("b"), F.col("z.a").alias("a"))
        every = one if every is None else every.unionAll(one)
    upto = Window.partitionBy("at", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = every.withColumn("end", F.sum(F.col("b.len") + F.length("match")).over(upto))
    placed = placed.where(_passes(F.col("kind"), F.col("match")))
    spans = placed.select("at", "kind", (F.col("end") - F.length("match")).alias("start"), "end", "match", F.col("b.tail").alias("tail"), F.col("a.head").alias("head"))
    return rows.select("at", "doc_id"), materialize(spans, spark, "spans")


def _order(kind: Column) -> Column:
    return F.array_position(F.lit([*KINDS, ADDED]), kind)


def candidates(spans: DataFrame) -> DataFrame:
    """The candidate spans that overlap no base span of their document."""
    by_start = Window.partitionBy("at").orderBy("start", _order(F.col("kind")))
    before = F.max(F.when(F.col("kind") != ADDED, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("kind") != ADDED, F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    marked = spans.withColumn("before", before).withColumn("after", after)
    free = (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("after") >= F.col("end"), F.lit(True)))
    return marked.where((F.col("kind") == ADDED) & free).drop("before", "after")


def trusted_instances(seeds: DataFrame, others: DataFrame) -> DataFrame:
    """(match, confidence) of the candidate texts that the pattern graph trusts.

    ``seeds`` and ``others``: spans with match, tail and head.
    """
    spark = seeds.sparkSession

    def edges(spans: DataFrame, seed: bool) -> DataFrame:
        side = F.explode(F.array(F.struct(F.lit("before").alias("side"), F.col("tail").alias("word")), F.struct(F.lit("after").alias("side"), F.col("head").alias("word"))))
        return spans.select("match", side.alias("p")).select("match", "p.side", "p.word", F.lit(seed).alias("seed")).where("word <> ''")

    graph = edges(seeds, True).unionAll(edges(others, False)).groupBy("match", "side", "word").agg(F.bool_or("seed").alias("seed"))
    graph = materialize(graph, spark, "pattern-graph")
    scores, before = None, (0, 0, 0.0)
    while True:
        known = graph if scores is None else sized_join(graph, scores, ["match"])
        confidence = F.when(F.col("seed"), 1.0).otherwise(F.coalesce("confidence", F.lit(0.0)) if scores is not None else F.lit(0.0))
        rated = known.withColumn("c", confidence).groupBy("side", "word").agg((F.sum("c") / (F.count(F.lit(1)) + 1)).alias("trust"), F.sum(F.when(F.col("c") >= INSTANCE_CONFIDENCE, 1).otherwise(0)).alias("support"))
        good = materialize(rated.where((F.col("trust") >= PATTERN_CONFIDENCE) & (F.col("support") >= SUPPORT)).select("side", "word", "trust"), spark, "trusted-patterns")
        patterns = good.count()
        rated_candidates = sized_join(graph.where(~F.col("seed")), good, ["side", "word"], "inner", rows=patterns)
        scores = rated_candidates.groupBy("match").agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("confidence"))
        scores = materialize(scores, spark, "instances")
        sums = scores.where(F.col("confidence") >= INSTANCE_CONFIDENCE).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("confidence"), F.lit(0.0)).alias("total")).first()
        # no score ever falls, so the rounds end
        if patterns <= before[0] and sums["n"] <= before[1] and sums["total"] <= before[2] * (1 + SETTLED):
            return scores.where(F.col("confidence") >= INSTANCE_CONFIDENCE)
        before = (patterns, sums["n"], sums["total"])


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and spans (array of start, order, kind, end, match in order) for every row of ``docs`` (doc_id, text)."""
    rows, spans = found_spans(docs)
    seeds = spans.where(F.col("kind") != ADDED)
    others = materialize(candidates(spans), docs.sparkSession, "candidates")
    more = sized_join(others, trusted_instances(seeds, others).select("match"), ["match"], "left_semi")
    columns = ["at", "kind", "start", "end", "match"]
    held = seeds.select(columns).unionAll(more.select(columns))
    span = F.struct("start", _order(F.col("kind")).cast("int").alias("order"), "kind", "end", "match")
    by_row = held.groupBy("at").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    return rows.join(by_row, "at", "left").select("doc_id", F.coalesce("spans", F.expr("cast(array() as array<struct<start:bigint,order:int,kind:string,end:bigint,match:string>>)")).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans, the digest of base spans and the list of all spans, of a personal_data() result."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != ADDED)
    return found.select("doc_id", *map(_count, KINDS), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
