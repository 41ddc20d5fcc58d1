"""Exact deduplication with a two-pass Bloom filter (dealt operator 3; DataFrame operations only).

Texts are equal when identical after each run of ASCII blanks becomes one
space; null counts as empty. Pass one sets ``PROBES`` bits of a filter per row
and keeps those set twice or more; it is a sum per bit, combined in each task
before its shuffle. Pass two looks each row's bits up: rows with a bit seen
once are unique and pass straight through, and only the others, possible
repeats, are shuffled by the SHA-256 of their text and grouped exactly. The
filter is broadcast as 64-bit words; its size follows the row count up to
``max_words`` and no further, so at any scale the broadcast is bounded and a
fuller filter only lets more rows into the exact grouping.

Of equal texts the row with the smallest doc_id stays; null doc_ids come after
all others, and of rows with equal doc_id and text one stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, packed, sized_join

BLANKS = r"[\x20\x09-\x0D]+"
#: Bits set per text, all in one word.
PROBES = 3
#: Filter bits per row, up to MAX_WORDS words.
BITS_PER_ROW = 16
#: Words of the filter at most: 8 MB of bits, some 50 MB as a broadcast table.
MAX_WORDS = 1 << 20


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def filter_words(rows: int, max_words: int = MAX_WORDS) -> int:
    return min(max_words, 1 << max(4, (rows * BITS_PER_ROW // 64).bit_length()))


def _probes(words: int) -> list[Column]:
    """The word that holds a text's bits, and its bit numbers, from two hashes."""
    bits = [F.expr(f"cast(pmod(shiftright(h2, {6 * i}), 64) as int)") for i in range(PROBES)]
    return [F.expr(f"pmod(h1, {words})").alias("word"), F.array(*bits).alias("bits")]


def repeated_bits(keyed: DataFrame, words: int) -> DataFrame:
    """Pass one: (word, seen), where seen has the bits of that word that rows set twice or more."""
    set_bits = keyed.select(*_probes(words)).select("word", F.explode(F.array_distinct("bits")).alias("bit"))
    twice = set_bits.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("seen"))


def mark_copies(docs: DataFrame, carry: bool = False, max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (doc_id, text).

    With ``carry`` the result also has ``row``, a struct of all input columns.
    """
    spark = docs.sparkSession
    base = packed(docs, doc_id="cast(doc_id as bigint)", text="text")
    hashed = base.select(*["row"] * carry, "doc_id", F.sha2(normalised(F.col("text")), 256).alias("sha"))
    keyed = hashed.select("*", F.expr("xxhash64(sha)").alias("h1"), F.expr("xxhash64(sha, 1)").alias("h2"), F.monotonically_increasing_id().alias("at"))
    keyed = materialize(keyed, spark, "text-hashes")
    words = filter_words(keyed.count(), max_words)
    seen = materialize(repeated_bits(keyed, words), spark, "repeated-bits")

    probed = keyed.select("*", *_probes(words)).join(F.broadcast(seen), "word", "left")
    maybe = " and ".join(f"shiftright(seen, bits[{i}]) & 1 = 1" for i in range(PROBES))
    probed = probed.withColumn("maybe", F.expr(f"coalesce({maybe}, false)"))

    out = [*["row"] * carry, "doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")]
    once = probed.where("not maybe").select("*", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")).select(out)
    repeats = probed.where("maybe").select(*["row"] * carry, "doc_id", "sha", "at")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at"))
    groups = repeats.groupBy("sha").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = materialize(groups.select("sha", F.col("first.doc_id").alias("first_id"), F.col("first.at").alias("first_at"), "n"), spark, "copy-groups")
    # a group with a third of all rows is not gathered: its one row here meets them where they are, or salted
    more = sized_join(repeats, groups, ["sha"])
    more = more.withColumn("keep_id", F.expr("if(n is null, doc_id, first_id)")).withColumn("group_size", F.expr("coalesce(n, 1L)")).withColumn("kept", F.expr("coalesce(at = first_at, true)")).select(out)
    return once.unionByName(more)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return mark_copies(docs, carry=True).where("kept").select("row.*")
