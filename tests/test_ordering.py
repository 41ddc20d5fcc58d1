from __future__ import annotations

from pyspark.sql import functions as F

from facturo.functions import strip_blanks
from facturo.operators.ordering import chunk_counts


def test_a_huge_count_is_cut_without_a_huge_array(spark):
    df = spark.createDataFrame([("a", 25_000), ("b", 1), ("c", 30_000_000_000), ("d", 0)], "k string, n long")
    found = chunk_counts(df, "n").groupBy("k").agg(F.count(F.lit(1)), F.countDistinct("_chunk"), F.max("_chunk"), F.sum("_k"), F.max("_k"))
    want = {("a", 3, 3, 2, 25_000, 10_000), ("b", 1, 1, 0, 1, 1), ("c", 3_000_000, 3_000_000, 2_999_999, 30_000_000_000, 10_000)}
    assert set(map(tuple, found.collect())) == want


def test_unicode_blanks_are_stripped_like_python_does(spark):
    blanks = "".join(filter(str.isspace, map(chr, range(0x10000))))
    texts = [f"{b}a{b}c{b}" for b in blanks] + [blanks, "plain"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(strip_blanks("t")).collect()] == [t.strip() for t in texts]
