"""Connected components by alternating large-star and small-star rounds (DataFrame operations only).

Every round replaces each edge by one to the smallest neighbour; it takes
minima per node, combined in each task before the shuffle, and joins them back
with ``sized_join``, so a node with very many edges is neither gathered in one
task nor sent to the driver. Rounds are cut by writing the edges to the shared
folder. A few rounds suffice for any shape seen in practice (log^2 n at most).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialize, sized_join


def _shape(edges: DataFrame) -> tuple[int, bool]:
    """Number of edges (a > b), and whether they are stars: each node is a root, or has one edge, to a root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("below")).unionAll(edges.select(F.col("b").alias("node"), F.lit(0).alias("below")))
    nodes = ends.groupBy("node").agg(F.sum("below").alias("below"), F.count(F.lit(1)).alias("n"))
    row = nodes.agg(F.sum("below").alias("edges"), F.max(F.expr("below > 0 and n > 1")).alias("open")).first()
    return row["edges"] or 0, not row["open"]


def _star(edges: DataFrame, large: bool, n: int, max_rows: int) -> DataFrame:
    """One star round over edges with a > b; ``n``: an upper bound of their number."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    if large:
        # all neighbours above a go to the least of a's neighbourhood
        up = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        moved = sized_join(up, least, ["a"], max_rows=max_rows, rows=2 * n).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        # a's neighbours below it, and a itself, go to the least
        moved = sized_join(edges, least, ["a"], max_rows=max_rows, rows=n).select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
    return moved.where("a > b").distinct()


def connected_components(edges: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b, any ordered type); component is the least node. ``max_rows``: of a broadcast."""
    spark = edges.sparkSession
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialize(ordered, spark, "components")
    n, stars = _shape(now)
    while not stars:
        # a large round yields at most one edge for each edge
        now = materialize(_star(now, large=True, n=n, max_rows=max_rows), spark, "components")
        now = materialize(_star(now, large=False, n=n, max_rows=max_rows), spark, "components")
        n, stars = _shape(now)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def merged_components(components: DataFrame, links: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Written (node, component) after further ``links`` (a, b): only components that these join are looked at again."""
    spark = links.sparkSession
    ends = links.select("a", "b")
    for side in ("a", "b"):
        names = components.select(F.col("node").alias(side), "component")
        ends = sized_join(ends, names, [side], max_rows=max_rows).withColumn(side, F.coalesce("component", side)).drop("component")
    moved = materialize(connected_components(ends, max_rows), spark, "moved")
    old = sized_join(components, moved.select(F.col("node").alias("component"), F.col("component").alias("to")), ["component"], max_rows=max_rows).select("node", F.coalesce("to", "component").alias("component"))
    new = sized_join(moved, components.select("node"), ["node"], "left_anti", max_rows=max_rows, salts=1)
    return materialize(old.unionAll(new), spark, "components")
