"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import discard


def _star(spark: SparkSession, edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges (u, v) with u > v.

    Every node learns the least node it is joined to; its larger neighbours
    (large) or its smaller ones and itself (small) are then joined to that.
    What they learn is written first, so that both sides of the join are plain
    shuffles, which Spark splits where a node has very many neighbours.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    least = materialize(spark, least, "least")
    joined = both.join(least, both["u"] == least["w"])
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    out = materialize(spark, out.filter("u != v").distinct(), "edges")
    discard(least, edges)
    return out


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long); root is the least node it can reach.

    Repeats both steps until nothing changes, about as often as the logarithm
    of the longest shortest path.  Each round is a table in the shared
    checkpoint folder, so lost executors cost no earlier round; it goes when the
    next one is there.
    """
    edges = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = materialize(spark, edges, "edges"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        edges = _star(spark, _star(spark, edges, True), False)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
