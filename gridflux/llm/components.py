"""Connected components of a link table by alternating large and small stars.

Each round links the larger neighbours of a node to the least node around it,
then the smaller ones; the table of a round is staged in the shared folder, so
lineage stays short and a lost executor costs one round at most.  Hot nodes
only meet in grouped minima and joins, which Spark pre-aggregates and splits.

Defined cases: nodes are of any one type that Spark can order; loops, repeated
and reversed links are allowed; links with a null end are dropped; nodes without
links have no row; an empty table gives an empty table; links that don't settle
in the given rounds raise an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.llm.common import stage


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of ``links`` (a, b): the least node of each linked node's component."""
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stage(links.where("a <> b").select(a, b).distinct(), "cc")
    mark = _mark(edges)
    for _ in range(most_rounds):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        joined = large.join(low, "a")
        small = joined.select("a", F.col("least").alias("b")).union(joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")))
        edges = stage(small.distinct(), "cc")
        now = _mark(edges)
        if now == mark:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
        mark = now
    raise RuntimeError("components did not settle")
