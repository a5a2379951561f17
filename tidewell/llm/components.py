"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import common


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest node of the component.

    Each round is written to the shared folder. Minima are aggregated before
    the shuffle, so a node with very many edges costs one row a task there, and
    written before they meet the edges, so that the join has plain exchanges on
    both sides and the edges of such a node can be split.
    """
    edges = common.materialise(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(edges)
    for _ in range(most_rounds):
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = common.materialise(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        large = both.join(least, "a").where("b > a AND b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least_path = least._tidewell_path
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, edges = edges, common.materialise(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        common.remove(edges.sparkSession, last._tidewell_path)
        common.remove(edges.sparkSession, least_path)
        now = _state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
