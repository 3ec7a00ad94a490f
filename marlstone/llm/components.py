"""Connected components of a link table, by alternating large-star and small-star steps.

Both steps are a minimum per node, which is pre-aggregated, and a join of the links to it.
A node with very many links is joined by broadcast, so that its links stay where they are;
whether there is one is looked up before each step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import HEAVY, join_heavy, remove, stored


def _least(edges: DataFrame, heavy: bool) -> DataFrame:
    """Links (u, v) with the least v of their u, as m."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("rows"))
    return join_heavy(edges, least, ["u"], "rows") if heavy else edges.join(least.drop("rows"), "u")


def _large_star(edges: DataFrame, heavy: bool) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    return _least(both, heavy).withColumn("m", F.least("m", "u")).where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, heavy: bool) -> DataFrame:
    """Edges go from the larger node u to the smaller v."""
    moved = _least(edges, heavy).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(edges.groupBy("u").agg(F.min("v").alias("v"))).distinct()


def _has_heavy(edges: DataFrame) -> bool:
    ends = edges.select("u").union(edges.select("v"))
    return not ends.groupBy("u").agg(F.count("*").alias("rows")).where(F.col("rows") >= HEAVY).isEmpty()


def components(spark: SparkSession, links: DataFrame, most_rounds: int = 60) -> tuple[DataFrame, str]:
    """(node, component) for every node with a link to another, component the smallest node
    of its component; and the path of that table, for the caller to remove. ``links`` has
    columns a, b in any order and multiplicity; links of a node to itself say nothing."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, path = stored(spark, edges, "edges")
    state = None
    many = edges.count() >= HEAVY  # steps add no links, so fewer have no heavy node
    for _ in range(most_rounds):
        heavy = many and _has_heavy(edges)
        new, new_path = stored(spark, _small_star(_large_star(edges, heavy), heavy), "edges")
        now = new.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30))).alias("s")).first()
        remove(spark, path)
        edges, path = new, new_path
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")), path
        state = now
    raise RuntimeError("components did not settle")
