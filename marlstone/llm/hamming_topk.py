"""Exact top-k by Hamming distance: multi-index hashing, grown radius by radius.

Rows with the same code are one entry of the index, with as many of the smallest ids as a
result can hold. A code is cut into segments of about log2(entries) - 3 bits, so that a
bucket has some eight entries (fewer, and there are more look-ups than entries to verify),
and listed under the value of each. In the round of radius r the queries that are still open look up the
values at distance r from their own segments, an equi-join on (segment, value), so only the
buckets of that radius are read (radii 0 and 1 are one round). A code is met at the radius of
its nearest segment and through the first such segment, so no pair is met twice. After radius
r every code within s (r + 1) - 1 (s segments) has been met; a query whose kth verified
distance is no larger is done. Nothing is approximate, and all of it is DataFrame operations.
"""

from __future__ import annotations

import math
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marlstone.llm.common import remove, stored


def sign_code(vector: Column) -> Column:
    """A vector's bits (positive or not) as a binary string of 0 and 1; null for null."""
    return F.array_join(F.transform(vector, lambda x: F.when(x > 0, "1").otherwise("0")), "")


def segments_of(bits: int, entries: int, segment_bits: int | None = None) -> list[tuple[int, int]]:
    """(start, width) of the segments: as many of about log2(entries) - 3 bits (or of
    ``segment_bits``) as make up the code, of even widths."""
    wanted = segment_bits or min(31, max(1, round(math.log2(max(entries, 2))) - 3))
    n = max(1, round(bits / wanted), math.ceil(bits / 31))
    cuts = [bits * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(spark: SparkSession, widths: set[int], radii: list[int]) -> DataFrame:
    """(width, radius, mask): the values of a segment that differ from 0 in ``radius`` bits."""
    found = [(w, r, sum(1 << b for b in c)) for w in sorted(widths) for r in radii for c in combinations(range(w), r)]
    return spark.createDataFrame(pa.table({"width": pa.array([w for w, _, _ in found], pa.int32()), "radius": pa.array([r for _, r, _ in found], pa.int32()), "mask": pa.array([m for _, _, m in found], pa.int64())}))


def top_k(rows: DataFrame, code: Column, queries: Column, id_col: str = "vec_id", k: int = 10, segment_bits: int | None = None, most_broadcast: int = 1_000_000) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): for each row for which ``queries`` holds,
    its k nearest other rows by the Hamming distance of ``code`` (a string of 0 and 1, of one
    width), ties by id; fewer where there are fewer rows.

    Rows without an id or a code are neither queries nor found. A repeated id is one row if
    its code is the same; with several codes it counts once per code and never finds itself.
    An empty table gives no rows; further columns are ignored. The look-ups of a round are
    broadcast up to ``most_broadcast`` of them, and beyond that shuffled like the index.
    """
    spark = rows.sparkSession
    clean = rows.select(F.col(f"`{id_col}`").alias("id"), code.alias("code"), F.coalesce(queries, F.lit(False)).alias("asks")).where("id IS NOT NULL AND code IS NOT NULL AND code <> ''")
    # k + 1 ids per code: a query may be one of them. The limit applies before the shuffle, too.
    ranked = clean.select("id", "code").distinct().withColumn("r", F.row_number().over(W.partitionBy("code").orderBy("id"))).where(F.col("r") <= k + 1)
    index, index_path = stored(spark, ranked.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    asked, asked_path = stored(spark, clean.where("asks").select("code").distinct(), "asked")
    size = index.agg(F.count("*").alias("n"), F.min(F.length("code")).alias("low"), F.max(F.length("code")).alias("high")).first()
    if size["n"] and size["low"] != size["high"]:
        raise ValueError("codes have different widths")
    parts = segments_of(size["high"] or 1, size["n"], segment_bits)
    values = [F.conv(F.substring("code", a + 1, w), 2, 10).cast("bigint") for a, w in parts]
    width = F.element_at(F.array(*[F.lit(w) for _, w in parts]), F.col("segment") + 1)
    listed = index.select("ids", *[v.alias(f"c{i}") for i, v in enumerate(values)])
    listed = listed.select("*", F.posexplode(F.array(*[f"c{i}" for i in range(len(parts))])).alias("segment", "value"))
    apart = [F.bit_count(F.col(f"c{i}").bitwiseXOR(F.col(f"q{i}"))) for i in range(len(parts))]

    best, best_path = spark.createDataFrame([], "code string, distance int, neighbor_id bigint"), None
    still = asked.withColumn("bound", F.lit(size["high"] or 1))  # no row further away can still count
    for radii in ([0, 1], *([r] for r in range(2, max(w for _, w in parts) + 1))):
        probes = still.select("code", "bound", *[v.alias(f"q{i}") for i, v in enumerate(values)])
        probes = probes.select("*", F.posexplode(F.array(*[f"q{i}" for i in range(len(parts))])).alias("segment", "own"))
        probes = probes.withColumn("width", width).join(F.broadcast(masks(spark, {w for _, w in parts}, radii)), "width")
        probes = probes.select("code", "bound", "radius", *[f"q{i}" for i in range(len(parts))], "segment", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
        n_probes = still.count() * sum(math.comb(w, r) for _, w in parts for r in radii)
        if not n_probes:
            break
        met = listed.join(F.broadcast(probes) if n_probes <= most_broadcast else probes, ["segment", "value"])
        first = F.lit(False)  # whether this segment is the first of the nearest ones
        for i in range(len(parts)):
            others = [apart[j] > F.col("radius") for j in range(i)] + [apart[j] >= F.col("radius") for j in range(i + 1, len(parts))]
            first = F.when(F.col("segment") == i, F.expr("true") if not others else _all(others)).otherwise(first)
        distance = sum(apart[1:], apart[0]).cast("int")
        met = met.where((distance <= F.col("bound")) & first).select("code", distance.alias("distance"), F.explode("ids").alias("neighbor_id"))
        order = W.partitionBy("code").orderBy("distance", "neighbor_id")
        found, found_path = stored(spark, best.union(met).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r"), "best")
        if best_path:
            remove(spark, best_path)
        best, best_path = found, found_path
        covered = len(parts) * (radii[-1] + 1) - 1
        known = best.groupBy("code").agg(F.count("*").alias("n"), F.max("distance").alias("furthest"))
        still = asked.join(known, "code", "left").select("code", F.when(F.col("n") > k, F.col("furthest")).otherwise(F.lit(size["high"])).alias("bound"))
        still = still.where(F.col("bound") > covered)

    near = best.groupBy("code").agg(F.sort_array(F.collect_list(F.struct("distance", "neighbor_id"))).alias("near"))
    out = clean.where("asks").select(F.col("id").alias("query_id"), "code").distinct().join(near, "code")
    others = F.slice(F.filter("near", lambda x: x["neighbor_id"] != F.col("query_id")), 1, k)
    out = out.select("query_id", F.posexplode(others).alias("p", "x")).select("query_id", (F.col("p") + 1).alias("rank"), F.col("x.neighbor_id").alias("neighbor_id"), F.col("x.distance").alias("distance"))
    remove(spark, index_path)
    remove(spark, asked_path)
    return out


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
