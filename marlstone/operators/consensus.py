"""Agreement between models, and merges that depend on order.

A merge takes one document's records in their order: into the first kept record that fits,
else kept as a new one (see folds).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marlstone.functions import text as T
from marlstone.operators.folds import Fuzzy, NullTolerant, placed

KEY = ("critical_polymer_unit", "column_name", "manufacturer", "solvent", "ratio", "temperature")


def agreed(conditions: DataFrame, least: int, keys: tuple[str, ...] = KEY, model: str = "model") -> DataFrame:
    """The conditions whose normalised key at least ``least`` models of the document give."""
    if least <= 1:
        return conditions
    named = {f"__k{i}": T.norm_key(F.col(k)) for i, k in enumerate(keys)}
    by = W.partitionBy("doc_id", *named)
    support = F.size(F.collect_set(F.nullif(F.col(model), F.lit(""))).over(by))
    return conditions.withColumns(named).withColumn("__support", support).where(F.col("__support") >= least).drop(*named, "__support")


def _merged(rows: DataFrame, group: str, order: str, told: Callable[[str], str]) -> DataFrame:
    """Of placed() rows one per kept record: of each column the first value by rank that is
    ``told``, and the least order."""
    columns = [c for c in rows.columns if c not in (group, order, "kept_idx", "__rank")]
    values = [F.expr(f"min_by(`{c}`, CASE WHEN {told(f'`{c}`')} THEN __rank END)").alias(c) for c in columns]
    out = rows.groupBy(group, "kept_idx").agg(F.min(order).alias(order), *values)
    return out.select(group, "kept_idx", *[c for c in rows.columns if c not in (group, "kept_idx", "__rank")])


def _norms(rows: DataFrame, fields: list[str]) -> dict[str, Column]:
    """The fields' normal forms as one array, worked out by one expression."""
    given = F.array(*[F.col(f) if f in rows.columns else F.lit(None).cast("string") for f in fields])
    return {"__norms": F.transform(given, T.norm_key)}


def null_tolerant_merge(conditions: DataFrame, keys: tuple[str, ...] = KEY, group: str = "doc_id", order: str = "ord") -> DataFrame:
    """Records of a group that agree wherever both state a key become one: a record goes into
    the first such, whose nulls it fills. kept_idx numbers the results. ``order`` must be a
    total order within the group."""
    rows = placed(conditions, _norms(conditions, list(keys)), NullTolerant, group, order)
    return _merged(rows, group, order, lambda c: f"{c} IS NOT NULL")


def fuzzy_merge(conditions: DataFrame, value_fields: tuple[str, ...], tolerance: float = 5.0, group: str = "doc_id", order: str = "ord") -> DataFrame:
    """Records with the same unit, no conflicting manufacturer or solvent, upper ratios within
    ``tolerance``, and the same phase, material or column become one; the one with more
    values wins, keeps the place and takes what it lacks from the other."""
    keys = _norms(conditions, ["critical_polymer_unit", "manufacturer", "solvent", "phase", "material", "column_name"])
    ratio = F.col("ratio") if "ratio" in conditions.columns else F.lit(None).cast("string")
    keys["__hi"] = T.ratio_range(ratio)["hi"]
    # a bit for each field that has a value
    bits = " + ".join(f"if(coalesce(`{f}`, '') = '', 0L, {1 << i}L)" for i, f in enumerate(value_fields))
    keys["__values"] = F.expr(bits)
    rows = placed(conditions, keys, lambda: Fuzzy(tolerance), group, order)
    return _merged(rows, group, order, lambda c: f"{c} IS NOT NULL AND {c} <> ''" if c.strip("`") in value_fields else f"{c} IS NOT NULL")


def column_consensus(columns: DataFrame, least: int, key: Column, value_fields: tuple[str, ...]) -> DataFrame:
    """Of (doc_id, model, model_idx, ord, fields): with one model or ``least`` <= 1 the first
    model's columns; else per key that enough models give the fullest candidate. place
    orders them: by their own, or their key's first, model and order."""
    keyed = columns.withColumn("__key", key)
    by_doc, by_key = W.partitionBy("doc_id"), W.partitionBy("doc_id", "__key")
    keyed = keyed.withColumn("__models", F.size(F.collect_set("model").over(by_doc))).withColumn("__first", F.min("model_idx").over(by_doc))
    keyed = keyed.withColumn("__support", F.size(F.collect_set("model").over(by_key)))
    score = F.size(F.filter(F.array(*[F.col(f) for f in value_fields]), lambda x: x.isNotNull()))
    best = F.row_number().over(by_key.orderBy(F.desc("__score"), "model_idx", "ord"))
    keyed = keyed.withColumn("__score", score).withColumn("__best", best)
    alone = (F.col("__models") == 1) | F.lit(least <= 1)
    keyed = keyed.withColumn("place", F.when(alone, F.struct("model_idx", "ord")).otherwise(F.min(F.struct("model_idx", "ord")).over(by_key)))
    kept = keyed.where((alone & (F.col("model_idx") == F.col("__first"))) | (~alone & (F.col("__support") >= least) & (F.col("__best") == 1)))
    return kept.drop("__key", "__models", "__first", "__support", "__score", "__best")
