"""The condition record: one flat row of string columns per condition.

doc_id and an order (ord) come first; a null means 'not stated'."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of a condition, by group.
STATIONARY = ("column_name", "material", "modification", "pore_size", "particle_diameter", "column_dimensions", "number_of_columns", "manufacturer", "phase")
SOLVENT = ("solvent", "ratio", "ratio_units")
TECHNICAL = ("temperature", "flow_rate", "injected_polymer_concentration", "injected_polymer_solvent_solution", "injection_volume")
BEHAVIOR = ("critical_block_behavior", "non_critical_block_behavior", "purpose")
GROUPS = {"SP_FIELDS": STATIONARY, "SOL_FIELDS": SOLVENT, "TECH_FIELDS": TECHNICAL, "separation_behavior": BEHAVIOR}
TOP = ("critical_polymer_unit", "polymer_system")
FIELDS = (*TOP, *STATIONARY, *SOLVENT, *TECHNICAL, *BEHAVIOR)


def complete_columns(conditions: DataFrame) -> DataFrame:
    """Adds the fields that a table of conditions lacks, as nulls."""
    return conditions.withColumns({f: F.lit(None).cast("string") for f in FIELDS if f not in conditions.columns})


def leaves(fields: tuple[str, ...]) -> Column:
    return F.array(*[F.nullif(F.col(f), F.lit("")) for f in fields])


def filled(fields: tuple[str, ...]) -> Column:
    """How many of the fields have a value."""
    return F.size(F.filter(leaves(fields), lambda x: x.isNotNull()))


def has_data(conditions: DataFrame) -> DataFrame:
    return conditions.where(F.coalesce(*[F.col(f) for f in FIELDS if f != "polymer_system"]).isNotNull())


def needs_refinement(conditions: DataFrame, most: int = 6) -> DataFrame:
    """The first ``most`` conditions of each document that lack a value in a group."""
    from pyspark.sql import Window as W

    inner = (*STATIONARY, *SOLVENT, *TECHNICAL, *BEHAVIOR)
    ranked = conditions.withColumn("r", F.row_number().over(W.partitionBy("doc_id").orderBy("ord"))).where(F.col("r") <= most).drop("r")
    return ranked.where(filled(inner) < len(inner))


def problems(rows: DataFrame, column: str = "record") -> DataFrame:
    """Of records as JSON text those that lack the structure of one, with what is wrong (the
    first group that is missing); no rows if all are sound."""
    record = F.col(column)
    keys = F.json_object_keys(record)
    wrong = F.when(keys.isNull(), F.lit("not an object"))
    for group in ("SP_FIELDS", "SOL_FIELDS", "TECH_FIELDS"):
        wrong = wrong.when(~F.array_contains(keys, group), F.lit(f"no {group}"))
    return rows.withColumn("problem", wrong).where("problem IS NOT NULL")


def nested(conditions: DataFrame) -> DataFrame:
    """The record with one struct per group."""
    groups = [F.struct(*[F.col(f) for f in fields]).alias(name) for name, fields in GROUPS.items()]
    others = [c for c in conditions.columns if c not in FIELDS]
    return conditions.select(*others, *TOP, *groups)
