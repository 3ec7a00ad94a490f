"""Report tables: the table of conditions, the table of names, run counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marlstone.operators import rules as R
from marlstone.plans.lineage import cut

# The columns of the report, in order, and those that tell rows apart.
COLUMNS = (
    "polymer_group", "critical_polymer_unit", "completeness", "column_name", "manufacturer", "phase", "material", "modification",
    "column_dimensions", "number_of_columns", "pore_size", "particle_diameter", "solvent", "ratio", "ratio_units", "temperature",
    "flow_rate", "injection_volume", "injected_polymer_concentration", "injected_polymer_solvent_solution", "purpose",
)
KEY = ("polymer_group", "critical_polymer_unit", "column_name", "phase", "solvent", "ratio", "ratio_units", "column_dimensions", "manufacturer")


def graded(conditions: DataFrame) -> DataFrame:
    """With completeness; conditions that say nothing useful go."""
    grade = R.completeness([F.col(c) for c in ("column_name", "phase", "material", "manufacturer")], [F.col(c) for c in ("solvent", "ratio")])
    return conditions.withColumn("completeness", grade).where("completeness <> 'minimal'")


def without_size_exclusion(conditions: DataFrame) -> DataFrame:
    return conditions.where(R.keeps_condition(*[F.col(c) for c in ("column_name", "solvent", "ratio", "purpose", "critical_block_behavior")]))


def with_patch(conditions: DataFrame, docs: DataFrame, mark: str = "78.54", columns: tuple[str, ...] = ("nucleosil", "diol"), values: tuple[str, ...] = ("80", "80.0"), by: str = "78.54-80", units: str = "wt%") -> DataFrame:
    """In documents that hold ``mark``: a ratio of certain columns becomes another."""
    flags = docs.select("doc_id", F.contains(F.coalesce("text", F.lit("")), F.lit(mark)).alias("__mark"))
    rows = conditions.join(flags, "doc_id", "left")
    applies = F.col("__mark") & F.lower(F.coalesce("column_name", F.lit(""))).rlike(R.any_word(columns))
    new = R.patched(F.col("ratio"), applies, values, by)
    rows = rows.withColumn("__new", new)
    filled = F.when(~F.col("__new").eqNullSafe(F.col("ratio")) & (F.coalesce("ratio_units", F.lit("")) == ""), units).otherwise(F.col("ratio_units"))
    return rows.withColumn("ratio_units", filled).withColumn("ratio", F.col("__new")).drop("__mark", "__new")


def compact(conditions: DataFrame) -> DataFrame:
    return conditions.drop("context_snippet", "context_snippets", "completeness")


def table_rows(conditions: DataFrame, groups: Column | None = None) -> DataFrame:
    """(doc_id, ord, the report's columns), '' for null. A condition without a unit belongs to
    ``groups`` (the document's main names, joined), else to 'unknown'; one without a grade
    counts as complete."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if c in conditions.columns else F.lit("complete" if c == "completeness" else "")
    fallback = F.coalesce(F.nullif(groups, F.lit("")) if groups is not None else F.lit(None).cast("string"), F.lit("unknown"))
    first = F.coalesce(F.nullif(F.col("critical_polymer_unit"), F.lit("")), fallback).alias("polymer_group")
    return conditions.select("doc_id", "ord", first, *[text(c).alias(c) for c in COLUMNS[1:]])


def conditions_table(rows: DataFrame) -> DataFrame:
    """One row per document and key: the first non-empty value of each column, different
    purposes put together with '; '. Rows are dealt out by document and key once, which serves
    both aggregations: by purpose, so that only a key's distinct purposes are gathered, and by
    key. Rows without a document have no purpose."""
    others = [c for c in COLUMNS if c not in (*KEY, "purpose")]
    first = [F.expr(f"min(struct(ord, `{c}`)) FILTER (WHERE `{c}` <> '' AND ord IS NOT NULL)").alias(c) for c in others]
    # a hash of its own stays a column where parts of the key are constants, which Spark would
    # put in for the columns above the shuffle and then shuffle again
    dealt = rows.select("doc_id", "ord", *COLUMNS, F.xxhash64(*KEY).alias("__key")).repartition("doc_id", "__key")
    once = dealt.groupBy("doc_id", "__key", *KEY, "purpose").agg(F.min("ord").alias("ord"), *first)
    told = F.expr("sort_array(collect_list(struct(ord, purpose)) FILTER (WHERE purpose <> '' AND doc_id IS NOT NULL))").alias("ps")
    base = once.groupBy("doc_id", "__key", *KEY).agg(F.min("ord").alias("ord"), told, *[F.min(c)[c].alias(c) for c in others])
    joined = F.aggregate("ps", F.lit(""), lambda acc, p: F.when(acc == "", p["purpose"]).when(F.contains(acc, p["purpose"]), acc).otherwise(F.concat(acc, F.lit("; "), p["purpose"])))
    values = {"purpose": joined} | {c: F.coalesce(c, F.lit("")) for c in others}
    return base.select("doc_id", "ord", *[values[c].alias(c) if c in values else F.col(c) for c in COLUMNS])


def names_table(counts: DataFrame) -> DataFrame:
    """Names by falling count, then name."""
    return counts.groupBy("name").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "name")


def ranked(rows: DataFrame, *order, name: str = "place") -> DataFrame:
    """Rows with their place (from 1) in the whole order, none through the driver or one task:
    partitions by ranges, sorted; the place inside, and the sizes of the partitions before,
    of which there is one number each. ``order`` has to tell all rows apart."""
    ordered = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()))
    part, inside = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    sizes = ordered.groupBy(part.cast("int").alias("__part")).agg(F.count("*").alias("n"))
    before = sizes.select("__part", (F.sum("n").over(W.orderBy("__part")) - F.col("n")).alias("__before"))
    placed = ordered.withColumn("__part", part.cast("int")).join(F.broadcast(before), "__part")
    return placed.withColumn(name, (F.col("__before") + inside + 1).cast("int")).drop("__id", "__part", "__before")


def run_counters(counts: DataFrame, valid: DataFrame, main: DataFrame, paras: DataFrame, conditions: DataFrame) -> DataFrame:
    """One row: how much of everything a run has seen."""
    n = lambda df, name: df.agg(F.count("*").alias(name)).withColumn("__one", F.lit(1))
    out = n(counts, "total_names_found")
    for df, name in ((valid, "validated_names"), (main, "main_names"), (paras, "total_paragraphs"), (conditions, "conditions_found")):
        out = out.join(n(df, name), "__one")
    return out.drop("__one")
