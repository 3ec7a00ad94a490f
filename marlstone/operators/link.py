"""Linking: conditions of a document with the same key become one, then rules repair them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions import text as T
from marlstone.operators import rules as R
from marlstone.operators.consensus import fuzzy_merge
from marlstone.operators.records import BEHAVIOR, FIELDS, SOLVENT, STATIONARY, TECHNICAL, complete_columns

RANGED = ("temperature", "flow_rate", "injection_volume")
KEY = ("critical_polymer_unit", "column_name", "manufacturer", "column_dimensions", "phase", "solvent")
# Words that name a column by themselves.
FAMILIAR = ("jordi", "discovery", "hs-peg", "nucleosil", "diol")
#: Fields that repaired() may fill where conditions have none.
INFERRED = ("column_name", "pore_size", "phase", *SOLVENT)
VALUES = ("critical_polymer_unit", *STATIONARY, *SOLVENT, *TECHNICAL, *BEHAVIOR)


def _first(field: str) -> Column:
    return F.expr(f"min_by(`{field}`, CASE WHEN `{field}` <> '' THEN ord END)")


def keyed_merge(conditions: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """(doc_id, first_ord, fields, context_snippets): per document and normalised key the
    first value of each field; ratios and some technical values as the span of all that
    parse, if the first does. Without any key part but the unit, the snippet is the key.

    One aggregation with partial sums: no record list is gathered but the snippets.
    """
    return complete_columns(_keyed(conditions, key)).select("doc_id", "ord", *FIELDS, "context_snippets")


def _keyed(conditions: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """keyed_merge() with the fields that ``conditions`` has."""
    told = "context_snippet" in conditions.columns
    rows, given = conditions, [f for f in FIELDS if f in conditions.columns]  # the others are null
    if not told:
        rows = rows.withColumn("context_snippet", F.lit(None).cast("string"))
    names = [f"__k{i}" for i in range(len(key))]
    # one pass over an array, exploded as one element: worked out once, and no code of many rules
    norms = F.transform(F.array(*[F.col(k) if k in given else F.lit(None).cast("string") for k in key], F.col("context_snippet")), T.norm_key)
    rows = rows.withColumn("__norms", F.explode(F.array(norms)))
    rows = rows.withColumns({n: F.get("__norms", i) for i, n in enumerate(names)})
    bare = F.concat(*names[1:]) == ""
    rows = rows.withColumn("__snippet", F.when(bare, F.get("__norms", len(key))).otherwise("")).drop("__norms")
    ranged = [f for f in (*RANGED, "ratio") if f in given]
    if ranged:
        spans = F.struct(*[(T.ratio_range(F.col(f)) if f == "ratio" else T.value_range(F.nullif(F.col(f), F.lit("")))).alias(f) for f in ranged])
        rows = rows.withColumn("__spans", F.explode(F.array(spans))).withColumns({f"__{f}": F.col(f"__spans.{f}") for f in ranged}).drop("__spans")
    out = [F.min("ord").alias("first_ord")]
    for f in given:
        if f not in (*ranged, "ratio_units"):
            out.append(_first(f).alias(f))
    for f in ranged:
        parsed = f"__{f}"
        out += [_first(f).alias(f), F.expr(f"min_by(`{parsed}`, CASE WHEN `{f}` <> '' THEN ord END)").alias(f"{parsed}0"), F.min(f"{parsed}.lo").alias(f"{parsed}lo"), F.max(f"{parsed}.hi").alias(f"{parsed}hi")]
        parses = f"CASE WHEN `{parsed}` IS NOT NULL THEN `{f}` END"  # different ones: cheaper than counting them
        out.append(F.expr(f"min({parses}) <> max({parses})").alias(f"{parsed}n"))
        if f != "ratio":
            out.append(F.expr(f"min_by(`{parsed}`.unit, CASE WHEN `{parsed}`.unit <> '' THEN ord END)").alias(f"{parsed}unit"))
    if "ratio_units" in given:
        out += [_first("ratio_units").alias("ratio_units"), F.expr("max_by(ratio_units, CASE WHEN contains(lower(ratio_units), 'wt%') THEN ord END)").alias("__weight")]
    if told:
        out.append(F.transform(F.sort_array(F.expr("collect_list(struct(ord, context_snippet)) FILTER (WHERE context_snippet <> '')")), lambda x: x["context_snippet"]).alias("context_snippets"))
    merged = rows.groupBy("doc_id", *names, "__snippet").agg(*out)
    spans: dict[str, Column] = {}
    for f in ranged:
        p = f"__{f}"
        span = T.span_text(F.col(f"{p}lo"), F.col(f"{p}hi"), None if f == "ratio" else F.col(f"{p}unit"))
        spans[f] = F.when(F.col(f"{p}0").isNotNull() & F.col(f"{p}n"), span).otherwise(F.col(f))
    if "ratio_units" in given:
        spans["ratio_units"] = F.coalesce("__weight", "ratio_units")
    merged = merged.withColumns(spans)
    if not told:
        merged = merged.withColumn("context_snippets", F.array().cast("array<string>"))
    return merged.select("doc_id", F.col("first_ord").alias("ord"), *given, "context_snippets")


def with_ratio_of_solvent(conditions: DataFrame) -> DataFrame:
    """Ratio and units that the solvent's text holds, where none is given; then one spelling
    per solvent."""
    found = F.when(F.col("ratio").isNull(), R.ratio_in_solvent(F.col("solvent")))
    rows = conditions.withColumn("__f", found)
    rows = rows.withColumn("ratio", F.coalesce("ratio", "__f.ratio")).withColumn("ratio_units", F.coalesce(F.nullif(F.col("ratio_units"), F.lit("")), "__f.units")).drop("__f")
    return normalized_solvent(rows)


def normalized_solvent(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("solvent", R.solvent(F.col("solvent")))
    return rows.withColumn("ratio_units", R.ratio_units(F.col("ratio_units"), F.col("solvent")))


def names_of_column(rows: DataFrame) -> Column:
    def names(norms: Column) -> Column:
        text = F.array_join(norms, " ")
        known = F.filter(F.array(*map(F.lit, FAMILIAR)), lambda t: F.contains(text, t))
        own = F.filter(F.split(F.get(norms, 0), "[^a-z0-9]+"), lambda t: F.length(t) >= 4)
        return F.when(F.size(known) > 0, known).otherwise(own)

    return T.let(F.transform(F.array("column_name", "material", "modification", "phase"), T.norm_key), names)


def repaired(rows: DataFrame, compat: bool = True, widen: bool = True) -> DataFrame:
    """The repair rules, in their order, on merged conditions with context_snippets."""
    empty = lambda c: F.col(c).isNull() | (F.col(c) == "")
    rows = rows.withColumn("__names", names_of_column(rows))
    rows = rows.withColumn("column_name", F.when(empty("column_name"), F.coalesce(R.inferred_column(F.col("context_snippets")), F.col("column_name"))).otherwise(F.col("column_name")))
    rows = rows.withColumn("column_name", R.column_name(F.col("column_name")))
    rows = rows.withColumn("__pair", F.when(empty("ratio"), R.pair_in_snippets(F.col("context_snippets"))))
    rows = rows.withColumn("ratio_units", F.when(empty("ratio_units"), F.coalesce("__pair.units", "ratio_units")).otherwise(F.col("ratio_units"))).withColumn("ratio", F.coalesce(F.nullif(F.col("ratio"), F.lit("")), "__pair.ratio"))
    if widen:
        rows = rows.withColumn("__shares", R.shares_in_snippets(F.col("context_snippets"), F.col("__names"))).withColumn("__now", T.ratio_range(F.col("ratio")))
        some = F.coalesce(F.size("__shares") > 0, F.lit(False)) & (empty("ratio") | F.col("__now").isNotNull())
        span = T.span_text(F.array_min("__shares"), F.array_max("__shares"))
        rows = rows.withColumn("ratio_units", F.when(some & empty("ratio_units") & F.coalesce(F.contains(F.lower("solvent"), F.lit("acetone")), F.lit(False)), "wt% acetone").otherwise(F.col("ratio_units")))
        rows = rows.withColumn("ratio", F.when(some & (F.col("__now").isNull() | (F.size("__shares") > 1)), span).otherwise(F.col("ratio"))).drop("__shares", "__now")
    rows = normalized_solvent(rows)
    rows = rows.withColumn("phase", R.phase(F.col("phase"), F.col("column_name"), F.col("modification"), F.col("material")))
    number = r"^-?\d+(\.\d+)?$"
    rows = rows.withColumn("particle_diameter", R.with_unit(F.col("particle_diameter"), F.col("particle_diameter").rlike(number), "um"))
    rows = rows.withColumn("pore_size", R.with_unit(F.col("pore_size"), F.col("pore_size").rlike(number), "A"))
    rows = rows.withColumn("ratio_units", R.ratio_unit_of(F.col("ratio"), F.col("ratio_units"))).withColumn("ratio", R.bare_ratio(F.col("ratio")))
    rows = rows.withColumn("injection_volume", R.injection_volume(F.col("injection_volume")))
    rows = rows.withColumn("pore_size", R.pore_of_phantom(F.col("pore_size"), F.col("column_name"), compat)).withColumn("column_name", R.real_column(F.col("column_name")))
    rows = rows.withColumn("__shares", R.both_shares(F.col("ratio"), F.col("solvent")))
    rows = rows.withColumn("ratio_units", R.units_of_shares(F.col("ratio_units"), F.col("ratio"), F.col("__shares"))).withColumn("ratio", F.col("__shares"))
    return rows.drop("__names", "__pair", "__shares")


def linked(conditions: DataFrame, compat: bool = True, widen: bool = True, strict_key: bool = False) -> DataFrame:
    """Merge by key, repair, merge what is nearly the same. With ``strict_key`` ratio,
    temperature and system also keep conditions apart. Records are dealt out by document as
    they are given, for both merges: before the normal forms and partial sums of the first,
    which take three times the room on disk."""
    key = (*KEY, "polymer_system", "ratio", "temperature") if strict_key else KEY
    needed = {f: F.lit(None).cast("string") for f in SOLVENT if f not in conditions.columns}
    dealt = conditions.repartition("doc_id").withColumns(needed)
    rows = repaired(complete_columns(_keyed(with_ratio_of_solvent(dealt), key)), compat, widen)
    # only what may have a value travels; the rest is null or empty in each row
    fields = [f for f in FIELDS if (f in conditions.columns or f in INFERRED) and not (f == "polymer_system" and compat and not strict_key)]
    snippets = ["context_snippets"] if "context_snippet" in conditions.columns else []
    merged = fuzzy_merge(rows.select("doc_id", "ord", *fields, *snippets), tuple(f for f in VALUES if f in fields))
    if not snippets:
        merged = merged.withColumn("context_snippets", F.array().cast("array<string>"))
    return complete_columns(merged).select("doc_id", "kept_idx", "ord", *FIELDS, "context_snippets")
