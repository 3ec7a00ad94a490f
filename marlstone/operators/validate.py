"""Fields held against the text they came from, and against a catalogue of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions import text as T
from marlstone.operators.records import BEHAVIOR, SOLVENT, STATIONARY, TECHNICAL

# How strictly fields are checked.
SOFT = ("solvent", "phase", "modification", "material", "manufacturer", "column_name", "injected_polymer_solvent_solution", "injected_polymer_concentration")
NUMERIC = ("ratio", "flow_rate", "injection_volume", "injected_polymer_concentration", "pore_size", "particle_diameter", "column_dimensions")
UNITS = ("wt%", "w/w", "v/v", "vol%", "%")
MATCHED = ("column_name", "phase", "modification", "material")


def checked(field: str, value: Column, source: Column | None = None, normal: Column | None = None) -> Column:
    """The value if its field's rule accepts it for the source text, else null. ``normal`` is
    that text normalised, where it is at hand."""
    normal = T.normalize(source) if normal is None else normal
    v = F.nullif(F.trim(value), F.lit(""))
    if field == "temperature":
        return T.single_temperature(v)
    if field == "number_of_columns":
        return v
    if field in BEHAVIOR:
        words = F.size(F.filter(F.split(v, r"\s+"), lambda w: w != ""))
        return F.when((words >= 5) & (F.length(v) <= 500), v)
    if field in SOFT:
        return F.when(F.length(v) <= 300, v)
    good = T.value_in_normal(v, normal)
    if field in NUMERIC:
        good = good | T.numbers_in_normal(v, normal)
    if field == "ratio_units":
        t = F.lower(normal)
        for unit in UNITS:
            good = good | F.contains(t, F.lit(unit))
    return F.when(F.coalesce(good, F.lit(False)), v)


def validated(conditions: DataFrame, source: str | None = None, normal: str | None = None) -> DataFrame:
    """Every field of the groups, checked against the text in column ``source``, or against
    the normalised one in column ``normal``."""
    fields = (*STATIONARY, *SOLVENT, *TECHNICAL, *BEHAVIOR)
    texts = {"normal": F.col(normal)} if normal else {"source": F.col(source)}
    return conditions.withColumns({f: checked(f, F.col(f), **texts) for f in fields if f in conditions.columns})


def matches(left: dict[str, Column], right: dict[str, Column]) -> Column:
    """Whether one of the fields of both holds the other's (normalised)."""
    out = F.lit(False)
    for f, a in left.items():
        b = right[f]
        out = out | F.coalesce((a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a)), F.lit(False))
    return out


def catalog_match(conditions: DataFrame, catalog: DataFrame, fields: tuple[str, ...] = MATCHED) -> DataFrame:
    """(doc_id, ord, col_idx): for each condition the first column of its document's
    catalogue that matches on a field. The join is on doc_id, the test its residue."""
    a = conditions.select("doc_id", "ord", *[T.norm_key(F.col(f)).alias(f"a_{f}") for f in fields])
    b = catalog.select("doc_id", "col_idx", *[T.norm_key(F.col(f)).alias(f"b_{f}") for f in fields])
    pairs = a.join(b, "doc_id").where(matches({f: F.col(f"a_{f}") for f in fields}, {f: F.col(f"b_{f}") for f in fields}))
    return pairs.groupBy("doc_id", "ord").agg(F.min("col_idx").alias("col_idx"))


def with_catalog(conditions: DataFrame, catalog: DataFrame, fields: tuple[str, ...] = MATCHED, fill: tuple[str, ...] = STATIONARY) -> DataFrame:
    """Conditions whose nulls are filled from their first matching column; of documents with
    a catalogue, those without a match go."""
    found = catalog_match(conditions, catalog, fields)
    fill = tuple(f for f in fill if f in catalog.columns and f in conditions.columns)
    best = found.join(catalog.select("doc_id", "col_idx", *[F.col(f).alias(f"__c_{f}") for f in fill]), ["doc_id", "col_idx"])
    has = catalog.select("doc_id").distinct().withColumn("__has", F.lit(True))
    rows = conditions.join(best.drop("col_idx").withColumn("__hit", F.lit(True)), ["doc_id", "ord"], "left").join(has, "doc_id", "left")
    rows = rows.where(F.col("__hit").isNotNull() | F.col("__has").isNull())
    return rows.withColumns({f: F.coalesce(f, f"__c_{f}") for f in fill}).drop("__hit", "__has", *[f"__c_{f}" for f in fill])


def with_hint(conditions: DataFrame, hints: DataFrame, fields: tuple[str, ...] = STATIONARY) -> DataFrame:
    """Nulls filled from the column (doc_id, col_idx) that drove the extraction."""
    named = hints.select("doc_id", "col_idx", *[F.col(f).alias(f"__h_{f}") for f in fields])
    return conditions.join(named, ["doc_id", "col_idx"], "left").withColumns({f: F.coalesce(f, f"__h_{f}") for f in fields}).drop(*[f"__h_{f}" for f in fields])


def by_name(names: DataFrame, catalog: DataFrame) -> DataFrame:
    """(doc_id, ord, col_idx): the first column whose name holds the given one or is held."""
    return catalog_match(names, catalog, ("column_name",))
