"""JSON out of a model's answer: the longest part that parses, and the records in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators.records import GROUPS, TOP

# The keys of the list of records, and other spellings of the groups.
LIST_KEYS = ("LCCC_conditions", "conditions")
OTHER_KEYS = {
    "critical_polymer_unit": "critical_unit",
    "polymer_system": "Polymer_System",
    "SP_FIELDS": "stationary_phase",
    "SOL_FIELDS": "solvent_details",
    "TECH_FIELDS": "technical_details",
    "separation_behavior": "behavior",
}


def json_part(text: Column) -> Column:
    """The longest candidate that is JSON, as a string: objects of two levels, the span of
    all braces, the span of all brackets; scratch pads and code fences are cut away first."""
    t = F.regexp_replace(text, r"(?is)<scratchpad>.*?</scratchpad>", "")
    t = F.regexp_replace(F.trim(t), r"(?is)^```(?:json)?\s*|\s*```$", "")
    objects = F.regexp_extract_all(t, F.lit(r"(?s)\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\}"), F.lit(0))
    spans = F.array(F.regexp_extract(t, r"(?s)\{.*\}", 0), F.regexp_extract(t, r"(?s)\[.*\]", 0))
    every = F.filter(F.concat(objects, spans), lambda c: c != "")
    # inside brackets, as the parser lets anything follow a value
    parses = F.filter(F.transform(every, lambda c, i: F.struct((-F.length(c)).alias("l"), i.alias("i"), c.alias("c"))), lambda x: F.try_parse_json(F.concat(F.lit("["), x["c"], F.lit("]"))).isNotNull())
    return F.get(F.sort_array(parses), 0)["c"]


def lists(responses: DataFrame, keys: tuple[str, ...], whole: bool = True) -> DataFrame:
    """``responses`` (.., response) with items: the list of an answer under the first of the
    keys that has one, or (with ``whole``) the answer if it is a list; else null."""
    v = F.try_parse_json(json_part(F.col("response")))
    found = [F.try_variant_get(v, f"$.{k}", "array<variant>") for k in keys]
    return responses.withColumn("items", F.coalesce(*found, *([F.try_variant_get(v, "$", "array<variant>")] if whole else [])))


def records(responses: DataFrame, keys: tuple[str, ...] = LIST_KEYS) -> DataFrame:
    """``responses`` (.., response) with item_seq and the record as JSON text; answers
    without a list of records give none."""
    out = lists(responses, keys).select(*responses.columns, F.posexplode("items").alias("item_seq", "__v"))
    return out.withColumn("record", F.to_json("__v")).where(F.col("record").startswith("{")).drop("__v")


def columns(responses: DataFrame) -> DataFrame:
    """The separation columns of answers: item_seq and the stationary fields."""
    found = records(responses, ("columns",))
    return found.withColumns({f: _scalar(_leaf(F.col("record"), f)) for f in GROUPS["SP_FIELDS"]}).drop("record", "response")


def parse_failures(responses: DataFrame) -> DataFrame:
    """One row: answers, and answers that hold no list of records."""
    return lists(responses, LIST_KEYS).agg(F.count("*").alias("llm_calls"), F.count_if(F.col("items").isNull()).alias("parse_failures"))


def _leaf(group: Column, field: str) -> Column:
    return F.nullif(F.trim(F.get_json_object(group, f"$.{field}")), F.lit(""))


def _scalar(leaf: Column) -> Column:
    """Null for what is no scalar; whole numbers without a fraction."""
    return F.when(~leaf.rlike(r"^[\[{]"), F.regexp_replace(leaf, r"^(-?\d+)\.0+$", "$1"))


def flat(found: DataFrame) -> DataFrame:
    """The record's fields as columns: groups under either key, a list stands for its first
    element, an object as a unit for its first key; values that are no scalars are null."""
    rec = F.col("record")
    groups = {}
    for name in GROUPS:
        g = F.coalesce(F.get_json_object(rec, f"$.{name}"), F.get_json_object(rec, f"$.{OTHER_KEYS[name]}"))
        groups[f"__{name}"] = F.when(g.startswith("["), F.get_json_object(g, "$[0]")).otherwise(g)
    out = found.withColumns(groups)
    columns = {}
    for name in TOP:
        value = F.coalesce(F.get_json_object(rec, f"$.{name}"), F.get_json_object(rec, f"$.{OTHER_KEYS[name]}"))
        first_key = F.get(F.json_object_keys(value), 0)
        columns[name] = F.nullif(F.trim(F.when(value.startswith("{"), first_key).otherwise(value)), F.lit(""))
    for name, fields in GROUPS.items():
        for f in fields:
            columns[f] = _scalar(_leaf(F.col(f"__{name}"), f))
    return out.withColumns(columns).drop("record", *groups)
