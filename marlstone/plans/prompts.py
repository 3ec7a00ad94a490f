"""What a model is asked, as columns: instructions, the shape of the answer, a catalogue of
the document's columns, values that are settled, and the text."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marlstone.operators.records import FIELDS, GROUPS, STATIONARY, TOP
from marlstone.operators.report import COLUMNS

SHAPE = json.dumps({"conditions": [{**dict.fromkeys(TOP), **{g: dict.fromkeys(fields) for g, fields in GROUPS.items()}}]})
SHAPE_COLUMNS = json.dumps({"columns": [dict.fromkeys(STATIONARY)]})
SHAPE_TABLE = json.dumps({"conditions": [dict.fromkeys(COLUMNS, "")]})
RULES = "Answer with JSON only, in this shape:\n{}\nCopy values as the text spells them. Write null for what it does not state; never guess.\n"
CONDITIONS = "List every experimental condition that the text states.\n" + RULES.format(SHAPE)
CATALOGUE = "List every separation column that the text describes, one entry each.\n" + RULES.format(SHAPE_COLUMNS)
ONE_COLUMN = "List the experimental conditions that the text states for this one column and no other.\n" + RULES.format(SHAPE)
WHOLE = "These are the paragraphs of a document that say most about its experiments. List every condition they state, also those told in passing.\n" + RULES.format(SHAPE)
REFINE = "Complete one record from the text. Keep the values that are settled as they are.\n" + RULES.format(SHAPE)
CLEAN = "Tidy this table: one row per condition, doubles merged, units spelled alike, a single share of a mixture written as a/b. Add nothing that it does not hold.\n" + RULES.format(SHAPE_TABLE)
#: Columns of the catalogue that a prompt names.
NAMED = 8


def _text(text: Column) -> Column:
    return F.concat(F.lit("\nText:\n"), text)


def catalogue_block(catalogue: DataFrame, most: int = NAMED) -> DataFrame:
    """(doc_id, block): the first ``most`` columns of each document, numbered, as JSON."""
    first = catalogue.withColumn("r", F.row_number().over(W.partitionBy("doc_id").orderBy("col_idx"))).where(F.col("r") <= most)
    lines = F.struct("r", F.concat(F.col("r").cast("string"), F.lit(". "), F.to_json(F.struct(*STATIONARY))).alias("line"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(lines)), lambda x: x["line"]), "\n")
    return first.groupBy("doc_id").agg(F.concat(F.lit("\nColumns of this document:\n"), joined, F.lit("\n")).alias("block"))


def conditions(evidence: Column, block: Column) -> Column:
    return F.concat(F.lit(CONDITIONS), F.coalesce(block, F.lit("")), _text(evidence))


def whole(evidence: Column) -> Column:
    return F.concat(F.lit(WHOLE), _text(evidence))


def catalogue(evidence: Column) -> Column:
    return F.concat(F.lit(CATALOGUE), _text(evidence))


def one_column(column: Column, evidence: Column) -> Column:
    """column: a struct of the column's fields."""
    return F.concat(F.lit(ONE_COLUMN), F.lit("\nColumn:\n"), F.to_json(column), F.lit("\n"), _text(evidence))


def refine(evidence: Column) -> Column:
    """For a row with a record's fields: those with a value are settled, the others asked."""
    settled = F.array_join(F.filter(F.array(*[F.when(F.col(f).isNotNull(), F.concat(F.lit(f + " = "), F.col(f))) for f in FIELDS]), lambda x: x.isNotNull()), "\n")
    asked = F.array_join(F.filter(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in FIELDS]), lambda x: x.isNotNull()), ", ")
    return F.concat(F.lit(REFINE), F.lit("\nSettled:\n"), settled, F.lit("\nAsked for:\n"), asked, F.lit("\n"), _text(evidence))


def clean(rows: Column) -> Column:
    """rows: the table's rows as JSON."""
    return F.concat(F.lit(CLEAN), F.lit("\nTable:\n"), rows)
