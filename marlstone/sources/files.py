"""Files in and out: whole-text documents, TEI markup, JSON, CSV and spreadsheet reports."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators.report import COLUMNS
from marlstone.sources.workbook import sheet


def text_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole files as UTF-8; undecodable bytes are dropped. A missing path
    raises."""
    rows = spark.read.format("binaryFile").load(path)
    text = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "�", "")
    return rows.select("path", text.alias("text"))


def tei_text(xml: Column) -> Column:
    """Body text of TEI markup outside tables, a line per text node."""
    nodes = F.xpath(xml, F.lit("//body//text()[not(ancestor::table)]"))
    return F.array_join(F.filter(F.transform(nodes, lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != ""), "\n")


def _tables_of(xml: str) -> Iterator[tuple[int, int, list[str]]]:
    """(table from 1, row from 0, cells) of a document; a table without rows has one empty
    row, so that its number isn't lost. Names count without their prefix."""
    from xml.etree import ElementTree

    local = lambda e: e.tag.rsplit("}", 1)[-1]
    inside = lambda e, name: [x for x in e.iter() if isinstance(x.tag, str) and local(x) == name]
    for n, found in enumerate(inside(ElementTree.fromstring(xml.encode()), "table"), 1):
        rows = [[" ".join(t for t in map(str.strip, cell.itertext()) if t) for cell in inside(row, "cell")] for row in inside(found, "row")]
        width = max(map(len, rows), default=0)
        for i, cells in enumerate(rows or [[]]):
            yield n, i, cells + [""] * (width - len(cells))


def tei_tables(docs: DataFrame, xml: str = "xml") -> DataFrame:
    """(doc_id, table_idx from 1, row_idx, cells): rows of all tables, nested ones too, padded
    with '' to their table's width. A parser reads each document, so prefixes and entities of
    any kind are right; a document that is null gives no rows, one that is no XML raises."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, table_idx int, row_idx int, cells array<string>"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(d, *r) for d, x in zip(part["doc_id"], part["xml"], strict=True) if x is not None for r in _tables_of(x)]
            yield pd.DataFrame(rows, columns=["doc_id", "table_idx", "row_idx", "cells"])

    return docs.select("doc_id", F.col(f"`{xml}`").alias("xml")).mapInPandas(run, schema)


def page_text(html: Column) -> Column:
    """Visible text of a web page: scripts, styles, comments and tags away."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"(?s)<[^>]*>", " "), r"\s+", " "))


def save_json(result: DataFrame, path: str) -> None:
    """A single pretty JSON document of a one-row result, nulls kept."""
    out = F.to_json(F.struct("*"), {"ignoreNullFields": "false", "pretty": "true"})
    result.select(out.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def save_csv(table: DataFrame, path: str, columns: tuple[str, ...] = COLUMNS) -> None:
    """The columns in order under a header; an empty table is a header and one blank row."""
    spark = table.sparkSession
    text = table.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
    if text.isEmpty():
        text = spark.createDataFrame([("",) * len(columns)], text.schema)
    text.coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").option("lineSep", "\r\n").csv(path)


def sheet_widths(table: DataFrame, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """(column, width): characters of the longest cell or heading and two, 50 at most."""
    widest = table.agg(*[F.max(F.length(F.col(c))).alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.least(F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(len(c))) + 2, F.lit(50)).alias("width")) for c in columns]))
    return widest.select(pairs.alias("x")).select("x.*")


def save_sheet(table: DataFrame, path: str, columns: tuple[str, ...] = COLUMNS, title: str = "LCCC_Conditions", most_rows: int = 100_000) -> None:
    """A workbook with one sheet, for reports of up to ``most_rows`` rows (more raise)."""
    rows = table.select(*[F.col(c).cast("string").alias(c) for c in columns]).limit(most_rows + 1).collect()
    if len(rows) > most_rows:
        raise ValueError(f"more than {most_rows} rows")
    widths = {r["column"]: r["width"] for r in sheet_widths(table, columns).collect()}
    with open(path, "wb") as f:
        f.write(sheet(title, columns, rows, [widths[c] for c in columns]))


def save_result(result: DataFrame, path: str) -> None:
    """pipeline.result(): of one document a pretty JSON file, of several a folder of JSON
    lines. ``tables`` is left out where it holds nothing; other nulls are kept."""
    if len(result.limit(2).take(2)) > 1:
        result.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)
        return
    body = F.struct("metadata", F.coalesce("conditions", F.array().cast(result.schema["conditions"].dataType)).alias("LCCC_conditions"), "tables")
    told = [json.loads(r.value) for r in result.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("value")).collect()]
    for one in told:
        if not (one["tables"] or {}).get("conditions"):
            del one["tables"]
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(told[0] if told else {"metadata": {}, "LCCC_conditions": []}, f, indent=2, ensure_ascii=False)


def save_markup(docs: DataFrame, path: str, xml: str = "xml") -> None:
    """Of (doc_id, xml) the body texts and the tables: path/text has a JSON line per document,
    path/tables a CSV folder per document and table, rows in their order."""
    docs.select("doc_id", tei_text(F.col(xml)).alias("text")).write.mode("overwrite").json(f"{path}/text")
    rows = tei_tables(docs, xml)
    quoted = F.transform("cells", lambda c: F.when(c.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c))
    lines = rows.select("doc_id", "table_idx", "row_idx", F.array_join(quoted, ",").alias("value"))
    dealt = lines.repartition("doc_id", "table_idx").sortWithinPartitions("doc_id", "table_idx", "row_idx")
    dealt.drop("row_idx").write.mode("overwrite").partitionBy("doc_id", "table_idx").option("lineSep", "\r\n").text(f"{path}/tables")
