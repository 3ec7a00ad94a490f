"""Condition-shaped rows derived from the order tables, for the record operators."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Runs unchanged on Spark and DuckDB.
CONDITIONS = """
SELECT l_orderkey AS doc_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INT) AS ord,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE p_type END AS critical_polymer_unit,
  CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE p_name END AS column_name,
  CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE p_brand END AS manufacturer,
  CASE WHEN l_suppkey % 3 = 0 THEN NULL WHEN l_suppkey % 3 = 1 THEN 'acetone / water'
       ELSE 'butanone and cyclohexane' END AS solvent,
  CASE WHEN l_linenumber % 4 = 0 THEN NULL
       WHEN l_linenumber % 4 = 1 THEN CAST(CAST(round(100*(1-l_discount)) AS INT) AS VARCHAR(10)) || '/'
            || CAST(CAST(round(100*l_discount) AS INT) AS VARCHAR(10))
       ELSE CAST(CAST(round(100*(1-l_discount)) AS INT) AS VARCHAR(10)) END AS ratio,
  CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR(10)) || ' C'
       ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR(10)) || '-60 C' END AS temperature,
  'm' || CAST(l_suppkey % 3 AS VARCHAR(10)) AS model
FROM lineitem JOIN part ON l_partkey = p_partkey"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """SQL over tables; they are arguments of the statement, so no view of the session is
    replaced."""
    sql = sql.replace("{", "{{").replace("}", "}}")
    for name in names:
        sql = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", sql)
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, CONDITIONS, "lineitem", "part")
