"""Folders as sources and sinks."""

import csv
import json
import os
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from marlstone.sources.folders import ReportFolder, TextFolder, save_reports

COLUMNS = ("name", "value")


def put(folder, name, data):
    (folder / f".{name}").write_bytes(data)
    os.rename(folder / f".{name}", folder / name)


def test_texts_of_a_folder(spark, tmp_path):
    spark.dataSource.register(TextFolder)
    (tmp_path / "in").mkdir()
    for i in range(40):
        put(tmp_path, f"{i}.txt", f"text {i} é".encode() + b"\xff")
    put(tmp_path / "in", "deep.txt", b"deep")
    put(tmp_path, "_hidden", b"no")
    found = spark.read.format("marlstone_texts").option("path", str(tmp_path)).option("task_bytes", 100).load()
    assert {os.path.basename(r.path): r.text for r in found.collect()} == {f"{i}.txt": f"text {i} é" for i in range(40)} | {"deep.txt": "deep"}
    assert found.rdd.getNumPartitions() > 3
    (tmp_path / "none").mkdir()
    assert spark.read.format("marlstone_texts").option("path", str(tmp_path / "none")).load().count() == 0


def test_stream_of_a_folder(spark, tmp_path):
    spark.dataSource.register(TextFolder)
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()

    def seen():
        query = spark.readStream.format("marlstone_texts").option("path", str(source)).load().writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        assert query.awaitTermination(60)
        return sorted(r.text for r in spark.read.parquet(str(out)).collect())

    for i in range(3):
        put(source, f"b{i}.txt", f"first {i}".encode())
    assert seen() == ["first 0", "first 1", "first 2"]
    time.sleep(0.02)
    put(source, "a.txt", b"second")
    assert seen() == ["first 0", "first 1", "first 2", "second"]  # each file once, over two runs


def results(spark, n):
    result = spark.range(n).select(F.concat(F.lit("d/"), "id").alias("doc_id"), F.struct(F.col("id").alias("n")).alias("metadata"), F.array(F.lit("c")).alias("conditions"), F.lit(None).cast("string").alias("tables"))
    table = spark.range(2 * n).select(F.concat(F.lit("d/"), F.floor(F.col("id") / 2)).alias("doc_id"), (F.col("id") % 2).alias("ord"), F.concat(F.lit('n, "'), "id").alias("name"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("value"))
    return result, table.where("doc_id <> 'd/1'")


def test_reports(spark, tmp_path):
    result, table = results(spark, 300)
    save_reports(result.repartition(5), table, f"file://{tmp_path}/out", COLUMNS)
    files = {f.name: f for f in (tmp_path / "out").glob("part-*/*")}
    assert len(files) == 900 and not list((tmp_path / "out").glob("_*"))
    assert json.loads(files["d%2F7.json"].read_text()) == {"metadata": {"n": 7}, "LCCC_conditions": ["c"], "tables": None}
    assert list(csv.reader(files["d%2F7.csv"].open(newline=""))) == [["name", "value"], ['n, "14', "14"], ['n, "15', ""]]
    assert files["d%2F1.csv"].read_bytes() == b"name,value\r\n,\r\n"  # no rows: a blank one
    with zipfile.ZipFile(files["d%2F7.xlsx"]) as book:
        assert 'n, "14' in book.read("xl/worksheets/sheet1.xml").decode().replace("&quot;", '"')


def test_failing_task_leaves_nothing(spark, tmp_path):
    spark.dataSource.register(ReportFolder)
    rows = spark.range(100).repartition(4).select(F.col("id").cast("string").alias("doc_id"), F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.lit("{}")).alias("result"), F.lit(None).cast("array<array<string>>").alias("rows"))
    with pytest.raises(Exception, match="broken"):
        rows.write.format("marlstone_reports").option("path", f"{tmp_path}/out").option("columns", "a,b").option("title", "t").mode("append").save()
    assert not list(tmp_path.glob("out/*"))
