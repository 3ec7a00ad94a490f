"""Folders of documents as a source, of a batch or a stream, and of reports as a sink.

    spark.dataSource.register(TextFolder)
    spark.read.format("marlstone_texts").option("path", folder).load()
    spark.readStream.format("marlstone_texts").option("path", folder).load()
    save_reports(results, tables, folder)

The driver lists files and commits folders, one for each task; contents pass through tasks
alone. Paths are local or of a store that pyarrow knows.
"""

from __future__ import annotations

import csv
import io
import re
import time
import urllib.parse
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

from marlstone.operators.report import COLUMNS
from marlstone.sources.workbook import sheet


def _system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + urllib.parse.unquote(path.removeprefix("file:")).lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]

    def __post_init__(self) -> None:
        self.value = self.paths


def _listed(options: dict) -> list[tuple[int, str, int]]:
    """(time of change, path, size) of the files below the folder, in this order; names that
    start with . or _ are passed over. A missing folder raises."""
    system, top = _system(options["path"])
    found = system.get_file_info(fs.FileSelector(top, recursive=True))
    return sorted((f.mtime_ns or 0, f.path, f.size) for f in found if f.type == fs.FileType.File and not re.match(r"[._]", f.base_name))


def _partitions(found: list[tuple[int, str, int]], options: dict) -> list[Files]:
    """Tasks of files of about task_bytes together; a larger file is alone."""
    most, groups, held = int(options.get("task_bytes", 64 << 20)), [], 0
    for _, path, size in found:
        if not groups or held + size > most:
            groups.append([])
            held = 0
        groups[-1].append(path)
        held += size
    return [Files(tuple(g)) for g in groups]


def _texts(options: dict, part: Files) -> Iterator[tuple[str, str]]:
    system, _ = _system(options["path"])
    for path in part.paths:
        with system.open_input_stream(path) as f:
            yield path, f.read().decode("utf-8", "ignore")


class TextFolder(DataSource):
    """(path, text) of every file below a folder, as UTF-8 without bytes that aren't. As a
    stream, files by time of change: one that appears must be newer than those before it, as
    files are that are written elsewhere and then moved in."""

    @classmethod
    def name(cls) -> str:
        return "marlstone_texts"

    def schema(self) -> str:
        return "path string, text string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Files]:
        return _partitions(_listed(self.options), self.options) or [Files(())]

    def read(self, partition: Files) -> Iterator[tuple[str, str]]:
        return _texts(self.options, partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self) -> dict:
        return {"time": 0, "path": ""}

    def latestOffset(self) -> dict:
        found = _listed(self.options)
        return {"time": found[-1][0], "path": found[-1][1]} if found else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Files]:
        low, high = (start["time"], start["path"]), (end["time"], end["path"])
        return _partitions([f for f in _listed(self.options) if low < f[:2] <= high], self.options) or [Files(())]

    def read(self, partition: Files) -> Iterator[tuple[str, str]]:
        return _texts(self.options, partition)

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Written(WriterCommitMessage):
    folder: str
    documents: int


class ReportFolder(DataSource):
    """Of (doc_id, result, rows) a JSON file, a CSV file and a workbook per document, in one
    folder for each task. They are written aside and moved in when all tasks are done; if one
    fails, nothing is left."""

    @classmethod
    def name(cls) -> str:
        return "marlstone_reports"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options))


class _Writer(DataSourceWriter):
    def __init__(self, options: dict):
        self.path, self.columns, self.title = options["path"].rstrip("/"), options["columns"].split(","), options["title"]
        self.staged = f"{self.path}/_staged-{uuid.uuid4().hex}"
        system, staged = _system(self.staged)
        system.create_dir(staged, recursive=True)  # here alone: a task that is late can't make it again

    def write(self, iterator) -> Written:
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        system, folder = _system(f"{self.staged}/{name}")
        system.create_dir(folder, recursive=False)
        documents = 0
        for row in iterator:
            file = urllib.parse.quote(str(row.doc_id), safe="")[-180:]
            for ending, data in (("json", (row.result or "").encode()), ("csv", self._csv(row.rows)), ("xlsx", self._workbook(row.rows))):
                with system.open_output_stream(f"{folder}/{file}.{ending}") as f:
                    f.write(data)
            documents += 1
        return Written(name, documents)

    def _csv(self, rows) -> bytes:
        out = io.StringIO()
        lines = csv.writer(out, lineterminator="\r\n")
        lines.writerow(self.columns)
        lines.writerows(rows or [[""] * len(self.columns)])
        return out.getvalue().encode()

    def _workbook(self, rows) -> bytes:
        rows = [tuple(r) for r in rows or ()]
        widths = [min(max(map(len, column)) + 2, 50) for column in zip(self.columns, *rows, strict=True)]
        return sheet(self.title, tuple(self.columns), rows, widths)

    def commit(self, messages) -> None:
        system, staged = _system(self.staged)
        for message in filter(None, messages):
            if message.documents:
                system.move(f"{staged}/{message.folder}", f"{_system(self.path)[1]}/{message.folder}")
        self.abort(messages)

    def abort(self, messages) -> None:
        system, staged = _system(self.staged)
        for _ in range(50):  # other tasks may still be writing when one has failed
            if system.get_file_info(staged).type == fs.FileType.NotFound:
                break
            try:
                system.delete_dir(staged)
            except OSError:
                time.sleep(0.1)


def save_reports(result: DataFrame, table: DataFrame, path: str, columns: tuple[str, ...] = COLUMNS, title: str = "LCCC_Conditions") -> None:
    """Files for each document of pipeline.result() and of the table's rows (doc_id, ord, the
    columns): written by the tasks, none through the driver. A document's rows meet in one
    task."""
    result.sparkSession.dataSource.register(ReportFolder)
    texts = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    rows = table.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", texts.alias("t")))), lambda x: x["t"]).alias("rows"))
    told = F.to_json(F.struct("metadata", F.coalesce("conditions", F.array().cast(result.schema["conditions"].dataType)).alias("LCCC_conditions"), "tables"), {"ignoreNullFields": "false", "pretty": "true"})
    out = result.select("doc_id", told.alias("result")).join(rows, "doc_id", "left").select(F.col("doc_id").cast("string").alias("doc_id"), "result", "rows")
    out.write.format("marlstone_reports").option("path", path).option("columns", ",".join(columns)).option("title", title).mode("append").save()
