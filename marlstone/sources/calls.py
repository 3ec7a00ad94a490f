"""Calls of services from tasks, several in flight, and a ledger of what they answered.

The ledger is a folder of small files, each the answers of a few calls, written as soon as
they are there and never changed. A key that has an answer is not asked again: not in a later
run, and not by a task that runs again after it failed, as it first reads what the attempt
before it wrote. Failures are kept too, with their reason, but asked again in a later run.
"""

from __future__ import annotations

import json
import os
import random
import time
import urllib.error
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Patience:
    """How often a call is tried and how long to wait in between: ``delay`` at first, then
    twice as long each time, at most ``most_delay``, less up to a quarter."""

    attempts: int = 2
    delay: float = 2.0
    most_delay: float = 30.0

    def tried(self, call: Callable[[], object]) -> tuple[object, str | None]:
        """What the call gives, or None and why. Refusals that may pass (no connection, 429,
        5xx) are tried again; others are answers."""
        reason = None
        for attempt in range(self.attempts):
            if attempt:
                time.sleep(min(self.delay * 2 ** (attempt - 1), self.most_delay) * (1 - random.random() / 4))
            try:
                return call(), None
            except urllib.error.HTTPError as error:
                reason = f"status {error.code}"
                if error.code != 429 and error.code < 500:
                    break
            except (OSError, ValueError) as error:
                reason = f"{type(error).__name__}: {error}"[:200]
        return None, reason


def in_flight(items: Iterator, call: Callable, at_once: int, named: Callable = lambda item: item) -> Iterator[tuple[object, object]]:
    """(named(item), call(item)) as calls end, at most ``at_once`` running and no more taken ahead."""
    with ThreadPoolExecutor(at_once) as pool:
        running: dict = {}
        for item in items:
            running[pool.submit(call, item)] = named(item)
            if len(running) >= at_once:
                for done in wait(running, return_when=FIRST_COMPLETED).done:
                    yield running.pop(done), done.result()
        while running:
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                yield running.pop(done), done.result()


def tasks_for(spark: SparkSession, limit: int) -> tuple[int, int]:
    """Tasks and calls of each, so that all together have at most ``limit`` calls in flight."""
    tasks = max(1, min(limit, spark.sparkContext.defaultParallelism))
    return tasks, max(1, limit // tasks)


def _local(path: str) -> str | None:
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") or "://" not in path else None


def _write(path: str, text: str) -> None:
    """A whole file or none, in a local folder or a store that pyarrow knows."""
    local = _local(path)
    if local:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(f"{local}.part", "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(f"{local}.part", local)
        return
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    with system.open_output_stream(inner) as f:
        f.write(text.encode())


def _lines(folder: str) -> Iterator[dict]:
    """The records of a folder's files; none if it isn't there."""
    from pyarrow import fs

    local = _local(folder)
    system, inner = (fs.LocalFileSystem(), local) if local else fs.FileSystem.from_uri(folder)
    for found in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        if found.path.endswith(".json"):
            with system.open_input_stream(found.path) as f:
                yield from map(json.loads, f.read().decode().splitlines())


class Ledger:
    """Answers by key, at a path that stays. ``keys`` and ``value`` name string columns; the
    value of a failure is null."""

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...], value: str):
        self.spark, self.path, self.keys, self.value = spark, path.rstrip("/"), keys, value
        self.schema = ", ".join(f"{k} string" for k in (*keys, value, "reason"))

    def answers(self) -> DataFrame:
        """(keys, value, reason), one row per key: an answer before a failure."""
        rows = self.spark.createDataFrame([], self.schema)
        if self._there():
            rows = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(self.path)
        best = F.struct(F.col(self.value).isNull().alias("failed"), F.col(self.value).alias("value"), "reason")
        return rows.groupBy(*self.keys).agg(F.min(best).alias("a")).select(*self.keys, F.col("a.value").alias(self.value), "a.reason")

    def _there(self) -> bool:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def ask(self, rows: DataFrame, call: Callable[[dict], tuple[str | None, str | None]], limit: int, kept_every: int = 8, run: str | None = None) -> DataFrame:
        """answers() after every key of ``rows`` has been asked for that had no answer, each
        once. call gets a row (of one of equal keys) and gives value and reason; at most
        ``limit`` are in flight, and at most ``kept_every`` answers of a task unwritten."""
        keys, value, path = self.keys, self.value, self.path
        run = run or uuid.uuid4().hex
        tasks, at_once = tasks_for(self.spark, limit)
        others = [c for c in rows.columns if c not in keys]
        new = rows.groupBy(*keys).agg(*[F.min(c).alias(c) for c in others]) if others else rows.distinct()
        new = new.join(self.answers().where(F.col(value).isNotNull()), list(keys), "left_anti")
        names = new.columns

        def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            folder = f"{path}/run={run}/part={TaskContext.get().partitionId():05d}"
            done = {tuple(x[k] for k in keys) for x in _lines(folder)}
            items = (x for b in batches for x in (dict(zip(names, r, strict=True)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)) if tuple(x[k] for k in keys) not in done)
            held, n = [], 0

            def kept() -> None:
                if held:
                    _write(f"{folder}/{uuid.uuid4().hex}.json", "".join(json.dumps(x) + "\n" for x in held))
                    held.clear()

            try:
                for item, (answer, reason) in in_flight(items, call, at_once):
                    held.append({k: item[k] for k in keys} | {value: answer, "reason": reason})
                    n += 1
                    if len(held) >= kept_every:
                        kept()
            finally:
                kept()
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

        # the same keys in the same task, whenever it runs
        new.repartition(tasks, *keys).mapInArrow(asked, "n bigint").agg(F.sum("n")).collect()
        return self.answers()
