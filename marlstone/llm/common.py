"""Shared helpers: the cluster's shared folder, intermediate tables, Arrow mapping."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir. Where that is unset and driver and
    executors are one machine, as in tests, a fresh local folder that is remembered for the
    application; on a cluster an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="marlstone-")
        spark.sparkContext.setCheckpointDir(_own_dir[app])
    return _own_dir[app]


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def new_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table. What a result still reads can't be removed earlier,
    so it goes when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    system, where = _hadoop(spark, path)
    system.mkdirs(where.getParent())
    system.deleteOnExit(where)
    return path


def make_dir(spark: SparkSession, path: str) -> None:
    system, where = _hadoop(spark, path)
    system.mkdirs(where)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes an intermediate table through the Hadoop file system that holds it."""
    system, where = _hadoop(spark, path)
    system.delete(where, True)
    system.cancelDeleteOnExit(where)


def stored(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Cuts the lineage with a Parquet table in the shared folder; returns it and its path."""
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


#: A key with at least HEAVY rows is joined by broadcast, MOST of them at most.
HEAVY, MOST = 20_000, 20_000


def join_heavy(left: DataFrame, right: DataFrame, keys: list[str], rows: str, how: str = "inner") -> DataFrame:
    """Join (inner or left) of ``left`` to ``right``, which has one row for each value of the keys
    and, in column ``rows``, how many rows of ``left`` have it. Values with very many rows
    are few, so they are broadcast and their rows stay where they are; the others are
    shuffled. Columns: those of left, then the others of right but ``rows``."""
    others = [c for c in right.columns if c not in keys and c != rows]
    heavy = right.where(F.col(rows) >= HEAVY).orderBy(F.desc(rows)).limit(MOST).select(*keys, F.struct(F.lit(1).alias("_"), *others).alias("__heavy"))
    marked = left.join(F.broadcast(heavy), keys, "left")
    spared = marked.where("__heavy IS NOT NULL").select(*left.columns, *[f"__heavy.{c}" for c in others])
    dealt = marked.where("__heavy IS NULL").drop("__heavy").join(right.drop(rows), keys, how).select(*left.columns, *others)
    return spared.union(dealt)


def ids_and_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under names of its own, so that further
    columns (of whatever names) never reach it."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """mapInArrow whose tasks give what they have freed back to the system when they end:
    workers are kept for later stages, and what they hold counts against the executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim is not None:
            trim(0)

    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that the text of a slice stays near max_bytes, whatever the
    lengths of the documents; a longer single text is a slice of its own."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        if batch.nbytes <= max_bytes:
            yield batch
            continue
        sizes = [len(x) if x is not None else 0 for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if total and total + size > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        yield batch.slice(start)
