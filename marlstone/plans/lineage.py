"""Cutting a plan: what comes after starts from files that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Counts:
    """Row counts that come with the jobs that make the tables: seen() marks a table, and after
    a job that read it whole its count is there."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def seen(self, df: DataFrame, name: str) -> DataFrame:
        self._seen[name] = Observation(name)
        return df.observe(self._seen[name], F.count(F.lit(1)).alias(name))

    def table(self, spark: SparkSession) -> DataFrame:
        """One row, a column per name; waits for tables no job has read yet."""
        found = {name: int(o.get[name] or 0) for name, o in self._seen.items()}
        return spark.createDataFrame([tuple(found.values())], ", ".join(f"{name} bigint" for name in found))


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the folder that spark.checkpoint.dir names; where it is unset and driver
    and executors are one machine, as in tests, in a local folder of this application; on a
    cluster an error. Long chains of rules plan slowly in one piece, and a lost executor
    would repeat them all."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="marlstone-"))
    return df.checkpoint()
