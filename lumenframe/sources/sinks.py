"""Sinks: wide CSV, appended JSON lines, retention lists, metric text."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared(spark: SparkSession, what: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``), under one folder an application, so
    that all it wrote can be removed when its results have been read.

    Where the session has no such setting, a temporary folder serves on one machine; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: it names the folder that the driver and the executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lumenframe-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/lumenframe-{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it again: lineage is cut, and lost executors cost nothing."""
    path = shared(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def wide_csv(df: DataFrame, keys: list[str], path: str) -> None:
    """Keys first, the other columns sorted by name, nulls as empty fields."""
    rest = sorted(set(df.columns) - set(keys))
    df.select(*keys, *rest).write.option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def append_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def beyond_last(files: DataFrame, keys: list[str], keep: int, modified: str = "modified", path: str = "path") -> DataFrame:
    """The files to delete when each key keeps its ``keep`` newest."""
    w = Window.partitionBy(*keys).orderBy(F.desc(modified), F.desc(path))
    return files.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") > keep).drop("_n")


def metric_line(name: str, labels: list[str], value: str) -> Column:
    """``name{label="..."} value`` lines of a metrics page."""
    parts = F.concat_ws(",", *(F.concat(F.lit(f'{x}="'), F.col(x).cast("string"), F.lit('"')) for x in labels))
    return F.concat(F.lit(name + "{"), parts, F.lit("} "), F.col(value).cast("string"))
