"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks

#: What one Arrow batch may hold; a batch of very long texts stays small.
BATCH_ROWS, BATCH_BYTES = 2000, 2 << 20


def tuned(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that go to Python workers by rows and, where this Spark has the setting, by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


shared_dir = sinks.shared


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it again: lineage is cut and lost executors cost nothing."""
    path = shared_dir(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_join(big: DataFrame, small: DataFrame, key: str, salt: str, counts: DataFrame, total: int | None = None) -> DataFrame:
    """Inner join of ``big`` with ``small``, which has one row a key, where a key may hold any share of the rows of ``big``.

    ``counts`` has a key's number of rows of ``big`` (key, rows), ``total`` their sum if it is known. A key with more than a
    quarter of a task's even share is dealt by ``salt`` to as many pieces; there are no more than 4 such keys a task (8 where
    ``total`` is half the sum), so their table is small whatever the data, and is sent to the tasks.
    """
    spark = big.sparkSession
    total = counts.agg(F.sum("rows")).first()[0] or 0 if total is None else total
    share = max(1, total // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    hot = F.broadcast(counts.filter(F.col("rows") > share).select(key, F.ceil(F.col("rows") / share).cast("int").alias("pieces")))
    pieces = F.coalesce("pieces", F.lit(1))
    big = big.join(hot, key, "left").withColumn("salt", F.pmod(F.xxhash64(salt), pieces).cast("int")).drop("pieces")
    small = small.join(hot, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("pieces")
    return big.join(small, [key, "salt"]).drop("salt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(col: str, mod: int) -> Column:
    """crc32 of an id's text, modulo ``mod``; the fold that learners use. A null id counts as bucket 0."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % mod, F.lit(0))


def crc(ids) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def texts(column: pa.Array) -> list[str]:
    """A string column as Python strings, null as empty."""
    return [x if x is not None else "" for x in column.to_pylist()]


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Numpy vectors as one Arrow list column."""
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(kind.to_pandas_dtype(), copy=False), kind))


def mapped(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], dict | None]) -> DataFrame:
    """Apply a batch function; it returns the columns of ``schema`` as Arrow arrays or lists."""
    spark = df.sparkSession
    kinds = arrow_schema(spark, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := work(batch)) is not None:
                yield batch_of(out, kinds)

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema), prefers_large_types=False)


def batch_of(columns: dict, kinds: pa.Schema) -> pa.RecordBatch:
    arrays = [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in kinds]
    return pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, kinds, strict=True)], schema=kinds)


def summed(df: DataFrame, width: int, work: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Sum of a vector of fixed ``width`` that ``work`` makes of each batch.

    Each task sums its own batches and sends the cells that are not 0; the driver gets ``width`` numbers at most.
    """

    def run(batches):
        total = np.zeros(width, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += work(batch)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["cell", "n"])

    cells = df.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(width, np.int64)
    out[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return out
