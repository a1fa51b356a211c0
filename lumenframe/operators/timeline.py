"""Operators on rows along a time axis: lags, windows, runs, sessions, bursts, as-of and band joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .series import leaps


def seconds(c: str = "ts") -> Column:
    return F.unix_micros(c) / F.lit(1e6)


def rates(df: DataFrame, key: str, order: list[str], value: str, least: float = 1e-3) -> DataFrame:
    """Difference to the row before and its rate per second, the time step being ``least`` at least; a key's first row goes."""
    w = Window.partitionBy(key).orderBy(*order)
    # The step is taken in whole microseconds: seconds since 1970 as doubles are a quarter of one apart.
    step = (F.unix_micros("ts") - F.lag(F.unix_micros("ts")).over(w)) / F.lit(1e6)
    out = df.withColumn("diff", F.col(value) - F.lag(value).over(w)).withColumn("dt", step)
    return out.filter("diff is not null").withColumn("rate", F.col("diff") / F.greatest("dt", F.lit(least)))


def runs(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Runs of equal values along the order: key, run, value, first and last time, rows."""
    w = Window.partitionBy(key).orderBy(*order)
    change = F.when(F.col(value) == F.lag(value).over(w), 0).otherwise(1)
    return df.withColumn("_c", change).withColumn("run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(key, "run").agg(F.first(value).alias(value), F.min("ts").alias("start"), F.max("ts").alias("end"), F.count("*").alias("n"))


def sessions(df: DataFrame, key: str, order: list[str], gap: float) -> DataFrame:
    """Session numbers per key: a row more than ``gap`` seconds after the one before begins a new one."""
    w = Window.partitionBy(key).orderBy(*order)
    late = F.when((F.unix_micros("ts") - F.lag(F.unix_micros("ts")).over(w)) / F.lit(1e6) <= gap, 0).otherwise(1)
    return df.withColumn("_l", late).withColumn("session", F.sum("_l").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_l")


def spaced(df: DataFrame, key: str, gap: float) -> DataFrame:
    """Times more than ``gap`` seconds after the last kept one of their key, the first being kept."""
    kept = leaps(df.withColumn("_t", F.unix_micros("ts")), key, "_t", int(gap * 1_000_000) + 1)
    return kept.select(key, F.timestamp_micros("t").alias("ts"))


def as_of(left: DataFrame, right: DataFrame, key: str, order: str, value: str, name: str) -> DataFrame:
    """Each left row with the latest right ``value`` at or before it: one union and one window, no range join."""
    both = left.select(key, order, F.lit(1).alias("_s"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(right.schema[value].dataType).alias(name))
    rights = right.select(key, order, F.lit(0).alias("_s"), F.lit(None).cast(both.schema["_row"].dataType).alias("_row"), F.col(value).alias(name))
    w = Window.partitionBy(key).orderBy(order, "_s").rowsBetween(Window.unboundedPreceding, 0)
    return both.union(rights).withColumn(name, F.last(name, ignorenulls=True).over(w)).filter("_s = 1").select("_row.*", name)


def near(left: DataFrame, right: DataFrame, key: str, within: int) -> DataFrame:
    """Left rows that have a right row of the same key within ``within`` seconds: times are cut into cells of that length,
    each right row goes to its own and both neighbouring cells, and an equality join on key and cell is checked exactly."""
    cell = F.floor(seconds() / within)
    cells = right.select(F.col(key).alias("_k"), F.col("ts").alias("_t"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("_c"))
    return left.withColumn("_cell", cell).join(cells, (F.col(key) == F.col("_k")) & (F.col("_cell") == F.col("_c")) & (F.abs(F.unix_micros("ts") - F.unix_micros("_t")) <= within * 1_000_000), "left_semi").drop("_cell")


def latest(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """The last row of each key by order: the state that an append-only journal leaves; sums up before the shuffle."""
    return df.groupBy(*keys).agg(F.max(F.struct(*order, *values)).alias("_x")).select(*keys, *(f"_x.{c}" for c in [*order, *values]))


def within(points: DataFrame, spans: DataFrame, key: str, point: str, start: str, end: str, cell: float, pad: float = 0.0) -> DataFrame:
    """Pairs of points and spans of the same key where the point is in [start - pad, end + pad].

    Times are cut into cells; a span goes to each cell it touches, a point to its own, so the join is one of equality that
    is checked exactly, and a long span costs its length in cells.
    """
    cells = spans.withColumn("_cell", F.explode(F.sequence(F.floor((F.col(start) - pad) / cell), F.floor((F.col(end) + pad) / cell))))
    met = points.withColumn("_cell", F.floor(F.col(point) / cell)).join(cells, [key, "_cell"])
    return met.filter((F.col(point) >= F.col(start) - pad) & (F.col(point) <= F.col(end) + pad)).drop("_cell")
