"""Exact quantiles, linear between neighbours, without a group's values in memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Accuracy of the sketch that bounds the wanted places, and the share of a group's values that is kept on either side of them,
#: well beyond what the sketch may be off; groups of fewer than SMALL values are kept whole.
ACCURACY, MARGIN, SMALL = 10_000, 0.002, 1_000


def ranked(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The rows with ``_k``, the place of the value among its key's, from 0, and ``_n``, their number: for keys whose rows one
    task can sort, which spills. Nulls have no place."""
    some = Window.partitionBy(*keys)
    return df.withColumn("_n", F.count(value).over(some)).withColumn("_k", F.when(F.col(value).isNotNull(), F.row_number().over(some.orderBy(F.col(value).asc_nulls_last())) - 1))


def between(low: Column, high: Column, rest: Column, part: Column) -> Column:
    """low * rest + high * part, where the first product is not rounded before the sum, as a fused multiply-add has it: a place
    between equal values has their value, where rounded products would put the quantile beside values that are compared with it."""
    one, two = low * rest, high * part
    (a, b), (c, d) = ((x.cast("float").cast("double"), x - x.cast("float").cast("double")) for x in (low, rest))
    whole = one + two
    back = whole - one
    lost = (((a * c - one) + a * d + b * c) + b * d) + ((one - (whole - back)) + (two - back))
    # Values beyond a float's range have no halves.
    return F.when(low == high, low).otherwise(F.nanvl(whole + lost, whole))


def at(value: str, q: float, over: WindowSpec | None = None) -> Column:
    """The quantile of ranked rows, as an aggregate or over their window."""
    place, x = (F.col("_n") - 1) * F.lit(q), F.col(value).cast("double")
    low = F.floor(place)
    made = [F.max(F.when(F.col("_k") == low, x)), F.max(F.when(F.col("_k") == F.ceil(place), x)), F.max(1 - (place - low)), F.max(place - low)]
    return between(*(made if over is None else [c.over(over) for c in made]))


def grouped(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """keys and a column for each wanted quantile, for few keys with any number of rows.

    One pass makes a sketch of fixed size, which says between which values each wanted place surely lies; another counts the
    values below and keeps those between, equal ones as a count, before anything is moved. Only these are ranked. That they hold
    the wanted places is checked; if they did not, the query would fail.
    """
    df = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    shares = [min(1.0, max(0.0, q + side)) for q in wanted.values() for side in (-MARGIN, MARGIN)]
    bounds = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.percentile_approx("_v", shares, ACCURACY).alias("_b"))
    kept = []
    for i, (k, q) in enumerate(wanted.items()):
        low, high = F.get("_b", F.lit(2 * i)), F.get("_b", F.lit(2 * i + 1))
        below = (F.col("_n") >= SMALL) & F.lit(q > MARGIN) & (F.col("_v") < low)
        above = (F.col("_n") >= SMALL) & F.lit(q < 1 - MARGIN) & (F.col("_v") > high)
        kept.append(F.when(below, F.struct(F.lit(k).alias("name"), F.lit(None).cast("double").alias("v"))).when(~above, F.struct(F.lit(k).alias("name"), F.col("_v").alias("v"))))
    rows = df.join(bounds, keys).select(*keys, "_n", F.explode(F.array_compact(F.array(*kept))).alias("_x")).groupBy(*keys, "_n", "_x").agg(F.count("*").alias("_c")).select(*keys, "_n", "_x.name", "_x.v", "_c")
    upto = F.sum("_c").over(Window.partitionBy(*keys, "name").orderBy(F.col("v").asc_nulls_first()))
    rows = rows.withColumn("_to", upto).filter("v is not null")
    place = (F.col("_n") - 1) * F.create_map(*(F.lit(x) for k, q in wanted.items() for x in (k, float(q))))[F.col("name")]
    weight = lambda at, w: F.when((at >= F.col("_to") - F.col("_c")) & (at < F.col("_to")), w).otherwise(0.0)
    rows = rows.withColumn("_p", place).withColumn("_w", weight(F.floor("_p"), 1 - (F.col("_p") - F.floor("_p"))) + weight(F.floor("_p") + 1, F.col("_p") - F.floor("_p"))).filter("_w > 0")

    def found(k: str) -> Column:
        own = F.col("name") == k
        part = F.max(F.when(own, F.col("_p") - F.floor("_p")))
        value = between(F.min(F.when(own, F.col("v"))), F.max(F.when(own, F.col("v"))), 1 - part, part)
        return F.when(F.abs(F.sum(F.when(own, F.col("_w"))) - 1) < 1e-6, value).otherwise(F.raise_error(F.lit(f"the sketch does not bound the place of {k}")).cast("double"))

    return rows.groupBy(*keys).agg(*(found(k).alias(k) for k in wanted))


def beside(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """The rows with the wanted quantiles of their key beside them, by the sorted window of ``ranked``."""
    w = Window.partitionBy(*keys)
    return ranked(df, keys, value).withColumns({k: at(value, q, w) for k, q in wanted.items()}).drop("_k", "_n")
