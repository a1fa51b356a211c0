"""Sequences of a key brought to a stated length: long ones keep their key rows and even steps of the rest, short ones repeat key
rows and take values between neighbours. Runs of rows that stand out from their surroundings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import spread


def placed(df: DataFrame, key: str, order: list[str], score: str) -> DataFrame:
    """The rows with _i (place from 0), _n (rows of the key) and _rank (from 0, of rows with a score: the best first)."""
    w, best = Window.partitionBy(key), Window.partitionBy(key, F.col(score).isNull()).orderBy(F.desc(score), *order)
    rows = spread(df, [key]).withColumns({"_i": F.row_number().over(w.orderBy(*order)) - 1, "_n": F.count(F.lit(1)).over(w), "_keys": F.count(score).over(w)})
    return rows.withColumn("_rank", F.when(F.col(score).isNotNull(), F.row_number().over(best) - 1))


def compressed(df: DataFrame, key: str, order: list[str], score: str, target: int) -> DataFrame:
    """The rows that stay when a key has ``target`` at most: half of them the rows with the best scores, the rest every so-many-th of the
    others. A row without a score is no key row. The columns are those of ``df`` and ``place``, the row's place before."""
    rows = placed(df, key, order, score)
    taken = F.least(F.col("_keys"), F.lit(target // 2))
    rows = rows.withColumn("_key", F.coalesce(F.col("_rank") < target // 2, F.lit(False)))
    left = F.lit(target) - taken
    step = F.greatest(F.lit(1), F.floor((F.col("_n") - taken) / left)).cast("long")
    rows = rows.withColumn("_j", F.row_number().over(Window.partitionBy(key, "_key").orderBy("_i")) - 1)
    even = (left > 0) & (F.col("_j") % step == 0) & (F.floor(F.col("_j") / step) < left)
    return rows.filter(F.col("_key") | even).select(*df.columns, F.col("_i").cast("long").alias("place"))


def expanded(df: DataFrame, key: str, order: list[str], score: str, value: str, target: int) -> DataFrame:
    """key, place, source, kind, value: a key's rows, then two copies each of its best rows (a third of ``target`` rows at most), then
    values between its rows at even steps (source -1), until there are ``target``. Longer keys keep all rows. Copies are
    exact. A key of one row has nothing between."""
    rows = placed(df, key, order, score)
    copies = F.least(F.greatest(F.lit(target) - F.col("_n"), F.lit(0)), 2 * F.least(F.col("_keys"), F.lit(target // 3)))
    rows = rows.withColumn("_copies", copies).withColumn("_next", F.lead(value).over(Window.partitionBy(key).orderBy("_i")))
    own = rows.select(key, F.col("_i").alias("place"), F.col("_i").alias("source"), F.lit("row").alias("kind"), F.col(value).alias("value"))
    again = rows.filter("_rank is not null").select(key, "_n", "_i", "_copies", value, F.explode(F.array(*(2 * F.col("_rank") + d for d in (0, 1)))).alias("_d")).filter("_d < _copies")
    again = again.select(key, (F.col("_n") + F.col("_d")).alias("place"), F.col("_i").alias("source"), F.lit("copy").alias("kind"), F.col(value).alias("value"))
    # Place i of N even ones lies at i * (n - 1) / (N - 1); each row gives those between itself and the next row.
    need = F.greatest(F.lit(target) - F.col("_n") - F.col("_copies"), F.lit(0))
    between = rows.withColumn("_need", need).filter("_need > 0 and _n > 1 and _i < _n - 1").withColumn("_all", F.col("_n") + F.col("_need") - 1)
    between = between.withColumn("_p", F.explode(F.sequence(F.floor(F.col("_i") * F.col("_all") / (F.col("_n") - 1)), F.ceil((F.col("_i") + 1) * F.col("_all") / (F.col("_n") - 1)))))
    inside = (F.col("_p") * (F.col("_n") - 1) > F.col("_i") * F.col("_all")) & (F.col("_p") * (F.col("_n") - 1) < (F.col("_i") + 1) * F.col("_all"))
    between = between.filter(inside).withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy("_p")) - 1).filter("_k < _need")
    part = F.col("_p") * (F.col("_n") - 1) / F.col("_all") - F.col("_i")
    between = between.select(key, (F.col("_n") + F.col("_copies") + F.col("_k")).alias("place"), F.lit(-1).alias("source"), F.lit("between").alias("kind"), (F.col(value) + (F.col("_next") - F.col(value)) * part).alias("value"))
    return own.union(again).union(between)


def standing_out(df: DataFrame, key: str, order: list[str], value: str, window: int, bar: float) -> DataFrame:
    """key, place, z, change: runs of rows over ``bar`` deviations from the mean of the ``window`` rows around them, none more than
    ``window`` places from the one before; of a run its middle place (the whole part of the mean), the distance in deviations
    there, and how far its value is from the key's mean. A level window counts as a deviation of 1e-10; keys of fewer than
    two windows have none."""
    w, whole = Window.partitionBy(key).orderBy(*order), Window.partitionBy(key)
    around = w.rowsBetween(-(window // 2), window - 1 - window // 2)
    std: Column = F.stddev_samp(value).over(around)
    rows = df.withColumns({"_i": F.row_number().over(w) - 1, "_m": F.avg(value).over(around), "_s": F.when(std == 0, 1e-10).otherwise(std), "_mean": F.avg(value).over(whole), "_n": F.count(F.lit(1)).over(whole)})
    rows = rows.filter(F.col("_n") >= 2 * window).select(key, "_i", F.col(value).alias("_v"), "_mean", (F.abs(F.col(value) - F.col("_m")) / F.col("_s")).alias("_z"))
    odd = rows.filter(F.col("_z") > bar)
    at = Window.partitionBy(key).orderBy("_i")
    odd = odd.withColumn("_new", F.when(F.col("_i") - F.lag("_i").over(at) <= window, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(at))
    middle = odd.groupBy(key, "_run").agg(F.floor(F.avg("_i")).cast("int").alias("_i"))
    return middle.join(rows, [key, "_i"]).select(key, F.col("_i").cast("long").alias("place"), F.col("_z").alias("z"), (F.col("_v") - F.col("_mean")).alias("change"))
