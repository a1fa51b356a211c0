"""Feature rows: long tables of (keys, feature, value), and the wide training table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import finite


def status_code(c: str) -> Column:
    """1 for ok, 0 for empty, -1 for anything else."""
    return F.when(F.col(c) == "ok", 1.0).when(F.col(c) == "empty", 0.0).otherwise(-1.0)


def long_features(df: DataFrame, keys: list[str], values: list[str], prefix: str) -> DataFrame:
    """One row per key and feature; values that are not finite are left out."""
    cols = ", ".join(f"'{prefix}__{v}', cast({v} as double)" for v in values)
    out = df.selectExpr(*keys, f"stack({len(values)}, {cols}) as (feature, value)")
    return out.withColumn("value", finite(F.col("value"))).filter("value is not null")


def training_table(features: DataFrame, keys: list[str], registry: list[str]) -> DataFrame:
    """Keys first, then the registry's features in order; a missing one is null, of a repeated one the greatest value is taken.

    The registry saves a pass for the names.
    """
    return features.groupBy(*keys).pivot("feature", sorted(registry)).agg(F.max("value"))


def rolled_wide(df: DataFrame, keys: list[str], by: str, kinds: list[str], made: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """keys and a column kind__name for each kind of ``by`` and each aggregate, which is made of the test for its rows: one
    shuffle of partial aggregates, no long table and no pivot."""
    return df.groupBy(*keys).agg(*(f(F.col(by) == kind).alias(f"{kind}__{name}") for kind in kinds for name, f in made.items()))
