"""Flat numeric features of nested payloads: the schema says which expressions, so a row is flattened without code per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from ..functions.stats import finite

ARRAY_STATS = ("mean", "std", "min", "max", "p50", "p90", "count")


def numeric(kind: S.DataType) -> bool:
    return isinstance(kind, (S.NumericType, S.BooleanType))


def scalar(c: Column) -> Column:
    """A number or truth value as a finite double, else null."""
    return finite(c.cast("double"))


def total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def percentile_of(ordered: Column, q: float) -> Column:
    """Percentile of a sorted array, linear between neighbours."""
    at = (F.size(ordered) - 1) * F.lit(q)
    low = F.get(ordered, F.floor(at).cast("int"))
    return low + (F.get(ordered, F.ceil(at).cast("int")) - low) * (at - F.floor(at))


def pairs_of(features: list[tuple[str, Column]]) -> Column:
    return F.array(*(F.struct(F.lit(k).alias("feature"), v.cast("double").alias("value")) for k, v in features))


def array_summary(name: str, c: Column, kind: S.DataType) -> Column:
    """What a numeric array gives, as pairs (feature, value): __empty, the mean of truth values, __all_non_finite, or seven statistics
    of its finite values. What several of them need is a variable of a transform over one element, so it is found once."""
    empty = (f"{name}__empty", F.when(F.size(c) == 0, 1.0))
    if isinstance(kind, S.BooleanType):
        return pairs_of([empty, (f"{name}__mean", F.when(F.size(c) > 0, F.aggregate(c, F.lit(0.0), lambda a, x: a + F.coalesce(x.cast("double"), F.lit(0.0))) / F.size(c)))])

    def figures(xs: Column, mean: Column) -> Column:
        deviation = F.sqrt(F.aggregate(xs, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / F.size(xs))
        own = {"mean": mean, "std": deviation, "min": F.get(xs, F.lit(0)), "max": F.get(xs, F.size(xs) - 1), "p50": percentile_of(xs, 0.5), "p90": percentile_of(xs, 0.9), "count": F.size(xs)}
        return pairs_of([empty, (f"{name}__all_non_finite", F.when((F.size(c) > 0) & (F.size(xs) == 0), 1.0)), *((f"{name}__{k}", F.when(F.size(xs) > 0, own[k])) for k in ARRAY_STATS)])

    finite_values = F.array_sort(F.filter(F.transform(c, lambda x: scalar(x)), lambda x: x.isNotNull()))
    one = lambda x, then: F.get(F.transform(F.array(x), then), F.lit(0))
    return F.coalesce(one(finite_values, lambda xs: one(F.when(F.size(xs) > 0, total(xs) / F.size(xs)), lambda mean: figures(xs, mean))), pairs_of([empty]))


def one_level(payload: str, kind: S.StructType, prefix: str) -> list[tuple[str, Column] | Column]:
    """prefix__field of numbers, truth values and numeric arrays (as pairs); strings and nested fields are left out."""
    out = []
    for f in kind.fields:
        c, name = F.col(payload)[f.name], f"{prefix}__{f.name}"
        if numeric(f.dataType):
            out.append((name, scalar(c)))
        elif isinstance(f.dataType, S.ArrayType) and numeric(f.dataType.elementType):
            out.append(array_summary(name, c, f.dataType.elementType))
    return out


def leaves(c: Column, kind: S.StructType, path: str = "", lists: bool = False) -> list[tuple[str, Column]]:
    """Dotted names of numbers and truth values at any depth; with ``lists``, of the means of numeric lists too."""
    out = []
    for f in kind.fields:
        name, own = f"{path}.{f.name}" if path else f.name, c[f.name]
        if isinstance(f.dataType, S.StructType):
            out += leaves(own, f.dataType, name, lists)
        elif numeric(f.dataType):
            out.append((name, scalar(own)))
        elif lists and isinstance(f.dataType, S.ArrayType) and numeric(f.dataType.elementType):
            out.append((name, F.when(F.size(own) > 0, scalar(total(F.transform(own, lambda x: x.cast("double"))) / F.size(own)))))
    return out


def long_rows(df: DataFrame, keys: list[str], features: list[tuple[str, Column] | Column]) -> DataFrame:
    """A row (keys, feature, value) for each feature that has a value; features are named columns or arrays of pairs."""
    single = [x for x in features if isinstance(x, tuple)]
    pairs = F.concat(*([pairs_of(single)] if single else []), *(x for x in features if not isinstance(x, tuple)))
    return df.select(*keys, F.inline(pairs)).filter("value is not null")


def artifact_features(df: DataFrame, keys: list[str], skip: tuple[str, ...] = ("meta", "embedding", "embeddings", "ocr_raw", "ocr_unique_elements")) -> DataFrame:
    """Features of artifacts (names, values, features map, arrays map), by precedence.

    An artifact with names and values gives those pairs alone; another gives its features map and the summaries of its
    arrays, but for those in ``skip``. Names are prefixed with the component.
    """
    own = F.col("names").isNotNull() & F.col("values").isNotNull()
    name = lambda k: F.concat_ws("__", F.col("component"), k)
    paired = df.filter(own).select(*keys, F.inline(F.transform(F.arrays_zip(F.col("names").alias("k"), F.col("values").alias("v")), lambda x: F.struct(name(x["k"]).alias("feature"), x["v"].cast("double").alias("value")))))
    rest = df.filter(~own)
    mapped = rest.select(*keys, "component", F.explode("features").alias("k", "v")).select(*keys, name(F.col("k")).alias("feature"), F.col("v").cast("double").alias("value"))
    arrays = rest.select(*keys, "component", F.explode("arrays").alias("k", "xs")).filter(~F.col("k").isin(*skip))
    stats = array_summary("x", F.col("xs"), S.DoubleType())
    summed = long_rows(arrays, [*keys, "component", "k"], [stats]).select(*keys, F.concat(name(F.col("k")), F.expr("substring(feature, 2)")).alias("feature"), "value")
    return paired.union(mapped).union(summed).withColumn("value", finite(F.col("value"))).filter("value is not null")


def first_artifact(artifacts: Column, ending: str) -> Column:
    """The first of a list of artifacts (structs with a path) whose path has the ending, in any case."""
    return F.get(F.filter(artifacts, lambda a: F.lower(a["path"]).endswith(ending)), F.lit(0))


def resampled(df: DataFrame, key: str, order: list[str], value: str, length: int) -> DataFrame:
    """key, i, value: the ordered values of a key at ``length`` even places from the first to the last, linear between rows.

    Each row gives the places from itself to the next row, so no grid is joined.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(*order)
    rows = df.select(key, F.col(value).alias("_v"), F.lead(value).over(w).alias("_next"), (F.row_number().over(w) - 1).alias("_k"), F.count("*").over(Window.partitionBy(key)).alias("_n"))
    scale = F.lit(length - 1)
    first = F.when(F.col("_n") == 1, 0).otherwise(F.ceil(F.col("_k") * scale / (F.col("_n") - 1))).cast("long")
    last = F.when(F.col("_n") == 1, scale).when(F.col("_k") == F.col("_n") - 1, scale).otherwise(F.ceil((F.col("_k") + 1) * scale / (F.col("_n") - 1)) - 1).cast("long")
    rows = rows.withColumn("_a", first).withColumn("_b", last).filter("_a <= _b").withColumn("i", F.explode(F.sequence("_a", "_b")))
    part = F.col("i") * (F.col("_n") - 1) / scale - F.col("_k")
    return rows.select(key, "i", (F.col("_v") + F.when(F.col("_next").isNotNull(), (F.col("_next") - F.col("_v")) * part).otherwise(0.0)).alias(value))
