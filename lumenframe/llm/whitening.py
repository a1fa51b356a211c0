"""Whitening of embeddings by exact covariances: cross-products of whole numbers are counted on bit planes.

1. Each entry becomes a whole number; the fit list holds each distinct vector once (equal rows meet before the shuffle).
2. Each dimension is shifted by its least value, and each bit of it becomes a plane: one bit a row, 64 rows a word.
3. A task counts the common bits of each two planes (AND and popcount), weighs them by the bits' places and adds them up; the
   sums of tasks meet in Spark as decimals. So sums and cross-products are exact, whatever the number of rows or their order.
4. The driver gets one number a pair of dimensions. n * xy - x * y is formed in whole numbers, and only the result is rounded,
   divided by n * n and given to the eigensolver.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Steps of a unit; rows whose planes are held at once; components that are given out.
SCALE, ROWS, COMPONENTS = 256, 1 << 14, 4
#: Bits of one limb of a sum, so that a task's part of it fits 64 bits.
LIMB = 24
#: A component with less than this share of the greatest variance has none.
NO_VARIANCE = 1e-13


@dataclass(frozen=True)
class Fit:
    """n vectors, their sums, eigenvalues and eigenvectors (columns) by falling eigenvalue, and the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def matrix(column: pa.Array, kind=np.int64) -> np.ndarray:
    """A list column without nulls, of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def whole(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * entry) of each entry; null where the vector is null or empty or an entry is null, not finite or beyond 64 bits."""
    x = F.transform(F.col(vector), lambda c: c.cast("double") * scale)
    fine = F.forall(x, lambda c: F.coalesce((c >= -(2.0**63)) & (c < 2.0**63), F.lit(False)))
    return F.when(fine & (F.size(vector) > 0), F.transform(x, lambda c: F.floor(c).cast("long")))


def usual_length(rows: DataFrame) -> int | None:
    """The length that most rows have (ties: the greatest)."""
    found = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else None


def planes(y: np.ndarray, bits: list[int]) -> np.ndarray:
    """One row a (dimension, bit): the bit of each row of ``y``, 64 rows a word."""
    out = np.zeros((sum(bits), -(-len(y) // 64) * 8), np.uint8)
    at = 0
    for d, width in enumerate(bits):
        for b in range(width):
            own = np.packbits((y[:, d] >> np.uint64(b)).astype(np.uint8) & 1)
            out[at, : len(own)] = own
            at += 1
    return out.view(np.uint64)


def common_bits(p: np.ndarray) -> np.ndarray:
    """Rows that have both bits, for each two planes (upper triangle)."""
    out = np.zeros((len(p), len(p)), np.int64)
    for i in range(len(p)):
        out[i, i:] = np.bitwise_count(p[i:] & p[i]).sum(axis=1, dtype=np.int64)
    return out


def cross_products(fit: DataFrame, least: list[int], bits: list[int]) -> list[list[int]]:
    """Exact sums of y[d] * y[e] over the fit list, where y is x shifted by its dimension's least value."""
    dims, low = len(bits), np.array(least, np.int64)
    of_dim, place = np.repeat(np.arange(dims), bits), np.concatenate([np.arange(b) for b in bits] or [[]]).astype(int)

    def run(batches):
        counts, held, rows = np.zeros((sum(bits), sum(bits)), np.int64), [], 0
        for batch in batches:
            held.append(matrix(batch["x"]) - low)
            rows += batch.num_rows
            if rows >= ROWS:
                counts += common_bits(planes(np.concatenate(held).view(np.uint64), bits))
                held, rows = [], 0
        if rows:
            counts += common_bits(planes(np.concatenate(held).view(np.uint64), bits))
        p, q = np.nonzero(counts)
        n, d, e, weight = counts[p, q], of_dim[p], of_dim[q], place[p] + place[q]
        n = np.where((d == e) & (p != q), 2 * n, n)
        key, value = (d * dims + e) * 8 + weight // LIMB, n << (weight % LIMB)
        cells, where = np.unique(key, return_inverse=True)
        total = np.zeros(len(cells), np.int64)
        np.add.at(total, where, value)
        yield pa.RecordBatch.from_arrays([pa.array(cells // 8 // dims, pa.int32()), pa.array(cells // 8 % dims, pa.int32()), pa.array(cells % 8, pa.int32()), pa.array(total)], names=["d", "e", "limb", "part"])

    parts = fit.select("x").mapInArrow(run, "d int, e int, limb int, part long").groupBy("d", "e", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    out = [[0] * dims for _ in range(dims)]
    for r in parts.collect():
        out[r["d"]][r["e"]] += int(r["part"]) << (LIMB * r["limb"])
    for d in range(dims):
        for e in range(d):
            out[d][e] = out[e][d]
    return out


def fitted(fit: DataFrame, dims: int) -> Fit:
    """The eigenvectors of the exact covariance of the fit list (x array<long>, one length)."""
    at = lambda f, kind=None: F.array(*(f(F.get("x", F.lit(d)) if kind is None else F.get("x", F.lit(d)).cast(kind)) for d in range(dims)))
    r = fit.agg(F.count("*").alias("n"), at(F.min).alias("least"), at(F.max).alias("most"), at(F.sum, "decimal(38,0)").alias("sums")).first()
    n, least, sums = r["n"], list(r["least"]), [int(s) for s in r["sums"]]
    bits = [int(hi - lo).bit_length() for lo, hi in zip(least, r["most"], strict=True)]
    products = cross_products(fit, least, bits)
    shifted = [s - n * lo for s, lo in zip(sums, least, strict=True)]
    centred = [[n * products[d][e] - shifted[d] * shifted[e] for e in range(dims)] for d in range(dims)]
    v = np.array([[float(Fraction(c, n * n)) for c in row] for row in centred])
    values, vectors = np.linalg.eigh(v)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    # Of the two signs, the one whose largest entry is positive.
    sign = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(dims)])
    return Fit(n, sums, values, vectors * np.where(sign == 0, 1, sign), float(Fraction(sum(centred[d][d] for d in range(dims)), n * n)))


def projected(rows: DataFrame, fit: Fit, components: int) -> DataFrame:
    """The rows with deviation (decimal, exact) and whitened (array<double>, null entries for components without variance)."""
    dims = len(fit.sums)
    sums, limit = np.array(fit.sums, object), 2**62
    live = fit.values[:components] > NO_VARIANCE * max(fit.values[0], 1e-300)
    scale = np.where(live, 1 / np.sqrt(np.where(live, fit.values[:components], 1)), np.nan)
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]

    def work(batch):
        x = matrix(batch["x"])
        reach = fit.n * max(abs(int(x.min())), abs(int(x.max()))) + max(abs(s) for s in fit.sums)
        # Whole numbers of 64 bits where all of this fits them, else Python's.
        gap = fit.n * x - sums.astype(np.int64) if reach < limit else fit.n * x.astype(object) - sums
        far = np.abs(gap).max() if len(gap) else 0
        deviation = ((gap * gap) if int(far) ** 2 * dims < limit else gap.astype(object) ** 2).sum(axis=1)
        white = (gap.astype(np.float64) / fit.n) @ fit.vectors[:, :components] * scale
        flat = pa.array(white.ravel(), pa.float64(), mask=np.isnan(white.ravel()))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * components), flat)
        return {k: batch[k] for k in batch.schema.names} | {"deviation": pa.array([str(v) for v in deviation.tolist()]), "whitened": lists}

    out = common.mapped(rows, ", ".join([*own, "deviation string, whitened array<double>"]), work)
    return out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def identity_error(fit_list: DataFrame, fit: Fit, components: int) -> float | None:
    """Largest absolute entry of the covariance of the fit list's whitened vectors minus the identity; components without
    variance are left out, null if there is none. Spark's covariance centres as it adds."""
    live = [k for k in range(components) if fit.values[k] > NO_VARIANCE * max(fit.values[0], 1e-300)]
    if not live:
        return None
    white = projected(fit_list.select("x"), fit, components).select(*(F.get("whitened", F.lit(k)).alias(f"w{k}") for k in live))
    cells = {(a, b): F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a in live for b in live if a <= b}
    got = white.agg(*cells.values()).first()
    return max(abs(got[f"c{a}_{b}"] - (a == b)) for a, b in cells)


def whiten(df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of every usable row.

    Each entry c counts as floor(scale * c). Rows are left out whose vector is null, empty, holds null or non-finite entries or
    entries beyond 64 bits, or has another length than most rows (ties: the greatest length). Equal vectors count once in the
    fit, and repeated rows and rows without an id are given out like all others. A vector of d entries has d components at
    most. deviation (decimal) is the exact sum of (n * x - sum) ** 2, null beyond 38 digits; whitened is null where a component
    has no variance, explained where no component has. No usable row: no rows. Other columns are not read.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), whole(vector, scale).alias("x")).filter("x is not null")
    rows = common.stored(rows, "whole")
    dims = usual_length(rows)
    empty = df.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    if dims is None:
        return empty
    components = min(components, dims)
    rows = rows.filter(F.size("x") == dims)
    fit_list = common.stored(rows.select("x").distinct(), "fit_list")
    fit = fitted(fit_list, dims)
    error = identity_error(fit_list, fit, components)
    shares = F.array(*(F.lit(float(v / fit.trace) if fit.trace else None).cast("double") for v in fit.values[:components]))
    out = projected(rows, fit, components).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return out.select("vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("k")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``whiten``; a deviation beyond 64 bits is null."""
    return whiten(common.table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as long)"))
