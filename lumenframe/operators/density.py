"""Density clusters (DBSCAN) of each key's vectors, without all pairs and without a key's vectors in one task."""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import stored
from .ranges import BLOCK, components, dealt, joined, parts

#: Dimensions that a grid is laid over. Vectors that are close are close in these too, so cells lose no neighbour.
GRID = 3


def standardized(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """The values less their key's mean over its deviation (1 where there is none), as a vector x; nulls make no vector."""
    stats = df.groupBy(key).agg(*(f(c).alias(f"_{n}{i}") for i, c in enumerate(values) for n, f in (("m", F.avg), ("s", F.stddev_pop))))
    parts = [(F.col(c) - F.col(f"_m{i}")) / F.when(F.col(f"_s{i}") > 0, F.col(f"_s{i}")).otherwise(1.0) for i, c in enumerate(values)]
    x = F.when(F.greatest(*(F.col(c).isNull().cast("int") for c in [values[0], *values])) == 0, F.array(*parts))
    return df.join(stats.hint("merge"), key).withColumn("x", x).select(*df.columns, "x")


def cells_of(points: DataFrame, eps: float) -> DataFrame:
    """node, key, x of each point in its grid cell, and as a visitor in the later neighbouring cells that it can reach into. Points that
    are not ``large`` share their key's one cell."""

    def work(batches):
        for batch in filter(len, batches):
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            g = x[:, :GRID]
            large = batch["large"].to_numpy(zero_copy_only=False)
            home = np.where(large[:, None], np.floor(g / eps), 0).astype(np.int64)
            rows, cells, visitor = [np.arange(len(x))], [home], [np.zeros(len(x), bool)]
            for step in product((-1, 0, 1), repeat=g.shape[1]):
                if step <= (0,) * len(step):
                    continue
                step = np.array(step)
                # The way to the cell: up to its near side in each dimension that it differs in.
                way = np.where(step > 0, (home + 1) * eps - g, np.where(step < 0, g - home * eps, 0.0))
                near = np.flatnonzero(large & ((way * way).sum(axis=1) <= eps * eps * (1 + 1e-9)))
                rows.append(near)
                cells.append(home[near] + step)
                visitor.append(np.ones(len(near), bool))
            at, cell = pa.array(np.concatenate(rows)), [",".join(map(str, c)) for c in np.concatenate(cells).tolist()]
            yield pa.RecordBatch.from_arrays([batch["key"].take(at), pa.array(cell), pa.array(np.concatenate(visitor)), batch["node"].take(at), batch["x"].take(at)], names=["key", "cell", "visitor", "node", "x"])

    return points.select("key", "node", "x", "large").mapInArrow(work, "key string, cell string, visitor boolean, node string, x array<double>")


def near(table: pa.Table, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows on the left and on the right of a task, and which of them are within ``eps`` (a row and itself are)."""
    left, right = (np.flatnonzero(table[c].to_numpy()) for c in ("left", "right"))
    x = np.array(table["x"].to_pylist(), np.float64).reshape(len(table), -1)
    out = np.zeros((len(left), len(right)), bool)
    for at in range(0, len(left), 256):
        gap = np.zeros((len(out[at : at + 256]), len(right)))
        for d in range(x.shape[1]):
            gap += (x[left[at : at + 256], d, None] - x[right, d]) ** 2
        out[at : at + 256] = gap <= eps * eps
    return left, right, out


def dbscan(df: DataFrame, key: str, id: str, vector: str, eps: float, least: int, block: int = BLOCK) -> DataFrame:
    """key, id, cluster of every row: a row with ``least`` rows of its key (itself included) within ``eps`` is a core; cores within
    ``eps`` of each other are one cluster, other rows go to the first cluster with a core in reach, or to none (-1).

    ``id`` is a whole number from 0 on, one for each row of a key, ``vector`` array<double> of one length; clusters are numbered
    by their least core id. Rows with a null key, id or vector, and those with a null or NaN entry, are in no cluster.
    """
    node = F.concat(F.lpad(F.col(id).cast("string"), 20, "0"), F.lit("|"), F.col(key).cast("string"))
    fine = F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c)) & (F.size(vector) > 0), F.lit(False))
    points = stored(df.filter(fine & F.col(key).isNotNull() & F.col(id).isNotNull()).select(F.col(key).cast("string").alias("key"), node.alias("node"), F.col(vector).alias("x")), "points")
    # A grid is laid over keys of more rows than a block has.
    large = stored(points.groupBy("key").count().filter(F.col("count") > block).select("key", F.lit(True).alias("large")), "large_keys")
    cells = stored(cells_of(joined(points, large, ["key"], "node").withColumn("large", F.coalesce("large", F.lit(False))), eps), "cells")

    def count(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        left, right, close = near(table, eps)
        both, x, y = np.intersect1d(left, right, assume_unique=True, return_indices=True)
        close[x, y] = False
        n = np.zeros(len(table), np.int64)
        n[left] = close.sum(axis=1)
        alone = np.setdiff1d(np.arange(len(right)), y)
        n[right[alone]] = close[:, alone].sum(axis=0)
        met = np.flatnonzero(n)
        return pa.table({"node": table["node"].take(pa.array(met)), "n": pa.array(n[met])})

    counts = dealt(cells, ["key", "cell"], "node", block).groupBy("key", "cell", "i", "j").applyInArrow(count, "node string, n long")
    cores = stored(counts.groupBy("node").agg(F.sum("n").alias("n")).filter(F.col("n") + 1 >= least).select("node") if least > 1 else points.select("node"), "cores")

    def unite(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        left, right, close = near(table, eps)
        core, nodes = table["core"].to_numpy(zero_copy_only=False).astype(bool), np.array(table["node"].to_pylist(), object)
        part = parts(close & core[left][:, None] & core[right][None, :])
        a, b = [], []

        def put(x, y):
            a.extend(nodes[x])
            b.extend(nodes[y])

        inner, outer = np.flatnonzero(core[left]), np.flatnonzero(core[right] & (part[len(left) :] >= 0))
        put(left[inner], left[part[inner]])
        put(right[outer], left[part[len(left) + outer]])
        # A row that is no core takes one link to each part of cores in its reach.
        for mine, other, links, of in ((left, right, close, part[len(left) :]), (right, left, close.T, part[: len(left)])):
            i, j = np.nonzero(links & ~core[mine][:, None] & core[other][None, :])
            if len(i):
                first = np.unique(np.stack([i, np.where(of[j] >= 0, of[j], len(table) + j)]), axis=1, return_index=True)[1]
                put(mine[i[first]], other[j[first]])
        is_core = dict(zip(nodes.tolist(), core.tolist(), strict=True))
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "core": pa.array([is_core[x] and is_core[y] for x, y in zip(a, b, strict=True)], pa.bool_())})

    marked = cells.join(cores.withColumn("core", F.lit(True)).hint("merge"), "node", "left").withColumn("core", F.coalesce("core", F.lit(False))).select(*cells.columns, "core")
    links = stored(dealt(marked, ["key", "cell"], "node", block).groupBy("key", "cell", "i", "j").applyInArrow(unite, "a string, b string, core boolean"), "density_links")
    found = components(links.filter("core and a <> b"))
    # Small files may hold many rows: what grows with the input is never sent to all tasks.
    of_core = stored(cores.join(found.hint("merge"), "node", "left").select("node", F.coalesce("component", "node").alias("component")), "core_clusters")
    border = links.filter("not core").select(F.col("a").alias("border"), F.col("b").alias("node")).join(of_core.hint("merge"), "node").groupBy(F.col("border").alias("node")).agg(F.min("component").alias("component"))
    named = of_core.union(border)
    # One row a cluster: its key's clusters are numbered by their least core.
    heads = named.select("component").distinct().withColumn("of", F.expr("substring(component, 22)"))
    number = heads.withColumn("cluster", F.row_number().over(Window.partitionBy("of").orderBy("component")).cast("long") - 1).drop("of")
    labels = named.join(number.hint("merge"), "component").select("node", "cluster")
    return df.select(key, id).withColumn("node", node).join(labels.hint("merge"), "node", "left").select(key, id, F.coalesce("cluster", F.lit(-1)).cast("long").alias("cluster"))
