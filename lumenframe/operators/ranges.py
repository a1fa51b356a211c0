"""Range joins that keep hot cells apart: checked joins, cells dealt to pairs of blocks, parts of a block, components of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import stored

#: Rows of a table that is sent to all tasks; pieces of a key where it is shuffled instead, and rows from which on a key is cut; rows of a block;
#: rows of a task that sorts whole keys.
BROADCAST_MAX, SALTS, HOT, BLOCK, TASK = 100_000, 64, 100_000, 2048, 100_000


def spread(df: DataFrame, keys: list[str], rows: int = TASK) -> DataFrame:
    """The rows by key in tasks of about ``rows`` of them, so that more rows are more tasks, not larger ones. By their files' sizes Spark
    would put as many rows into a task as compress well; a key is never cut."""
    return df.repartition(max(1, -(-df.count() // rows)), *keys)


def joined(big: DataFrame, small: DataFrame, keys: list[str], salt: str, most: int = BROADCAST_MAX, hot: int = HOT) -> DataFrame:
    """Left join with a table of one row a key, whose size is looked at: sent to all tasks up to ``most`` rows, beyond it
    shuffled, where the rows of ``big`` of a key with more than ``hot`` of them are dealt to SALTS pieces by the column ``salt``.

    Only such keys, of which there are few, are copied to the pieces. The join is named: by their files' sizes Spark would take
    large tables for small ones.
    """
    if small.count() <= most:
        return big.join(F.broadcast(small), keys, "left")
    cut = F.broadcast(stored(big.groupBy(*keys).agg(F.count("*").alias("_c")).filter(F.col("_c") > hot).select(*keys, F.lit(True).alias("_cut")), "hot_keys"))
    salted = small.join(cut, keys, "left").withColumn("_salt", F.explode(F.when(F.col("_cut"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("_cut")
    dealt_out = big.join(cut, keys, "left").withColumn("_salt", F.when(F.col("_cut"), F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int")).otherwise(0)).drop("_cut")
    return dealt_out.join(salted.hint("merge"), [*keys, "_salt"], "left").drop("_salt")


def dealt(cells: DataFrame, keys: list[str], salt: str, block: int = BLOCK, most: int = BROADCAST_MAX) -> DataFrame:
    """The rows of cells (``keys``, visitor) with i and j, which with the keys name the task in which they meet others, and the
    sides of it, left and right, on which they are.

    In a cell of one task its own rows meet all. A larger cell is cut into blocks, and each pair of its own blocks, and each of
    them with each block of visitors, is a task. Visitors never meet each other. Each two rows meet in one task.
    """
    sizes = cells.groupBy(*keys).agg(F.count_if(~F.col("visitor")).alias("own"), F.count_if("visitor").alias("guests")).filter((F.col("own") > block) | (F.col("guests") > block))
    sizes = stored(sizes.select(*keys, F.ceil(F.col("own") / block).cast("int").alias("own"), F.ceil(F.col("guests") / block).cast("int").alias("guests")), "large_cells")
    rows = joined(cells, sizes, keys, salt, most)
    rows = rows.withColumn("block", F.pmod(F.xxhash64(salt), F.when(F.col("visitor"), F.col("guests")).otherwise(F.col("own"))).cast("int"))
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    pair = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    mine = F.col("block")
    # Blocks of visitors are counted down from -1.
    at_home = F.concat(F.transform(upto("own"), lambda k: pair(F.least(mine, k), F.greatest(mine, k))), F.transform(upto("guests"), lambda k: pair(mine, -1 - k)))
    away = F.transform(upto("own"), lambda k: pair(k, -1 - mine))
    one = F.col("block").isNull()
    rows = rows.withColumn("at", F.explode(F.when(one, F.array(pair(F.lit(0), F.lit(0)))).when(F.col("visitor"), away).otherwise(at_home)))
    left = ~F.col("visitor") & (one | (mine == F.col("at.i")))
    right = one | F.col("visitor") | (mine == F.col("at.j"))
    return rows.select(*cells.columns, F.col("at.i").alias("i"), F.col("at.j").alias("j"), left.alias("left"), right.alias("right"))


def parts(links: np.ndarray) -> np.ndarray:
    """Connected parts of rows and columns of a table of links: for each row, then each column, its part's first row, or -1."""
    rows, cols = links.shape
    part = np.full(rows + cols, -1)
    for start in range(rows):
        if part[start] >= 0:
            continue
        part[start], front = start, np.array([start])
        while len(front):
            new = np.flatnonzero(links[front].any(axis=0) & (part[rows:] < 0))
            part[rows + new] = start
            front = np.flatnonzero(links[:, new].any(axis=1) & (part[:rows] < 0)) if len(new) else new
            part[front] = start
    return part


def components(links: DataFrame) -> DataFrame:
    """node, component (least node reachable) of all nodes in the links (a, b).

    Each round links all neighbours of a node with its least one, on the larger side, then on the smaller (alternating stars), and
    is written to the shared folder; only a count and a checksum come to the driver. Minima are formed before the shuffle.
    """

    def settled(df):
        edges = stored(df.filter("a <> b").distinct(), "links")
        return edges, edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    def to_least(df):
        return joined(df, stored(df.groupBy("a").agg(F.min("b").alias("m")), "least"), ["a"], "b")

    edges, state = settled(links.select("a", "b"))
    while state[0]:
        large = to_least(edges.union(edges.select("b", "a"))).filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
        small = to_least(settled(large)[0])
        edges, now = settled(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b"))))
        if now == state:
            break
        state = now
    found = edges.groupBy("a").agg(F.min("b").alias("component"))
    return found.select(F.col("a").alias("node"), "component").union(found.select("component", "component").distinct())
