"""Near duplicates of embeddings: an exact metric range join of unit vectors within a label.

1. Equal vectors of a label are one class, so exact copies never meet.
2. Pivots are drawn by hash, a share of a large label's classes. Each vector's home is the cell of its nearest pivot; where the
   triangle inequality leaves room for a link (d(x, c) - d(x, home) <= 2 r), it is sent to cell c as well. Of two cells, one
   gets the other's visitors, so that each two vectors meet once.
3. Cells join independently. A cell of more than BLOCK vectors is dealt to pairs of blocks; a task multiplies two blocks and gives
   out each vector's number of links and the root of its part of the block, so pairs are never rows and no link is lost.

Labels with few classes are one cell. Pivots go with a share of a label's vectors to a task (a cogroup, salted), so nothing is
broadcast whose size grows with the data unchecked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranges import dealt, joined, parts
from . import common
from .neardup import components

#: Least cosine of a link.
LEAST = 0.98
#: Vectors a pivot; pivots a label at most; vectors of a label that one task assigns; vectors of a block.
CELL, PIVOTS, DEAL, BLOCK = 2048, 256, 16384, 2048
#: Rows of a table that is sent to all tasks; beyond it, the join is by shuffle.
BROADCAST_MAX = 100_000
#: Room for rounding: in a bound on distances, and around the least cosine, where a pair is looked at one by one.
SLACK, CLOSE = 1e-9, 1e-12


def doubles(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors in double precision; None for those that are null, empty, zero or hold null or non-finite entries."""
    ends, values = column.offsets.to_numpy(), column.values
    gap = np.concatenate([[0], np.cumsum(values.is_null().to_numpy(zero_copy_only=False))])
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)
    out = []
    for here, a, b in zip(column.is_valid().to_pylist(), ends[:-1], ends[1:], strict=True):
        x = flat[a:b]
        out.append(x if here and b > a and gap[a] == gap[b] and np.isfinite(x).all() and x.any() else None)
    return out


def units(column: pa.Array) -> np.ndarray:
    """Vectors kept as bytes, brought to length 1; scaled first, so that very large and very small entries neither overflow nor vanish."""
    x = np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def classes_of(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows (vec_id, digest: null where nothing can be linked) and their classes (digest, space, id, rows, vector).

    ``space`` names a label and a number of entries: only vectors of one space are compared.
    """

    def work(batch):
        vectors = doubles(batch["v"])
        kept = [v if v is not None and label is not None and i is not None else None for v, label, i in zip(vectors, batch["label"].to_pylist(), batch["vec_id"].to_pylist(), strict=True)]
        spaces = [None if v is None else f"{len(v)}:{label}" for v, label in zip(kept, batch["label"].to_pylist(), strict=True)]
        data = [None if v is None else (v + 0.0).tobytes() for v in kept]
        digests = [None if s is None else xxhash.xxh3_128_digest(s.encode() + b"\0" + b) for s, b in zip(spaces, data, strict=True)]
        return {"vec_id": batch["vec_id"], "digest": pa.array(digests, pa.binary()), "space": spaces, "vector": pa.array(data, pa.binary())}

    rows = common.stored(common.mapped(df, "vec_id long, digest binary, space string, vector binary", work), "vectors")
    found = rows.filter("digest is not null").groupBy("digest").agg(F.first("space").alias("space"), F.min("vec_id").alias("id"), F.count("*").alias("rows"), F.first("vector").alias("vector"))
    return rows.select("vec_id", "digest"), common.stored(found, "classes")


def nearest(vectors: np.ndarray, numbers: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each vector's home (number of its nearest pivot, ties: the least) and the other cells that it visits.

    A link crosses from home h to cell c only if d(x, c) - d(x, h) <= 2 reach, by the triangle inequality on both sides of the
    linked vector. In Euclidean space the distance to the plane between both pivots is a bound too, and never a weaker one.
    """
    order = np.argsort(numbers, kind="stable")
    numbers, pivots = numbers[order], pivots[order]
    between = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
    home, visits = np.empty(len(vectors), np.int64), []
    for at in range(0, len(vectors), 1024):
        square = np.maximum(0, 2 - 2 * vectors[at : at + 1024] @ pivots.T)
        own = square.argmin(axis=1)
        least = square[np.arange(len(own)), own]
        near = np.sqrt(square) - np.sqrt(least)[:, None] <= 2 * reach + SLACK
        near &= square - least[:, None] <= 2 * reach * between[own] + SLACK
        # Of cells a < b, the sum's parity says which of them gets visitors from the other.
        mine, other = numbers[own][:, None], numbers[None, :]
        near &= (mine != other) & ((mine < other) == ((mine + other) % 2 == 0))
        home[at : at + 1024] = numbers[own]
        visits += [numbers[row] for row in near]
    return home, visits


def cells_of(classes: DataFrame, reach: float) -> DataFrame:
    """digest, space, cell, visitor, rows and vector of each class in its home, and in each cell that it visits."""
    sizes = classes.groupBy("space").agg(F.count("*").alias("n")).filter(F.col("n") > CELL)
    sizes = common.stored(sizes.select("space", F.ceil(F.greatest(F.lit(CELL), F.col("n") / PIVOTS)).cast("long").alias("every"), F.ceil(F.col("n") / DEAL).cast("int").alias("deals")), "large_labels")
    every = joined(classes.select("digest", "space", "rows", "vector"), sizes, ["space"], "digest", BROADCAST_MAX).withColumn("h", F.xxhash64("digest"))
    small = every.filter("every is null").select("digest", "space", F.lit(0).alias("cell"), F.lit(False).alias("visitor"), "rows", "vector")
    large = every.filter("every is not null").withColumn("deal", F.pmod(F.xxhash64("h"), "deals").cast("int"))
    pivots = large.filter(F.pmod("h", "every") == 0).select(F.col("space").alias("of_space"), F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("of_deal"), F.col("h").alias("pivot"), F.col("vector").alias("pivot_vector"))

    def assign(own: pa.Table, pivots: pa.Table) -> pa.Table:
        own, pivots = own.combine_chunks(), pivots.combine_chunks()
        homes, visits = [0] * len(own), [[]] * len(own)
        if len(own) and len(pivots):
            # Cells are numbered by the order of the pivots' hashes, so all tasks of a label number them alike.
            number = np.unique(pivots["pivot"].to_numpy(), return_inverse=True)[1]
            homes, visits = nearest(units(own["vector"]), number, units(pivots["pivot_vector"]), reach)
        return pa.table({"digest": own["digest"].cast(pa.binary()), "space": own["space"], "home": pa.array(homes, pa.int32()), "rows": own["rows"], "visits": common.lists([np.asarray(v, np.int32) for v in visits], pa.int32()), "vector": own["vector"].cast(pa.binary())})

    homes = large.select("space", "deal", "digest", "rows", "vector").groupBy("space", "deal").cogroup(pivots.groupBy("of_space", "of_deal")).applyInArrow(assign, "digest binary, space string, home int, rows long, visits array<int>, vector binary")
    both = homes.withColumn("x", F.explode(F.concat(F.array(F.struct(F.col("home").alias("cell"), F.lit(False).alias("visitor"))), F.transform("visits", lambda v: F.struct(v.alias("cell"), F.lit(True).alias("visitor"))))))
    return common.stored(small.union(both.select("digest", "space", "x.cell", "x.visitor", "rows", "vector")), "cells")


def linked(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of unit vectors have the least cosine; those too close to it for the order of additions are added one way."""
    s = a @ b.T
    out = s >= least
    for i, j in zip(*np.nonzero(np.abs(s - least) <= CLOSE), strict=True):
        out[i, j] = (a[i] * b[j]).sum() >= least
    return out


def meetings(cells: DataFrame, least: float) -> DataFrame:
    """digest, n (rows linked with it in one task) and root (a class that its links lead to there)."""

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        left, right = (np.flatnonzero(table[c].to_numpy(zero_copy_only=False)) for c in ("left", "right"))
        digest, rows, v = np.array(table["digest"].to_pylist(), object), table["rows"].to_numpy(), units(table["vector"])
        links = linked(v[left], v[right], least) if len(left) and len(right) else np.zeros((len(left), len(right)), bool)
        both, x, y = np.intersect1d(left, right, assume_unique=True, return_indices=True)
        links[x, y] = False
        n, root = np.zeros(len(digest), np.int64), np.full(len(digest), -1)
        n[left] = links @ rows[right]
        alone = np.setdiff1d(np.arange(len(right)), y)
        n[right[alone]] = links[:, alone].T @ rows[left]
        links[x, y] = True
        part = parts(links)
        of_right = part[len(left) :]
        root[right[of_right >= 0]] = left[of_right[of_right >= 0]]
        root[left] = left[part[: len(left)]]
        met = np.flatnonzero(n > 0)
        return pa.table({"digest": pa.array(digest[met].tolist(), pa.binary()), "n": pa.array(n[met]), "root": pa.array(digest[root[met]].tolist(), pa.binary())})

    return common.stored(dealt(cells, ["space", "cell"], "digest", BLOCK, BROADCAST_MAX).groupBy("space", "cell", "i", "j").applyInArrow(work, "digest binary, n long, root binary"), "meetings")


def near_duplicates(df: DataFrame, *, least: float = LEAST, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``df``.

    Two rows are linked if their labels are equal and not null, their vectors have the same number of entries and their cosine,
    in double precision, is ``least`` or more. n_links counts the other rows that are linked directly, component_id is the least
    id reachable, kept says whether that is the row's own. Null, empty and zero vectors and those with null or non-finite
    entries are linked with nothing, nor are rows without an id (their component is null, and they are kept). Repeated rows are
    linked with each other. An id that stands on different vectors links each by itself, and names the least component of each.
    Other columns are not read.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine is above 0 and at most 1")
    df = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))
    rows, classes = classes_of(df)
    cells = cells_of(classes, float(np.sqrt(2 - 2 * least)))
    met = meetings(cells, least)
    links = met.filter("digest <> root").select(F.col("digest").alias("a"), F.col("root").alias("b")).distinct()
    found = common.stored(components(links), "parts")
    ids = found.join(classes.select("digest", "id"), "digest")
    tops = ids.groupBy("component").agg(F.min("id").alias("top"), F.count("*").alias("rows"))
    tops = common.stored(tops, "tops")
    ids = common.spread_join(ids.select("digest", "component"), tops.select("component", "top"), "component", "digest", tops).select("digest", "top")
    links_of = met.groupBy("digest").agg(F.sum("n").alias("n"))
    of_class = classes.select("digest", "id", "rows").join(links_of, "digest", "left").join(ids, "digest", "left")
    of_class = common.stored(of_class.select("digest", "rows", (F.coalesce("n", F.lit(0)) + F.col("rows") - 1).alias("n_links"), F.coalesce("top", "id").alias("component_id")), "class_links")
    out = common.spread_join(rows.filter("digest is not null"), of_class.drop("rows"), "digest", "vec_id", of_class)
    out = out.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return out.union(rows.filter("digest is null").select("vec_id", F.lit(0).cast("long"), "vec_id", F.lit(True)))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x::DOUBLE), false))) AND list_bool_or(list_transform(embedding, lambda x: coalesce(x <> 0, false)))),
e AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
n AS (SELECT a, count(*) AS n FROM e GROUP BY 1),
r(vec_id, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT e.b, r.c FROM r JOIN e ON r.vec_id = e.a),
m AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY 1)
SELECT m.vec_id, coalesce(n.n, 0) AS n_links, m.component_id, m.vec_id = m.component_id AS kept FROM m LEFT JOIN n ON m.vec_id = n.a"""
