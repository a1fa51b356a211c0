"""Approximate nearest neighbours by cosine: a neighbour graph for each shard of rows, stored, searched from the best nodes on.

Rows are dealt to shards by hash. A task links each vector of its shard with near ones in different directions (a near one is
skipped if it is nearer to one that was taken) and writes ids, vectors and links as one row, so an index is a Parquet table.
A search sends a stated set of queries to all shards; in each, all queries of a block walk the graph together and keep a beam of
the best vectors seen. It looks at a share of a shard's vectors that falls as the shard grows, never at all of a large one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import stored

#: Vectors of a shard, links that a vector makes (it has twice as many at most), near vectors that it chooses from.
SHARD, DEGREE, CHOICE = 8192, 32, 96
#: Vectors kept by a query's beam, and walked on from in one step; queries of a block.
BEAM, STEP, QUERIES = 200, 4, 256


def units(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(length > 0, length, 1)).astype(np.float32)


def chosen(x: np.ndarray, degree: int, choice: int) -> np.ndarray:
    """Links of each vector: of its nearest, those that are nearer to it than to one taken before; then the nearest left. -1: none."""
    n = len(x)
    choice, degree = min(choice, n - 1), min(degree, n - 1)
    out = np.full((n, max(degree, 1)), -1, np.int32)
    step = max(1, (1 << 22) // max(choice * choice, n))
    for at in range(0, n if choice else 0, step):
        rows = np.arange(at, min(at + step, n))
        sim = x[rows] @ x.T
        sim[np.arange(len(rows)), rows] = -np.inf
        near = np.argpartition(-sim, choice - 1, axis=1)[:, :choice]
        order = np.argsort(-np.take_along_axis(sim, near, 1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        own = np.take_along_axis(sim, near, 1)
        between = x[near] @ x[near].transpose(0, 2, 1)
        taken = np.zeros(near.shape, bool)
        for k in range(choice):
            hidden = ((between[:, k, :k] > own[:, k, None]) & taken[:, :k]).any(axis=1)
            taken[:, k] = ~hidden & (taken.sum(axis=1) < degree)
        # Taken ones first, then the nearest others.
        best = np.argsort(~taken, axis=1, kind="stable")[:, :degree]
        out[rows, :degree] = np.take_along_axis(near, best, 1)
    return out


def both_ways(links: np.ndarray) -> np.ndarray:
    """Each link in both directions, up to twice as many a vector, its own before those of others."""
    n, degree = links.shape
    a, k = np.nonzero(links >= 0)
    b = links[a, k]
    src, dst, late = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([k, degree + k])
    order = np.lexsort([late, dst, src])
    src, dst, late = src[order], dst[order], late[order]
    first = np.concatenate([[True], (src[1:] != src[:-1]) | (dst[1:] != dst[:-1])]) if len(src) else np.zeros(0, bool)
    src, dst, late = src[first], dst[first], late[first]
    order = np.lexsort([late, src])
    src, dst = src[order], dst[order]
    place = np.arange(len(src)) - np.searchsorted(src, src)
    out, fits = np.full((n, 2 * degree), -1, np.int32), place < 2 * degree
    out[src[fits], place[fits]] = dst[fits]
    return out


def entries_of(links: np.ndarray) -> np.ndarray:
    """Where a search begins: every so many vectors, about two square roots of them, and one of each connected part."""
    n = len(links)
    part = np.arange(n)
    src, k = np.nonzero(links >= 0)
    dst = links[src, k]
    while True:
        low = part.copy()
        np.minimum.at(low, src, part[dst])
        np.minimum.at(low, dst, part[src])
        low = low[low]
        if (low == part).all():
            break
        part = low
    return np.union1d(np.arange(0, n, max(1, int(np.sqrt(n)) // 2)), np.unique(part)).astype(np.int32)


def build(df: DataFrame, id: str, vector: str, *, shard: int = SHARD, degree: int = DEGREE, choice: int = CHOICE, path: str | None = None) -> DataFrame:
    """The index of all rows: shard, n, ids, x, links, entries (bytes), written to ``path`` or to the shared folder.

    Ids are whole numbers, vectors of one length; rows with a null id or vector, or a null or non-finite entry, are left out. A zero
    vector has cosine 0 with all.
    """
    fine = F.coalesce(F.forall(vector, lambda c: F.coalesce(c.cast("double").between(-1e300, 1e300), F.lit(False))) & (F.size(vector) > 0), F.lit(False))
    rows = df.filter(fine & F.col(id).isNotNull()).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"))
    shards = max(1, -(-rows.count() // shard))

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        x = units(table["v"].to_pylist())
        links = both_ways(chosen(x, degree, choice))
        cells = {"ids": table["id"].to_numpy().astype(np.int64), "x": x, "links": links, "entries": entries_of(links)}
        return pa.table({"shard": table["shard"][:1], "n": pa.array([len(x)], pa.int64())} | {k: pa.array([v.tobytes()], pa.binary()) for k, v in cells.items()})

    made = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(work, "shard int, n long, ids binary, x binary, links binary, entries binary")
    if path is None:
        return stored(made, "neighbour_graph")
    made.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def walk(x: np.ndarray, links: np.ndarray, entries: np.ndarray, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the beam's vectors (-1: none) and their cosines, best first, and how many vectors it has looked at."""
    n, rows = len(x), np.arange(len(q))[:, None]
    seen = np.zeros((len(q), n + 1), bool)
    seen[:, n] = True
    start = np.broadcast_to(entries, (len(q), len(entries)))
    ids, sims = start.copy(), q @ x[entries].T
    seen[rows, ids] = True
    open_ = np.ones(ids.shape, bool)

    def best(ids, sims, open_):
        order = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
        return (np.take_along_axis(v, order, 1) for v in (ids, sims, open_))

    ids, sims, open_ = best(ids, sims, open_)
    while open_.any():
        pick = np.argsort(np.where(open_, -sims, np.inf), axis=1, kind="stable")[:, :STEP]
        ready = np.take_along_axis(open_, pick, 1)
        np.put_along_axis(open_, pick, False, 1)
        near = links[np.where(ready, np.take_along_axis(ids, pick, 1), 0)]
        near = np.where(ready[:, :, None] & (near >= 0), near, n).reshape(len(q), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        near = np.where(seen[rows, near], n, near)
        # Only the columns that some query has new vectors in.
        near.sort(axis=1)
        near = near[:, : max(1, int((near < n).sum(axis=1).max()))]
        seen[rows, near] = True
        fresh = near < n
        new = np.where(fresh, np.einsum("qmd,qd->qm", x[np.where(fresh, near, 0)], q, optimize=True), -np.inf)
        ids, sims, open_ = best(np.concatenate([ids, np.where(fresh, near, -1)], 1), np.concatenate([sims, new], 1), np.concatenate([open_, fresh], 1))
    return ids, sims, seen[:, :n].sum(axis=1)


def search(index: DataFrame, queries: DataFrame, id: str, vector: str, k: int, *, beam: int = BEAM) -> DataFrame:
    """query_id, rank, id, score (cosine) of about the k nearest other rows of each query, ties by id, and looked: the vectors that
    the query was compared with in that row's shard. A stated query set in blocks meets the index, one row a shard."""

    def block(batches):
        for batch in filter(len, batches):
            ids, x = batch["id"].to_numpy(), units(batch["v"].to_pylist())
            for at in range(0, len(ids), QUERIES):
                yield pa.RecordBatch.from_arrays([pa.array([ids[at : at + QUERIES].astype(np.int64).tobytes()], pa.binary()), pa.array([x[at : at + QUERIES].tobytes()], pa.binary())], names=["query_ids", "q"])

    def met(batches):
        for batch in batches:
            for row in range(len(batch)):
                ids, other = (np.frombuffer(batch[c][row].as_py(), np.int64) for c in ("ids", "query_ids"))
                x, q = (np.frombuffer(batch[c][row].as_py(), np.float32).reshape(len(i), -1) for c, i in (("x", ids), ("q", other)))
                links, entries = np.frombuffer(batch["links"][row].as_py(), np.int32).reshape(len(ids), -1), np.frombuffer(batch["entries"][row].as_py(), np.int32)
                found, sims, looked = walk(x, links, entries, q, max(beam, k + 1))
                # One more than k, as a query may find itself.
                found, sims = found[:, : k + 1], sims[:, : k + 1]
                i, j = np.nonzero(found >= 0)
                at = found[i, j]
                score = np.einsum("md,md->m", x[at].astype(np.float64), q[i].astype(np.float64))
                yield pa.RecordBatch.from_arrays([pa.array(other[i]), pa.array(ids[at]), pa.array(score), pa.array(looked[i].astype(np.int64))], names=["query_id", "id", "score", "looked"])

    blocks = queries.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v")).filter("id is not null and v is not null").mapInArrow(block, "query_ids binary, q binary")
    best = index.select("shard", "ids", "x", "links", "entries").crossJoin(blocks).drop("shard").mapInArrow(met, "query_id long, id long, score double, looked long")
    own = best.filter("query_id <> id")
    w = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "id")
    ranked = own.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score", "looked")
