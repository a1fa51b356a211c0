"""Clusters of each key's vectors: k-means and principal components over blocks of rows, Ward's merges in rounds.

A key's vectors are packed into blocks of BLOCK rows once. K-means of keys of one block is done where the block is, many keys at
once; for larger keys each round sends a key's centres to its blocks and adds up partial sums, so a key of any size is spread
over tasks. Nothing but counts and numbers of rounds come to the driver.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..sources.sinks import stored
from .ranges import joined

#: Rows of a block; groups that partial sums of a key meet in first; clusters of a key that are merged in one task; entries of
#: whole keys that are worked on at once (a larger block is worked on alone).
BLOCK, GROUPS, APART, TOGETHER = 1024, 64, 8192, 2**17
#: The greatest entry of a vector, of either sign.
MOST = 1e300
BLOCKS = "key string, block int, ids binary, x binary"
MOMENTS = "key string, n long, mean binary, square binary"


def blocks_of(df: DataFrame, key: str, id: str, vector: str, block: int = BLOCK) -> DataFrame:
    """key, block, ids, x (bytes): a key's vectors in blocks of about ``block`` rows. Rows with a null key, id or vector, or a null
    or non-finite entry, are left out. Vectors of a key have one length."""
    fine = F.coalesce(F.forall(vector, lambda c: F.coalesce(c.cast("double").between(-MOST, MOST), F.lit(False))) & (F.size(vector) > 0), F.lit(False))
    rows = df.filter(fine & F.col(key).isNotNull() & F.col(id).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(id).cast("long").alias("id"), F.transform(vector, lambda c: c.cast("double")).alias("x"))
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("pieces")).filter("pieces > 1")
    rows = joined(rows, stored(sizes, "key_sizes"), ["key"], "id").withColumn("block", F.pmod(F.xxhash64("id"), F.coalesce("pieces", F.lit(1))).cast("int"))

    def pack(table: pa.Table) -> pa.RecordBatch:
        key, block = table["key"], table["block"].to_numpy()
        begins = pa.compute.not_equal(key[1:], key[:-1]).to_numpy() | (np.diff(block) != 0)
        at = np.concatenate([[0], np.flatnonzero(begins) + 1, [len(block)]])
        x = table["x"].combine_chunks()
        edge = x.offsets.to_numpy()[at] - x.offsets[0].as_py()
        ids, x = table["id"].to_numpy(), x.flatten().to_numpy(zero_copy_only=False)
        cut = lambda v, at: pa.array([v[i:j].tobytes() for i, j in itertools.pairwise(at.tolist())], pa.binary())
        return pa.RecordBatch.from_arrays([key.take(pa.array(at[:-1])).combine_chunks(), pa.array(block[at[:-1]]), cut(ids, at), cut(x, edge)], names=["key", "block", "ids", "x"])

    def run(batches):
        held = []
        for batch in filter(len, batches):
            # The last block may go on in the next batch.
            last = (batch["key"][-1].as_py(), batch["block"][-1].as_py())
            own = np.asarray(pa.compute.equal(batch["key"], last[0])) & (batch["block"].to_numpy() == last[1])
            cut = len(batch) - int(own.sum())
            if cut or (held and (held[-1]["key"][0].as_py(), held[-1]["block"][0].as_py()) != last):
                if whole := [*held, *([batch.slice(0, cut)] if cut else [])]:
                    yield pack(pa.Table.from_batches(whole))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield pack(pa.Table.from_batches(held))

    rows = rows.select("key", "block", "id", "x").repartition("key", "block").sortWithinPartitions("key", "block", "id")
    return stored(rows.mapInArrow(run, BLOCKS), "blocks")


def opened(ids: bytes, x: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(x, np.float64).reshape(len(ids), -1)


def pooled(parts: DataFrame, keys: list[str], schema: str) -> DataFrame:
    """Counts, means and sums of squares around the mean (n, mean, square as bytes) of parts, brought together in two steps, so a
    key of many parts is no single group. Parts are added by the rule for two samples, which stays exact far from 0."""

    def add(table: pa.Table) -> pa.Table:
        total, mean, square = 0, None, None
        for n, m, s in sorted(zip(*(table[c].to_pylist() for c in ("n", "mean", "square")), strict=True)):
            m, s = np.frombuffer(m), np.frombuffer(s)
            if mean is None:
                total, mean, square = n, m.copy(), s.copy()
                continue
            gap = m - mean
            both = total + n
            square += s + (np.outer(gap, gap).ravel() if len(s) == len(m) ** 2 and len(m) > 1 else gap * gap) * (total * n / both)
            mean, total = mean + gap * (n / both), both
        return pa.table({k: table[k][:1] for k in keys} | {"n": pa.array([total], pa.int64()), "mean": pa.array([mean.tobytes()], pa.binary()), "square": pa.array([square.tobytes()], pa.binary())})

    salted = parts.withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    first = salted.groupBy(*keys, "_g").applyInArrow(lambda table: add(table), schema)
    return first.groupBy(*keys).applyInArrow(lambda table: add(table), schema)


def principal(blocks: DataFrame, most: int) -> DataFrame:
    """The blocks on each key's first components: min(``most``, entries, rows - 1) of them, at least one. Of a component's two signs,
    the one whose largest entry is positive."""

    def moments(batches):
        for batch in filter(len, batches):
            out = []
            for key, ids, x in zip(*(batch[c].to_pylist() for c in ("key", "ids", "x")), strict=True):
                x = opened(ids, x)[1]
                gap = x - x.mean(axis=0)
                out.append((key, len(x), x.mean(axis=0).tobytes(), (gap.T @ gap).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["key", "n", "mean", "square"])

    def axes(batches):
        for batch in filter(len, batches):
            out = []
            for n, mean, square in zip(*(batch[c].to_pylist() for c in ("n", "mean", "square")), strict=True):
                d = len(np.frombuffer(mean))
                v = np.linalg.eigh(np.frombuffer(square).reshape(d, d) / n)[1][:, ::-1][:, : max(1, min(most, d, n - 1))]
                v = v * np.where(np.take_along_axis(v, np.abs(v).argmax(axis=0)[None], 0) < 0, -1, 1)
                out.append(np.ascontiguousarray(v).tobytes())
            yield pa.RecordBatch.from_arrays([batch["key"], batch["mean"], pa.array(out, pa.binary())], names=["key", "mean", "axes"])

    def project(batches):
        for batch in filter(len, batches):
            out = []
            for ids, x, mean, v in zip(*(batch[c].to_pylist() for c in ("ids", "x", "mean", "axes")), strict=True):
                x, mean = opened(ids, x)[1], np.frombuffer(mean)
                out.append(((x - mean) @ np.frombuffer(v).reshape(len(mean), -1)).tobytes())
            yield pa.RecordBatch.from_arrays([batch["key"], batch["block"], batch["ids"], pa.array(out, pa.binary())], names=["key", "block", "ids", "x"])

    found = pooled(blocks.mapInArrow(moments, MOMENTS), ["key"], MOMENTS).mapInArrow(axes, "key string, mean binary, axes binary")
    return stored(joined(blocks, stored(found, "axes"), ["key"], "ids").mapInArrow(project, BLOCKS), "projected")


def gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres, from differences, so that equal ones are at 0."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1)


def drawn(ids: np.ndarray, step: int) -> np.ndarray:
    """A number over 0 and under 1 for each id and step, from a 64-bit mix: the same wherever it is drawn."""
    z = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((step + 1) * 0xBF58476D1CE4E5B9 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53 + 2.0**-54


def seeded(blocks: DataFrame, k: int, of_key: DataFrame | None = None) -> DataFrame:
    """key, centres (bytes, ``k`` at most, or as many as ``of_key`` (key, k) says): k-means++ by races. The next centre is the row with the least -ln(u) / squared distance to
    the centres so far, u drawn from its id: so each row wins with a chance in proportion to its squared distance."""

    def race(step):
        def run(batches):
            for batch in filter(len, batches):
                names = batch.schema.names
                out = []
                for i in range(len(batch)):
                    ids, x = opened(batch["ids"][i].as_py(), batch["x"][i].as_py())
                    far = gaps(x, np.frombuffer(batch["centres"][i].as_py()).reshape(-1, x.shape[1])).min(axis=1) if "centres" in names else np.ones(len(x))
                    live = np.flatnonzero(far > 0)
                    if len(live):
                        time = -np.log(drawn(ids[live], step)) / far[live]
                        w = live[np.lexsort([ids[live], time])[0]]
                        out.append((batch["key"][i].as_py(), float(time.min()), int(ids[w]), x[w].tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.float64(), pa.int64(), pa.binary()), strict=True)], names=["key", "time", "id", "x"])

        return run

    centres, held = None, blocks
    for step in range(k):
        won = held.mapInArrow(race(step), "key string, time double, id long, x binary").groupBy("key").agg(F.min(F.struct("time", "id", "x"))["x"].alias("x"))
        won = won if of_key is None else won.join(of_key.filter(F.col("k") > step), "key", "left_semi")
        if centres is None:
            centres = stored(won.select("key", F.col("x").alias("centres")), "centres")
        else:
            centres = stored(centres.join(won, "key", "left").select("key", F.when(F.col("x").isNull(), F.col("centres")).otherwise(F.concat("centres", F.coalesce("x", F.lit(b"")))).alias("centres")), "centres")
        held = joined(blocks, centres, ["key"], "ids")
    return centres


def sums(batches, own):
    """key, cell, n, s, q: of each block's rows, by the numbers that ``own`` gives them, count, sums and sums of squares of each entry
    (cell: number * entries + entry)."""
    for batch in filter(len, batches):
        out = []
        for i, (key, ids, x) in enumerate(zip(*(batch[c].to_pylist() for c in ("key", "ids", "x")), strict=True)):
            x = opened(ids, x)[1]
            number = own(batch, i, x)
            for j in np.unique(number).tolist():
                of = x[number == j]
                out += [(key, j * x.shape[1] + d, len(of), s, q) for d, (s, q) in enumerate(zip(of.sum(axis=0).tolist(), (of * of).sum(axis=0).tolist(), strict=True))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.float64()), strict=True)], names=["key", "cell", "n", "s", "q"])


def first_of(batch: pa.RecordBatch, i: int, x: np.ndarray) -> np.ndarray:
    """The nearest centre of each row of a block; of equal ones the first."""
    return gaps(x, np.frombuffer(batch["centres"][i].as_py()).reshape(-1, x.shape[1])).argmin(axis=1)


def together(batch: pa.RecordBatch):
    """The blocks of a batch end to end, those of one width, up to TOGETHER entries: their places in the batch, ids, rows, and for
    each row which of the blocks it is of."""
    ids, x = batch["ids"].to_pylist(), batch["x"].to_pylist()
    width = np.array([len(b) // len(a) for a, b in zip(ids, x, strict=True)])
    for d in np.unique(width).tolist():
        at = np.flatnonzero(width == d)
        size = np.array([len(ids[i]) // 8 for i in at])
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(np.cumsum(size * d) // TOGETHER)) + 1):
            own = at[part]
            yield own, *opened(b"".join(ids[i] for i in own), b"".join(x[i] for i in own)), np.repeat(np.arange(len(own)), size[part])


def totals(x: np.ndarray, owner: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """How many rows each block has, and their sums, to the last bit those of ``sum`` on a block's rows of one entry: reduceat adds the
    first of a part to the sum of its rest, so each part begins with a zero."""
    start = np.searchsorted(owner, np.arange(blocks + 1))
    return np.diff(start), np.stack([np.add.reduceat(np.insert(v, start[:-1], 0.0), start[:-1] + np.arange(blocks)) for v in x.T], axis=1)


def raced(ids: np.ndarray, x: np.ndarray, owner: np.ndarray, k: np.ndarray) -> np.ndarray:
    """What ``seeded`` does, for whole blocks (``k`` of each) at once: block, number, entry; infinite beyond a block's centres."""
    start = np.searchsorted(owner, np.arange(len(k)))
    centres = np.full((len(k), k.max(), x.shape[1]), np.inf)
    for step in range(k.max()):
        far = gaps(x, [centres[owner, j] for j in range(step)]).min(axis=1) if step else np.ones(len(x))
        time = np.where(far > 0, -np.log(drawn(ids, step)) / np.where(far > 0, far, 1), np.inf)
        of, first = np.unique(owner[won := np.flatnonzero(time == np.minimum.reduceat(time, start)[owner])], return_index=True)
        won = won[first][(far[won[first]] > 0) & (step < k[of])]
        centres[owner[won], step] = x[won]
    return centres


def lloyd(ids: np.ndarray, x: np.ndarray, owner: np.ndarray, k: np.ndarray, rounds: int, tolerance: float) -> tuple[np.ndarray, list[int]]:
    """The cluster of each row after ``rounds`` of Lloyd's for whole blocks at once, and the rounds in which a block's centres moved by
    more than the tolerance. A block whose rows all keep their clusters stays as it is, so it takes no further part."""
    n, s = totals(x, owner, len(k))
    spread = np.maximum((totals(x * x, owner, len(k))[1] / n[:, None] - (s / n[:, None]) ** 2).mean(axis=1), 0)
    centres, out, at, moving = raced(ids, x, owner, k), np.zeros(len(x), np.int32), np.arange(len(x)), []
    own = gaps(x, [centres[owner, j] for j in range(centres.shape[1])]).argmin(axis=1)
    for step in range(rounds):
        moves = np.zeros(len(spread))
        for j in range(centres.shape[1]):
            n, s = totals(x[own == j], owner[own == j], len(spread))
            new = s[n > 0] / n[n > 0, None]
            moves[n > 0] += ((new - centres[n > 0, j]) ** 2).sum(axis=1)
            centres[n > 0, j] = new
        if (moves > tolerance * spread).any():
            moving.append(step)
        now = gaps(x, [centres[owner, j] for j in range(centres.shape[1])]).argmin(axis=1)
        live = np.zeros(len(spread), bool)
        live[owner[now != own]] = True
        out[at] = now
        stay = live[owner]
        x, at, own, centres, spread, owner = x[stay], at[stay], now[stay], centres[live], spread[live], (np.cumsum(live) - 1)[owner[stay]]
        if not len(x):
            break
    return out, moving


def kmeans(blocks: DataFrame, k: int, rounds: int = 50, tolerance: float = 1e-4, of_key: DataFrame | None = None, vectors: bool = False) -> DataFrame:
    """key, id, cluster of every row of the blocks, with ``vectors`` also x, its vector: Lloyd's rounds from ``seeded`` centres, until the
    squared moves of no key's centres come to more than ``tolerance`` of the mean variance of its entries, or ``rounds`` are done. A
    centre without rows stays.
    A key with fewer than ``k`` different vectors has as many clusters as those; ``of_key`` (key, k) may name fewer for some keys.

    Keys of one block are looked at twice: for the rounds in which any of them moves, and, when it is known how many rounds there are,
    for their clusters. Only keys of more blocks take the rounds by shuffle."""
    cells = "key string, cell int, n long, s double, q double"
    found = "key string, id long, cluster int" + (", x array<double>" if vectors else "")

    def rows_of(batch, places, ids, cluster, x):
        out = {"key": batch["key"].take(pa.array(places)), "id": pa.array(ids), "cluster": pa.array(cluster.astype(np.int32))}
        if vectors:
            out["x"] = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
        return pa.RecordBatch.from_pydict(out)

    def labelled(batches):
        for batch in filter(len, batches):
            for i in range(len(batch)):
                ids, x = opened(batch["ids"][i].as_py(), batch["x"][i].as_py())
                yield rows_of(batch, np.full(len(ids), i), ids, first_of(batch, i, x), x)

    def packed(batches):
        for batch in filter(len, batches):
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array([np.array(x, np.float64).tobytes() for x in batch["flat"].to_pylist()], pa.binary()), batch["flat"], batch["moving"]], names=["key", "centres", "flat", "moving"])

    def unpacked(batches):
        for batch in filter(len, batches):
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array([np.frombuffer(x).tolist() for x in batch["centres"].to_pylist()], pa.list_(pa.float64()))], names=["key", "flat"])

    def whole_keys(batch):
        most = np.minimum(batch["k"].to_numpy(), k) if "k" in batch.schema.names else np.full(len(batch), k)
        for own, ids, x, owner in together(batch):
            yield own, ids, x, owner, most[own]

    def unsettled(batches):
        for batch in filter(len, batches):
            steps = {step for _, ids, x, owner, most in whole_keys(batch) for step in lloyd(ids, x, owner, most, rounds, tolerance)[1]}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(steps), pa.int32())], names=["step"])

    def clustered(upto):
        def run(batches):
            for batch in filter(len, batches):
                for own, ids, x, owner, most in whole_keys(batch):
                    yield rows_of(batch, own[owner], ids, lloyd(ids, x, owner, most, upto, tolerance)[0], x)

        return run

    several = stored(blocks.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1").select("key", F.lit(True).alias("_cut")), "cut_keys")
    cut = not several.isEmpty()
    told = joined(blocks, several, ["key"], "ids") if cut else blocks.withColumn("_cut", F.lit(None).cast("boolean"))
    whole, blocks = told.filter("_cut is null").drop("_cut"), told.filter("_cut").drop("_cut")
    whole = whole if of_key is None else joined(whole, of_key, ["key"], "ids")
    moving = {row["step"] for row in whole.mapInArrow(unsettled, "step int").distinct().collect()}

    if cut:
        added = [F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")]
        sizes = blocks.mapInArrow(lambda b: sums(b, lambda batch, i, x: np.zeros(len(x), np.int64)), cells).groupBy("key", "cell").agg(*added)
        variance = F.avg(F.col("q") / F.col("n") - (F.col("s") / F.col("n")) * (F.col("s") / F.col("n")))
        spread = stored(sizes.groupBy("key").agg(F.greatest(variance, F.lit(0.0)).alias("spread")), "spread")
        centres = stored(seeded(blocks, k, of_key).mapInArrow(unpacked, "key string, flat array<double>").withColumn("moving", F.lit(True)).mapInArrow(packed, "key string, centres binary, flat array<double>, moving boolean"), "centres")
    for done in range(rounds):
        still = False
        if cut:
            means = joined(blocks, centres.select("key", "centres"), ["key"], "ids").mapInArrow(lambda b: sums(b, first_of), cells).groupBy("key", "cell").agg(*added)
            old = centres.select("key", F.posexplode("flat").alias("cell", "old"))
            new = old.join(means, ["key", "cell"], "left").withColumn("new", F.coalesce(F.col("s") / F.col("n"), F.col("old")))
            new = new.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "new"))), lambda x: x["new"]).alias("flat"), F.sum((F.col("new") - F.col("old")) * (F.col("new") - F.col("old"))).alias("moves"))
            new = new.join(spread, "key").select("key", "flat", (F.col("moves") > tolerance * F.col("spread")).alias("moving"))
            centres = stored(new.mapInArrow(packed, "key string, centres binary, flat array<double>, moving boolean"), "centres")
            still = not centres.filter("moving").isEmpty()
        if not still and done not in moving:
            break
    got = whole.mapInArrow(clustered(done + 1), found)
    return got.union(joined(blocks, centres.select("key", "centres"), ["key"], "ids").mapInArrow(labelled, found)) if cut else got


def closest(node: np.ndarray, x: np.ndarray, size: np.ndarray, others: np.ndarray, y: np.ndarray, weight: np.ndarray, rows: int = 256, exact: int = 65_536) -> tuple[np.ndarray, np.ndarray]:
    """What the cheapest merge of each cluster (number, centre, size) with one of the others adds to the squared distances within, and
    that one's number, of equal ones the least; infinity and -1 where there is none. Products of matrices leave the few that may
    be the cheapest; these are taken from differences, which give both clusters of a pair the same cost to the last bit."""
    cost, near = np.full(len(x), np.inf), np.full(len(x), -1)
    p, r = x - y.mean(axis=0), y - y.mean(axis=0)
    pp, rr = (p * p).sum(axis=1), (r * r).sum(axis=1)
    for start in range(0, len(x), rows):
        at = slice(start, start + rows)
        share = size[at, None] * weight / (size[at, None] + weight)
        far = pp[at, None] + rr - 2 * (p[at] @ r.T)
        _, own, same = np.intersect1d(node[at], others, return_indices=True)
        far[own, same] = np.inf
        slack = 1e-12 * (pp[at, None] + rr.max())
        far = (far - slack) * share
        i, j = np.nonzero((far <= (far + 2 * slack * share).min(axis=1)[:, None]) & np.isfinite(far))
        got = np.concatenate([share[i[k : k + exact], j[k : k + exact]] * ((x[start + i[k : k + exact]] - y[j[k : k + exact]]) ** 2).sum(axis=1) for k in range(0, len(i), exact)] or [np.zeros(0)])
        order = np.lexsort([others[j], got, i])
        first, k = np.unique(i[order], return_index=True)
        cost[start + first], near[start + first] = got[order[k]], others[j[order[k]]]
    return cost, near


def merges(node: np.ndarray, x: np.ndarray, size: np.ndarray, height: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ward's merges of clusters (numbers that grow, centres, sizes, heights) until one is left: the numbers of both sides, of which
    the first stays, and the cost, not under that of a merge within.

    Two clusters that are each other's cheapest partner are merged at some point whatever else is, so all of them are at once; the
    others keep their partner unless it was merged, as a merge brings no cluster nearer.
    """
    out = [[], [], []]
    cost, near = np.full(len(x), np.inf), np.full(len(x), -1)
    while len(node) > 1:
        stale = near < 0
        cost[stale], near[stale] = closest(node[stale], x[stale], size[stale], node, x, size)
        at, i = np.searchsorted(node, near), np.arange(len(node))
        a = i[(near >= 0) & (near[at % len(node)] == node) & (node < near)]
        if not len(a):
            break
        b = at[a]
        height[a] = np.maximum(cost[a], np.maximum(height[a], height[b]))
        for part, new in zip(out, (node[a], node[b], height[a]), strict=True):
            part.append(new)
        x[a] = (size[a, None] * x[a] + size[b, None] * x[b]) / (size[a] + size[b])[:, None]
        size[a] += size[b]
        merged = np.zeros(len(node), bool)
        merged[a] = merged[b] = True
        near[merged | merged[at % len(node)]] = -1
        keep = np.ones(len(node), bool)
        keep[b] = False
        node, x, size, height, cost, near = (v[keep] for v in (node, x, size, height, cost, near))
    return tuple(np.concatenate(part or [np.zeros(0)]).astype(kind) for part, kind in zip(out, (np.int64, np.int64, np.float64), strict=True))


def roots(node: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number that merges (a, b) of numbers of ``node``, which grow, bring each one's side to."""
    parent = np.arange(len(node))
    for x, y in zip(np.searchsorted(node, a).tolist(), np.searchsorted(node, b).tolist(), strict=True):
        parent[y] = x
    while (up := parent[parent] != parent).any():
        parent = np.where(up, parent[parent], parent)
    return node[parent]


def ward(x: np.ndarray, clusters: int) -> np.ndarray:
    """Cluster of each row when the two clusters that add least to the squared distances within are merged until ``clusters`` are
    left, numbered by their first rows. Copies are merged first."""
    n = len(x)
    if not n:
        return np.zeros(0, np.int64)
    first, copy, count = np.unique(x, axis=0, return_index=True, return_inverse=True, return_counts=True)[1:]
    of = first[copy.ravel()]
    order = np.argsort(first)
    again = np.flatnonzero(of != np.arange(n))
    again = again[np.lexsort([again, of[again]])]
    a, b, height = merges(first[order], x[first[order]].astype(np.float64), count[order].astype(np.float64), np.zeros(len(first)))
    a, b, height = np.concatenate([of[again], a]), np.concatenate([again, b]), np.concatenate([np.zeros(len(again)), height])
    kept = np.sort(np.argsort(height, kind="stable")[: max(0, n - clusters)])
    return np.unique(roots(np.arange(n), a[kept], b[kept]), return_inverse=True)[1]


def speakers(n, square: float, own: float, least: int, most: int) -> int:
    """How many speakers to look for: from the mean cosine distance of all pairs of ``n`` rows, which the squared length of the sum of
    their unit vectors and the sum of their squared lengths give."""
    if n < 2:
        return least
    far = 1 - (square - own) / (n * (n - 1))
    # Bands of the mean distance.
    want = 3 if far > 0.32 else 2 if far > 0.24 else least
    return max(least, min(most, max(least, want)))


def cheapest(state: DataFrame, block: int) -> DataFrame:
    """key, node, cost, near: the cheapest partner of each cluster without one. Blocks of these and blocks of all clusters of a key
    meet in tasks of their own."""
    pieces = lambda c: F.ceil(c / block).cast("int")
    sizes = stored(state.groupBy("key").agg(pieces(F.count("*")).alias("all"), pieces(F.count_if(F.col("near").isNull())).alias("stale")), "state_sizes")
    rows = joined(state, sizes, ["key"], "node").filter("stale > 0").select("key", "node", "size", "x", "near", "all", "stale", F.xxhash64("node").alias("h"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = rows.filter("near is null").select("key", "node", "size", "x", F.pmod("h", "stale").cast("int").alias("i"), upto("all").alias("j"), F.lit(True).alias("asks"))
    met = mine.union(rows.select("key", "node", "size", "x", upto("stale").alias("i"), F.pmod("h", "all").cast("int").alias("j"), F.lit(False).alias("asks")))

    def meet(table: pa.Table) -> pa.Table:
        (node, x, size), (others, y, weight) = (clusters_of(table.filter(mask)) for mask in (table["asks"], pa.compute.invert(table["asks"])))
        if not len(node) or not len(others):
            return pa.table({"key": table["key"][:0], "node": pa.array([], pa.int64()), "cost": pa.array([], pa.float64()), "near": pa.array([], pa.int64())})
        cost, near = closest(node, x, size, others, y, weight)
        return pa.table({"key": pa.array([table["key"][0].as_py()] * len(node)), "node": node, "cost": cost, "near": near}).filter(pa.array(near >= 0))

    best = met.groupBy("key", "i", "j").applyInArrow(meet, "key string, node long, cost double, near long")
    return best.groupBy("key", "node").agg(F.min(F.struct("cost", "near")).alias("b")).select("key", "node", "b.cost", "b.near")


def clusters_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, centres and sizes, by number."""
    table = table.sort_by("node").combine_chunks()
    x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return table["node"].to_numpy(), x.reshape(table.num_rows, -1) if len(x) else np.zeros((0, 1)), table["size"].to_numpy()


def merged_once(state: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Clusters (key, node, size, height, x, near, cost) after all that are each other's cheapest partners are merged, and the
    merges (key, a, b, height)."""
    found = cheapest(state, block)
    known = state.filter("near is not null").select("key", "node", "cost", "near").union(found)
    light = stored(known.join(state.select("key", "node", "height").hint("merge"), ["key", "node"]), "partners")
    back = light.select("key", F.col("node").alias("near"), F.col("near").alias("back"), F.col("height").alias("other"))
    pairs = light.join(back.hint("merge"), ["key", "near"]).filter("back = node and node < near")
    pairs = stored(pairs.select("key", F.col("node").alias("a"), F.col("near").alias("b"), F.greatest("cost", "height", "other").alias("height")), "merges")
    part = lambda c: state.select("key", F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("x").alias(f"x_{c}")).hint("merge")
    size = F.col("size_a") + F.col("size_b")
    new = pairs.join(part("a"), ["key", "a"]).join(part("b"), ["key", "b"])
    new = new.select("key", F.col("a").alias("node"), size.alias("size"), "height", F.zip_with("x_a", "x_b", lambda p, q: (F.col("size_a") * p + F.col("size_b") * q) / size).alias("x"), F.lit(None).cast("long").alias("near"), F.lit(None).cast("double").alias("cost"))
    gone = stored(pairs.select("key", F.explode(F.array("a", "b")).alias("node"), F.lit(True).alias("gone")), "merged")
    rest = joined(light.drop("height"), gone, ["key", "node"], "node").filter("gone is null").drop("gone")
    rest = joined(rest, gone.withColumnRenamed("node", "near"), ["key", "near"], "node").select("key", "node", F.when(F.col("gone").isNull(), F.col("near")).alias("near"), F.when(F.col("gone").isNull(), F.col("cost")).alias("cost"))
    rest = state.drop("near", "cost").join(rest.hint("merge"), ["key", "node"]).select("key", "node", "size", "height", "x", "near", "cost")
    return stored(rest.union(new), "clusters"), pairs


def merged_speakers(df: DataFrame, key: str, id: str, vector: str, least: int = 1, most: int = 8, block: int = APART) -> DataFrame:
    """key, id, speaker, speakers: Ward's clusters of each key's segments, as many as ``speakers`` says, numbered by their first
    segment. Rows without a key, id or vector, or with an entry that is null or no finite number, are left out.

    Copies are merged first. Keys of more than ``block`` different segments are merged in rounds that are spread over tasks by pairs of
    blocks until so few are left (or a round merges under one in 200); what is left of a key is merged in a task. The work grows with the
    square of a key's segments; a task holds two blocks. The costliest merges of each key are then left out.
    """
    fine = F.forall(vector, lambda c: F.coalesce(c.cast("double").between(-1e100, 1e100), F.lit(False))) & (F.size(vector) > 0)
    rows = df.filter(F.col(key).isNotNull() & F.col(id).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(key).cast("string").alias("key"), F.col(id).cast("long").alias("id"), F.transform(vector, lambda c: c.cast("double")).alias("x"))
    rows = stored(rows.withColumn("node", F.row_number().over(Window.partitionBy("key").orderBy("id", "x")).cast("long")), "segments")
    length = F.greatest(V.norm(F.col("x")), F.lit(1e-300))
    flat = rows.select("key", length.alias("length"), F.posexplode("x").alias("i", "c")).withColumn("u", F.col("c") / F.col("length")).groupBy("key", "i").agg(F.sum("u").alias("s"), F.sum(F.col("u") * F.col("u")).alias("q"), F.count("*").alias("n"))
    wanted = F.udf(lambda n, square, own: speakers(n, square, own, least, most), "long")
    counts = stored(flat.groupBy("key").agg(F.max("n").alias("n"), F.sum(F.col("s") * F.col("s")).alias("square"), F.sum("q").alias("own")).select("key", wanted("n", "square", "own").alias("speakers")), "speakers")
    firsts = stored(rows.groupBy("key", "x").agg(F.min("node").alias("first"), F.count("*").cast("double").alias("size")), "copies")
    labels = stored(rows.select("key", "id", "node", "x").join(firsts.select("key", "x", "first").hint("merge"), ["key", "x"]).select("key", "id", "node", "first"), "firsts")
    done = [labels.filter("node <> first").select("key", F.col("first").alias("a"), F.col("node").alias("b"), F.lit(0.0).alias("height"))]
    state = firsts.select("key", F.col("first").alias("node"), "size", F.lit(0.0).alias("height"), "x", F.lit(None).cast("long").alias("near"), F.lit(None).cast("double").alias("cost"))
    left = stored(state.groupBy("key").count(), "left")
    apart, small = left.filter(F.col("count") > block), []
    while not apart.isEmpty():
        small.append(joined(state, apart.select("key", F.lit(True).alias("large")), ["key"], "node").filter("large is null").drop("large"))
        state, pairs = merged_once(joined(state, apart.select("key", F.lit(True).alias("large")), ["key"], "node").filter("large").drop("large"), block)
        done.append(pairs)
        left = stored(state.groupBy("key").count().join(pairs.groupBy("key").agg(F.count("*").alias("merged")), "key", "left"), "left")
        apart = left.filter((F.col("count") > block) & (F.coalesce("merged", F.lit(0)) * 200 >= F.col("count")))
    for part in small:
        state = state.union(part)

    def finish(table: pa.Table) -> pa.Table:
        height = table.sort_by("node")["height"].to_numpy().copy()
        a, b, height = merges(*(v.copy() for v in clusters_of(table)), height)
        return pa.table({"key": pa.array([table["key"][0].as_py()] * len(a), pa.string()), "a": a, "b": b, "height": height, "step": np.arange(len(a))})

    def rooted(table: pa.Table) -> pa.Table:
        table = table.sort_by("step")
        a, b = table["a"].to_numpy(), table["b"].to_numpy()
        node = np.unique(np.concatenate([a, b]))
        return pa.table({"key": pa.array([table["key"][0].as_py()] * len(node), pa.string()), "a": roots(node, a, b), "b": node})

    last = stored(state.select("key", "node", "size", "height", "x").groupBy("key").applyInArrow(finish, "key string, a long, b long, height double, step long"), "last_merges")
    every = last.withColumn("round", F.lit(len(done)))
    for number, pairs in enumerate(done):
        every = every.union(pairs.select("key", "a", "b", "height", F.lit(0).cast("long").alias("step"), F.lit(number).alias("round")))
    costly = Window.partitionBy("key").orderBy(F.desc("height"), F.desc("round"), F.desc("step"), F.desc("a"), F.desc("b"))
    # A merge is undone for each speaker but one: those that cost most, which are on top of all others.
    undone = joined(every.withColumn("rank", F.row_number().over(costly)).filter(F.col("rank") < most), counts, ["key"], "b").filter("rank < speakers")
    undone = stored(undone.select("key", "b", "round", F.lit(True).alias("undone")), "undone")
    out = labels.select("key", "id", F.col("node").alias("at"))
    for number, pairs in enumerate([*done, last]):
        kept = joined(pairs, undone.filter(F.col("round") == number).drop("round"), ["key", "b"], "b").filter("undone is null").drop("undone")
        kept = kept if number < len(done) else kept.groupBy("key").applyInArrow(rooted, "key string, a long, b long")
        kept = stored(kept.select("key", F.col("b").alias("at"), "a"), "kept")
        out = joined(out, kept, ["key", "at"], "id").select("key", "id", F.coalesce("a", "at").alias("at"))
    out = stored(out, "merged_rows")
    numbers = out.select("key", "at").distinct().withColumn("speaker", (F.row_number().over(Window.partitionBy("key").orderBy("at")) - 1).cast("long"))
    named = stored(numbers.join(counts.hint("merge"), "key"), "numbers")
    return joined(out, named, ["key", "at"], "id").select("key", "id", "speaker", "speakers")
