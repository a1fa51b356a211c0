"""Near duplicates by min-max hashing: of each permutation the least and the greatest value are kept.

80 permutations give 160 values, half the hash evaluations of plain MinHash. 16 bands of 5 least values and 16 of 5
greatest find a pair of similarity 0.8 but for 3 in a million; candidates are confirmed on their full shingle sets.

1. Equal sets are one class, named by their digest; only classes go on, so exact copies never make pairs.
2. In each bucket of a band, all members are compared with one pivot alone (a star, not all pairs).
3. Connected components of the confirmed links; where members of a bucket are still in different components, the sets of
   all that share its pivot are multiplied block by block, so that no link is lost and no pair is a row. Sets of the
   pivot's own component meet the others only.

Joins on keys that may be hot (buckets, pivots, hubs of a component, copies of one text) deal such keys over many tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

PERMUTATIONS, ROWS = 80, 5
#: Rows and bytes of shingles of a block; a task holds two blocks.
BLOCK, BLOCK_BYTES = 128, 4 << 20
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def multipliers(n: int, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


MIX, FOLD = multipliers(PERMUTATIONS), multipliers(ROWS, 11)
STEP = multipliers(16, 13)


def words_of(text: str) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space, with A-Z in lower case."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of the whole sequence if it is shorter; none without words."""
    w = words_of(text)
    size = min(size, len(w)) or 1
    if not len(w):
        return w
    out = np.full(len(w) - size + 1, size, np.uint64)
    for i in range(size):
        out = (out ^ w[i : len(w) - size + 1 + i]) * STEP[i % len(STEP)]
        out ^= out >> np.uint64(29)
    return np.unique(out)


def bands(shingle_set: np.ndarray) -> np.ndarray:
    """One key per band: bands of least values, then of greatest ones."""
    low, high = np.empty(PERMUTATIONS, np.uint64), np.empty(PERMUTATIONS, np.uint64)
    step = max(1, (1 << 20) // PERMUTATIONS)
    for at in range(0, len(shingle_set), step):
        values = shingle_set[None, at : at + step] * MIX[:, None]
        a, b = values.min(1), values.max(1)
        low, high = (a, b) if not at else (np.minimum(low, a), np.maximum(high, b))
    rows = np.concatenate([low, high]).reshape(-1, ROWS)
    rows = (rows ^ (rows >> np.uint64(31))) * FOLD
    keys = rows.sum(1, dtype=np.uint64) + np.arange(len(rows), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (keys ^ (keys >> np.uint64(32))).view(np.int64)


def features(docs: DataFrame, size: int, least: int) -> DataFrame:
    """n_shingles, digest of the set, its bands where it has ``least`` shingles, and the other columns of ``docs``."""
    none = np.zeros(0, np.int64)
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]

    def work(batch):
        sets = [shingles(x, size) for x in common.texts(batch["text"])]
        return {k: batch[k] for k in batch.schema.names} | {"n_shingles": [len(s) for s in sets], "digest": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), "bands": common.lists([bands(s) if len(s) >= least else none for s in sets], pa.int64())}

    return common.mapped(docs, ", ".join([*own, "n_shingles long, digest binary, bands array<long>"]), work)


def shingle_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """digest and shingles of the documents in ``ids``: their texts move once, by id. An id's texts are all taken."""
    own = docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi").withColumn("h", F.xxhash64("text")).dropDuplicates(["doc_id", "h"])

    def work(batch):
        sets = [shingles(x, size).tobytes() for x in common.texts(batch["text"])]
        return {"digest": pa.array([xxhash.xxh3_128_digest(x) for x in sets], pa.binary()), "shingles": pa.array(sets, pa.binary())}

    return common.stored(common.mapped(own.select("text"), "digest binary, shingles binary", work), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (digest, pivot), as a and b, whose full sets have 100 * intersection >= percent * union."""
    of_pivot = common.stored(pairs.groupBy("pivot").agg(F.count("*").alias("rows")), "star_sizes")
    both = pairs.join(sets.select("digest", F.col("shingles").alias("set_a")).hint("merge"), "digest")
    right = sets.select(F.col("digest").alias("pivot"), F.col("shingles").alias("set_b"))
    both = common.spread_join(both, right, "pivot", "digest", of_pivot)

    def work(batch):
        keep = []
        for x, y in zip(batch["set_a"].to_pylist(), batch["set_b"].to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            inter = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * inter >= percent * (len(x) + len(y) - inter))
        mask = pa.array(keep)
        return {"a": batch["digest"].filter(mask), "b": batch["pivot"].filter(mask)}

    return common.mapped(both.select("digest", "pivot", "set_a", "set_b"), "a binary, b binary", work)


def pivoted(members: DataFrame) -> DataFrame:
    """The rows of buckets with each bucket's pivot: the member that shares most buckets with most others, so the middle of
    a group of near copies is the pivot in all of the group's buckets; of equal ones that of the greatest digest."""
    weight = members.groupBy("digest").agg(F.sum("members").alias("weight"))
    pivots = members.join(weight, "digest").groupBy("band").agg(F.max(F.struct("weight", "digest", "n")).alias("x"), F.count("*").alias("rows"))
    pivots = common.stored(pivots.select("band", F.col("x.digest").alias("pivot"), F.col("x.n").alias("pivot_n"), "rows"), "bucket_pivots")
    return common.stored(common.spread_join(members, pivots.drop("rows"), "band", "digest", pivots), "pivots")


def stars(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (digest, pivot) of each bucket's pivot with its other members, where sizes allow a link."""
    return members.filter("digest <> pivot").filter(fits("n", "pivot_n", percent)).select("digest", "pivot").distinct()


def families(members: DataFrame, parts: DataFrame) -> DataFrame:
    """pivot, digest, n and part (component) of all members of a pivot's buckets that hold several components."""
    own = members.filter("members > 2").join(parts, "digest", "left").select("band", "digest", "n", "pivot", F.coalesce("component", "digest").alias("part"))
    mixed = own.groupBy("band").agg(F.min("part").alias("x"), F.max("part").alias("y"), F.count("*").alias("rows")).filter("x <> y").select("band", "rows")
    mixed = common.stored(mixed, "mixed")
    return common.stored(common.spread_join(own, mixed.select("band"), "band", "digest", mixed).select("pivot", "digest", "n", "part").distinct(), "families")


def within_families(family: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of different components of a family, one for each two components of a block.

    The members in the pivot's component and the rest are dealt to blocks of about BLOCK rows and BLOCK_BYTES each; blocks of
    the rest meet all others. A task holds two blocks and counts their intersections as products of matrices, so pairs are
    never rows.
    """
    own = family.groupBy("pivot", "part").agg(F.count("*").alias("c"), F.sum("n").alias("s"), F.max(F.when(F.col("digest") == F.col("pivot"), F.col("part"))).alias("main"))
    blocks = lambda which: F.greatest(F.ceil(F.coalesce(F.sum(F.when(which, F.col("c"))), F.lit(0)) / BLOCK), F.ceil(F.coalesce(F.sum(F.when(which, F.col("s"))), F.lit(0)) * 8 / BLOCK_BYTES)).cast("int")
    dealt = own.groupBy("pivot").agg(F.sum("c").alias("rows"), blocks(F.col("main").isNotNull()).alias("mains"), blocks(F.col("main").isNull()).alias("rests"), F.max("main").alias("main"))
    dealt = common.stored(dealt, "blocks")
    rows = common.spread_join(family, dealt.drop("rows"), "pivot", "digest", dealt)
    rows = rows.join(sets.hint("merge"), "digest").withColumn("is_main", F.coalesce(F.col("part") == F.col("main"), F.lit(False)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("digest"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("rests"))).cast("int"))
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    pair = lambda x, y: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"))
    mine = F.col("own")
    of_main = F.transform(upto("rests"), lambda r: pair(r, -1 - mine))
    of_rest = F.concat(F.transform(upto("mains"), lambda m: pair(mine, -1 - m)), F.transform(upto("rests"), lambda r: pair(F.least(mine, r), F.greatest(mine, r))))
    rows = rows.withColumn("at", F.explode(F.when(F.col("is_main"), of_main).otherwise(of_rest)))

    def links(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table["digest"].to_pylist()
        part = np.unique(np.array(table["part"].to_pylist(), "V16").view("S16"), return_inverse=True)[1]
        own_sets = [np.frombuffer(x.as_py(), np.uint64) for x in table["shingles"]]
        size = np.array([len(x) for x in own_sets])
        flat, row = np.concatenate(own_sets), np.repeat(np.arange(len(ids)), size)
        _, col, n = np.unique(flat, return_inverse=True, return_counts=True)
        shared = np.cumsum(n > 1) - 1
        keep = n[col] > 1
        row, col = row[keep], shared[col[keep]]
        inter, width = np.zeros((len(ids), len(ids)), np.float32), int((n > 1).sum())
        for at in range(0, width, 4096):
            here = (col >= at) & (col < at + 4096)
            part_of = np.zeros((len(ids), min(4096, width - at)), np.float32)
            part_of[row[here], col[here] - at] = 1
            inter += part_of @ part_of.T
        linked = (100 * inter >= percent * (size[:, None] + size[None, :] - inter)) & (part[:, None] < part[None, :])
        i, j = np.nonzero(linked)
        _, first = np.unique(np.stack([part[i], part[j]]), axis=1, return_index=True) if len(i) else (None, np.zeros(0, np.int64))
        return pa.table({"a": pa.array([ids[k] for k in i[first]], pa.binary()), "b": pa.array([ids[k] for k in j[first]], pa.binary())})

    return rows.select("pivot", "at.x", "at.y", "digest", "part", "shingles").groupBy("pivot", "x", "y").applyInArrow(links, "a binary, b binary")


def fits(x: str, y: str, percent: int) -> Column:
    """Whether sets of these sizes can be linked."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def components(links: DataFrame) -> DataFrame:
    """node, component (least node reachable) of all nodes in the links (a, b): alternating large and small stars.

    Each round is written to the shared folder; only a count and a checksum come to the driver.
    """

    def stored(df):
        edges = common.stored(df.filter("a <> b").distinct(), "links")
        return edges, edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    def to_least(df, n):
        """The rows with m, the least of all that their a is linked with."""
        least = df.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("rows"))
        return common.spread_join(df, least.drop("rows"), "a", "b", least, n)

    edges, state = stored(links.select("a", "b"))
    while True:
        large = to_least(edges.union(edges.select("b", "a")), 2 * state[0]).filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
        large, (n, _) = stored(large)
        small = to_least(large, n)
        small = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        edges, now = stored(small)
        if now == state:
            break
        state = now
    found = edges.groupBy("a").agg(F.min("b").alias("component"))
    return found.select(F.col("a").alias("digest"), "component").union(found.select("component", "component").distinct())


def near_duplicates(docs: DataFrame, *, size: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and the columns ``carry`` of every row of ``docs``.

    Two texts are linked if their sets of ``size``-word shingles have 100 * intersection >= percent * union; component_id
    is the smallest id reachable, kept marks the rows with that id (and of them those of one set, where the id repeats with
    different texts). A text without words has an empty set and is linked with nothing; a null text is empty. A null id has
    a null component and is kept. Rows that repeat an id with its text are marked alike; rows that share an id but not a
    text are linked by their own texts. Columns other than those named are not read.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *carry)
    # Different sets that are linked have a union of `smallest` shingles at least, and a smaller set of one fewer.
    smallest = -(-100 // (100 - percent)) if percent < 100 else 1 << 30
    rows = common.stored(features(docs, size, smallest - 1), "features")
    classes = rows.filter("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.count("*").alias("rows"))
    classes = common.stored(classes, "classes")
    members = classes.select("digest", "n", F.explode("bands").alias("band"))
    several = common.stored(members.groupBy("band").agg(F.count("*").alias("rows")).filter("rows > 1"), "bands")
    members = common.stored(common.spread_join(members, several.select("band", F.col("rows").alias("members")), "band", "digest", several), "buckets")
    met = classes.select("digest", "id").join(members.select("digest").distinct(), "digest", "left_semi")
    sets = shingle_sets(docs, met.select(F.col("id").alias("doc_id")).distinct(), size)
    members = pivoted(members)
    links = common.stored(confirmed(common.stored(stars(members, percent), "star"), sets, percent), "confirmed")
    parts = common.stored(components(links), "parts")
    family = families(members, parts)
    if not family.isEmpty():
        more = common.stored(within_families(family, sets, percent), "more")
        if not more.isEmpty():
            parts = common.stored(components(links.union(more)), "parts")

    linked = parts.join(classes.select("digest", "id"), "digest")
    tops = linked.groupBy("component").agg(F.min(F.struct("id", "digest")).alias("x"), F.count("*").alias("rows"))
    tops = common.stored(tops.select("component", F.col("x.id").alias("top_id"), F.col("x.digest").alias("top"), "rows"), "tops")
    linked = common.spread_join(linked.select("digest", "component"), tops.drop("rows"), "component", "digest", tops).drop("component")
    of_class = classes.select("digest", "id", "rows").join(linked, "digest", "left")
    of_class = common.stored(of_class.select("digest", "rows", F.coalesce("top_id", "id").alias("component_id"), F.coalesce("top", "digest").alias("top")), "class_components")
    own = rows.drop("bands")
    inside = F.col("n_shingles") > 0
    out = common.spread_join(own.filter(inside & F.col("doc_id").isNotNull()), of_class.drop("rows"), "digest", "doc_id", of_class)
    out = out.select("doc_id", "n_shingles", "component_id", ((F.col("doc_id") == F.col("component_id")) & (F.col("digest") == F.col("top"))).alias("kept"), *carry)
    return out.union(own.filter(~(inside & F.col("doc_id").isNotNull())).select("doc_id", "n_shingles", "doc_id", F.lit(True), *carry))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), size=2, percent=80)
