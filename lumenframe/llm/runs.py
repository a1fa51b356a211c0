"""Periodic runs of words: stretches that repeat a block of words, found in each text and collapsed to one copy.

1. Suffixes are ranked by doubling (all texts of a batch at once); only positions whose first words occur twice go on.
2. Neighbouring suffixes are united by decreasing length of their common prefix (Kruskal on the path of neighbours). A class
   keeps its positions in order; the smaller class goes into the larger one.
3. Two positions that become neighbours in a class at prefix length l and distance d <= l seed a stretch of period d and length
   d + l. If they still are neighbours when all of length l are united, d is its smallest period (a smaller one would put a
   position between them); if the words before them differ, no neighbouring word extends it. So each run is found once.

A text is worked on by one task, in about n log n steps of its n words; texts share nothing, so nothing is shuffled.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: A run has at least LEAST words and TIMES periods.
LEAST, TIMES = 6, 4
#: Positions in one block of an ordered set.
BLOCK = 2048
SCHEMA = "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def words_of(column: pa.Array) -> list[list[bytes]]:
    """Words between ASCII white space of each text, as UTF-8; null has none."""
    return [x.split() if x else [] for x in column.cast(pa.binary()).to_pylist()]


def ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of smaller keys of each key, and the size of its group of equals."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    size = np.diff(np.append(first, len(keys)))
    rank, group = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
    rank[order], group[order] = np.repeat(first, size), np.repeat(size, size)
    return rank, group


def suffix_neighbours(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, common words) of suffixes next to each other in the order of all suffixes of a text that share ``base`` words.

    ``begin`` and ``end`` hold each word's text.
    """
    here, wide = np.arange(len(ids)), len(ids) + 1

    def after(rank, at, step, end):
        inside = at + step < end
        return np.where(inside, rank[np.where(inside, at + step, at)] + 1, 0)

    rank, levels, length = ranks(ids)[0], [], 1
    text = np.cumsum(here == begin) - 1
    while length < base:
        levels.append((length, rank))
        step = min(length, base - length)
        keys = rank * wide + after(rank, here, step, end)
        length += step
        rank, group = ranks(keys + text * wide * wide if length == base else keys)
    if base == 1:
        rank, group = ranks(rank + text * wide)
    tied = np.flatnonzero(group > 1)
    own, first = tied, rank
    while len(tied):
        levels.append((length, rank))
        fine, group = ranks(rank[tied] * wide + after(rank, tied, length, end[tied]))
        coarse = np.sort(rank[tied])
        rank = rank.copy()
        # Tied positions fill whole groups of ranks, so the k-th of them in order takes its group's k-th place.
        rank[tied] += fine - np.searchsorted(coarse, rank[tied])
        tied, length = tied[group > 1], 2 * length
    own = own[np.argsort(rank[own])]
    i, j = own[:-1], own[1:]
    same = first[i] == first[j]
    i, j = i[same], j[same]
    x, y, stop = i.copy(), j.copy(), end[i]
    for length, rank in reversed(levels):
        inside = np.maximum(x, y) < stop
        step = length * (inside & (rank[np.where(inside, x, 0)] == rank[np.where(inside, y, 0)]))
        x, y = x + step, y + step
    return i, j, x - i


def put(blocks: list[list[int]], x: int) -> tuple[int, int]:
    """Insert into an ordered set; the neighbours on either side, -1 for none."""
    k = max(0, bisect_right(blocks, x, key=lambda b: b[0]) - 1) if len(blocks) > 1 else 0
    own = blocks[k]
    i = bisect_right(own, x)
    left = own[i - 1] if i else blocks[k - 1][-1] if k else -1
    right = own[i] if i < len(own) else blocks[k + 1][0] if k + 1 < len(blocks) else -1
    own.insert(i, x)
    if len(own) > BLOCK:
        blocks[k : k + 1] = [own[: BLOCK // 2], own[BLOCK // 2 :]]
    return left, right


def kruskal(places: list[int], left: list[int], right: list[int], shared: list[int], least: int, times: int) -> list[tuple[int, int, int]]:
    """(x, y, common words) that seed runs; edges come by decreasing ``shared``, ends are places' numbers in order."""
    parent, follows = list(range(len(places))), [-1] * len(places)
    classes: list[list[list[int]] | None] = [None] * len(places)
    sizes, found, fresh, edges = [1] * len(places), [], [], len(shared)

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for e in range(edges):
        words = shared[e]
        a, b = root(left[e]), root(right[e])
        if sizes[a] < sizes[b]:
            a, b = b, a
        parent[b] = a
        sizes[a] += sizes[b]
        own = classes[a] = classes[a] or [[a]]
        last = -1
        for block in classes[b] or [[b]]:
            for x in block:
                before, behind = put(own, x)
                if before >= 0:
                    follows[before] = x
                    d = places[x] - places[before]
                    # Two of the smaller class that stay neighbours have been so at a greater length.
                    if before != last and d * (times - 1) <= words and d + words >= least:
                        fresh.append((before, x))
                last = x
                if behind >= 0:
                    follows[x] = behind
                    d = places[behind] - places[x]
                    if d * (times - 1) <= words and d + words >= least:
                        fresh.append((x, behind))
        classes[b] = None
        if fresh and (e + 1 == edges or shared[e + 1] != words):
            found += [(x, y, words) for x, y in dict.fromkeys(fresh) if follows[x] == y]
            fresh = []
    return found


def find_runs(texts: list[np.ndarray], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """Rows (start, length, smallest period) of each text's runs, by start, then period; texts are whole numbers of words."""
    size = np.array([len(x) for x in texts], np.int64)
    none = [np.zeros((0, 3), np.int64)] * len(texts)
    if not size.sum():
        return none
    ids = np.concatenate(texts)
    begin = np.repeat(np.cumsum(size) - size, size)
    end = begin + np.repeat(size, size)
    base = max(1, min(max(least - q, (times - 1) * q) for q in range(1, max(least, 2))))
    i, j, shared = suffix_neighbours(ids, begin, end, base)
    if not len(i):
        return none
    order = np.argsort(-shared, kind="stable")
    places = np.unique(np.concatenate([i, j]))
    seeds = kruskal(places.tolist(), np.searchsorted(places, i[order]).tolist(), np.searchsorted(places, j[order]).tolist(), shared[order].tolist(), least, times)
    if not seeds:
        return none
    x, y, shared = np.array(seeds, np.int64).T
    x, y = places[x], places[y]
    ends = (x == begin[x]) | (ids[x - 1] != ids[y - 1])
    x, y, shared = x[ends], y[ends], shared[ends]
    rows = np.stack([x - begin[x], y - x + shared, y - x], 1)
    order = np.lexsort([y, x])
    cuts = np.searchsorted(x[order], np.cumsum(size)[:-1])
    return np.split(rows[order], cuts)


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period only."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def collapse(docs: DataFrame, *, least: int = LEAST, times: int = TIMES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, runs (start, length and smallest period in words, by start, then period) and the collapsed text of
    every row.

    A run has at least ``least`` words and ``times`` (2 or more) periods, and no neighbouring word extends it. A word is
    dropped if a run contains it after the run's first period; the rest are joined by one space. A null text has no words; an
    empty one neither. Rows that repeat an id, and rows without one, are worked on like all others. Other columns are not read.
    """
    if times < 2:
        raise ValueError("a run has two periods at least")

    def work(batch):
        texts, number = words_of(batch["text"]), defaultdict(count().__next__)
        ids = [np.fromiter(map(number.__getitem__, x), np.int64, len(x)) for x in texts]
        found, out = find_runs(ids, least, times), []
        for words, runs in zip(texts, found, strict=True):
            out.append(b" ".join(words if not len(runs) else [w for w, keep in zip(words, kept_words(len(words), runs).tolist(), strict=True) if keep]))
        rows = np.concatenate(found)
        pieces = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], ["start", "length", "period"])
        ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
        return {"doc_id": batch["doc_id"], "n_words": [len(x) for x in texts], "runs": pa.ListArray.from_arrays(pa.array(ends), pieces), "collapsed": pa.array(out, pa.binary()).cast(pa.utf8())}

    return common.mapped(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), SCHEMA, work)


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one text in ten is made periodic from some word on, as its id's crc32 says; words are joined by
    one space. A row without an id keeps its words."""

    def work(batch):
        out = []
        for i, words in zip(batch["doc_id"].to_pylist(), words_of(batch["text"]), strict=True):
            h, n = zlib.crc32(b"%d" % i) if i is not None else 1, len(words)
            if h % 10 == 0 and n:
                g = h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = words[:a] + [words[a + k % p] for k in range(n - a)]
            out.append(b" ".join(words))
        return {"doc_id": batch["doc_id"], "text": pa.array(out, pa.binary()).cast(pa.utf8())}

    return common.mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id long, text string", work)


def digests(found: DataFrame) -> DataFrame:
    """n_runs, the longest run (ties: least start, then period) and digests of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda x: F.struct(x["length"], (-x["start"]).alias("start"), (-x["period"]).alias("period"))))
    line = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")), F.lit("\n")))
    out = found.withColumn("x", longest).select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("x.start")).alias("start"), F.col("x.length").alias("length"), (-F.col("x.period")).alias("period"), F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.withColumn("exponent_milli", F.expr("1000 * length div period"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(collapse(with_repeats(common.table(spark, sf_dir, "documents"))))


OP11_SQL = r"""
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS x,
  xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda y, k: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) AS h FROM documents),
v AS (SELECT doc_id, x, len(x) AS n, h, h // 10 AS g FROM w),
u AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM v),
t AS MATERIALIZED (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM u),
s AS MATERIALIZED (SELECT doc_id, i, x[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS w FROM (SELECT *, unnest(range(n)) AS i FROM t)),
e AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.w = b.w AND a.i < b.i),
f AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
l AS (SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM f GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
r AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM l GROUP BY 1, 2, 3),
d AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
c AS (SELECT s.doc_id, string_agg(s.w, ' ' ORDER BY s.i) AS kept FROM s LEFT JOIN d ON s.doc_id = d.doc_id AND s.i = d.i WHERE d.i IS NULL GROUP BY 1),
b AS (SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(start, length, period), struct_pack(a := -length, b := start, c := period)) AS top, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM r GROUP BY 1)
SELECT t.doc_id, coalesce(b.n_runs, 0) AS n_runs, b.top.start AS start, b.top.length AS length, b.top.period AS period, 1000 * b.top.length // b.top.period AS exponent_milli,
  sha256(coalesce(b.lines, '')) AS runs_sha256, sha256(coalesce(c.kept, '')) AS collapsed_sha256
FROM t LEFT JOIN b ON t.doc_id = b.doc_id LEFT JOIN c ON t.doc_id = c.doc_id"""
