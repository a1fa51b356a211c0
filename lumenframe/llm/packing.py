"""Packing by lexical retrieval: each seed document's window is filled with its nearest unused neighbours of a BM25 index.

The units are pieces of at most a window. A document's full windows are sequences of their own; the index is of the rests. It
is sharded: rests are dealt by their rarest id, so that related texts meet, and rests of a frequent one by a hash of document
and place, so that no id makes a large shard. A shard has about SHARD rests and its own inverted index, which a seed of the
shard asks with all its distinct ids; the frequencies and the mean length in its weights are those of all pieces of all
documents. The shards depend on the texts and ids alone, and rests of a shard are in the order of their documents, so
results do not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .tokens import N_IDS, encoded

WINDOW, SHARD = 4096, 2048
#: BM25's constants, and the share of a shard's rests from which an id's weights are a dense row.
K1, B, DENSE = 1.2, 0.75, 1 / 8
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def terms_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids in order, and their counts; 16 bits hold an id, which sorts in linear time."""
    x = np.sort(ids.astype(np.uint16), kind="stable")
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[at].astype(np.int64), np.diff(np.append(at, len(x)))


class Index:
    """An inverted index of a shard's rests: postings of each id, ids of many rests as rows of a matrix, and each rest's query."""

    def __init__(self, ids: list[np.ndarray], df: np.ndarray, n: int, mean: float):
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        self.size, pieces, tf = len(ids), [], []
        self.queries = []
        for k, x in enumerate(ids):
            t, c = terms_of(x)
            self.queries.append(t)
            pieces.append(np.full(len(t), k, np.int32))
            tf.append(c / (c + K1 * (1 - B + B * len(x) / mean)) * (K1 + 1))
        terms = np.concatenate(self.queries)
        order = np.argsort(terms.astype(np.uint16), kind="stable")
        terms, self.pieces = terms[order], np.concatenate(pieces)[order]
        self.weight = np.concatenate(tf)[order] * idf[terms]
        self.at = np.searchsorted(terms, np.arange(N_IDS + 1))
        held = np.diff(self.at)
        often = np.flatnonzero(held > max(16, DENSE * self.size))
        self.row = np.full(N_IDS, -1)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), self.size), np.float32)
        for r, t in enumerate(often):
            own = slice(self.at[t], self.at[t + 1])
            self.dense[r, self.pieces[own]] = self.weight[own]

    def scores(self, seed: int) -> np.ndarray:
        """Score of every rest for all distinct ids of a seed."""
        t = self.queries[seed]
        row = self.row[t]
        asked = np.zeros(len(self.dense), np.float32)
        asked[row[row >= 0]] = 1
        t = t[row < 0]
        start, n = self.at[t], self.at[t + 1] - self.at[t]
        at = np.arange(n.sum()) + np.repeat(start - np.cumsum(n) + n, n)
        return np.bincount(self.pieces[at], self.weight[at], self.size) + asked @ self.dense


def fill(ids: list[np.ndarray], df: np.ndarray, n: int, mean: float) -> list[list[tuple[int, int, int]]]:
    """Sequences of (rest, from, length). Seeds are taken in order; each window takes its seed's unused neighbours, best
    first (of equal ones the earlier), then the next unused rests; the last is cut where the window ends, its end stays for
    later."""
    index = Index(ids, df, n, mean)
    size = np.array([len(x) for x in ids])
    done, out, seed = np.zeros(len(ids), np.int64), [], 0
    while seed < len(ids):
        if done[seed] >= size[seed]:
            seed += 1
            continue
        score = index.scores(seed)
        score[done >= size] = 0
        score[seed] = 0
        near = np.flatnonzero(score)
        near = near[np.argsort(-score[near], kind="stable")]
        row, room = [], WINDOW
        for k in itertools.chain([seed], near.tolist(), range(seed + 1, len(ids))):
            take = min(room, int(size[k] - done[k]))
            if take > 0:
                row.append((k, int(done[k]), take))
                done[k] += take
                room -= take
                if not room:
                    break
        out.append(row)
    return out


def pack(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Full windows of a long document are sequences of their own; only its rest goes to a shard. Every shard has at most one
    sequence that is not full. A null text is an empty one (its end id alone), repeated rows are packed each, an empty
    table gives no pieces, a text of any length is cut as a whole, and columns other than the two named are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def cut(batch):
        """Pieces of at most a window; a rest's term is its greatest id, which the vocabulary learned last."""
        out = {k: [] for k in ("doc_id", "start", "doc_tokens", "ids_crc32", "term")}
        parts = []
        for i, x in zip(batch["doc_id"].to_pylist(), encoded(batch, vocabulary), strict=True):
            for a in range(0, len(x), WINDOW):
                part = x[a : a + WINDOW]
                for k, v in zip(out, (i, a, len(x), zlib.crc32(part), -1 if len(part) == WINDOW else int(part.max())), strict=True):
                    out[k].append(v)
                parts.append(part)
        return out | {"tokens": pa.array([x.astype("<u2").tobytes() for x in parts], pa.binary())}

    pieces = common.stored(common.mapped(rows, "doc_id long, start long, doc_tokens long, ids_crc32 long, term int, tokens binary", cut), "pieces")

    def spread(batch):
        """In how many pieces each id is, then pieces and tokens."""
        own = ids_of(batch["tokens"])
        seen = np.concatenate([terms_of(x)[0] for x in own])
        return np.append(np.bincount(seen, minlength=N_IDS), [len(own), sum(map(len, own))])

    got = common.summed(pieces.select("tokens"), N_IDS + 2, spread)
    n, mean = max(1, int(got[-2])), max(1.0, got[-1] / max(1, got[-2]))
    frequencies = spark.sparkContext.broadcast(got[:N_IDS])
    kinds = common.arrow_schema(spark, PIECES)

    def whole(batches):
        done, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            number = (np.int64(part) << 32) + done + np.arange(batch.num_rows)
            done += batch.num_rows
            yield common.batch_of({"doc_id": batch["doc_id"], "start": batch["start"], "length": np.full(batch.num_rows, WINDOW), "ids_crc32": batch["ids_crc32"], "doc_tokens": batch["doc_tokens"], "sequence_id": 2 * number + 1, "offset": np.zeros(batch.num_rows, np.int64)}, kinds)

    def shards(batches):
        """Shards of a task, which come in order; an overfull one is cut after each 2 * SHARD rests, whatever the batches."""
        held, size, now, done = [], 0, None, 0
        for batch in filter(len, batches):
            ends = np.flatnonzero(np.diff(batch["shard"].to_numpy())) + 1
            for a, b in zip([0, *ends.tolist()], [*ends.tolist(), batch.num_rows], strict=True):
                number = batch["shard"][a].as_py()
                if number != now:
                    if held:
                        yield shard(pa.Table.from_batches(held), now, done)
                    held, size, now, done = [], 0, number, 0
                while a < b:
                    take = min(b - a, 2 * SHARD - size)
                    held.append(batch.slice(a, take))
                    a, size = a + take, size + take
                    if size == 2 * SHARD:
                        yield shard(pa.Table.from_batches(held), now, done)
                        held, size, done = [], 0, done + size
        if held:
            yield shard(pa.Table.from_batches(held), now, done)

    def shard(rests, number, done):
        """A shard's pieces; it has no more sequences than rests, so ``done`` rests before it keep its numbers apart."""
        own = ids_of(rests["tokens"])
        ids, start, total = (rests[k].to_pylist() for k in ("doc_id", "start", "doc_tokens"))
        out = {k.name: [] for k in kinds}
        for s, row in enumerate(fill(own, frequencies.value, n, mean)):
            offset = 0
            for k, a, size in row:
                for name, v in zip(out, (ids[k], start[k] + a, size, common.crc(own[k][a : a + size]), total[k], 2 * ((number << 32) + done + s), offset), strict=True):
                    out[name].append(v)
                offset += size
        return common.batch_of(out, kinds)

    full = pieces.filter("term < 0").select("doc_id", "start", "doc_tokens", "ids_crc32").mapInArrow(whole, PIECES)
    rest = pieces.filter("term >= 0")
    terms = np.zeros(N_IDS, np.int64)
    for r in rest.groupBy("term").count().collect():  # N_IDS rows at most
        terms[r["term"]] = r["count"]
    count = max(1, -(-int(terms.sum()) // SHARD))
    place = spark.createDataFrame([(int(t), int(a), int(k)) for t, a, k in zip(np.flatnonzero(terms), (np.cumsum(terms) - terms)[terms > 0], terms[terms > 0], strict=True)], "term int, before long, of_term long")
    number = F.floor((F.col("before") + F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("of_term"))) / SHARD).cast("long").alias("shard")
    rest = rest.join(F.broadcast(place), "term").select(number, "doc_id", "start", "doc_tokens", "ids_crc32", "tokens")
    rest = rest.repartition(count, "shard").sortWithinPartitions("shard", "doc_id", "start", "ids_crc32").mapInArrow(shards, PIECES)
    return full.union(rest)


def ids_of(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), "<u2") for x in column]


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))
