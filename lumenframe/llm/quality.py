"""Quality by nearest-neighbour voting on latent-semantic vectors.

Features of a text: hashed words, and hashed shapes (letter case, digits, marks) of words and of neighbouring words. Weighted
by document frequencies of all documents and projected on the leading directions of the labelled sample. Each document meets
every labelled vector in blocked cosine products; its nearest ones vote, weighted by the fourth power of similarity.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Labelled rows that are fitted and broadcast at most (4096 x 48 floats: 0.8 MB), hashed features of each kind, directions, voters.
SAMPLE, WIDTH, DIMS, VOTERS = 4096, 1024, 48, 15
THRESHOLD = 0.3
RUNS = re.compile(rb"(.)\1+", re.S)
SHAPE = bytes(ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b for b in range(256))
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def hashed(items: list[bytes]) -> np.ndarray:
    return (np.fromiter(map(xxhash.xxh3_64_intdigest, items), np.uint64, len(items)) % np.uint64(WIDTH)).astype(np.int64)


def counts(text: str) -> np.ndarray:
    """Counts of the 2 * WIDTH features of a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    out = np.zeros(2 * WIDTH, np.int64)
    if words := raw.translate(LOWER).split():
        out[:WIDTH] = np.bincount(hashed(words), minlength=WIDTH)
        shapes = RUNS.sub(rb"\1", raw.translate(SHAPE)).split(b" ")
        first = np.fromiter(map(xxhash.xxh3_64_intdigest, shapes), np.uint64, len(shapes))
        pairs = first[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ first[1:]
        lines = [x for x in raw.split(b"\n") if x.strip()]
        own = np.concatenate([first, pairs, np.full(len(lines) - len(set(lines)), 1, np.uint64)]) % np.uint64(WIDTH)
        out[WIDTH:] = np.bincount(own.astype(np.int64), minlength=WIDTH)
    return out


def weighted(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """log(1 + count) * idf, each kind of feature scaled to length 1."""
    x = np.log1p(rows).astype(np.float32) * idf
    for part in (x[:, :WIDTH], x[:, WIDTH:]):
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def directions(x: np.ndarray, dims: int = DIMS, rounds: int = 4, seed: int = 3) -> np.ndarray:
    """The leading right singular vectors of x, by power iteration on a random start."""
    q = np.random.default_rng(seed).standard_normal((x.shape[1], min(dims, *x.shape))).astype(np.float32)
    for _ in range(rounds):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    return q


def vote(rows: np.ndarray, voters: np.ndarray, labels: np.ndarray, prior: float, k: int = VOTERS) -> np.ndarray:
    """Mean label of the k nearest voters and of all that tie with the last of them, each weighted by the fourth power of its
    similarity; the prior where nothing is similar."""
    out, k = np.full(len(rows), prior), min(k, len(voters))
    if not k:
        return out
    for at in range(0, len(rows), 512):
        sim = rows[at : at + 512] @ voters.T
        least = np.partition(sim, len(voters) - k, axis=1)[:, len(voters) - k, None]
        row, near = np.nonzero(sim >= least)
        w = np.maximum(sim[row, near], 0).astype(np.float64) ** 4
        total, voted = np.bincount(row, w, len(sim)), np.bincount(row, w * labels[near], len(sim))
        out[at : at + 512] = np.where(total > 1e-12, voted / np.maximum(total, 1e-12), prior)
    return np.clip(out, 0, 1)


@dataclass
class Model:
    """Weights of features, directions, the labelled vectors on them, their labels, and the share of label 1."""

    idf: np.ndarray
    basis: np.ndarray
    voters: np.ndarray
    labels: np.ndarray
    prior: float


def prepared(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), (common.bucket(doc_id, 5) == 0).alias("held_out"))
    return docs.withColumn("held_out", F.col("held_out") & F.col("doc_id").isNotNull())


def fitted(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> Model:
    """Learned from labelled rows whose crc32(doc_id as text) mod 5 is not 0, SAMPLE of them at most (smallest hashes of their
    ids); document frequencies are those of all documents. Of clashing labels of an id the least counts, of clashing texts
    the first by order."""
    docs = prepared(docs, text, doc_id)
    known = labels.filter("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality")).filter(common.bucket("doc_id", 5) != 0)
    drawn = docs.filter("not held_out").select("doc_id").distinct().join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = docs.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "quality").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))

    def sparse(batch):
        rows = [counts(x) for x in common.texts(batch["text"])]
        at = [np.flatnonzero(r) for r in rows]
        return {"doc_id": batch["doc_id"], "quality": batch["quality"], "at": common.lists(at, pa.int32()), "n": common.lists([r[a] for r, a in zip(rows, at, strict=True)], pa.int32())}

    got = common.mapped(sample, "doc_id long, quality int, at array<int>, n array<int>", sparse).orderBy("doc_id").toArrow()
    x, y = np.zeros((got.num_rows, 2 * WIDTH), np.float32), got["quality"].to_numpy().astype(np.float64)
    for i, (at, n) in enumerate(zip(got["at"].to_pylist(), got["n"].to_pylist(), strict=True)):
        x[i, at] = n
    df = common.summed(docs.select("text"), 2 * WIDTH + 1, lambda batch: np.append(sum((counts(t) > 0).astype(np.int64) for t in common.texts(batch["text"])), batch.num_rows))
    idf = np.log((1 + df[-1]) / (1 + df[:-1])).astype(np.float32) + 0.1
    x = weighted(x, idf)
    basis = directions(x) if len(x) else np.zeros((2 * WIDTH, 1), np.float32)
    return Model(idf, basis, unit(x @ basis), y, float(y.mean()) if len(y) else 1.0)


def neighbour_quality(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every document.

    Without labelled rows, and for texts without words, the score is the learned share of label 1 (1 if there is none). A
    null text is empty; a null id is not held out; rows that repeat a text have equal scores; columns other than those
    named are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, text=text, doc_id=doc_id))

    def work(batch):
        m = model.value
        own = weighted(np.array([counts(t) for t in common.texts(batch["text"])]), m.idf)
        score = vote(unit(own @ m.basis), m.voters, m.labels, m.prior)
        return {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": score, "predicted": (score >= THRESHOLD).astype(np.int32)}

    return common.mapped(prepared(docs, text, doc_id), "doc_id long, held_out boolean, score double, predicted int", work)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_quality(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
