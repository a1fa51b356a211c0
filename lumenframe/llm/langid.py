"""Language id: averaged hashed subword embeddings and a linear softmax, trained by stochastic gradient descent in numpy.

A subword is a run of 2 to 4 bytes of a lower-cased text whose other characters than letters are word ends; a run may hold
a word end only first or last. A text's vector is the mean of its subwords' vectors, so the linear layer can be applied to
the table once and a text's logits are a mean of table rows. Rejection: probabilities are calibrated by a temperature on
rows that the training leaves out, and the least probability is taken at which those rows, and as many pieces of a language
that a second training has not seen, reach the wanted precision: a piece of an unseen language counts as wrong.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Training documents and pieces of them at most, hashed subwords, embedding size, words and characters of a piece, passes.
SAMPLE, PIECES, BUCKETS, DIM, PIECE, PIECE_CHARS, EPOCHS = 1500, 60_000, 1 << 15, 16, 12, 200, 3
#: Precision at the limit, and pieces that the trainings without a language take at most, all of them together.
PRECISION, UNSEEN = 0.98, 16_000
LETTER = regex.compile(r"\p{L}")
NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
UNDETERMINED = "und"


def subwords(text: str) -> np.ndarray:
    """Hashes of all subwords of a whole text."""
    raw = np.frombuffer((" " + NOT_LETTERS.sub(" ", text).strip() + " ").lower().encode("utf-8", "surrogatepass"), np.uint8)
    code, gap, out = raw.astype(np.uint32), raw == 32, []
    for n in (2, 3, 4):
        if len(code) >= n:
            h = np.full(len(code) - n + 1, n, np.uint32)
            for i in range(n):
                h = (h ^ code[i : len(code) - n + 1 + i]) * np.uint32(0x01000193)
            inner = np.zeros(len(h), bool)
            for i in range(1, n - 1):
                inner |= gap[i : len(code) - n + 1 + i]
            if n == 2:
                inner = gap[:-1] & gap[1:]
            out.append((h[~inner] ^ (h[~inner] >> np.uint32(15))) % np.uint32(BUCKETS))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def pieces(text: str) -> list[str]:
    """Parts of PIECE words of a whole text, of PIECE_CHARS characters at most."""
    words = text.split()
    rows = [" ".join(words[i : i + PIECE]) for i in range(0, len(words), PIECE)]
    return [row[k : k + PIECE_CHARS] for row in rows for k in range(0, len(row), PIECE_CHARS)]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def means(table: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
    """Mean of the table rows of each list of ids; 0 for an empty one."""
    out = np.zeros((len(ids), table.shape[1]))
    for i, x in enumerate(ids):
        if len(x):
            out[i] = np.bincount(x, minlength=len(table)) @ table / len(x) if len(x) > len(table) // 8 else table[x].mean(0)
    return out


def train(ids: list[np.ndarray], y: np.ndarray, classes: int, rate: float = 8.0, seed: int = 2) -> np.ndarray:
    """The table of logits: embeddings (BUCKETS, DIM) times weights (DIM, classes), by minibatch descent."""
    rng = np.random.default_rng(seed)
    table = (rng.standard_normal((BUCKETS, DIM)) / DIM).astype(np.float32)
    weights = (rng.standard_normal((DIM, classes)) / 4).astype(np.float32)
    share = np.bincount(y, minlength=classes) / len(y)
    steps, size = EPOCHS * -(-len(y) // 64), 64
    for step in range(steps):
        own = rng.choice(len(y), min(size, len(y)), replace=False)
        flat, n = np.concatenate([ids[i] for i in own]), np.array([len(ids[i]) for i in own])
        row = np.repeat(np.arange(len(own)), n)
        mean = np.stack([np.bincount(row, w, len(own)) for w in table[flat].T], 1) / n[:, None]
        wrong = softmax(mean @ weights)
        wrong[np.arange(len(own)), y[own]] -= 1
        wrong /= (share[y[own]] * classes)[:, None] * len(own)
        lr = rate * (1 - step / steps)
        back = (wrong @ weights.T / n[:, None]).astype(np.float32)
        weights -= lr * (mean.T @ wrong).astype(np.float32)
        np.subtract.at(table, flat, lr * 8 * back[row])
    return table @ weights


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss."""
    grid = np.geomspace(0.05, 5, 40)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def least_probability(best: np.ndarray, right: np.ndarray) -> float:
    """The least probability at which PRECISION of the rows at or above it are right."""
    order = np.argsort(-best, kind="stable")
    ok = np.flatnonzero(np.cumsum(right[order]) / np.arange(1, len(right) + 1) >= PRECISION)
    return float(best[order][ok[-1]]) if len(ok) else 1.0


@dataclass
class Model:
    """Logits of each subword, temperature, least probability, languages in order; no table where nothing could be learned."""

    table: np.ndarray | None
    temperature: float
    limit: float
    names: list[str]


def unseen(ids: list[np.ndarray], y: np.ndarray, classes: int, temperature: float) -> np.ndarray:
    """Best probabilities of pieces of each language under a training on the other ones."""
    own, out = slice(0, max(1, UNSEEN // classes)), []
    for c in range(classes if classes > 2 else 0):
        others = [i for i in range(len(y)) if y[i] != c][own]
        if len(others) and (there := [i for i in range(len(y)) if y[i] == c][own]):
            low = np.array([y[i] - (y[i] > c) for i in others])
            if len(set(low.tolist())) == classes - 1:
                table = train([ids[i] for i in others], low, classes - 1)
                out.append(softmax(means(table, [ids[i] for i in there]) / temperature).max(1))
    return np.concatenate(out) if out else np.zeros(0)


def prepared(docs: DataFrame, text: str, lang: str, doc_id: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), (common.bucket(doc_id, 3) == 1).alias("held_out"))


def fitted(docs: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """Learned from rows with a text and a language whose crc32(doc_id as text) mod 3 is not 1: SAMPLE documents at most, and
    PIECES pieces of their whole texts (smallest hashes), so that the driver gets a bounded number of bytes."""
    known = prepared(docs, text, lang, doc_id).filter("not held_out and text is not null and lang is not null")
    drawn = known.select("doc_id").filter("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)

    def cut(batch):
        rows = [(i, own, k, p) for i, own, t in zip(batch["doc_id"].to_pylist(), batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True) for k, p in enumerate(pieces(t))]
        return {k: [r[n] for r in rows] for n, k in enumerate(("doc_id", "lang", "k", "piece"))} if rows else None

    own = common.mapped(known.join(F.broadcast(drawn), "doc_id").select("doc_id", "lang", "text"), "doc_id long, lang string, k int, piece string", cut)
    own = own.orderBy(F.xxhash64("doc_id", "k"), "doc_id", "k", "lang", "piece").limit(PIECES).toArrow().sort_by([(c, "ascending") for c in ("doc_id", "k", "lang", "piece")])
    names = sorted(set(own["lang"].to_pylist()))
    code = {x: i for i, x in enumerate(names)}
    number = {i: k for k, i in enumerate(sorted(set(own["doc_id"].to_pylist())))}
    parts = [(subwords(p), code[x], number[i] % 5 == 0) for i, x, p in zip(own["doc_id"].to_pylist(), own["lang"].to_pylist(), own["piece"].to_pylist(), strict=True)]
    parts = [x for x in parts if len(x[0])]
    learned = [(x, y) for x, y, out in parts if not out]
    if not learned:
        return Model(None, 1.0, 1.0, names)
    ids, y = [x for x, _ in learned], np.array([y for _, y in learned])
    table, temperature, limit = train(ids, y, len(names)), 1.0, 1.0
    if left := [(x, y) for x, y, out in parts if out]:
        logits, truth = means(table, [x for x, _ in left]), np.array([y for _, y in left])
        temperature = calibrate(logits, truth)
        p = softmax(logits / temperature)
        own_best, foreign = p.max(1), unseen(ids, y, len(names), temperature)
        if len(foreign) > len(own_best):
            foreign = foreign[np.linspace(0, len(foreign) - 1, len(own_best)).astype(int)]
        limit = least_probability(np.concatenate([own_best, foreign]), np.concatenate([p.argmax(1) == truth, np.zeros(len(foreign), bool)]))
    return Model(table, temperature, limit, names)


def language(docs: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every document.

    ``und`` with score 0 if a text is null or has no letter, or if nothing could be learned; of equally likely languages
    the first by name; rejected marks a score below the calibrated limit. A null id is not held out; rows that repeat a
    text are judged alike; columns other than the three named are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, text=text, lang=lang, doc_id=doc_id))

    def work(batch):
        m = model.value
        own = [t if t and m.table is not None and LETTER.search(t) else None for t in batch["text"].to_pylist()]
        p = softmax(means(m.table, [subwords(t) if t else np.zeros(0, np.int64) for t in own]) / m.temperature) if m.table is not None else np.zeros((len(own), 1))
        score = np.where([t is not None for t in own], p.max(1), 0.0)
        pred = [m.names[k] if t else UNDETERMINED for t, k in zip(own, p.argmax(1), strict=True)]
        return {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": pred, "score": score, "rejected": score < m.limit}

    return common.mapped(prepared(docs, text, lang, doc_id).select("doc_id", "text", "held_out"), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean", work)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language(common.table(spark, sf_dir, "documents"))
