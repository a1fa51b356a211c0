"""Quality rules: an isolation forest on rule statistics, its threshold calibrated from labelled rows."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the forest sees: shares, so that a text's length alone is no anomaly.
SHARES = ("chars_per_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "mark_share", "bar_share", "distinct_share")
#: Labelled rows that the forest is drawn from at most, trees, rows and depth of a tree.
SAMPLE, TREES, ROWS, DEPTH = 4096, 128, 256, 10
#: Share of good labelled rows that the threshold may reject; cells of the score histogram.
REJECTS, CELLS = 0.002, 4096

SPACE = re.compile(r"[\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, shares array<float>"


def statistics(text: str) -> tuple[tuple[int, ...], list[float]]:
    """The base counts and the shares of one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    word_chars = len(text) - sum(map(len, SPACE.findall(text)))
    n_symbols = len(SYMBOLS.findall(text))
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    n_dup = len(lines) - len(set(lines))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    n_repeat = 0
    if n >= 3:
        windows = (hashes[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ hashes[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) ^ hashes[2:]
        order = np.argsort(windows, kind="stable")
        same = windows[order][1:] == windows[order][:-1]
        again = np.zeros(n - 2, bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        covered = np.zeros(n, bool)
        for i in range(3):
            covered[i : n - 2 + i] |= again
        n_repeat = int(covered.sum())
    letters, d = max(1, word_chars), max(1, n)
    upper = np.frombuffer(raw, np.uint8)
    shares = [word_chars / d, n_symbols / d, n_dup / max(1, len(lines)), n_repeat / d, float(((upper >= 65) & (upper <= 90)).sum()) / letters, text.count("!") / d, text.count("|") / d, len(np.unique(hashes)) / d]
    return (n, word_chars, n_symbols, n_dup, n_repeat), shares


def failed(n: int, repeat: int) -> bool:
    return n < 50 or 100 * repeat > 50 * n


def rule_statistics(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, the base counts, base_failed and the shares of each text; a null text has none of anything."""

    def work(batch):
        got = [statistics(x) for x in common.texts(batch["text"])]
        out = {k: [b[i] for b, _ in got] for i, k in enumerate(BASE)}
        return out | {"doc_id": batch["doc_id"], "base_failed": [failed(b[0], b[4]) for b, _ in got], "shares": common.lists([np.array(s, np.float32) for _, s in got], pa.float32())}

    return common.mapped(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), STATS, work)


@dataclass
class Forest:
    """Trees as arrays (tree, node): the share that splits, where, the left child (the right one follows), path length at a leaf."""

    share: np.ndarray
    at: np.ndarray
    left: np.ndarray
    length: np.ndarray
    depth: int
    usual: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / usual length): towards 1 for rows that few splits set apart."""
        trees, rows = np.arange(len(self.share))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.share)), np.int64)
        for _ in range(self.depth):
            right = x[rows, self.share[trees, node]] >= self.at[trees, node]
            left = self.left[trees, node]
            node = np.where(left < 0, node, left + right)
        return 2.0 ** -(self.length[trees, node].mean(1) / self.usual)


def usual_length(n: int) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grow(x: np.ndarray, span: np.ndarray, trees: int = TREES, rows: int = ROWS, depth: int = DEPTH, seed: int = 5) -> Forest:
    """Trees over samples of ``x``. Splits are drawn from a node's own range widened by ``span``, so that rows beyond all of
    ``x`` soon reach a leaf without rows, whose path is short."""
    rng, rows = np.random.default_rng(seed), min(rows, len(x))
    size, split = 2 ** (depth + 1), np.flatnonzero(span > 0)
    share, at = np.zeros((trees, size), np.int64), np.zeros((trees, size))
    left, length = np.full((trees, size), -1), np.zeros((trees, size))
    for t in range(trees):
        todo, used = [(0, x[rng.choice(len(x), rows, replace=False)], 0)], 1
        while todo:
            node, own, deep = todo.pop()
            if deep == depth or len(own) < 2 or not len(split):
                length[t, node] = deep + usual_length(len(own))
                continue
            f = rng.choice(split)
            cut = rng.uniform(own[:, f].min() - span[f], own[:, f].max() + span[f])
            share[t, node], at[t, node], left[t, node] = f, cut, used
            right = own[:, f] >= cut
            todo += [(used, own[~right], deep + 1), (used + 1, own[right], deep + 1)]
            used += 2
    return Forest(share, at, left, length, depth, max(usual_length(rows), 1e-9))


def as_matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(SHARES)).astype(np.float64)


def scored(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """The rows of ``stats`` with score, 0 where there is no forest."""
    kinds = STATS.replace("shares array<float>", "score double")
    model = stats.sparkSession.sparkContext.broadcast(forest)

    def work(batch):
        got = model.value.scores(as_matrix(batch["shares"])) if model.value else np.zeros(batch.num_rows)
        return {k: batch[k] for k in ("doc_id", "base_failed", *BASE)} | {"score": got}

    return common.mapped(stats, kinds, work)


def fit(stats: DataFrame, labels: DataFrame) -> tuple[Forest | None, float]:
    """A forest and the score from which a row is rejected.

    The forest is grown on the good ones of the SAMPLE labelled rows whose ids' hashes are smallest. The threshold takes all labelled rows
    that pass the base rules: of those that reject at most REJECTS of the good rows, the one that catches most bad rows
    for the fewest good ones. Without bad or good rows nothing is rejected. Of clashing labels of an id the least counts.
    """
    labels = labels.filter("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    known = stats.filter("not base_failed").join(labels, "doc_id")
    known = common.stored(known, "labelled")
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id", "shares").limit(SAMPLE).select("shares", "quality").toArrow()
    good = drawn["quality"].to_numpy() == 1
    if good.sum() < 2:
        return None, 2.0
    x = as_matrix(drawn["shares"].combine_chunks())
    forest = grow(x[good], np.ptp(x, axis=0) / 2)
    cells = scored(known, forest).join(known.select("doc_id", "quality").distinct(), "doc_id").groupBy(F.floor(F.col("score") * CELLS).alias("cell")).agg(F.sum(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("bad"), F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"))
    cells = cells.orderBy(F.col("cell").desc()).collect()  # CELLS rows at most
    bad, good = np.cumsum([r["bad"] for r in cells]), np.cumsum([r["good"] for r in cells])
    if not len(cells) or not bad[-1] or not good[-1]:
        return forest, 2.0
    worth = np.where(good <= REJECTS * good[-1], bad / bad[-1] - 5 * good / good[-1], -1)
    best = int(np.argmax(worth))
    return forest, cells[best]["cell"] / CELLS if worth[best] > 0 else 2.0


def rule_verdicts(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, base counts, base_failed, score and kept of every document.

    Null and empty texts have no words, so they fail the base rules; repeated rows get equal verdicts; an empty table gives
    none; columns other than the two named are not read.
    """
    stats = common.stored(rule_statistics(docs, text, doc_id), "rules")
    forest, threshold = fit(stats, labels)
    return scored(stats, forest).withColumn("kept", ~F.col("base_failed") & (F.col("score") < threshold))


def passing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, all columns, without a shuffle of their texts: null and empty texts go, rows that
    repeat a text are treated alike, and rows without an id are judged by their text."""
    forest, threshold = fit(common.stored(rule_statistics(docs), "rules"), labels)
    model = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        for batch in batches:
            got = [statistics(x) for x in common.texts(batch["text"])]
            if got:
                shares = np.array([s for _, s in got], np.float32).astype(np.float64)
                score = model.value.scores(shares) if model.value else np.zeros(len(got))
                yield batch.filter(pa.array([not failed(b[0], b[4]) and bool(s < threshold) for (b, _), s in zip(got, score, strict=True)]))

    return docs.mapInArrow(run, docs.schema)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rule_verdicts(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return out.select("doc_id", *BASE, "base_failed", "kept", "score")
