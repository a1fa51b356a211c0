"""Operators on small made-up rows: quantiles, resampling, payloads, folds, chunks."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumenframe.functions import lexicon as L
from lumenframe.operators import folds, series, similarity
from lumenframe.operators import payload as P
from lumenframe.operators import quantiles as Q


def test_quantiles(spark):
    rng = np.random.default_rng(1)
    groups = {"even": rng.normal(size=3001), "ties": np.repeat([1.0, 2.0, 2.0, 5.0], 500), "one": np.array([4.0]), "two": np.array([1.0, 2.0]), "skew": np.concatenate([np.zeros(2000), 10.0 ** rng.uniform(-9, 9, 1000)])}
    rows = [(k, float(v)) for k, xs in groups.items() for v in xs] + [("even", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    wanted = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["k"]: r for r in Q.grouped(df, ["k"], "v", wanted).collect()}
    again = {r["k"]: r for r in Q.ranked(df, ["k"], "v").groupBy("k").agg(*(Q.at("v", q).alias(n) for n, q in wanted.items())).collect()}
    assert set(got) == set(groups)
    for k, xs in groups.items():
        for n, q in wanted.items():
            assert got[k][n] == pytest.approx(np.percentile(xs, 100 * q), rel=1e-9, abs=1e-12) and again[k][n] == pytest.approx(got[k][n], rel=1e-9, abs=1e-12)
    assert again["none"]["p50"] is None and Q.grouped(df.limit(0), ["k"], "v", wanted).count() == 0


@pytest.mark.parametrize("length", [2, 5, 16])
def test_resampled(spark, length):
    series = {1: [3.0], 2: [1.0, 4.0], 3: [float(x * x) for x in range(11)], 4: [float(x % 3) for x in range(40)]}
    df = spark.createDataFrame([(k, i, v) for k, xs in series.items() for i, v in enumerate(xs)], "k long, i long, v double").withColumnRenamed("i", "at")
    got = {}
    for r in P.resampled(df, "k", ["at"], "v", length).collect():
        got.setdefault(r["k"], {})[r["i"]] = r["v"]
    for k, xs in series.items():
        want = np.interp(np.linspace(0, len(xs) - 1, length), range(len(xs)), xs)
        assert sorted(got[k]) == list(range(length)) and np.allclose([got[k][i] for i in range(length)], want)


def test_payload_arrays(spark):
    rows = [(1, ([1.0, float("nan"), 3.0, None], [True, False], "t", (5, [1, 2]))), (2, ([], [], None, None)), (3, ([float("inf")], None, None, (None, []))), (4, None)]
    df = spark.createDataFrame(rows, "k long, p struct<a: array<double>, b: array<boolean>, s: string, n: struct<x: long, l: array<long>>>")
    own = {(r["k"], r["feature"]): r["value"] for r in P.long_rows(df, ["k"], P.one_level("p", df.schema["p"].dataType, "c")).collect()}
    assert own[1, "c__a__mean"] == 2 and own[1, "c__a__std"] == 1 and own[1, "c__a__count"] == 2 and own[1, "c__b__mean"] == 0.5
    assert own[2, "c__a__empty"] == own[2, "c__b__empty"] == own[3, "c__a__all_non_finite"] == 1 and not any(k == 4 for k, _ in own)
    deep = {(r["k"], r["feature"]): r["value"] for r in P.long_rows(df, ["k"], P.leaves(F.col("p"), df.schema["p"].dataType, lists=True)).collect()}
    assert deep[1, "n.x"] == 5 and deep[1, "n.l"] == 1.5 and (3, "n.l") not in deep


def test_bursts_and_segments():
    assert list(folds.bursts(5.0, 3)([(t,) for t in (0, 1, 2, 3, 10, 11, 12, 13, 14, 15, 16)])) == [(2,)]
    assert list(folds.bounded_segments(1.0, 3.0)([(t,) for t in (0.0, 0.5, 1.0, 1.9, 2.8, 3.1, 9.0)])) == [(0.0, 2.8, 5), (3.1, 3.1, 1), (9.0, 9.0, 1)]


def chunked(sentences, most, share):
    """Overlap chunks, by the rule as it is stated."""
    chunks, held = [], []
    for s in sentences:
        words = s.split()
        if len(held) + len(words) > most:
            if held:
                chunks.append(held)
            tail = int(most * share)
            held = held[-tail:] if tail else []
        held = held + words
    return chunks + [held] if held else chunks


@pytest.mark.parametrize("most,share", [(3, 0.0), (10, 0.3), (40, 0.25)])
def test_overlap_chunks(spark, most, share):
    text = "One two three. Four five! Six seven eight nine ten eleven twelve? Thirteen. " * 7 + "no mark at the end"
    got = spark.createDataFrame([(text,), ("",)], "x string").select(L.overlap_chunks(L.marked_sentences(F.col("x")), most, share).alias("c")).collect()
    sentences = [s for s in re.split(r"(?<=[.!?]) ", text) if s]
    assert got[0]["c"] == chunked(sentences, most, share) and got[1]["c"] == []


def test_questions_emoji_and_captions(spark):
    rows = [("How to do it?", "\U0001f600\U0001f600☀"), ("however", "x"), ("Shocking! The best secret", ""), (None, None)]
    df = spark.createDataFrame(rows, "t string, e string")
    got = df.select(L.question_prefix(F.col("t")).alias("q"), L.clickbait(F.col("t")).alias("c"), L.diversity(F.regexp_extract_all("e", F.lit(L.EMOJI), F.lit(0))).alias("d"), L.trimmed(F.col("t")).alias("x")).collect()
    assert [r["q"] for r in got] == [True, False, False, None] and [r["d"] for r in got[:3]] == [pytest.approx(2 / 3), 0, 0]
    assert got[0]["c"] == pytest.approx(1 / 3) and got[2]["c"] == 1.0 and got[0]["x"] == "how to do it" and got[3]["x"] == ""
    cta = spark.createDataFrame([("subscribee",), ("please like it",), ("nothing",), ("",)], "x string").select(L.call_to_action(F.col("x")).alias("c")).collect()
    assert [r["c"] for r in cta] == [True, True, False, False]


def test_leaps(spark):
    rng = np.random.default_rng(2)
    rows = [(k, int(t)) for k in (3, -1, 7) for t in np.sort(rng.integers(0, 5000, 400 * (k > 0) + 1))] + [(None, 5), (3, None)]
    df = spark.createDataFrame(rows, "k long, t long").repartition(5)
    got = sorted((r["k"], r["t"], r["n"]) for r in series.leaps(df, "k", "t", 90).collect())
    want = []
    for k in (-1, 3, 7):
        kept = []
        for t in sorted(t for x, t in rows if x == k and t is not None):
            if not kept or t - kept[-1][1] >= 90:
                kept.append([k, t, 0])
            kept[-1][2] += 1
        want += [tuple(x) for x in kept]
    assert got == want and series.leaps(df.limit(0), "k", "t", 90).count() == 0


def test_best_lag_and_period(spark):
    rng = np.random.default_rng(3)
    values = {1: np.sin(np.arange(200) / 30 * 2 * np.pi), 2: rng.normal(size=37), 3: np.array([5.0]), 4: np.ones(9)}
    df = spark.createDataFrame([(k, i, float(v)) for k, xs in values.items() for i, v in enumerate(xs)], "k long, i long, v double")
    got = {r["k"]: (r["lag"], r["correlation"]) for r in series.best_lag(df, "k", ["i"], "v").collect()}
    for k in (1, 2):
        x = values[k] - values[k].mean()
        c = [float((x[lag:] * x[: len(x) - lag]).sum() / (x * x).sum()) for lag in range(1, len(x))]
        assert got[k][0] == int(np.argmax(c)) + 1 and got[k][1] == pytest.approx(max(c))
    assert 3 not in got and got[4][1] == 0.0
    daily = spark.createDataFrame([("a", h, 10 + round(5 * np.cos(h / 24 * 2 * np.pi))) for h in range(24 * 400)] + [("b", 7, 1)], "k string, h long, c long")
    rows = series.strongest_period(daily, "k", "h", "c", 0.1 / 24, 5 / 24).collect()
    assert [r["k"] for r in rows] == ["a"] and rows[0]["cycles"] == 400 and rows[0]["period"] == 24.0 and rows[0]["significance"] > 100


def test_spread_peaks_and_tracks():
    rng = np.random.default_rng(5)
    rows = sorted((int(t), float(v), i) for i, (t, v) in enumerate(zip(rng.integers(0, 3000, 150), rng.integers(0, 9, 150), strict=True)))
    kept = []
    for t, _, i in sorted(rows, key=lambda x: (-x[1], x[2])):
        if all(abs(t - u) >= 40 for u, _ in kept):
            kept.append((t, i))
    assert {i for (i,) in folds.spread_peaks(40)(rows)} == {i for _, i in kept}
    a, b = (0.0, 0.0, 10.0, 10.0), (50.0, 50.0, 60.0, 60.0)
    boxes = [(1, 0, *a), (2, 1, *b), (3, 2, *a), (4, 6, *a), (5, 7, 1.0, 1.0, 11.0, 11.0)]
    assert list(folds.tracked(0.3, 3)(boxes)) == [(1, 1), (2, 2), (3, 1), (4, 3), (5, 3)]
    found = list(folds.captions(0.6, 0.8)([(1, "sale now", *a), (2, "sale now!", *a), (3, "other", *a), (4, "sale now", *b)]))
    assert found == [(1, 0), (2, 0), (3, 1), (4, 2)]


def test_top_k_blocks(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 64)
    rng = np.random.default_rng(7)
    x = rng.standard_normal((300, 8)).astype(np.float32)
    x[10:20] = x[0]
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    got = {}
    for r in similarity.top_k(df.filter("vec_id % 7 = 0"), df, 5).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    u = x.astype(np.float64) / (np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True) + 1e-9)
    for q in range(0, 300, 7):
        near = sorted(((-round(float(u[q] @ u[i]), 12), i) for i in range(300) if i != q))[:5]
        assert [got[q][k + 1][0] for k in range(5)] == [i for _, i in near]


def test_grouped_quantiles_of_large_small_and_tied_groups(spark):
    """Linear quantiles of groups beyond the sketch's exact size, of few values, of one value, with ties and nulls."""
    rng = np.random.default_rng(3)
    groups = {"wide": rng.normal(size=60_000), "ties": rng.integers(0, 4, 30_000).astype(float), "skew": np.concatenate([np.zeros(20_000), rng.exponential(size=50) * 1e9]), "few": rng.normal(size=7), "one": np.array([2.5]), "edge": rng.normal(size=1_000)}
    pdf = pd.DataFrame([(k, v) for k, x in groups.items() for v in x.tolist()] + [("few", None), ("none", None)], columns=["k", "v"])
    df = spark.createDataFrame(pdf, "k string, v double").filter("not isnan(v)").union(spark.createDataFrame([("none", None)], "k string, v double"))
    wanted = {"p0": 0.0, "p1": 0.001, "p10": 0.1, "p50": 0.5, "p999": 0.999, "p100": 1.0}
    got = {r["k"]: r for r in Q.grouped(df.repartition(6), ["k"], "v", wanted).collect()}
    assert set(got) == set(groups)
    for k, x in groups.items():
        for name, q in wanted.items():
            low, high = np.sort(x)[int(np.floor(q * (len(x) - 1)))], np.sort(x)[int(np.ceil(q * (len(x) - 1)))]
            want = low if low == high else np.quantile(x, q)
            assert got[k][name] == want or abs(got[k][name] - want) <= 1e-9 * max(1.0, abs(want)), (k, name)


def test_quantiles_between_equal_and_close_values(spark):
    """A place between equal values has their value, and others are as the SQL engine has them, to the last bit."""
    import duckdb

    rng = np.random.default_rng(3)
    groups = {k: np.round(rng.exponential(50, n), 2) for k, n in enumerate(range(2, 60))} | {100 + k: np.abs(np.round(rng.exponential(2, n), 1) - 0.3) for k, n in enumerate(range(2, 160))}
    rows = [(k, float(v)) for k, xs in groups.items() for v in xs]
    df = spark.createDataFrame(rows, "k int, v double")
    wanted = {"p20": 0.2, "p75": 0.75, "p85": 0.85, "p90": 0.9}
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest(?::INT[]) AS k, unnest(?::DOUBLE[]) AS v", [[k for k, _ in rows], [v for _, v in rows]])
    want = {x[0]: x[1:] for x in con.execute(f"SELECT k, {', '.join(f'quantile_cont(v, {q})' for q in wanted.values())} FROM t GROUP BY k").fetchall()}
    for got in (Q.grouped(df, ["k"], "v", wanted), Q.ranked(df, ["k"], "v").groupBy("k").agg(*(Q.at("v", q).alias(n) for n, q in wanted.items())), Q.beside(df, ["k"], "v", wanted).drop("v").distinct()):
        assert {r["k"]: tuple(r[n] for n in wanted) for r in got.collect()} == want


def test_rates_of_close_times(spark):
    """Steps of a few microseconds are exact, far from 1970 too."""
    from lumenframe.operators import timeline as T

    df = spark.sql("SELECT 1 AS k, timestamp_micros(1704067211172425 + 1107 * i) AS ts, double(i * i) AS v, i FROM (SELECT explode(sequence(0, 40)) AS i)")
    got = {r["i"]: r["rate"] for r in T.rates(df, "k", ["ts"], "v", 1e-6).collect()}
    assert got == {i: (2 * i - 1) / (1107 / 1e6) for i in range(1, 41)}


@pytest.mark.parametrize("rows", [50, 1000])
def test_more_rows_are_more_tasks(spark, rows, monkeypatch):
    """Sequences are placed in tasks of a stated number of rows, whatever the session's number of partitions."""
    from lumenframe.operators import ranges, sequences

    monkeypatch.setattr(sequences, "spread", lambda df, keys: ranges.spread(df, keys, rows))
    df = spark.range(1000).selectExpr("id % 100 AS k", "id AS i", "CASE WHEN id % 3 = 0 THEN id * 1.0 END AS score")
    placed = sequences.placed(df, "k", ["i"], "score")
    assert placed.rdd.getNumPartitions() == 1000 // rows
    assert placed.filter("_i <> floor(i / 100) OR _n <> 10").isEmpty() and placed.count() == 1000


def test_manifest_table_is_shuffled_once(spark, sf):
    """One shuffle by run, of a number of tasks that follows the rows, serves all its rollups."""
    from lumenframe.plans.catalogue import QUERIES

    plan = QUERIES["p6_manifest_table"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "REPARTITION_BY_NUM" in plan


def test_topics_take_words_once(spark, sf):
    """Texts are read and cut into words once."""
    from lumenframe.plans.catalogue import QUERIES

    plan = QUERIES["a39_topics"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Generate explode") == 1


def test_pairs_of_blocks_are_groups(spark, sf):
    """A worker gets one pair of blocks at a time, not a batch of all that a task has."""
    from lumenframe.plans.catalogue import QUERIES

    plan = QUERIES["v4_top_k"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("FlatMapGroupsInArrow") < plan.index("MapInArrow", plan.index("CartesianProduct") if "CartesianProduct" in plan else plan.index("NestedLoop"))
