"""Whitening against brute force in whole numbers and numpy, and on edge rows."""

from __future__ import annotations

import math

import numpy as np

from lumenframe.llm import queries, whitening


def brute(vectors):
    """x of each usable vector, n, sums and the covariance of the distinct ones, in Python's whole numbers."""
    xs = [tuple(math.floor(256 * float(c)) for c in v) for v in vectors]
    fit = sorted(set(xs))
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dims)]
    cov = [[sum((n * x[d] - sums[d]) * (n * x[e] - sums[e]) for x in fit) / n**3 for e in range(dims)] for d in range(dims)]
    return xs, n, sums, np.array(cov)


def check(rows, ids, vectors, components=4, error=1e-9):
    xs, n, sums, cov = brute(vectors)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == len(ids) * min(components, len(sums))
    for k in range(min(components, len(sums))):
        want = np.array([[x[d] - sums[d] / n for d in range(len(sums))] for x in xs]) @ axes[:, k] / np.sqrt(values[k])
        have = np.array([got[i, k + 1]["whitened"] for i in ids])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-6
    for i, x in zip(ids, xs, strict=True):
        r = got[i, 1]
        assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        assert abs(r["explained"] / (values[0] / np.trace(cov)) - 1) < 1e-9 and r["identity_error"] < error


def test_whitening_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    check(queries.QUERIES["op12_whitening"](spark, sf).collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_bit_planes_against_products():
    rng = np.random.default_rng(3)
    y = rng.integers(0, [1, 2, 9, 300, 2**20], (1000, 5)).astype(np.uint64)
    bits = [int(c.max()).bit_length() for c in y.T]
    counts = whitening.common_bits(whitening.planes(y, bits))
    of, place = np.repeat(np.arange(5), bits), np.concatenate([np.arange(b) for b in bits])
    got = np.zeros((5, 5), np.int64)
    for p in range(len(counts)):
        for q in range(p, len(counts)):
            got[of[p], of[q]] += counts[p, q] * (1 << (place[p] + place[q])) * (2 if of[p] == of[q] and p != q else 1)
    assert (got == np.triu(y.astype(np.int64).T @ y.astype(np.int64))).all()


def test_whitening_edge_rows(spark):
    """Nulls, non-finite entries, odd lengths, repeats, large entries, many rows on few partitions, extra columns, no rows."""
    rng = np.random.default_rng(5)
    good = [(i, v.tolist(), "z") for i, v in enumerate(rng.normal(0, [0.1, 3, 40, 1e4, 1], (300, 5)))]
    good += [(1000 + i, v, "z") for i, (_, v, _) in enumerate(good[:40])]
    bad = [(2000, None, "z"), (2001, [], "z"), (2002, [1.0, None, 1.0, 1.0, 1.0], "z"), (2003, [1.0, float("nan"), 1.0, 1.0, 1.0], None), (2004, [1.0, 2.0], "z"), (2005, [1e30, 1.0, 1.0, 1.0, 1.0], "z"), (2006, [float("inf")] * 5, "z")]
    schema = "vec_id long, embedding array<double>, whitened string"
    df = spark.createDataFrame(good + bad, schema)
    check(whitening.whiten(df).collect(), [i for i, _, _ in good], [v for _, v, _ in good], error=1e-6)
    assert whitening.whiten(spark.createDataFrame(bad[:4], schema)).count() == 0 and whitening.whiten(df.limit(0)).count() == 0
    same = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0], ""), (7, [1.0, 2.0], "")], schema)).collect()
    assert len(same) == 4 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 and r["n"] == 1 for r in same)
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i], "") for i in range(50)], schema)).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line) and {r["identity_error"] < 1e-9 for r in line} == {True}


def test_whitening_is_exact_beyond_64_bits(spark):
    """Deviations of large entries are exact decimals; the thin query's long is null where it does not fit."""
    rng = np.random.default_rng(6)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, [3e9, 1e9], (40, 2)))]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    check(whitening.whiten(df).collect(), [i for i, _ in vectors], [v for _, v in vectors])
