"""Near duplicates of embeddings against all pairs by brute force, by SQL, and on edge rows."""

from __future__ import annotations

import numpy as np
import pytest
from compare import oracle, same
from pyspark.sql import functions as F

from lumenframe.llm import queries, vectors


def brute(rows, least):
    """{vec_id: (links, least id reachable)} of rows (vec_id, vector, label) with ids that are not repeated."""
    fine = [(i, np.array(v, float), lab) for i, v, lab in rows if v is not None and lab is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    near = {i: [] for i, *_ in rows}
    for i, v, lab in fine:
        near[i] = [j for j, w, other in fine if i != j and lab == other and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= least]
    top = {i: i for i in near}
    for start in sorted(near):
        front = [start] if top[start] == start else []
        while front:
            i = front.pop()
            for j in near[i]:
                if top[j] > start:
                    top[j] = start
                    front.append(j)
    return {i: (len(near[i]), top[i]) for i in near}


def made(seed, n=900, dims=8):
    """Random vectors, chains of small steps, a large group of near copies, exact and scaled copies, of two labels."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    for k in range(60, 260):
        x[k] = x[k - 1] + 0.12 * rng.normal(size=dims) * np.linalg.norm(x[k - 1]) / np.sqrt(dims)
    x[300:500] = x[300] + 0.03 * rng.normal(size=(200, dims))
    x[500:530], x[530:540] = x[500], 3 * x[500]
    order = rng.permutation(n)
    return [(int(i), v.tolist(), int(k % 4 == 0)) for k, (i, v) in enumerate(zip(order, x, strict=True))]


@pytest.mark.parametrize(("cell", "block", "deal", "send"), [(2048, 2048, 16384, 100_000), (16, 24, 100, 100_000), (64, 16, 64, 0)])
def test_against_all_pairs(spark, monkeypatch, cell, block, deal, send):
    for name, value in (("CELL", cell), ("BLOCK", block), ("DEAL", deal), ("BROADCAST_MAX", send)):
        monkeypatch.setattr(vectors, name, value)
    rows = made(cell)
    for least in (0.98, 0.9):
        got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), least=least).collect()
        want = brute(rows, least)
        assert len(got) == len(rows) and {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got) and max(n for n, _ in want.values()) > 100


def test_bound_loses_no_link():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 4))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    home, visits = vectors.nearest(x, np.arange(20), x[:20], 0.5)
    near = np.linalg.norm(x[:, None] - x[None], axis=2) <= 0.5
    for i, j in zip(*np.nonzero(near), strict=True):
        assert (home[i] == home[j]) or (home[j] in visits[i]) != (home[i] in visits[j])
    assert np.mean([len(v) for v in visits]) < 8


def test_query_matches_sql(spark, sf):
    name = "op13_embedding_duplicates"
    rows = [r.asDict() for r in queries.QUERIES[name](spark, sf).collect()]
    assert not same(rows, oracle(queries.ORACLES[name], sf))


def test_edge_rows(spark):
    """Null, empty, zero and odd vectors, null labels and ids, repeated rows, ids with two vectors, extreme entries, no rows."""
    nan, inf = float("nan"), float("inf")
    schema = "vec_id long, embedding array<float>, label int, n_links string, space int"
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, [1.0, 0.0], 2), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (None, [1.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1), (12, [0.0, 1e-30], 1), (13, [0.0, 3e38], 1), (14, [-1.0, 0.0], 3), (14, [0.0, 1.0], 3), (15, [-0.0, 1.0], 3)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    got = vectors.near_duplicates(df).collect()
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] != 14}
    assert len(got) == len(rows)
    assert by[1] == (2, 1, True) and by[2] == (2, 1, False) and by[None] == (0, None, True)
    assert all(by[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11))
    assert by[12] == (1, 12, True) and by[13] == (1, 12, False) and by[15] == (1, 14, False)
    assert sorted((r["n_links"], r["component_id"]) for r in got if r["vec_id"] == 14) == [(0, 14), (1, 14)]
    assert vectors.near_duplicates(df.limit(0)).count() == 0
    one = vectors.near_duplicates(df.filter("vec_id = 1").withColumn("label", F.lit("a")))
    assert [tuple(r) for r in one.collect()] == [(1, 0, 1, True)]
    with pytest.raises(ValueError, match="least cosine"):
        vectors.near_duplicates(df, least=0)
