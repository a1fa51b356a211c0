"""Neighbour graphs, density clusters, k-means, principal components and merged segments against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from lumenframe.operators import clusters as C
from lumenframe.operators import density as D
from lumenframe.operators import nearest as N
from lumenframe.operators import ranges
from lumenframe.operators import similarity as S
from lumenframe.plans.catalogue import QUERIES


def test_similar_rows_recall(spark, sf):
    """Recall of the ten best against the exact search of all rows."""
    got = {(r["query_id"], r["vec_id"]) for r in QUERIES["v5_similar_rows"](spark, sf).collect()}
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    want = {(r["query_id"], r["vec_id"]) for r in S.top_k(df.filter("vec_id % 50 = 0"), df, 10).collect()}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_graph_recall_without_a_pass_over_all(spark):
    """Clustered vectors in several shards: recall of 0.9 at least while most of a shard is not looked at; scores are cosines."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 24))[rng.integers(0, 60, 9000)] + 0.4 * rng.normal(size=(9000, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").repartition(8)
    index = N.build(df, "id", "v", shard=5000, degree=12, choice=40)
    got = N.search(index, df.filter("id % 50 = 0"), "id", "v", 10, beam=40).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 9000, 50):
        sim = u @ u[q]
        sim[q] = -9
        own = [r for r in got if r["query_id"] == q]
        hits += len({r["id"] for r in own} & set(np.argsort(-sim)[:10].tolist()))
        assert [r["rank"] for r in sorted(own, key=lambda r: -r["score"])] == list(range(1, 11)) and all(abs(r["score"] - sim[r["id"]]) < 1e-5 for r in own)
    assert index.count() == 2 and hits >= 0.9 * 1800 and np.mean([r["looked"] for r in got]) < 0.35 * 4500


def test_graph_edge_rows(spark, tmp_path):
    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, None), (4, [0.0, 0.0]), (None, [1.0, 0.0]), (5, [float("nan"), 1.0]), (6, [])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    index = N.build(df, "id", "v", path=f"file://{tmp_path}/index")
    got = {(r["query_id"], r["id"]): r["score"] for r in N.search(index, df.filter("id = 1"), "id", "v", 5).collect()}
    assert set(got) == {(1, 2), (1, 4)} and got[1, 4] == 0 and abs(got[1, 2] - 0.9 / np.hypot(0.9, 0.1)) < 1e-6
    assert N.search(N.build(df.filter("id = 2"), "id", "v"), df.filter("id = 1"), "id", "v", 5).count() == 1
    assert N.search(N.build(df.limit(0), "id", "v"), df, "id", "v", 5).count() == 0


def brute_density(x, eps, least):
    """Labels by walking from each core in order; a row that is no core stays with the first cluster that reaches it."""
    near = [[j for j in range(len(x)) if ((x[i] - x[j]) ** 2).sum() <= eps * eps] for i in range(len(x))]
    core, label, n = [len(a) >= least for a in near], [-1] * len(x), 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            front, label[i] = [i], n
            while front:
                for j in near[front.pop()]:
                    if label[j] < 0:
                        label[j] = n
                        if core[j]:
                            front.append(j)
            n += 1
    return label


@pytest.mark.parametrize(("block", "dims"), [(2048, 2), (20, 2), (20, 4)])
def test_density_against_brute_force(spark, block, dims):
    rng = np.random.default_rng(block + dims)
    keys = {"a": rng.normal(size=(300, dims)), "b": np.repeat(rng.normal(size=(5, dims)), 30, axis=0) + 0.05 * rng.normal(size=(150, dims)), "c": np.zeros((1, dims))}
    rows = [(k, i, v.tolist()) for k, x in keys.items() for i, v in enumerate(x)]
    df = spark.createDataFrame([*rows, ("a", 900, None), (None, 1, [0.0] * dims), ("c", 7, [float("nan")] * dims)], "k string, i long, v array<double>")
    got = {(r["k"], r["i"]): r["cluster"] for r in D.dbscan(df, "k", "i", "v", 0.3, 4, block).collect()}
    for k, x in keys.items():
        assert [got[k, i] for i in range(len(x))] == brute_density(x, 0.3, 4)
    assert len(got) == len(rows) + 3 and got["a", 900] == got[None, 1] == got["c", 7] == -1 and max(got.values()) >= 2
    assert D.dbscan(df.limit(0), "k", "i", "v", 0.3, 4).count() == 0


def test_components_of_chains_and_hubs(spark, monkeypatch):
    monkeypatch.setattr(ranges, "BROADCAST_MAX", 0)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(500, 499)]
    got = {r["node"]: r["component"] for r in ranges.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 499: 499, 500: 499}
    assert ranges.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_kmeans(ids, x, k, rounds=50, tolerance=1e-4):
    centres = []
    for step in range(k):
        far = np.min([((x - c) ** 2).sum(1) for c in centres], axis=0) if centres else np.ones(len(x))
        time = np.where(far > 0, -np.log(C.drawn(ids, step)) / np.where(far > 0, far, 1), np.inf)
        if np.isfinite(time).any():
            centres.append(x[np.argmin(time)])
    c = np.array(centres)
    for _ in range(rounds):
        own = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        new = np.array([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        moves, c = ((new - c) ** 2).sum(), new
        if moves <= tolerance * x.var(0).mean():
            break
    return ((x[:, None] - c) ** 2).sum(2).argmin(1)


def test_kmeans_against_brute_force(spark):
    rng = np.random.default_rng(2)
    keys = {"a": rng.normal(size=(2500, 3)), "b": rng.normal(size=(40, 3)), "c": np.ones((6, 3)), "d": np.array([[1.0], [2.0], [9.0]])}
    df = spark.createDataFrame([(k, i, v.tolist()) for k, x in keys.items() for i, v in enumerate(x)] + [("b", 99, None), (None, 1, [1.0])], "k string, i long, v array<double>")
    got = {(r["key"], r["id"]): r["cluster"] for r in C.kmeans(C.blocks_of(df, "k", "i", "v", 256), 4).collect()}
    assert len(got) == sum(map(len, keys.values()))
    for k, x in keys.items():
        assert [got[k, i] for i in range(len(x))] == brute_kmeans(np.arange(len(x)), x, 4).tolist()
    assert C.kmeans(C.blocks_of(df.limit(0), "k", "i", "v"), 4).count() == 0
    few = C.kmeans(C.blocks_of(df.filter("k in ('b', 'd')"), "k", "i", "v"), 4, of_key=spark.createDataFrame([("b", 4), ("d", 2)], "key string, k int")).collect()
    assert [r["cluster"] for r in sorted(few) if r["key"] == "d"] == brute_kmeans(np.arange(3), keys["d"], 2).tolist()


def test_kmeans_of_whole_keys_takes_no_rounds_by_shuffle(spark, monkeypatch):
    """Many keys of one block, with ties, level values and fewer different ones than clusters, write no more tables than one key does."""
    rng, written, stored = np.random.default_rng(7), [], C.stored
    keys = {f"k{i}": np.round(rng.normal(size=(int(rng.integers(1, 60)), 1)) * 20, 1) for i in range(150)} | {"level": np.full((41, 1), 0.1), "wide": rng.normal(size=(30, 2))}
    df = spark.createDataFrame([(k, i, v.tolist()) for k, x in keys.items() for i, v in enumerate(x)], "k string, i long, v array<double>").repartition(5)
    blocks = C.blocks_of(df, "k", "i", "v")
    monkeypatch.setattr(C, "TOGETHER", 500, raising=False)
    monkeypatch.setattr(C, "stored", lambda df, what: written.append(what) or stored(df, what))
    got = {}
    for r in C.kmeans(blocks, 5).orderBy("key", "id").collect():
        got.setdefault(r["key"], []).append(r["cluster"])
    assert len(written) <= 2 and set(got) == set(keys)
    for k, x in keys.items():
        assert got[k] == brute_kmeans(np.arange(len(x)), x, 5).tolist()


def test_rounds_of_level_values_end(spark, monkeypatch):
    """A key of equal values, whose sums of squares round below 0, does not keep all keys at work for 50 rounds."""
    written, stored = [], C.stored
    df = spark.createDataFrame([("a", i, [v]) for i, v in enumerate([0.7] * 11)] + [("b", i, [v]) for i, v in enumerate([1.0, 2.0, 9.0])], "k string, i long, v array<double>")
    blocks = C.blocks_of(df, "k", "i", "v", 4)
    assert blocks.groupBy("key").count().filter("key = 'a' and count > 1").count() == 1
    monkeypatch.setattr(C, "stored", lambda df, what: written.append(what) or stored(df, what))
    got = C.kmeans(blocks, 2).collect()
    assert len(written) < 20 and {r["cluster"] for r in got if r["key"] == "a"} == {0} and len(got) == 14
    again = C.kmeans(blocks, 2, vectors=True).collect()
    assert sorted(r[:3] for r in again) == sorted(got) and all(r["x"] == [0.7 if r["key"] == "a" else (1.0, 2.0, 9.0)[r["id"]]] for r in again)


def test_segments_of_values_that_are_no_numbers(spark, tmp_path):
    """Users with a null, a NaN or an infinite value get equal runs."""
    values = {1: [1.0] * 5 + [float("nan")] + [2.0] * 6, 2: [None] + [3.0] * 10, 3: [5.0, 5.0, float("inf"), *[9.0] * 9], 4: [1.0] * 9, None: [1.0] * 12, 5: [0.7] * 30}
    rows = [(100 * (u or 0) + i, i, u, v) for u, xs in values.items() for i, v in enumerate(xs)]
    spark.createDataFrame(rows, "event_id long, s long, user_id long, value double").selectExpr("event_id", "timestamp_seconds(s) AS ts", "user_id", "value").write.parquet(f"{tmp_path}/events.parquet")
    got = {}
    for r in QUERIES["e18_temporal_segments"](spark, str(tmp_path)).orderBy("user_id", "start_frame").collect():
        got.setdefault(r["user_id"], []).append((r["start_frame"], r["end_frame"], r["method"]))
    even = lambda n: [(i * (n // 5), (i + 1) * (n // 5) if i < 4 else n, "uniform") for i in range(5)]
    assert got == {1: even(12), 2: even(11), 3: even(12), 5: [(0, 30, "kmeans")]}


def test_blocks_go_on_over_batches(spark):
    """Blocks hold each row once, in order, wherever the batches they are packed from end."""
    rows = [(k, i, [float(i), k / 7]) for k in range(9) for i in range(5 * k + 1)]
    df = spark.createDataFrame(rows, "k long, i long, v array<double>").repartition(3)
    for most in ("1", "7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
        try:
            got = [(r["key"], r["block"], *C.opened(r["ids"], r["x"])) for r in C.blocks_of(df, "k", "i", "v", 16).collect()]
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert len({r[:2] for r in got}) == len(got) and all((np.diff(ids) > 0).all() for _, _, ids, _ in got)
        assert sorted((int(k), i, v) for k, _, ids, x in got for i, v in zip(ids.tolist(), x.tolist(), strict=True)) == rows
    assert C.blocks_of(df.limit(0), "k", "i", "v").count() == 0


def test_components_of_blocks_against_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 6)) * [9, 5, 3, 2, 1, 0.5] + 1e6
    df = spark.createDataFrame([(1, i, v.tolist()) for i, v in enumerate(x)] + [(2, i, [float(i), 2.0 * i]) for i in range(2)], "k long, i long, v array<double>")
    rows = [C.opened(r["ids"], r["x"]) for r in C.principal(C.blocks_of(df, "k", "i", "v", 64), 4).filter("key = 1").collect()]
    got = np.concatenate([r[1] for r in rows])[np.argsort(np.concatenate([r[0] for r in rows]))]
    v = np.linalg.eigh(np.cov((x - x.mean(0)).T))[1][:, ::-1][:, :4]
    want = (x - x.mean(0)) @ v
    assert got.shape == (700, 4) and (np.minimum(np.abs(got - want).max(0), np.abs(got + want).max(0)) < 1e-6).all()


def test_label_runs_against_brute_force(spark, sf):
    """The whole chain of one label in numpy: components, clusters, runs."""
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").filter("label = 3").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    v = np.linalg.eigh(np.cov((x - x.mean(0)).T))[1][:, ::-1][:, :32]
    label = brute_kmeans(ids, (x - x.mean(0)) @ v, 5)
    runs = np.diff(np.flatnonzero(np.concatenate([[True], np.diff(label) != 0, [True]])))
    got = QUERIES["v25_label_runs"](spark, sf).filter("label = 3").first()
    assert got["switches"] == len(runs) - 1 and abs(got["stability"] - runs.max() / len(x)) < 1e-6


def test_temporal_segments_against_brute_force(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").orderBy("user_id", "ts", "event_id").collect()
    got = {}
    for r in QUERIES["e18_temporal_segments"](spark, sf).collect():
        got.setdefault(r["user_id"], []).append((r["start_frame"], r["end_frame"], r["length_frames"], r["mean"], r["std"]))
    users = {r["user_id"] for r in events}
    for user in users:
        x = np.array([[r["value"]] for r in events if r["user_id"] == user])
        if len(x) < 10:
            assert user not in got
            continue
        label = brute_kmeans(np.arange(len(x)), x, 5)
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(label) != 0, [True]]))
        want = [(a, b, b - a, x[a:b].mean(), x[a:b].std()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        assert np.allclose(sorted(got[user]), want, atol=1e-5)


def brute_ward(x, k):
    own = [[i] for i in range(len(x))]
    while len(own) > k:
        cost = {(a, b): len(p) * len(q) / (len(p) + len(q)) * ((x[p].mean(0) - x[q].mean(0)) ** 2).sum() for a, p in enumerate(own) for b, q in enumerate(own) if a < b}
        a, b = min(cost, key=cost.get)
        own[a] += own[b]
        del own[b]
    out = np.zeros(len(x), int)
    for j, rows in enumerate(sorted(own, key=min)):
        out[rows] = j
    return out


def test_ward_against_brute_force(spark, sf):
    rng = np.random.default_rng(4)
    for _ in range(20):
        x = rng.normal(size=(rng.integers(1, 30), 3))
        k = int(rng.integers(1, 5))
        assert (C.ward(x, k) == brute_ward(x, k)).all()
    assert C.ward(np.zeros((6, 2)), 2).max() == 1
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    got = {r["vec_id"]: r for r in QUERIES["v30_merged_speakers"](spark, sf).collect()}
    own = [r for r in rows if r["label"] == 2]
    x = np.array([r["embedding"] for r in own], np.float64)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    far = 1 - (u @ u.T)[np.triu_indices(len(u), 1)].mean()
    k = 3 if far > 0.32 else 2 if far > 0.24 else 1
    assert len(got) == len(rows) and [got[r["vec_id"]]["speaker"] for r in own] == brute_ward(x, k).tolist() and got[own[0]["vec_id"]]["speakers"] == k


def test_ward_of_keys_of_many_blocks(spark):
    """Rounds of blocks give what one task gives, with copies, far pairs that merge early, repeated ids and vectors that are none."""
    rng = np.random.default_rng(6)
    apart = lambda *at: np.concatenate([rng.normal(size=(40, 3)) + 50 * np.array(p) for p in at])
    far = np.concatenate([apart((1, 0, 0), (1, 0.1, 0)), [[0, 900, 0], [0, 940, 0]]])
    keys = {1: apart((1, 0, 0), (0, 1, 0), (0, 0, 1)), 2: np.repeat(apart((1, 0, 0), (0, -1, 0)), 3, axis=0), 3: far, 4: np.ones((50, 3)), 5: rng.normal(size=(110, 3))}
    rows = [(k, i, x.tolist()) for k, xs in keys.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame([*rows, (1, 500, [1.0, None, 0.0]), (1, 501, [1.0, float("nan"), 0.0]), (1, 502, None), (7, 1, [1.0, 0.0, 0.0]), (7, 1, [0.0, 1.0, 0.0]), (7, 1, [0.0, 0.0, 1.0])], "k int, id long, v array<double>")
    got = {}
    for r in C.merged_speakers(df, "k", "id", "v", 3, block=70).orderBy("key", "id").collect():
        got.setdefault(int(r["key"]), []).append(r["speaker"])
    for k, x in keys.items():
        assert got[k] == C.ward(x, 3).tolist()
    for k in (1, 3):
        assert got[k] == brute_ward(keys[k], 3).tolist()
    assert sorted(got[7]) == [0, 1, 2] and set(got) == {*keys, 7}


@pytest.mark.parametrize("hot", [5, 1000])
def test_large_tables_are_joined_by_shuffle(spark, hot):
    """Beyond the stated size a table is not sent to the tasks, whatever its file's size, and only hot keys are copied to pieces."""
    from lumenframe.operators import ranges

    big = spark.range(400).selectExpr("id AS row", "if(id % 2 = 0, 0, id % 50) AS k")
    small = ranges.stored(spark.range(0, 40).selectExpr("id AS k", "id * 3 AS v"), "small_table")
    got = ranges.joined(big, small, ["k"], "row", 10, hot)
    rows = {r["row"]: r["v"] for r in got.collect()}
    assert rows == {i: (k * 3 if (k := 0 if i % 2 == 0 else i % 50) < 40 else None) for i in range(400)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan.split("Join LeftOuter")[1].splitlines()[0]


def test_self_similarity_of_many_blocks(spark):
    """Blocks, copies and keys of one row give what a matrix of all pairs gives."""
    rng = np.random.default_rng(5)
    keys = {1: rng.normal(size=(90, 6)), 2: np.repeat(rng.normal(size=(4, 6)), 10, axis=0), 3: rng.normal(size=(1, 6)), 4: rng.normal(size=(2, 6))}
    rows = [(k, 1000 * k + i, x.tolist()) for k, xs in keys.items() for i, x in enumerate(xs)]
    got = {r["k"]: r for r in S.self_similarity(spark.createDataFrame(rows, "k int, id long, v array<double>"), "k", "id", "v", 0.5, 16).collect()}
    for k, x in keys.items():
        x = x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)
        sim = x @ x.T
        pairs = sim[np.triu_indices(len(x), 1)]
        np.fill_diagonal(sim, -np.inf)
        want = ((sim.max(axis=1) >= 0.5).mean(), *((pairs.mean(), np.percentile(pairs, 95)) if len(pairs) else (None, None)))
        assert got[k]["n"] == len(x)
        assert all(a == b if b is None else a == pytest.approx(b, rel=1e-9) for a, b in zip((got[k][c] for c in ("repetition", "mean", "p95")), want, strict=True))
