"""Periodic runs against their definition, by brute force and by SQL."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from compare import oracle, same

from lumenframe.llm import queries, runs


def brute_runs(words, least, times):
    """All maximal stretches of each period; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, times * q) and i > start:
                found.setdefault((start, i - start + q), q)
            i += i == start
    return sorted((s, n, q) for (s, n), q in found.items())


@pytest.mark.parametrize(("least", "times"), [(6, 4), (2, 2), (9, 3)])
def test_runs_against_brute_force(least, times):
    rng = random.Random(least)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            words = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 60))]
            p = rng.randint(1, 9)
            texts.append([words[i % p if i > len(words) // 3 else i] for i in range(len(words))] if len(words) > p and rng.random() < 0.5 else words)
        for words, got in zip(texts, runs.find_runs([np.array(x, np.int64) for x in texts], least, times), strict=True):
            assert sorted(map(tuple, got.tolist())) == sorted(brute_runs(words, least, times))


def test_runs_of_large_classes():
    """Classes of more positions than a block of an ordered set holds."""
    words = np.zeros(5 * runs.BLOCK + 1, np.int64)
    words[3 * runs.BLOCK] = 1
    assert runs.find_runs([words])[0].tolist() == [[0, 3 * runs.BLOCK, 1], [3 * runs.BLOCK + 1, 2 * runs.BLOCK, 1]]
    fib = [0]
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    fib = b[:900]
    assert sorted(map(tuple, runs.find_runs([np.array(fib)], 2, 2)[0].tolist())) == sorted(brute_runs(fib, 2, 2))


def test_runs_query(spark, sf):
    rows = [r.asDict() for r in queries.QUERIES["op11_periodic_runs"](spark, sf).collect()]
    assert not same(rows, oracle(queries.ORACLES["op11_periodic_runs"], sf)) and sum(r["n_runs"] > 0 for r in rows) > 5


def test_runs_edge_rows(spark):
    """Null, empty and very long texts, repeated rows, rows without an id, extra columns, ties, empty tables."""
    schema = "doc_id long, text string, runs string, n_words int, start long"
    say = "a b " * 5
    rows = [(1, None, "x", 1, None), (2, "", None, 1, 1), (3, " \t\n ", "x", 1, 1), (4, say + "c " + say, "x", 1, 1), (4, say + "c " + say, "x", 1, 1), (None, "na " * 9 + "héé x", "x", None, 1), (5, "w " * 30_000, "x", 1, 1)]
    got = runs.collapse(spark.createDataFrame(rows, schema)).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and [by[i]["n_words"] for i in (1, 2, 3)] == [0, 0, 0] and by[1]["collapsed"] == "" and by[3]["runs"] == []
    assert [tuple(x) for x in by[4]["runs"]] == [(0, 10, 2), (11, 10, 2)] and by[4]["collapsed"] == "a b c a b"
    assert by[None]["collapsed"] == "na héé x" and by[5]["collapsed"] == "w" and tuple(by[5]["runs"][0]) == (0, 30_000, 1)
    top = {r["doc_id"]: r for r in runs.digests(runs.collapse(spark.createDataFrame(rows, schema))).collect()}
    assert (top[4]["start"], top[4]["length"], top[4]["period"], top[4]["exponent_milli"], top[4]["n_runs"]) == (0, 10, 2, 5000, 2)
    assert top[1]["start"] is None and top[1]["runs_sha256"] == top[2]["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()
    assert runs.digests(runs.collapse(runs.with_repeats(spark.createDataFrame([], schema)))).count() == 0
    kept = {r["doc_id"]: r["text"] for r in runs.with_repeats(spark.createDataFrame([(None, "a b  c", "", 1, 1)], schema)).collect()}
    assert kept[None] == "a b c"
    with pytest.raises(ValueError, match="two periods"):
        runs.collapse(spark.createDataFrame(rows, schema), times=1)
