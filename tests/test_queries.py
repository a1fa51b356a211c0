from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from compare import oracle, same

from lumenframe.plans.catalogue import FLAGSHIP, ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, name):
    rows = [r.asDict() for r in QUERIES[name](spark, sf).collect()]
    assert not same(rows, oracle(ORACLES[name], sf))


def test_keyframes(spark, sf):
    """The one query without SQL: its peaks by their definition, user by user."""
    from lumenframe.plans import pacing_queries

    rows = pacing_queries.feelings(spark, sf).orderBy("user_id", "ts", "event_id").collect()
    taps = np.exp(-0.5 * (np.arange(-7, 8) / (5 / 3)) ** 2)
    want = {}
    for user in {r["user_id"] for r in rows}:
        v, a = (np.array([r[c] for r in rows if r["user_id"] == user], float) for c in ("valence", "arousal"))
        smooth = [np.array([sum(w * x[min(max(i + k, 0), len(x) - 1)] for k, w in zip(range(-7, 8), taps / taps.sum(), strict=True)) for i in range(len(x))]) for x in (v, a)]
        found = {}
        for kind, x, shift in (("emotion_peak", np.hypot(*smooth), 0), ("transition", np.hypot(*map(np.diff, smooth)), 1)):
            x = (x - x.min()) / (x.max() - x.min())
            at = [i for i in range(1, len(x) - 1) if x[i] > x[i - 1] and x[i] > x[i + 1]]
            kept = []
            for i in sorted(at, key=lambda i: -x[i]):
                if all(abs(i - j) >= 8 for j in kept):
                    kept.append(i)
            for i in kept:
                low = [min(side[: next((k for k, y in enumerate(side) if y > x[i]), len(side))], default=x[i]) for side in (x[:i][::-1], x[i + 1 :])]
                if x[i] - max(min(y, x[i]) for y in low) >= 0.1 and (i + shift not in found or x[i] > found[i + shift][1]):
                    found[i + shift] = (kind, float(x[i]))
        want |= {(user, i): y for i, y in found.items()}
    got = {(r["user_id"], r["place"]): (r["kind"], r["score"]) for r in QUERIES["w14_keyframes"](spark, sf).collect()}
    assert {k: y[0] for k, y in got.items()} == {k: y[0] for k, y in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 1e-5 for k in want) and set(QUERIES) - set(ORACLES) == {"w14_keyframes", "v5_similar_rows", "e18_temporal_segments", "v25_label_runs", "v30_merged_speakers", "m11_time_warping", "e15_unit_flashes", "p7_decoded_tokens", "e7_soft_cuts", "j8_caption_groups"}


def test_best_and_worst_rows_have_places_from_both_ends(spark, tmp_path):
    """Places are whole, with ties, nulls and numbers that are none; nulls come last from either end."""
    rows = [(i, k, v) for k, vs in {"a": [5.0, 1.0, 1.0, 2.0, 9.0, 9.0, 3.0, 4.0, None, float("nan")], "b": [None, None, 7.0], None: [1.0, 2.0]}.items() for i, v in enumerate(vs, 100 * len(vs))]
    spark.createDataFrame(rows, "event_id long, event_type string, value double").selectExpr("*", "timestamp'2024-01-01' AS ts").write.parquet(f"{tmp_path}/events.parquet")
    order = {"low": lambda x: (x[2] is None, x[2] != x[2], x[2] if x[2] == x[2] else 0, x[0]), "high": lambda x: (x[2] is None, x[2] == x[2], -x[2] if x[2] is not None and x[2] == x[2] else 0, x[0])}
    want = {}
    for kind in ("a", "b", None):
        own = [x for x in rows if x[1] == kind]
        places = {n: {x[0]: i for i, x in enumerate(sorted(own, key=f), 1)} for n, f in order.items()}
        want |= {(kind, x[0]): (places["low"][x[0]], places["high"][x[0]]) for x in own if min(p[x[0]] for p in places.values()) <= 3}
    assert {(r["event_type"], r["event_id"]): (r["low"], r["high"]) for r in QUERIES["w9_best_worst"](spark, str(tmp_path)).collect()} == want


@pytest.mark.parametrize(("column", "lengths", "users"), [("confidence", (70, 75), (1529, 21343, 22017, 25475)), ("tension", (40, 50, 64, 75, 80), (13272,)), ("stress", (40, 50, 64, 75, 80), (18028,)), ("nervousness", (40, 50, 64, 75, 80), (298, 1930, 3861, 4556))])
def test_halves_of_individuality_go_as_in_sql(spark, tmp_path, column, lengths, users):
    """Scores of these users stand on a half at the seventh place: parts are added and rounded as the SQL does, to the last bit."""
    rows = []
    for user in users:
        rnd = random.Random(user)
        rows += [(rnd.randrange(273), user, rnd.choice(("click", "view", "purchase", "signup", "error"))) for _ in range(rnd.choice(lengths))]
    df = pd.DataFrame(rows, columns=["event_id", "user_id", "event_type"]).assign(ts=pd.Timestamp("2024-01-01"), value=1.0)
    df.to_parquet(f"{tmp_path}/events.parquet", coerce_timestamps="us")
    got, want = ({r["user_id"]: r[column] for r in rows} for rows in (QUERIES["a20_individuality"](spark, str(tmp_path)).collect(), oracle(ORACLES["a20_individuality"], str(tmp_path))))
    assert got == want and set(got) == set(users)


def test_entry(spark):
    import __spark_entry__ as e

    assert FLAGSHIP in e.queries() and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).limit(1).count() == 1
