"""Curves side by side, local fits, flashes, sessions of a stream, keyed JSON in pieces and decoded tokens, each by its definition."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lumenframe.functions import signal as G
from lumenframe.operators import curves as C
from lumenframe.operators import decoding, series
from lumenframe.plans import curve_queries
from lumenframe.plans.catalogue import QUERIES
from lumenframe.sources import files
from lumenframe.streaming import events as E


def brute_warping(a, b, band):
    """The table of least costs, cell by cell."""
    band, table = max(band, abs(len(a) - len(b))), {}
    for i in range(len(a)):
        for j in range(len(b)):
            if abs(i - j) <= band:
                before = [table[p] for p in ((i - 1, j - 1), (i - 1, j), (i, j - 1)) if p in table]
                cost, steps = min(before, key=lambda x: x[0]) if before else (0.0, 0)
                table[i, j] = (cost + (a[i] - b[j]) ** 2, steps + 1)
    cost, steps = table[len(a) - 1, len(b) - 1]
    return np.sqrt(cost), steps


def test_warping_against_brute_force(spark, sf):
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (rng.integers(0, 5, rng.integers(1, 18)).astype(float) for _ in range(2))
        band = int(rng.integers(0, 9))
        got, want = C.warped(a, b, band), brute_warping(a, b, band)
        assert abs(got[0] - want[0]) < 1e-12 and got[1] == want[1]
    days = {}
    for r in curve_queries.daily(spark, sf).orderBy("user_id", "day").collect():
        days.setdefault(r["user_id"], []).append((r["views"], r["clicks"]))
    for r in QUERIES["m11_time_warping"](spark, sf).collect():
        distance, steps = brute_warping(*np.array(days.pop(r["user_id"])).T, curve_queries.BAND)
        assert abs(r["distance"] - distance) < 1e-5 and r["steps"] == steps
    assert not days


def test_warping_of_many_keys_at_once(spark):
    """Rows of a table are warped as each alone, and keys that go on over batches stay whole."""
    rng = np.random.default_rng(7)
    a, b = rng.integers(0, 5, (50, 12)).astype(float), rng.integers(0, 5, (50, 12)).astype(float)
    distance, steps = C.all_warped(a, b, 3)
    want = [brute_warping(x, y, 3) for x, y in zip(a, b, strict=True)]
    assert np.allclose(distance, [w[0] for w in want]) and steps.tolist() == [w[1] for w in want]
    df = spark.createDataFrame([(k, i, float(a[k, i]), float(b[k, i])) for k in range(50) for i in range(12 - k % 3)], "k long, i long, a double, b double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = {r["k"]: r for r in C.side_by_side(df, "k", ["i"], "a", "b", 4, 3).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k in range(50):
        want = brute_warping(a[k, : 12 - k % 3], b[k, : 12 - k % 3], 3)
        assert got[k]["n"] == 12 - k % 3 and abs(got[k]["distance"] - want[0]) < 1e-9 and got[k]["steps"] == want[1]


def test_curves_of_unlike_lengths(spark):
    """The shorter curve is stretched; a lag of the longer one is found; level and empty curves."""
    t = np.arange(40)
    a, b = np.exp(-((t - 25) ** 2) / 8.0), np.exp(-((t - 20) ** 2) / 8.0)
    rows = [(1, int(i), float(a[i]), float(b[i]) if i % 2 == 0 else None) for i in t] + [(2, 0, 1.0, None), (3, 0, 1.0, 2.0), (3, 1, 1.0, 5.0), (None, 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k long, i long, a double, b double")
    got = {r["k"]: r for r in C.side_by_side(df, "k", ["i"], "a", "b", 10, 5).collect()}
    stretched = np.interp(np.linspace(0, 1, 40), np.linspace(0, 1, 20), b[::2])
    full = np.correlate(a - a.mean(), stretched - stretched.mean(), "full")[29:50]
    assert set(got) == {1, 3} and got[1]["n"] == 40 and got[1]["lag"] == int(full.argmax()) - 10 == 4
    assert abs(got[1]["correlation"] - full.max() / np.sqrt(((a - a.mean()) ** 2).sum() * ((stretched - stretched.mean()) ** 2).sum())) < 1e-9
    assert abs(got[1]["pearson"] - np.corrcoef(a, stretched)[0, 1]) < 1e-9 and got[3]["correlation"] == 0 and got[3]["distance"] == pytest.approx(np.sqrt(17))
    assert C.side_by_side(df.limit(0), "k", ["i"], "a", "b", 10, 5).count() == 0


@pytest.mark.parametrize(("window", "degree"), [(5, 2), (7, 3), (3, 0)])
def test_local_fit_against_polyfit(spark, window, degree):
    rng = np.random.default_rng(window)
    keys = {"a": rng.normal(size=30), "b": rng.normal(size=window), "c": rng.normal(size=window + 1)}
    df = spark.createDataFrame([(k, i, float(v)) for k, x in keys.items() for i, v in enumerate(x)], "k string, i long, v double")
    w = Window.partitionBy("k").orderBy("i")
    got = {(r["k"], r["i"]): r["s"] for r in df.select("k", "i", G.savitzky_golay("v", w, window, degree).alias("s")).collect()}
    for k, x in keys.items():
        for i in range(len(x)):
            at = min(max(i - window // 2, 0), len(x) - window)
            want = np.polyval(np.polyfit(np.arange(window), x[at : at + window], degree), i - at) if len(x) > window else x[i]
            assert abs(got[k, i] - want) < 1e-8


def brute_peaks(x, height, distance, longest):
    """Peaks by their definition: strict maxima high enough, the higher of close ones, then 1 to ``longest`` wide at half prominence."""
    at = [i for i in range(1, len(x) - 1) if x[i] > x[i - 1] and x[i] > x[i + 1] and x[i] >= height]
    kept = []
    for i in sorted(at, key=lambda i: (-x[i], -i)):
        if all(abs(i - j) >= distance for j in kept):
            kept.append(i)
    out = []
    for p in sorted(kept):
        sides = [x[:p][::-1], x[p + 1 :]]
        low = [min([*side[: next((k for k, v in enumerate(side) if v > x[p]), len(side))], x[p]]) for side in sides]
        level = x[p] - 0.5 * (x[p] - max(low))
        ends = []
        for step in (-1, 1):
            i = p
            while x[i] > level:
                i += step
            ends.append(i - step * (level - x[i]) / (x[i - step] - x[i]))
        if 1 <= ends[1] - ends[0] <= longest:
            out.append(p)
    return out


def test_flashes_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/events.parquet").orderBy("user_id", "ts", "event_id").collect()
    taps = np.exp(-0.5 * np.arange(-4, 5) ** 2.0)
    want = set()
    for user in {r["user_id"] for r in rows}:
        own = [r for r in rows if r["user_id"] == user]
        v, t = np.array([r["value"] for r in own]), np.array([r["ts"].timestamp() for r in own])
        columns = [v, np.append(0, np.abs(np.diff(v))), np.append(0, np.diff(t))]
        v, change, gap = ((x - x.min()) / (x.max() - x.min()) if x.max() > x.min() else 0 * x for x in columns)
        for kind, x in (("surge", np.maximum(v, change)), ("pause", gap)):
            s = np.convolve(np.pad(x, 4, mode="symmetric"), taps / taps.sum(), "valid")
            want |= {(user, p, kind) for p in brute_peaks(s, s.mean() + 1.5 * s.std(), 3, 6.0)}
    got = QUERIES["e15_unit_flashes"](spark, sf).collect()
    assert {(r["user_id"], r["place"], r["kind"]) for r in got} == want and len(got) == len(want) > 20


def test_widths_of_plain_peaks():
    x = np.array([0, 1, 2, 3, 2, 1, 0, 0, 5, 0, 0], float)
    at = series.local_peaks(x)
    assert at.tolist() == [3, 8] and C.widths(x, at).tolist() == [3.0, 1.0] and C.peaks(x, 1.0, 1, 1, 2.5).tolist() == [8]


def test_sessions_over_batches_with_late_rows(spark, tmp_path):
    """Sessions merge across batches; a row within the delay joins, one beyond it is dropped."""
    folder, out, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    schema = "user_id long, ts timestamp, value double"

    def batch(rows):
        df = spark.createDataFrame([(u, None, float(v), s) for u, s, v in rows], schema + ", s long").select("user_id", F.timestamp_seconds("s").alias("ts"), "value")
        df.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        got = E.windowed(stream, F.session_window("ts", "100 seconds"), ["user_id"], [F.count("*").alias("n"), F.sum("value").alias("total")], delay="1000 seconds")
        flat = got.select("user_id", F.unix_seconds("w.start").alias("a"), F.unix_seconds("w.end").alias("b"), "n", "total")
        flat.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()

    batch([(1, 10_000, 1), (1, 10_050, 2), (2, 10_000, 5)])
    batch([(1, 10_180, 4), (1, 10_120, 8), (2, 10_900, 1)])
    batch([(1, 10_250, 16), (3, 12_000, 1)])
    batch([(1, 10_300, 32), (2, 11_950, 64), (3, 20_000, 1)])
    batch([(9, 90_000, 1)])
    got = {tuple(r) for r in spark.read.parquet(out).collect()}
    assert got == {(1, 10_000, 10_350, 5, 31.0), (2, 10_000, 10_100, 1, 5.0), (2, 10_900, 11_000, 1, 1.0), (2, 11_950, 12_050, 1, 64.0), (3, 12_000, 12_100, 1, 1.0), (3, 20_000, 20_100, 1, 1.0)}


def test_keyed_json_in_pieces(spark, tmp_path):
    """Entries of one large object, of any nesting, with commas and braces in strings, over many splits of a file."""
    values = {f'k"{i},{{': {"a": [i, {"b": "x,}\\" + '"' + ",]"}], "c": None, "d": i / 7} for i in range(3000)} | {"plain": {}, "ünï": {"a": []}}
    (tmp_path / "data_1.json").write_text(json.dumps(values, ensure_ascii=False))
    (tmp_path / "data_2.json").write_text(json.dumps({"x": {"d": 1.5}}, indent=2))
    (tmp_path / "data_3.json").write_text("{ }")
    (tmp_path / "data_4.json").write_text('{"good": {"d": 2}, "bad": {"d": nope}, "after": {"d": 3}}')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        got = files.keyed(spark, f"file://{tmp_path}/data_*.json", "struct<a:array<string>,d:double>").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    by = {r["key"]: r["value"] for r in got}
    assert len(got) == len(values) + 2 and set(by) == set(values) | {"x", "good"}
    assert by['k"7,{']["d"] == 1.0 and json.loads(by['k"7,{']["a"][1]) == {"b": "x,}\\" + '"' + ",]"} and by["plain"]["d"] is None and by["x"]["d"] == 1.5
    entries = files._Entries()
    taken = [x for x in map(entries.take, '{"a":1,"b":[1,2,3],"c":"x,y"}'.split(",")) if x]
    assert taken == [("a", "1"), ("b", "[1,2,3]"), ("c", '"x,y"')] and not entries.parts


def test_decoded_tokens(spark, sf):
    """Decoding the ids of a text gives its words in lower case, with single blanks; special and unknown ids are left out."""
    import unicodedata

    import public_tokenizers
    import regex
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, words = Tokenizer.from_file(path), decoding.vocabulary(spark, path)
    texts = {1: "Hello,  naïve Σίσυφος 東京 it's 12!", 2: "", 3: "🙂 é ÀÉ"}
    rows = [(i, tokenizer.encode(t, add_special_tokens=False).ids) for i, t in texts.items()] + [(4, None), (5, [49406, 99999999])]
    got = {r["k"]: r["text"] for r in decoding.decoded(spark.createDataFrame(rows, "k long, ids array<int>"), "k", "ids", words).collect()}

    def normal(text):
        return " ".join(regex.findall(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+", unicodedata.normalize("NFC", text).lower()))

    assert got == {i: normal(t) for i, t in texts.items()} | {4: "", 5: ""}
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["p7_decoded_tokens"](spark, sf).collect():
        assert (r["n_chars"], r["head"]) == (len(normal(docs[r["doc_id"]])), normal(docs.pop(r["doc_id"]))[:40])
    assert not docs


def test_patterns_of_addresses_and_mentions(spark):
    from lumenframe.functions import text as T
    from lumenframe.plans.text_queries import PATTERNS

    df = spark.createDataFrame([("mail a.b@example.com, see www.site.org or HTTP://x.y @me @@you x@z.@w 1:02:03 12:3",)], "t string")
    got = df.select(*(T.occurrences(F.col("t"), p).alias(k) for k, p in PATTERNS.items())).first()
    assert (got["n_urls"], got["n_mentions"], got["n_times"]) == (2, 3, 1)


def test_decoded_texts_span_batches(spark):
    """Texts of more tokens than a batch has, and of none, are put together whole and in order."""
    words = spark.createDataFrame([(i, f"w{i} ".encode().hex(), False) for i in range(50)] + [(99, b"<s>".hex(), True)], "id int, bytes string, special boolean")
    rows = [("long", [i * 7 % 50 for i in range(1000)]), ("short", [3, 99, 4]), ("none", []), ("null", None), ("only", [99])]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 17)
    try:
        frame = decoding.decoded(spark.createDataFrame(rows, "k string, ids array<int>"), "k", "ids", words)
        got = {r["k"]: r["text"] for r in frame.collect()}
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {k: " ".join(f"w{i}" for i in ids or [] if i != 99) for k, ids in rows}
    # No row's pieces are gathered as a list.
    assert "collect_list" not in plan
