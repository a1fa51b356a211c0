from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from lumenframe.operators import timeline as T
from lumenframe.sources import files, sinks
from lumenframe.streaming import events as E


def test_documents_and_keyed_json(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "v.json").write_text(json.dumps({"title": "t", "comments": [{"text": "c"}], "other": 1}, indent=1))
    (row,) = files.documents(spark, str(tmp_path / "a")).collect()
    assert (row.title, row.comments[0].text, row.description) == ("t", "c", None)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "data_0.json").write_text('{"x": {"n": 1}, "y": {"n": null}}')
    got = {r.key: r.value.n for r in files.keyed(spark, str(tmp_path / "b"), "struct<n:int>").collect()}
    assert got == {"x": 1, "y": None}


def test_manifests_leave_out_unreadable_files(spark, tmp_path):
    for k, text in (("1", '{"run": "a"}'), ("2", "{not json"), ("3", '{"run": "b"}')):
        (tmp_path / k / "x").mkdir(parents=True)
        (tmp_path / k / "x" / "manifest.json").write_text(text)
    (tmp_path / "1" / "other.json").write_text('{"run": "z"}')
    assert sorted(r.run for r in files.manifests(spark, str(tmp_path), "run string").collect()) == ["a", "b"]


def test_json_lines_append_and_malformed(spark, tmp_path):
    path = str(tmp_path / "lines")
    for n in (1, 2):
        sinks.append_lines(spark.createDataFrame([(n, "é\n")], "n int, t string"), path)
    (tmp_path / "lines" / "part-z.json").write_text('{"n": 3, "t": "x"}\n{"n": \n\n{"n": 4}\n')
    got = files.json_lines(spark, path, "n int, t string").select("n", "t").collect()
    assert sorted((r.n, r.t) for r in got if r.n != 4) == [(1, "é\n"), (2, "é\n"), (3, "x")] and len(got) == 4


def test_newest_and_retention(spark):
    df = spark.createDataFrame([("a", "p1", 1), ("a", "p2", 3), ("a", "p3", 3), ("b", "p4", 0)], "k string, path string, modified int")
    assert sorted(r.path for r in files.newest(df, ["k"]).collect()) == ["p3", "p4"]
    assert [r.path for r in sinks.beyond_last(df, ["k"], 2).collect()] == ["p1"]


def test_wide_csv_sorts_features_and_leaves_nulls_empty(spark, tmp_path):
    path = str(tmp_path / "csv")
    sinks.wide_csv(spark.createDataFrame([("k", 2, None, 1)], "id string, z int, b string, a int").coalesce(1), ["id"], path)
    (part,) = (tmp_path / "csv").glob("part-*")
    assert part.read_text().splitlines() == ["id,a,b,z", "k,1,,2"]


def test_spaced_matches_a_plain_loop(spark):
    times = [0, 5, 9, 11, 12, 22, 23, 90, 99, 101]
    df = spark.createDataFrame([("u", t) for t in times] + [("v", 3)], "k string, s int").select("k", F.timestamp_seconds("s").alias("ts"))
    kept, last = [], None
    for t in times:
        if last is None or t > last + 10:
            kept.append(t)
            last = t
    got = [(r.k, r.s) for r in T.spaced(df, "k", 10.0).select("k", F.unix_seconds("ts").alias("s")).orderBy("k", "s").collect()]
    assert got == [("u", t) for t in kept] + [("v", 3)]
    assert T.spaced(df.limit(0), "k", 10.0).count() == 0


def test_stream_runs_over_several_batches(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    for n in range(3):
        rows = [(n * 10 + i, base + dt.timedelta(minutes=n * 10 + i), i % 2) for i in range(10)]
        spark.createDataFrame(rows, "event_id int, ts timestamp, user_id int").coalesce(1).write.mode("append").parquet(str(tmp_path / "e"))
    df = E.stream(spark, str(tmp_path / "e"))
    got = E.windowed(df, F.window("ts", "20 minutes"), ["user_id"], [F.count("*").alias("n")])
    flat = got.select(F.unix_seconds("w.start").alias("s"), "user_id", "n")
    out = {(r.s % 86400, r.user_id): r.n for r in E.replay(flat, ["s", "user_id"]).collect()}
    assert out == {(0, 0): 10, (0, 1): 10, (1200, 0): 5, (1200, 1): 5}
    twice = E.deduplicated(E.stream(spark, str(tmp_path / "e")), ["user_id"])
    assert sorted(r.user_id for r in E.replay(twice.select("user_id")).collect()) == [0, 1]


def test_shared_folder_of_an_application(spark):
    from lumenframe.sources import sinks

    one, two = sinks.shared(spark, "x"), sinks.shared(spark, "x")
    assert one != two and f"/lumenframe-{spark.sparkContext.applicationId}/x-" in one and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_shared_folder_must_be_named_on_a_cluster():
    import pytest

    from lumenframe.sources import sinks

    class Context:
        master, applicationId = "yarn", "a"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError):
        sinks.shared(Session(), "x")
