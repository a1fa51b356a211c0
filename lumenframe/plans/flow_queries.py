"""Queries of sources, sinks, streams, ordered folds and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import quantiles as Q
from ..operators import timeline as T
from ..sources import files, sinks
from ..streaming import events as E

W = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"
HOURS = 6


def ev(spark, d):
    return files.utc(spark.read.parquet(f"{d}/events.parquet"))


def r(c):
    return F.round(c, 6)


def by_user():
    return Window.partitionBy("user_id").orderBy("ts", "event_id")


def json_lines(spark, d):
    """Events appended in two writes as JSON lines and read back."""
    df, path = ev(spark, d).select("event_id", "user_id", "event_type", "value", "props"), sinks.shared(spark, "lines")
    sinks.append_lines(df.filter("event_type in ('click', 'view')"), path)
    sinks.append_lines(df.filter("event_type is null or event_type not in ('click', 'view')"), path)
    return files.json_lines(spark, path, df.schema).withColumn("value", r("value"))


JSON_LINES = "SELECT event_id, user_id, event_type, round(value, 6) AS value, props FROM events"


def wide_csv(spark, d):
    """Events of each user by type, a wide CSV, read back; what a user lacks is null."""
    kinds, path = ["click", "error", "purchase", "signup", "view"], sinks.shared(spark, "wide")
    wide = ev(spark, d).groupBy("user_id").agg(*(F.sum(F.when(F.col("event_type") == k, 1)).alias(k) for k in reversed(kinds)))
    sinks.wide_csv(wide, ["user_id"], path)
    return spark.read.schema("user_id long, " + ", ".join(f"{k} long" for k in kinds)).option("header", True).csv(path)


WIDE_CSV = "SELECT user_id, " + ", ".join(f"CAST(sum(CASE WHEN event_type = '{k}' THEN 1 END) AS BIGINT) AS {k}" for k in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY 1"


def metrics(spark, d):
    n = ev(spark, d).groupBy("event_type").agg(F.count("*").alias("n"))
    return n.select(sinks.metric_line("events_total", ["event_type"], "n").alias("line"))


METRICS = """SELECT 'events_total{event_type="' || event_type || '"} ' || count(*) AS line FROM events GROUP BY event_type"""


def stream_tumbling(spark, d):
    """Streamed windows of 6 hours with a watermark."""
    got = E.windowed(E.stream(spark, f"{d}/events.parquet"), F.window("ts", f"{HOURS} hours"), ["event_type"], [F.count("*").alias("n"), F.max("value").alias("top")])
    flat = got.select((F.unix_micros("w.start") / 1_000_000).cast("long").alias("start_s"), "event_type", "n", "top")
    return E.replay(flat, ["start_s", "event_type"]).withColumn("top", r("top"))


STREAM_TUMBLING = "SELECT epoch_us(ts) // 21600000000 * 21600 AS start_s, event_type, count(*) AS n, round(max(value), 6) AS top FROM events GROUP BY 1, 2"


def stream_latest(spark, d):
    """The state that a streamed journal leaves: each user's last event."""
    got = E.latest(E.stream(spark, f"{d}/events.parquet"), ["user_id"], ["ts", "event_id"], ["event_type"])
    return E.replay(got.select("user_id", "x.ts", "x.event_id", "x.event_type"), ["user_id"]).select("user_id", "event_id", "event_type")


STREAM_LATEST = "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


def stream_distinct(spark, d):
    """Streamed deduplication by key: the (user, type, day) keys met."""
    df = E.stream(spark, f"{d}/events.parquet").withColumn("day", F.floor(F.unix_micros("ts") / 86_400_000_000))
    return E.replay(E.deduplicated(df, ["user_id", "event_type", "day"]).select("user_id", "event_type", "day"))


STREAM_DISTINCT = "SELECT DISTINCT user_id, event_type, epoch_us(ts) // 86400000000 AS day FROM events"


def spaced(spark, d):
    """Purchases more than 6 hours after the last kept one of their user."""
    return T.spaced(ev(spark, d).filter("event_type = 'purchase'"), "user_id", HOURS * 3600.0).select("user_id", F.unix_micros("ts").alias("kept_us"))


SPACED = """WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'purchase'),
f(user_id, t) AS (SELECT user_id, min(t) FROM e GROUP BY 1 UNION ALL SELECT f.user_id, min(e.t) FROM f JOIN e ON e.user_id = f.user_id AND e.t > f.t + 21600000000 GROUP BY f.user_id)
SELECT user_id, t AS kept_us FROM f"""


def trailing(spark, d):
    w = by_user().rowsBetween(-4, 0)
    return ev(spark, d).select("event_id", r(F.avg("value").over(w)).alias("trailing_mean"), r(F.max("value").over(w)).alias("trailing_max"))


TRAILING = f"SELECT event_id, round(avg(value) OVER w, 6) AS trailing_mean, round(max(value) OVER w, 6) AS trailing_max FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"


def mad(spark, d):
    """Values over their user's median by more than 1.5 median absolute deviations, and cuts: values as far below it at which the change
    or the time since the row before is as far above its own."""
    df = ev(spark, d).select("event_id", "user_id", "value", F.abs(F.col("value") - F.lag("value").over(by_user())).alias("change"), ((F.unix_micros("ts") - F.lag(F.unix_micros("ts")).over(by_user())) / 3_600_000_000).alias("hours"))
    for c in ("value", "change", "hours"):
        df = Q.beside(df, ["user_id"], c, {f"{c}_med": 0.5})
        df = Q.beside(df.withColumn("dev", F.abs(F.col(c) - F.col(f"{c}_med"))), ["user_id"], "dev", {f"{c}_mad": 0.5})
    far = lambda c: F.coalesce(F.col(c) > F.col(f"{c}_med") + 1.5 * F.col(f"{c}_mad"), F.lit(False))
    low = F.col("value") < F.col("value_med") - 1.5 * F.col("value_mad")
    return df.select("event_id", r("value_med").alias("med"), r("value_mad").alias("mad"), far("value").alias("high"), (low & (far("change") | far("hours"))).alias("cut"))


_DEV = ", ".join(f"quantile_cont(abs({c} - {c}_med), 0.5) OVER (PARTITION BY user_id) AS {c}_mad" for c in ("value", "change", "hours"))
MAD = f"""WITH c AS (SELECT event_id, user_id, value, abs(value - lag(value) {W}) AS change, (epoch_us(ts) - lag(epoch_us(ts)) {W}) / 3600000000 AS hours FROM events),
m AS (SELECT *, {", ".join(f"quantile_cont({c}, 0.5) OVER (PARTITION BY user_id) AS {c}_med" for c in ("value", "change", "hours"))} FROM c), n AS (SELECT *, {_DEV} FROM m)
SELECT event_id, round(value_med, 6) AS med, round(value_mad, 6) AS mad, value > value_med + 1.5 * value_mad AS high,
value < value_med - 1.5 * value_mad AND (coalesce(change > change_med + 1.5 * change_mad, false) OR coalesce(hours > hours_med + 1.5 * hours_mad, false)) AS cut FROM n"""


def cumulative(spark, d):
    """Events of a type so far, per user, and the middle of the interval since the one before."""
    w = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    us = F.unix_micros("ts")
    return ev(spark, d).select("event_id", F.row_number().over(w).alias("n"), F.floor((us + F.lag(us).over(w)) / 2).alias("middle_us"))


CUMULATIVE = """SELECT event_id, row_number() OVER w AS n, CAST(floor((epoch_us(ts) + lag(epoch_us(ts)) OVER w) / 2) AS BIGINT) AS middle_us
FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)"""


def softmax(spark, d):
    """Shares of each user's types by softmax of the mean value over 100."""
    g = ev(spark, d).groupBy("user_id", "event_type").agg((F.avg("value") / 100).alias("x"))
    w = Window.partitionBy("user_id")
    g = g.withColumn("e", F.exp(F.col("x") - F.max("x").over(w)))
    return g.select("user_id", "event_type", r(F.col("e") / F.sum("e").over(w)).alias("share"))


SOFTMAX = """WITH g AS (SELECT user_id, event_type, avg(value) / 100 AS x FROM events GROUP BY 1, 2),
e AS (SELECT *, exp(x - max(x) OVER (PARTITION BY user_id)) AS e FROM g)
SELECT user_id, event_type, round(e / sum(e) OVER (PARTITION BY user_id), 6) AS share FROM e"""


def anchors(spark, d):
    """Windows of an hour around purchases, clipped to the user's span, and the events in them, by one range window."""
    us, span = F.unix_micros("ts"), Window.partitionBy("user_id")
    near = Window.partitionBy("user_id").orderBy(us).rangeBetween(-3_600_000_000, 3_600_000_000)
    df = ev(spark, d).withColumn("n", F.count("*").over(near)).withColumn("a", F.min(us).over(span)).withColumn("b", F.max(us).over(span))
    return df.filter("event_type = 'purchase'").select("event_id", "n", F.greatest(us - 3_600_000_000, "a").alias("start_us"), F.least(us + 3_600_000_000, "b").alias("end_us"))


ANCHORS = """WITH a AS (SELECT event_id, event_type, epoch_us(ts) AS t, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 3600000000 PRECEDING AND 3600000000 FOLLOWING) AS n,
min(epoch_us(ts)) OVER (PARTITION BY user_id) AS a, max(epoch_us(ts)) OVER (PARTITION BY user_id) AS b FROM events)
SELECT event_id, n, greatest(t - 3600000000, a) AS start_us, least(t + 3600000000, b) AS end_us FROM a WHERE event_type = 'purchase'"""


def peaks(spark, d):
    """Local maxima over the user's 75th percentile, those closer than a day merged, the strongest kept."""
    w = by_user()
    v = F.col("value")
    df = Q.beside(ev(spark, d), ["user_id"], "value", {"p75": 0.75}).withColumn("peak", (v > F.col("p75")) & (v > F.coalesce(F.lag(v).over(w), F.lit(float("-inf")))) & (v >= F.coalesce(F.lead(v).over(w), F.lit(float("-inf")))))
    groups = T.sessions(df.filter("peak"), "user_id", ["ts", "event_id"], 86400.0)
    return groups.groupBy("user_id", "session").agg(F.max(F.struct("value", "event_id")).alias("x"), F.count("*").alias("n")).select("user_id", "x.event_id", "n")


PEAKS = f"""WITH p AS (SELECT *, quantile_cont(value, 0.75) OVER (PARTITION BY user_id) AS q, lag(value) {W} AS a, lead(value) {W} AS b FROM events),
k AS (SELECT * FROM p WHERE value > q AND (a IS NULL OR value > a) AND (b IS NULL OR value >= b)),
s AS (SELECT *, CASE WHEN (epoch_us(ts) - lag(epoch_us(ts)) {W}) / 1e6 <= 86400 THEN 0 ELSE 1 END AS l FROM k),
g AS (SELECT *, sum(l) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM s)
SELECT user_id, arg_max(event_id, (value, event_id)) AS event_id, count(*) AS n FROM g GROUP BY user_id, session"""


def clips(spark, d):
    """Clips of 16 events every 8; the last ones are padded."""
    df = ev(spark, d).select("user_id", "value", (F.row_number().over(by_user()) - 1).alias("i"))
    last = F.floor(F.col("i") / 8).cast("int")
    df = df.select("user_id", "value", F.explode(F.sequence(F.greatest(last - 1, F.lit(0)), last)).alias("clip"))
    return df.groupBy("user_id", "clip").agg(r(F.avg("value")).alias("mean"), (16 - F.count("*")).alias("padded"))


CLIPS = f"""WITH i AS (SELECT user_id, value, row_number() {W} - 1 AS i FROM events),
c AS (SELECT user_id, value, i // 8 AS clip FROM i UNION ALL SELECT user_id, value, i // 8 - 1 FROM i WHERE i >= 8)
SELECT user_id, clip, round(avg(value), 6) AS mean, 16 - count(*) AS padded FROM c GROUP BY 1, 2"""


def not_done(spark, d):
    """Customers without an order."""
    return spark.read.parquet(f"{d}/customer.parquet").join(spark.read.parquet(f"{d}/orders.parquet"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


NOT_DONE = "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)"


def both_sources(spark, d):
    """Texts of two sources as one, each with its source."""
    a = spark.read.parquet(f"{d}/documents.parquet").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.length("text").alias("chars"))
    b = spark.read.parquet(f"{d}/benchmark.parquet").select(F.length("text").alias("chars"), F.lit("benchmark").alias("kind"), F.col("item_id").alias("id"))
    return a.unionByName(b)


BOTH_SOURCES = "SELECT 'document' AS kind, doc_id AS id, length(text) AS chars FROM documents UNION ALL SELECT 'benchmark', item_id, length(text) FROM benchmark"

_ALL = {
    "s6_k3_json_lines": (json_lines, JSON_LINES), "k1_wide_csv": (wide_csv, WIDE_CSV), "k7_metrics": (metrics, METRICS),
    "r7_stream_tumbling": (stream_tumbling, STREAM_TUMBLING), "r1_stream_latest": (stream_latest, STREAM_LATEST), "r4_stream_distinct": (stream_distinct, STREAM_DISTINCT),
    "w6_spaced": (spaced, SPACED), "w4_trailing": (trailing, TRAILING), "w12_mad": (mad, MAD), "w13_cumulative": (cumulative, CUMULATIVE), "w15_softmax": (softmax, SOFTMAX),
    "e1_anchors": (anchors, ANCHORS), "e11_peaks": (peaks, PEAKS), "e17_clips": (clips, CLIPS), "o5_not_done": (not_done, NOT_DONE), "o7_both_sources": (both_sources, BOTH_SOURCES),
}
QUERIES = {k: v[0] for k, v in _ALL.items()}
ORACLES = {k: v[1] for k, v in _ALL.items()}
