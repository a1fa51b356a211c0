"""Queries of reports, overlaps, shifts and interval shares."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import quantiles as Q
from ..streaming import events as E
from .flow_queries import W, by_user, ev, r


def orders_report(spark, d):
    """Quantiles and mean of order totals by priority and status."""
    keys, p = ["o_orderpriority", "o_orderstatus"], {f"p{q}": q / 100 for q in (50, 90, 99)}
    df = spark.read.parquet(f"{d}/orders.parquet")
    got = df.groupBy(*keys).agg(r(F.avg("o_totalprice")).alias("mean"), F.count("*").alias("n")).join(Q.grouped(df, keys, "o_totalprice", p), keys)
    return got.withColumns({k: r(k) for k in p})


ORDERS_REPORT = f"SELECT o_orderpriority, o_orderstatus, {', '.join(f'round(quantile_cont(o_totalprice, 0.{q}), 6) AS p{q}' for q in (50, 90, 99))}, round(avg(o_totalprice), 6) AS mean, count(*) AS n FROM orders GROUP BY 1, 2"


def top_customers(spark, d):
    """Each market segment's five highest balances, with the segment's mean and deviation."""
    df = spark.read.parquet(f"{d}/customer.parquet")
    w = Window.partitionBy("c_mktsegment").orderBy(F.desc("c_acctbal"), "c_custkey")
    best = df.withColumn("place", F.row_number().over(w)).filter("place <= 5").select("c_mktsegment", "place", "c_custkey", "c_acctbal")
    whole = df.groupBy("c_mktsegment").agg(r(F.avg("c_acctbal")).alias("mean"), r(F.stddev_pop("c_acctbal")).alias("std"), F.count("*").alias("n"))
    return best.join(whole, "c_mktsegment")


TOP_CUSTOMERS = """WITH p AS (SELECT c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS place, c_custkey, c_acctbal FROM customer),
s AS (SELECT c_mktsegment, round(avg(c_acctbal), 6) AS mean, round(stddev_pop(c_acctbal), 6) AS std, count(*) AS n FROM customer GROUP BY 1)
SELECT * FROM p JOIN s USING (c_mktsegment) WHERE place <= 5"""


def shift(spark, d):
    """Cosine of the mean of a label's first and last two vectors (fewer for short ones), and whether it is below 0.85."""
    w = Window.partitionBy("label")
    df = spark.read.parquet(f"{d}/embeddings.parquet").withColumn("n", F.count("*").over(w)).withColumn("i", F.row_number().over(w.orderBy("vec_id")))
    df = df.withColumn("own", F.least(F.lit(2), F.floor(F.col("n") / 2))).filter("own > 0 and (i <= own or i > n - own)")
    df = df.select("label", (F.col("i") <= F.col("own")).alias("begin"), F.posexplode("embedding").alias("dim", "x"))
    x = F.col("x").cast("double")
    parts = df.groupBy("label", "dim").agg(F.avg(F.when(F.col("begin"), x)).alias("b"), F.avg(F.when(~F.col("begin"), x)).alias("e"))
    got = parts.groupBy("label").agg((F.sum(F.col("b") * F.col("e")) / (F.sqrt(F.sum(F.col("b") ** 2)) * F.sqrt(F.sum(F.col("e") ** 2)))).alias("c"))
    return got.select("label", r("c").alias("cosine"), (F.col("c") < 0.85).alias("shifted"))


SHIFT = """WITH i AS (SELECT label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS i, count(*) OVER (PARTITION BY label) AS n FROM embeddings),
x AS (SELECT label, i <= least(2, n // 2) AS first_part, unnest(range(len(embedding))) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM i WHERE n >= 2 AND (i <= least(2, n // 2) OR i > n - least(2, n // 2))),
p AS (SELECT label, dim, avg(x) FILTER (first_part) AS b, avg(x) FILTER (NOT first_part) AS e FROM x GROUP BY 1, 2),
c AS (SELECT label, sum(b * e) / (sqrt(sum(b * b)) * sqrt(sum(e * e))) AS c FROM p GROUP BY 1)
SELECT label, round(c, 6) AS cosine, c < 0.85 AS shifted FROM c"""


def overlap(spark, d):
    """Weighted Jaccard of the event-type shares of each user and the next one by id."""
    g = ev(spark, d).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    g = g.withColumn("w", F.col("n") / F.sum("n").over(Window.partitionBy("user_id"))).drop("n")
    both = g.join(g.select((F.col("user_id") - 1).alias("user_id"), "event_type", F.col("w").alias("v")), ["user_id", "event_type"], "full").fillna(0.0, ["w", "v"])
    return both.groupBy("user_id").agg(r(F.sum(F.least("w", "v")) / F.sum(F.greatest("w", "v"))).alias("overlap"))


OVERLAP = """WITH g AS (SELECT user_id, event_type, count(*) / sum(count(*)) OVER (PARTITION BY user_id) AS w FROM events GROUP BY 1, 2),
j AS (SELECT coalesce(a.user_id, b.user_id - 1) AS user_id, coalesce(a.w, 0) AS w, coalesce(b.w, 0) AS v FROM g a FULL JOIN g b ON b.user_id - 1 = a.user_id AND b.event_type = a.event_type)
SELECT user_id, round(sum(least(w, v)) / sum(greatest(w, v)), 6) AS overlap FROM j GROUP BY 1"""


def intervals(spark, d):
    """Shares of short and long intervals per user, their quantiles, and the regularity 1 / (1 + deviation / mean)."""
    t = F.unix_micros("ts") / 1e6
    df = ev(spark, d).select("user_id", (t - F.lag(t).over(by_user())).alias("dt")).filter("dt is not null")
    short, long = F.avg((F.col("dt") < 3600).cast("int")), F.avg((F.col("dt") > 86400).cast("int"))
    q = [r(Q.at("dt", x / 100)).alias(f"p{x}") for x in (10, 25, 75, 90)]
    return Q.ranked(df, ["user_id"], "dt").groupBy("user_id").agg(r(short).alias("short"), r(long).alias("long"), *q, r(1 / (1 + F.stddev_pop("dt") / F.avg("dt"))).alias("regularity"))


INTERVALS = f"""WITH x AS (SELECT user_id, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) {W} AS dt FROM events)
SELECT user_id, round(avg(CASE WHEN dt < 3600 THEN 1 ELSE 0 END), 6) AS short, round(avg(CASE WHEN dt > 86400 THEN 1 ELSE 0 END), 6) AS long,
{', '.join(f'round(quantile_cont(dt, {q / 100}), 6) AS p{q}' for q in (10, 25, 75, 90))}, round(1 / (1 + stddev_pop(dt) / avg(dt)), 6) AS regularity FROM x WHERE dt IS NOT NULL GROUP BY 1"""


def stream_sliding(spark, d):
    """Streamed windows of 6 hours every 2 hours with a watermark."""
    got = E.windowed(E.stream(spark, f"{d}/events.parquet"), F.window("ts", "6 hours", "2 hours"), ["event_type"], [F.count("*").alias("n")])
    return E.replay(got.select((F.unix_micros("w.start") / 1_000_000).cast("long").alias("start_s"), "event_type", "n"), ["start_s", "event_type"])


STREAM_SLIDING = "SELECT (epoch_us(ts) // 7200000000 - k) * 7200 AS start_s, event_type, count(*) AS n FROM events, range(3) t(k) GROUP BY 1, 2"

_ALL = {
    "k9_orders_report": (orders_report, ORDERS_REPORT), "k8_top_customers": (top_customers, TOP_CUSTOMERS), "v15_shift": (shift, SHIFT), "v21_overlap": (overlap, OVERLAP),
    "a3_a27_intervals": (intervals, INTERVALS), "r7_stream_sliding": (stream_sliding, STREAM_SLIDING),
}
QUERIES = {k: v[0] for k, v in _ALL.items()}
ORACLES = {k: v[1] for k, v in _ALL.items()}
