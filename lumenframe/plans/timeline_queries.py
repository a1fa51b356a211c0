"""Queries of the time-axis operators, the rollups and the training table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import stats
from ..operators import features as X
from ..operators import quantiles as Q
from ..operators import timeline as T
from ..sources import files


def ev(spark, d):
    return files.utc(spark.read.parquet(f"{d}/events.parquet"))


def r(c):
    return F.round(c, 6)


def up(c):
    """Six places, where a half at the seventh goes up whatever order a sum was made in."""
    return F.round((F.col(c) if isinstance(c, str) else c) + 1e-9, 6)


def up_sql(sql: str) -> str:
    return sql.replace(", 6)", " + 1e-9, 6)")


W = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"
S = "epoch_us(ts)"


def summary(spark, d):
    df = ev(spark, d).withColumn("value", stats.finite(F.col("value")))
    q = Q.grouped(df, ["event_type"], "value", {"value__p50": 0.5, "value__p90": 0.9})
    return df.groupBy("event_type").agg(*stats.summary(F.col("value"), "value")).join(q, "event_type").withColumns({k: r(k) for k in ("value__p50", "value__p90")})


SUMMARY = """SELECT event_type, round(avg(value), 6) AS value__mean, round(stddev_pop(value), 6) AS value__std, round(min(value), 6) AS value__min, round(max(value), 6) AS value__max,
round(quantile_cont(value, 0.5), 6) AS value__p50, round(quantile_cont(value, 0.9), 6) AS value__p90, count(value) AS value__count FROM events WHERE isfinite(value) GROUP BY 1"""


def lag_rate(spark, d):
    return T.rates(ev(spark, d), "user_id", ["ts", "event_id"], "value").select("event_id", r("diff").alias("diff"), r("rate").alias("rate"))


LAG_RATE = f"""WITH l AS (SELECT event_id, value - lag(value) {W} AS diff, ({S} - lag({S}) {W}) / 1e6 AS dt FROM events)
SELECT event_id, round(diff, 6) AS diff, round(diff / greatest(dt, 1e-3), 6) + 0.0 AS rate FROM l WHERE diff IS NOT NULL"""


def rolling(spark, d):
    """Centred rolling mean and deviation of five rows, and rows over two deviations away."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-2, 2)
    df = ev(spark, d).withColumn("m", F.avg("value").over(w)).withColumn("s", F.stddev_samp("value").over(w))
    return df.select("event_id", r("m").alias("rolling_mean"), r("s").alias("rolling_std"), F.coalesce(F.abs(F.col("value") - F.col("m")) > 1.5 * F.col("s"), F.lit(False)).alias("anomaly"))


ROLLING = """WITH l AS (SELECT event_id, value, avg(value) OVER w AS m, stddev_samp(value) OVER w AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))
SELECT event_id, round(m, 6) AS rolling_mean, round(s, 6) AS rolling_std, coalesce(abs(value - m) > 1.5 * s, false) AS anomaly FROM l"""


def longest_run(spark, d):
    got = T.runs(ev(spark, d), "user_id", ["ts", "event_id"], "event_type")
    return got.groupBy("user_id").agg(F.max("n").alias("longest"), (F.count("*") - 1).alias("switches"), r(F.max("n") / F.sum("n")).alias("longest_share"))


RUNS_CTE = f"""c AS (SELECT *, CASE WHEN event_type = lag(event_type) {W} THEN 0 ELSE 1 END AS c FROM events),
g AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c), n AS (SELECT user_id, run, count(*) AS n FROM g GROUP BY 1, 2)"""
LONGEST_RUN = f"WITH {RUNS_CTE} SELECT user_id, max(n) AS longest, count(*) - 1 AS switches, round(max(n) / sum(n), 6) AS longest_share FROM n GROUP BY 1"


def sliding(spark, d):
    """Windows of 6 hours every 2 hours."""
    g = ev(spark, d).groupBy(F.window("ts", "6 hours", "2 hours").alias("w"), "event_type").agg(F.count("*").alias("n"), r(F.avg("value")).alias("mean"))
    return g.select((F.unix_micros("w.start") / 1_000_000).cast("long").alias("start_s"), "event_type", "n", "mean")


SLIDING = """WITH w AS (SELECT (epoch_us(ts) // 7200000000 - k) * 7200 AS start_s, event_type, value FROM events, range(3) t(k))
SELECT start_s, event_type, count(*) AS n, round(avg(value), 6) AS mean FROM w GROUP BY 1, 2"""


def sessions(spark, d, gap: float = 21_600):
    s = T.sessions(ev(spark, d), "user_id", ["ts", "event_id"], gap)
    return s.groupBy("user_id", "session").agg(F.count("*").alias("n"), r((F.max(F.unix_micros("ts")) - F.min(F.unix_micros("ts"))) / 1e6).alias("length_s"), r(F.sum("value")).alias("total"))


SESSIONS = f"""WITH l AS (SELECT *, CASE WHEN ({S} - lag({S}) {W}) / 1e6 <= 21600 THEN 0 ELSE 1 END AS l FROM events), s AS (SELECT *, (sum(l) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS session FROM l)
SELECT user_id, session, count(*) AS n, round((max({S}) - min({S})) / 1e6, 6) AS length_s, round(sum(value), 6) AS total FROM s GROUP BY 1, 2"""


def bursts(spark, d, within: int = 86_400, least: int = 3):
    """Starts from which ``least`` events or more of a user follow within a day."""
    w = Window.partitionBy("user_id").orderBy(F.unix_micros("ts")).rangeBetween(0, within * 1_000_000)
    return ev(spark, d).withColumn("n", F.count("*").over(w)).groupBy("user_id").agg(F.sum((F.col("n") >= least).cast("long")).alias("bursts"), F.max("n").alias("densest"))


BURSTS = f"WITH n AS (SELECT user_id, count(*) OVER (PARTITION BY user_id ORDER BY {S} RANGE BETWEEN CURRENT ROW AND 86400000000 FOLLOWING) AS n FROM events) SELECT user_id, sum((n >= 3)::BIGINT)::BIGINT AS bursts, max(n) AS densest FROM n GROUP BY 1"


def intervals(spark, d):
    """Interval statistics per user: mean, median, deviation, variation, Gini, share of short ones."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    df = ev(spark, d).withColumn("x", (F.unix_micros("ts") - F.lag(F.unix_micros("ts")).over(w)) / 1e6).filter("x is not null")
    df = Q.ranked(df, ["user_id"], "x").withColumn("k", F.col("_k") + 1).withColumn("c", F.col("_n"))
    return df.groupBy("user_id").agg(F.count("*").alias("n"), r(F.avg("x")).alias("mean"), up(Q.at("x", 0.5)).alias("median"), r(F.stddev_pop("x") / F.greatest(F.avg("x"), F.lit(1e-9))).alias("variation"), r(stats.gini(F.col("x"), F.col("k"), F.col("c"))).alias("gini"), r(F.avg((F.col("x") < 3600).cast("double"))).alias("short_share"))


INTERVALS = f"""WITH l AS (SELECT user_id, event_id, ({S} - lag({S}) {W}) / 1e6 AS x FROM events), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY x, event_id) AS k, count(*) OVER (PARTITION BY user_id) AS c FROM l WHERE x IS NOT NULL)
SELECT user_id, count(*) AS n, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.5) + 1e-9, 6) AS median, round(stddev_pop(x) / greatest(avg(x), 1e-9), 6) AS variation,
round(CASE WHEN sum(x) > 0 THEN sum((2 * k - c - 1) * x) / (max(c) * sum(x)) ELSE 0 END, 6) AS gini, round(avg((x < 3600)::INT), 6) AS short_share FROM k GROUP BY 1"""


def trend(spark, d):
    t = F.unix_micros("ts") / 1e6 / 86400
    return ev(spark, d).groupBy("user_id").agg(r(F.regr_slope("value", t)).alias("slope"), r(F.corr(t, F.col("value"))).alias("correlation"))


TREND = f"SELECT user_id, round(regr_slope(value, {S} / 1e6 / 86400), 6) AS slope, round(corr({S} / 1e6 / 86400, value), 6) AS correlation FROM events GROUP BY 1"


def outliers(spark, d):
    """Rows over three median absolute deviations from their type's median; medians are aggregates joined back, a row per type."""
    df = ev(spark, d)
    dev = df.join(Q.grouped(df, ["event_type"], "value", {"med": 0.5}), "event_type").withColumn("dev", F.abs(F.col("value") - F.col("med")))
    return dev.join(Q.grouped(dev, ["event_type"], "dev", {"mad": 0.5}), "event_type").filter(F.abs(F.col("value") - F.col("med")) > 3 * F.col("mad")).select("event_id", "event_type", r("med").alias("median"), r("mad").alias("mad"))


OUTLIERS = """WITH m AS (SELECT *, quantile_cont(value, 0.5) OVER (PARTITION BY event_type) AS med FROM events), a AS (SELECT *, quantile_cont(abs(value - med), 0.5) OVER (PARTITION BY event_type) AS mad FROM m)
SELECT event_id, event_type, round(med, 6) AS median, round(mad, 6) AS mad FROM a WHERE abs(value - med) > 3 * mad"""


def cuts(spark, d, k: float = 1.5, around: int = 3):
    """Adaptive threshold on the jump between rows: median plus k deviations; a cut with no other within 3 rows is isolated."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    df = ev(spark, d).withColumn("jump", F.abs(F.col("value") - F.lag("value").over(w))).filter("jump is not null")
    df = Q.beside(df, ["user_id"], "jump", {"middle": 0.5}).withColumn("level", F.col("middle") + k * F.stddev_pop("jump").over(Window.partitionBy("user_id")))
    df = df.withColumn("cut", (F.col("jump") > F.col("level")).cast("long"))
    return df.withColumn("beside", F.sum("cut").over(w.rowsBetween(-around, around)) - F.col("cut")).filter("cut = 1").select("event_id", r("jump").alias("strength"), "beside")


CUTS = f"""WITH l AS (SELECT *, abs(value - lag(value) {W}) AS jump FROM events), f AS (SELECT * FROM l WHERE jump IS NOT NULL), t AS (SELECT user_id, quantile_cont(jump, 0.5) + 1.5 * stddev_pop(jump) AS level FROM f GROUP BY 1),
c AS (SELECT f.*, (jump > level)::BIGINT AS cut FROM f JOIN t USING (user_id)), b AS (SELECT *, (sum(cut) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))::BIGINT - cut AS beside FROM c)
SELECT event_id, round(jump, 6) AS strength, beside FROM b WHERE cut = 1"""


def histogram(spark, d, bins: int = 20):
    """Equal-width histogram of each type's values with its normalised entropy."""
    df = ev(spark, d)
    span = df.groupBy("event_type").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    b = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col("value") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins)))).otherwise(bins // 2)
    n = df.join(span, "event_type").groupBy("event_type", b.cast("long").alias("bin")).agg(F.count("*").alias("n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy("event_type"))
    return n.withColumn("share", r(p))


HISTOGRAM = """WITH s AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1),
b AS (SELECT event_type, (CASE WHEN hi > lo THEN least(19, floor((value - lo) / ((hi - lo) / 20))) ELSE 10 END)::BIGINT AS bin FROM events JOIN s USING (event_type)), n AS (SELECT event_type, bin, count(*) AS n FROM b GROUP BY 1, 2)
SELECT *, round(n / sum(n) OVER (PARTITION BY event_type), 6) AS share FROM n"""


def as_of(spark, d):
    df = ev(spark, d)
    got = T.as_of(df.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), df.filter("event_type = 'click'").select("user_id", "ts", "value"), "user_id", "ts", "value", "last_click")
    return got.select("event_id", r("last_click").alias("last_click"))


AS_OF = """SELECT p.event_id, round(c.value, 6) AS last_click FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts >= c.ts"""


def band(spark, d):
    df = ev(spark, d)
    return T.near(df.filter("event_type = 'purchase'"), df.filter("event_type = 'click'"), "user_id", 14_400).select("event_id", "user_id")


BAND = f"SELECT event_id, user_id FROM events p WHERE event_type = 'purchase' AND EXISTS (SELECT 1 FROM events c WHERE c.event_type = 'click' AND c.user_id = p.user_id AND abs(epoch_us(c.ts) - epoch_us(p.ts)) <= 14400000000)"


def remaining(spark, d):
    """Customers without an order yet: what a batch runner would still do, in batches of 12."""
    c = spark.read.parquet(f"{d}/customer.parquet").join(spark.read.parquet(f"{d}/orders.parquet"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")
    return c.select("c_custkey", (F.floor((F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) - 1) / 12)).cast("long").alias("batch"))


REMAINING = "SELECT c_custkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 12 AS batch FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)"


def state(spark, d):
    got = T.latest(ev(spark, d), ["user_id", "event_type"], ["ts", "event_id"], ["value"])
    return got.select("user_id", "event_type", "event_id", r("value").alias("value"))


STATE = "SELECT user_id, event_type, event_id, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1"


def transitions(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    t = ev(spark, d).withColumn("was", F.lag("event_type").over(w)).filter("was is not null").groupBy("was", F.col("event_type").alias("now")).agg(F.count("*").alias("n"))
    return t.withColumn("share", r(F.col("n") / F.sum("n").over(Window.partitionBy("was"))))


TRANSITIONS = f"WITH l AS (SELECT lag(event_type) {W} AS was, event_type AS now FROM events), n AS (SELECT was, now, count(*) AS n FROM l WHERE was IS NOT NULL GROUP BY 1, 2) SELECT *, round(n / sum(n) OVER (PARTITION BY was), 6) AS share FROM n"


def sampled(spark, d, k: int = 8):
    """Uniform index sampling per user: positions rint(i * (n - 1) / (k - 1))."""
    df = ev(spark, d).withColumn("i", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).withColumn("n", F.count("*").over(Window.partitionBy("user_id")))
    at = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.rint(j * (F.col("n") - 1) / (k - 1)))
    return df.filter(F.array_contains(at, F.col("i").cast("double"))).select("event_id", F.col("i").cast("long").alias("position"))


SAMPLED = f"""WITH p AS (SELECT event_id, row_number() {W} - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT event_id, i AS position FROM p WHERE list_contains(list_transform(range(0, 8), lambda j: round_even(j * (n - 1) / 7, 0)), i::DOUBLE)"""


def best_worst(spark, d, k: int = 3):
    """The k rows of least and of greatest value of each type, with their places from both ends.

    Limited windows find the rows; places are counts of the rows before each of these few, so nothing is sorted as a whole.
    """
    df = ev(spark, d).select("event_type", "event_id", "value")

    def end(by):
        w = Window.partitionBy("event_type").orderBy(by, "event_id")
        return df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).drop("place")

    ends = end(F.col("value").asc_nulls_last()).union(end(F.col("value").desc_nulls_last())).distinct()
    mine = ends.select(F.col("event_type").alias("type"), F.col("event_id").alias("id"), F.col("value").alias("v"))
    v, other = F.col("v"), F.col("value")
    first = other.eqNullSafe(v) & (F.col("event_id") < F.col("id"))
    # Nulls come last from either end.
    before = lambda test: F.count_if(F.when(other.isNull(), False).when(v.isNull(), True).otherwise(test) | first) + 1
    met = df.join(F.broadcast(mine), F.col("event_type").eqNullSafe(F.col("type")))
    return met.groupBy(F.col("type").alias("event_type"), F.col("id").alias("event_id")).agg(before(other < v).alias("low"), before(other > v).alias("high"))


BEST_WORST = "SELECT event_type, event_id, low, high FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS low, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS high FROM events) WHERE low <= 3 OR high <= 3"


def quantiles(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    keys, p = ["l_returnflag", "l_linestatus"], {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    got = li.groupBy(*keys).agg(F.count("*").alias("n"), r(F.avg("l_extendedprice")).alias("mean")).join(Q.grouped(li, keys, "l_extendedprice", p), keys)
    return got.withColumns({k: r(k) for k in p})


QUANTILES = "SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_extendedprice), 6) AS mean, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.9), 6) AS p90, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99 FROM lineitem GROUP BY 1, 2"


def checks(spark, d):
    """Range checks: a row per violated rule and record kind, with its severity."""
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    rules = F.array(*(F.struct(F.lit(k).alias("rule"), F.lit(s).alias("severity"), c.alias("bad")) for k, s, c in (("discount_range", "error", ~F.col("l_discount").between(0, 0.1)), ("quantity_range", "warning", ~F.col("l_quantity").between(1, 45)), ("tax_zero", "info", F.col("l_tax") == 0))))
    return li.select("l_returnflag", F.explode(rules).alias("x")).filter("x.bad").groupBy("l_returnflag", F.col("x.rule").alias("rule"), F.col("x.severity").alias("severity")).agg(F.count("*").alias("n"))


CHECKS = " UNION ALL ".join(f"SELECT l_returnflag, '{k}' AS rule, '{s}' AS severity, count(*) AS n FROM lineitem WHERE {c} GROUP BY 1" for k, s, c in (("discount_range", "error", "l_discount NOT BETWEEN 0 AND 0.1"), ("quantity_range", "warning", "l_quantity NOT BETWEEN 1 AND 45"), ("tax_zero", "info", "l_tax = 0")))

FLAGS, VALUES = ("A", "N", "R"), ("n_lines", "mean_price", "max_discount")
REGISTRY = [f"{f}__{v}" for f in FLAGS for v in VALUES] + ["order__status", "order__total"]


def training_table(spark, d):
    """One row per order: status code and totals, and the rolled-up lines of each return flag as features of their own."""
    v = F.col("l_extendedprice")
    made = {"n_lines": lambda own: F.nullif(F.count_if(own), F.lit(0)).cast("double"), "mean_price": lambda own: F.avg(F.when(own, v)), "max_discount": lambda own: F.max(F.when(own, F.col("l_discount")))}
    wide = X.rolled_wide(spark.read.parquet(f"{d}/lineitem.parquet"), ["l_orderkey"], "l_returnflag", list(FLAGS), made)
    orders = spark.read.parquet(f"{d}/orders.parquet").withColumn("status", F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "empty").otherwise("error"))
    out = orders.join(wide, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumns({"order__status": X.status_code("status"), "order__total": F.col("o_totalprice")})
    return out.select(F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("custkey"), *(r(c).alias(c) for c in sorted(REGISTRY)))


TRAINING_TABLE = "WITH l AS (SELECT l_orderkey AS run_id, l_returnflag AS f, count(*) AS n_lines, avg(l_extendedprice) AS mean_price, max(l_discount) AS max_discount FROM lineitem GROUP BY 1, 2), p AS (SELECT run_id, " + ", ".join(f"round(max({v}) FILTER (WHERE f = '{f}'), 6)::DOUBLE AS \"{f}__{v}\"" for f in FLAGS for v in VALUES) + " FROM l GROUP BY 1) SELECT o_orderkey AS run_id, o_custkey AS custkey, p.* EXCLUDE (run_id), CASE o_orderstatus WHEN 'F' THEN 1.0 WHEN 'O' THEN 0.0 ELSE -1.0 END::DOUBLE AS order__status, round(o_totalprice, 6) AS order__total FROM orders LEFT JOIN p ON p.run_id = o_orderkey"

QUERIES = {"p1_summary": summary, "w1_lag_rate": lag_rate, "w3_rolling": rolling, "w8_longest_run": longest_run, "e2_sliding_windows": sliding, "e3_sessions": sessions, "w16_bursts": bursts, "a2_intervals": intervals, "m9_trend": trend, "m3_outliers": outliers, "e5_cuts": cuts, "m8_histogram": histogram, "j3_as_of": as_of, "j5_band_semi": band, "j12_remaining": remaining, "k5_latest_state": state, "a5_transitions": transitions, "m24_uniform_sample": sampled, "w9_best_worst": best_worst, "a37_quantiles": quantiles, "a36_range_checks": checks, "p6_training_table": training_table}
ORACLES = {"p1_summary": SUMMARY, "w1_lag_rate": LAG_RATE, "w3_rolling": ROLLING, "w8_longest_run": LONGEST_RUN, "e2_sliding_windows": SLIDING, "e3_sessions": SESSIONS, "w16_bursts": BURSTS, "a2_intervals": INTERVALS, "m9_trend": TREND, "m3_outliers": OUTLIERS, "e5_cuts": CUTS, "m8_histogram": HISTOGRAM, "j3_as_of": AS_OF, "j5_band_semi": BAND, "j12_remaining": REMAINING, "k5_latest_state": STATE, "a5_transitions": TRANSITIONS, "m24_uniform_sample": SAMPLED, "w9_best_worst": BEST_WORST, "a37_quantiles": QUANTILES, "a36_range_checks": CHECKS, "p6_training_table": TRAINING_TABLE}
