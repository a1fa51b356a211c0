"""Queries of folds, peaks, fades and periods along the time axis, and of trailing state in a stream."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import folds as D
from ..operators import quantiles as Q
from ..operators import series
from ..operators import timeline as T
from ..streaming import events as E
from .flow_queries import W, by_user, ev, r

HOUR = 3_600_000_000


def whole():
    return Window.partitionBy("user_id")


def timed(spark, d):
    return ev(spark, d).withColumn("t", F.unix_micros("ts"))


def merged(spark, d):
    """Runs of one event type; those that begin under 12 hours after the last kept start are merged into it."""
    runs = T.runs(ev(spark, d), "user_id", ["ts", "event_id"], "event_type").withColumn("t", F.unix_micros("start"))
    return series.leaps(runs, "user_id", "t", 12 * HOUR).select("user_id", F.col("t").alias("start_us"), F.col("n").alias("runs"))


MERGED = f"""WITH RECURSIVE c AS (SELECT *, CASE WHEN event_type = lag(event_type) {W} THEN 0 ELSE 1 END AS c FROM events),
g AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c),
e AS MATERIALIZED (SELECT user_id, run, min(epoch_us(ts)) AS t FROM g GROUP BY 1, 2),
f(user_id, t) AS (SELECT user_id, min(t) FROM e GROUP BY 1 UNION ALL SELECT f.user_id, min(e.t) FROM f JOIN e ON e.user_id = f.user_id AND e.t >= f.t + {12 * HOUR} GROUP BY f.user_id),
k AS (SELECT user_id, t, lead(t) OVER (PARTITION BY user_id ORDER BY t) AS next FROM f)
SELECT k.user_id, k.t AS start_us, count(*) AS runs FROM k JOIN e ON e.user_id = k.user_id AND e.t >= k.t AND (k.next IS NULL OR e.t < k.next) GROUP BY 1, 2"""


def scenes(spark, d):
    """Scenes of shots (gaps to the next event, in hours): grown until long enough and of two shots at least."""
    df = timed(spark, d).withColumn("hours", (F.lead("t").over(by_user()) - F.col("t")) / HOUR).filter("hours is not null")
    return D.folded(df, "user_id", ["t", "event_id"], ["event_id", "hours"], "user_id long, scene long, first_event long, shots long, hours double", D.scenes(24.0, 12.0, 2)).withColumn("hours", r("hours"))


SCENES = f"""WITH RECURSIVE s AS (SELECT user_id, ts, event_id, (lead(epoch_us(ts)) {W} - epoch_us(ts)) / {HOUR} AS h FROM events),
x AS MATERIALIZED (SELECT user_id, event_id, h, row_number() {W} AS k FROM s WHERE h IS NOT NULL),
f(user_id, k, scene, first_event, shots, hours, wanted) AS (SELECT user_id, k, 0, event_id, 1, 0.0::DOUBLE + h, 24.0 * (1.0 + 0.5 * (1.0 - h / 12.0::DOUBLE)) FROM x WHERE k = 1
UNION ALL SELECT x.user_id, x.k, CASE WHEN o.fresh THEN f.scene + 1 ELSE f.scene END, CASE WHEN o.fresh THEN x.event_id ELSE f.first_event END, CASE WHEN o.fresh THEN 1 ELSE f.shots + 1 END, CASE WHEN o.fresh THEN x.h ELSE f.hours + x.h END, CASE WHEN o.fresh THEN 24.0 * (1.0 + 0.5 * (1.0 - x.h / 12.0::DOUBLE)) ELSE f.wanted END
FROM f JOIN x ON x.user_id = f.user_id AND x.k = f.k + 1, LATERAL (SELECT NOT (f.hours < f.wanted OR f.shots < 2) AS fresh) o)
SELECT user_id, CAST(scene AS BIGINT) AS scene, first_event, CAST(max(shots) AS BIGINT) AS shots, round(max(hours), 6) AS hours FROM f GROUP BY 1, 2, 3"""


def flashes(spark, d):
    """Short excursions of the change between a user's rows, from the 85th percentile on."""
    df = timed(spark, d).withColumn("change", F.abs(F.col("value") - F.lag("value").over(by_user()))).filter("change is not null")
    df = Q.beside(df, ["user_id"], "change", {"bar": 0.85})
    return D.folded(df, "user_id", ["t", "event_id"], ["change", "bar"], "user_id long, first_row long, last_row long", D.flashes(2, 15))


FLASHES = f"""WITH RECURSIVE c AS (SELECT user_id, ts, event_id, abs(value - lag(value) {W}) AS c FROM events),
x AS MATERIALIZED (SELECT user_id, c, quantile_cont(c, 0.85) OVER (PARTITION BY user_id) AS bar, row_number() {W} - 1 AS k FROM c WHERE c IS NOT NULL),
f(user_id, k, start, got) AS (SELECT user_id, k, CASE WHEN c >= bar THEN k END, CAST(NULL AS BIGINT) FROM x WHERE k = 0
UNION ALL SELECT x.user_id, x.k, CASE WHEN f.start IS NULL THEN CASE WHEN x.c >= x.bar THEN x.k END WHEN x.c < 0.5 * x.bar OR x.k - f.start + 1 > 15 THEN NULL ELSE f.start END,
CASE WHEN (x.c < 0.5 * x.bar OR x.k - f.start + 1 > 15) AND x.k - f.start + 1 BETWEEN 2 AND 15 THEN f.start END FROM f JOIN x ON x.user_id = f.user_id AND x.k = f.k + 1)
SELECT user_id, got AS first_row, k AS last_row FROM f WHERE got IS NOT NULL"""


def matches(spark, d):
    """Signups as predictions of purchases within 12 hours, one to one: counts, precision, recall and F1 of each user."""
    df = timed(spark, d).filter("event_type in ('purchase', 'signup')").withColumn("is_ref", F.col("event_type") == "purchase")
    got = D.folded(df, "user_id", ["t", "event_id"], ["t", "is_ref"], "user_id long, ref_n long, pred_n long, tp long", D.matched(12 * HOUR))
    p, q = F.col("tp") / F.greatest("pred_n", F.lit(1)), F.col("tp") / F.greatest("ref_n", F.lit(1))
    return got.withColumns({"precision": r(p), "recall": r(q), "f1": r(F.when(p + q > 0, 2 * p * q / (p + q)).otherwise(0.0))})


MATCHES = f"""WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) AS t, event_type, event_id FROM events WHERE event_type IN ('purchase', 'signup')),
n AS (SELECT user_id, count(*) FILTER (event_type = 'purchase') AS ref_n, count(*) FILTER (event_type = 'signup') AS pred_n, coalesce(list(t ORDER BY t) FILTER (event_type = 'purchase'), []::BIGINT[]) AS refs FROM e GROUP BY 1),
p AS MATERIALIZED (SELECT user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM e WHERE event_type = 'signup'),
f(user_id, k, free, tp) AS (SELECT user_id, 0, refs, 0 FROM n UNION ALL
SELECT f.user_id, p.k, CASE WHEN o.best IS NULL THEN f.free ELSE list_filter(f.free, lambda x: x <> o.best) END, CASE WHEN o.best IS NULL THEN f.tp ELSE f.tp + 1 END
FROM f JOIN p ON p.user_id = f.user_id AND p.k = f.k + 1, LATERAL (SELECT list_sort(list_transform(list_filter(f.free, lambda x: abs(x - p.t) <= {12 * HOUR}), lambda x: {{'d': abs(x - p.t), 't': x}}))[1].t AS best) o),
m AS (SELECT user_id, CAST(max(tp) AS BIGINT) AS tp FROM f GROUP BY 1),
q AS (SELECT *, tp / greatest(pred_n, 1) AS p, tp / greatest(ref_n, 1) AS r FROM n JOIN m USING (user_id))
SELECT user_id, ref_n, pred_n, tp, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1 FROM q"""


def peaks(spark, d):
    """Strict local maxima at or over the user's mean, 24 hours apart at least, the higher ones first.

    Candidates further apart than that never meet, so the choice is made chain by chain of close ones.
    """
    w = by_user()
    df = timed(spark, d).withColumns({"mean": F.avg("value").over(whole()), "before": F.lag("value").over(w), "after": F.lead("value").over(w)})
    df = df.filter((F.col("value") > F.col("before")) & (F.col("value") > F.col("after")) & (F.col("value") >= F.col("mean")))
    return D.folded(df, "user_id", ["t", "event_id"], ["t", "value", "event_id"], "user_id long, event_id long", D.spread_peaks(24 * HOUR))


PEAKS = f"""WITH RECURSIVE v AS (SELECT user_id, event_id, value, epoch_us(ts) AS t, avg(value) OVER (PARTITION BY user_id) AS mean, lag(value) {W} AS b, lead(value) {W} AS a FROM events),
c AS MATERIALIZED (SELECT user_id, event_id, t, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS k FROM v WHERE value > b AND value > a AND value >= mean),
f(user_id, k, kept, event_id) AS (SELECT user_id, k, [t], event_id FROM c WHERE k = 1 UNION ALL
SELECT c.user_id, c.k, CASE WHEN o.near THEN f.kept ELSE list_append(f.kept, c.t) END, CASE WHEN o.near THEN NULL ELSE c.event_id END
FROM f JOIN c ON c.user_id = f.user_id AND c.k = f.k + 1, LATERAL (SELECT len(list_filter(f.kept, lambda x: abs(x - c.t) < {24 * HOUR})) > 0 AS near) o)
SELECT user_id, event_id FROM f WHERE event_id IS NOT NULL"""


def fades(spark, d):
    """Runs of two steps or more, each under 60 in size, of the mean of three rows, that change it by over 40 in all."""
    w = by_user()
    df = ev(spark, d).withColumn("m", F.avg("value").over(w.rowsBetween(-1, 1)))
    df = df.withColumn("step", F.col("m") - F.lag("m").over(w)).filter("step is not null").withColumn("small", F.abs("step") < 60)
    runs = df.withColumn("run", F.count_if(~F.col("small")).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("small")
    got = runs.groupBy("user_id", "run").agg(F.min("event_id").alias("least_event"), F.count("*").alias("steps"), F.sum("step").alias("change"))
    return got.filter("steps >= 2 and abs(change) > 40").select("user_id", "least_event", "steps", r("change").alias("change"))


FADES = f"""WITH m AS (SELECT *, avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m FROM events),
s AS (SELECT *, m - lag(m) {W} AS step FROM m),
g AS (SELECT *, count(*) FILTER (abs(step) >= 60) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM s WHERE step IS NOT NULL)
SELECT user_id, min(event_id) AS least_event, count(*) AS steps, round(sum(step), 6) AS change FROM g WHERE abs(step) < 60 GROUP BY user_id, run HAVING count(*) >= 2 AND abs(sum(step)) > 40"""


def motion(spark, d):
    """Steps beyond a user's 90th percentile by kind: speed_ramp if the variance over five rows is beyond its own, else whip_pan if over
    0.6 of the steps around go one way, else zoom."""
    w = by_user()
    df = ev(spark, d).withColumns({"var": F.var_pop("value").over(w.rowsBetween(-2, 2)), "signed": F.col("value") - F.lag("value").over(w)})
    df = df.withColumns({"step": F.abs("signed"), "way": F.abs(F.avg(F.signum("signed")).over(w.rowsBetween(-2, 2)))})
    df = Q.beside(Q.beside(df, ["user_id"], "var", {"var90": 0.9}), ["user_id"], "step", {"step90": 0.9}).filter("step > step90")
    kind = F.when(F.col("var") > F.col("var90"), "speed_ramp").when(F.col("way") > 0.6 + 1e-9, "whip_pan").otherwise("zoom")
    return df.select("event_id", kind.alias("kind"), r("var").alias("variance"))


MOTION = f"""WITH v AS (SELECT user_id, event_id, ts, var_pop(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS var, value - lag(value) {W} AS signed FROM events),
s AS (SELECT *, abs(signed) AS step, abs(avg(sign(signed)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)) AS way FROM v),
q AS (SELECT *, quantile_cont(var, 0.9) OVER (PARTITION BY user_id) AS var90, quantile_cont(step, 0.9) OVER (PARTITION BY user_id) AS step90 FROM s)
SELECT event_id, CASE WHEN var > var90 THEN 'speed_ramp' WHEN way > 0.6 + 1e-9 THEN 'whip_pan' ELSE 'zoom' END AS kind, round(var, 6) AS variance FROM q WHERE step > step90"""


def two_stage(spark, d):
    """Every n-th row of a user (8 to 32 in all), then the rows within two of a sampled one whose value is over 250."""
    n = F.count("*").over(whole())
    df = ev(spark, d).withColumn("stride", F.ceil(n / F.greatest(F.lit(8), F.least(F.lit(32), F.floor(n / 10)))).cast("long"))
    df = df.withColumn("first", F.pmod(F.row_number().over(by_user()) - 1, F.col("stride")) == 0)
    df = df.withColumn("near", F.max(F.col("first") & (F.col("value") > 250)).over(by_user().rowsBetween(-2, 2)))
    return df.select("event_id", F.when(F.col("first"), 1).when(F.col("near"), 2).alias("stage")).filter("stage is not null")


TWO_STAGE = f"""WITH s AS (SELECT *, CAST(ceil(count(*) OVER (PARTITION BY user_id) / greatest(8, least(32, floor(count(*) OVER (PARTITION BY user_id) / 10)))) AS BIGINT) AS stride FROM events),
p AS (SELECT *, (row_number() {W} - 1) % stride = 0 AS first FROM s),
n AS (SELECT *, max(first AND value > 250) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near FROM p)
SELECT event_id, CASE WHEN first THEN 1 ELSE 2 END AS stage FROM n WHERE first OR near"""

# Weight of each event type in the combined curve.
WEIGHTS = {"purchase": 1.0, "signup": 0.75, "click": 0.5, "view": 0.25, "error": 0.125}


#: Deviations over the mean, and days apart, of a user's events.
STRONG, APART = 1.5, 3


def multimodal(spark, d):
    """Days whose weighted curve beats the user's mean by 1.5 deviations and both neighbouring days, three days apart at least (the
    higher first), with the type that adds most."""
    part = {k: F.sum(F.when(F.col("event_type") == k, F.col("value") * v).otherwise(0.0)).alias(k) for k, v in WEIGHTS.items()}
    df = ev(spark, d).groupBy("user_id", F.floor(F.unix_micros("ts") / (24 * HOUR)).alias("day")).agg(*part.values())
    df = df.withColumn("score", sum((F.col(k) for k in WEIGHTS), F.lit(0.0))).withColumn("top", F.array_max(F.array(*(F.struct(r(k).alias("x"), F.lit(k).alias("k")) for k in WEIGHTS)))["k"])
    w, x = Window.partitionBy("user_id").orderBy("day"), F.col("score")
    df = df.withColumns({"b": F.lag(x).over(w), "a": F.lead(x).over(w), "bar": F.avg(x).over(whole()) + STRONG * F.stddev_pop(x).over(whole())})
    found = df.filter((x > F.col("bar")) & (x > F.coalesce("a", F.lit(0.0))) & (x > F.coalesce("b", F.lit(0.0))))
    kept = D.folded(found, "user_id", ["day"], ["day", "score"], "user_id long, day long", lambda rows: D.spread_peaks(APART)((t, h, t) for t, h in rows))
    return found.join(kept, ["user_id", "day"]).select("user_id", F.date_format(F.date_from_unix_date(F.col("day").cast("int")), "yyyy-MM-dd").alias("day"), "top", r(x).alias("score"))


MULTIMODAL = f"""WITH RECURSIVE d AS (SELECT user_id, epoch_us(ts) // {24 * HOUR} AS day, {', '.join(f"sum(CASE WHEN event_type = '{k}' THEN value * {v}::DOUBLE ELSE 0.0 END) AS {k}" for k, v in WEIGHTS.items())} FROM events GROUP BY 1, 2),
s AS (SELECT *, {' + '.join(WEIGHTS)} AS score, list_max([{', '.join(f"{{'x': round({k}, 6), 'k': '{k}'}}" for k in WEIGHTS)}]).k AS top FROM d),
w AS (SELECT *, lag(score) OVER o AS b, lead(score) OVER o AS a, avg(score) OVER (PARTITION BY user_id) + {STRONG}::DOUBLE * stddev_pop(score) OVER (PARTITION BY user_id) AS bar FROM s WINDOW o AS (PARTITION BY user_id ORDER BY day)),
c AS MATERIALIZED (SELECT user_id, day, top, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, day) AS k FROM w WHERE score > bar AND score > coalesce(a, 0) AND score > coalesce(b, 0)),
f(user_id, k, kept, day) AS (SELECT user_id, k, [day], day FROM c WHERE k = 1 UNION ALL
SELECT c.user_id, c.k, CASE WHEN o.near THEN f.kept ELSE list_append(f.kept, c.day) END, CASE WHEN o.near THEN NULL ELSE c.day END
FROM f JOIN c ON c.user_id = f.user_id AND c.k = f.k + 1, LATERAL (SELECT len(list_filter(f.kept, lambda x: abs(x - c.day) < {APART})) > 0 AS near) o)
SELECT c.user_id, strftime(DATE '1970-01-01' + c.day::INT, '%Y-%m-%d') AS day, c.top, round(c.score, 6) AS score FROM f JOIN c ON c.user_id = f.user_id AND c.day = f.day"""

#: Cycles a day of a period that is looked for.
SLOWEST, FASTEST = 0.1, 5.0


def periodicity(spark, d):
    """The strongest of all frequencies between 0.1 and 5 cycles a day of each type's hourly counts, detrended under a Hann
    window, against their median."""
    h = ev(spark, d).groupBy("event_type", F.floor(F.unix_micros("ts") / HOUR).alias("h")).agg(F.count("*").alias("c"))
    got = series.strongest_period(h, "event_type", "h", "c", SLOWEST / 24, FASTEST / 24)
    return got.select("event_type", "cycles", r("period").alias("period_hours"), F.round("significance", 4).alias("significance"), (F.col("significance") > 2).alias("periodic"))


PERIODICITY = f"""WITH h AS (SELECT event_type, epoch_us(ts) // {HOUR} AS h, count(*) AS c FROM events GROUP BY 1, 2),
s AS (SELECT event_type, min(h) AS lo, max(h) - min(h) + 1 AS n FROM h GROUP BY 1),
e AS (SELECT event_type, n, lo, unnest(range(n)) AS i FROM s),
x AS (SELECT e.event_type, n, i, CAST(coalesce(c, 0) AS DOUBLE) AS x FROM e LEFT JOIN h ON h.event_type = e.event_type AND h.h = e.lo + e.i),
l AS (SELECT event_type, regr_slope(x, i) AS slope, regr_intercept(x, i) AS cut FROM x GROUP BY 1),
k AS (SELECT event_type, n, unnest(range(1, (n + 1) // 2)) AS k FROM s), b AS (SELECT * FROM k WHERE k / n > {SLOWEST} / 24 AND k / n < {FASTEST} / 24),
y AS (SELECT x.event_type, x.n, i, (x - cut - slope * i) * (0.5 - 0.5 * cos(2 * pi() * i / greatest(x.n - 1, 1))) AS y, k FROM x JOIN l USING (event_type) JOIN b ON b.event_type = x.event_type),
p AS (SELECT event_type, n, k, sum(y * cos(2 * pi() * k * i / n)) ** 2 + sum(y * sin(2 * pi() * k * i / n)) ** 2 AS power FROM y GROUP BY 1, 2, 3)
SELECT event_type, CAST(arg_max(k, power) AS BIGINT) AS cycles, round(n / arg_max(k, power), 6) AS period_hours, round(max(power) / (median(power) + 1e-10), 4) AS significance, max(power) / (median(power) + 1e-10) > 2 AS periodic FROM p GROUP BY event_type, n"""


def stream_trailing(spark, d):
    """A stream's state: mean of the last five values of each user and how many there were, whatever order they come in."""
    return E.replay(E.trailing(E.stream(spark, f"{d}/events.parquet"), 5), ["user_id"]).select("user_id", r("mean").alias("mean"), "n", "last_us")


STREAM_TRAILING = """WITH x AS (SELECT user_id, value, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id, round(avg(value), 6) AS mean, max(n) AS n, max(t) AS last_us FROM x WHERE k <= 5 GROUP BY 1"""

_ALL = {
    "w7_merged_runs": (merged, MERGED), "e10_scenes": (scenes, SCENES), "e14_flashes": (flashes, FLASHES), "j7_matches": (matches, MATCHES), "m15_peaks": (peaks, PEAKS), "e7_fades": (fades, FADES), "e8_motion": (motion, MOTION),
    "e16_two_stage": (two_stage, TWO_STAGE), "e13_multimodal": (multimodal, MULTIMODAL), "m16_periodicity": (periodicity, PERIODICITY), "r6_stream_trailing": (stream_trailing, STREAM_TRAILING),
}
QUERIES = {k: v[0] for k, v in _ALL.items()}
ORACLES = {k: v[1] for k, v in _ALL.items()}
