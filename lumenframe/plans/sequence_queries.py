"""Queries of sequences brought to a length, runs that stand out, pooled vectors of length 1, positions checked, and run keys."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import sequences as Q
from ..streaming import events as E
from .flow_queries import W, by_user, ev, r
from .vector_queries import emb

SHORT, LONG, KEY = 24, 90, 150.0
SPAN, BAR = 9, 2.0


def scored(spark, d):
    """A user's rows; those of a value over 150 are key rows."""
    return ev(spark, d).select("user_id", "ts", "event_id", "value", F.when(F.col("value") > KEY, F.col("value")).alias("score"))


def compressed(spark, d):
    """24 rows a user at most: the best key rows and even steps of the others."""
    return Q.compressed(scored(spark, d), "user_id", ["ts", "event_id"], "score", SHORT).select("user_id", "place", "event_id")


_PLACED = f"""o AS (SELECT user_id, ts, event_id, value, CASE WHEN value > {KEY} THEN value END AS score FROM events),
p AS MATERIALIZED (SELECT *, row_number() {W} - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n, count(score) OVER (PARTITION BY user_id) AS keys,
  CASE WHEN score IS NOT NULL THEN row_number() OVER (PARTITION BY user_id, score IS NULL ORDER BY score DESC, ts, event_id) - 1 END AS rank FROM o)"""

COMPRESSED = f"""WITH {_PLACED},
k AS (SELECT *, coalesce(rank < {SHORT // 2}, false) AS key, {SHORT} - least(keys, {SHORT // 2}) AS rest, greatest(1, (n - least(keys, {SHORT // 2})) // ({SHORT} - least(keys, {SHORT // 2}))) AS step FROM p),
j AS (SELECT *, row_number() OVER (PARTITION BY user_id, key ORDER BY i) - 1 AS j FROM k)
SELECT user_id, i AS place, event_id FROM j WHERE key OR (j % step = 0 AND j // step < rest)"""


def expanded(spark, d):
    """90 rows a user at least: all rows, copies of key rows, values between neighbours."""
    return Q.expanded(scored(spark, d), "user_id", ["ts", "event_id"], "score", "value", LONG).select("user_id", F.col("place").cast("long").alias("place"), F.col("source").cast("long").alias("source"), "kind", r("value").alias("value"))


EXPANDED = f"""WITH {_PLACED},
c AS MATERIALIZED (SELECT *, least(greatest({LONG} - n, 0), 2 * least(keys, {LONG // 3})) AS copies FROM p),
u AS (SELECT user_id, min(n) AS n, min(copies) AS copies, greatest({LONG} - min(n) - min(copies), 0) AS need FROM c GROUP BY 1),
g AS (SELECT *, unnest(range(n + need)) AS q FROM u WHERE need > 0 AND n > 1),
b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY q) - 1 AS k, q * (n - 1) // (n + need - 1) AS below, q * (n - 1) / (n + need - 1) AS x FROM g WHERE q * (n - 1) % (n + need - 1) <> 0)
SELECT user_id, i AS place, i AS source, 'row' AS kind, round(value, 6) AS value FROM c
UNION ALL SELECT user_id, n + 2 * rank + t.d, i, 'copy', round(value, 6) FROM c, (VALUES (0), (1)) t(d) WHERE rank IS NOT NULL AND 2 * rank + t.d < copies
UNION ALL SELECT b.user_id, b.n + b.copies + k, -1, 'between', round(l.value + (h.value - l.value) * (x - below), 6) FROM b JOIN c l ON l.user_id = b.user_id AND l.i = below JOIN c h ON h.user_id = b.user_id AND h.i = below + 1 WHERE k < need"""


def standing_out(spark, d):
    """Runs of values over two deviations from the nine around them."""
    got = Q.standing_out(ev(spark, d), "user_id", ["ts", "event_id"], "value", SPAN, BAR)
    return got.select("user_id", "place", r("z").alias("z"), r("change").alias("change"))


STANDING_OUT = f"""WITH m AS (SELECT user_id, value, row_number() {W} - 1 AS i, avg(value) OVER a AS m, stddev_samp(value) OVER a AS s, avg(value) OVER (PARTITION BY user_id) AS mean, count(*) OVER (PARTITION BY user_id) AS n FROM events
  WINDOW a AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN {SPAN // 2} PRECEDING AND {SPAN - 1 - SPAN // 2} FOLLOWING)),
z AS MATERIALIZED (SELECT user_id, i, value, mean, abs(value - m) / CASE WHEN s = 0 THEN 1e-10 ELSE s END AS z FROM m WHERE n >= {2 * SPAN}),
o AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY user_id ORDER BY i) <= {SPAN} THEN 0 ELSE 1 END AS new FROM z WHERE z > {BAR}),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM o),
c AS (SELECT user_id, floor(avg(i))::BIGINT AS i FROM g GROUP BY user_id, run)
SELECT c.user_id, c.i AS place, round(z.z, 6) AS z, round(z.value - z.mean, 6) AS change FROM c JOIN z ON z.user_id = c.user_id AND z.i = c.i"""


def pooled_units(spark, d):
    """A label's tags (vectors whose id ends in 0 or 5) as their mean of length 1, and its chunks as their mean by weight (words) of
    length 1; a label without words has the zero vector."""
    weight = (F.col("vec_id") % 7).cast("double")
    x = emb(spark, d).select("label", weight.alias("w"), (F.col("vec_id") % 5 == 0).alias("tag"), F.posexplode("embedding").alias("dim", "x")).withColumn("x", F.col("x").cast("double"))
    means = x.groupBy("label", "dim").agg(F.avg(F.when(F.col("tag"), F.col("x"))).alias("tags"), (F.sum(F.col("w") * F.col("x")) / (F.sum("w") + 1e-9)).alias("chunks"))
    own = Window.partitionBy("label")
    length = lambda c: F.sqrt(F.sum(F.col(c) * F.col(c)).over(own))
    return means.select("label", "dim", *(r(F.when(length(c) > 0, F.col(c) / length(c)).otherwise(F.col(c))).alias(c) for c in ("tags", "chunks")))


POOLED_UNITS = """WITH x AS (SELECT label, (vec_id % 7)::DOUBLE AS w, vec_id % 5 = 0 AS tag, CAST(unnest(range(len(embedding))) AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
m AS (SELECT label, dim, avg(x) FILTER (tag) AS tags, sum(w * x) / (sum(w) + 1e-9) AS chunks FROM x GROUP BY 1, 2), l AS (SELECT label, sqrt(sum(tags * tags)) AS t, sqrt(sum(chunks * chunks)) AS c FROM m GROUP BY 1)
SELECT label, dim, round(CASE WHEN t > 0 THEN tags / t ELSE tags END, 6) AS tags, round(CASE WHEN c > 0 THEN chunks / c ELSE chunks END, 6) AS chunks FROM m JOIN l USING (label)"""


def checked_positions(spark, d):
    """Cut positions (of signups, by their id) turned to frames of their user; a position beyond the user's frames is a row that says so."""
    frames = ev(spark, d).select("user_id", F.col("event_id").alias("frame"), (F.row_number().over(by_user()) - 1).cast("long").alias("position"))
    cuts = ev(spark, d).filter("event_type = 'signup'").select("user_id", (F.col("event_id") % 97 - 2).cast("long").alias("position")).distinct()
    got = cuts.join(frames, ["user_id", "position"], "left")
    return got.select("user_id", "position", "frame", F.when(F.col("frame").isNull(), F.concat(F.lit("out of bounds: "), F.col("position").cast("string"))).alias("error"))


CHECKED_POSITIONS = f"""WITH f AS (SELECT user_id, event_id AS frame, row_number() {W} - 1 AS position FROM events), c AS (SELECT DISTINCT user_id, event_id % 97 - 2 AS position FROM events WHERE event_type = 'signup')
SELECT c.user_id, c.position, f.frame, CASE WHEN f.frame IS NULL THEN 'out of bounds: ' || c.position END AS error FROM c LEFT JOIN f ON f.user_id = c.user_id AND f.position = c.position"""

# The fields that tell one run of a component from another, in order; here with what stands for each.
RUN_KEY = {"platform_id": "'p' || user_id % 2", "video_id": "user_id", "component": "event_type", "config_hash": "event_id % 3", "sampling_policy_version": "'v1'", "producer_version": "'2.0'", "schema_version": "'s1'", "model_signature": "'m' || event_id % 2"}


def run_keys(spark, d):
    """Streamed runs without those done before: one for each key of eight fields."""
    df = E.stream(spark, f"{d}/events.parquet")
    # A null field is told from an empty one.
    key = F.sha2(F.concat_ws("|", *(F.coalesce(F.expr(v).cast("string"), F.lit("\\N")) for v in RUN_KEY.values())), 256)
    return E.replay(E.deduplicated(df.withColumn("run_key", key), ["run_key"]).select("run_key", "user_id", "event_type"))


RUN_KEYS = "SELECT DISTINCT sha256(" + " || '|' || ".join(f"coalesce(({v})::VARCHAR, '\\N')" for v in RUN_KEY.values()) + ") AS run_key, user_id, event_type FROM events"

def entropies(spark, d):
    """The entropy of a user's event types by five rules: a small number added in the logarithm, shares of at least a small number, no
    empty shares, in bits, and over the greatest there could be."""
    counts = ev(spark, d).groupBy("user_id").agg(*(F.count_if(F.col("event_type") == k).cast("double").alias(k) for k in KINDS))
    n = sum((F.col(k) for k in KINDS), F.lit(0.0))
    p = F.transform(F.array(*KINDS), lambda x: x / n)
    total = lambda term: F.aggregate(F.transform(p, term), F.lit(0.0), lambda s, x: s - x)
    plain = total(lambda x: F.when(x > 0, x * F.log(x)).otherwise(0.0))
    return counts.select("user_id", r(total(lambda x: x * F.log(x + 1e-9))).alias("added"), r(total(lambda x: F.greatest(x, F.lit(1e-12)) * F.log(F.greatest(x, F.lit(1e-12))))).alias("clipped"), r(plain).alias("plain"), r(total(lambda x: x * F.log2(x + 1e-8))).alias("bits"), r(plain / F.log(F.lit(float(len(KINDS))))).alias("normal"))


KINDS = ("click", "error", "purchase", "signup", "view")
ENTROPIES = f"""WITH c AS (SELECT user_id, [{', '.join(f"count(*) FILTER (event_type = '{k}')" for k in KINDS)}] AS c, count(*) FILTER (event_type IN {KINDS}) AS n FROM events GROUP BY 1), p AS (SELECT user_id, list_transform(c, lambda x: x / n) AS p FROM c)
SELECT user_id, round(-list_sum(list_transform(p, lambda x: x * ln(x + 1e-9))), 6) + 0 AS added, round(-list_sum(list_transform(p, lambda x: greatest(x, 1e-12) * ln(greatest(x, 1e-12)))), 6) + 0 AS clipped, round(-list_sum(list_transform(p, lambda x: CASE WHEN x > 0 THEN x * ln(x) ELSE 0 END)), 6) + 0 AS plain,
round(-list_sum(list_transform(p, lambda x: x * log2(x + 1e-8))), 6) + 0 AS bits, round(-list_sum(list_transform(p, lambda x: CASE WHEN x > 0 THEN x * ln(x) ELSE 0 END)) / ln(5), 6) + 0 AS normal FROM p"""


def trends(spark, d):
    """Slope of two series of a user over hours, by kind (under 0.001 an hour either way is stable), with mean, deviation, range and
    how steady it is (1 / (1 + deviation over mean))."""
    us = F.unix_micros("ts")
    df = ev(spark, d).withColumns({"hours": (us - F.min(us).over(Window.partitionBy("user_id"))) / 3_600_000_000, "change": F.abs(F.col("value") - F.lag("value").over(by_user()))})
    long = df.select("user_id", "hours", F.inline(F.array(*(F.struct(F.lit(c).alias("series"), F.col(c).alias("x")) for c in ("value", "change"))))).filter("x is not null")
    slope = F.regr_slope("x", "hours")
    kind = F.when(F.abs(slope) < 0.001, "stable").when(slope > 0, "increasing").otherwise("decreasing")
    return long.groupBy("user_id", "series").agg(r(slope).alias("slope"), kind.alias("trend"), r(F.avg("x")).alias("mean"), r(F.stddev_pop("x")).alias("std"), r(F.max("x") - F.min("x")).alias("range"), r(1 / (1 + F.stddev_pop("x") / (F.avg("x") + 1e-9))).alias("steady"), (F.abs(slope) > 0.001).alias("has_trend"))


TRENDS = f"""WITH h AS (SELECT user_id, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / 3600000000 AS hours, value, abs(value - lag(value) {W}) AS change FROM events),
l AS (SELECT user_id, hours, 'value' AS series, value AS x FROM h UNION ALL SELECT user_id, hours, 'change', change FROM h WHERE change IS NOT NULL)
SELECT user_id, series, round(regr_slope(x, hours), 6) AS slope, CASE WHEN abs(regr_slope(x, hours)) < 0.001 THEN 'stable' WHEN regr_slope(x, hours) > 0 THEN 'increasing' ELSE 'decreasing' END AS trend,
round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(max(x) - min(x), 6) AS range, round(1 / (1 + stddev_pop(x) / (avg(x) + 1e-9)), 6) AS steady, abs(regr_slope(x, hours)) > 0.001 AS has_trend FROM l GROUP BY 1, 2"""

_ALL = {
    "m1_entropies": (entropies, ENTROPIES), "a23_trends": (trends, TRENDS),
    "p17_compressed": (compressed, COMPRESSED), "p17_expanded": (expanded, EXPANDED), "w3_standing_out": (standing_out, STANDING_OUT), "v12_pooled_units": (pooled_units, POOLED_UNITS),
    "j16_checked_positions": (checked_positions, CHECKED_POSITIONS), "r5_run_keys": (run_keys, RUN_KEYS),
}
QUERIES = {k: v[0] for k, v in _ALL.items()}
ORACLES = {k: v[1] for k, v in _ALL.items()}
