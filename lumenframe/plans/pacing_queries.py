"""Queries of pacing: shots, cut timing, edit style, change of content and light, scenes and videos, emotions.

A user's events are the frames or cuts of a video; an hour stands for a second, so that the constants are those of seconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats
from ..operators import folds
from ..operators import quantiles as Q
from ..operators import series
from .timeline_queries import W, ev, r, up, up_sql

HOUR = 3_600_000_000
EPS = 1e-9


def by_user():
    return Window.partitionBy("user_id").orderBy("ts", "event_id")


def shots(spark, d) -> DataFrame:
    """user_id, us (start), x (length) and length_s of the whole, a row for each step between a user's events."""
    w, whole = by_user(), Window.partitionBy("user_id")
    us = F.unix_micros("ts")
    df = ev(spark, d).select("user_id", "event_id", us.alias("us"), ((F.lead(us).over(w) - us) / HOUR).alias("x"), F.min(us).over(whole).alias("first"), ((F.max(us).over(whole) - F.min(us).over(whole)) / HOUR).alias("length_s"), F.lag(us).over(w).isNotNull().alias("is_cut"))
    return df


SHOTS = f"""shots AS (SELECT user_id, event_id, epoch_us(ts) AS us, (lead(epoch_us(ts)) {W} - epoch_us(ts)) / {HOUR} AS x, min(epoch_us(ts)) OVER (PARTITION BY user_id) AS first, (max(epoch_us(ts)) OVER (PARTITION BY user_id) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / {HOUR} AS length_s, lag(epoch_us(ts)) {W} IS NOT NULL AS is_cut FROM events)"""


def measured(df: DataFrame) -> DataFrame:
    """Figures of the shots with a length, a row a user."""
    whole = Window.partitionBy("user_id")
    df = Q.ranked(df.filter("x is not null"), ["user_id"], "x").withColumn("lo", F.min("x").over(whole)).withColumn("hi", F.max("x").over(whole))
    nb = F.least(F.lit(20), F.greatest(F.lit(2), F.col("_n"))).cast("int")
    own = lambda bins: stats.bin_of(F.col("x"), F.col("lo"), F.col("hi"), bins)
    df = df.withColumn("b20", own(20)).withColumn("nb", nb).withColumn("bn", own(F.col("nb"))).withColumn("b8", own(8))
    edges = (0.3, 0.7, 1.5, 3.0)
    five = F.lit(0)
    for e in edges:
        five = five + (F.col("x") >= e).cast("int")
    df = df.withColumn("b5", five)
    share = lambda test: F.avg(test.cast("double"))
    g = df.groupBy("user_id").agg(
        F.count("*").alias("shots"), F.avg("x").alias("mean"), Q.at("x", 0.5).alias("median"), F.min("x").alias("least"), F.max("x").alias("greatest"), F.stddev_pop("x").alias("std"), F.max("length_s").alias("length_s"), F.max("nb").alias("nb"),
        stats.gini(F.col("x"), F.col("_k") + 1, F.col("_n")).alias("gini"), *(Q.at("x", q / 100).alias(f"p{q}") for q in (10, 25, 75, 90)), share(F.col("x") < 0.5).alias("below_half"), share(F.col("x") < 1).alias("short"), share(F.col("x") > 4).alias("long"),
        F.count_if(F.col("x") > 10).alias("very_long"), F.count_if(F.col("x") < 0.25).alias("extremely_short"), *(stats.bin_counts(F.col(f"b{k}"), n).alias(f"c{k}") for k, n in (("20", 20), ("n", 20), ("8", 8), ("5", 5))))
    cv = F.col("std") / (F.col("mean") + EPS)
    entropy = stats.counts_entropy(F.slice("cn", F.lit(1), F.col("nb"))) / (F.log(F.col("nb")) + EPS)
    return g.withColumn("entropy20", stats.counts_entropy(F.col("c20"))).withColumn("tempo_entropy", stats.counts_entropy(F.col("c5"))).withColumn("cv", cv).withColumn("interval_entropy", entropy).withColumn("uniformity", 1 - F.least(F.lit(1.0), F.greatest(F.lit(0.0), cv))).withColumn("per_minute", (F.col("shots") + 1) / F.greatest("length_s", F.lit(1e-6)) * 60).withColumn("norm_mean", F.col("mean") / F.greatest("length_s", F.lit(1e-6)))


def _bins(b: str, n: str) -> str:
    return f"list_transform(range(0, {n}), lambda i: len(list_filter({b}, lambda y: y = i)))"


def _entropy(c: str) -> str:
    total = f"list_sum(list_transform({c}, lambda z: z + 1e-9))"
    return f"list_sum(list_transform({c}, lambda z: -(z + 1e-9) / {total} * ln((z + 1e-9) / {total})))"


MEASURED = f"""s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY x) AS k, count(*) OVER (PARTITION BY user_id) AS n, min(x) OVER (PARTITION BY user_id) AS lo, max(x) OVER (PARTITION BY user_id) AS hi, least(20, greatest(2, count(*) OVER (PARTITION BY user_id))) AS nb FROM shots WHERE x IS NOT NULL),
b AS (SELECT *, {', '.join(f"(CASE WHEN hi > lo THEN least({n} - 1, floor((x - lo) / ((hi - lo) / {n}))) ELSE floor({n} / 2) END)::INT AS b{k}" for k, n in (("20", "20"), ("n", "nb"), ("8", "8")))}, (x >= 0.3)::INT + (x >= 0.7)::INT + (x >= 1.5)::INT + (x >= 3)::INT AS b5 FROM s),
l AS (SELECT user_id, count(*) AS shots, avg(x) AS mean, median(x) AS median, min(x) AS least, max(x) AS greatest, stddev_pop(x) AS std, max(length_s) AS length_s, max(nb) AS nb, CASE WHEN sum(x) > 0 THEN sum((2 * k - n - 1) * x) / (max(n) * sum(x)) ELSE 0 END AS gini, {', '.join(f'quantile_cont(x, {q / 100}) AS p{q}' for q in (10, 25, 75, 90))},
 avg((x < 0.5)::INT) AS below_half, avg((x < 1)::INT) AS short, avg((x > 4)::INT) AS long, count(*) FILTER (x > 10) AS very_long, count(*) FILTER (x < 0.25) AS extremely_short, list(b20) AS b20, list(bn) AS bn, list(b8) AS b8, list(b5) AS b5 FROM b GROUP BY 1),
c AS (SELECT *, {_bins('b20', '20')} AS c20, {_bins('bn', 'nb')} AS cn, {_bins('b8', '8')} AS c8, {_bins('b5', '5')} AS c5, std / (mean + 1e-9) AS cv FROM l),
m AS (SELECT *, {_entropy('c20')} AS entropy20, {_entropy('c5')} AS tempo_entropy, {_entropy('cn')} / (ln(nb) + 1e-9) AS interval_entropy, 1 - least(1.0, greatest(0.0, cv)) AS uniformity, (shots + 1) / greatest(length_s, 1e-6) * 60 AS per_minute, mean / greatest(length_s, 1e-6) AS norm_mean FROM c)"""

_A1 = ("mean", "median", "least", "greatest", "std", "entropy20", "norm_mean", "gini", "below_half", "tempo_entropy")


def shot_statistics(spark, d):
    """Shot lengths, their entropy and Gini, cuts in windows of ten seconds, dense bursts, and cuts along eight parts."""
    df = shots(spark, d)
    cuts = df.filter("is_cut").withColumn("rel", (F.col("us") - F.col("first")) / HOUR)
    near = F.count("*").over(Window.partitionBy("user_id").orderBy("us").rangeBetween(0, HOUR))
    part = F.least(F.lit(7), F.floor(F.col("rel") / (F.col("length_s") / 8)))
    windows = F.greatest(F.lit(1), F.ceil(F.col("length_s") / 10))
    own = cuts.withColumn("near", near).groupBy("user_id").agg(F.count_if(F.col("near") >= 3).alias("bursts"), *(r(F.count_if(part == i) / F.greatest(F.max("length_s") / 8, F.lit(1e-6))).alias(f"density{i}") for i in range(8)))
    per = cuts.groupBy("user_id", F.least(windows - 1, F.floor(F.col("rel") / 10)).alias("win")).agg(F.count("*").alias("c"), F.max(windows).alias("all"), F.max("length_s").alias("length_s"))
    per = Q.ranked(per, ["user_id"], "c")
    blank, half = F.col("all") - F.col("_n"), (F.col("all") - 1) / 2
    middle = F.sum(F.when(F.col("_k") + blank == F.floor(half), F.col("c") / 2).otherwise(0.0) + F.when(F.col("_k") + blank == F.ceil(half), F.col("c") / 2).otherwise(0.0))
    per = per.groupBy("user_id").agg(r(F.sum("c") / F.greatest(F.max("length_s") / 10, F.lit(1e-6))).alias("per_10s"), r(F.max("c") / 10).alias("per_10s_max"), r(middle / 10).alias("per_10s_median"))
    figures = measured(df).select("user_id", "shots", *(r(c).alias(c) for c in _A1), *(r(F.col("c5")[i] / F.col("shots")).alias(f"hist{i}") for i in range(5)))
    return figures.join(own, "user_id").join(per, "user_id")


SHOT_STATISTICS = f"""WITH {SHOTS}, {MEASURED}, cuts AS (SELECT *, (us - first) / {HOUR} AS rel, greatest(1, ceil(length_s / 10)) AS nw, count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN CURRENT ROW AND {HOUR} FOLLOWING) AS near FROM shots WHERE is_cut),
o AS (SELECT user_id, count(*) FILTER (near >= 3) AS bursts, {', '.join(f'round(count(*) FILTER (least(7, floor(rel / (length_s / 8))) = {i}) / greatest(max(length_s) / 8, 1e-6), 6) AS density{i}' for i in range(8))}, count(*) / greatest(max(length_s) / 10, 1e-6) AS per_10s FROM cuts GROUP BY 1),
g AS (SELECT user_id, nw, unnest(range(0, nw::BIGINT)) AS win FROM (SELECT DISTINCT user_id, nw FROM cuts)), q AS (SELECT g.user_id, g.win, count(c.us) AS c FROM g LEFT JOIN cuts c ON c.user_id = g.user_id AND least(c.nw - 1, floor(c.rel / 10)) = g.win GROUP BY 1, 2),
p AS (SELECT user_id, round(max(c) / 10, 6) AS per_10s_max, round(median(c) / 10, 6) AS per_10s_median FROM q GROUP BY 1)
SELECT user_id, shots, {', '.join(f'round({c}, 6) AS {c}' for c in _A1)}, {', '.join(f'round(c5[{i + 1}] / shots, 6) AS hist{i}' for i in range(5))}, o.* EXCLUDE (user_id, per_10s), round(per_10s, 6) AS per_10s, p.* EXCLUDE (user_id) FROM m JOIN o USING (user_id) JOIN p USING (user_id)"""

_A2 = ("per_minute", "median", "least", "greatest", "std", "cv", "interval_entropy", "uniformity", "mean", "p10", "p25", "p75", "p90", "short", "long")


def cut_timing(spark, d):
    """Cuts a minute, interval figures with normalised entropy and uniformity, and the histogram of shot lengths in eight bins."""
    return measured(shots(spark, d)).select("user_id", *(r(c).alias(c) for c in _A2), "very_long", "extremely_short", *(r(F.col("c8")[i] / F.col("shots")).alias(f"hist{i}") for i in range(8)))


CUT_TIMING = f"WITH {SHOTS}, {MEASURED} SELECT user_id, {', '.join(f'round({c}, 6) AS {c}' for c in _A2)}, very_long, extremely_short, {', '.join(f'round(c8[{i + 1}] / shots, 6) AS hist{i}' for i in range(8))} FROM m"

# Scores of six styles, as SQL that both engines read; m is a row of figures with its counts of jumps, motions and styled cuts.
_JUMP, _MOTION = "(jumps / (length_s / 60.0 + 1e-9))", "(motions / (cuts + 1e-9))"
_SLOW1 = "CASE WHEN per_minute < 8 AND mean > 5.0 AND uniformity > 0.7 THEN least(1.0, (1.0 - per_minute / 15.0) * 0.4 + mean / 10.0 * 0.3 + uniformity * 0.3) ELSE 0.0 END"
_SLOW2 = "least(1.0, (1.0 - per_minute / 12.0) * 0.5 + mean / 15.0 * 0.3 + (1.0 - std) * 0.2)"
_SLOW3 = "least(1.0, (1.0 - per_minute / 12.0) * 0.5 + mean / 15.0 * 0.3)"
STYLES = {
    "fast": "CASE WHEN per_minute > 20 AND mean < 2.0 AND std > 0.5 THEN least(1.0, per_minute / 60.0 * 0.5 + (1.0 - mean / 3.0) * 0.3 + std * 0.2) ELSE 0.0 END",
    "slow": f"CASE WHEN per_minute < 6 AND mean > 8.0 AND std < 0.3 THEN CASE WHEN greatest({_SLOW1}, {_SLOW2}) < 0.3 THEN {_SLOW3} ELSE greatest({_SLOW1}, {_SLOW2}) END ELSE {_SLOW1} END",
    "social": f"CASE WHEN {_JUMP} > 3.0 AND per_minute > 15 AND short > 0.3 THEN least(1.0, {_JUMP} / 10.0 * 0.4 + per_minute / 40.0 * 0.3 + short * 0.3) ELSE 0.0 END",
    "cinematic": "CASE WHEN per_minute > 5 AND per_minute < 15 AND mean > 3.0 AND styled > cuts * 0.2 THEN least(1.0, mean / 6.0 * 0.4 + styled / greatest(cuts, 1) * 0.4 + (1.0 - abs(per_minute - 10) / 10.0) * 0.2) ELSE 0.0 END",
    "meme": f"CASE WHEN extremely_short > 5 AND per_minute > 25 AND {_JUMP} > 2.0 AND uniformity < 0.5 THEN least(1.0, extremely_short / 20.0 * 0.3 + per_minute / 50.0 * 0.3 + {_JUMP} / 8.0 * 0.2 + (1.0 - uniformity) * 0.2) ELSE 0.0 END",
    "high_action": f"CASE WHEN {_MOTION} > 0.3 AND per_minute > 18 AND mean > 1.0 AND mean < 4.0 THEN least(1.0, {_MOTION} * 0.4 + per_minute / 40.0 * 0.3 + (1.0 - abs(mean - 2.5) / 2.5) * 0.3) ELSE 0.0 END",
}


def edit_style(spark, d, pace: float = 6.0):
    """Shares of six editing styles; users' lengths are divided by the user's number and ``pace``, so that all rules are met."""
    factor = 1 + F.col("user_id") % 9 * pace
    kinds = ev(spark, d).groupBy("user_id").agg(F.count_if(F.col("event_type") == "click").alias("jumps"), F.count_if(F.col("event_type") == "view").alias("motions"), F.count_if(F.col("event_type") == "signup").alias("styled"), F.count("*").alias("cuts"))
    m = measured(shots(spark, d).withColumn("x", F.col("x") / factor).withColumn("length_s", F.col("length_s") / factor)).join(kinds, "user_id")
    m = m.select("user_id", *(F.expr(e).alias(k) for k, e in STYLES.items()))
    total = sum((F.col(k) for k in STYLES), F.lit(1e-9))
    return m.select("user_id", *(r(F.col(k) / total).alias(k) for k in STYLES))


EDIT_STYLE = f"""WITH all_shots AS (WITH {SHOTS} SELECT * FROM shots), shots AS (SELECT * REPLACE (x / (1 + user_id % 9 * 6.0::DOUBLE) AS x, length_s / (1 + user_id % 9 * 6.0::DOUBLE) AS length_s) FROM all_shots), {MEASURED},
k AS (SELECT user_id, count(*) FILTER (event_type = 'click') AS jumps, count(*) FILTER (event_type = 'view') AS motions, count(*) FILTER (event_type = 'signup') AS styled, count(*) AS cuts FROM events GROUP BY 1), j AS (SELECT m.*, k.* EXCLUDE (user_id) FROM m JOIN k USING (user_id)),
e AS (SELECT user_id, {', '.join(f'({e})::DOUBLE AS {k}' for k, e in STYLES.items())} FROM j) SELECT user_id, {', '.join(f"round({k} / ({' + '.join(STYLES)} + 1e-9), 6) AS {k}" for k in STYLES)} FROM e"""


def changes(spark, d) -> DataFrame:
    """user_id, mid (middle of the step), rate (absolute change a second), signed rate and length_s, for each step."""
    w, whole = by_user(), Window.partitionBy("user_id")
    us = F.unix_micros("ts")
    dt = F.greatest((us - F.lag(us).over(w)) / HOUR, F.lit(1e-3))
    df = ev(spark, d).select("user_id", "ts", "event_id", ((us + F.lag(us).over(w)) / 2 / HOUR).alias("mid"), ((F.col("value") - F.lag("value").over(w)) / dt).alias("signed"), ((F.max(us).over(whole) - F.min(us).over(whole)) / HOUR).alias("length_s"))
    return df.filter("signed is not null").withColumn("rate", F.abs("signed"))


CHANGES = f"""changes AS (SELECT * FROM (SELECT user_id, ts, event_id, (epoch_us(ts) + lag(epoch_us(ts)) {W}) / 2 / {HOUR} AS mid, (value - lag(value) {W}) / greatest((epoch_us(ts) - lag(epoch_us(ts)) {W}) / {HOUR}, 1e-3) AS signed, (max(epoch_us(ts)) OVER (PARTITION BY user_id) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / {HOUR} AS length_s FROM events) WHERE signed IS NOT NULL)"""


def content_change(spark, d):
    """Smoothed change rates: mean, deviation, share above the third quartile, jumps over two deviations and bursts of them."""
    w, whole = by_user(), Window.partitionBy("user_id")
    df = changes(spark, d)
    smooth = F.when(F.count("*").over(whole) >= 7, F.sum("rate").over(w.rowsBetween(-2, 2)) / 5).otherwise(F.col("rate"))
    df = Q.ranked(df.withColumn("s", smooth), ["user_id"], "s")
    df = df.withColumn("m", F.avg("s").over(whole)).withColumn("d", F.stddev_pop("s").over(whole)).withColumn("q", Q.at("s", 0.75, whole))
    high = F.col("s") > F.col("m") + 2 * F.col("d")
    g = df.groupBy("user_id").agg(r(F.first("m")).alias("mean"), r(F.first("d")).alias("std"), r(F.avg((F.col("s") > F.col("q")).cast("double"))).alias("high_ratio"), F.count_if(high).alias("jumps"))
    found = folds.folded(df.filter(high), "user_id", ["mid"], ["mid"], "user_id long, bursts long", folds.bursts(5.0, 3))
    return g.join(found, "user_id", "left").select("user_id", "mean", "std", "high_ratio", "jumps", F.coalesce("bursts", F.lit(0)).alias("bursts"))


CONTENT_CHANGE = f"""WITH RECURSIVE {CHANGES}, s AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY user_id) >= 7 THEN sum(rate) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5 ELSE rate END AS s FROM (SELECT *, abs(signed) AS rate FROM changes)),
t AS (SELECT user_id, avg(s) AS m, stddev_pop(s) AS d, quantile_cont(s, 0.75) AS q FROM s GROUP BY 1), g AS (SELECT user_id, round(max(m), 6) AS mean, round(max(d), 6) AS std, round(avg((s > q)::INT), 6) AS high_ratio, count(*) FILTER (s > m + 2 * d) AS jumps FROM s JOIN t USING (user_id) GROUP BY 1),
h AS MATERIALIZED (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY mid) AS k, count(*) OVER (PARTITION BY user_id ORDER BY mid RANGE BETWEEN CURRENT ROW AND 5.0 FOLLOWING) AS c FROM s JOIN t USING (user_id) WHERE s > m + 2 * d),
f(user_id, k) AS (SELECT DISTINCT user_id, 1::BIGINT FROM h UNION ALL SELECT f.user_id, f.k + h.c FROM f JOIN h ON h.user_id = f.user_id AND h.k = f.k),
b AS (SELECT f.user_id, count(*) FILTER (c >= 3) AS bursts FROM f JOIN h ON h.user_id = f.user_id AND h.k = f.k GROUP BY 1) SELECT g.*, coalesce(bursts, 0) AS bursts FROM g LEFT JOIN b USING (user_id)"""


def light_spikes(spark, d):
    """Change rates beyond the median by its size and six median deviations, a minute; and means of the rates."""
    whole = Window.partitionBy("user_id")
    df = Q.ranked(changes(spark, d), ["user_id"], "signed").withColumn("med", Q.at("signed", 0.5, whole)).withColumn("dev", F.abs(F.col("signed") - F.col("med")))
    df = Q.ranked(df, ["user_id"], "dev").withColumn("mad", Q.at("dev", 0.5, whole))
    spike = F.col("dev") > F.abs("med") + 6 * (F.col("mad") + EPS)
    return df.groupBy("user_id").agg(r(F.count_if(spike) / F.greatest(F.max("length_s") / 60, F.lit(1e-6))).alias("spikes_per_minute"), r(F.avg("rate")).alias("rate_mean"), r(F.stddev_pop("rate")).alias("rate_std"), r(F.stddev_pop("signed")).alias("signed_std"))


LIGHT_SPIKES = f"""WITH {CHANGES}, m AS (SELECT *, median(signed) OVER (PARTITION BY user_id) AS med FROM changes), a AS (SELECT *, median(abs(signed - med)) OVER (PARTITION BY user_id) AS mad FROM m)
SELECT user_id, round(count(*) FILTER (abs(signed - med) > abs(med) + 6 * (mad + 1e-9)) / greatest(max(length_s) / 60, 1e-6), 6) AS spikes_per_minute, round(avg(abs(signed)), 6) AS rate_mean, round(stddev_pop(abs(signed)), 6) AS rate_std, round(stddev_pop(signed), 6) AS signed_std FROM a GROUP BY 1"""


def feelings(spark, d) -> DataFrame:
    """Events as frames with valence, arousal, confidence and a label."""
    i = F.col("event_id")
    return ev(spark, d).select("user_id", "ts", "event_id", ((i * 7 % 21) / 10 - 1).alias("valence"), ((i * 5 % 13) / 12).alias("arousal"), (F.col("value") / 500).alias("confidence"), F.col("event_type").alias("label"))


FEELINGS = "feelings AS (SELECT user_id, ts, event_id, (event_id * 7 % 21) / 10 - 1 AS valence, (event_id * 5 % 13) / 12 AS arousal, value / 500 AS confidence, event_type AS label FROM events)"


def profile(spark, d):
    """Confidence-weighted means, the dominant label (of equal ones the first by name) and the share of the neutral one."""
    df = feelings(spark, d)
    labels = df.groupBy("user_id", "label").agg(F.sum("confidence").alias("total"))
    top = labels.groupBy("user_id").agg(F.min(F.struct((-F.col("total")).alias("less"), "label")).alias("x"), F.sum(F.when(F.col("label") == "view", F.col("total")).otherwise(0.0)).alias("neutral"), F.sum("total").alias("all"))
    mean = lambda c: F.sum(F.col(c) * F.col("confidence")) / F.sum("confidence")
    g = df.groupBy("user_id").agg(*(r(mean(c)).alias(f"{c}_avg") for c in ("valence", "arousal")), *(r(F.stddev_pop(c)).alias(f"{c}_std") for c in ("valence", "arousal")))
    return g.join(top.select("user_id", F.col("x.label").alias("dominant"), (F.col("x.label") == "view").alias("is_neutral"), r(F.when(F.col("all") > 0, F.col("neutral") / F.col("all")).otherwise(0.0)).alias("neutral_share")), "user_id")


PROFILE = f"""WITH {FEELINGS}, l AS (SELECT user_id, label, sum(confidence) AS total FROM feelings GROUP BY 1, 2), t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY total DESC, label) AS k, sum(total) OVER (PARTITION BY user_id) AS whole FROM l),
g AS (SELECT user_id, round(sum(valence * confidence) / sum(confidence), 6) AS valence_avg, round(sum(arousal * confidence) / sum(confidence), 6) AS arousal_avg, round(stddev_pop(valence), 6) AS valence_std, round(stddev_pop(arousal), 6) AS arousal_std FROM feelings GROUP BY 1)
SELECT g.*, label AS dominant, label = 'view' AS is_neutral, round(coalesce((SELECT total FROM l WHERE l.user_id = t.user_id AND l.label = 'view'), 0) / whole, 6) AS neutral_share FROM g JOIN t USING (user_id) WHERE k = 1"""


def sequence_quality(spark, d):
    """Diversity of labels, transitions, longest even stretch, variance, and the verdict at the thresholds of the regime."""
    w, whole = by_user(), Window.partitionBy("user_id")
    df = feelings(spark, d)
    df = df.withColumn("dv", F.abs(F.col("valence") - F.lag("valence").over(w))).withColumn("da", F.abs(F.col("arousal") - F.lag("arousal").over(w)))
    even = F.coalesce((F.col("dv") < 0.1) & (F.col("da") < 0.1), F.lit(False))
    df = df.withColumn("even", even).withColumn("stretch", F.sum((~F.col("even")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    streak = df.groupBy("user_id", "stretch").agg(F.count("*").alias("n")).groupBy("user_id").agg(F.max(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("streak"))
    kinds = df.groupBy("user_id", "label").agg(F.count("*").alias("c")).withColumn("p", F.col("c") / F.sum("c").over(whole))
    kinds = kinds.groupBy("user_id").agg(F.sum(-F.col("p") * F.log2("p")).alias("entropy"), F.count("*").alias("labels"), F.max(F.when(F.col("label") == "view", F.col("p"))).alias("neutral"))
    g = df.groupBy("user_id").agg(F.count("*").alias("n"), (F.count_if(F.col("dv") > 0.3) + F.count_if(F.col("da") > 0.3)).alias("transitions"), (F.var_pop("valence") + F.var_pop("arousal")).alias("variance")).join(streak, "user_id").join(kinds, "user_id")
    diversity = F.when(F.col("labels") > 1, F.col("entropy") / F.log2("labels")).otherwise(0.0)
    g = g.withColumn("diversity", diversity).withColumn("overall", 0.45 * F.col("diversity") + 0.45 * F.least(F.lit(1.0), F.col("transitions") / 5) + 0.35 * (1 - F.least(F.lit(1.0), F.col("streak") / F.col("n"))) + 0.35 * F.least(F.lit(1.0), F.col("variance") / 0.5))
    flat = (F.coalesce("neutral", F.lit(0.0)) > 0.7) | ((F.col("diversity") < 0.1) & (F.col("transitions") < 2))
    valid = (F.col("n") >= 20) & (F.col("overall") >= F.when(flat, 0.2).otherwise(0.4)) & (F.col("diversity") >= F.when(flat, 0.05).otherwise(0.2))
    return g.select("user_id", "n", r("diversity").alias("diversity"), "transitions", F.col("streak").alias("longest_even"), r("variance").alias("variance"), r("overall").alias("overall"), flat.alias("is_flat"), valid.alias("is_valid"))


SEQUENCE_QUALITY = f"""WITH {FEELINGS}, l AS (SELECT *, abs(valence - lag(valence) {W}) AS dv, abs(arousal - lag(arousal) {W}) AS da FROM feelings), e AS (SELECT *, coalesce(dv < 0.1 AND da < 0.1, false) AS even FROM l), s AS (SELECT *, sum((NOT even)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS stretch FROM e),
c AS (SELECT user_id, stretch, count(*) AS n FROM s GROUP BY 1, 2), streak AS (SELECT user_id, max(CASE WHEN n > 1 THEN n ELSE 0 END) AS streak FROM c GROUP BY 1), k AS (SELECT user_id, label, count(*) / sum(count(*)) OVER (PARTITION BY user_id) AS p FROM feelings GROUP BY 1, 2),
h AS (SELECT user_id, sum(-p * log2(p)) AS entropy, count(*) AS labels, max(p) FILTER (label = 'view') AS neutral FROM k GROUP BY 1), g AS (SELECT user_id, count(*) AS n, count(*) FILTER (dv > 0.3) + count(*) FILTER (da > 0.3) AS transitions, var_pop(valence) + var_pop(arousal) AS variance FROM s GROUP BY 1),
j AS (SELECT *, CASE WHEN labels > 1 THEN entropy / log2(labels) ELSE 0 END AS diversity FROM g JOIN streak USING (user_id) JOIN h USING (user_id)), o AS (SELECT *, 0.45 * diversity + 0.45 * least(1.0, transitions / 5) + 0.35 * (1 - least(1.0, streak / n)) + 0.35 * least(1.0, variance / 0.5) AS overall, coalesce(neutral, 0) > 0.7 OR (diversity < 0.1 AND transitions < 2) AS flat FROM j)
SELECT user_id, n, round(diversity, 6) AS diversity, transitions, streak AS longest_even, round(variance, 6) AS variance, round(overall, 6) AS overall, flat AS is_flat, n >= 20 AND overall >= CASE WHEN flat THEN 0.2 ELSE 0.4 END AND diversity >= CASE WHEN flat THEN 0.05 ELSE 0.2 END AS is_valid FROM o"""


def frames(spark, d) -> DataFrame:
    """Events as frames of scenes (a user's week), with brightness and hue, and both changes within the scene."""
    i = F.col("event_id")
    df = ev(spark, d).select("user_id", F.floor(F.unix_micros("ts") / (168 * HOUR)).alias("scene"), "ts", "event_id", (F.col("value") / 2).alias("bright"), (i * 37 % 180).cast("double").alias("hue"))
    w = Window.partitionBy("user_id", "scene").orderBy("ts", "event_id")
    turn = F.abs(F.col("hue") - F.lag("hue").over(w))
    return df.withColumn("db", F.col("bright") - F.lag("bright").over(w)).withColumn("dh", F.least(turn, 180 - turn)).withColumn("shift", turn)


FRAMES = f"""fr AS (SELECT user_id, epoch_us(ts) // {168 * HOUR} AS scene, ts, event_id, value / 2 AS bright, (event_id * 37 % 180)::DOUBLE AS hue FROM events),
fl AS (SELECT *, bright - lag(bright) OVER w AS db, abs(hue - lag(hue) OVER w) AS shift FROM fr WINDOW w AS (PARTITION BY user_id, scene ORDER BY ts, event_id)), frames AS (SELECT *, least(shift, 180 - shift) AS dh FROM fl)"""

_SCENE = ("bright_mean", "bright_std", "hue_mean", "hue_std", "change_speed", "flicker", "colour_speed", "colour_variance", "flashes", "flash_share", "hue_entropy", "shift_speed", "dynamic_range")


def scenes(df: DataFrame) -> DataFrame:
    """Figures of each scene; those of changes are null for a scene of one frame, flashes need three."""
    whole = Window.partitionBy("user_id", "scene")
    df = df.withColumn("limit", F.avg("bright").over(whole) + 2 * F.stddev_pop("bright").over(whole)).withColumn("bin", stats.bin_of(F.col("hue"), F.min("hue").over(whole), F.max("hue").over(whole), 18))
    g = df.groupBy("user_id", "scene").agg(F.count("*").alias("n"), *(f(c).alias(f"{c}_{k}") for c in ("bright", "hue") for k, f in (("mean", F.avg), ("std", F.stddev_pop))), F.avg(F.abs("db")).alias("change_speed"), F.stddev_pop("db").alias("flicker"), F.avg("dh").alias("colour_speed"), F.var_pop("dh").alias("colour_variance"),
                                           F.count_if(F.abs("db") > F.col("limit")).cast("double").alias("flashes"), stats.bin_counts(F.col("bin"), 18).alias("c"), F.avg("shift").alias("shift_speed"), (F.max("bright") - F.min("bright")).alias("dynamic_range"))
    flashes = F.when(F.col("n") > 2, F.col("flashes"))
    shares = F.transform("c", lambda x: x / F.col("n"))
    return g.withColumn("flash_share", flashes / (F.col("n") - 1)).withColumn("flashes", flashes).withColumn("hue_entropy", F.when(F.col("n") > 1, stats.counts_entropy(shares, 1e-10)))


SCENES = f"""fb AS (SELECT *, avg(bright) OVER w + 2 * stddev_pop(bright) OVER w AS lim, CASE WHEN max(hue) OVER w > min(hue) OVER w THEN least(17, floor((hue - min(hue) OVER w) / ((max(hue) OVER w - min(hue) OVER w) / 18))) ELSE 9 END::INT AS bin FROM frames WINDOW w AS (PARTITION BY user_id, scene)),
sg AS (SELECT user_id, scene, count(*) AS n, avg(bright) AS bright_mean, stddev_pop(bright) AS bright_std, avg(hue) AS hue_mean, stddev_pop(hue) AS hue_std, avg(abs(db)) AS change_speed, stddev_pop(db) AS flicker, avg(dh) AS colour_speed, var_pop(dh) AS colour_variance, CASE WHEN count(*) > 2 THEN count(*) FILTER (abs(db) > lim) END::DOUBLE AS flashes, list(bin) AS b, avg(shift) AS shift_speed, max(bright) - min(bright) AS dynamic_range FROM fb GROUP BY 1, 2),
sc AS (SELECT *, list_transform({_bins('b', '18')}, lambda c: c / n) AS c FROM sg), scenes AS (SELECT *, flashes / (n - 1) AS flash_share, CASE WHEN n > 1 THEN {_entropy('c').replace('1e-9', '1e-10')} END AS hue_entropy FROM sc)"""


def scene_figures(spark, d):
    return scenes(frames(spark, d)).select("user_id", "scene", "n", *(r(c).alias(c) for c in _SCENE))


SCENE_FIGURES = f"WITH {FRAMES}, {SCENES} SELECT user_id, scene, n, {', '.join(f'round({c}, 6) AS {c}' for c in _SCENE)} FROM scenes"


def video_figures(spark, d):
    """Mean, deviation, least and greatest of every figure of a video's scenes; hue entropy in 36 bins, Gini, speeds, strobes."""
    df, whole = frames(spark, d), Window.partitionBy("user_id")
    rolled = scenes(df).groupBy("user_id").agg(F.count("*").alias("scenes"), *(up(f(c)).alias(f"{c}_{k}") for c in _SCENE for k, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))))
    w = by_user()
    turn = F.abs(F.col("hue") - F.lag("hue").over(w))
    all_ = Q.ranked(df.select("user_id", "ts", "event_id", "bright", "hue"), ["user_id"], "hue").withColumn("db", F.abs(F.col("bright") - F.lag("bright").over(w))).withColumn("dh", F.least(turn, 180 - turn)).withColumn("bin", stats.bin_of(F.col("hue"), F.min("hue").over(whole), F.max("hue").over(whole), 36)).withColumn("limit", F.avg("bright").over(whole) + 1.5 * F.stddev_pop("bright").over(whole))
    g = all_.groupBy("user_id").agg(stats.bin_counts(F.col("bin"), 36).alias("c"), F.count("*").alias("n"), up(stats.gini(F.col("hue"), F.col("_k") + 1, F.col("_n"))).alias("hue_gini"), up(F.avg("db")).alias("global_change_speed"), up(F.avg("dh")).alias("global_colour_speed"), up(F.when(F.count("*") > 2, F.count_if(F.col("db") > F.col("limit")) / (F.count("*") - 1))).alias("strobe_frequency"))
    g = g.select("user_id", up(stats.counts_entropy(F.transform("c", lambda x: x / F.col("n")), 1e-10)).alias("hue_entropy"), "hue_gini", "global_change_speed", "global_colour_speed", "strobe_frequency")
    return rolled.join(g, "user_id")


VIDEO_FIGURES = f"""WITH {FRAMES}, {SCENES}, rolled AS (SELECT user_id, count(*) AS scenes, {', '.join(f'round({f}({c}), 6) AS {c}_{k}' for c in _SCENE for k, f in (('mean', 'avg'), ('std', 'stddev_pop'), ('min', 'min'), ('max', 'max')))} FROM scenes GROUP BY 1),
al AS (SELECT user_id, bright, hue, abs(bright - lag(bright) {W}) AS db, abs(hue - lag(hue) {W}) AS turn, row_number() OVER (PARTITION BY user_id ORDER BY hue) AS k, count(*) OVER v AS nn, avg(bright) OVER v + 1.5 * stddev_pop(bright) OVER v AS lim, CASE WHEN max(hue) OVER v > min(hue) OVER v THEN least(35, floor((hue - min(hue) OVER v) / ((max(hue) OVER v - min(hue) OVER v) / 36))) ELSE 18 END::INT AS bin FROM fr WINDOW v AS (PARTITION BY user_id)),
ag AS (SELECT user_id, list(bin) AS b, count(*) AS n, round(CASE WHEN sum(hue) > 0 THEN sum((2 * k - nn - 1) * hue) / (max(nn) * sum(hue)) ELSE 0 END, 6) AS hue_gini, round(avg(db), 6) AS global_change_speed, round(avg(least(turn, 180 - turn)), 6) AS global_colour_speed, round(CASE WHEN count(*) > 2 THEN count(*) FILTER (db > lim) / (count(*) - 1) END, 6) AS strobe_frequency FROM al GROUP BY 1),
ac AS (SELECT *, list_transform({_bins('b', '36')}, lambda c: c / n) AS c FROM ag) SELECT rolled.*, round({_entropy('c').replace('1e-9', '1e-10')}, 6) AS hue_entropy, hue_gini, global_change_speed, global_colour_speed, strobe_frequency FROM rolled JOIN ac USING (user_id)"""


def segments(spark, d, gap: float = 12.0, longest: float = 48.0):
    """Segments of a user's times: a new one after a gap, or when the start is too far back."""
    df = ev(spark, d).select("user_id", (F.unix_micros("ts") / HOUR).alias("t"))
    got = folds.folded(df, "user_id", ["t"], ["t"], "user_id long, start double, end double, n long", folds.bounded_segments(gap, longest))
    return got.select("user_id", r("start").alias("start"), r("end").alias("end"), "n")


SEGMENTS = f"""WITH RECURSIVE o AS MATERIALIZED (SELECT user_id, epoch_us(ts) / {HOUR} AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS k FROM events), s(user_id, k, t, start) AS (SELECT user_id, k, t, t FROM o WHERE k = 1
UNION ALL SELECT o.user_id, o.k, o.t, CASE WHEN o.t - s.t > 12 OR o.t - s.start > 48 THEN o.t ELSE s.start END FROM s JOIN o ON o.user_id = s.user_id AND o.k = s.k + 1)
SELECT user_id, round(start, 6) AS start, round(max(t), 6) AS "end", count(*) AS n FROM s GROUP BY user_id, start"""

# Window and stride of each family, in seconds.
FAMILIES = {"tempo": (15, 5), "asr": (30, 25), "diarization": (2, 2), "emotion": (4, 2), "separation": (15, 15), "primary": (2, 2)}


def families(spark, d):
    """Windows of six families over each user's length: how many, how many are cut at the end, and the rows that they hold (a row
    counts for each window it is in)."""
    df = shots(spark, d).select("user_id", "length_s", ((F.col("us") - F.col("first")) / HOUR).alias("t"))
    rows = F.array(*(F.struct(F.lit(k).alias("family"), F.lit(float(w)).alias("w"), F.lit(float(s)).alias("s")) for k, (w, s) in FAMILIES.items()))
    df = df.select("user_id", "length_s", "t", F.inline(rows))
    n = F.greatest(F.lit(1), F.ceil(F.col("length_s") / F.col("s")))
    held = F.least(n - 1, F.floor(F.col("t") / F.col("s"))) - F.greatest(F.lit(0), F.floor((F.col("t") - F.col("w")) / F.col("s")) + 1) + 1
    whole = F.greatest(F.lit(0), F.floor((F.col("length_s") - F.col("w")) / F.col("s")) + 1)
    return df.groupBy("user_id", "family").agg(F.max(n).alias("windows"), F.max(n - F.least(n, whole)).alias("cut"), F.sum(F.greatest(F.lit(0), held)).alias("rows_held"))


FAMILIES_SQL = f"""WITH {SHOTS}, f AS (SELECT user_id, length_s, (us - first) / {HOUR} AS t, family, w, s, greatest(1, ceil(length_s / s)) AS n FROM shots CROSS JOIN (VALUES {', '.join(f"('{k}', {w}.0::DOUBLE, {s}.0::DOUBLE)" for k, (w, s) in FAMILIES.items())}) v(family, w, s)),
u AS (SELECT DISTINCT user_id, family, length_s, w, s, unnest(range(0, n::BIGINT)) AS k, n FROM (SELECT DISTINCT user_id, family, length_s, w, s, n FROM f)), c AS (SELECT user_id, family, count(*) AS windows, count(*) FILTER (k * s + w > length_s) AS cut FROM u GROUP BY 1, 2),
h AS (SELECT f.user_id, f.family, count(*) AS rows_held FROM f JOIN u ON u.user_id = f.user_id AND u.family = f.family AND t >= k * f.s AND t < k * f.s + f.w GROUP BY 1, 2) SELECT user_id, family, windows, cut, coalesce(rows_held, 0) AS rows_held FROM c LEFT JOIN h USING (user_id, family)"""

#: Deviations over the median from which each of three signals tells a cut; rows between kept cuts.
TRIGGERS, APART = {"hist": 2.0, "ssim": 1.5, "flow": 2.0}, 5


def hard_cuts(spark, d):
    """Steps at which two or three of three signals are over their adaptive thresholds, more than five rows after the last kept
    one, with the number of signals as strength."""
    w = by_user()
    df = ev(spark, d).select("user_id", "ts", "event_id", F.col("value").alias("a"), (F.col("event_id") * 13 % 97 / 97).alias("b"), F.sqrt("value").alias("c"))
    df = df.select("user_id", F.row_number().over(w).alias("place"), *(F.abs(F.col(x) - F.lag(x).over(w)).alias(k) for x, k in zip("abc", TRIGGERS, strict=True))).filter("hist is not null")
    whole = Window.partitionBy("user_id")
    for k in TRIGGERS:
        df = Q.beside(df, ["user_id"], k, {f"{k}_mid": 0.5})
    score = sum(((F.col(k) > F.col(f"{k}_mid") + n * F.stddev_pop(k).over(whole)).cast("int") for k, n in TRIGGERS.items()), F.lit(0))
    found = df.withColumn("strength", score).filter("strength >= 2").select("user_id", F.col("place").cast("long").alias("place"), F.col("strength").cast("long").alias("strength"))
    kept = series.leaps(found, "user_id", "place", APART + 1).select("user_id", F.col("t").alias("place"))
    return kept.join(found, ["user_id", "place"])


HARD_CUTS = f"""WITH RECURSIVE e AS (SELECT user_id, ts, event_id, value AS a, event_id * 13 % 97 / 97 AS b, sqrt(value) AS c FROM events), s AS (SELECT user_id, row_number() {W} AS place, {', '.join(f'abs({x} - lag({x}) {W}) AS {k}' for x, k in zip('abc', TRIGGERS, strict=True))} FROM e),
t AS (SELECT user_id, place, {' + '.join(f'({k} > median({k}) OVER u + {n} * stddev_pop({k}) OVER u)::INT' for k, n in TRIGGERS.items())} AS strength FROM s WHERE hist IS NOT NULL WINDOW u AS (PARTITION BY user_id)), c AS MATERIALIZED (SELECT * FROM t WHERE strength >= 2),
f(user_id, place) AS (SELECT user_id, min(place) FROM c GROUP BY 1 UNION ALL SELECT f.user_id, min(c.place) FROM f JOIN c ON c.user_id = f.user_id AND c.place > f.place + {APART} GROUP BY f.user_id)
SELECT user_id, place, strength::BIGINT AS strength FROM f JOIN c USING (user_id, place)"""

_ALL = {
    "e2_families": (families, FAMILIES_SQL), "e5_hard_cuts": (hard_cuts, HARD_CUTS),
    "a1_shot_statistics": (shot_statistics, SHOT_STATISTICS), "a2_cut_timing": (cut_timing, CUT_TIMING), "a4_edit_style": (edit_style, EDIT_STYLE), "a13_content_change": (content_change, CONTENT_CHANGE), "a14_light_spikes": (light_spikes, LIGHT_SPIKES),
    "a17_profile": (profile, PROFILE), "a18_sequence_quality": (sequence_quality, SEQUENCE_QUALITY), "a7_scene_figures": (scene_figures, SCENE_FIGURES), "a8_video_figures": (video_figures, up_sql(VIDEO_FIGURES)), "e3_bounded_segments": (segments, SEGMENTS),
}
QUERIES = {k: v[0] for k, v in _ALL.items()}
ORACLES = {k: v[1] for k, v in _ALL.items()}
