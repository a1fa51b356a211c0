"""Queries of filters, trends, segment rollups and vector pooling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import signal as G
from ..functions import vectors as V
from ..operators import quantiles as Q
from ..operators import series
from ..operators import timeline as T
from .flow_queries import W, by_user, ev, r
from .timeline_queries import up


def whole():
    return Window.partitionBy("user_id")


def moving(spark, d):
    """Moving averages of five rows: zeros beyond the ends, and over the rows there are."""
    w = by_user().rowsBetween(-2, 2)
    return ev(spark, d).select("event_id", r(F.sum("value").over(w) / 5).alias("same"), r(F.avg("value").over(w)).alias("shrunk"))


MOVING = """SELECT event_id, round(sum(value) OVER w / 5, 6) AS same, round(avg(value) OVER w, 6) AS shrunk FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"""


def smooth(spark, d):
    """Gaussian smoothing (sigma 1) and a median filter of five."""
    return ev(spark, d).select("event_id", r(G.gaussian("value", by_user(), 1.0)).alias("smooth"), r(G.median_filter("value", by_user())).alias("median5"))


def _tap(k: int, edge: str) -> str:
    return "value" if k == 0 else f"coalesce({'lag' if k < 0 else 'lead'}(value, {abs(k)}) {W}, {edge})"


_FIRST, _LAST = ("first_value(value) OVER u", "last_value(value) OVER u")
SMOOTH = f"""SELECT event_id, round({' + '.join(f'{x!r}::DOUBLE * {_tap(k - 4, _FIRST if k < 4 else _LAST)}' for k, x in enumerate(G.kernel(1.0)))}, 6) AS smooth,
round(list_sort([{', '.join(_tap(k, '0') for k in range(-2, 3))}])[3], 6) AS median5
FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""


def autocorrelation(spark, d):
    """The lag of a row or more with the highest autocorrelation of each user's values, over all lags there are."""
    return series.best_lag(ev(spark, d), "user_id", ["ts", "event_id"], "value").select("user_id", "lag", r("correlation").alias("correlation"))


AUTOCORRELATION = f"""WITH x AS (SELECT user_id, value - avg(value) OVER (PARTITION BY user_id) AS x, row_number() {W} AS k FROM events), v AS (SELECT user_id, sum(x * x) AS v FROM x GROUP BY 1),
c AS (SELECT a.user_id, b.k - a.k AS lag, sum(a.x * b.x) AS c FROM x a JOIN x b ON a.user_id = b.user_id AND b.k > a.k GROUP BY 1, 2), m AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, lag) AS n FROM c)
SELECT user_id, lag, round(CASE WHEN v > 0 THEN c / v ELSE 0 END, 6) AS correlation FROM m JOIN v USING (user_id) WHERE n = 1"""


def circular(spark, d):
    """Circular mean and deviation of the time of day, and the entropy of its eight parts (one added to each)."""
    day = F.pmod(F.unix_micros("ts"), F.lit(86_400_000_000)) / 86_400_000_000
    a = day * 2 * F.pi()
    parts = [F.sum(F.when(F.floor(day * 8) == i, 1).otherwise(0)) for i in range(8)]
    p = [(n + 1) / (F.count("*") + 8) for n in parts]
    size = F.sqrt(F.avg(F.sin(a)) ** 2 + F.avg(F.cos(a)) ** 2)
    entropy = -sum((x * F.log(x) for x in p[1:]), p[0] * F.log(p[0]))
    return ev(spark, d).groupBy("user_id").agg(r(F.atan2(F.avg(F.sin(a)), F.avg(F.cos(a)))).alias("mean_angle"), r(F.sqrt(F.greatest(-2 * F.log(size), F.lit(0.0)))).alias("spread"), r(entropy).alias("entropy"))


CIRCULAR = f"""WITH a AS (SELECT user_id, (epoch_us(ts) % 86400000000) / 86400000000 AS day FROM events),
g AS (SELECT user_id, avg(sin(day * 2 * pi())) AS s, avg(cos(day * 2 * pi())) AS c, {', '.join(f'(count(*) FILTER (floor(day * 8) = {i}) + 1) / (count(*) + 8) AS p{i}' for i in range(8))} FROM a GROUP BY 1)
SELECT user_id, round(atan2(s, c), 6) AS mean_angle, round(sqrt(greatest(-2 * ln(sqrt(s * s + c * c)), 0)), 6) AS spread, round(-({' + '.join(f'p{i} * ln(p{i})' for i in range(8))}), 6) AS entropy FROM g"""


def stable_mean(spark, d):
    """Mean of the values within four median absolute deviations of their user's median, and the spikes above."""
    df = Q.beside(ev(spark, d).select("user_id", "value"), ["user_id"], "value", {"med": 0.5})
    df = Q.beside(df.withColumn("dev", F.abs(F.col("value") - F.col("med"))), ["user_id"], "dev", {"mad": 0.5})
    own = F.abs(F.col("value") - F.col("med")) <= 4 * F.col("mad")
    return df.groupBy("user_id").agg(up(F.avg(F.when(own, F.col("value")))).alias("stable_mean"), F.sum(F.when(F.col("value") > F.col("med") + 4 * F.col("mad"), 1).otherwise(0)).alias("spikes"))


STABLE_MEAN = """WITH m AS (SELECT user_id, value, quantile_cont(value, 0.5) OVER (PARTITION BY user_id) AS med FROM events),
n AS (SELECT *, quantile_cont(abs(value - med), 0.5) OVER (PARTITION BY user_id) AS mad FROM m)
SELECT user_id, round(avg(value) FILTER (abs(value - med) <= 4 * mad) + 1e-9, 6) AS stable_mean, count(*) FILTER (value > med + 4 * mad) AS spikes FROM n GROUP BY 1"""


def story(spark, d):
    """Per user: mean of the first 15 % of the time, the climax and its place, the share of rows at the 90th percentile or over."""
    t, w = F.unix_micros("ts"), whole()
    df = Q.beside(ev(spark, d), ["user_id"], "value", {"p90": 0.9}).withColumn("a", F.min(t).over(w)).withColumn("b", F.max(t).over(w))
    df = df.withColumn("at", F.when(F.col("b") > F.col("a"), (t - F.col("a")) / (F.col("b") - F.col("a"))).otherwise(F.lit(0.0)))
    top = F.max(F.struct("value", "event_id", "at"))
    got = df.groupBy("user_id").agg(F.avg(F.when(F.col("at") <= 0.15, F.col("value"))).alias("hook"), top.alias("top"), F.avg((F.col("value") >= F.col("p90")).cast("int")).alias("peaks"))
    return got.select("user_id", r("hook").alias("hook"), F.col("top.event_id").alias("climax"), r("top.at").alias("climax_at"), r("peaks").alias("peaks"))


STORY = """WITH x AS (SELECT user_id, event_id, value, epoch_us(ts) AS t, min(epoch_us(ts)) OVER u AS a, max(epoch_us(ts)) OVER u AS b, quantile_cont(value, 0.9) OVER u AS p90 FROM events WINDOW u AS (PARTITION BY user_id)),
y AS (SELECT *, CASE WHEN b > a THEN (t - a) / (b - a) ELSE 0.0 END AS pos FROM x)
SELECT user_id, round(avg(value) FILTER (pos <= 0.15), 6) AS hook, arg_max(event_id, (value, event_id)) AS climax, round(arg_max(pos, (value, event_id)), 6) AS climax_at, round(avg(CASE WHEN value >= p90 THEN 1 ELSE 0 END), 6) AS peaks FROM y GROUP BY 1"""


def trend(spark, d):
    """Slope over the order, its type, stability, and the counts of sharp and smooth changes."""
    df = ev(spark, d).withColumn("i", F.row_number().over(by_user()).cast("double")).withColumn("jump", F.abs(F.col("value") - F.lag("value").over(by_user())))
    slope, cv = F.regr_slope("value", "i"), F.stddev_pop("value") / F.avg("value")
    kind = F.when(slope > 0.5, "rising").when(slope < -0.5, "falling").otherwise("flat")
    return df.groupBy("user_id").agg(r(slope).alias("slope"), kind.alias("trend"), r(1 / (1 + cv)).alias("stability"), F.count_if(F.col("jump") > 150).alias("sharp"), F.count_if(F.col("jump").between(25, 75)).alias("smooth"))


TREND = f"""WITH x AS (SELECT user_id, value, CAST(row_number() {W} AS DOUBLE) AS i, abs(value - lag(value) {W}) AS jump FROM events)
SELECT user_id, round(regr_slope(value, i), 6) AS slope, CASE WHEN regr_slope(value, i) > 0.5 THEN 'rising' WHEN regr_slope(value, i) < -0.5 THEN 'falling' ELSE 'flat' END AS trend,
round(1 / (1 + stddev_pop(value) / avg(value)), 6) AS stability, count(*) FILTER (jump > 150) AS sharp, count(*) FILTER (jump BETWEEN 25 AND 75) AS smooth FROM x GROUP BY user_id"""


def segments(spark, d):
    """Runs of one event type that last an hour or more, numbered after short ones are dropped."""
    got = T.runs(ev(spark, d), "user_id", ["ts", "event_id"], "event_type").filter(F.unix_micros("end") - F.unix_micros("start") >= 3_600_000_000)
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("run")) - 1
    return got.select("user_id", F.format_string("s%04d", n).alias("segment"), "event_type", "n")


SEGMENTS = f"""WITH c AS (SELECT *, CASE WHEN event_type = lag(event_type) {W} THEN 0 ELSE 1 END AS c FROM events),
g AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c),
n AS (SELECT user_id, run, min(event_type) AS event_type, count(*) AS n FROM g GROUP BY 1, 2 HAVING max(epoch_us(ts)) - min(epoch_us(ts)) >= 3600000000)
SELECT user_id, printf('s%04d', row_number() OVER (PARTITION BY user_id ORDER BY run) - 1) AS segment, event_type, n FROM n"""


def quarters(spark, d):
    """Median value of each quarter of a user's rows."""
    n = F.count("*").over(whole())
    df = ev(spark, d).select("user_id", "value", F.floor((F.row_number().over(by_user()) - 1) * 4 / n).alias("quarter"))
    return Q.ranked(df, ["user_id", "quarter"], "value").groupBy("user_id", "quarter").agg(r(Q.at("value", 0.5)).alias("median"), F.count("*").alias("n"))


QUARTERS = f"""WITH q AS (SELECT user_id, value, (row_number() {W} - 1) * 4 // count(*) OVER (PARTITION BY user_id) AS quarter FROM events)
SELECT user_id, quarter, round(quantile_cont(value, 0.5), 6) AS median, count(*) AS n FROM q GROUP BY 1, 2"""


def pooled(spark, d):
    """Decay-weighted mean (exp(-0.01 i) by place), sample deviation and maximum of each component of a label's vectors."""
    i = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    df = spark.read.parquet(f"{d}/embeddings.parquet").withColumn("w", F.exp(i * -0.01))
    df = df.select("label", "w", F.posexplode("embedding").alias("dim", "x")).withColumn("x", F.col("x").cast("double"))
    pools = df.groupBy("label", "dim").agg((F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("mean"), r(F.stddev_samp("x")).alias("std"), F.max("x").alias("top"))
    length = lambda c: F.sqrt(F.sum(F.col(c) * F.col(c)).over(Window.partitionBy("label")))
    return pools.select("label", "dim", r("mean").alias("mean"), "std", r("top").alias("top"), *(r(F.col(c) / (length(c) + 1e-9)).alias(f"unit_{c}") for c in ("mean", "top")))


POOLED = """WITH i AS (SELECT label, embedding, exp((row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) * -0.01) AS w FROM embeddings),
x AS (SELECT label, w, CAST(unnest(range(len(embedding))) AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM i),
g AS (SELECT label, dim, sum(w * x) / sum(w) AS mean, round(stddev_samp(x), 6) AS std, max(x) AS top FROM x GROUP BY 1, 2), l AS (SELECT label, sqrt(sum(mean * mean)) + 1e-9 AS m, sqrt(sum(top * top)) + 1e-9 AS t FROM g GROUP BY 1)
SELECT label, dim, round(mean, 6) AS mean, std, round(top, 6) AS top, round(mean / m, 6) AS unit_mean, round(top / t, 6) AS unit_top FROM g JOIN l USING (label)"""


def sequence(spark, d):
    """Norms of a label's vectors and the greatest jump between neighbours in order."""
    w = Window.partitionBy("label").orderBy("vec_id")
    df = spark.read.parquet(f"{d}/embeddings.parquet").withColumn("before", F.lag("embedding").over(w))
    gap = V.norm(F.zip_with("embedding", "before", lambda a, b: a.cast("double") - b.cast("double")))
    return df.select("label", V.norm(F.col("embedding")).alias("norm"), gap.alias("gap")).groupBy("label").agg(r(F.avg("norm")).alias("norm_mean"), r(F.stddev_pop("norm")).alias("norm_std"), r(F.max("gap")).alias("max_jump"))


SEQUENCE = """WITH x AS (SELECT label, CAST(embedding AS DOUBLE[]) AS e, lag(CAST(embedding AS DOUBLE[])) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings)
SELECT label, round(avg(sqrt(list_dot_product(e, e))), 6) AS norm_mean, round(stddev_pop(sqrt(list_dot_product(e, e))), 6) AS norm_std, round(max(list_distance(e, b)), 6) AS max_jump FROM x GROUP BY 1"""


def characters(spark, d):
    """Share of characters that are neither letters, digits nor space, and the ratio of upper to lower case in the first line."""
    text, title = F.coalesce("text", F.lit("")), F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)
    lower = F.length(F.regexp_replace(title, r"[^\p{Ll}]+", ""))
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", r(F.length(F.regexp_replace(text, r"[\p{L}\p{N}\x20\x09-\x0D]+", "")) / F.greatest(F.length(text), F.lit(1))).alias("special"), r(F.length(F.regexp_replace(title, r"[^\p{Lu}]+", "")) / F.greatest(lower, F.lit(1))).alias("upper_lower"))


CHARACTERS = r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, split_part(coalesce(text, ''), chr(10), 1) AS title FROM documents)
SELECT doc_id, round(length(regexp_replace(t, '[\p{L}\p{N}\x20\x09-\x0D]', '', 'g')) / greatest(length(t), 1), 6) AS special,
round(length(regexp_replace(title, '[^\p{Lu}]', '', 'g')) / greatest(length(regexp_replace(title, '[^\p{Ll}]', '', 'g')), 1), 6) AS upper_lower FROM t"""


def similar_names(spark, d):
    """Similarity of a part's name to its type: 1 - edit distance / longer length."""
    a, b = F.lower("p_name"), F.lower("p_type")
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", r(1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))).alias("similarity"))


SIMILAR_NAMES = "SELECT p_partkey, round(1 - levenshtein(lower(p_name), lower(p_type)) / greatest(length(p_name), length(p_type), 1), 6) AS similarity FROM part"


def consistency(spark, d):
    """Orders whose lines disagree in status."""
    g = spark.read.parquet(f"{d}/lineitem.parquet").groupBy("l_orderkey").agg(F.min("l_linestatus").alias("a"), F.max("l_linestatus").alias("b"), F.count("*").alias("n"))
    return g.filter("a <> b").select("l_orderkey", "n")


CONSISTENCY = "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING min(l_linestatus) <> max(l_linestatus)"

_ALL = {
    "m13_moving": (moving, MOVING), "m12_m14_smooth": (smooth, SMOOTH), "m11_autocorrelation": (autocorrelation, AUTOCORRELATION), "m17_circular": (circular, CIRCULAR), "m22_stable_mean": (stable_mean, STABLE_MEAN),
    "a11_story": (story, STORY), "a19_a23_trend": (trend, TREND), "a6_segments": (segments, SEGMENTS), "a15_quarters": (quarters, QUARTERS), "v9_v10_pooled": (pooled, POOLED), "v25_sequence": (sequence, SEQUENCE),
    "t24_characters": (characters, CHARACTERS), "t36_similar_names": (similar_names, SIMILAR_NAMES), "j15_consistency": (consistency, CONSISTENCY),
}
QUERIES = {k: v[0] for k, v in _ALL.items()}
ORACLES = {k: v[1] for k, v in _ALL.items()}
