"""Rollups of components: motion, behaviour, camera, faces, sound, bands, topics; trimmed means, keys, horizons, sets, gates.

A user's events are a component's frames or segments; an hour stands for a second.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import stats
from ..operators import quantiles as Q
from .pacing_queries import HOUR, by_user
from .timeline_queries import W, ev, up_sql
from .timeline_queries import up as r
from .vector_queries import emb

WHOLE = "OVER (PARTITION BY user_id)"


def whole():
    return Window.partitionBy("user_id")


def motion(spark, d):
    """Motion of frames and shots (runs of a day): mean, median, variance, p90, shares above the third quartile, and the
    correlation of a shot's motion with its length."""
    df = Q.ranked(ev(spark, d).withColumn("shot", F.floor(F.unix_micros("ts") / (24 * HOUR))), ["user_id"], "value").withColumn("q", Q.at("value", 0.75, whole()))
    g = df.groupBy("user_id").agg(r(F.avg("value")).alias("mean"), r(Q.at("value", 0.5)).alias("median"), r(F.var_pop("value")).alias("variance"), r(Q.at("value", 0.9)).alias("p90"), r(F.avg((F.col("value") > F.col("q")).cast("double"))).alias("high_frames"))
    s = df.groupBy("user_id", "shot").agg(F.avg("value").alias("m"), ((F.max(F.unix_micros("ts")) - F.min(F.unix_micros("ts"))) / HOUR).alias("length"))
    s = Q.ranked(s, ["user_id"], "m").withColumn("q", Q.at("m", 0.75, whole()))
    s = s.groupBy("user_id").agg(F.count("*").alias("shots"), r(F.avg((F.col("m") > F.col("q")).cast("double"))).alias("high_shots"), F.covar_pop("m", "length").alias("c"), (F.stddev_pop("m") * F.stddev_pop("length")).alias("s"))
    return g.join(s, "user_id").select("user_id", "mean", "median", "variance", "p90", "high_frames", "shots", "high_shots", r(F.when(F.col("s") > 1e-12, F.col("c") / F.col("s")).otherwise(0.0)).alias("motion_length"))


MOTION = f"""WITH e AS (SELECT *, epoch_us(ts) // {24 * HOUR} AS shot, quantile_cont(value, 0.75) {WHOLE} AS q FROM events), g AS (SELECT user_id, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(var_pop(value), 6) AS variance, round(quantile_cont(value, 0.9), 6) AS p90, round(avg((value > q)::INT), 6) AS high_frames FROM e GROUP BY 1),
s AS (SELECT user_id, shot, avg(value) AS m, (max(epoch_us(ts)) - min(epoch_us(ts))) / {HOUR} AS length FROM e GROUP BY 1, 2), t AS (SELECT *, quantile_cont(m, 0.75) {WHOLE} AS q FROM s),
h AS (SELECT user_id, count(*) AS shots, round(avg((m > q)::INT), 6) AS high_shots, covar_pop(m, length) AS c, stddev_pop(m) * stddev_pop(length) AS s FROM t GROUP BY 1) SELECT g.*, shots, high_shots, round(CASE WHEN s > 1e-12 THEN c / s ELSE 0 END, 6) AS motion_length FROM g JOIN h USING (user_id)"""


def behaviour(spark, d):
    """Engagement (values) and stress: mean, greatest, variance, local peaks, means of the first and last fifth; kinds of
    gestures, their entropy and how often they change."""
    w = by_user()
    df = ev(spark, d).select("user_id", "ts", "event_id", "event_type", (F.col("value") / 500).alias("x"), ((F.col("event_id") * 11 % 17) / 16).alias("stress"))
    df = df.withColumn("k", F.row_number().over(w) - 1).withColumn("n", F.count("*").over(whole()))
    peak = (F.col("x") > F.lag("x").over(w)) & (F.col("x") > F.lead("x").over(w))
    df = df.withColumn("peak", F.coalesce(peak, F.lit(False))).withColumn("turned", F.coalesce(F.col("event_type") != F.lag("event_type").over(w), F.lit(False)))
    part = F.greatest(F.lit(1), F.floor(F.col("n") * 0.2))
    early, late = F.col("k") < part, F.col("k") >= F.col("n") - part
    g = df.groupBy("user_id").agg(*(r(f(c)).alias(f"{c}_{k}") for c in ("x", "stress") for k, f in (("mean", F.avg), ("max", F.max), ("var", F.var_pop))), F.count_if("peak").alias("peaks"), *(r(F.avg(F.when(t, F.col(c)))).alias(f"{c}_{k}") for c in ("x", "stress") for k, t in (("early", early), ("late", late))),
                                  F.countDistinct("event_type").alias("kinds"), r(F.count_if("turned") / F.greatest(F.lit(1), F.count("*") - 1)).alias("switch_rate"))
    p = df.groupBy("user_id", "event_type").agg(F.count("*").alias("c")).withColumn("p", F.col("c") / F.sum("c").over(whole()))
    return g.join(p.groupBy("user_id").agg(r(F.sum(-F.col("p") * F.log2(F.col("p") + 1e-8))).alias("entropy")), "user_id")


BEHAVIOUR = f"""WITH e AS (SELECT user_id, ts, event_id, event_type, value / 500 AS x, (event_id * 11 % 17) / 16 AS stress, row_number() {W} - 1 AS k, count(*) {WHOLE} AS n, lag(event_type) {W} AS was FROM events), l AS (SELECT *, coalesce(x > lag(x) {W} AND x > lead(x) {W}, false) AS peak, greatest(1, floor(n * 0.2)) AS part FROM e),
g AS (SELECT user_id, {', '.join(f'round({f}({c}), 6) AS {c}_{k}' for c in ('x', 'stress') for k, f in (('mean', 'avg'), ('max', 'max'), ('var', 'var_pop')))}, count(*) FILTER (peak) AS peaks, {', '.join(f'round(avg({c}) FILTER ({t}), 6) AS {c}_{k}' for c in ('x', 'stress') for k, t in (('early', 'k < part'), ('late', 'k >= n - part')))}, count(DISTINCT event_type) AS kinds, round(count(*) FILTER (event_type <> was) / greatest(1, count(*) - 1), 6) AS switch_rate FROM l GROUP BY 1),
p AS (SELECT user_id, event_type, count(*) / sum(count(*)) {WHOLE} AS p FROM events GROUP BY 1, 2) SELECT g.*, (SELECT round(sum(-p * log2(p + 1e-8)), 6) + 0.0 FROM p WHERE p.user_id = g.user_id) AS entropy FROM g"""


def camera(spark, d):
    """Camera motion: figures of the values that are there, zooms in and out, shares of the moves, and the even spread of
    directions over 36 parts."""
    w = by_user()
    x = F.when(F.col("event_id") % 9 != 0, F.col("value"))
    df = ev(spark, d).select("user_id", "event_type", x.alias("x"), F.col("event_id").alias("i"), (F.col("value") - F.lag("value").over(w)).alias("zoom"))
    direction = F.floor(F.col("i") * 73 % 360 / 10).cast("int")
    g = df.groupBy("user_id").agg(*(r(f("x")).alias(k) for k, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))), F.count("x").alias("valid"), F.count_if(F.col("zoom") > 50).alias("zoom_in"), F.count_if(F.col("zoom") < -50).alias("zoom_out"),
                                  *(r(F.avg((F.col("event_type") == k).cast("double"))).alias(f"{k}_share") for k in ("click", "view", "signup")), stats.bin_counts(direction, 36).alias("c"))
    return g.withColumn("chaos", r(stats.counts_entropy(F.col("c"), 1e-9) / F.log(F.lit(36.0)))).drop("c")


CAMERA = f"""WITH e AS (SELECT user_id, event_type, CASE WHEN event_id % 9 <> 0 THEN value END AS x, value - lag(value) {W} AS zoom, floor(event_id * 73 % 360 / 10)::INT AS b FROM events),
g AS (SELECT user_id, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max, count(x) AS valid, count(*) FILTER (zoom > 50) AS zoom_in, count(*) FILTER (zoom < -50) AS zoom_out, {', '.join(f"round(avg((event_type = '{k}')::INT), 6) AS {k}_share" for k in ('click', 'view', 'signup'))}, list(b) AS b FROM e GROUP BY 1),
c AS (SELECT *, list_transform(range(0, 36), lambda i: len(list_filter(b, lambda y: y = i)) + 1e-9) AS c FROM g) SELECT * EXCLUDE (b, c), round(list_sum(list_transform(c, lambda z: -z / list_sum(c) * ln(z / list_sum(c)))) / ln(36), 6) AS chaos FROM c"""


def faces(spark, d):
    """Faces (user and part of the ids): figures of three metrics, head turns over 7 degrees a minute, still share."""
    df = ev(spark, d).select("user_id", (F.col("event_id") % 3).alias("face"), "ts", "event_id", (F.col("event_id") * 29 % 90 - 45.0).alias("yaw"), (F.col("value") / 500).alias("open"), F.sqrt("value").alias("size"))
    w = Window.partitionBy("user_id", "face").orderBy("ts", "event_id")
    df = df.withColumn("turn", F.abs(F.col("yaw") - F.lag("yaw").over(w)))
    minutes = F.greatest((F.max(F.unix_micros("ts")) - F.min(F.unix_micros("ts"))) / HOUR / 60, F.lit(1e-6))
    return df.groupBy("user_id", "face").agg(F.count("*").alias("n"), *(r(f(c)).alias(f"{c}_{k}") for c in ("yaw", "open", "size") for k, f in (("mean", F.avg), ("std", F.stddev_pop), ("max", F.max))), r(F.count_if(F.col("turn") > 7) / minutes).alias("turns_per_minute"), r(F.avg((F.col("turn") <= 7).cast("double"))).alias("still_share"))


FACES = f"""WITH e AS (SELECT user_id, event_id % 3 AS face, ts, event_id, event_id * 29 % 90 - 45.0::DOUBLE AS yaw, value / 500 AS open, sqrt(value) AS size FROM events), t AS (SELECT *, abs(yaw - lag(yaw) OVER (PARTITION BY user_id, face ORDER BY ts, event_id)) AS turn FROM e)
SELECT user_id, face, count(*) AS n, {', '.join(f'round({f}({c}), 6) AS {c}_{k}' for c in ('yaw', 'open', 'size') for k, f in (('mean', 'avg'), ('std', 'stddev_pop'), ('max', 'max')))}, round(count(*) FILTER (turn > 7) / greatest((max(epoch_us(ts)) - min(epoch_us(ts))) / {HOUR} / 60, 1e-6), 6) AS turns_per_minute, round(avg((turn <= 7)::INT), 6) AS still_share FROM t GROUP BY 1, 2"""


def loudness(spark, d):
    """Level of segments (days) in decibel from their root mean square: mean, deviation, quantiles; crest, range, clipping,
    offset; tempo of windows with its confidence and the warnings of all of them."""
    x = (F.col("value") - 250) / 250
    df = ev(spark, d).select("user_id", F.floor(F.unix_micros("ts") / (24 * HOUR)).alias("seg"), x.alias("x"))
    seg = df.groupBy("user_id", "seg").agg(F.sqrt(F.avg(F.col("x") * F.col("x"))).alias("rms"), F.count("*").alias("n"))
    seg = seg.withColumn("db", 20 * F.log10(F.greatest("rms", F.lit(1e-9)))).withColumn("tempo", F.col("n") * 20.0)
    warned = F.when(F.col("tempo") < 40, "slow").when(F.col("tempo") > 220, "fast")
    s = Q.ranked(seg, ["user_id"], "db").groupBy("user_id").agg(F.count("*").alias("segments"), r(F.avg("db")).alias("mean"), r(F.stddev_pop("db")).alias("std"), *(r(Q.at("db", q / 100)).alias(f"p{q}") for q in (10, 50, 90)), r(F.avg("tempo")).alias("tempo"), r(1 / (1 + F.stddev_pop("tempo") / F.avg("tempo"))).alias("tempo_confidence"), F.array_join(F.array_sort(F.collect_set(warned)), ",").alias("warnings"))
    peak, rms = F.max(F.abs("x")), F.sqrt(F.avg(F.col("x") * F.col("x")))
    a = Q.ranked(df, ["user_id"], "x").groupBy("user_id").agg(r(F.avg("x")).alias("offset"), r(F.avg((F.abs("x") >= 0.99).cast("double"))).alias("clipped"), r(peak / F.greatest(rms, F.lit(1e-9))).alias("crest"), r(Q.at("x", 0.95) - Q.at("x", 0.05)).alias("range"))
    return s.join(a, "user_id")


LOUDNESS = f"""WITH e AS (SELECT user_id, epoch_us(ts) // {24 * HOUR} AS seg, (value - 250) / 250 AS x FROM events), s AS (SELECT user_id, seg, 20 * log10(greatest(sqrt(avg(x * x)), 1e-9)) AS db, count(*) * 20.0::DOUBLE AS tempo FROM e GROUP BY 1, 2),
g AS (SELECT user_id, count(*) AS segments, round(avg(db), 6) AS mean, round(stddev_pop(db), 6) AS std, {', '.join(f'round(quantile_cont(db, {q / 100}), 6) AS p{q}' for q in (10, 50, 90))}, round(avg(tempo), 6) AS tempo, round(1 / (1 + stddev_pop(tempo) / avg(tempo)), 6) AS tempo_confidence, coalesce(string_agg(DISTINCT CASE WHEN tempo < 40 THEN 'slow' WHEN tempo > 220 THEN 'fast' END, ',' ORDER BY CASE WHEN tempo < 40 THEN 'slow' WHEN tempo > 220 THEN 'fast' END), '') AS warnings FROM s GROUP BY 1),
a AS (SELECT user_id, round(avg(x), 6) AS "offset", round(avg((abs(x) >= 0.99)::INT), 6) AS clipped, round(max(abs(x)) / greatest(sqrt(avg(x * x)), 1e-9), 6) AS crest, round(quantile_cont(x, 0.95) - quantile_cont(x, 0.05), 6) AS range FROM e GROUP BY 1) SELECT * FROM g JOIN a USING (user_id)"""


def diarized(spark, d):
    """Rows of class weights made shares: the dominant class of rows and of all, mean shares, entropy and its mean."""
    v = [F.col("value"), F.col("event_id") % 100 + 1.0, F.col("event_id") * 7 % 50 + 1.0]
    total = sum(v, F.lit(0.0))
    df = ev(spark, d).select("user_id", *((c / total).alias(f"p{i}") for i, c in enumerate(v)))
    top = F.when((F.col("p0") >= F.col("p1")) & (F.col("p0") >= F.col("p2")), 0).when(F.col("p1") >= F.col("p2"), 1).otherwise(2)
    entropy = sum((-F.col(f"p{i}") * F.log(F.col(f"p{i}") + 1e-12) for i in range(3)), F.lit(0.0))
    g = df.groupBy("user_id").agg(*(F.avg(f"p{i}").alias(f"m{i}") for i in range(3)), *(F.count_if(top == i).alias(f"n{i}") for i in range(3)), F.avg(entropy).alias("e"), F.stddev_pop("p0").alias("s"))
    best = F.when((F.col("m0") >= F.col("m1")) & (F.col("m0") >= F.col("m2")), 0).when(F.col("m1") >= F.col("m2"), 1).otherwise(2)
    return g.select("user_id", *(r(f"m{i}").alias(f"share{i}") for i in range(3)), "n0", "n1", "n2", best.cast("long").alias("dominant"), r("e").alias("mean_entropy"), r("s").alias("share0_std"))


DIARIZED = """WITH e AS (SELECT user_id, value AS a, event_id % 100 + 1.0::DOUBLE AS b, event_id * 7 % 50 + 1.0::DOUBLE AS c FROM events), p AS (SELECT user_id, a / (a + b + c) AS p0, b / (a + b + c) AS p1, c / (a + b + c) AS p2 FROM e),
t AS (SELECT *, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS top, -p0 * ln(p0 + 1e-12) - p1 * ln(p1 + 1e-12) - p2 * ln(p2 + 1e-12) AS e FROM p)
SELECT user_id, round(avg(p0), 6) AS share0, round(avg(p1), 6) AS share1, round(avg(p2), 6) AS share2, count(*) FILTER (top = 0) AS n0, count(*) FILTER (top = 1) AS n1, count(*) FILTER (top = 2) AS n2, CASE WHEN avg(p0) >= avg(p1) AND avg(p0) >= avg(p2) THEN 0 WHEN avg(p1) >= avg(p2) THEN 1 ELSE 2 END::BIGINT AS dominant, round(avg(e), 6) AS mean_entropy, round(stddev_pop(p0), 6) AS share0_std FROM t GROUP BY 1"""


def bands(spark, d):
    """Figures of each band (dimension) of a label's rows: mean, deviation, least, greatest, median, lower and upper quartile."""
    df = emb(spark, d).select("label", F.posexplode("embedding").alias("band", "x")).withColumn("x", F.col("x").cast("double"))
    g = Q.ranked(df, ["label", "band"], "x").groupBy("label", "band").agg(r(F.avg("x")).alias("mean"), r(F.stddev_pop("x")).alias("std"), r(F.min("x")).alias("min"), r(F.max("x")).alias("max"), *(r(Q.at("x", q / 100)).alias(f"p{q}") for q in (25, 50, 75)))
    return g.withColumn("band", F.col("band").cast("long"))


BANDS = "WITH f AS (SELECT label, unnest(range(len(embedding))) AS band, unnest(embedding)::DOUBLE AS x FROM embeddings) SELECT label, band, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max, round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.75), 6) AS p75 FROM f GROUP BY 1, 2"


def mean_vectors(spark, d):
    """The mean vector of each label as figures: length, mean and deviation of the sizes of its parts, parts that are not zero."""
    m = emb(spark, d).select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return m.groupBy("label").agg(r(F.sqrt(F.sum(F.col("m") * F.col("m")))).alias("norm"), r(F.avg(F.abs("m"))).alias("abs_mean"), r(F.stddev_pop(F.abs("m"))).alias("abs_std"), F.count_if(F.abs("m") > 1e-6).alias("non_zero"))


MEAN_VECTORS = "WITH m AS (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY 1, 2) SELECT label, round(sqrt(sum(m * m)), 6) AS norm, round(avg(abs(m)), 6) AS abs_mean, round(stddev_pop(abs(m)), 6) AS abs_std, count(*) FILTER (abs(m) > 1e-6) AS non_zero FROM m GROUP BY 1"


def expressions(spark, d):
    """Events of each kind: number, rate a minute and greatest value; and the mean of a user's calmest fifth of rows as its level."""
    minutes = F.greatest((F.max(F.unix_micros("ts")) - F.min(F.unix_micros("ts"))) / HOUR / 60, F.lit(1e-6))
    df = ev(spark, d)
    length = df.groupBy("user_id").agg(minutes.alias("minutes"))
    kinds = df.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), r(F.max("value")).alias("greatest"))
    calm = Q.ranked(df, ["user_id"], "value").withColumn("q", Q.at("value", 0.2, whole())).groupBy("user_id").agg(r(F.avg(F.when(F.col("value") <= F.col("q"), F.col("value")))).alias("level"))
    return kinds.join(length, "user_id").join(calm, "user_id").select("user_id", "event_type", "n", "greatest", r(F.col("n") / F.col("minutes")).alias("per_minute"), "level")


EXPRESSIONS = f"""WITH l AS (SELECT user_id, greatest((max(epoch_us(ts)) - min(epoch_us(ts))) / {HOUR} / 60, 1e-6) AS minutes FROM events GROUP BY 1), k AS (SELECT user_id, event_type, count(*) AS n, round(max(value), 6) AS greatest FROM events GROUP BY 1, 2), c AS (SELECT user_id, round(avg(value) FILTER (value <= q), 6) AS level FROM (SELECT *, quantile_cont(value, 0.2) {WHOLE} AS q FROM events) GROUP BY 1)
SELECT user_id, event_type, n, greatest, round(n / minutes, 6) AS per_minute, level FROM k JOIN l USING (user_id) JOIN c USING (user_id)"""


def topics(spark, d, k: int = 10):
    """Topic shares of each source: the ten greatest of the terms' mean shares over documents, made to sum to 1, their entropy,
    and the term that leads most documents."""
    from ..functions import text as T

    # A document's rows meet in one task as texts, which are shorter than the counts of their terms; all figures come of one pass.
    docs = spark.read.parquet(f"{d}/documents.parquet").filter("source is not null").select("source", "doc_id", "text").repartition("source", "doc_id")
    n = docs.select("source", "doc_id", F.explode(F.transform(T.words(F.col("text")), lambda x: F.substring(F.lower(x), 1, 2))).alias("topic")).groupBy("source", "doc_id", "topic").agg(F.count("*").alias("n"))
    own = Window.partitionBy("source", "doc_id").orderBy(F.desc("n"), "topic")
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    p = n.select("source", "topic", (F.col("n") / F.sum("n").over(whole)).alias("p"), (F.row_number().over(own) == 1).cast("long").alias("first"), F.col("doc_id").isNotNull().cast("long").alias("known"))
    of_source = Window.partitionBy("source")
    m = p.groupBy("source", "topic").agg(F.sum("p").alias("s"), F.sum("first").alias("leads"), F.sum(F.col("first") * F.col("known")).alias("docs"))
    # Each document has one leading term, so these count the documents (of those with an id).
    m = m.withColumn("m", F.col("s") / F.sum("docs").over(of_source))
    m = m.withColumn("k", F.row_number().over(of_source.orderBy(F.desc(F.round("m", 9)), "topic"))).withColumn("lead", F.row_number().over(of_source.orderBy(F.desc("leads"), "topic")))
    top = F.col("k") <= k
    m = m.withColumn("p", F.when(top, F.col("m") / F.sum(F.when(top, F.col("m"))).over(of_source)))
    return m.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(top, F.struct("k", "topic")))), lambda s: s["topic"]), " ").alias("topics"), r(F.max("p")).alias("greatest"), r(F.sum(-F.col("p") * F.log(F.col("p") + 1e-12))).alias("entropy"), F.max(F.when(F.col("lead") == 1, F.col("topic"))).alias("dominant"), F.max(F.when(F.col("lead") == 1, F.col("leads"))).alias("leads"))


def _topics_sql() -> str:
    from .text_queries import SQL_CLEAN, SQL_WORD

    return rf"""WITH t AS (SELECT source, doc_id, unnest(list_transform(regexp_extract_all({SQL_CLEAN.format('text')}, '{SQL_WORD}'), lambda x: substring(lower(x), 1, 2))) AS topic FROM documents), n AS (SELECT source, doc_id, topic, count(*) AS n FROM t GROUP BY 1, 2, 3), p AS (SELECT *, n / sum(n) OVER (PARTITION BY source, doc_id) AS p FROM n),
c AS (SELECT source, count(DISTINCT doc_id) AS docs FROM n GROUP BY 1), m AS (SELECT source, topic, sum(p) / any_value(docs) AS m FROM p JOIN c USING (source) GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY round(m, 9) DESC, topic) AS k FROM m), q AS (SELECT *, m / sum(m) OVER (PARTITION BY source) AS p FROM k WHERE k <= 10),
s AS (SELECT source, string_agg(topic, ' ' ORDER BY k) AS topics, round(max(p), 6) AS greatest, round(sum(-p * ln(p + 1e-12)), 6) AS entropy FROM q GROUP BY 1), l AS (SELECT *, row_number() OVER (PARTITION BY source, doc_id ORDER BY n DESC, topic) AS k FROM n),
d AS (SELECT source, topic AS dominant, count(*) AS leads FROM l WHERE k = 1 GROUP BY 1, 2), e AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY leads DESC, dominant) AS k FROM d) SELECT s.*, dominant, leads FROM s JOIN e USING (source) WHERE k = 1"""


def trimmed(spark, d, share: float = 0.1):
    """Mean of a user's values without the tenth at each end; of all where nothing would be left."""
    df = Q.ranked(ev(spark, d), ["user_id"], "value")
    cut = F.floor(F.col("_n") * share)
    inside = (F.col("_k") >= cut) & (F.col("_k") < F.col("_n") - cut)
    return df.groupBy("user_id").agg(r(F.coalesce(F.avg(F.when(inside, F.col("value"))), F.avg("value"))).alias("trimmed_mean"), F.max(cut).alias("cut"))


TRIMMED = f"WITH k AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value) - 1 AS k, count(*) {WHOLE} AS n FROM events) SELECT user_id, round(coalesce(avg(value) FILTER (k >= floor(n * 0.1) AND k < n - floor(n * 0.1)), avg(value)), 6) AS trimmed_mean, max(floor(n * 0.1))::BIGINT AS cut FROM k GROUP BY 1"

# Weights of the twelve tones in a major and in a minor key.
MAJOR = (6.35, 2.23, 3.48, 2.33, 4.38, 4.09, 2.52, 5.19, 2.39, 3.66, 2.29, 2.88)
MINOR = (6.33, 2.68, 3.52, 5.38, 2.60, 3.53, 2.54, 4.75, 3.98, 2.69, 3.34, 3.17)


def keys_of(spark, d):
    """Likeness of a user's twelve tone sums to the 24 keys, between 0 and 1, and the best one (of equal ones the first)."""
    tones = ev(spark, d).groupBy("user_id").agg(F.array(*(F.sum(F.when(F.col("event_id") % 12 == i, F.col("value")).otherwise(0.0)) for i in range(12))).alias("v"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    centred = lambda a: F.transform(a, lambda x: x - total(a) / 12)
    df = tones.withColumn("c", centred(F.col("v"))).withColumn("n", F.sqrt(total(F.transform("c", lambda x: x * x))))
    scores = []
    for shift in range(12):
        for profile in (MAJOR, MINOR):
            row = [profile[(i - shift) % 12] - sum(profile) / 12 for i in range(12)]
            size = sum(x * x for x in row) ** 0.5
            scores.append(total(F.zip_with("c", F.array(*map(F.lit, row)), lambda a, b: a * b)) / (F.col("n") * size + 1e-12))
    df = df.withColumn("s", F.array(*scores)).withColumn("lo", F.array_min("s")).withColumn("hi", F.array_max("s"))
    unit = F.transform("s", lambda x: (x - F.col("lo")) / (F.col("hi") - F.col("lo") + 1e-12))
    return df.select("user_id", (F.array_position("s", F.col("hi")) - 1).alias("key"), r(F.col("hi")).alias("likeness"), r(total(unit) / 24).alias("mean_score"))


def _keys_sql() -> str:
    rows = [[p[(i - shift) % 12] - sum(p) / 12 for i in range(12)] for shift in range(12) for p in (MAJOR, MINOR)]
    made = ", ".join(f"({k}, [{', '.join(f'{x!r}::DOUBLE' for x in row)}], {sum(x * x for x in row) ** 0.5!r}::DOUBLE)" for k, row in enumerate(rows))
    return f"""WITH v AS (SELECT user_id, [{', '.join(f'coalesce(sum(value) FILTER (event_id % 12 = {i}), 0)' for i in range(12))}] AS v FROM events GROUP BY 1), c AS (SELECT user_id, list_transform(v, lambda x: x - list_sum(v) / 12) AS c FROM v),
s AS (SELECT user_id, key, list_dot_product(c, row) / (sqrt(list_dot_product(c, c)) * size + 1e-12) AS s FROM c CROSS JOIN (VALUES {made}) k(key, row, size)), m AS (SELECT *, min(s) OVER w AS lo, max(s) OVER w AS hi, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, key) AS k FROM s WINDOW w AS (PARTITION BY user_id))
SELECT user_id, max(key) FILTER (k = 1)::BIGINT AS key, round(max(hi), 6) AS likeness, round(avg((s - lo) / (hi - lo + 1e-12)), 6) AS mean_score FROM m GROUP BY 1"""


def horizons(spark, d):
    """Of each purchase: logarithms of what its user's events add within one and three days after it, and its age in hours at
    the end of the table."""
    us = F.unix_micros("ts")
    after = lambda days: F.coalesce(F.sum("value").over(Window.partitionBy("user_id").orderBy("us").rangeBetween(1, days * 86_400_000_000)), F.lit(0.0))
    df = ev(spark, d).withColumn("us", us)
    end = df.agg(F.max("us").alias("end"))
    got = df.withColumn("d1", after(1)).withColumn("d3", after(3)).filter("event_type = 'purchase'")
    return got.crossJoin(end).select("event_id", r(F.log1p("d1")).alias("within_1d"), r(F.log1p("d3")).alias("within_3d"), r((F.col("end") - F.col("us")) / HOUR).alias("age_hours"))


HORIZONS = f"""WITH a AS (SELECT *, epoch_us(ts) AS us, {', '.join(f'coalesce(sum(value) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 1 FOLLOWING AND {n * 86_400_000_000} FOLLOWING), 0) AS d{n}' for n in (1, 3))} FROM events)
SELECT event_id, round(ln(1 + d1), 6) AS within_1d, round(ln(1 + d3), 6) AS within_3d, round(((SELECT max(epoch_us(ts)) FROM events) - us) / {HOUR}, 6) AS age_hours FROM a WHERE event_type = 'purchase'"""


def index_sets(spark, d):
    """Index sets of a user's components (clicks, views, the latter's even ids): union, intersection, whether one holds the
    other, and the hours of day in the order they first come."""
    df = ev(spark, d)
    views = df.filter("event_type = 'view'").select("user_id", "event_id")
    clicks = df.filter("event_type = 'click'").select("user_id", "event_id")
    even = df.filter("event_id % 2 = 0 and event_type <> 'error'").select("user_id", "event_id")
    both = clicks.union(views)
    n = lambda x, name: x.groupBy("user_id").agg(F.count("*").alias(name))
    got = n(both.union(even).distinct(), "in_any").join(n(both.intersect(even), "in_both"), "user_id", "left").join(n(views.subtract(even), "outside"), "user_id", "left")
    hours = df.select("user_id", "ts", "event_id", F.floor(F.unix_micros("ts") / HOUR % 24).alias("h")).groupBy("user_id", "h").agg(F.min(F.struct("ts", "event_id")).alias("first"))
    hours = hours.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "h"))), lambda s: s["h"].cast("string")), " ").alias("hours"))
    return got.join(hours, "user_id").select("user_id", "in_any", F.coalesce("in_both", F.lit(0)).alias("in_both"), F.col("outside").isNull().alias("views_are_even"), "hours")


INDEX_SETS = f"""WITH b AS (SELECT user_id, event_id FROM events WHERE event_type IN ('click', 'view')), e AS (SELECT user_id, event_id FROM events WHERE event_id % 2 = 0 AND event_type <> 'error'), a AS (SELECT user_id, count(*) AS in_any FROM (SELECT * FROM b UNION SELECT * FROM e) GROUP BY 1), i AS (SELECT user_id, count(*) AS in_both FROM (SELECT * FROM b INTERSECT SELECT * FROM e) GROUP BY 1),
o AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'view' AND event_id % 2 <> 0), h AS (SELECT user_id, epoch_us(ts) // {HOUR} % 24 AS h, min(epoch_us(ts)) AS us FROM events GROUP BY 1, 2), g AS (SELECT user_id, string_agg(h::VARCHAR, ' ' ORDER BY us) AS hours FROM h GROUP BY 1)
SELECT user_id, in_any, coalesce(in_both, 0) AS in_both, user_id NOT IN (SELECT user_id FROM o) AS views_are_even, hours FROM a LEFT JOIN i USING (user_id) JOIN g USING (user_id)"""


def gated(spark, d, limit: float = 120.0):
    """Rows whose cheap figure is over a limit or in its user's top quarter go on to the costly one; how many, and what it finds."""
    w = by_user()
    df = ev(spark, d).withColumn("cheap", F.abs(F.col("value") - F.lag("value").over(w))).filter("cheap is not null")
    df = Q.ranked(df, ["user_id"], "cheap").withColumn("q", Q.at("cheap", 0.75, whole()))
    on = df.filter((F.col("cheap") >= limit) | (F.col("cheap") > F.col("q")))
    costly = F.conv(F.substring(F.md5(F.concat_ws(":", "event_type", F.col("event_id").cast("string"))), 1, 2), 16, 10).cast("int") % 4
    return on.withColumn("costly", costly).groupBy("user_id").agg(F.max("_n").alias("rows"), F.count("*").alias("gated"), F.count_if(F.col("costly") == 0).alias("found"), r(F.min("cheap")).alias("least"))


GATED = f"""WITH l AS (SELECT *, abs(value - lag(value) {W}) AS cheap FROM events), f AS (SELECT *, count(*) {WHOLE} AS n, quantile_cont(cheap, 0.75) {WHOLE} AS q FROM l WHERE cheap IS NOT NULL)
SELECT user_id, max(n) AS rows, count(*) AS gated, count(*) FILTER (md5(event_type || ':' || event_id)[2] IN ('0', '4', '8', 'c')) AS found, round(min(cheap), 6) AS least FROM f WHERE cheap >= 120 OR cheap > q GROUP BY 1"""


def leaf_figures(spark, d):
    """Mean, deviation, least, greatest, median and range of each number of a line, by return flag; its commonest status and that
    one's share."""
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    long = li.select("l_returnflag", F.inline(F.array(*(F.struct(F.lit(c).alias("leaf"), F.col(f"l_{c}").alias("x")) for c in ("quantity", "extendedprice", "discount", "tax")))))
    g = long.groupBy("l_returnflag", "leaf").agg(F.count("x").alias("n"), r(F.avg("x")).alias("mean"), r(F.stddev_pop("x")).alias("std"), r(F.min("x")).alias("min"), r(F.max("x")).alias("max"), r(F.max("x") - F.min("x")).alias("range"))
    g = g.join(Q.grouped(long, ["l_returnflag", "leaf"], "x", {"median": 0.5}), ["l_returnflag", "leaf"]).withColumn("median", r("median"))
    styles = li.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("c")).groupBy("l_returnflag").agg(F.min(F.struct((-F.col("c")).alias("less"), "l_linestatus")).alias("m"), F.sum("c").alias("all"))
    return g.join(styles.select("l_returnflag", F.col("m.l_linestatus").alias("style"), r(-F.col("m.less") / F.col("all")).alias("consistency")), "l_returnflag")


LEAF_FIGURES = f"""WITH l AS ({' UNION ALL '.join(f"SELECT l_returnflag, '{c}' AS leaf, l_{c} AS x FROM lineitem" for c in ('quantity', 'extendedprice', 'discount', 'tax'))}), s AS (SELECT l_returnflag, l_linestatus, count(*) AS c FROM lineitem GROUP BY 1, 2), t AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY c DESC, l_linestatus) AS k, sum(c) OVER (PARTITION BY l_returnflag) AS whole FROM s)
SELECT l.l_returnflag, leaf, count(x) AS n, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max, round(max(x) - min(x), 6) AS range, round(median(x), 6) AS median, any_value(l_linestatus) AS style, round(any_value(c / whole), 6) AS consistency FROM l JOIN t ON t.l_returnflag = l.l_returnflag AND t.k = 1 GROUP BY 1, 2"""

_ALL = {
    "a12_motion": (motion, MOTION), "a16_behaviour": (behaviour, BEHAVIOUR), "a22_camera": (camera, CAMERA), "a24_faces": (faces, FACES), "a25_loudness": (loudness, LOUDNESS), "a29_diarized": (diarized, DIARIZED), "a33_bands": (bands, BANDS), "a34_mean_vectors": (mean_vectors, MEAN_VECTORS),
    "a38_expressions": (expressions, EXPRESSIONS), "a39_topics": (topics, _topics_sql()), "m7_trimmed": (trimmed, TRIMMED), "m20_keys": (keys_of, _keys_sql()), "m23_horizons": (horizons, HORIZONS), "o4_index_sets": (index_sets, INDEX_SETS), "e6_gated": (gated, GATED), "a9_leaf_figures": (leaf_figures, LEAF_FIGURES),
}
QUERIES = {k: v[0] for k, v in _ALL.items()}
ORACLES = {k: up_sql(v[1]) for k, v in _ALL.items()}
