"""Queries of declared projections, cleaned columns, captions, zero-shot shares, shots with gaps, tokens, samples, lookups, keyframes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import stats
from ..functions import text as T
from ..functions import vectors as V
from ..operators import series
from ..operators import timeline as X
from .lexicon_queries import TITLED, titled
from .pacing_queries import HOUR, feelings
from .pair_queries import cosine_sql
from .text_queries import SQL_CLEAN, SQL_WORD
from .timeline_queries import S, W, ev, r
from .vector_queries import E, emb

# What each component's payload declares; a missing one is 0.
DECLARED = {"click": ("tempo", "level"), "view": ("level",), "purchase": ("tempo", "level", "pitch")}


def declared(spark, d):
    """Payloads of three components as flat columns component_name, 0 where a payload or a value is missing."""
    df = ev(spark, d)
    made = F.create_map(F.lit("tempo"), F.col("value"), F.lit("level"), F.when(F.col("event_id") % 4 != 0, F.col("value") / 2), F.lit("extra"), F.lit(1.0))
    df = df.select("user_id", "event_type", made.alias("payload"))
    return df.groupBy("user_id").agg(*(r(F.sum(F.coalesce(F.when(F.col("event_type") == c, F.element_at("payload", k)), F.lit(0.0)))).alias(f"{c}_{k}") for c, own in DECLARED.items() for k in own))


DECLARED_SQL = "SELECT user_id, " + ", ".join(f"round(sum(CASE WHEN event_type = '{c}' THEN coalesce({ {'tempo': 'value', 'level': 'CASE WHEN event_id % 4 <> 0 THEN value / 2 END', 'pitch': 'NULL::DOUBLE'}[k] }, 0) ELSE 0 END), 6) AS {c}_{k}" for c, own in DECLARED.items() for k in own) + " FROM events GROUP BY 1"

TAGS = r"#[\p{L}\p{N}_-]+"


def cleaned(spark, d):
    """Title and description without tags, which later steps read in place of the first ones: lengths and words of both."""
    df = titled(spark, d).withColumn("description", F.concat("description", F.lit(" #tag"), F.col("doc_id").cast("string")))
    df = df.withColumns({f"clean_{c}": T.clean(F.regexp_replace(c, TAGS, " ")) for c in ("title", "description")}).withColumn("hashtags", F.regexp_extract_all(F.concat("title", F.lit(" "), "description"), F.lit(TAGS), F.lit(0)))
    return df.select("doc_id", *(F.char_length(f"clean_{c}").cast("long").alias(f"{c}_chars") for c in ("title", "description")), F.size("hashtags").cast("long").alias("n_tags"), F.size(T.words(F.col("clean_description"))).cast("long").alias("n_words"), F.sha1("clean_title").alias("title_hash"))


_OFF = lambda c: SQL_CLEAN.format(f"regexp_replace({c}, '{TAGS}', ' ', 'g')")
CLEANED = rf"""WITH {TITLED}, t AS (SELECT doc_id, title, description || ' #tag' || doc_id AS description FROM titled), c AS (SELECT doc_id, {_OFF('title')} AS t, {_OFF('description')} AS x, len(regexp_extract_all(title || ' ' || description, '{TAGS}')) AS n FROM t)
SELECT doc_id, length(t) AS title_chars, length(x) AS description_chars, n AS n_tags, len(regexp_extract_all(x, '{SQL_WORD}')) AS n_words, sha1(t) AS title_hash FROM c"""


def caption_rollup(spark, d, least: float = 0.1, fps: float = 30.0):
    """Captions (confidence of ``least`` or more, time from the frame) of a user: elements, how long they stay, how often they
    change, the first one, calls to action that stay over three seconds, entropy of their kinds, and their speed."""
    df = ev(spark, d).select("user_id", F.col("event_id").alias("frame"), F.col("event_type").alias("text"), (F.col("value") / 500).alias("confidence"), (F.col("event_id") * 37 % 100).alias("x"))
    df = df.filter(F.col("confidence") >= least).withColumn("t", F.col("frame") / fps)
    w = Window.partitionBy("user_id").orderBy("frame")
    df = df.withColumn("turn", F.col("text") != F.lag("text").over(w)).withColumn("speed", F.abs(F.col("x") - F.lag("x").over(w)) / F.greatest(F.col("t") - F.lag("t").over(w), F.lit(1e-3)))
    g = df.groupBy("user_id").agg(F.count("*").alias("n"), r(F.count_if("turn") / F.greatest(F.lit(1), F.count("*") - 1)).alias("switch_rate"), r(F.min("t")).alias("first_s"), r(F.avg("speed")).alias("speed"))
    e = df.groupBy("user_id", "text").agg(F.count("*").alias("c"), (F.max("t") - F.min("t")).alias("stays"), F.min("t").alias("at")).withColumn("p", F.col("c") / F.sum("c").over(Window.partitionBy("user_id")))
    cta = F.col("text").isin("purchase", "signup")
    e = e.groupBy("user_id").agg(F.count("*").alias("elements"), r(F.avg("stays")).alias("mean_stay"), r(F.max("stays")).alias("longest"), r(F.sum(-F.col("p") * F.log(F.col("p") + 1e-12))).alias("entropy"), F.count_if(cta).alias("ctas"), r(F.min(F.when(cta, F.col("at")))).alias("first_cta"), F.count_if(cta & (F.col("stays") > 3)).alias("lasting_ctas"))
    return g.join(e, "user_id")


CAPTION_ROLLUP = """WITH c AS (SELECT user_id, event_id AS frame, event_type AS text, event_id * 37 % 100 AS x, event_id / 30 AS t FROM events WHERE value / 500 >= 0.1), w AS (SELECT *, text <> lag(text) OVER o AS turn, abs(x - lag(x) OVER o) / greatest(t - lag(t) OVER o, 1e-3) AS speed FROM c WINDOW o AS (PARTITION BY user_id ORDER BY frame)),
g AS (SELECT user_id, count(*) AS n, round(count(*) FILTER (turn) / greatest(1, count(*) - 1), 6) AS switch_rate, round(min(t), 6) AS first_s, round(avg(speed), 6) AS speed FROM w GROUP BY 1), e AS (SELECT user_id, text, count(*) / sum(count(*)) OVER (PARTITION BY user_id) AS p, max(t) - min(t) AS stays, min(t) AS at_s FROM c GROUP BY 1, 2),
f AS (SELECT user_id, count(*) AS elements, round(avg(stays), 6) AS mean_stay, round(max(stays), 6) AS longest, round(sum(-p * ln(p + 1e-12)), 6) + 0.0 AS entropy, count(*) FILTER (text IN ('purchase', 'signup')) AS ctas, round(min(at_s) FILTER (text IN ('purchase', 'signup')), 6) AS first_cta, count(*) FILTER (text IN ('purchase', 'signup') AND stays > 3) AS lasting_ctas FROM e GROUP BY 1) SELECT * FROM g JOIN f USING (user_id)"""


def zero_shot(spark, d, prompts: int = 4, temperature: float = 0.07):
    """Shares of four stated prompts (the first vectors) in each label's rows by softmax: their means, the dominant prompt, the
    entropy of the means, and how often the best prompt changes along the rows."""
    told = emb(spark, d).filter(F.col("vec_id") < prompts).agg(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))), lambda x: x["embedding"]).alias("told"))
    # One row with the stated prompts: cosines, softmax and the best prompt are found in the row.
    df = emb(spark, d).crossJoin(F.broadcast(told)).select("label", "vec_id", F.transform("told", lambda e: V.cosine(F.col("embedding"), e)).alias("s"))
    df = df.withColumn("z", F.transform("s", lambda x: F.exp((x - F.array_max("s")) / temperature)))
    df = df.select("label", "vec_id", F.array_position("s", F.array_max("s")).alias("prompt"), F.transform("z", lambda x: x / F.aggregate("z", F.lit(0.0), lambda a, y: a + y)).alias("p"))
    means = df.groupBy("label").agg(*(F.avg(F.get("p", F.lit(i))).alias(f"m{i}") for i in range(prompts)))
    best = df.select("label", "vec_id", "prompt")
    best = best.withColumn("turn", F.col("prompt") != F.lag("prompt").over(Window.partitionBy("label").orderBy("vec_id"))).groupBy("label").agg(r(F.count_if("turn") / F.greatest(F.lit(1), F.count("*") - 1)).alias("transition_rate"))
    m = [F.col(f"m{i}") for i in range(prompts)]
    top = F.array_position(F.array(*m), F.greatest(*m)) - 1
    return means.join(best, "label").select("label", *(r(x).alias(f"prompt{i}") for i, x in enumerate(m)), top.alias("dominant"), r(sum((-x * F.log(x + 1e-9) for x in m), F.lit(0.0))).alias("entropy"), "transition_rate")


ZERO_SHOT = f"""WITH e AS (SELECT vec_id, label, {E} AS v FROM embeddings), s AS (SELECT a.label, a.vec_id, b.vec_id AS prompt, {cosine_sql('a.v', 'b.v')} AS s FROM e a CROSS JOIN e b WHERE b.vec_id < 4), z AS (SELECT *, exp((s - max(s) OVER (PARTITION BY vec_id)) / 0.07) AS z FROM s), p AS (SELECT *, z / sum(z) OVER (PARTITION BY vec_id) AS p FROM z),
m AS (SELECT label, {', '.join(f'avg(p) FILTER (prompt = {i}) AS m{i}' for i in range(4))} FROM p GROUP BY 1), b AS (SELECT label, vec_id, arg_max(prompt, (s, -prompt)) AS prompt FROM s GROUP BY 1, 2), t AS (SELECT label, prompt <> lag(prompt) OVER (PARTITION BY label ORDER BY vec_id) AS turn FROM b), u AS (SELECT label, round(count(*) FILTER (turn) / greatest(1, count(*) - 1), 6) AS transition_rate FROM t GROUP BY 1)
SELECT label, {', '.join(f'round(m{i}, 6) AS prompt{i}' for i in range(4))}, list_position([m0, m1, m2, m3], greatest(m0, m1, m2, m3))::BIGINT - 1 AS dominant, round({' + '.join(f'(-m{i} * ln(m{i} + 1e-9))' for i in range(4))}, 6) AS entropy, transition_rate FROM m JOIN u USING (label)"""


def shot_quality(spark, d):
    """Figures of two measures per shot (a user's day), without the values that are not numbers."""
    nan = F.lit(float("nan"))
    df = ev(spark, d).select("user_id", F.floor(F.unix_micros("ts") / (24 * HOUR)).alias("shot"), F.when(F.col("event_id") % 6 == 0, nan).otherwise(F.col("value")).alias("sharp"), F.when(F.col("event_id") % 5 < 3, F.col("value") * F.col("value")).otherwise(nan).alias("noise"))
    return df.groupBy("user_id", "shot").agg(F.count("*").alias("frames"), *(r(f(stats.finite(F.col(c)))).alias(f"{c}_{k}") for c in ("sharp", "noise") for k, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))))


SHOT_QUALITY = f"""WITH e AS (SELECT user_id, epoch_us(ts) // {24 * HOUR} AS shot, CASE WHEN event_id % 6 <> 0 THEN value END AS sharp, CASE WHEN event_id % 5 < 3 THEN value * value END AS noise FROM events)
SELECT user_id, shot, count(*) AS frames, {', '.join(f'round({f}({c}), 6) AS {c}_{k}' for c in ('sharp', 'noise') for k, f in (('mean', 'avg'), ('std', 'stddev_pop'), ('min', 'min'), ('max', 'max')))} FROM e GROUP BY 1, 2"""


def token_totals(spark, d):
    """Tokens of each role of a conversation: total, mean and deviation of its turns, density a second (160 words a minute), share."""
    n = F.size(T.words(F.col("text")))
    df = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "role", n.alias("n"))
    g = df.groupBy("conv_id", "role").agg(F.sum("n").alias("tokens"), r(F.avg("n")).alias("mean"), r(F.stddev_pop("n")).alias("std"))
    total = F.sum("tokens").over(Window.partitionBy("conv_id"))
    return g.withColumn("share", r(F.when(total > 0, F.col("tokens") / total).otherwise(0.0))).withColumn("per_second", r(F.col("tokens") / (F.greatest(F.lit(0.5), total / 160) * 60)))


TOKEN_TOTALS = rf"""WITH n AS (SELECT conv_id, role, len(regexp_extract_all({SQL_CLEAN.format('text')}, '{SQL_WORD}')) AS n FROM conversations), g AS (SELECT conv_id, role, sum(n)::BIGINT AS tokens, round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS std FROM n GROUP BY 1, 2), t AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id) AS total FROM g)
SELECT conv_id, role, tokens, mean, std, round(CASE WHEN total > 0 THEN tokens / total ELSE 0 END, 6) AS share, round(tokens / (greatest(0.5, total / 160) * 60), 6) AS per_second FROM t"""


def segment_samples(spark, d, each: int = 3):
    """Up to three even rows of each session, the first and the last among them."""
    s = X.sessions(ev(spark, d), "user_id", ["ts", "event_id"], 43_200)
    w = Window.partitionBy("user_id", "session")
    df = s.withColumn("n", F.count("*").over(w)).withColumn("i", F.row_number().over(w.orderBy("ts", "event_id")) - 1)
    k = F.least("n", F.lit(each))
    at = F.transform(F.sequence(F.lit(0), F.lit(each - 1)), lambda j: F.rint(j * (F.col("n") - 1) / F.greatest(k - 1, F.lit(1))))
    return df.filter(F.array_contains(F.slice(at, F.lit(1), k.cast("int")), F.col("i").cast("double"))).select("event_id", "session", F.col("i").cast("long").alias("place"))


SEGMENT_SAMPLES = f"""WITH s AS (SELECT user_id, event_id, ts, (sum(l) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS session FROM (SELECT *, CASE WHEN ({S} - lag({S}) {W}) / 1e6 <= 43200 THEN 0 ELSE 1 END AS l FROM events)), p AS (SELECT *, count(*) OVER w AS n, row_number() OVER (PARTITION BY user_id, session ORDER BY ts, event_id) - 1 AS i FROM s WINDOW w AS (PARTITION BY user_id, session))
SELECT event_id, session, i AS place FROM p WHERE list_contains(list_transform(range(0, least(n, 3)), lambda j: round_even(j * (n - 1) / greatest(least(n, 3) - 1, 1), 0)), i::DOUBLE)"""


def lookups(spark, d):
    """Orders by region through three lookups, with those that have no customer."""
    read = lambda t: spark.read.parquet(f"{d}/{t}.parquet")
    c = read("customer").join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(read("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name")
    got = read("orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    return got.groupBy(F.coalesce("r_name", F.lit("unmapped")).alias("region")).agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


LOOKUPS = "SELECT coalesce(r_name, 'unmapped') AS region, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders LEFT JOIN (SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) ON o_custkey = c_custkey GROUP BY 1"


def remapped(spark, d):
    """Source indices of a user's components (clicks, every second view) as places in the union of both."""
    df = ev(spark, d)
    parts = df.filter("event_type = 'click'").select("user_id", F.lit("a").alias("component"), "event_id").union(df.filter("event_type = 'view' and event_id % 2 = 0").select("user_id", F.lit("b"), "event_id"))
    union = parts.select("user_id", "event_id").distinct()
    union = union.withColumn("place", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1)
    return parts.join(union, ["user_id", "event_id"]).select("user_id", "component", "event_id", F.col("place").cast("long").alias("place"))


REMAPPED = """WITH p AS (SELECT user_id, 'a' AS component, event_id FROM events WHERE event_type = 'click' UNION ALL SELECT user_id, 'b', event_id FROM events WHERE event_type = 'view' AND event_id % 2 = 0),
u AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS place FROM (SELECT DISTINCT user_id, event_id FROM p)) SELECT user_id, component, event_id, place FROM p JOIN u USING (user_id, event_id)"""


def value_counts(spark, d):
    """Counts of each market segment's nations, with their rank and share."""
    n = spark.read.parquet(f"{d}/customer.parquet").groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"))
    w = Window.partitionBy("c_mktsegment")
    return n.withColumn("place", F.row_number().over(w.orderBy(F.desc("n"), "c_nationkey"))).withColumn("share", r(F.col("n") / F.sum("n").over(w)))


VALUE_COUNTS = "SELECT c_mktsegment, c_nationkey, count(*) AS n, row_number() OVER (PARTITION BY c_mktsegment ORDER BY count(*) DESC, c_nationkey) AS place, round(count(*) / sum(count(*)) OVER (PARTITION BY c_mktsegment), 6) AS share FROM customer GROUP BY 1, 2"


def keyframes(spark, d):
    """Peaks of emotion and of its change: prominent, eight frames apart, the higher one where both fall on a frame."""
    return series.keyframes(feelings(spark, d), "user_id", ["ts", "event_id"]).withColumn("score", r("score"))


_ALL = {
    "p5_declared": (declared, DECLARED_SQL), "p8_cleaned": (cleaned, CLEANED), "a35_caption_rollup": (caption_rollup, CAPTION_ROLLUP), "v26_zero_shot": (zero_shot, ZERO_SHOT), "a10_shot_quality": (shot_quality, SHOT_QUALITY), "a31_token_totals": (token_totals, TOKEN_TOTALS),
    "e4_segment_samples": (segment_samples, SEGMENT_SAMPLES), "j14_lookups": (lookups, LOOKUPS), "j18_remapped": (remapped, REMAPPED), "k8_value_counts": (value_counts, VALUE_COUNTS), "w14_keyframes": (keyframes, None),
}
QUERIES = {k: v[0] for k, v in _ALL.items()}
#: Keyframes need a greedy choice and prominences, which a test holds against brute force in place of SQL.
ORACLES = {k: v[1] for k, v in _ALL.items() if v[1]}
