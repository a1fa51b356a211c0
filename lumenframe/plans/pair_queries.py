"""Queries of pairs: cosines between vectors, projections, pools, self-similarity, boxes, alignment and interval joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import folds
from ..operators import quantiles as Q
from ..operators import similarity as S
from ..operators import timeline as T
from .pacing_queries import HOUR, by_user
from .timeline_queries import W, ev, r
from .vector_queries import CENTROID_CTE, DOT, E, emb


def cosine_sql(a: str, b: str) -> str:
    return f"{DOT.format(a=a, b=b)} / ((sqrt({DOT.format(a=a, b=a)}) + 1e-9) * (sqrt({DOT.format(a=b, b=b)}) + 1e-9))"


def pair_cosines(spark, d):
    """Cosines of a title, a description and the first transcript there is, and of the transcript with its comments.

    Every tenth vector is a title, the next one its description, one of the next three its transcript; the rest of the ten
    are comments.
    """
    df = emb(spark, d).select((F.floor(F.col("vec_id") / 10)).alias("doc_id"), (F.col("vec_id") % 10).alias("k"), "embedding")
    pick = lambda k: F.max(F.when(F.col("k") == k, F.struct("embedding")))["embedding"]
    own = df.filter("k < 5").groupBy("doc_id").agg(pick(0).alias("title"), pick(1).alias("description"), pick(2).alias("combined"), pick(3).alias("whisper"), pick(4).alias("auto"))
    own = own.withColumn("transcript", F.coalesce(F.when(F.col("doc_id") % 3 == 0, F.col("combined")), F.when(F.col("doc_id") % 3 <= 1, F.col("whisper")), F.col("auto")))
    met = Q.ranked(df.filter("k >= 5").join(own.select("doc_id", "transcript"), "doc_id").select("doc_id", V.cosine(F.col("transcript"), F.col("embedding")).alias("s")), ["doc_id"], "s")
    comments = met.groupBy("doc_id").agg(r(F.avg("s")).alias("comments_mean"), r(Q.at("s", 0.5)).alias("comments_median"))
    cos = lambda a, b: r(V.cosine(F.col(a), F.col(b)))
    return own.select("doc_id", cos("title", "description").alias("title_description"), cos("title", "transcript").alias("title_transcript"), cos("description", "transcript").alias("description_transcript")).join(comments, "doc_id", "left")


PAIR_COSINES = f"""WITH e AS (SELECT vec_id // 10 AS doc_id, vec_id % 10 AS k, {E} AS v FROM embeddings), p AS (SELECT doc_id, {', '.join(f'any_value(v) FILTER (k = {k}) AS v{k}' for k in range(5))} FROM e GROUP BY 1),
o AS (SELECT doc_id, v0 AS t, v1 AS x, coalesce(CASE WHEN doc_id % 3 = 0 THEN v2 END, CASE WHEN doc_id % 3 <= 1 THEN v3 END, v4) AS s FROM p), c AS (SELECT doc_id, {cosine_sql('s', 'v')} AS s FROM o JOIN e USING (doc_id) WHERE k >= 5), m AS (SELECT doc_id, round(avg(s), 6) AS comments_mean, round(median(s), 6) AS comments_median FROM c GROUP BY 1)
SELECT doc_id, round({cosine_sql('t', 'x')}, 6) AS title_description, round({cosine_sql('t', 's')}, 6) AS title_transcript, round({cosine_sql('x', 's')}, 6) AS description_transcript, comments_mean, comments_median FROM o LEFT JOIN m USING (doc_id)"""

REDUCED = 8


def projected(spark, d):
    """Each vector in eight dimensions, and the nearest of the labels' centroids there (of equal ones the least label)."""
    low = lambda v: V.unit(F.transform(F.sequence(F.lit(1), F.lit(REDUCED)), lambda j: V.dot(v, F.transform(F.sequence(F.lit(1), F.size(v)), lambda i: F.cos(i * j)))))
    c = S.centroids(emb(spark, d), "label", "embedding").select("label", low(F.col("centroid")).alias("c"))
    all_ = c.agg(F.array_sort(F.collect_list(F.struct("label", "c"))).alias("cs"))  # a row a label
    df = emb(spark, d).select("vec_id", low(F.col("embedding")).alias("v")).crossJoin(all_)
    best = F.array_max(F.transform("cs", lambda x: F.struct(V.dot(F.col("v"), x["c"]).alias("s"), (-x["label"]).alias("less"))))
    return df.select("vec_id", best.alias("b")).select("vec_id", (-F.col("b.less")).cast("long").alias("cluster"), F.round("b.s", 4).alias("similarity"), F.round(1 - F.col("b.s"), 4).alias("distance"))


_LOW = "list_transform(range(1, 9), lambda j: list_sum(list_transform(range(1, len({v}) + 1), lambda i: {v}[i] * cos(i * j))))"
PROJECTED = f"""WITH {CENTROID_CTE}, a AS (SELECT vec_id, {_LOW.format(v='v')} AS v FROM e), b AS (SELECT label, {_LOW.format(v='c')} AS c FROM c), s AS (SELECT vec_id, label, {DOT.format(a='v', b='c')} / (sqrt({DOT.format(a='v', b='v')}) * sqrt({DOT.format(a='c', b='c')})) AS s FROM a CROSS JOIN b)
SELECT vec_id, label::BIGINT AS cluster, round(s, 4) AS similarity, round(1 - s, 4) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS k FROM s) WHERE k = 1"""


def weighted_pools(spark, d):
    """Of each label's vectors, the mean weighted by likes, authority and recency (0.1 at least each) and the median, both of length 1."""
    i = F.col("vec_id")
    least = lambda c: F.greatest(c, F.lit(0.1))
    df = emb(spark, d).select("label", (least(i % 7 * F.lit(1.0)) * least(i % 5 / 5) * least(i % 3 / 3)).alias("w"), F.posexplode("embedding").alias("dim", "x")).withColumn("x", F.col("x").cast("double"))
    g = Q.ranked(df, ["label", "dim"], "x").groupBy("label", "dim").agg((F.sum(F.col("x") * F.col("w")) / F.sum("w")).alias("m"), Q.at("x", 0.5).alias("d"))
    length = lambda c: F.sqrt(F.sum(F.col(c) * F.col(c)).over(Window.partitionBy("label")))
    return g.select("label", F.col("dim").cast("long").alias("dim"), r(F.col("m") / length("m")).alias("mean"), r(F.col("d") / length("d")).alias("median"))


WEIGHTED_POOLS = f"""WITH f AS (SELECT label, greatest(vec_id % 7, 0.1) * greatest(vec_id % 5 / 5, 0.1) * greatest(vec_id % 3 / 3, 0.1) AS w, v, unnest(range(0, len(v))) AS dim FROM (SELECT *, {E} AS v FROM embeddings)),
g AS (SELECT label, dim, sum(v[dim + 1] * w) / sum(w) AS m, median(v[dim + 1]) AS d FROM f GROUP BY 1, 2) SELECT label, dim, round(m / sqrt(sum(m * m) OVER (PARTITION BY label)), 6) AS mean, round(d / sqrt(sum(d * d) OVER (PARTITION BY label)), 6) AS median FROM g"""


def speaker_vectors(spark, d):
    """Mean and greatest vector of each speaker of a label, of length 1; empty turns are left out, a blank name is unknown."""
    i = F.col("vec_id")
    name = F.when(i % 4 == 0, F.lit("  ")).otherwise(F.concat(F.lit("s"), (i % 4).cast("string")))
    df = emb(spark, d).filter(i % 5 != 0).select("label", F.coalesce(F.nullif(F.trim(name), F.lit("")), F.lit("unknown")).alias("speaker"), F.posexplode("embedding").alias("dim", "x"))
    g = df.groupBy("label", "speaker", "dim").agg(F.avg(F.col("x").cast("double")).alias("m"), F.max(F.col("x").cast("double")).alias("g"), F.count("*").alias("turns"))
    length = lambda c: F.sqrt(F.sum(F.col(c) * F.col(c)).over(Window.partitionBy("label", "speaker")))
    return g.select("label", "speaker", F.col("dim").cast("long").alias("dim"), r(F.col("m") / length("m")).alias("mean"), r(F.col("g") / length("g")).alias("greatest"), "turns")


SPEAKER_VECTORS = f"""WITH f AS (SELECT label, CASE WHEN vec_id % 4 = 0 THEN 'unknown' ELSE 's' || (vec_id % 4) END AS speaker, v, unnest(range(0, len(v))) AS dim FROM (SELECT *, {E} AS v FROM embeddings) WHERE vec_id % 5 <> 0),
g AS (SELECT label, speaker, dim, avg(v[dim + 1]) AS m, max(v[dim + 1]) AS g, count(*) AS turns FROM f GROUP BY 1, 2, 3) SELECT label, speaker, dim, round(m / sqrt(sum(m * m) OVER w), 6) AS mean, round(g / sqrt(sum(g * g) OVER w), 6) AS greatest, turns FROM g WINDOW w AS (PARTITION BY label, speaker)"""


def self_similarity(spark, d):
    got = S.self_similarity(emb(spark, d), "label", "vec_id", "embedding", 0.5)
    return got.select("label", "n", r("repetition").alias("repetition"), r("mean").alias("mean"), r("p95").alias("p95"), r(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - F.coalesce("mean", F.lit(0.0))))).alias("diversity"))


SELF_SIMILARITY = f"""WITH e AS (SELECT vec_id, label, {E} AS v FROM embeddings), u AS (SELECT vec_id, label, list_transform(v, lambda x: x / (sqrt({DOT.format(a='v', b='v')}) + 1e-9)) AS v FROM e), p AS (SELECT a.label, a.vec_id AS x, b.vec_id AS y, list_dot_product(a.v, b.v) AS s FROM u a JOIN u b ON a.label = b.label AND a.vec_id < b.vec_id),
m AS (SELECT label, x, max(s) AS s FROM (SELECT label, x, s FROM p UNION ALL SELECT label, y, s FROM p) GROUP BY 1, 2), q AS (SELECT label, avg(s) AS mean, quantile_cont(s, 0.95) AS p95 FROM p GROUP BY 1), n AS (SELECT label, count(*) AS n FROM e GROUP BY 1)
SELECT n.label::BIGINT AS label, n, round(coalesce((SELECT count(*) FROM m WHERE m.label = n.label AND s >= 0.5), 0) / n, 6) AS repetition, round(mean, 6) AS mean, round(p95, 6) AS p95, round(least(1.0, greatest(0.0, 1 - coalesce(mean, 0))), 6) AS diversity FROM n LEFT JOIN q USING (label)"""


def batch_likeness(spark, d):
    """Mean pairwise cosine of each label without making pairs, the speakers it speaks for, and the variance of the norms."""
    g = S.dimension_sums(emb(spark, d), ["label"], "embedding")
    mean = (F.col("sum_square") - F.col("square_sum")) / (F.col("n") * (F.col("n") - 1))
    norms = emb(spark, d).groupBy("label").agg(r(F.var_pop(V.norm(F.col("embedding")))).alias("norm_variance"))
    g = g.withColumn("mean", F.when(F.col("n") > 1, mean))
    return g.select("label", "n", r("mean").alias("mean"), F.when(1 - F.col("mean") > 0.32, 3).when(1 - F.col("mean") > 0.24, 2).otherwise(1).alias("speakers")).join(norms, "label")


BATCH_LIKENESS = f"""WITH e AS (SELECT vec_id, label, {E} AS v FROM embeddings), u AS (SELECT label, list_transform(v, lambda x: x / (sqrt({DOT.format(a='v', b='v')}) + 1e-9)) AS u, sqrt({DOT.format(a='v', b='v')}) AS n FROM e), f AS (SELECT label, u, unnest(range(1, len(u) + 1)) AS i FROM u), s AS (SELECT label, i, sum(u[i]) AS s, sum(u[i] * u[i]) AS q FROM f GROUP BY 1, 2),
g AS (SELECT label, sum(s * s) - sum(q) AS x FROM s GROUP BY 1), n AS (SELECT label, count(*) AS n, round(var_pop(n), 6) AS norm_variance FROM u GROUP BY 1), m AS (SELECT label, n, CASE WHEN n > 1 THEN x / (n * (n - 1)) END AS m, norm_variance FROM g JOIN n USING (label))
SELECT label, n, round(m, 6) AS mean, CASE WHEN 1 - m > 0.32 THEN 3 WHEN 1 - m > 0.24 THEN 2 ELSE 1 END AS speakers, norm_variance FROM m"""


def novelty(spark, d, references: int = 16, top: int = 10):
    """Every fiftieth vector against the reference set (the first sixteen): mean of the ten best, best, 10th percentile, novelty."""
    refs = emb(spark, d).filter(F.col("vec_id") < references).select(F.col("vec_id").alias("ref"), F.col("embedding").alias("e"))
    df = emb(spark, d).filter("vec_id % 50 = 0").crossJoin(F.broadcast(refs)).select("vec_id", "ref", V.cosine(F.col("embedding"), F.col("e"), 1e-10).alias("s"))
    df = Q.ranked(df, ["vec_id"], "s")
    g = df.groupBy("vec_id").agg(F.avg(F.when(F.col("_k") >= F.col("_n") - top, F.col("s"))).alias("mean"), F.max("s").alias("max"), Q.at("s", 0.1).alias("p10"))
    return g.select("vec_id", *(r(c).alias(c) for c in ("mean", "max", "p10")), r(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (1 - F.col("max")) * 0.5 + 0.5))).alias("novelty"))


NOVELTY = f"""WITH e AS (SELECT vec_id, {E} AS v FROM embeddings), p AS (SELECT a.vec_id, {cosine_sql('a.v', 'b.v').replace('1e-9', '1e-10')} AS s FROM e a CROSS JOIN e b WHERE a.vec_id % 50 = 0 AND b.vec_id < 16), k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC) AS k FROM p)
SELECT vec_id, round(avg(s) FILTER (k <= 10), 6) AS mean, round(max(s), 6) AS max, round(quantile_cont(s, 0.1), 6) AS p10, round(least(1.0, greatest(0.0, (1 - max(s)) * 0.5 + 0.5)), 6) AS novelty FROM k GROUP BY 1"""


def distributions(spark, d, bins: int = 10):
    """Each user and the next one by id: likeness of their value histograms (cosine, distance moved, correlation), of their means
    and of their event kinds, and the weighted whole."""
    df = ev(spark, d)
    slot = F.least(F.lit(bins - 1), F.floor(F.col("value") / (500 / bins)))
    h = df.groupBy("user_id").agg(F.array(*(F.count_if(slot == i) / F.count("*") for i in range(bins))).alias("h"), F.avg("value").alias("m"), F.array(*(F.count_if(F.col("event_type") == k) / F.count("*") for k in _KINDS)).alias("t"))
    both = h.join(h.select((F.col("user_id") - 1).alias("user_id"), F.col("h").alias("g"), F.col("m").alias("n"), F.col("t").alias("s")), "user_id")
    upto = lambda a, i: F.aggregate(F.slice(a, 1, i), F.lit(0.0), lambda x, y: x + y)
    moved = sum((F.abs(upto("h", i) - upto("g", i)) for i in range(1, bins + 1)), F.lit(0.0)) / bins
    mh, mg = upto("h", bins) / bins, upto("g", bins) / bins
    ch, cg = F.transform("h", lambda x: x - mh), F.transform("g", lambda x: x - mg)
    both = both.select("user_id", V.cosine(F.col("h"), F.col("g")).alias("histogram"), moved.alias("moved"), V.cosine(ch, cg).alias("correlation"), (F.least("m", "n") / F.greatest("m", "n")).alias("ratio"), V.cosine(F.col("t"), F.col("s")).alias("kinds"))
    whole = 0.25 * F.col("histogram") + 0.15 * F.col("kinds") + 0.15 * (F.col("histogram") + F.col("kinds") + F.col("ratio")) / 3 + 0.10 * F.col("ratio") + 0.15 * F.greatest("correlation", F.lit(0.0)) + 0.10 * (1 - F.col("moved")) + 0.10 * F.col("kinds")
    whole = F.least(F.lit(1.0), F.greatest(F.lit(0.0), whole))
    return both.select("user_id", *(r(c).alias(c) for c in ("histogram", "moved", "correlation", "ratio", "kinds")), r(whole).alias("overall"), r(1 - whole).alias("uniqueness"))


_KINDS = ("click", "error", "purchase", "signup", "view")
DISTRIBUTIONS = f"""WITH h AS (SELECT user_id, [{', '.join(f'count(*) FILTER (least(9, floor(value / 50)) = {i}) / count(*)' for i in range(10))}] AS h, avg(value) AS m, [{', '.join(f"count(*) FILTER (event_type = '{k}') / count(*)" for k in _KINDS)}] AS t FROM events GROUP BY 1),
b AS (SELECT a.user_id, a.h, b.h AS g, a.m, b.m AS n, a.t, b.t AS s, list_transform(a.h, lambda x: x - list_sum(a.h) / 10) AS ch, list_transform(b.h, lambda x: x - list_sum(b.h) / 10) AS cg FROM h a JOIN h b ON b.user_id = a.user_id + 1),
c AS (SELECT user_id, {cosine_sql('h', 'g')} AS histogram, list_sum(list_transform(range(1, 11), lambda i: abs(list_sum(h[1:i]) - list_sum(g[1:i])))) / 10 AS moved, {cosine_sql('ch', 'cg')} AS correlation, least(m, n) / greatest(m, n) AS ratio, {cosine_sql('t', 's')} AS kinds FROM b),
o AS (SELECT *, least(1.0, greatest(0.0, 0.25 * histogram + 0.15 * kinds + 0.15 * (histogram + kinds + ratio) / 3 + 0.10 * ratio + 0.15 * greatest(correlation, 0.0) + 0.10 * (1 - moved) + 0.10 * kinds)) AS overall FROM c)
SELECT user_id, {', '.join(f'round({c}, 6) AS {c}' for c in ('histogram', 'moved', 'correlation', 'ratio', 'kinds', 'overall'))}, round(1 - overall, 6) AS uniqueness FROM o"""


def adjacent(spark, d):
    """Of a label's vectors in order: mean and deviation of neighbours' cosines, and the greatest jump, 0 at least."""
    w = Window.partitionBy("label").orderBy("vec_id")
    df = emb(spark, d).withColumn("b", F.lag("embedding").over(w)).filter("b is not null").select("label", V.cosine(F.col("embedding"), F.col("b")).alias("s"))
    return df.groupBy("label").agg(F.count("*").alias("n"), r(F.avg("s")).alias("mean"), r(F.stddev_pop("s")).alias("std"), r(F.max(F.greatest(F.lit(0.0), 1 - F.col("s")))).alias("greatest_jump"))


ADJACENT = f"""WITH e AS (SELECT label, {E} AS a, lag({E}) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings), s AS (SELECT label, {cosine_sql('a', 'b')} AS s FROM e WHERE b IS NOT NULL)
SELECT label, count(*) AS n, round(avg(s), 6) AS mean, round(stddev_pop(s), 6) AS std, round(max(greatest(0.0, 1 - s)), 6) AS greatest_jump FROM s GROUP BY 1"""


def boxes(spark, d):
    """Events as boxes: frame (ten of them), side (tracks and detections), order and the box."""
    i = F.col("event_id")
    x, y = (i * 37 % 60).cast("double"), (i * 53 % 40).cast("double")
    box = F.struct(x.alias("x1"), y.alias("y1"), (x + 30 + i % 7).alias("x2"), (y + 30 + i % 11).alias("y2"))
    return ev(spark, d).select("event_id", "user_id", "ts", F.floor(i / 10).alias("frame"), (i % 10 >= 5).alias("is_track"), box.alias("box"))


BOXES = "boxes AS (SELECT event_id, user_id, ts, event_id // 10 AS frame, event_id % 10 >= 5 AS is_track, (event_id * 37 % 60)::DOUBLE AS x1, (event_id * 53 % 40)::DOUBLE AS y1, event_id * 37 % 60 + 30.0::DOUBLE + event_id % 7 AS x2, event_id * 53 % 40 + 30.0::DOUBLE + event_id % 11 AS y2 FROM events)"


def iou_sql(a: str, b: str, eps: str) -> str:
    inter = f"(greatest(0.0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0.0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)))"
    area = lambda s: f"({s}.x2 - {s}.x1) * ({s}.y2 - {s}.y1)"
    return f"{inter} / ({area(a)} + {area(b)} - {inter} + {eps})"


def matched_boxes(spark, d, least: float = 0.3):
    """Each track's best detection of its frame, from ``least`` on; a detection wanted by several tracks goes to the first."""
    df = boxes(spark, d)
    t, x = df.filter("is_track").select("frame", F.col("event_id").alias("track"), F.col("box").alias("a")), df.filter("not is_track").select("frame", F.col("event_id").alias("detection"), F.col("box").alias("b"))
    met = t.join(x, "frame").select("frame", "track", "detection", V.iou(F.col("a"), F.col("b"), 1e-12).alias("iou"))
    best = met.groupBy("frame", "track").agg(F.min(F.struct((-F.col("iou")).alias("less"), "detection")).alias("m")).select("frame", "track", "m.detection", (-F.col("m.less")).alias("iou")).filter(F.col("iou") >= least)
    won = best.groupBy("frame", "detection").agg(F.min(F.struct("track", "iou")).alias("m"))
    return won.select("frame", "detection", "m.track", r("m.iou").alias("iou"))


MATCHED_BOXES = f"""WITH {BOXES}, m AS (SELECT t.frame, t.event_id AS track, x.event_id AS detection, {iou_sql('t', 'x', '1e-12')} AS iou FROM boxes t JOIN boxes x ON t.frame = x.frame AND t.is_track AND NOT x.is_track),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY frame, track ORDER BY iou DESC, detection) AS k FROM m) WHERE k = 1 AND iou >= 0.3) SELECT frame, detection, track, round(iou, 6) AS iou FROM (SELECT *, row_number() OVER (PARTITION BY frame, detection ORDER BY track) AS j FROM b) WHERE j = 1"""


def tracks(spark, d):
    """A track for each of a user's boxes, by the overlap with those of the three rows before."""
    df = boxes(spark, d).withColumn("k", F.row_number().over(by_user()).cast("long")).select("user_id", "event_id", "k", "box.*")
    return folds.folded(df, "user_id", ["k"], ["event_id", "k", "x1", "y1", "x2", "y2"], "user_id long, event_id long, track long", folds.tracked(0.3, 3))


# Of the tracks of the last three rows, each is met at its latest box; the older row's track comes first among equal overlaps.
TRACKS = f"""WITH RECURSIVE {BOXES}, o AS MATERIALIZED (SELECT *, row_number() {W} AS k FROM boxes), g AS MATERIALIZED (SELECT a.user_id, a.k, {', '.join(f"coalesce({iou_sql('a', f'b{i}', '0')}, -1) AS i{i}" for i in (1, 2, 3))} FROM o a {' '.join(f'LEFT JOIN o b{i} ON b{i}.user_id = a.user_id AND b{i}.k = a.k - {i}' for i in (1, 2, 3))}),
t(user_id, k, n, t1, t2, t3) AS (SELECT user_id, 1::BIGINT, 1::BIGINT, 1::BIGINT, 0::BIGINT, 0::BIGINT FROM o WHERE k = 1 UNION ALL SELECT user_id, k, CASE WHEN best > 0.3 THEN n ELSE n + 1 END, CASE WHEN best <= 0.3 THEN n + 1 WHEN c3 = best THEN t3 WHEN c2 = best THEN t2 ELSE t1 END, t1, t2
 FROM (SELECT *, greatest(c1, c2, c3) AS best FROM (SELECT t.user_id, g.k, t.n, t.t1, t.t2, t.t3, i1 AS c1, CASE WHEN t2 = 0 THEN -1 WHEN t2 = t1 THEN i1 ELSE i2 END AS c2, CASE WHEN t3 = 0 THEN -1 WHEN t3 = t1 THEN i1 WHEN t3 = t2 THEN i2 ELSE i3 END AS c3 FROM t JOIN g ON g.user_id = t.user_id AND g.k = t.k + 1)))
SELECT t.user_id, o.event_id, t.t1 AS track FROM t JOIN o ON o.user_id = t.user_id AND o.k = t.k"""


def aligned(spark, d):
    """Purchases as wanted frames, all but every seventh event as provided ones: how many are covered, and times that run back."""
    df = ev(spark, d)
    want = df.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("frame"))
    own = df.filter("event_id % 7 <> 0").select(F.col("event_id").alias("frame"), F.unix_micros("ts").alias("us"))
    got = want.join(own, "frame", "left").withColumn("back", F.col("us") < F.lag("us").over(Window.partitionBy("user_id").orderBy("frame")))
    return got.groupBy("user_id").agg(F.count("*").alias("wanted"), F.count("us").alias("found"), F.min(F.when(F.col("us").isNull(), F.col("frame"))).alias("first_missing"), F.count_if("back").alias("runs_back"), (F.count("*") == F.count("us")).alias("covered"))


ALIGNED = """WITH j AS (SELECT w.user_id, w.event_id AS frame, epoch_us(o.ts) AS us FROM events w LEFT JOIN (SELECT * FROM events WHERE event_id % 7 <> 0) o ON o.event_id = w.event_id WHERE w.event_type = 'purchase'), b AS (SELECT *, us < lag(us) OVER (PARTITION BY user_id ORDER BY frame) AS back FROM j)
SELECT user_id, count(*) AS wanted, count(us) AS found, min(frame) FILTER (us IS NULL) AS first_missing, count(*) FILTER (back) AS runs_back, count(*) = count(us) AS covered FROM b GROUP BY 1"""


def sessions_of(spark, d):
    """Sessions of users: key, session, start, end and mean, in hours."""
    s = T.sessions(ev(spark, d), "user_id", ["ts", "event_id"], 43_200)
    return s.groupBy("user_id", "session").agg((F.min(F.unix_micros("ts")) / HOUR).alias("start"), (F.max(F.unix_micros("ts")) / HOUR).alias("end"), F.avg("value").alias("mean"))


SESSIONS_OF = f"""sess AS (SELECT user_id, session, min(us) / {HOUR} AS start, max(us) / {HOUR} AS "end", avg(value) AS mean FROM (SELECT *, sum(l) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM (SELECT *, epoch_us(ts) AS us, CASE WHEN (epoch_us(ts) - lag(epoch_us(ts)) {W}) / 1e6 <= 43200 THEN 0 ELSE 1 END AS l FROM events)) GROUP BY 1, 2)"""


def first_span(spark, d):
    """The first session of a user that holds each purchase of the next user; none for a purchase outside."""
    points = ev(spark, d).filter("event_type = 'purchase'").select((F.col("user_id") - 1).alias("user_id"), "event_id", (F.unix_micros("ts") / HOUR).alias("t"))
    met = T.within(points, sessions_of(spark, d), "user_id", "t", "start", "end", 24.0)
    best = met.groupBy("event_id").agg(F.min(F.struct("start", "session")).alias("m"))
    return points.join(best, "event_id", "left").select("event_id", F.col("m.session").alias("session"))


FIRST_SPAN = f"""WITH {SESSIONS_OF}, p AS (SELECT user_id - 1 AS user_id, event_id, epoch_us(ts) / {HOUR} AS t FROM events WHERE event_type = 'purchase')
SELECT event_id, (SELECT session FROM sess s WHERE s.user_id = p.user_id AND t >= start AND t <= "end" ORDER BY start LIMIT 1)::BIGINT AS session FROM p"""


def span_context(spark, d, pad: float = 6.0):
    """Mean of the sessions within six hours of each purchase of the next user; that of the first session where there is none."""
    points = ev(spark, d).filter("event_type = 'purchase'").select((F.col("user_id") - 1).alias("user_id"), "event_id", (F.unix_micros("ts") / HOUR).alias("t"))
    s = sessions_of(spark, d)
    near = T.within(points, s, "user_id", "t", "start", "end", 24.0, pad).groupBy("event_id").agg(F.avg("mean").alias("near"), F.count("*").alias("n"))
    first = s.groupBy("user_id").agg(F.min(F.struct("start", "mean")).alias("m")).select("user_id", F.col("m.mean").alias("first"))
    return points.join(near, "event_id", "left").join(first, "user_id", "left").select("event_id", F.coalesce("n", F.lit(0)).alias("n"), r(F.coalesce("near", "first")).alias("context"))


SPAN_CONTEXT = f"""WITH {SESSIONS_OF}, p AS (SELECT user_id - 1 AS user_id, event_id, epoch_us(ts) / {HOUR} AS t FROM events WHERE event_type = 'purchase'), n AS (SELECT event_id, count(*) AS n, avg(mean) AS near FROM p JOIN sess s ON s.user_id = p.user_id AND t >= start - 6 AND t <= "end" + 6 GROUP BY 1)
SELECT p.event_id, coalesce(n, 0) AS n, round(coalesce(near, (SELECT mean FROM sess s WHERE s.user_id = p.user_id ORDER BY start LIMIT 1)), 6) AS context FROM p LEFT JOIN n USING (event_id)"""


def subset_sampling(spark, d):
    """Frames wanted by a component that must be its provider's: kept where they are, else as many even ones of the provider's.

    Clicks are wanted; the provider has the views, and of users with even ids the clicks too.
    """
    df = ev(spark, d).select("user_id", "event_id", "event_type")
    want = df.filter("event_type = 'click'")
    parent = df.filter("event_type = 'view' or (event_type = 'click' and user_id % 2 = 0)").select("user_id", "event_id")
    test = want.join(parent.withColumn("own", F.lit(True)), ["user_id", "event_id"], "left").groupBy("user_id").agg(F.count("*").alias("n"), (F.count("own") == F.count("*")).alias("is_subset"))
    w = Window.partitionBy("user_id")
    placed = parent.withColumn("i", F.row_number().over(w.orderBy("event_id")) - 1).withColumn("all", F.count("*").over(w)).join(test.filter("not is_subset"), "user_id")
    k = F.least("n", "all")
    # Place i is taken if one of the k even places rounds to it; the two nearest tell.
    near = F.when(k == 1, F.array(F.lit(0))).otherwise(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda o: F.greatest(F.lit(0), F.least(k - 1, F.floor(F.col("i") * (k - 1) / (F.col("all") - 1)) + o))))
    hit = F.exists(near, lambda j: F.when(k == 1, F.col("i") == 0).otherwise(F.rint(j * (F.col("all") - 1) / (k - 1)) == F.col("i")))
    new = placed.filter(hit).select("user_id", "event_id", F.lit(True).alias("resampled"))
    kept = want.join(test.filter("is_subset"), "user_id").select("user_id", "event_id", F.lit(False).alias("resampled"))
    return kept.union(new)


SUBSET_SAMPLING = """WITH want AS (SELECT user_id, event_id FROM events WHERE event_type = 'click'), parent AS (SELECT user_id, event_id FROM events WHERE event_type = 'view' OR (event_type = 'click' AND user_id % 2 = 0)),
t AS (SELECT w.user_id, count(*) AS n, count(p.event_id) = count(*) AS is_subset FROM want w LEFT JOIN parent p USING (user_id, event_id) GROUP BY 1), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS whole FROM parent),
j AS (SELECT k.*, least(n, whole) AS m FROM k JOIN t USING (user_id) WHERE NOT is_subset)
SELECT user_id, event_id, false AS resampled FROM want JOIN t USING (user_id) WHERE is_subset UNION ALL SELECT user_id, event_id, true FROM j WHERE CASE WHEN m = 1 THEN i = 0 ELSE list_contains(list_transform(range(0, m), lambda x: round_even(x * (whole - 1) / (m - 1), 0)), i::DOUBLE) END"""


def jump_cuts(spark, d, near: int = 21_600):
    """Purchases as cuts, with a click (landmark) of the user before and after within six hours, no view (background) between."""
    w = by_user()
    ahead, behind = w.rowsBetween(1, Window.unboundedFollowing), w.rowsBetween(Window.unboundedPreceding, -1)
    us = F.unix_micros("ts")
    when = lambda k: F.when(F.col("event_type") == k, us)
    df = ev(spark, d).select("event_id", "event_type", us.alias("us"), *(F.last(when(k), True).over(behind).alias(f"{k}_before") for k in ("click", "view")), *(F.first(when(k), True).over(ahead).alias(f"{k}_after") for k in ("click", "view")))
    limit = near * 1_000_000
    face = ((F.col("us") - F.col("click_before")) <= limit) & ((F.col("click_after") - F.col("us")) <= limit)
    still = (F.coalesce("view_before", F.lit(0)) < F.col("click_before")) & (F.coalesce("view_after", F.lit(2**62)) > F.col("click_after"))
    return df.filter("event_type = 'purchase'").select("event_id", F.coalesce(face, F.lit(False)).alias("has_face"), F.coalesce(face & still, F.lit(False)).alias("is_jump"))


JUMP_CUTS = f"""WITH j AS (SELECT event_id, event_type, epoch_us(ts) AS us, {', '.join(f"max(CASE WHEN event_type = '{k}' THEN epoch_us(ts) END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS {k}_before, min(CASE WHEN event_type = '{k}' THEN epoch_us(ts) END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS {k}_after" for k in ('click', 'view'))} FROM events)
SELECT event_id, coalesce(us - click_before <= 21600000000 AND click_after - us <= 21600000000, false) AS has_face, coalesce(us - click_before <= 21600000000 AND click_after - us <= 21600000000 AND coalesce(view_before, 0) < click_before AND coalesce(view_after, 4611686018427387904) > click_after, false) AS is_jump FROM j WHERE event_type = 'purchase'"""


def aligned_peaks(spark, d, lag: int = 7_200, near: int = 10_800):
    """Share of a user's purchases that have a click within three hours, two hours later."""
    df = ev(spark, d)
    peaks = df.filter("event_type = 'purchase'")
    shifted = peaks.withColumn("ts", F.timestamp_micros(F.unix_micros("ts") + lag * 1_000_000))
    hit = T.near(shifted, df.filter("event_type = 'click'"), "user_id", near).select("event_id", F.lit(True).alias("hit"))
    return peaks.join(hit, "event_id", "left").groupBy("user_id").agg(F.count("*").alias("peaks"), F.count("hit").alias("aligned"), r(F.count("hit") / F.count("*")).alias("reliability"))


ALIGNED_PEAKS = """WITH h AS (SELECT user_id, EXISTS (SELECT 1 FROM events c WHERE c.event_type = 'click' AND c.user_id = p.user_id AND abs(epoch_us(c.ts) - epoch_us(p.ts) - 7200000000) <= 10800000000) AS hit FROM events p WHERE event_type = 'purchase')
SELECT user_id, count(*) AS peaks, count(*) FILTER (hit) AS aligned, round(count(*) FILTER (hit) / count(*), 6) AS reliability FROM h GROUP BY 1"""

_ALL = {
    "v3_pair_cosines": (pair_cosines, PAIR_COSINES), "v7_projected": (projected, PROJECTED), "v11_weighted_pools": (weighted_pools, WEIGHTED_POOLS), "v13_speaker_vectors": (speaker_vectors, SPEAKER_VECTORS), "v17_self_similarity": (self_similarity, SELF_SIMILARITY),
    "v24_batch_likeness": (batch_likeness, BATCH_LIKENESS), "v20_novelty": (novelty, NOVELTY), "v22_distributions": (distributions, DISTRIBUTIONS), "v27_adjacent": (adjacent, ADJACENT), "j9_matched_boxes": (matched_boxes, MATCHED_BOXES), "j10_tracks": (tracks, TRACKS),
    "j1_aligned": (aligned, ALIGNED), "j4_first_span": (first_span, FIRST_SPAN), "j6_span_context": (span_context, SPAN_CONTEXT), "j13_subset_sampling": (subset_sampling, SUBSET_SAMPLING), "j17_jump_cuts": (jump_cuts, JUMP_CUTS), "j20_aligned_peaks": (aligned_peaks, ALIGNED_PEAKS),
}
QUERIES = {k: v[0] for k, v in _ALL.items()}
ORACLES = {k: v[1] for k, v in _ALL.items()}
