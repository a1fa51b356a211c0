"""Queries of clusters and neighbours of vectors: similar rows by a graph, scenes by density, segments and label runs by k-means,
speakers by merged segments."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import clusters as C
from ..operators import density as D
from ..operators import folds
from ..operators import nearest as N
from ..sources.sinks import stored
from .flow_queries import W, by_user, ev, r
from .fold_queries import HOUR, SCENES, timed
from .vector_queries import emb

#: The last: rows of a user whose k-means is done in one task.
EPS, SHOTS, WHOLE = 0.5, 2, 65_536


def similar(spark, d):
    """About the ten nearest others of each row whose id is divisible by 50, by a walk through a neighbour graph of all rows."""
    df = emb(spark, d)
    got = N.search(N.build(df, "vec_id", "embedding"), df.filter("vec_id % 50 = 0"), "vec_id", "embedding", 10)
    return got.select("query_id", "rank", F.col("id").alias("vec_id"), r("score").alias("score"))


def shots(spark, d):
    """Shots (gaps to the next event, in hours) with their place in a user's order."""
    df = timed(spark, d).withColumn("hours", (F.lead("t").over(by_user()) - F.col("t")) / HOUR).filter("hours is not null")
    return df.withColumn("place", F.row_number().over(by_user()).cast("long") - 1).select("user_id", "place", "event_id", "t", "value", "hours")


def density_scenes(spark, d):
    """Scenes of shots: runs of shots in one density cluster of (value, hours) brought to mean 0 and deviation 1; users without such
    a run get scenes grown until they are long enough."""
    own = shots(spark, d)
    labels = D.dbscan(D.standardized(own, "user_id", ["value", "hours"]), "user_id", "place", "x", EPS, SHOTS)
    w = Window.partitionBy("user_id").orderBy("place")
    df = own.join(labels.hint("merge"), ["user_id", "place"]).withColumn("new", F.when(F.col("cluster") == F.lag("cluster").over(w), 0).otherwise(1))
    df = df.withColumn("run", F.sum("new").over(w)).filter("cluster >= 0")
    runs = df.groupBy("user_id", "run").agg(F.min_by("event_id", "place").alias("first_event"), F.count("*").alias("shots"), r(F.sum("hours")).alias("hours"))
    found = runs.select("user_id", (F.row_number().over(Window.partitionBy("user_id").orderBy("run")) - 1).cast("long").alias("scene"), "first_event", "shots", "hours", F.lit("density").alias("method"))
    rest = own.join(labels.filter("cluster >= 0").select("user_id").distinct().hint("merge"), "user_id", "left_anti")
    grown = folds.folded(rest, "user_id", ["t", "event_id"], ["event_id", "hours"], "user_id long, scene long, first_event long, shots long, hours double", folds.scenes(24.0, 12.0, 2))
    return found.union(grown.select("user_id", "scene", "first_event", "shots", r("hours"), F.lit("greedy")))


DENSITY_SCENES = f"""WITH RECURSIVE g AS (SELECT user_id, event_id, ts, value, (lead(epoch_us(ts)) {W} - epoch_us(ts)) / {HOUR} AS h FROM events),
s AS MATERIALIZED (SELECT user_id, event_id, value, h, row_number() {W} - 1 AS place, avg(value) OVER u AS mv, stddev_pop(value) OVER u AS sv, avg(h) OVER u AS mh, stddev_pop(h) OVER u AS sh FROM g WHERE h IS NOT NULL WINDOW u AS (PARTITION BY user_id)),
p AS MATERIALIZED (SELECT user_id, place, event_id, h, (value - mv) / CASE WHEN sv > 0 THEN sv ELSE 1 END AS x, (h - mh) / CASE WHEN sh > 0 THEN sh ELSE 1 END AS y FROM s),
e AS MATERIALIZED (SELECT a.user_id, a.place AS a, b.place AS b FROM p a JOIN p b ON a.user_id = b.user_id AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= {EPS}::DOUBLE ** 2),
c AS MATERIALIZED (SELECT user_id, a AS place FROM e GROUP BY 1, 2 HAVING count(*) >= {SHOTS}),
k AS MATERIALIZED (SELECT e.* FROM e JOIN c x ON x.user_id = e.user_id AND x.place = e.a JOIN c y ON y.user_id = e.user_id AND y.place = e.b),
reach(user_id, place, c) AS (SELECT user_id, place, place FROM c UNION SELECT k.user_id, k.b, reach.c FROM reach JOIN k ON k.user_id = reach.user_id AND k.a = reach.place),
m AS MATERIALIZED (SELECT user_id, place, min(c) AS c FROM reach GROUP BY 1, 2),
l AS (SELECT user_id, place, min(c) AS c FROM (SELECT * FROM m UNION ALL SELECT e.user_id, e.a, m.c FROM e JOIN m ON m.user_id = e.user_id AND m.place = e.b ANTI JOIN c ON c.user_id = e.user_id AND c.place = e.a) GROUP BY 1, 2),
o AS (SELECT p.*, coalesce(l.c, -1) AS c FROM p LEFT JOIN l ON l.user_id = p.user_id AND l.place = p.place),
n AS (SELECT *, CASE WHEN c = lag(c) OVER (PARTITION BY user_id ORDER BY place) THEN 0 ELSE 1 END AS new FROM o),
t AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS run FROM n),
d AS MATERIALIZED (SELECT user_id, run, arg_min(event_id, place) AS first_event, count(*) AS shots, round(sum(h), 6) AS hours FROM t WHERE c >= 0 GROUP BY 1, 2),
greedy AS MATERIALIZED ({SCENES})
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY run) - 1 AS scene, first_event, shots, hours, 'density' AS method FROM d
UNION ALL SELECT *, 'greedy' FROM greedy WHERE user_id NOT IN (SELECT user_id FROM d)"""


def temporal_segments(spark, d):
    """Runs of rows of a user that k-means on their values puts in one of five clusters; users of under ten rows have none, and
    those with a value that is null, no number or infinite get five runs of equal length."""
    rows = ev(spark, d).withColumn("place", F.row_number().over(by_user()).cast("long") - 1).select("user_id", "place", "value")
    sizes = rows.groupBy("user_id").agg(F.count("*").alias("n"), F.max(~F.coalesce(F.col("value").between(-C.MOST, C.MOST), F.lit(False))).alias("odd")).filter("n >= 10")
    rows = stored(rows.join(sizes, "user_id"), "places")
    labels = C.kmeans(C.blocks_of(rows.filter("not odd").withColumn("x", F.array("value")), "user_id", "place", "x", WHOLE), 5, vectors=True)
    labels = labels.select(F.col("key").cast("long").alias("user_id"), F.col("id").alias("place"), F.col("x")[0].alias("value"), F.lit(False).alias("odd"), F.col("cluster").alias("part"))
    even = F.least(F.expr("place div (n div 5)"), F.lit(4))
    df = labels.union(rows.filter("odd").select("user_id", "place", "value", "odd", even.cast("int").alias("part")))
    w = Window.partitionBy("user_id").orderBy("place")
    df = df.withColumn("new", F.when(F.col("part") == F.lag("part").over(w), 0).otherwise(1)).withColumn("segment", F.sum("new").over(w).cast("long") - 1)
    got = df.groupBy("user_id", "segment").agg(F.min("place").alias("start_frame"), (F.max("place") + 1).alias("end_frame"), F.count("*").alias("length_frames"), r(F.avg("value")).alias("mean"), r(F.stddev_pop("value")).alias("std"), F.when(F.first("odd"), "uniform").otherwise("kmeans").alias("method"))
    return got


def label_runs(spark, d):
    """A label's vectors on their first 32 components, by k-means in five clusters (half as many as rows, at most): the share of the
    longest run in order, and how often the cluster changes. Labels of under three rows are stable."""
    df = emb(spark, d).filter("label is not null")
    sizes = df.groupBy("label").agg(F.count("*").alias("n"), F.least(F.lit(5), F.greatest(F.lit(1), F.expr("count(*) div 2"))).cast("int").alias("k"))
    blocks = C.principal(C.blocks_of(df.join(sizes.filter("n >= 3"), "label"), "label", "vec_id", "embedding"), 32)
    clusters = C.kmeans(blocks, 5, of_key=sizes.select(F.col("label").cast("string").alias("key"), "k"))
    w = Window.partitionBy("key").orderBy("id")
    runs = clusters.withColumn("new", F.when(F.col("cluster") == F.lag("cluster").over(w), 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    runs = runs.groupBy("key", "run").agg(F.count("*").alias("length")).groupBy("key").agg((F.max("length") / F.sum("length")).alias("stability"), (F.count("*") - 1).alias("switches"))
    out = sizes.join(runs, sizes["label"].cast("string") == runs["key"], "left")
    return out.select("label", r(F.coalesce("stability", F.lit(1.0))).alias("stability"), F.coalesce("switches", F.lit(0)).cast("long").alias("switches"))


def merged_speakers(spark, d):
    """Speakers of a label's segments: Ward's clusters, as many as the mean distance of the segments suggests."""
    got = C.merged_speakers(emb(spark, d), "label", "vec_id", "embedding")
    return got.select(F.col("key").cast("int").alias("label"), F.col("id").alias("vec_id"), "speaker", "speakers")


QUERIES = {"v5_similar_rows": similar, "e10_density_scenes": density_scenes, "e18_temporal_segments": temporal_segments, "v25_label_runs": label_runs, "v30_merged_speakers": merged_speakers}
ORACLES = {"e10_density_scenes": DENSITY_SCENES}
