"""Queries of the vector operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import quantiles as Q
from ..operators import similarity as S


def emb(spark, d):
    return spark.read.parquet(f"{d}/embeddings.parquet")


def r(c):
    return F.round(c, 6)


E = "list_transform(embedding, lambda x: x::DOUBLE)"
DOT = "coalesce(list_sum(list_transform(range(1, len({a}) + 1), lambda i: {a}[i] * {b}[i])), 0)"


def norms(spark, d):
    return emb(spark, d).select("vec_id", "label", r(V.norm(F.col("embedding"))).alias("norm"), F.size("embedding").cast("long").alias("dim"), V.sign_hash(F.col("embedding")).alias("sign_hash"))


NORMS = f"WITH e AS (SELECT vec_id, label, {E} AS v FROM embeddings) SELECT vec_id, label, round(sqrt({DOT.format(a='v', b='v')}), 6) AS norm, len(v) AS dim, sha256(array_to_string(list_transform(v, lambda x: CASE WHEN x >= 0 THEN '1' ELSE '0' END), '')) AS sign_hash FROM e"


def consecutive(spark, d):
    w = Window.partitionBy("label").orderBy("vec_id")
    df = emb(spark, d).withColumn("before", F.lag("embedding").over(w)).filter("before is not null")
    cos = V.cosine(F.col("embedding"), F.col("before"))
    return df.select("vec_id", "label", r(cos).alias("similarity"), r(1 - cos).alias("distance"))


CONSECUTIVE = f"""
WITH e AS (SELECT vec_id, label, {E} AS a, lag({E}) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings),
c AS (SELECT vec_id, label, {DOT.format(a='a', b='b')} / ((sqrt({DOT.format(a='a', b='a')}) + 1e-9) * (sqrt({DOT.format(a='b', b='b')}) + 1e-9)) AS c FROM e WHERE b IS NOT NULL)
SELECT vec_id, label, round(c, 6) AS similarity, round(1 - c, 6) AS distance FROM c"""


def centroid(spark, d):
    df, c = emb(spark, d), S.centroids(emb(spark, d), "label", "embedding")
    sim = Q.ranked(df.join(c, "label").select("label", V.cosine(F.col("embedding"), F.col("centroid")).alias("s")), ["label"], "s")
    return sim.groupBy("label").agg(F.count("*").alias("n"), r(F.avg("s")).alias("mean"), r(F.stddev_pop("s")).alias("std"), r(Q.at("s", 0.1)).alias("p10"), r(Q.at("s", 0.9)).alias("p90"))


CENTROID_CTE = f"""e AS (SELECT vec_id, label, {E} AS v FROM embeddings),
m AS (SELECT label, i, avg(v[i]) AS m FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM e) GROUP BY 1, 2), c AS (SELECT label, list(m ORDER BY i) AS c FROM m GROUP BY 1)"""
COS = f"{DOT.format(a='v', b='c')} / ((sqrt({DOT.format(a='v', b='v')}) + 1e-9) * (sqrt({DOT.format(a='c', b='c')}) + 1e-9))"
CENTROID = f"""
WITH {CENTROID_CTE}, s AS (SELECT label, {COS} AS s FROM e JOIN c USING (label))
SELECT label, count(*) AS n, round(avg(s), 6) AS mean, round(stddev_pop(s), 6) AS std, round(quantile_cont(s, 0.1), 6) AS p10, round(quantile_cont(s, 0.9), 6) AS p90 FROM s GROUP BY 1"""


def cluster_entropy(spark, d, k: int = 5, temperature: float = 0.1):
    """Softmax entropy over the k nearest of the label centroids (one row per label: a table as short as the labels)."""
    c = S.centroids(emb(spark, d), "label", "embedding").select(F.col("label").alias("cluster"), "centroid")
    sims = F.transform("cs", lambda x: F.struct(V.cosine(F.col("embedding"), x["centroid"]).alias("s"), x["cluster"].alias("cluster")))
    df = emb(spark, d).crossJoin(c.agg(F.collect_list(F.struct("cluster", "centroid")).alias("cs")))
    top = F.slice(F.sort_array(sims, asc=False), 1, k)
    df = df.select("vec_id", top.alias("top"))
    z = F.transform("top", lambda x: F.exp((x["s"] - F.col("top")[0]["s"]) / temperature))
    df = df.withColumn("z", z).withColumn("total", F.aggregate("z", F.lit(0.0), lambda a, x: a + x))
    p = F.transform("z", lambda x: x / F.col("total"))
    return df.select("vec_id", F.col("top")[0]["cluster"].cast("long").alias("nearest"), r(F.col("top")[0]["s"]).alias("similarity"), r(F.aggregate(p, F.lit(0.0), lambda a, x: a - x * F.log(x + 1e-9))).alias("entropy"))


CLUSTER_ENTROPY = f"""
WITH {CENTROID_CTE}, s AS (SELECT e.vec_id, c.label AS cluster, {COS} AS s FROM e CROSS JOIN c),
k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, cluster DESC) AS rank, max(s) OVER (PARTITION BY vec_id) AS top FROM s),
z AS (SELECT *, exp((s - top) / 0.1) AS z FROM k WHERE rank <= 5), p AS (SELECT *, z / sum(z) OVER (PARTITION BY vec_id) AS p FROM z)
SELECT vec_id, max(cluster) FILTER (WHERE rank = 1)::BIGINT AS nearest, round(max(s), 6) AS similarity, round(sum(-p * ln(p + 1e-9)), 6) + 0.0 AS entropy FROM p GROUP BY 1"""


def variance(spark, d):
    """How far a label's vectors vary: the length of the entries' variances, the five greatest of them, and the greatest entries' length."""
    flat = emb(spark, d).select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.var_pop(F.col("x").cast("double")).alias("v"), F.max(F.col("x").cast("double")).alias("m"))
    top = F.sort_array(F.collect_list("v"), asc=False)  # as many as a vector has entries
    return flat.groupBy("label").agg(r(F.sqrt(F.sum(F.col("v") * F.col("v")))).alias("variance_norm"), *(r(F.get(top, F.lit(k))).alias(f"variance{k + 1}") for k in range(5)), r(F.sqrt(F.sum(F.col("m") * F.col("m")))).alias("max_pool_norm"))


VARIANCE = f"""
WITH f AS (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM (SELECT label, {E} AS v FROM embeddings)), g AS (SELECT label, i, var_pop(v[i]) AS v, max(v[i]) AS m FROM f GROUP BY 1, 2)
SELECT label, round(sqrt(sum(v * v)), 6) AS variance_norm, {', '.join(f'round(list(v ORDER BY v DESC)[{k}], 6) AS variance{k}' for k in range(1, 6))}, round(sqrt(sum(m * m)), 6) AS max_pool_norm FROM g GROUP BY 1"""


def topk(spark, d):
    return S.top_k(emb(spark, d).filter("vec_id % 50 = 0"), emb(spark, d), 5).select("query_id", F.col("rank").cast("long").alias("rank"), "vec_id", r("score").alias("score"))


TOPK = f"""
WITH e AS (SELECT vec_id, {E} AS v FROM embeddings), n AS (SELECT vec_id, v, sqrt({DOT.format(a='v', b='v')}) + 1e-9 AS n FROM e),
p AS (SELECT q.vec_id AS query_id, x.vec_id, q.v AS a, x.v AS b, q.n * x.n AS n FROM n q JOIN n x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0),
s AS (SELECT query_id, vec_id, {DOT.format(a='a', b='b')} / n AS score FROM p)
SELECT query_id, rank, vec_id, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""

QUERIES = {"v1_norms": norms, "v18_consecutive": consecutive, "v19_centroid_similarity": centroid, "v8_cluster_entropy": cluster_entropy, "v14_variance": variance, "v4_top_k": topk}
ORACLES = {"v1_norms": NORMS, "v18_consecutive": CONSECUTIVE, "v19_centroid_similarity": CENTROID, "v8_cluster_entropy": CLUSTER_ENTROPY, "v14_variance": VARIANCE, "v4_top_k": TOPK}
