"""Queries of nested payloads, artifacts, curves and pools."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import features as X
from ..operators import payload as P
from ..operators import quantiles as Q
from ..operators import ranges
from ..operators import timeline as T
from .timeline_queries import S, W, ev, r

PAYLOAD = "score double, flag boolean, kind string, n long, curve array<double>, marks array<boolean>, none array<double>, inner struct<x: double, deep: struct<y: long, z: string, ok: boolean>, list: array<double>>"


def payloads(spark, d):
    """Events with a nested payload as JSON text, read by its schema; every fifth is broken and so has no features."""
    df = ev(spark, d)
    v, i = F.col("value"), F.col("event_id")
    made = F.struct(v.alias("score"), (v > 100).alias("flag"), F.col("event_type").alias("kind"), (i % 7).alias("n"), F.array(v, v * 2, v - 3, v / 7).alias("curve"), F.array(v > 50, v > 200).alias("marks"), F.array().cast("array<double>").alias("none"),
                    F.struct((v / 2).alias("x"), F.struct((i % 11).alias("y"), F.lit("text").alias("z"), (v > 10).alias("ok")).alias("deep"), F.array(v, v + 1).alias("list")).alias("inner"))
    text = F.when(i % 5 == 0, F.lit("{broken")).otherwise(F.to_json(made))
    return df.select("event_id", "event_type", F.from_json(text, PAYLOAD).alias("payload"))


def flattened(spark, d, features):
    df = payloads(spark, d)
    rows = P.long_rows(df, ["event_type"], features(df.schema["payload"].dataType))
    return rows.groupBy("event_type", "feature").agg(F.count("*").alias("n"), r(F.avg("value")).alias("mean"))


def one_level(spark, d):
    return flattened(spark, d, lambda kind: P.one_level("payload", kind, "c"))


def all_levels(spark, d):
    return flattened(spark, d, lambda kind: P.leaves(F.col("payload"), kind))


def leaves_and_lists(spark, d):
    return flattened(spark, d, lambda kind: P.leaves(F.col("payload"), kind, lists=True))


def _flat_sql(features: dict[str, str]) -> str:
    rows = ", ".join(f"('{k}', ({v})::DOUBLE)" for k, v in features.items())
    return f"WITH e AS (SELECT * FROM events WHERE event_id % 5 <> 0) SELECT event_type, feature, count(*) AS n, round(avg(v), 6) AS mean FROM e, LATERAL (VALUES {rows}) f(feature, v) WHERE v IS NOT NULL GROUP BY 1, 2"


_CURVE = "[value, value * 2, value - 3, value / 7]"
_OWN = {"score": "value", "flag": "(value > 100)::INT", "n": "event_id % 7"}
_DEEP = {"inner.x": "value / 2", "inner.deep.y": "event_id % 11", "inner.deep.ok": "(value > 10)::INT"}
ONE_LEVEL = _flat_sql({f"c__{k}": v for k, v in _OWN.items()} | {f"c__curve__{k}": f"list_{f}({_CURVE}{q})" for k, f, q in (("mean", "avg", ""), ("std", "stddev_pop", ""), ("min", "min", ""), ("max", "max", ""), ("count", "count", ""))} | {f"c__curve__p{q}": f"list_aggregate({_CURVE}, 'quantile_cont', {q / 100})" for q in (50, 90)} | {"c__marks__mean": "((value > 50)::INT + (value > 200)::INT) / 2", "c__none__empty": "1"})
ALL_LEVELS = _flat_sql(_OWN | _DEEP)
LEAVES_AND_LISTS = _flat_sql(_OWN | _DEEP | {"curve": f"list_avg({_CURVE})", "marks": "((value > 50)::INT + (value > 200)::INT) / 2", "inner.list": "value + 0.5"})


def artifacts(spark, d):
    """Artifacts of orders, of three kinds by key: names with values, a features map, arrays of line prices; the component is the priority."""
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("component"), "o_totalprice")
    li = spark.read.parquet(f"{d}/lineitem.parquet").groupBy("l_orderkey").agg(F.collect_list("l_extendedprice").alias("prices"))
    df = o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    k, paired = F.col("o_orderkey") % 3, F.col("o_orderkey") % 3 == 0
    prices = F.coalesce("prices", F.array().cast("array<double>"))
    return df.select("o_orderkey", "component", F.when(paired, F.array(F.lit("total"), F.lit("lines"))).alias("names"), F.when(paired, F.array(F.col("o_totalprice"), F.size(prices).cast("double"))).alias("values"),
                     F.when(k < 2, F.create_map(F.lit("total"), F.col("o_totalprice") * 2, F.lit("bad"), F.lit(float("nan")))).alias("features"), F.create_map(F.lit("price"), prices, F.lit("embedding"), prices, F.lit("blank"), F.array().cast("array<double>")).alias("arrays"))


def artifact_features(spark, d):
    rows = P.artifact_features(artifacts(spark, d), ["o_orderkey"])
    return rows.groupBy("feature").agg(F.count("*").alias("n"), r(F.avg("value")).alias("mean"), r(F.max("value")).alias("max"))


ARTIFACT_FEATURES = f"""WITH l AS (SELECT l_orderkey, count(*) AS n, {', '.join(f'{f} AS {k}' for k, f in (('mean', 'avg(l_extendedprice)'), ('std', 'stddev_pop(l_extendedprice)'), ('min', 'min(l_extendedprice)'), ('max', 'max(l_extendedprice)'), ('p50', 'quantile_cont(l_extendedprice, 0.5)'), ('p90', 'quantile_cont(l_extendedprice, 0.9)')))} FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey % 3 AS k, o_orderpriority[1] AS c, o_totalprice AS t, l.* FROM orders LEFT JOIN l ON l_orderkey = o_orderkey),
f AS (SELECT c || '__total' AS feature, t AS v FROM o WHERE k = 0 UNION ALL SELECT c || '__lines', coalesce(n, 0) FROM o WHERE k = 0 UNION ALL SELECT c || '__total', t * 2 FROM o WHERE k = 1 UNION ALL SELECT c || '__blank__empty', 1 FROM o WHERE k > 0 UNION ALL SELECT c || '__price__empty', 1 FROM o WHERE k > 0 AND n IS NULL
 UNION ALL {' UNION ALL '.join(f"SELECT c || '__price__{k}', {v} FROM o WHERE k > 0 AND n IS NOT NULL" for k, v in (('mean', 'mean'), ('std', 'std'), ('min', 'min'), ('max', 'max'), ('p50', 'p50'), ('p90', 'p90'), ('count', 'n')))})
SELECT feature, count(*) AS n, round(avg(v), 6) AS mean, round(max(v), 6) AS max FROM f GROUP BY 1"""

COMPONENTS = ("A", "N", "R")


def manifest_table(spark, d):
    """A wide row per run (order): each component's (return flag's) status code and the value of its first .npz artifact."""
    li = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus")
    li = ranges.spread(li, ["l_orderkey"])
    path = F.concat(F.lit("part"), F.col("l_linenumber"), F.when(F.col("l_tax") > 0.04, ".NPZ").otherwise(".json"))
    rows = li.select(F.col("l_orderkey").alias("run_id"), F.col("l_returnflag").alias("component"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", path.alias("path")).alias("a"), "l_linestatus")
    runs = rows.groupBy("run_id", "component").agg(F.array_sort(F.collect_list("a")).alias("artifacts"), F.max("l_linestatus").alias("s"))
    status = F.when(F.col("s") == "F", "ok").otherwise("empty")
    own = runs.withColumn("status", status).select("run_id", "component", X.status_code("status").alias("status"), P.first_artifact(F.col("artifacts"), ".npz")["l_extendedprice"].alias("value"))
    long = P.long_rows(own.withColumn("c", F.col("component")), ["run_id", "c"], [("component_status", F.col("status")), ("value", F.col("value"))])
    long = long.select("run_id", F.when(F.col("feature") == "value", F.concat("c", F.lit("__value"))).otherwise(F.concat(F.lit("component_status__"), F.col("c"))).alias("feature"), "value")
    wide = X.training_table(long, ["run_id"], [f"component_status__{c}" for c in COMPONENTS] + [f"{c}__value" for c in COMPONENTS])
    return wide.select("run_id", *(r(c).alias(c) for c in wide.columns[1:]))


MANIFEST_TABLE = f"""WITH s AS (SELECT l_orderkey AS run_id, l_returnflag AS c, max(l_linestatus) AS s, count(*) AS n FROM lineitem GROUP BY 1, 2),
a AS (SELECT l_orderkey AS run_id, l_returnflag AS c, l_extendedprice AS v, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem WHERE l_tax > 0.04),
j AS (SELECT s.run_id, s.c, CASE s WHEN 'F' THEN 1.0 ELSE 0.0 END AS status, v FROM s LEFT JOIN a ON a.run_id = s.run_id AND a.c = s.c AND k = 1)
SELECT run_id, {', '.join(f"max(status) FILTER (c = '{c}')::DOUBLE AS component_status__{c}" for c in COMPONENTS)}, {', '.join(f"round(max(v) FILTER (c = '{c}'), 6) AS {c}__value" for c in COMPONENTS)} FROM j GROUP BY 1"""


def curves(spark, d, length: int = 128):
    """Each user's values as a curve of 128 places, linear between rows."""
    got = P.resampled(ev(spark, d), "user_id", ["ts", "event_id"], "value", length)
    return got.select("user_id", "i", r("value").alias("value"))


CURVES = f"""WITH v AS (SELECT user_id, value, row_number() {W} - 1 AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events), g AS (SELECT user_id, n, i, i * (n - 1) / 127 AS pos FROM (SELECT DISTINCT user_id, n FROM v), range(128) t(i))
SELECT g.user_id, i, round(a.value + coalesce((b.value - a.value) * (pos - floor(pos)), 0), 6) AS value FROM g JOIN v a ON a.user_id = g.user_id AND a.k = floor(pos) LEFT JOIN v b ON b.user_id = g.user_id AND b.k = floor(pos) + 1"""


def pools(spark, d, bins: int = 8, most: int = 3):
    """Mean, greatest and median of eight even bins of a user's rows, and its three strongest events, padded with nulls."""
    w = Window.partitionBy("user_id")
    df = ev(spark, d).withColumn("n", F.count("*").over(w)).withColumn("k", F.row_number().over(w.orderBy("ts", "event_id")) - 1).withColumn("place", F.row_number().over(w.orderBy(F.desc("value"), "event_id")))
    slots = Q.ranked(df.withColumn("slot", F.floor(F.col("k") * bins / F.col("n"))), ["user_id", "slot"], "value")
    pooled = slots.groupBy("user_id", "slot").agg(r(F.avg("value")).alias("mean"), r(F.max("value")).alias("max"), r(Q.at("value", 0.5)).alias("median"))
    top = df.filter(F.col("place") <= most).groupBy("user_id").agg(*(F.max(F.when(F.col("place") == i, F.col("event_id"))).alias(f"top{i}") for i in range(1, most + 1)))
    return pooled.join(top, "user_id")


POOLS = f"""WITH k AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n, row_number() {W} - 1 AS k, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS place FROM events),
p AS (SELECT user_id, floor(k * 8 / n)::BIGINT AS slot, round(avg(value), 6) AS mean, round(max(value), 6) AS max, round(median(value), 6) AS median FROM k GROUP BY 1, 2),
t AS (SELECT user_id, {', '.join(f'max(event_id) FILTER (place = {i}) AS top{i}' for i in (1, 2, 3))} FROM k WHERE place <= 3 GROUP BY 1) SELECT * FROM p JOIN t USING (user_id)"""


def robust(spark, d):
    """Values less the user's median over its median deviation, z-scores, values between 0 and 1, and logarithms of rates."""
    w = Window.partitionBy("user_id")
    df = T.rates(ev(spark, d), "user_id", ["ts", "event_id"], "value")
    df = Q.ranked(df, ["user_id"], "value").withColumn("med", Q.at("value", 0.5, w)).withColumn("dev", F.abs(F.col("value") - F.col("med")))
    df = Q.ranked(df, ["user_id"], "dev").withColumn("mad", Q.at("dev", 0.5, w))
    lo, hi = F.min("value").over(w), F.max("value").over(w)
    return df.select("event_id", r((F.col("value") - F.col("med")) / (F.col("mad") + 1e-9)).alias("robust"), r((F.col("value") - F.avg("value").over(w)) / (F.stddev_pop("value").over(w) + 1e-6)).alias("z"), r(F.when(hi - lo < 1e-9, 0.0).otherwise((F.col("value") - lo) / (hi - lo))).alias("unit"), r(F.log1p(F.abs("rate"))).alias("log_rate"), r(1 / (1 + F.exp(-F.col("value") / 100))).alias("sigmoid"), r(20 * F.log10(F.greatest("value", F.lit(1e-9)))).alias("decibel"))


ROBUST = f"""WITH l AS (SELECT *, value - lag(value) {W} AS diff, greatest(({S} - lag({S}) {W}) / 1e6, 1e-3) AS dt FROM events), f AS (SELECT * FROM l WHERE diff IS NOT NULL), m AS (SELECT *, median(value) OVER (PARTITION BY user_id) AS med FROM f), a AS (SELECT *, median(abs(value - med)) OVER (PARTITION BY user_id) AS mad, min(value) OVER (PARTITION BY user_id) AS lo, max(value) OVER (PARTITION BY user_id) AS hi FROM m)
SELECT event_id, round((value - med) / (mad + 1e-9), 6) AS robust, round((value - avg(value) OVER (PARTITION BY user_id)) / (stddev_pop(value) OVER (PARTITION BY user_id) + 1e-6), 6) AS z, round(CASE WHEN hi - lo < 1e-9 THEN 0 ELSE (value - lo) / (hi - lo) END, 6) AS unit, round(ln(1 + abs(diff / dt)), 6) AS log_rate, round(1 / (1 + exp(-value / 100)), 6) AS sigmoid, round(20 * log10(greatest(value, 1e-9)), 6) AS decibel FROM a"""


def guarded(spark, d, longest: int = 86_400, least: int = 60):
    """Sessions by the length guard: too long ones are rejected, too short ones are errors; rows of hours with a signup are counted."""
    s = T.sessions(ev(spark, d), "user_id", ["ts", "event_id"], 21_600)
    hour = F.floor(T.seconds() / 3600)
    present = ev(spark, d).filter("event_type = 'signup'").select("user_id", hour.alias("hour")).distinct()
    near = s.withColumn("hour", hour).join(present, ["user_id", "hour"], "left_semi").groupBy("user_id", "session").agg(F.count("*").alias("near"))
    length = (F.max(F.unix_micros("ts")) - F.min(F.unix_micros("ts"))) / 1e6
    g = s.groupBy("user_id", "session").agg(F.count("*").alias("n"), length.alias("length"))
    g = g.withColumn("status", F.when(F.col("length") > longest, "rejected").when(F.col("length") < least, "error").otherwise("ok")).join(near, ["user_id", "session"], "left")
    return g.groupBy("user_id", "status").agg(F.count("*").alias("sessions"), F.sum("n").alias("rows"), F.coalesce(F.sum("near"), F.lit(0)).alias("near_rows"))


GUARDED = f"""WITH l AS (SELECT *, CASE WHEN ({S} - lag({S}) {W}) / 1e6 <= 21600 THEN 0 ELSE 1 END AS l FROM events), s AS (SELECT *, sum(l) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session,
 EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'signup' AND p.user_id = l.user_id AND epoch_us(p.ts) // 3600000000 = epoch_us(l.ts) // 3600000000) AS near FROM l),
g AS (SELECT user_id, session, count(*) AS n, (max({S}) - min({S})) / 1e6 AS length, count(*) FILTER (near) AS near FROM s GROUP BY 1, 2)
SELECT user_id, CASE WHEN length > 86400 THEN 'rejected' WHEN length < 60 THEN 'error' ELSE 'ok' END AS status, count(*) AS sessions, sum(n)::BIGINT AS rows, sum(near)::BIGINT AS near_rows FROM g GROUP BY 1, 2"""

_ALL = {
    "p2_one_level": (one_level, ONE_LEVEL), "p3_all_levels": (all_levels, ALL_LEVELS), "p4_leaves_and_lists": (leaves_and_lists, LEAVES_AND_LISTS), "s2_artifact_features": (artifact_features, ARTIFACT_FEATURES), "p6_manifest_table": (manifest_table, MANIFEST_TABLE),
    "p14_curves": (curves, CURVES), "p15_pools": (pools, POOLS), "p16_robust": (robust, ROBUST), "p11_guarded": (guarded, GUARDED),
}
QUERIES = {k: v[0] for k, v in _ALL.items()}
ORACLES = {k: v[1] for k, v in _ALL.items()}
