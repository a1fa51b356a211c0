"""Queries of feelings as a whole, and of sweeps of sound at boundaries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import affect
from ..operators import quantiles as Q
from .flow_queries import W, by_user, ev, r
from .fold_queries import HOUR, timed
from .pacing_queries import FEELINGS, feelings

#: Which feeling an event stands for; 0.7 of a row's probability is its own, the rest is Neutral.
OWN = {"click": "Happy", "view": "Neutral", "purchase": "Surprise", "signup": "Fear", "error": "Anger"}


def placed(c):
    """Six places, taken of the millionfold as the SQL takes them: a half that the last bit has lost goes up."""
    return F.round(c * 1e6) / 1e6


def individuality(spark, d):
    """A user's body signals, expressivity, range of feelings and style; every second user's arousal is halved, so that styles differ."""
    df = feelings(spark, d).withColumn("arousal", F.col("arousal") / (1 + F.col("user_id") % 2)).withColumn("valence", F.col("valence") / (1 + F.col("user_id") % 3))
    own = F.create_map(*(F.lit(x) for pair in OWN.items() for x in pair))[F.col("label")]
    df = df.withColumns({k: F.when(own == k, 0.7).otherwise(0.0) + (0.3 if k == "Neutral" else 0.0) for k in affect.KINDS})
    kinds = {k: k for k in affect.KINDS}
    scores = affect.body_signals("valence", "arousal", kinds) | affect.individuality("valence", "arousal", kinds)
    return df.groupBy("user_id").agg(*((c if k == "style" else placed(c)).alias(k) for k, c in scores.items()))


_P = {k: f"(CASE WHEN label IN ({', '.join(repr(e) for e, f in OWN.items() if f == k) or 'NULL'}) THEN 0.7::DOUBLE ELSE 0.0 END" + (" + 0.3::DOUBLE)" if k == "Neutral" else ")") for k in affect.KINDS}
INDIVIDUALITY = f"""WITH {FEELINGS}, f AS (SELECT user_id, valence / (1 + user_id % 3) AS v, arousal / (1 + user_id % 2) AS a, {', '.join(f'{p} AS {k}' for k, p in _P.items())} FROM feelings),
g AS (SELECT user_id, avg(CASE WHEN a > 0.3 AND v < 0 THEN 1.0 ELSE 0.0 END) AS s1, avg(Fear + Anger) AS s2, (var_pop(v) + var_pop(a)) / 2 AS var, avg((v > 0.2)::INT) AS c1, avg((a > -0.2 AND a < 0.5)::INT) AS c2, avg(Happy + Neutral) AS c3,
  avg((a > 0.4)::INT) AS high, avg(Sad + Anger + Fear) AS bad, avg(Fear + Surprise) AS odd, avg(sqrt(v * v + a * a)) AS m, stddev_pop(sqrt(v * v + a * a)) AS s, max(sqrt(v * v + a * a)) - min(sqrt(v * v + a * a)) AS w,
  [{', '.join(f'avg({k})' for k in affect.KINDS)}] AS means FROM f GROUP BY 1)
SELECT user_id, round((s1 + s2 + least(1, var * 2)) / 3, 6) AS stress, round((c1 + c2 + c3 + 1 - least(1, var)) / 4, 6) AS confidence, round((high + 1 - least(1, var * 2) + bad) / 3, 6) AS tension, round((least(1, var * 3) + high + odd) / 3, 6) AS nervousness,
  round(m, 6) AS intensity, round(least(1, m / 1.414) * 0.4 + least(1, s / 0.5) * 0.3 + least(1, w / 1.414) * 0.3, 6) AS expressivity,
  round(len(list_filter(means, lambda x: x > 0.1)) / 8 * 0.5 + list_sum(list_transform(means, lambda x: CASE WHEN x > 0 THEN -x * log2(x) ELSE 0 END)) / 3 * 0.5, 6) AS feeling_range,
  CASE WHEN m < 0.3 THEN 'reserved' WHEN m < 0.6 THEN 'moderate' WHEN m < 0.8 THEN 'expressive' ELSE 'highly_expressive' END || CASE WHEN s < 0.1 THEN '_stable' WHEN s > 0.3 THEN '_variable' ELSE '' END AS style FROM g"""

#: Hours on either side of a boundary, and the share of frames that is loud.
NEAR, LOUD = 12, 0.85


def sweeps(spark, d):
    """How likely a sweep of sound stands at each boundary (a purchase): rising frequency, change and high energy of the frames (a
    user's rows) within twelve hours, each less its median over its deviation. Frames meet boundaries by cells of that length."""
    w, whole = by_user(), Window.partitionBy("user_id")
    df = timed(spark, d).withColumns({"rolloff": F.col("value"), "flux": F.coalesce((F.col("value") - F.lag("value").over(w)) ** 2, F.lit(0.0)), "high": F.pmod("event_id", F.lit(11)).cast("double"), "before": F.lag("t").over(w)})
    for c in ("rolloff", "flux", "high"):
        df = Q.beside(df, ["user_id"], c, {f"{c}_m": 0.5})
        df = df.withColumn(c, (F.col(c) - F.col(f"{c}_m")) / (F.stddev_pop(c).over(whole) + 1e-9))
    for c in ("flux", "high"):
        df = Q.beside(df, ["user_id"], c, {f"{c}_bar": LOUD})
    df = df.withColumn("rise", F.col("rolloff") - F.lag("rolloff").over(w)).withColumn("cell", F.floor(F.col("t") / (NEAR * HOUR)))
    at = timed(spark, d).filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("boundary"), F.col("t").alias("at"))
    at = at.withColumn("cell", F.explode(F.array(*(F.floor(F.col("at") / (NEAR * HOUR)) + k for k in (-1, 0, 1)))))
    met = df.join(at, ["user_id", "cell"]).filter(F.abs(F.col("t") - F.col("at")) <= NEAR * HOUR)
    rising = (F.col("rise") > 0) & (F.col("before") >= F.col("at") - NEAR * HOUR)
    score = 0.35 * F.tanh(F.coalesce(F.avg(F.when(rising, F.col("rise"))), F.lit(0.0))) + 0.35 * affect.share(F.col("flux") > F.col("flux_bar") + 1e-9) + 0.30 * affect.share(F.col("high") > F.col("high_bar") + 1e-9)
    return met.groupBy("user_id", "boundary").agg(F.count("*").alias("frames"), r(affect.unit(score)).alias("likely"))


def _normal(c: str) -> str:
    return f"({c} - median({c}) OVER u) / (stddev_pop({c}) OVER u + 1e-9)"


SWEEPS = f"""WITH f AS (SELECT user_id, event_id, ts, event_type, epoch_us(ts) AS t, value AS rolloff, coalesce((value - lag(value) {W}) ** 2, 0) AS flux, (event_id % 11)::DOUBLE AS high, lag(epoch_us(ts)) {W} AS before FROM events),
n AS (SELECT user_id, event_id, ts, t, before, {_normal('rolloff')} AS rolloff, {_normal('flux')} AS flux, {_normal('high')} AS high FROM f WINDOW u AS (PARTITION BY user_id)),
b AS MATERIALIZED (SELECT *, rolloff - lag(rolloff) {W} AS rise, quantile_cont(flux, {LOUD}) OVER (PARTITION BY user_id) AS flux_bar, quantile_cont(high, {LOUD}) OVER (PARTITION BY user_id) AS high_bar FROM n),
m AS (SELECT c.user_id, c.event_id AS boundary, c.t AS middle, b.* EXCLUDE (user_id, event_id) FROM f c JOIN b ON b.user_id = c.user_id AND abs(b.t - c.t) <= {NEAR * HOUR} WHERE c.event_type = 'purchase')
SELECT user_id, boundary, count(*) AS frames, round(least(1, greatest(0, 0.35 * tanh(coalesce(avg(rise) FILTER (rise > 0 AND before >= middle - {NEAR * HOUR}), 0)) + 0.35 * avg((flux > flux_bar + 1e-9)::INT) + 0.3 * avg((high > high_bar + 1e-9)::INT))), 6) AS likely FROM m GROUP BY 1, 2"""

QUERIES = {"a20_individuality": individuality, "e12_sweeps": sweeps}
ORACLES = {"a20_individuality": INDIVIDUALITY, "e12_sweeps": SWEEPS}
