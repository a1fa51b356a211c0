"""Queries of curves side by side, local fits, flashes, sessions in a stream, and tokens decoded by a table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import signal as G
from ..operators import curves as C
from ..operators import cuts as K
from ..operators import decoding, folds
from ..streaming import events as E
from .flow_queries import HOURS, W, by_user, ev, r
from .fold_queries import HOUR, timed
from .text_queries import docs

DAY = 86_400_000_000
LAGS, BAND = 7, 10
#: Window and degree of local fits.
WINDOW, DEGREE = 7, 2


def daily(spark, d):
    """A user's sums of views and of clicks on each day from the first to the last, 0 where there are none."""
    df = ev(spark, d).filter("user_id is not null and ts is not null").withColumn("day", F.floor(F.unix_micros("ts") / DAY))
    part = lambda kind: F.sum(F.when(F.col("event_type") == kind, F.col("value")).otherwise(0.0))
    sums = df.groupBy("user_id", "day").agg(part("view").alias("views"), part("click").alias("clicks"))
    days = df.groupBy("user_id").agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    return days.join(sums, ["user_id", "day"], "left").fillna(0.0, ["views", "clicks"])


def cross_correlation(spark, d):
    """The lag of up to seven days at which a user's daily views go best with the daily clicks."""
    got = C.side_by_side(daily(spark, d), "user_id", ["day"], "views", "clicks", LAGS, BAND)
    return got.select("user_id", "n", "lag", r("correlation").alias("correlation"), r("alignment").alias("alignment"), r("pearson").alias("pearson"))


CROSS_CORRELATION = f"""WITH e AS (SELECT user_id, epoch_us(ts) // {DAY} AS day, event_type, value FROM events),
s AS (SELECT user_id, day, sum(CASE WHEN event_type = 'view' THEN value ELSE 0.0 END) AS a, sum(CASE WHEN event_type = 'click' THEN value ELSE 0.0 END) AS b FROM e GROUP BY 1, 2),
d AS (SELECT user_id, unnest(range(min(day), max(day) + 1)) AS day FROM e GROUP BY 1),
x AS (SELECT d.user_id, d.day, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM d LEFT JOIN s ON s.user_id = d.user_id AND s.day = d.day),
c AS MATERIALIZED (SELECT user_id, day, a - avg(a) OVER u AS a, b - avg(b) OVER u AS b FROM x WINDOW u AS (PARTITION BY user_id)),
v AS (SELECT user_id, count(*) AS n, sqrt(sum(a * a) * sum(b * b)) AS level, sum(a * b) AS none FROM c GROUP BY 1),
l AS (SELECT v.user_id, n, level, none, unnest(range(-least({LAGS}, n - 1), least({LAGS}, n - 1) + 1)) AS lag FROM v),
p AS (SELECT l.user_id, l.n, l.level, l.none, l.lag, coalesce(sum(x.a * y.b), 0) AS c FROM l LEFT JOIN c x ON x.user_id = l.user_id LEFT JOIN c y ON y.user_id = l.user_id AND x.day = y.day + l.lag GROUP BY ALL),
q AS (SELECT *, CASE WHEN level > 0 THEN c / level ELSE 0 END AS k, CASE WHEN level > 0 THEN none / level ELSE 0 END AS z FROM p)
SELECT user_id, n, lag, round(k, 6) AS correlation, round(least(greatest(k, 0), 1), 6) AS alignment, round(z, 6) AS pearson
FROM q QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(k, 9) DESC, lag) = 1"""


def time_warping(spark, d):
    """The distance of a user's daily views and clicks along the best path of at most ten days off, and the path's length."""
    got = C.side_by_side(daily(spark, d), "user_id", ["day"], "views", "clicks", LAGS, BAND)
    return got.select("user_id", "n", r("distance").alias("distance"), "steps")


def local_fit(spark, d):
    """Values smoothed by parabolas through seven rows."""
    return ev(spark, d).select("event_id", r(G.savitzky_golay("value", by_user(), WINDOW, DEGREE)).alias("smooth"))


def _fit(at: int) -> str:
    return " + ".join(f"({x!r})::DOUBLE * " + ("value" if i == at else f"{'lag' if i < at else 'lead'}(value, {abs(i - at)}) {W}") for i, x in enumerate(G.local_fit(WINDOW, DEGREE, at)))


LOCAL_FIT = f"""SELECT event_id, round(CASE WHEN n <= {WINDOW} THEN value {' '.join(f'WHEN k = {at + 1} THEN f{at} WHEN n - k = {at} THEN f{WINDOW - 1 - at}' for at in range(WINDOW // 2))} ELSE f{WINDOW // 2} END, 6) AS smooth
FROM (SELECT event_id, value, count(*) OVER (PARTITION BY user_id) AS n, row_number() {W} AS k, {', '.join(f'{_fit(at)} AS f{at}' for at in range(WINDOW))} FROM events)"""


def unit_flashes(spark, d):
    """Flashes of two kinds along a user's rows: of the value or its change, and of the time to the row before."""
    w = by_user()
    df = timed(spark, d).withColumns({"change": F.abs(F.col("value") - F.lag("value").over(w)), "gap": (F.col("t") - F.lag("t").over(w)) / HOUR})
    return C.flashes(df, "user_id", ["t", "event_id"], {"surge": ["value", "change"], "pause": ["gap"]}, 1.0, 3, 6.0).withColumn("intensity", r("intensity"))


def stream_sessions(spark, d):
    """Streamed sessions of each user that end after 6 hours without a row. A closing row far ahead, known by its null user, lets the
    watermark pass the last session of a replay."""
    rows = E.closed(E.stream(spark, f"{d}/events.parquet").select("user_id", "ts", "value"), "ts")
    got = E.windowed(rows, F.session_window("ts", f"{HOURS} hours"), ["user_id"], [F.count("*").alias("n"), F.sum("value").alias("total")])
    flat = got.select("user_id", F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "n", "total")
    return E.replay(flat).filter("user_id is not null").withColumn("total", r("total"))


STREAM_SESSIONS = f"""WITH l AS (SELECT user_id, ts, value, event_id, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) {W} < {HOURS * 3_600_000_000} THEN 0 ELSE 1 END AS new FROM events WHERE user_id IS NOT NULL),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM l)
SELECT user_id, min(epoch_us(ts)) AS start_us, max(epoch_us(ts)) + {HOURS * 3_600_000_000} AS end_us, count(*) AS n, round(sum(value), 6) AS total FROM s GROUP BY user_id, s"""

TOKENS = "word_bpe_49k.json"
#: Texts whose ids make a batch.
TEXTS = 256


def decoded_tokens(spark, d):
    """Texts that are kept as token ids, turned back to words by the vocabulary as a table: length, digest and first words."""
    import public_tokenizers

    path = public_tokenizers.path(TOKENS)

    def encode(batches):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        for batch in filter(len, batches):
            # An encoding takes many times its text, so a few texts are encoded at a time.
            for at in range(0, len(batch), TEXTS):
                part = batch.slice(at, TEXTS)
                ids = [tokenizer.encode(t.as_py() or "", add_special_tokens=False).ids for t in part["text"]]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    ids = docs(spark, d).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, "doc_id long, ids array<int>")
    text = decoding.decoded(ids, "doc_id", "ids", decoding.vocabulary(spark, path))
    return text.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("digest"), F.substring("text", 1, 40).alias("head"))


def soft_cuts(spark, d):
    """Fades and dissolves of a user's rows: light and tone are means of the last rows, picture change is that of the light."""
    w = by_user()
    df = timed(spark, d).withColumns({"light": F.avg("value").over(w.rowsBetween(-7, 0)) / 2500, "tone": F.avg("value").over(w.rowsBetween(-11, 0)) / 2500})
    df = df.withColumns({"change": F.abs(F.col("light") - F.lag("light").over(w)) * 8, "motion": F.pmod("event_id", F.lit(5)) / 2})
    return K.soft_cuts(df, "user_id", ["t", "event_id"], "light", "tone", "change", "motion", K.Rules(change=0.04, follow=0.1))


def caption_groups(spark, d):
    """Elements that a user's captions (event types, every other with a mark) belong to, by the overlap of their boxes and likeness."""
    i = F.col("event_id")
    box = {"x1": i * 37 % 4 * 30 + i % 3, "y1": i * 11 % 3 * 20.0, "x2": i * 37 % 4 * 30 + 40 + i % 5, "y2": i * 11 % 3 * 20 + 15.0 + i % 2}
    df = timed(spark, d).select("user_id", "t", "event_id", F.concat("event_type", F.when(i % 2 == 1, "!").otherwise("")).alias("caption"), *(v.cast("double").alias(k) for k, v in box.items()))
    return folds.folded(df, "user_id", ["t", "event_id"], ["event_id", "caption", *box], "user_id long, event_id long, element long", folds.captions(0.6, 0.8))


_ALL = {"m11_cross_correlation": (cross_correlation, CROSS_CORRELATION), "m14_local_fit": (local_fit, LOCAL_FIT), "r7_stream_sessions": (stream_sessions, STREAM_SESSIONS)}
QUERIES = {k: v[0] for k, v in _ALL.items()} | {"m11_time_warping": time_warping, "e15_unit_flashes": unit_flashes, "p7_decoded_tokens": decoded_tokens, "e7_soft_cuts": soft_cuts, "j8_caption_groups": caption_groups}
ORACLES = {k: v[1] for k, v in _ALL.items()}
