"""Queries of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T

SQL_CLEAN = r"trim(regexp_replace(coalesce({}, ''), '[ \t\n\r\f\x0b]+', ' ', 'g'), ' ')"
SQL_WORD = r"[\p{L}\p{N}_]+"
SQL_STOP = ", ".join(f"'{w}'" for w in T.STOPWORDS)


def docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang", "source")


def r(c):
    return F.round(c, 6)


def lexical(spark: SparkSession, d: str) -> DataFrame:
    df = docs(spark, d).withColumn("w", T.words(F.col("text"))).withColumn("s", T.sentences(F.col("text"))).withColumn("l", F.transform("w", F.lower))
    w, n = F.col("w"), F.size("w")
    length = F.char_length(F.array_join(w, ""))
    avg_word, avg_sentence = T.ratio(length, n), T.ratio(n, F.size("s"))
    chars = F.char_length(F.coalesce("text", F.lit("")))
    return df.select(
        "doc_id", n.cast("long").alias("n_words"), F.size("s").cast("long").alias("n_sentences"), r(avg_word).alias("avg_word_len"), r(avg_sentence).alias("avg_sentence_len"),
        r(T.ratio(F.size(F.array_distinct("l")), n)).alias("type_token_ratio"), r(T.ratio(T.marks(F.col("text")), chars)).alias("mark_ratio"),
        r(T.share(w, lambda x: (F.upper(x) == x) & (F.lower(x) != x))).alias("caps_ratio"), r(T.share(w, lambda x: F.char_length(x) > T.RARE_LENGTH)).alias("rare_ratio"),
        r(T.share(F.col("l"), lambda x: x.isin(*T.STOPWORDS))).alias("stopword_ratio"), r(F.when(F.size("s") > 0, avg_sentence / F.greatest(F.lit(1e-6), avg_word)).otherwise(0.0)).alias("readability"),
    )


LEXICAL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS raw, {SQL_CLEAN.format('text')} AS c FROM documents),
k AS (SELECT doc_id, raw, regexp_extract_all(c, '{SQL_WORD}') AS w, list_filter(regexp_split_to_array(c, '[.!?]+ +'), lambda x: x <> '') AS s FROM t),
m AS (SELECT *, list_transform(w, lambda x: lower(x)) AS l, len(w) AS n, len(s) AS ns, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS chars FROM k)
SELECT doc_id, n AS n_words, ns AS n_sentences, round(chars / greatest(1, n), 6) AS avg_word_len, round(n / greatest(1, ns), 6) AS avg_sentence_len,
  round(len(list_distinct(l)) / greatest(1, n), 6) AS type_token_ratio, round(length(regexp_replace(raw, '[^\p{{P}}\p{{S}}]', '', 'g')) / greatest(1, length(raw)), 6) AS mark_ratio,
  round(len(list_filter(w, lambda x: upper(x) = x AND lower(x) <> x)) / greatest(1, n), 6) AS caps_ratio, round(len(list_filter(w, lambda x: length(x) > {T.RARE_LENGTH})) / greatest(1, n), 6) AS rare_ratio,
  round(len(list_filter(l, lambda x: x IN ({SQL_STOP}))) / greatest(1, n), 6) AS stopword_ratio,
  round(CASE WHEN ns > 0 THEN (n / greatest(1, ns)) / greatest(1e-6, chars / greatest(1, n)) ELSE 0 END, 6) AS readability
FROM m"""


def content_hash(spark, d):
    return docs(spark, d).select("doc_id", T.content_hash(F.col("text")).alias("content_hash"), F.char_length(T.clean(F.col("text"))).cast("long").alias("n_clean"))


CONTENT_HASH = f"SELECT doc_id, sha256({SQL_CLEAN.format('text')}) AS content_hash, length({SQL_CLEAN.format('text')}) AS n_clean FROM documents"

TAG = r"#[\p{L}\p{N}_-]+"


def hashtags(spark, d):
    """Tags in lower case, each once, those of the title (first line) before those of the rest, in their order."""
    text = F.coalesce("text", F.lit(""))
    title = F.substring_index(text, "\n", 1)
    rest = F.expr("substring(coalesce(text, ''), length(substring_index(coalesce(text, ''), '\\n', 1)) + 1)")
    found = lambda c: F.transform(F.regexp_extract_all(c, F.lit(TAG), F.lit(0)), F.lower)
    tags = F.array_distinct(F.concat(found(title), found(rest)))
    return docs(spark, d).select("doc_id", F.size(tags).cast("long").alias("n_tags"), F.array_join(tags, " ").alias("tags"), F.char_length(T.clean(F.regexp_replace("text", TAG, " "))).cast("long").alias("n_without"))


HASHTAGS = rf"""
WITH t AS (SELECT doc_id, text, list_transform(regexp_extract_all(split_part(coalesce(text, ''), chr(10), 1), '{TAG}') || regexp_extract_all(substring(coalesce(text, ''), length(split_part(coalesce(text, ''), chr(10), 1)) + 1), '{TAG}'), lambda x: lower(x)) AS g FROM documents),
u AS (SELECT doc_id, text, list_filter(g, lambda x, i: list_position(g, x) = i) AS g FROM t)
SELECT doc_id, len(g) AS n_tags, coalesce(array_to_string(g, ' '), '') AS tags, length({SQL_CLEAN.format(f"regexp_replace(text, '{TAG}', ' ', 'g')")}) AS n_without FROM u"""

# What counts as an address, a mention (no word character before it), a time, a date or time of day.
URL, MENTION, TIME = r"(?i)https?://\S+|(?i)www\.\S+", r"(?<![\p{L}\p{N}_])@([A-Za-z0-9_.]+)", r"\b(?:[0-9]{1,2}:){1,2}[0-9]{2}\b"
DATE = r"\b([0-9]{1,2}[./-][0-9]{1,2}([./-][0-9]{2,4})?|[0-9]{1,2}:[0-9]{2})\b"
PATTERNS = {"n_urls": URL, "n_mentions": MENTION, "n_times": TIME, "n_numbers": r"[0-9]+", "n_exclamations": "!", "n_questions": r"\?"}


def patterns(spark, d):
    """Addresses, mentions, times, numbers and marks of pages, whether a date or time of day is named, and the host."""
    pages = spark.read.parquet(f"{d}/pages.parquet")
    return pages.select("page_id", *(T.occurrences(F.col("html"), p).cast("long").alias(k) for k, p in PATTERNS.items()), F.coalesce("html", F.lit("")).rlike(DATE).alias("names_time"), F.regexp_extract("url", r"^https?://([^/?#:]+)", 1).alias("host"))


PATTERNS_SQL = r"""SELECT page_id, len(regexp_extract_all(h, '(?i)https?://\S+|(?i)www\.\S+')) AS n_urls, len(regexp_extract_all(regexp_replace(h, '([^\p{L}\p{N}_])@', '\1 @', 'g'), '(?:^|[^\p{L}\p{N}_])@([A-Za-z0-9_.]+)')) AS n_mentions,
len(regexp_extract_all(h, '\b(?:[0-9]{1,2}:){1,2}[0-9]{2}\b')) AS n_times, len(regexp_extract_all(h, '[0-9]+')) AS n_numbers, length(h) - length(replace(h, '!', '')) AS n_exclamations, length(h) - length(replace(h, '?', '')) AS n_questions,
regexp_matches(h, '\b([0-9]{1,2}[./-][0-9]{1,2}([./-][0-9]{2,4})?|[0-9]{1,2}:[0-9]{2})\b') AS names_time, regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host FROM (SELECT *, coalesce(html, '') AS h FROM pages)"""


def title_figures(spark, d):
    """Of each text's first line: words, characters, mean word length, exclamation and question marks."""
    title = F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)
    words, count = F.regexp_extract_all(title, F.lit(T.WORD), F.lit(0)), lambda c: (F.char_length(title) - F.char_length(F.replace(title, F.lit(c), F.lit("")))).cast("long")
    length = F.aggregate(words, F.lit(0), lambda s, x: s + F.char_length(x))
    return docs(spark, d).select("doc_id", F.size(words).cast("long").alias("words"), F.char_length(title).cast("long").alias("chars"), F.round(F.when(F.size(words) > 0, length / F.size(words)).otherwise(0.0), 6).alias("mean_word_length"), count("!").alias("exclamations"), count("?").alias("questions"))


TITLE_FIGURES = r"""WITH t AS (SELECT doc_id, split_part(coalesce(text, ''), chr(10), 1) AS t FROM documents), w AS (SELECT *, regexp_extract_all(t, '[\p{L}\p{N}_]+') AS w FROM t)
SELECT doc_id, len(w) AS words, length(t) AS chars, round(CASE WHEN len(w) > 0 THEN list_sum(list_transform(w, lambda x: length(x))) / len(w) ELSE 0 END, 6) AS mean_word_length,
length(t) - length(replace(t, '!', '')) AS exclamations, length(t) - length(replace(t, '?', '')) AS questions FROM w"""


def chunks(spark, d, size: int = 40):
    """The sentences between full stops, or chunks of 40 words where there are fewer than three."""
    df = docs(spark, d).withColumn("x", T.clean(F.col("text"))).filter("x <> ''")
    parts = F.filter(F.transform(F.split("x", "[.]"), lambda s: F.trim(s)), lambda s: s != "")
    w = F.filter(F.split("x", " "), lambda s: s != "")
    starts = F.sequence(F.lit(0), F.floor((F.size(w) - 1) / size).cast("int"))
    fallback = F.transform(starts, lambda k: F.array_join(F.slice(w, k * size + 1, F.lit(size)), " "))
    df = df.select("doc_id", F.posexplode(F.when(F.size(parts) < 3, fallback).otherwise(parts)).alias("chunk", "c"))
    return df.select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.size(F.split("c", " ")).cast("long").alias("n_words"), F.sha1("c").alias("chunk_hash"))


CHUNKS = rf"""
WITH t AS (SELECT doc_id, {SQL_CLEAN.format('text')} AS x FROM documents), s AS (SELECT doc_id, list_filter(list_transform(string_split(x, '.'), lambda s: trim(s, ' ')), lambda s: s <> '') AS s, list_filter(string_split(x, ' '), lambda s: s <> '') AS w FROM t WHERE x <> ''),
c AS (SELECT doc_id, CASE WHEN len(s) < 3 THEN list_transform(range(0, (len(w) + 39) // 40), lambda k: array_to_string(w[k * 40 + 1 : k * 40 + 40], ' ')) ELSE s END AS c FROM s), e AS (SELECT doc_id, unnest(range(len(c))) AS chunk, unnest(c) AS c FROM c)
SELECT doc_id, chunk, len(string_split(c, ' ')) AS n_words, sha1(c) AS chunk_hash FROM e"""


def keyphrases(spark, d, k: int = 10):
    """The most frequent terms of three letters or more in each source's dominant cluster (its commonest language)."""
    df = docs(spark, d)
    tops = df.filter("lang is not null").groupBy("source", "lang").agg(F.count("*").alias("c")).groupBy("source").agg(F.min(F.struct((-F.col("c")).alias("less"), "lang")).alias("x")).select("source", F.col("x.lang").alias("lang"))
    terms = df.join(tops, ["source", "lang"]).select("source", F.explode(F.filter(F.transform(T.words(F.col("text")), F.lower), lambda x: F.char_length(x) > 2)).alias("term"))
    n = terms.groupBy("source", "term").agg(F.count("*").alias("n"))
    w = Window.partitionBy("source").orderBy(F.col("n").desc(), "term")
    return n.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


KEYPHRASES = rf"""
WITH c AS (SELECT source, lang, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) AS k FROM documents WHERE lang IS NOT NULL GROUP BY 1, 2),
t AS (SELECT d.source, unnest(list_transform(regexp_extract_all({SQL_CLEAN.format('text')}, '{SQL_WORD}'), lambda x: lower(x))) AS term FROM documents d JOIN c ON c.source = d.source AND c.lang = d.lang AND k = 1),
n AS (SELECT source, term, count(*) AS n FROM t WHERE length(term) > 2 GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, term) AS rank FROM n) WHERE rank <= 10"""


def mark_entropy(spark, d):
    ch = docs(spark, d).select("doc_id", F.explode(F.split(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\p{P}\p{S}]", ""), "")).alias("c")).filter("c <> ''")
    n = ch.groupBy("doc_id", "c").agg(F.count("*").alias("n"))
    p = n.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("doc_id")))
    return p.groupBy("doc_id").agg(F.count("*").alias("n_kinds"), r(F.sum(-F.col("p") * F.log(F.col("p") + 1e-9))).alias("entropy"))


MARK_ENTROPY = r"""
WITH c AS (SELECT doc_id, unnest(string_split(regexp_replace(coalesce(text, ''), '[^\p{P}\p{S}]', '', 'g'), '')) AS c FROM documents),
n AS (SELECT doc_id, c, count(*) AS n FROM c WHERE c <> '' GROUP BY 1, 2), p AS (SELECT *, n / sum(n) OVER (PARTITION BY doc_id) AS p FROM n)
SELECT doc_id, count(*) AS n_kinds, round(sum(-p * ln(p + 1e-9)), 6) + 0.0 AS entropy FROM p GROUP BY 1"""


def orthography(spark, d):
    w = T.words(F.col("text"))
    bad = lambda x: ~x.rlike(r"^[\p{L}\p{M}]+$") | ~F.lower(x).rlike("[aeiouyáéíóúàèêäöüаеёиоуыэюя]")
    common = lambda x: 1 - F.least(F.lit(1.0), F.char_length(x) / 20)
    return docs(spark, d).select("doc_id", r(T.share(w, bad)).alias("error_rate"), r(F.aggregate(F.transform(w, common), F.lit(0.0), lambda a, x: a + x) / F.greatest(F.lit(1), F.size(w))).alias("frequency_proxy"))


ORTHOGRAPHY = rf"""
WITH t AS (SELECT doc_id, regexp_extract_all({SQL_CLEAN.format('text')}, '{SQL_WORD}') AS w FROM documents)
SELECT doc_id, round(len(list_filter(w, lambda x: NOT regexp_matches(x, '^[\p{{L}}\p{{M}}]+$') OR NOT regexp_matches(lower(x), '[aeiouyáéíóúàèêäöüаеёиоуыэюя]'))) / greatest(1, len(w)), 6) AS error_rate,
  round(coalesce(list_sum(list_transform(w, lambda x: 1 - least(1.0::DOUBLE, length(x) / 20))), 0) / greatest(1, len(w)), 6) AS frequency_proxy FROM t"""


def speech(spark, d):
    """Speech proxies of a conversation's turns: words, pauses, intonation, fillers, estimated minutes and rate."""
    df = spark.read.parquet(f"{d}/conversations.parquet").withColumn("w", T.words(F.col("text")))
    n = F.size("w")
    minutes = F.greatest(F.lit(0.5), F.greatest(F.lit(1), n) / 160)
    ends = F.greatest(F.lit(1), T.occurrences(F.col("text"), r"[.!?]"))
    return df.select("conv_id", "turn", "role", n.cast("long").alias("n_words"), r(minutes).alias("minutes"), r(n / minutes).alias("words_per_minute"), r(T.occurrences(F.col("text"), "[,;:]") / ends).alias("pause_density"), r(T.occurrences(F.col("text"), "[!?]") / ends).alias("intonation"), r(T.share(F.transform("w", F.lower), lambda x: x.isin(*T.FILLERS))).alias("filler_ratio"))


SPEECH = rf"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS x, regexp_extract_all({SQL_CLEAN.format('text')}, '{SQL_WORD}') AS w FROM conversations)
SELECT conv_id, turn, role, len(w) AS n_words, round(greatest(0.5, greatest(1, len(w)) / 160), 6) AS minutes, round(len(w) / greatest(0.5, greatest(1, len(w)) / 160), 6) AS words_per_minute,
  round(len(regexp_extract_all(x, '[,;:]')) / greatest(1, len(regexp_extract_all(x, '[.!?]'))), 6) AS pause_density, round(len(regexp_extract_all(x, '[!?]')) / greatest(1, len(regexp_extract_all(x, '[.!?]'))), 6) AS intonation,
  round(len(list_filter(list_transform(w, lambda x: lower(x)), lambda x: x IN ({", ".join(f"'{f}'" for f in T.FILLERS)}))) / greatest(1, len(w)), 6) AS filler_ratio FROM t"""


def speakers(spark, d):
    df = spark.read.parquet(f"{d}/conversations.parquet")
    n = df.groupBy("conv_id", F.coalesce(F.nullif(F.trim("role"), F.lit("")), F.lit("unknown")).alias("role")).agg(F.count("*").alias("turns"), F.sum(F.char_length(F.coalesce("text", F.lit("")))).alias("chars"))
    total = F.sum("chars").over(Window.partitionBy("conv_id"))
    return n.withColumn("share", r(F.when(total > 0, F.col("chars") / total).otherwise(0.0)))


SPEAKERS = """
WITH n AS (SELECT conv_id, coalesce(nullif(trim(role), ''), 'unknown') AS role, count(*) AS turns, sum(length(coalesce(text, '')))::BIGINT AS chars FROM conversations GROUP BY 1, 2)
SELECT *, round(CASE WHEN sum(chars) OVER (PARTITION BY conv_id) > 0 THEN chars / sum(chars) OVER (PARTITION BY conv_id) ELSE 0 END, 6) AS share FROM n"""

QUERIES = {"t_lexical": lexical, "t13_content_hash": content_hash, "t7_hashtags": hashtags, "t9_title_figures": title_figures, "t8_patterns": patterns, "t31_chunks": chunks, "t32_keyphrases": keyphrases, "t23_mark_entropy": mark_entropy, "t20_orthography": orthography, "t27_speech": speech, "a28_speakers": speakers}
ORACLES = {"t_lexical": LEXICAL, "t13_content_hash": CONTENT_HASH, "t7_hashtags": HASHTAGS, "t9_title_figures": TITLE_FIGURES, "t8_patterns": PATTERNS_SQL, "t31_chunks": CHUNKS, "t32_keyphrases": KEYPHRASES, "t23_mark_entropy": MARK_ENTROPY, "t20_orthography": ORTHOGRAPHY, "t27_speech": SPEECH, "a28_speakers": SPEAKERS}
