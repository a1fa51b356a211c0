"""Queries of word lists, questions, chunks, transcripts and speech proxies.

A document's title is its first line, its description the rest. The tables hold no question marks and no emoji, so the
queries that count them put some in, by id.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from .text_queries import SQL_CLEAN, SQL_WORD, r


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def titled(spark, d):
    """doc_id, title and description; every third title becomes a question, some texts get emoji."""
    df = spark.read.parquet(f"{d}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    title = F.substring_index(text, "\n", 1)
    title = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("How "), title, F.lit("?"))).otherwise(title)
    marks = F.concat(F.repeat(F.lit("\U0001f600"), (F.col("doc_id") % 3).cast("int")), F.repeat(F.lit("☀"), (F.col("doc_id") % 2).cast("int")))
    return df.select("doc_id", title.alias("title"), F.concat(F.expr("substring(coalesce(text, ''), length(substring_index(coalesce(text, ''), '\\n', 1)) + 2)"), marks).alias("description"))


TITLED = """titled AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'How ' || split_part(coalesce(text, ''), chr(10), 1) || '?' ELSE split_part(coalesce(text, ''), chr(10), 1) END AS title,
substring(coalesce(text, ''), length(split_part(coalesce(text, ''), chr(10), 1)) + 2) || repeat('\U0001f600', (doc_id % 3)::INT) || repeat('☀', (doc_id % 2)::INT) AS description FROM documents)"""


def titles(spark, d):
    """Question prefix, clickbait score, stop words, dates, numbers and emoji of titles and descriptions."""
    df = titled(spark, d)
    t, both = F.col("title"), F.concat("title", F.lit("\n"), "description")
    words = F.transform(T.words(t), F.lower)
    return df.select("doc_id", L.question_prefix(t).alias("question_prefix"), r(L.clickbait(t)).alias("clickbait"), r(T.share(words, lambda x: x.isin(*T.STOPWORDS))).alias("stopword_ratio"),
                     t.rlike(L.DATE_TIME).alias("time_mention"), t.rlike("[0-9]").alias("number_presence"), F.col("description").rlike(L.TIMESTAMP).alias("has_timestamps"),
                     T.occurrences(t, L.EMOJI).cast("long").alias("emoji_title"), T.occurrences(F.col("description"), L.EMOJI).cast("long").alias("emoji_description"), r(L.diversity(F.regexp_extract_all(both, F.lit(L.EMOJI), F.lit(0)))).alias("emoji_diversity"))


_PREFIX = f"regexp_matches(trim(title, ' '), '{L.QUESTION_PREFIX}')"
_HITS = " + ".join(f"contains(lower(title), '{w}')::INT".replace("you won't", "you won''t") for w in L.CLICKBAIT)
TITLES = rf"""WITH {TITLED}, w AS (SELECT *, list_transform(regexp_extract_all({SQL_CLEAN.format('title')}, '{SQL_WORD}'), lambda x: lower(x)) AS w, regexp_extract_all(title || chr(10) || description, '{L.EMOJI}') AS e FROM titled)
SELECT doc_id, {_PREFIX} AS question_prefix, round(least(1.0::DOUBLE, ({_HITS} + contains(title, '!')::INT + ({_PREFIX})::INT) / 3), 6) AS clickbait, round(len(list_filter(w, lambda x: x IN ({quoted(T.STOPWORDS)}))) / greatest(1, len(w)), 6) AS stopword_ratio,
regexp_matches(title, '{L.DATE_TIME}') AS time_mention, regexp_matches(title, '[0-9]') AS number_presence, regexp_matches(description, '{L.TIMESTAMP}') AS has_timestamps,
len(regexp_extract_all(title, '{L.EMOJI}')) AS emoji_title, len(regexp_extract_all(description, '{L.EMOJI}')) AS emoji_description, round(len(list_distinct(e)) / greatest(1, len(e)), 6) AS emoji_diversity FROM w"""


def best_transcript(spark, d):
    """The transcript by precedence, of a map whose entries are empty for some documents; the sentence split keeps its marks."""
    text = F.coalesce("text", F.lit(""))
    m = F.create_map(F.lit("other"), F.lower(text), F.lit("whisper"), F.when(F.col("doc_id") % 3 == 0, text).otherwise(""), F.lit("youtube_auto"), F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit("auto. "), text)).otherwise(""))
    df = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", T.clean(L.best_transcript(m)).alias("x"))
    return df.select("doc_id", F.sha1("x").alias("transcript_hash"), F.size(L.marked_sentences(F.col("x"))).cast("long").alias("n_sentences"), F.sha1(F.element_at(L.marked_sentences(F.col("x")), -1)).alias("last_sentence_hash"))


BEST_TRANSCRIPT = rf"""WITH t AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN coalesce(text, '') WHEN 1 THEN 'auto. ' || coalesce(text, '') ELSE lower(coalesce(text, '')) END AS x FROM documents), c AS (SELECT doc_id, {SQL_CLEAN.format('x')} AS x FROM t),
s AS (SELECT *, list_filter(string_split(regexp_replace(x, '([.!?]) ', '\1' || chr(1), 'g'), chr(1)), lambda s: s <> '') AS s FROM c)
SELECT doc_id, sha1(x) AS transcript_hash, len(s) AS n_sentences, sha1(s[-1]) AS last_sentence_hash FROM s"""


def overlap_chunks(spark, d):
    """Chunks of at most 40 words of whole sentences, each beginning with the last 10 words of the one before."""
    sents = L.marked_sentences(T.clean(F.col("text")))
    df = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", L.overlap_chunks(sents, 40, 0.25).alias("c"))
    return df.select("doc_id", F.posexplode("c").alias("chunk", "words")).select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.size("words").cast("long").alias("n_words"), F.sha1(F.array_join("words", " ")).alias("chunk_hash"))


# The fold is a recursion over a document's sentences: what is carried, then the chunk that a sentence closed.
OVERLAP_CHUNKS = rf"""WITH RECURSIVE c AS (SELECT doc_id, {SQL_CLEAN.format('text')} AS x FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_filter(string_split(regexp_replace(x, '([.!?]) ', '\1' || chr(1), 'g'), chr(1)), lambda s: s <> '') AS s FROM c),
f(doc_id, s, i, held, chunk, done) AS (SELECT doc_id, s, 0, []::VARCHAR[], 0, NULL::VARCHAR[] FROM s
UNION ALL SELECT doc_id, s, i + 1, CASE WHEN over THEN held[greatest(1, len(held) - 9):] ELSE held END || w, chunk + (over AND len(held) > 0)::INT, CASE WHEN over AND len(held) > 0 THEN held END
FROM (SELECT doc_id, s, i, held, chunk, string_split(s[i + 1], ' ') AS w, len(held) + len(string_split(s[i + 1], ' ')) > 40 AS over FROM f WHERE i < len(s))),
o AS (SELECT doc_id, chunk - 1 AS chunk, done AS w FROM f WHERE done IS NOT NULL UNION ALL SELECT doc_id, chunk, held FROM f WHERE i = len(s) AND len(held) > 0)
SELECT doc_id, chunk::BIGINT AS chunk, len(w) AS n_words, sha1(array_to_string(w, ' ')) AS chunk_hash FROM o"""


def asked(spark, d):
    """Turns of conversations, every second one of them put as questions."""
    t = F.coalesce("text", F.lit(""))
    return spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", F.when(F.col("turn") % 2 == 0, F.concat(F.lit("Когда "), t, F.lit("? И как "), F.substring(t, 1, 20), F.lit("?"))).otherwise(t).alias("text"))


ASKED = "asked AS (SELECT conv_id, turn, role, CASE WHEN turn % 2 = 0 THEN 'Когда ' || coalesce(text, '') || '? И как ' || substring(coalesce(text, ''), 1, 20) || '?' ELSE coalesce(text, '') END AS text FROM conversations)"


def questions(spark, d):
    """Questions by source: sentences of system and assistant turns, whole texts of user turns, as comments are."""
    parts = F.when(F.col("role") == "user", F.array("text")).otherwise(T.sentences(F.col("text")))
    df = asked(spark, d).select("conv_id", F.when(F.col("role") == "user", "comments").otherwise("transcript").alias("source"), F.explode(parts).alias("s"))
    return df.groupBy("source").agg(F.count("*").alias("n_sentences"), F.count_if(F.lower("s").rlike(L.QUESTION)).alias("n_questions"), F.countDistinct(F.when(F.lower("s").rlike(L.QUESTION), F.col("conv_id"))).alias("n_conversations"))


QUESTIONS = rf"""WITH {ASKED}, p AS (SELECT conv_id, CASE WHEN role = 'user' THEN 'comments' ELSE 'transcript' END AS source, unnest(CASE WHEN role = 'user' THEN [text] ELSE list_filter(regexp_split_to_array({SQL_CLEAN.format('text')}, '[.!?]+ +'), lambda x: x <> '') END) AS s FROM asked)
SELECT source, count(*) AS n_sentences, count(*) FILTER (regexp_matches(lower(s), '{L.QUESTION}')) AS n_questions, count(DISTINCT CASE WHEN regexp_matches(lower(s), '{L.QUESTION}') THEN conv_id END) AS n_conversations FROM p GROUP BY 1"""


def style_flags(spark, d):
    """Questions between full stops, and the flags of instructions, address and calls to action; sentence length and questions."""
    df = asked(spark, d)
    low = F.lower("text")
    has = lambda words: F.greatest(*(F.contains(low, F.lit(w)) for w in words))
    faq = F.size(F.filter(F.split("text", r"\."), lambda s: F.trim(s).endswith("?")))
    sents = T.sentences(F.col("text"))
    n = F.size(sents)
    words = F.aggregate(F.transform(sents, lambda s: F.size(T.words(s))), F.lit(0), lambda a, x: a + x)
    return df.select("conv_id", "turn", faq.cast("long").alias("faq_count"), *(has(w).alias(f"{k}_flag") for k, w in L.STYLE.items()), r(T.ratio(words, n)).alias("avg_sentence_len"), r(T.ratio(F.size(F.filter(sents, lambda s: F.contains(s, F.lit("?")))), n)).alias("question_ratio"))


_SENTS = rf"list_filter(regexp_split_to_array({SQL_CLEAN.format('text')}, '[.!?]+ +'), lambda x: x <> '')"
STYLE_FLAGS = rf"""WITH {ASKED}, s AS (SELECT *, lower(text) AS low, {_SENTS} AS s FROM asked)
SELECT conv_id, turn, len(list_filter(string_split(text, '.'), lambda x: suffix(trim(x, ' '), '?'))) AS faq_count, {", ".join("(" + " OR ".join(f"contains(low, '{w}')" for w in ws) + f") AS {k}_flag" for k, ws in L.STYLE.items())},
round(coalesce(list_sum(list_transform(s, lambda x: len(regexp_extract_all(x, '{SQL_WORD}')))), 0) / greatest(1, len(s)), 6) AS avg_sentence_len, round(len(list_filter(s, lambda x: contains(x, '?'))) / greatest(1, len(s)), 6) AS question_ratio FROM s"""


def recognised(spark, d):
    """Turns with a confidence, a start and an end, made of their lengths; every third conversation declares no duration."""
    n = F.char_length(F.coalesce("text", F.lit("")))
    return spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"), (n % 100 / 100).alias("confidence"), (F.when(F.col("conv_id") % 3 == 1, n / 15).otherwise(F.lit(0.0))).alias("seconds"), F.when(F.col("conv_id") % 3 == 0, F.col("conv_id") % 500 + 2.0).alias("declared"))


RECOGNISED = """recognised AS (SELECT conv_id, turn, coalesce(text, '') AS text, length(coalesce(text, '')) % 100 / 100 AS confidence, CASE WHEN conv_id % 3 = 1 THEN length(coalesce(text, '')) / 15 ELSE 0 END AS seconds, CASE WHEN conv_id % 3 = 0 THEN conv_id % 500 + 2.0 END AS declared FROM conversations)"""


def recognition(spark, d):
    """Confidence mean, deviation and least mean of blocks; duration by precedence; rates; rare, odd and low-confidence shares."""
    w = Window.partitionBy("conv_id")
    df = recognised(spark, d).withColumn("n", F.count("*").over(w)).withColumn("i", F.row_number().over(w.orderBy("turn", "text")) - 1)
    block = F.greatest(F.lit(1.0), F.rint(F.col("n") / F.greatest(F.lit(1), F.floor(F.col("n") / 10) + 1)))
    words = T.words(F.col("text"))
    df = df.select("conv_id", "confidence", "seconds", "declared", F.floor(F.col("i") / block).alias("block"), F.size(words).alias("words"), F.char_length(T.clean(F.col("text"))).alias("chars"),
                   F.size(F.filter(words, L.is_rare)).alias("rare"), F.size(F.filter(words, L.is_odd)).alias("odd"))
    blocks = df.groupBy("conv_id", "block").agg(*(F.sum(c).alias(c) for c in ("confidence", "words", "chars", "rare", "odd", "seconds")), F.sum(F.col("confidence") ** 2).alias("squares"), F.count("*").alias("n"), F.count_if(F.col("confidence") < 0.5).alias("low"), F.max("declared").alias("declared"))
    g = blocks.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in ("confidence", "words", "chars", "rare", "odd", "seconds", "squares", "n", "low")), F.min(F.col("confidence") / F.col("n")).alias("least"), F.max("declared").alias("declared"))
    mean = F.col("confidence") / F.col("n")
    seconds = F.when(F.col("declared") > 1, F.col("declared")).when(F.col("seconds") > 1, F.col("seconds")).otherwise(60 * F.greatest(F.lit(0.5), F.greatest(F.col("words"), F.lit(1)) / 160))
    rare, low = T.ratio(F.col("rare"), F.col("words")), F.col("low") / F.col("n")
    return g.select("conv_id", r(mean).alias("confidence_mean"), r(F.sqrt(F.greatest(F.lit(0.0), F.col("squares") / F.col("n") - mean * mean))).alias("confidence_std"), r("least").alias("confidence_least_block"), r(seconds).alias("seconds"), r(F.col("words") / (seconds / 60)).alias("words_per_minute"), r(F.col("chars") / seconds).alias("chars_per_second"),
                    r(rare).alias("rare_ratio"), r(T.ratio(F.col("odd"), F.col("words"))).alias("oov_ratio"), r(F.least(F.lit(1.0), 0.5 * rare + 0.5 * low)).alias("error_proxy"), r(low).alias("noise_proxy"))


RECOGNITION = rf"""WITH {RECOGNISED}, w AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS i, regexp_extract_all({SQL_CLEAN.format('text')}, '{SQL_WORD}') AS w FROM recognised),
b AS (SELECT conv_id, confidence, seconds, declared, floor(i / greatest(1, round_even(n / greatest(1, n // 10 + 1), 0))) AS block, len(w) AS words, length({SQL_CLEAN.format('text')}) AS chars,
 len(list_filter(w, lambda x: length(x) > 12 OR regexp_matches(x, '\p{{Nd}}') OR length(regexp_replace(x, '[\p{{L}}\p{{M}}\p{{Nd}}]', '', 'g')) / length(x) > 0.4)) AS rare, len(list_filter(w, lambda x: length(regexp_replace(x, '[^\p{{L}}\p{{M}}]', '', 'g')) < greatest(1, length(x) // 2))) AS odd FROM w),
m AS (SELECT conv_id, avg(confidence) AS m FROM b GROUP BY conv_id, block), l AS (SELECT conv_id, min(m) AS least FROM m GROUP BY 1),
g AS (SELECT conv_id, avg(confidence) AS mean, stddev_pop(confidence) AS std, sum(words) AS words, sum(chars) AS chars, sum(rare) AS rare, sum(odd) AS odd, avg((confidence < 0.5)::INT) AS low, CASE WHEN max(declared) > 1 THEN max(declared) WHEN sum(seconds) > 1 THEN sum(seconds) ELSE 60 * greatest(0.5, greatest(1, sum(words)) / 160) END::DOUBLE AS seconds FROM b GROUP BY 1)
SELECT conv_id, round(mean, 6) AS confidence_mean, round(std, 6) AS confidence_std, round(least, 6) AS confidence_least_block, round(seconds, 6) AS seconds, round(words / (seconds / 60), 6) AS words_per_minute, round(chars / seconds, 6) AS chars_per_second,
round(rare / greatest(1, words), 6) AS rare_ratio, round(odd / greatest(1, words), 6) AS oov_ratio, round(least(1.0::DOUBLE, 0.5 * rare / greatest(1, words) + 0.5 * low), 6) AS error_proxy, round(low, 6) AS noise_proxy FROM g JOIN l USING (conv_id)"""


def speaker_cues(spark, d):
    """Speakers estimated from dashes and colons, intonation, and whether the declared language is the stop words' one."""
    df = spark.read.parquet(f"{d}/documents.parquet").withColumn("x", T.clean(F.col("text")))
    count = lambda s: (F.char_length("x") - F.char_length(F.replace("x", F.lit(s), F.lit("")))) / len(s)
    cues = count("— ") + count("- ") + count(": ")
    ends = F.greatest(F.lit(1), count(".") + count("?") + count("!"))
    words = F.transform(T.words(F.col("text")), F.lower)
    english = T.share(words, lambda x: x.isin(*[w for w in T.STOPWORDS if w.isascii()])) >= 0.1
    return df.select("doc_id", F.when(F.col("x") == "", 0).otherwise(F.least(F.lit(10.0), F.greatest(F.lit(1.0), F.rint(F.sqrt(cues))))).cast("long").alias("speakers"), r((count("!") + count("?")) / ends).alias("intonation"), F.when(F.col("lang").isNotNull(), english != (F.col("lang") == "en")).alias("mismatch"))


def _n(s: str) -> str:
    return f"((length(x) - length(replace(x, '{s}', ''))) / {len(s)})"


SPEAKER_CUES = rf"""WITH x AS (SELECT doc_id, lang, {SQL_CLEAN.format('text')} AS x FROM documents), w AS (SELECT *, list_transform(regexp_extract_all(x, '{SQL_WORD}'), lambda y: lower(y)) AS w FROM x)
SELECT doc_id, (CASE WHEN x = '' THEN 0 ELSE least(10, greatest(1, round_even(sqrt({_n(chr(0x2014) + ' ')} + {_n('- ')} + {_n(': ')}), 0))) END)::BIGINT AS speakers, round(({_n('!')} + {_n('?')}) / greatest(1, {_n('.')} + {_n('?')} + {_n('!')}), 6) AS intonation,
CASE WHEN lang IS NOT NULL THEN (len(list_filter(w, lambda y: y IN ({quoted(w for w in T.STOPWORDS if w.isascii())}))) / greatest(1, len(w)) >= 0.1) <> (lang = 'en') END AS mismatch FROM w"""


def captions(spark, d):
    """Captions (part names): trimmed form, readability, calls to action by likeness or as a part."""
    name = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("  Subscrib "), F.substring("p_name", 1, 2), F.lit("!"))).when(F.col("p_partkey") % 7 == 1, F.concat("p_name", F.lit(" - link in bio..."))).otherwise(F.col("p_name"))
    x = L.trimmed(name)
    return spark.read.parquet(f"{d}/part.parquet").withColumn("x", x).select("p_partkey", "x", r(L.caption_readability(F.col("x"))).alias("readability"), L.call_to_action(F.col("x")).alias("is_cta"))


_SIM = "CASE WHEN x = '{w}' THEN 1.0 WHEN x = '' THEN 0.0 ELSE 1 - levenshtein(x, '{w}') / greatest(length(x), {n}) END >= 0.75 OR contains(x, '{w}')"
CAPTIONS = rf"""WITH n AS (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN '  Subscrib ' || substring(p_name, 1, 2) || '!' WHEN 1 THEN p_name || ' - link in bio...' ELSE p_name END AS n FROM part),
x AS (SELECT p_partkey, regexp_replace(trim(lower(n), ' '), '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g') AS x FROM n), c AS (SELECT *, regexp_replace(x, ' +', ' ', 'g') AS y FROM x), m AS (SELECT *, len(string_split(y, ' ')) AS n_words, length(y) AS n, length(regexp_replace(y, '[\p{{L}}\p{{N}}_ ]', '', 'g')) AS marks FROM c)
SELECT p_partkey, x, round(CASE WHEN x = '' THEN 0 ELSE 1 / (1 + greatest(0, (n_words - 6) / 10)) / (1 + greatest(0, (n / n_words - 6) / 10)) / (1 + 5 * marks / n) END, 6) AS readability, x <> '' AND ({" OR ".join("(" + _SIM.format(w=w, n=len(w)) + ")" for w in L.CALLS)}) AS is_cta FROM m"""


def keys(spark, d):
    """Cache key, source id by precedence, run key and model signature: hashes of canonical forms."""
    df = titled(spark, d)
    t, x = T.clean(F.col("title")), T.clean(F.col("description"))
    return df.select("doc_id", F.sha2(F.concat(F.lit("model-a||"), t), 256).alias("cache_key"), F.substring(F.sha1(F.coalesce(F.nullif(t, F.lit("")), x)), 1, 12).alias("source_id"),
                     F.substring(F.sha2(F.concat_ws("␟", F.lit("v1"), F.col("doc_id").cast("string"), t), 256), 1, 16).alias("run_key"), L.signature(F.array(F.struct(F.lit("b").alias("name"), F.col("doc_id").cast("string").alias("version")), F.struct(F.lit("a").alias("name"), F.lit("1").alias("version")))).alias("signature"))


KEYS = rf"""WITH {TITLED}, c AS (SELECT doc_id, {SQL_CLEAN.format('title')} AS t, {SQL_CLEAN.format('description')} AS x FROM titled)
SELECT doc_id, sha256('model-a||' || t) AS cache_key, substring(sha1(coalesce(nullif(t, ''), x)), 1, 12) AS source_id, substring(sha256('v1' || '{chr(0x241f)}' || doc_id || '{chr(0x241f)}' || t), 1, 16) AS run_key,
substring(sha256('[{{"name":"a","version":"1"}},{{"name":"b","version":"' || doc_id || '"}}]'), 1, 16) AS signature FROM c"""


def privacy(spark, d):
    """Lengths and a content hash of a conversation's system, assistant and user texts; nothing else leaves."""
    t = F.substring(T.clean(F.col("text")), 1, 20_000)
    w = Window.partitionBy("conv_id", "part").orderBy("turn", "t")
    df = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", F.coalesce(F.when(F.col("role").isin("system", "assistant"), F.col("role")), F.lit("user")).alias("part"), t.alias("t"))
    df = df.filter("t <> ''").withColumn("i", F.row_number().over(w)).filter("i <= 2000")
    g = df.groupBy("conv_id", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "t"))), lambda s: s["t"]), " ").alias("t"), F.count("*").alias("n"))
    g = g.groupBy("conv_id").pivot("part", ["system", "assistant", "user"]).agg(F.max("t").alias("t"), F.max("n").alias("n"))
    part = lambda k: F.coalesce(f"{k}_t", F.lit(""))
    return g.select("conv_id", *(F.char_length(part(k)).cast("long").alias(f"{k}_chars") for k in ("system", "assistant", "user")), F.coalesce("user_n", F.lit(0)).alias("n_comments"), F.sha2(F.trim(F.regexp_replace(F.concat_ws("\n", part("system"), part("assistant"), part("user")), r"^\n+|\n+$", "")), 256).alias("content_hash"))


PRIVACY = rf"""WITH t AS (SELECT conv_id, turn, CASE WHEN role IN ('system', 'assistant') THEN role ELSE 'user' END AS part, substring({SQL_CLEAN.format('text')}, 1, 20000) AS t FROM conversations),
i AS (SELECT *, row_number() OVER (PARTITION BY conv_id, part ORDER BY turn, t) AS i FROM t WHERE t <> ''), g AS (SELECT conv_id, part, string_agg(t, ' ' ORDER BY i) AS t, count(*) AS n FROM i WHERE i <= 2000 GROUP BY 1, 2),
p AS (SELECT conv_id, coalesce(max(t) FILTER (part = 'system'), '') AS s, coalesce(max(t) FILTER (part = 'assistant'), '') AS a, coalesce(max(t) FILTER (part = 'user'), '') AS u, coalesce(max(n) FILTER (part = 'user'), 0) AS n FROM g GROUP BY 1)
SELECT conv_id, length(s) AS system_chars, length(a) AS assistant_chars, length(u) AS user_chars, n AS n_comments, sha256(trim(regexp_replace(s || chr(10) || a || chr(10) || u, '^\n+|\n+$', '', 'g'), ' ')) AS content_hash FROM p"""

_ALL = {
    "t14_titles": (titles, TITLES), "t2_best_transcript": (best_transcript, BEST_TRANSCRIPT), "t33_overlap_chunks": (overlap_chunks, OVERLAP_CHUNKS), "t34_questions": (questions, QUESTIONS), "t30_style_flags": (style_flags, STYLE_FLAGS),
    "t25_recognition": (recognition, RECOGNITION), "t29_speaker_cues": (speaker_cues, SPEAKER_CUES), "t37_captions": (captions, CAPTIONS), "t40_keys": (keys, KEYS), "p12_privacy": (privacy, PRIVACY),
}
QUERIES = {k: v[0] for k, v in _ALL.items()}
ORACLES = {k: v[1] for k, v in _ALL.items()}
