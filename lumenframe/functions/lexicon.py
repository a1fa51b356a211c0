"""Word lists, question and caption tests, transcripts and chunks, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes of a question, question words of a sentence, clickbait words, style cues, calls to action.
QUESTION_PREFIX = r"^(?i)(кто|что|где|когда|почему|зачем|как|who|what|where|when|why|how)([^\p{L}\p{N}_]|$)"
QUESTION = r"(^|[^\p{L}\p{N}_])(кто|что|где|когда|почему|зачем|как)([^\p{L}\p{N}_].*)?\?"
CLICKBAIT = ("шок", "срочно", "невероятно", "топ", "лучшие", "секрет", "удивит", "скандал", "честно", "разоблачение", "shocking", "urgent", "incredible", "top", "best", "secret", "you won't believe", "scandal", "honest", "exposed")
STYLE = {"instructional": ("нажмите", "сделайте", "кликните"), "audience": ("вы", "ты", "тебя", "вас"), "call_to_action": ("подпишитесь", "лайк", "комментарий")}
CALLS = ("subscribe", "follow", "like", "link in bio", "click", "watch", "подпишись", "подписаться", "ставь лайк", "ссылка в описании")
# Dates and times, positions in a recording, the blocks of emoji.
DATE_TIME = r"(^|[^\p{L}\p{N}_])([0-9]{1,2}[./-][0-9]{1,2}([./-][0-9]{2,4})?|[0-9]{1,2}:[0-9]{2})([^\p{L}\p{N}_]|$)"
TIMESTAMP = r"(^|[^\p{L}\p{N}_])([0-9]{1,2}:){1,2}[0-9]{2}([^\p{L}\p{N}_]|$)"
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]"


def question_prefix(title: Column) -> Column:
    return F.trim(title).rlike(QUESTION_PREFIX)


def clickbait(title: Column) -> Column:
    """A third for each listed word in the title, for an exclamation mark and for a question prefix, 1 at most."""
    low, hits = F.lower(title), F.lit(0)
    for w in CLICKBAIT:
        hits = hits + F.contains(low, F.lit(w)).cast("int")
    return F.least(F.lit(1.0), (hits + F.contains(title, F.lit("!")).cast("int") + question_prefix(title).cast("int")) / 3)


def diversity(items: Column) -> Column:
    return F.size(F.array_distinct(items)) / F.greatest(F.lit(1), F.size(items))


def best_transcript(transcripts: Column) -> Column:
    """whisper, else youtube_auto, else the first that is not empty; an empty string without any."""
    first = F.get(F.filter(F.map_values(transcripts), lambda x: x != ""), F.lit(0))
    return F.coalesce(*(F.nullif(F.element_at(transcripts, k), F.lit("")) for k in ("whisper", "youtube_auto")), first, F.lit(""))


def marked_sentences(clean: Column) -> Column:
    """Sentences of a text with single blanks, each with the mark that ends it."""
    return F.filter(F.split(clean, r"(?<=[.!?]) "), lambda s: s != "")


def overlap_chunks(sentences: Column, most: int, share: float) -> Column:
    """Arrays of words: sentences are added while a chunk has ``most`` words at most; the next one begins with the last
    ``most * share`` words of the one before. A longer sentence is a chunk of its own."""
    tail = int(most * share)

    def step(s, n):
        """A chunk is a stretch of the text's words: where the open one begins, where it ends, and those that are closed."""
        over = s["end"] - s["begin"] + n > most
        closed = F.array(F.struct(s["begin"].alias("begin"), s["end"].alias("end")))
        return F.struct(
            F.when(over & (s["end"] > s["begin"]), F.concat(s["done"], closed)).otherwise(s["done"]).alias("done"),
            F.when(over, F.greatest(s["begin"], s["end"] - tail)).otherwise(s["begin"]).alias("begin"),
            (s["end"] + n).alias("end"),
        )

    def finish(s):
        return F.when(s["end"] > s["begin"], F.concat(s["done"], F.array(F.struct(s["begin"].alias("begin"), s["end"].alias("end"))))).otherwise(s["done"])

    start = F.struct(F.array().cast("array<struct<begin:int,end:int>>").alias("done"), F.lit(0).alias("begin"), F.lit(0).alias("end"))
    def chunks(own):
        stretches = F.aggregate(F.transform(own, lambda x: F.size(F.split(x, " "))), start, step, finish)
        return F.flatten(F.transform(F.array(F.split(F.array_join(own, " "), " ")), lambda words: F.transform(stretches, lambda c: F.slice(words, c["begin"] + 1, c["end"] - c["begin"]))))

    # Within transform the sentences and the words are variables, so they are found once.
    return F.flatten(F.transform(F.array(sentences), chunks))


def is_rare(word: Column) -> Column:
    """Longer than 12, with a digit, or more than 0.4 of it neither letters, marks nor digits."""
    return (F.char_length(word) > 12) | word.rlike(r"\p{Nd}") | (F.char_length(F.regexp_replace(word, r"[\p{L}\p{M}\p{Nd}]", "")) / F.char_length(word) > 0.4)


def is_odd(word: Column) -> Column:
    """Fewer letters than half its length."""
    return F.char_length(F.regexp_replace(word, r"[^\p{L}\p{M}]", "")) < F.greatest(F.lit(1), F.floor(F.char_length(word) / 2))


def trimmed(c: Column) -> Column:
    """Lower case, without white space and marks at the ends."""
    return F.regexp_replace(F.trim(F.lower(F.coalesce(c, F.lit("")))), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def likeness(a: Column, b: str) -> Column:
    """1 - edit distance / greater length."""
    return F.when(a == b, 1.0).when(a == "", 0.0).otherwise(1 - F.levenshtein(a, F.lit(b)) / F.greatest(F.char_length(a), F.lit(len(b))))


def call_to_action(x: Column) -> Column:
    hit = F.lit(False)
    for w in CALLS:
        hit = hit | (likeness(x, w) >= 0.75) | F.contains(x, F.lit(w))
    return (x != "") & hit


def caption_readability(x: Column) -> Column:
    """1 for a short caption; less for more than 6 words, longer ones than 6 letters, and marks."""
    y = F.regexp_replace(x, " +", " ")
    n, length = F.size(F.split(y, " ")), F.char_length(y)
    marks = F.char_length(F.regexp_replace(y, r"[\p{L}\p{N}_ ]", ""))
    over = lambda v: 1 + F.greatest(F.lit(0.0), (v - 6) / 10)
    return F.when(x == "", 0.0).otherwise(1 / over(n) / over(length / n) / (1 + 5 * marks / length))


def signature(models: Column) -> Column:
    """The first 16 digits of the digest of a list's canonical form, whatever its order."""
    return F.substring(F.sha2(F.to_json(F.array_sort(models)), 256), 1, 16)
