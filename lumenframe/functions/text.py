"""Text functions as column expressions. Word and mark classes are spelled out, so every engine reads them alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"
# Stop words (English and Russian), fillers, lengths from which a word is rare.
STOPWORDS = ("и", "в", "во", "не", "что", "он", "на", "я", "с", "со", "как", "а", "то", "все", "она", "так", "его", "но", "да", "ты", "к", "у", "the", "a", "an", "and", "or", "but", "if", "in", "on", "with", "for", "to", "of", "is", "are", "was", "were", "be", "been", "it")
FILLERS = ("ээ", "мм", "ну", "типа", "короче", "значит", "э", "эээ", "mmm", "uh", "um")
RARE_LENGTH = 12


def clean(c: Column) -> Column:
    """White space runs as one blank, none at the ends; null as empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"[ \t\n\r\f\x0b]+", " "))


def words(c: Column) -> Column:
    return F.regexp_extract_all(clean(c), F.lit(WORD), F.lit(0))


def sentences(c: Column) -> Column:
    """Parts between runs of sentence marks that white space follows; the marks go."""
    return F.filter(F.split(clean(c), r"[.!?]+ +"), lambda x: x != "")


def ratio(part: Column, whole: Column) -> Column:
    return part / F.greatest(F.lit(1), whole)


def occurrences(c: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(0)))


def marks(c: Column) -> Column:
    """How many punctuation marks and symbols."""
    return F.char_length(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{P}\p{S}]+", ""))


def share(tokens: Column, test) -> Column:
    return ratio(F.size(F.filter(tokens, test)), F.size(tokens))


def content_hash(c: Column) -> Column:
    return F.sha2(clean(c), 256)
