"""Personal data: regular expressions propose spans, checksums confirm them, nearby context words adjust the score."""

from __future__ import annotations

import bisect
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# The base patterns, in the order of kinds. An email is found from its @, so that a run of letters is read once:
# LOCAL_PART are the characters before it, DOMAIN what must follow. An ip starts at the first digit of a number only, since a
# later digit of it would be followed by the same; possessive repeats keep what they took.
LOCAL_PART, DOMAIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-", re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# What the method adds: account numbers (mod 97), and numbers that a context word must support.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
# The characters of an account number, by country.
IBAN_SIZES = {c: n for n, own in {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in own.split()}
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
LOCAL = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "localphone")

#: Score of a kind before its context, what a context word within NEAR characters adds, and the least score of an added span.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "localphone": 0.3}
CONTEXT = {
    "email": re.compile(r"\b(e-?mail|contact|write to|courriel|correo)\b", re.I),
    "ip": re.compile(r"\b(ip|address|host|server|client)\b", re.I),
    "card": re.compile(r"\b(card|visa|mastercard|amex|credit|karte|tarjeta|carte)\b", re.I),
    "phone": re.compile(r"\b(tel|phone|call|mobile|fax|telefon|teléfono|téléphone)\b", re.I),
    "iban": re.compile(r"\b(iban|account|bank|konto|cuenta|compte)\b", re.I),
    "ssn": re.compile(r"\b(ssn|social security)\b", re.I),
    "localphone": re.compile(r"\b(tel|phone|call|mobile|fax|telefon|teléfono|téléphone)\b", re.I),
}
NEAR, BONUS, LEAST = 60, 0.3, 0.6


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(number: str) -> bool:
    turned = number[4:] + number[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def ibans(text: str):
    """Start and end of account numbers. The pattern may run on over words in capitals, so a match is tried at each of its
    words' ends, longest first: one of the country's size, or any size for a country not listed, whose checksum holds."""
    at = 0
    while m := IBAN.search(text, at):
        a, b = m.span()
        at = a + 1
        for e in range(b, a + 14, -1):
            if e < b and text[e] != " ":
                continue
            number = text[a:e].replace(" ", "")
            if len(number) == IBAN_SIZES.get(number[:2], max(15, len(number))) and mod97(number):
                yield a, e
                at = e
                break


def emails(text: str):
    """Start and end of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, leftmost and apart, in one pass."""
    at, sign = 0, text.find("@")
    while sign >= 0:
        start = at + len(text[at:sign].rstrip(LOCAL_PART))
        at = sign + 1
        if start < sign and (m := DOMAIN.match(text, at)):
            yield start, m.end()
            at = m.end()
        sign = text.find("@", at)


def clear_of(found: list[tuple[str, int, int]], spans):
    """Those of ``spans`` that overlap none of ``found``."""
    taken = sorted(x[1:] for x in found)
    starts, reach = [a for a, _ in taken], list(itertools.accumulate((b for _, b in taken), max))
    for x, y in spans:
        before = bisect.bisect_left(starts, y)
        if not before or reach[before - 1] <= x:
            yield x, y


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in code points, by start, then kind; base spans always, added ones from LEAST on."""
    found: list[tuple[str, int, int]] = []
    if "@" in text:
        found += [("email", *x) for x in emails(text)]
    if any(map(text.__contains__, "0123456789")):
        if "." in text:
            found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if 14 <= m.end() - m.start() and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
        base = list(found)
        for kind, own in (("iban", ibans(text)), ("ssn", (m.span() for m in SSN.finditer(text))), ("localphone", (m.span() for m in LOCAL.finditer(text)))):
            found += [(kind, *x) for x in clear_of(base, own)]
    out = []
    for kind, a, b in sorted(found, key=lambda x: (x[1], KINDS.index(x[0]))):
        near = CONTEXT[kind].search(text, max(0, a - NEAR), a) or CONTEXT[kind].search(text, b, b + NEAR)
        score = min(1.0, SCORES[kind] + BONUS * bool(near))
        if kind in KINDS[:4] or score >= LEAST:
            out.append((kind, a, b, score))
    return out


def joined(found: list[tuple]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in found)


def masked(text: str, found: list[tuple]) -> str:
    """The text with each span, or run of overlapping ones, as <KIND> of its first."""
    out, at = [], 0
    for kind, a, b, *_ in found:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and entities (kind, start, end, score) of every whole text.

    A null or empty text has none; rows that repeat have equal results; only the two named columns are read. The time for a
    text is in proportion to its length, whatever it holds.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return common.mapped(docs, "doc_id long, entities array<struct<kind:string,start:bigint,end:bigint,score:double>>", lambda batch: {"doc_id": batch["doc_id"], "entities": pa.array([[dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in spans(t)] for t in common.texts(batch["text"])], kind)})


def mask_personal_data(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents with their spans masked, all columns; n_chars, where there is one, follows the new text. Null stays null.

    Of spans that overlap the first gives its name to the whole run; an empty text stays empty, repeated rows are masked alike.
    """

    def run(batches):
        for batch in batches:
            new = [None if t is None else masked(t, spans(t)) for t in batch[text].to_pylist()]
            yield batch.set_column(batch.schema.get_field_index(text), batch.schema.field(text), pa.array(new, batch.schema.field(text).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn(n_chars, F.when(F.col(n_chars).isNotNull(), F.char_length(text).cast(docs.schema[n_chars].dataType))) if n_chars in docs.columns else out


def result(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text, of each document's entities."""
    base = F.filter("entities", lambda e: e["kind"].isin(*KINDS[:4]))
    line = lambda c: F.array_join(F.transform(c, lambda e: F.concat_ws(":", e["kind"], e["start"].cast("string"), e["end"].cast("string"))), ",")
    n = lambda k: F.size(F.filter("entities", lambda e: e["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(n, KINDS[:4]), F.sha2(line(base), 256).alias("base_sha256"), line(F.col("entities")).alias("spans"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result(find_personal_data(common.table(spark, sf_dir, "documents")))
