"""Benchmark decontamination on templates: numbers, names and units become typed placeholders, windows of the templates are
hash-joined, and the placeholders' contents must correspond one to one for a match to count. Windows of the unreplaced tokens
find copies whatever their case and line breaks, and edited ones.

Short items with few words, such as a sum, must have the marks between their tokens too; an item of one token must be a whole
line or sentence. What several different items share, such as an instruction, tells nothing by itself: a match needs a window
that no other item has, if the item has one."""

from __future__ import annotations

from array import array

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Tokens of a window, literal ones it must have, share of an item's windows that makes a document contaminated.
WINDOW, LITERALS, COVER = 10, 5, 0.4
#: Share of slot contents that must correspond, and by how many tokens parts of one occurrence may be shifted.
CONSISTENT, BAND = 0.8, 8
#: Tokens in a row that make a document contaminated whatever their share of the item, or the whole item if it is shorter.
RUN = 13
#: Benchmark windows up to which their hashes are sent to the tasks, and the joined side is broadcast (16 MB).
FILTER_MAX = 1_000_000

TOKEN = regex.compile(r"[\p{L}\p{M}]+(?:['’][\p{L}]+)*|\p{Sc}|%|\d+(?:[.,]\d+)*|[.!?\n]")
# Words that stand for numbers, and units of measure.
NUMBERS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen".split())
UNITS = frozenset("km cm mm kg mg lb lbs oz ml mph kmh hour hours minute minutes second seconds day days week weeks month months year years dollar dollars euro euros cent cents percent meter meters metre metres mile miles inch inches foot feet yard yards liter liters litre litres gram grams kilogram kilograms kilometer kilometers kilometre kilometres pound pounds ounce ounces".split())
STEP = np.random.default_rng(17).integers(1, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Kinds of tokens; a name is one only inside a sentence. Windows of templates and of unreplaced tokens start from other seeds.
KINDS = ("", "<number>", "<unit>", "<name>")
BREAK = len(KINDS)
KIND_HASH = np.array([0, *map(xxhash.xxh3_64_intdigest, KINDS[1:])], np.uint64)
TEMPLATE, RAW, MARKED = range(3)
SEEDS = (np.uint64(0), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03))
#: Written forms that a Python worker keeps.
KEPT = 300_000


class Words(dict):
    """A number for each token as written; its lower-case form, hash and kind are at that place of three vectors."""

    def __init__(self):
        self.start()

    def start(self):
        self.clear()
        self.low, self.hash, self.kind = [], array("Q"), array("b")

    def __missing__(self, t: str) -> int:
        low, kind = t.lower(), 0
        if t in ".!?\n":
            kind = BREAK
        elif t[0].isdigit() or low in NUMBERS:
            kind = 1
        elif low in UNITS or not t[0].isalpha():
            kind = 2
        elif len(t) > 1 and t[0].isupper() and t[1:].islower():
            kind = 3
        self[t] = n = len(self.low)
        self.low.append(low)
        self.hash.append(xxhash.xxh3_64_intdigest(low))
        self.kind.append(kind)
        return n


WORDS = Words()


class Tokens:
    """The tokens of a batch of texts in one row: words (numbers), kinds, owners (texts), places in them, tokens of each text.

    A name is a capitalised word that neither begins a sentence or line nor is all capitals; literals are lower-cased. With
    ``marked``, the marks before each token (since the one before it) are known too.
    """

    def __init__(self, texts: list[str], marked: bool = False):
        if len(WORDS) > KEPT:
            WORDS.start()
        parts = [np.fromiter(map(WORDS.__getitem__, TOKEN.findall(t)), np.int64) for t in texts]
        words, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), list(map(len, parts)))
        kinds = np.array(WORDS.kind, np.int8)[words]
        stop = kinds == BREAK
        begins = np.ones(len(words), bool)
        begins[1:] = stop[:-1] | (owner[1:] != owner[:-1])
        kinds[(kinds == 3) & begins] = 0
        ends = np.ones(len(words), bool)
        ends[:-1] = stop[1:] | (owner[1:] != owner[:-1])
        self.alone = (begins & ends)[~stop]
        self.marks = marks_before(texts) if marked else None
        self.words, self.kinds, self.owner = words[~stop], kinds[~stop], owner[~stop]
        self.sizes = np.bincount(self.owner, minlength=len(parts))
        self.at = np.arange(len(self.words)) - (np.cumsum(self.sizes) - self.sizes)[self.owner]
        self.literals = np.concatenate([[0], np.cumsum(self.kinds == 0)])

    def windows(self, form: int, lengths: set[int]):
        """Length, places (in the batch's row) and hashes of all windows; of templates those with enough literals only, and of one
        marked token those that are a whole line or sentence."""
        n = len(self.words)
        h = np.array(WORDS.hash, np.uint64)[self.words]
        if form == TEMPLATE:
            h = np.where(self.kinds > 0, KIND_HASH[self.kinds], h)
        left, out = self.sizes[self.owner] - self.at, np.full(n, SEEDS[form])
        for i in range(min(n, max(lengths, default=0))):
            state = out[: n - i]
            state ^= h[i:] ^ self.marks[i:] if form == MARKED and i else h[i:]
            state *= STEP[i]
            state ^= state >> np.uint64(31)
            if i + 1 in lengths:
                good = left[: n - i] > i
                if form == TEMPLATE:
                    good &= self.literals[i + 1 :] - self.literals[: n - i] >= LITERALS
                elif form == MARKED and not i:
                    good &= self.alone
                at = np.flatnonzero(good)
                yield i + 1, at, state[at].view(np.int64)

    def digests(self) -> list[int]:
        """A hash of each text's words in lower case."""
        return [xxhash.xxh3_64_intdigest(" ".join(WORDS.low[w] for w in own)) >> 1 for own in np.split(self.words, np.cumsum(self.sizes)[:-1])]

    def slots(self, at: int, length: int) -> list[str] | None:
        own = self.kinds[at : at + length]
        return [KINDS[k] + WORDS.low[w] if k else "" for k, w in zip(own, self.words[at : at + length], strict=True)] if own.any() else None


def marks_before(texts: list[str]) -> np.ndarray:
    """A hash of the marks between each token and the one before it in its text, without white space; 0 for none."""
    out = []
    for text in texts:
        end = 0
        for m in TOKEN.finditer(text):
            if m[0] not in ".!?\n":
                gap = "".join(text[end : m.start()].split()) if end else ""
                out.append(xxhash.xxh3_64_intdigest(gap) if gap else 0)
                end = m.end()
    return np.array(out, np.uint64)


def raw_lengths(sizes: np.ndarray) -> np.ndarray:
    """Length of the windows of unreplaced tokens of items. From RUN tokens on it is the greatest at which one changed word
    in the middle leaves COVER of the windows, WINDOW at most; shorter items have WINDOW tokens, or all."""
    fit = np.floor((1 - COVER) * (sizes + 1) / (2 - COVER) + 1e-9).astype(np.int64)
    return np.minimum(sizes, np.where(sizes < RUN, WINDOW, np.clip(fit, 1, WINDOW)))


def item_windows(own: Tokens):
    """Windows of items (form, length, places, hashes): WINDOW tokens of the template with enough literals, or the whole item
    if it is shorter, and windows of the unreplaced tokens, in lower case, so that each item with a token has a window. Of
    items with fewer than RUN tokens and LITERALS words these are marked."""
    words = np.bincount(own.owner, own.kinds == 0, minlength=len(own.sizes))
    bare = (own.sizes < RUN) & (words < LITERALS)
    raw = raw_lengths(own.sizes)
    for form, mine in ((TEMPLATE, np.minimum(own.sizes, WINDOW)), (RAW, np.where(bare, 0, raw)), (MARKED, np.where(bare, raw, 0))):
        for length, at, h in own.windows(form, set(range(1, WINDOW + 1))):
            hit = mine[own.owner[at]] == length
            yield form, length, at[hit], h[hit]


def met_only(h: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the hashes that are in a sorted vector; a table of low bits leaves few to search."""
    if not len(wanted):
        return np.zeros(0, np.int64)
    mask = (1 << min(24, 6 + int(len(wanted)).bit_length())) - 1
    table = np.zeros(mask + 1, bool)
    table[wanted & mask] = True
    at = np.flatnonzero(table[h & mask])
    return at[wanted[np.minimum(np.searchsorted(wanted, h[at]), len(wanted) - 1)] == h[at]]


WINDOWS = "id long, at int, form int, length int, size int, hash long, text long, slots array<string>"


def window_table(rows: DataFrame, asked: set[tuple[int, int]] | None = None, wanted=None) -> DataFrame:
    """Windows of each row (id, text), with their slots' contents where they have any.

    ``asked``: forms and lengths of a document's windows; without it rows are items, and ``text`` is a hash of the item's words. ``wanted``: a broadcast sorted vector of
    the only hashes asked for.
    """

    def work(batch):
        own, ids = Tokens(common.texts(batch["text"]), asked is None or any(form == MARKED for form, _ in asked)), batch["id"].to_pylist()
        out = {k: [] for k in ("id", "at", "form", "length", "size", "hash", "text", "slots")}
        found = item_windows(own) if asked is None else ((form, *x) for form in range(len(SEEDS)) for x in own.windows(form, {n for f, n in asked if f == form}))
        told = own.digests() if asked is None else [0] * len(ids)
        for form, length, at, h in found:
            if wanted is not None:
                hit = met_only(h, wanted.value)
                at, h = at[hit], h[hit]
            out["id"] += [ids[k] for k in own.owner[at].tolist()]
            out["at"] += own.at[at].tolist()
            out["form"] += [form] * len(at)
            out["length"] += [length] * len(at)
            out["size"] += own.sizes[own.owner[at]].tolist()
            out["hash"] += h.tolist()
            out["text"] += [told[k] for k in own.owner[at].tolist()]
            out["slots"] += [None if form != TEMPLATE else own.slots(a, length) for a in at.tolist()]
        return out

    return common.mapped(rows, WINDOWS, work)


def matches(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text", filter_max: int = FILTER_MAX) -> DataFrame:
    """doc_id, item_id, n_windows (distinct windows of the item found), of_item (its share), consistent (share of slot
    contents of the item that stand for one content throughout the occurrence, and the reverse), reparameterised, run
    (whether RUN tokens of the item, or all of a shorter one, stand in a row), own (whether a window found is in no item of
    other words, or the item has none such).

    An occurrence is what matches at one shift between document and item, or at shifts within a band of BAND (bands
    overlap by half); the whole document counts as one too, for an item dealt over it. The row is of the best one.

    Hashes of a benchmark of up to ``filter_max`` windows go to the tasks, so that only windows that meet one leave a document;
    a larger one is joined by shuffle on the hash. Documents have windows of all lengths that items' windows have.
    """
    bench = common.stored(window_table(benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).dropDuplicates()), "benchmark")
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    several = bench.groupBy("hash").agg((F.min("text") != F.max("text")).alias("several")).filter("several")
    marked = bench.join(several, "hash", "left").withColumn("several", F.coalesce("several", F.lit(False)))
    common_only = marked.groupBy("id", "form").agg(F.min("several").alias("all_several"))
    bench = common.stored(marked.join(common_only, ["id", "form"]).withColumn("own", ~F.col("several") | F.col("all_several")).drop("several", "all_several"), "benchmark_own")
    asked = {(r["form"], r["length"]) for r in bench.select("form", "length").distinct().collect()}  # 3 * WINDOW at most
    wanted, small = None, bench.count() <= filter_max
    if small:
        got = bench.select("hash").distinct().toArrow()["hash"].to_numpy()
        wanted = docs.sparkSession.sparkContext.broadcast(np.sort(got))
    own = common.stored(window_table(docs, asked, wanted), "windows").select(F.col("id").alias("doc_id"), F.col("at").alias("doc_at"), "hash", F.col("slots").alias("doc_slots"))
    items = bench.select(F.col("id").alias("item_id"), F.col("at").alias("item_at"), "form", "length", "size", "hash", "own", F.col("slots").alias("item_slots"))
    met = own.join(F.broadcast(items) if small else items, "hash")
    shift = F.col("doc_at") - F.col("item_at")
    ways = [shift, F.floor(shift / BAND), F.floor((shift + BAND // 2) / BAND), F.when((F.col("form") == TEMPLATE) | (F.col("length") == WINDOW), 0)]
    met = met.withColumn("o", F.explode(F.array(*(F.struct(F.lit(k).alias("way"), x.cast("long").alias("place")) for k, x in enumerate(ways))))).select("*", "o.way", "o.place").drop("o").filter("place is not null")
    key = ["doc_id", "item_id", "form", "way", "place"]
    places = met.groupBy(key).agg(F.array_sort(F.collect_set("item_at")).alias("ats"), F.min("length").alias("length"), F.max("size").alias("size"), F.max("own").alias("own"))
    # Windows at one shift that overlap or adjoin make a row of tokens: (its start, the last place, the longest row so far).
    step = lambda s, x: F.struct(F.when(x - s["last"] <= F.col("length"), s["start"]).otherwise(x).alias("start"), x.alias("last"), F.greatest(s["longest"], x - F.when(x - s["last"] <= F.col("length"), s["start"]).otherwise(x) + F.col("length")).alias("longest"))
    first = F.struct(F.col("ats")[0].alias("start"), F.col("ats")[0].alias("last"), F.lit(0).alias("longest"))
    found = places.select(*key, "own", F.size("ats").alias("n_windows"), ((F.col("way") == 0) & (F.aggregate("ats", first, step)["longest"] >= F.least(F.lit(RUN), "size"))).alias("run"))
    slots = met.filter("item_slots is not null and doc_slots is not null").select(*key, F.explode(F.arrays_zip(F.col("item_slots").alias("x"), F.col("doc_slots").alias("y"))).alias("z")).select(*key, "z.x", "z.y").filter("x <> '' and y <> ''").distinct()
    one = slots.groupBy(*key, "x").agg((F.count("*") == 1).cast("double").alias("ok"), F.max(F.col("x") != F.col("y")).alias("other"))
    back = slots.groupBy(*key, "y").agg((F.count("*") == 1).cast("double").alias("ok"), F.lit(False).alias("other"))
    checked = one.drop("x").union(back.drop("y")).groupBy(key).agg(F.avg("ok").alias("consistent"), F.max("other").alias("reparameterised"))
    total = bench.groupBy(F.col("id").alias("item_id"), "form").agg(F.countDistinct("at").alias("total"))
    out = found.join(checked, key, "left").join(F.broadcast(total) if small else total, ["item_id", "form"])
    consistent, other = F.coalesce("consistent", F.lit(1.0)), F.coalesce("reparameterised", F.lit(False))
    order = F.struct((consistent >= CONSISTENT).alias("passes"), ((consistent >= CONSISTENT) & F.col("own") & ((F.col("n_windows") / F.col("total") >= COVER) | F.col("run"))).alias("leaks"), (F.col("n_windows") / F.col("total")).alias("of_item"), (~other).alias("same"), consistent.alias("consistent"), "n_windows", "run", "own")
    best = out.groupBy("doc_id", "item_id").agg(F.max(order).alias("b"))
    return best.select("doc_id", "item_id", "b.n_windows", "b.of_item", "b.consistent", "b.run", "b.own", (~F.col("b.same")).alias("reparameterised"))


def leaks(found: DataFrame, cover: float = COVER) -> DataFrame:
    """The matches that make a document contaminated: enough of the item, or of its tokens in a row, in one occurrence with
    mostly consistent slots, and some of it the item's own."""
    return found.filter(F.col("own") & ((F.col("of_item") >= cover) | F.col("run")) & (F.col("consistent") >= CONSISTENT))


def contamination(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", doc_id: str = "doc_id", filter_max: int = FILTER_MAX) -> DataFrame:
    """doc_id, contaminated, n_items, n_windows, reparameterised and item_ids (sorted) of every document.

    Null and empty texts, and all documents beside an empty benchmark, are clean; equal texts get equal verdicts, a null id
    is never contaminated; columns other than those named are not read.
    """
    bad = leaks(matches(docs, benchmark, text=text, doc_id=doc_id, filter_max=filter_max)).groupBy("doc_id").agg(F.count("*").alias("n_items"), F.sum("n_windows").alias("n_windows"), F.max("reparameterised").alias("reparameterised"), F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    out = docs.select(F.col(doc_id).cast("long").alias("doc_id")).join(bad, "doc_id", "left")
    return out.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"), F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"), F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
