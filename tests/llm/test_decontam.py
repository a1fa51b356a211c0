"""Decontamination held against a version by plain loops, and what is no contamination."""

from __future__ import annotations

import random

import pytest

from lumenframe.llm import decontam as D


def tokens(text):
    """(lower-case word, kind, marks before, stands alone) of each token, as stated."""
    found, out, end = list(D.TOKEN.finditer(text or "")), [], 0
    stop = [m[0] in ".!?\n" for m in found]
    for k, m in enumerate(found):
        if stop[k]:
            continue
        w, low = m[0], m[0].lower()
        begins, ends = k == 0 or stop[k - 1], k + 1 == len(found) or stop[k + 1]
        kind = 0
        if w[0].isdigit() or low in D.NUMBERS:
            kind = 1
        elif low in D.UNITS or not w[0].isalpha():
            kind = 2
        elif len(w) > 1 and w[0].isupper() and w[1:].islower() and not begins:
            kind = 3
        out.append((low, kind, "".join(text[end : m.start()].split()) if end else "", begins and ends))
        end = m.end()
    return out


def window(own, at, length, form):
    """What is compared, and the slots' contents; None where there is no such window."""
    part = own[at : at + length]
    if len(part) < length or (form == "template" and sum(k == 0 for _, k, *_ in part) < D.LITERALS) or (form == "marked" and length == 1 and not part[0][3]):
        return None
    if form == "template":
        return tuple(D.KINDS[k] or w for w, k, *_ in part), [(D.KINDS[k] + w) if k else "" for w, k, *_ in part]
    return tuple((w, m if form == "marked" and i else "") for i, (w, _, m, _) in enumerate(part)), None


def brute(docs, items):
    """{(document, item): reparameterised} of all leaks, occurrence by occurrence."""
    cut = {}
    for i, text in items.items():
        own = tokens(text)
        bare = len(own) < D.RUN and sum(k == 0 for _, k, *_ in own) < D.LITERALS
        raw = int(D.raw_lengths(D.np.array([len(own)]))[0])
        for form, length in (("template", min(len(own), D.WINDOW)), ("marked" if bare else "raw", raw)):
            if length:
                cut[i, form] = length, {at: w for at in range(len(own)) if (w := window(own, at, length, form))}, len(own), " ".join(w for w, *_ in own)
    texts = {}
    for (_, form), (_, windows, _, words) in cut.items():
        for w, _ in windows.values():
            texts.setdefault((form, w), set()).add(words)
    leaks = {}
    for d, text in docs.items():
        told = tokens(text)
        for (i, form), (length, windows, size, _) in cut.items():
            if not windows:
                continue
            of_doc = {}
            for at in range(len(told)):
                if w := window(told, at, length, form):
                    of_doc.setdefault(w[0], []).append((at, w[1]))
            mine = {at for at, w in windows.items() if len(texts[form, w[0]]) == 1} or set(windows)
            met = [(x, y, s, t) for y, (w, t) in windows.items() for x, s in of_doc.get(w, [])]
            occurrences = {}
            for x, y, s, t in met:
                shift = x - y
                places = [("exact", shift), ("a", shift // D.BAND), ("b", (shift + D.BAND // 2) // D.BAND)] + ([("all", 0)] if form == "template" or length == D.WINDOW else [])
                for key in places:
                    occurrences.setdefault(key, []).append((y, s, t))
            best = None
            for (way, _), rows in occurrences.items():
                ats = sorted({y for y, *_ in rows})
                longest, start = 0, ats[0]
                for k, at in enumerate(ats):
                    if k and at - ats[k - 1] > length:
                        start = at
                    longest = max(longest, at - start + length)
                run = way == "exact" and longest >= min(D.RUN, size)
                pairs = {(a, b) for _, s, t in rows if t for a, b in zip(t, s, strict=True) if a and b}
                one, back = {}, {}
                for a, b in pairs:
                    one.setdefault(a, set()).add(b)
                    back.setdefault(b, set()).add(a)
                each = [len(v) == 1 for v in [*one.values(), *back.values()]]
                consistent = sum(each) / len(each) if each else 1.0
                share, own = len(ats) / len(windows), bool(set(ats) & mine)
                passes = consistent >= D.CONSISTENT
                order = (passes, passes and own and (share >= D.COVER or run), share, not any(a != b for a, b in pairs), consistent, len(ats), run, own)
                best = max(best, order) if best else order
            if best:
                leaks.setdefault((d, i), []).append(best)
    return {k: not max(v)[3] for k, v in leaks.items() if max(v)[1]}


def check(spark, docs, items, **options):
    pair = lambda x, name: spark.createDataFrame(list(x.items()), f"{name} long, text string")
    rows = D.leaks(D.matches(pair(docs, "doc_id"), pair(items, "item_id"), **options)).collect()
    got = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in rows}
    assert got == brute(docs, items)
    return got


QUESTION = "On {0} {1} bought {2} apples for {3} cents each at the market near {4} and gave {5} of them to {1} the baker, who paid {6} dollars back"


def questions(rng, n):
    names = ["Anna", "Peter", "Maria", "Johann", "Olga", "Viktor", "Marta"]
    return [QUESTION.format("Monday", rng.choice(names), rng.randint(2, 99), rng.randint(2, 99), rng.choice(names), rng.randint(2, 99), rng.randint(2, 9)) for _ in range(n)]


@pytest.mark.parametrize("filter_max", [D.FILTER_MAX, 0])
def test_against_plain_loops(spark, sf, filter_max):
    """Documents and items of the small table, with re-parameterised, edited, mixed, shuffled and short ones added."""
    rng = random.Random(5)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").filter("n_chars < 2500").orderBy("doc_id").limit(50).collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    made = questions(rng, 12)
    items |= {900: made[0], 901: made[1].replace("apples", "pears").replace("market", "fair"), 902: "12 + 7 = ?", 903: "Paris", 904: "Name the largest ocean.", 905: "3, 5, 8, 13, 21", 906: None, 907: ""}
    for k, text in enumerate([*made, " ".join(made[:3]), made[0].lower(), made[2].replace("cents", "pence"), *("see 12 + 7 = ? or 12, 7", "Paris", "in Paris", "Name the largest ocean", "3, 5, 8, 13, 21, 34", "3 5 8 13 21", None, "")]):
        docs[5000 + k] = text
    for k in range(25):
        words = rng.choice([x for x in items.values() if x]).split()
        at, size = rng.randrange(len(words)), rng.randrange(1, 25)
        part = words[at : at + size]
        if rng.random() < 0.5 and part:
            part[rng.randrange(len(part))] = rng.choice(["7", "Rome", "changed", ""])
        docs[6000 + k] = "Some words first. " + " ".join([*part, *words[:at]])
    got = check(spark, docs, items, filter_max=filter_max)
    assert len(got) > 20 and any(got.values()) and not all(got.values())


def test_chance_matches_are_clean(spark):
    """Lists that hold a sum's numbers, a word that is an item, and an instruction that items share are no contamination."""
    instruction = "Read the passage below with care and then choose the one answer that fits best from the list:"
    items = {1: "12 + 7 = ?", 2: "Paris", 3: f"{instruction} why did the old river turn to the north beyond the hills", 4: f"{instruction} how many ships left the harbour before the storm came in", 5: f"{instruction} how many ships left the harbour before the storm came in"}
    clean = {1: "See tables 12, 7 and others.", 2: "They went to Paris in spring and to Rome after that.", 3: f"{instruction} what colour has the roof of the house beside the church", 4: f"Tests begin like this. {instruction}"}
    bad = {11: "What is 12 + 7 = ? Tell me.", 12: "The answer:\nParis\nis right.", 13: items[3], 14: items[4]}
    got = check(spark, clean | bad, items)
    assert {d for d, _ in got} == set(bad) and {i for d, i in got if d == 14} == {4, 5}
