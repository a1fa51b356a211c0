"""The training-data operators against brute force, round trips, SQL and held-out rows, and on edge rows."""

from __future__ import annotations

import collections
import hashlib
import zlib

import numpy as np
import pytest
from compare import oracle, same
from pyspark.sql import functions as F

from lumenframe.llm import common, decontam, langid, licences, neardup, packing, pii, quality, queries, rules, tokens, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, term int"
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty " * 2


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns whose names clash with results."""
    rows = [(1, None, "en", None, None, "x", 1), (2, "", None, "s", 0, "x", 1), (3, " \t\n", "en", "s", 3, None, None), (4, BASE, "en", "s", 1, "x", 1), (4, BASE, "en", "s", 1, "x", 1), (5, BASE.upper(), "en", "s", 1, "x", 1), (6, BASE + "extra", "en", "s", 1, "x", 1), (7, "word " * 60_000, "en", "s", 1, "x", 1), (None, "no id " * 30, "en", "s", 1, "x", 1), (8, "naïve Ünïcode Σίσυφος ‘quotes’ 東京 <|endoftext|> é", "en", "s", 1, "x", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")


def docs_of(spark, sf):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def reference_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = reference_ids.__dict__.setdefault("t", Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY)))
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, tokens.END], "<u4")


def test_token_files_round_trip(spark, sf):
    got = {r["doc_id"]: r for r in tokens.op1(spark, sf).collect()}
    start = 0
    for i, text in sorted(docs_of(spark, sf).items()):
        ids = reference_ids(text)
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_edge_rows(spark, edge, empty, encoding):
    path = tokens.write_tokens(edge, common.shared_dir(spark, "t"), encoding=encoding)
    got = tokens.read_tokens(spark, path, ids=[8, 4], columns=["doc_id", "tokens"]).collect()
    assert sorted(r["doc_id"] for r in got) == [4, 4, 8]
    assert [r["tokens"] for r in got if r["doc_id"] == 8] == [reference_ids(edge.filter("doc_id = 8").first()["text"]).tolist()]
    assert tokens.token_index(spark, path).count() == edge.count()
    assert tokens.token_index(spark, tokens.write_tokens(empty, common.shared_dir(spark, "t"))).count() == 0


def check_pieces(rows, texts):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in texts.items():
        ids, at = reference_ids(text), 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.WINDOW
    return sum(sum(r["length"] for r in own) < packing.WINDOW for own in by_sequence.values())


def test_packing(spark, sf, edge, empty):
    assert check_pieces(packing.op2(spark, sf).collect(), docs_of(spark, sf)) <= 2
    unique = edge.filter("doc_id is not null and doc_id <> 4")
    check_pieces(packing.pack(unique).collect(), {r["doc_id"]: r["text"] for r in unique.collect()})
    assert packing.pack(edge).agg(F.sum("length")).first()[0] == sum(len(reference_ids(r["text"])) for r in edge.collect())
    assert packing.pack(empty).count() == 0


def frequencies(ids):
    df = np.zeros(tokens.N_IDS, np.int64)
    for x in ids:
        df[np.unique(x)] += 1
    return df, len(ids), float(np.mean([len(x) for x in ids]))


def test_packing_takes_lexical_neighbours():
    ids = [np.array([10 * k + j for j in range(5)] * 8, np.uint32) for k in (100, 200, 100, 300, 200)]
    order = [k for k, *_ in packing.fill(ids, *frequencies(ids))[0]]
    assert order.index(2) == 1


def brute_bm25(query, ids, df, n, mean):
    """BM25 of each text for all distinct ids of a query, as it is stated."""
    out = []
    for x in ids:
        total, held = 0.0, collections.Counter(x.tolist())
        for t in set(query.tolist()):
            c = held[t]
            total += np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * (packing.K1 + 1) / (c + packing.K1 * (1 - packing.B + packing.B * len(x) / mean))
        out.append(total)
    return np.array(out)


def test_packing_against_brute_force(spark, sf):
    """Every shard's scores, hence its neighbours, are those of BM25 with all ids of the seed; each window is the greedy fill."""
    ids = [reference_ids(t)[: packing.WINDOW] for _, t in sorted(docs_of(spark, sf).items())][:120]
    df, n, mean = frequencies(ids)
    index = packing.Index(ids, df, n, mean)
    want = [brute_bm25(q, ids, df, n, mean) for q in ids]
    for k in range(len(ids)):
        assert np.allclose(index.scores(k), want[k], rtol=1e-4, atol=1e-4)
    left = np.array([len(x) for x in ids])
    for row in packing.fill(ids, df, n, mean):
        seed = row[0][0]
        free = [k for k in np.argsort(-index.scores(seed), kind="stable") if k != seed and left[k] > 0 and index.scores(seed)[k] > 0]
        assert [k for k, *_ in row[1 : 1 + len(free)]] == free[: len(row) - 1]
        for k, _, size in row:
            left[k] -= size
    assert not left.any()


def test_packing_does_not_depend_on_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    key = lambda rows: sorted((r["doc_id"], r["start"], r["length"], r["offset"]) for r in rows)
    one = packing.pack(docs.coalesce(1)).collect()
    assert key(one) == key(packing.pack(docs.repartition(7)).collect())
    many = docs.select(F.lit(7).alias("doc_id"), F.lit("the same words in each row " * 9).alias("text")).union(docs.select(F.lit(7), F.lit("the same words in each row " * 9))).limit(350)
    assert packing.pack(many.union(many)).agg(F.countDistinct("sequence_id", "offset"), F.count("*")).first()[0] >= 700


def test_quality_held_out(spark, sf, labels, edge, empty):
    got = quality.op3(spark, sf).join(labels, "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.9
    out = quality.neighbour_quality(edge, labels.limit(0)).collect()
    assert len(out) == edge.count() and all(0 <= r["score"] <= 1 for r in out)
    assert quality.neighbour_quality(empty, labels).count() == 0


def brute_rules(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, covered = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {i + j for i in at for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_rules(spark, sf, labels, edge, empty):
    got = rules.op4(spark, sf).toPandas()
    texts = docs_of(spark, sf)
    for r in got.itertuples():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_rules(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    m = got.merge(labels.toPandas(), on="doc_id")
    assert m[(m.quality == 1) & ~m.base_failed].kept.mean() > 0.98 and m[m.quality == 0].kept.mean() < 0.1
    out = rules.rule_verdicts(edge, labels).toPandas()
    assert len(out) == edge.count() and not out[out.doc_id.isin([1, 2, 3])].kept.any()
    assert rules.rule_verdicts(empty, labels).count() == 0
    kept = set(got[got.kept].doc_id)
    assert {r["doc_id"] for r in rules.passing(spark.read.parquet(f"{sf}/documents.parquet"), labels).collect()} == kept


def test_warc(spark, sf, tmp_path):
    long, odd = "x" * 300, "Ω\r\n\r\nWARC/1.1\n" * 20
    rows = [(5, "http://a/ b\n", long), (3, None, long), (9, "http://c", long), (3, None, long), (4, "u", "tiny"), (6, "u", "tiny"), (7, "u", None), (None, "u", odd), (8, "u", odd)]
    for version in (1, 2, None):
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
        arc = warc.write_arc(pages, common.shared_dir(spark, "arc"), version=version)
        got = warc.read_warc(spark, warc.convert(spark, arc, common.shared_dir(spark, "warc"))).collect()
        kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got)
        assert kinds == sorted([(5, "revisit", 3, 300), (3, "response", None, 300), (3, "response", None, 300), (9, "revisit", 3, 300), (4, "response", None, 4), (6, "response", None, 4), (7, "response", None, 0), (0, "revisit", 8, len(odd.encode())), (8, "response", None, len(odd.encode()))], key=lambda x: (x[0], x[1]))
        assert {r["payload_digest"] for r in got if r["page_id"] == 5} == {hashlib.sha256(long.encode()).hexdigest()}
    assert not same([r.asDict() for r in warc.op5(spark, sf).collect()], oracle(warc.OP5_SQL, sf))
    with pytest.raises(ValueError):
        list(warc.parse_arc(warc.version_block(1, "x", "2024") + b"u 0.0.0.0 2024 text/html 99\nshort"))


def test_decontamination(spark, sf, edge, empty):
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    planted = {i for i, t in docs_of(spark, sf).items() if any(x in t for x in items)}
    assert {r["doc_id"] for r in decontam.op6(spark, sf).filter("contaminated").collect()} == planted
    bench = spark.createDataFrame([(1, "A train leaves Paris at 9 and reaches the city where Anna waits after 40 km of hills and rain."), (2, None), (3, "")], "item_id long, text string")
    told = [(1, "So a train leaves London at 7 and reaches the city where Peter waits after 55 miles of hills and rain."), (2, "Nothing of the kind is told here about trains."), (3, None), (4, "")]
    got = {r["doc_id"]: r for r in decontam.contamination(spark.createDataFrame(told, "doc_id long, text string"), bench).collect()}
    assert got[1]["contaminated"] and got[1]["reparameterised"] and got[1]["item_ids"] == [1]
    assert not any(got[i]["contaminated"] for i in (2, 3, 4))
    assert decontam.contamination(edge, bench).count() == edge.count() and decontam.contamination(empty, bench).count() == 0


def verdicts(spark, items, told):
    pair = lambda x, names: spark.createDataFrame(list(enumerate(x, 1)), names)
    return {r["doc_id"]: r for r in decontam.contamination(pair(told, "doc_id long, text string"), pair(items, "item_id long, text string")).collect()}


def test_decontamination_short_items(spark):
    items = ["Which river flows through old Cairo?", "Name the largest ocean.", "3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610", "Tom has 5 apples. Ann has 7 km."]
    filler = "Plain words stand before and after so that the whole text is a long one. "
    got = verdicts(spark, items, [filler + x + " " + filler for x in items] + [filler * 3, items[1], "3, 5, 8, 13 and 21, 34, 55, 89"])
    assert [got[i]["item_ids"] for i in range(1, 8)] == [[1], [2], [3], [4], [], [2], []]


def test_decontamination_by_shuffle(spark, sf):
    """A benchmark beyond the number of windows that are broadcast gives the same verdicts."""
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    few = docs.filter("n_chars < 3000")
    one, two = (sorted(map(str, decontam.contamination(few, bench, filter_max=n).collect())) for n in (decontam.FILTER_MAX, 0))
    assert one == two and any("contaminated=True" in r for r in one)


def test_decontamination_by_occurrence(spark):
    """An exact copy counts beside re-parameterised variants; slots that contradict each other within one occurrence do not."""
    told = "The baker {0} sells {1} loaves to {2} and later {0} gives {3} rolls to {2} for free on market day"
    exact, *variants = [told.format(*x) for x in (("Anna", 12, "Peter", 7), ("Maria", 31, "Johann", 9), ("Olga", 44, "Viktor", 5))]
    mixed = "The baker Maria sells 31 loaves to Johann and later Olga gives 31 rolls to Maria for free on market day"
    got = verdicts(spark, [exact], [". ".join([exact, variants[0]]), ". ".join([variants[0], exact, variants[1]]), ". ".join(variants), mixed])
    assert [got[i]["contaminated"] for i in range(1, 5)] == [True, True, True, False]
    assert [got[i]["reparameterised"] for i in range(1, 4)] == [False, False, True]


def test_decontamination_partial_and_edited_copies(spark):
    """A passage, one changed, added or lost word in items of 15 to 26 words, other case and line breaks; chance phrases stay clean."""
    word = lambda k: "".join(chr(97 + k // 26**i % 26) for i in range(3))
    items = [" ".join(word(1000 * n + k) for k in range(n)) for n in (59, 15, 20, 25, 26)]
    items.append("In spring the painter Marta Lind met Oskar Berg near Lake Siljan and told Nils Ek about Paris and Rome before Easter")
    around = lambda x: f"Some words stand before it and {x} and some words follow"
    told = [around(" ".join(items[0].split()[20:48])), around(" ".join(items[0].split()[20:33])), around(" ".join(items[0].split()[20:29]))]
    for x in items[1:5]:
        w = x.split()
        told += [around(" ".join([*w[: len(w) // 2], *new, *w[len(w) // 2 + gone :]])) for new, gone in ((["changed"], 1), (["added"], 0), ([], 1))]
    told += [around(items[5].lower()), around(items[5].upper()), around(items[5].replace(" ", "\n")), around(" ".join(items[5].split()[:6]))]
    got = verdicts(spark, items, told)
    assert [got[i]["item_ids"] for i in range(1, len(told) + 1)] == [[1], [1], [], *([k] for k in (2, 3, 4, 5) for _ in range(3)), [6], [6], [6], []]


def test_votes_against_brute_force():
    """Each row's vote by plain loops: the nearest voters and all tied with the last of them, weighted by likeness ** 4."""
    rng = np.random.default_rng(6)
    voters = quality.unit(rng.standard_normal((60, 5)).astype(np.float32))
    voters[40:50], voters[50] = voters[0], 0
    rows, y = np.concatenate([quality.unit(rng.standard_normal((200, 5)).astype(np.float32)), voters[:3], np.zeros((1, 5), np.float32)]), rng.integers(0, 2, 60).astype(np.float64)
    got = quality.vote(rows, voters, y, 0.7, 7)
    for row, score in zip(rows, got, strict=True):
        sim = sorted(((float(row @ v), k) for k, v in enumerate(voters)), reverse=True)
        chosen = [(max(s, 0.0) ** 4, y[k]) for s, k in sim if s >= sim[6][0]]
        total = sum(w for w, _ in chosen)
        assert score == pytest.approx(sum(w * label for w, label in chosen) / total if total > 1e-12 else 0.7, abs=1e-5)
    assert (quality.vote(rows, voters[:0], y[:0], 0.7) == 0.7).all()


def test_quality_against_brute_force(spark, sf, labels):
    """Scores of all documents from a plain fit: counts by a dictionary, frequencies of all documents, cosines by loops."""
    texts = docs_of(spark, sf)
    model = quality.fitted(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    raw = {i: quality.counts(t) for i, t in texts.items()}
    df = sum((r > 0).astype(int) for r in raw.values())
    assert np.allclose(model.idf, np.log((1 + len(raw)) / (1 + df)) + 0.1, rtol=1e-5)
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    learned = [i for i in texts if i in known and zlib.crc32(str(i).encode()) % 5]
    assert len(model.labels) == len(learned) and sorted(model.labels) == sorted(float(known[i]) for i in learned)
    got = {r["doc_id"]: r for r in quality.op3(spark, sf).collect()}
    for i, r in raw.items():
        x = np.log1p(r) * model.idf
        x = np.concatenate([p / max(np.linalg.norm(p), 1e-9) for p in (x[: quality.WIDTH], x[quality.WIDTH :])]) @ model.basis
        x = x / max(np.linalg.norm(x), 1e-9)
        sim = model.voters @ x
        near = sim >= np.sort(sim)[-quality.VOTERS]
        w = np.where(near, np.maximum(sim, 0) ** 4, 0)
        want = (w * model.labels).sum() / w.sum() if w.sum() > 1e-12 else model.prior
        assert got[i]["score"] == pytest.approx(want, abs=1e-3) and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.3)


def test_clashing_labels_and_texts(spark, sf):
    """Of clashing labels the least counts, of clashing texts of an id the first by order, whatever the order of rows."""
    rows = [(i, " ".join(f"w{i % 7}x{k % (i + 2)}" for k in range(80))) for i in range(60)] + [(3, "other text " * 30), (4, None)]
    known = [(i, i % 2) for i in range(60)] + [(i, (i + 1) % 2) for i in range(0, 60, 3)] + [(5, None)]
    made = [(spark.createDataFrame(r, "doc_id long, text string").repartition(n), spark.createDataFrame(k, "doc_id long, quality int").repartition(n)) for n, (r, k) in ((1, (rows, known)), (5, (rows[::-1], known[::-1])))]
    for run, column in ((quality.neighbour_quality, "score"), (rules.rule_verdicts, "score")):
        one, two = (sorted((r["doc_id"], round(r[column], 5)) for r in run(d, k).collect()) for d, k in made)
        assert one == two


def test_forest_against_brute_force():
    """Path lengths by walking every tree for every row."""
    rng = np.random.default_rng(8)
    x = rng.random((300, len(rules.SHARES)))
    forest = rules.grow(x, np.ptp(x, axis=0) / 2, trees=9, rows=64, depth=6)
    rows = np.concatenate([x[:40], rng.random((40, len(rules.SHARES))) * 3 - 1])
    for row, score in zip(rows, forest.scores(rows), strict=True):
        lengths = []
        for t in range(9):
            node = 0
            while forest.left[t, node] >= 0:
                node = forest.left[t, node] + int(row[forest.share[t, node]] >= forest.at[t, node])
            lengths.append(forest.length[t, node])
        assert score == pytest.approx(2 ** -(np.mean(lengths) / rules.usual_length(64)))


def test_rules_threshold_against_brute_force(spark, sf, labels):
    """The verdicts follow from the scores of all documents and the threshold that plain counting over the labelled rows gives."""
    got, known = rules.op4(spark, sf).toPandas(), labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).toPandas()
    m = got[~got.base_failed].merge(known, on="doc_id")
    m["cell"] = np.floor(m.score * rules.CELLS)
    best = None
    for cell in sorted(m.cell.unique(), reverse=True):
        bad, good = ((m.cell >= cell) & (m.quality == q) for q in (0, 1))
        share = good.sum() / (m.quality == 1).sum()
        worth = bad.sum() / (m.quality == 0).sum() - 5 * share if share <= rules.REJECTS else -1
        if best is None or worth > best[0]:
            best = worth, cell / rules.CELLS
    limit = best[1] if best and best[0] > 0 else 2.0
    assert (got.kept == (~got.base_failed & (got.score < limit))).all()


def brute_logits(table, text):
    """Mean of the table's rows over all subwords of 2 to 4 bytes, found one by one."""
    import regex

    raw = (" " + regex.sub(r"[^\p{L}\p{M}]+", " ", text).strip() + " ").lower().encode()
    total, n = np.zeros(table.shape[1]), 0
    for size in (2, 3, 4):
        for at in range(len(raw) - size + 1):
            part = raw[at : at + size]
            if b" " in part[1:-1] or part == b"  ":
                continue
            h = size
            for b in part:
                h = (h ^ b) * 0x01000193 % 2**32
            total, n = total + table[(h ^ (h >> 15)) % langid.BUCKETS], n + 1
    return total / max(n, 1)


def test_language_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fitted(docs)
    texts, got = docs_of(spark, sf), {r["doc_id"]: r for r in langid.op7(spark, sf).collect()}
    for i, text in sorted(texts.items())[:25]:
        z = brute_logits(model.table, text[:20_000]) / model.temperature if len(text) <= 20_000 else None
        if z is not None and text.strip():
            p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
            assert got[i]["score"] == pytest.approx(p.max(), abs=1e-6) and got[i]["lang_pred"] == model.names[int(p.argmax())]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in texts)


def test_language_rejects_what_it_has_not_learned(spark, sf):
    """Documents of the learned languages are not rejected; other alphabets, other languages and noise are."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    told = ["Съешь же ещё этих мягких французских булок да выпей чаю", "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。", "aaaa aaaa aaaa", "xqzw vkjq zzxq wqkv pqzx", "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności"]
    extra = spark.createDataFrame([(10**9 + k, t, None) for k, t in enumerate(told)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.language(docs.select("doc_id", "text", "lang").union(extra)).collect()}
    own = [r["rejected"] for i, r in got.items() if i < 10**9 and r["held_out"]]
    assert np.mean(own) < 0.1 and sum(got[10**9 + k]["rejected"] for k in range(len(told))) >= 4


def test_language(spark, sf, edge, empty):
    got = langid.op7(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.95 and got.score.between(0, 1).all()
    out = {r["doc_id"]: r["lang_pred"] for r in langid.language(edge).collect()}
    assert out[1] == out[2] == out[3] == "und"
    assert langid.language(empty).count() == 0


def test_licences(spark, sf, edge, empty):
    mit = licences.KNOWN["MIT"][0]
    rows = [(1, f"Copyright (c) 2020 A. Body\n\n{mit}"), (2, mit.replace(",", " ,").upper() + "\n"), (3, mit + " and more"), (4, None), (5, "text\nReleased under the MIT Licence!\n")]
    got = {r["doc_id"]: r for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["license_id"] for i in (1, 2, 3, 4)] == ["MIT", "MIT", None, None] and got[5]["line_licenses"] == "MIT"
    assert licences.scan_licences(edge).count() == edge.count() and licences.scan_licences(empty).count() == 0
    assert not same([r.asDict() for r in licences.op8(spark, sf).collect()], oracle(licences.op8_sql(), sf))


def test_licences_as_files(spark):
    """Usual files: a title, copyright lines, wraps, comment marks; full texts where the machine has them."""
    import os
    import textwrap

    mit, isc = licences.KNOWN["MIT"][0], licences.KNOWN["ISC"][0]
    told = {"MIT": ["MIT License\n\nCopyright (c) 2024 A. Body\n\n" + textwrap.fill(mit, 70), "The MIT License (MIT)\nCopyright 2011-2014 X, Y\nCopyright (C) 2015 Z\nAll rights reserved.\n" + mit, "# Copyright (c) 2020 B\n#\n" + textwrap.indent(textwrap.fill(mit, 60), "# "), "/*\n * (c) 2020 C\n */\n" + mit]}
    told["ISC"] = ["ISC License\n\nCopyright (c) 2024, D <d@e.f>\n\n" + isc.replace("provided that the above copyright", "provided that the above\ncopyright")]
    told[None] = ["MIT License", "Copyright notice of a kind\n" + mit, mit[:-20], "MIT License\nSome text of a project"]
    files = {"GPL-3": "GPL-3.0", "GPL-2": "GPL-2.0", "Apache-2.0": "Apache-2.0", "MPL-2.0": "MPL-2.0", "LGPL-3": "LGPL-3.0", "CC0-1.0": "CC0-1.0"}
    for name, licence in files.items():
        if os.path.exists(path := f"/usr/share/common-licenses/{name}"):
            with open(path, encoding="utf-8") as f:
                told.setdefault(licence, []).append(f.read())
    rows = [(i, text, k) for i, (k, text) in enumerate((k, t) for k, own in told.items() for t in own)]
    got = {r["doc_id"]: r["license_id"] for r in licences.scan_licences(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    assert [(k, got[i], text[:60]) for i, text, k in rows if got[i] != k] == []
    assert licences.scan_licences(spark.createDataFrame([(1, mit)], "doc_id long, text string"), known={}).first()["license_id"] is None
    with pytest.raises(ValueError):
        licences.known_digests(spark, {"x": ["t"] * (licences.KNOWN_MAX + 1)})


def test_personal_data(spark, sf, edge, empty):
    text = "mail a.b@c.example.com, card 4111 1111 1111 1111, bad 4111 1111 1111 1112, ip 10.0.0.255 not 10.0.0.256, tel +1 (743) 555-3824, iban GB82 WEST 1234 5698 7654 32, ssn 123-45-6789"
    kinds = {k: text[a:b] for k, a, b, _ in pii.spans(text)}
    assert kinds == {"email": "a.b@c.example.com", "card": "4111 1111 1111 1111", "ip": "10.0.0.255", "phone": "+1 (743) 555-3824", "iban": "GB82 WEST 1234 5698 7654 32", "ssn": "123-45-6789"}
    assert "4111 1111 1111 1111" not in pii.masked(text, pii.spans(text))
    assert pii.spans("𝒳 a@b.c")[0][1:3] == (2, 7)
    got = pii.op9(spark, sf).collect()
    assert len(got) == len(docs_of(spark, sf)) and sum(r["n_card"] for r in got) > 0
    assert pii.find_personal_data(edge).count() == edge.count() and pii.find_personal_data(empty).count() == 0
    assert pii.mask_personal_data(edge).filter("text is null").count() == 1


def test_account_numbers_before_capitals(spark):
    """A number is found whole beside words in capitals, after a failed start and next to another number; a wrong one is not."""
    told = {
        "IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX": ["DE89 3704 0044 0532 0130 00"],
        "GB82WEST12345698765432 SWIFT": ["GB82WEST12345698765432"],
        "REF AB12 PAID TO GB82 WEST 1234 5698 7654 32 NOW": ["GB82 WEST 1234 5698 7654 32"],
        "NO93 8601 1117 947 DE89370400440532013000 OK": ["NO93 8601 1117 947", "DE89370400440532013000"],
        "DE89 3704 0044 0532 0130 01 BIC": [],
    }
    for text, numbers in told.items():
        assert [text[a:b] for k, a, b, _ in pii.spans(text) if k == "iban"] == numbers
    got = pii.mask_personal_data(spark.createDataFrame([(k, t) for k, t in enumerate(told)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert got[0]["text"] == "IBAN <IBAN> BIC COBADEFFXXX" and got[3]["text"] == "<IBAN> <IBAN> OK"


def test_near_duplicates(spark, sf, edge, empty):
    assert not same([r.asDict() for r in neardup.op10(spark, sf).collect()], oracle(queries.OP10_SQL, sf))
    got = {r["doc_id"]: r for r in neardup.near_duplicates(edge).collect()}
    assert got[4]["component_id"] == got[5]["component_id"] == got[6]["component_id"] == 4 and got[4]["kept"] and not got[6]["kept"]
    assert [got[i]["component_id"] for i in (1, 2, 3)] == [1, 2, 3] and got[None]["kept"]
    assert neardup.near_duplicates(empty).count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    """Rows that share an id but not a text are linked by their own texts; one set of a component is kept."""
    words = lambda a, n: " ".join(f"w{a}x{k}" for k in range(n))
    rows = [(1, words(0, 60)), (1, words(1, 60)), (2, words(1, 60) + " end"), (3, words(2, 60)), (3, words(2, 60)), (4, words(3, 60)), (4, words(3, 60) + " end"), (5, words(3, 60) + " other end")]
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got)[:5] == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (3, 3, True)]
    four = sorted(got)[5:]
    assert [x[:2] for x in four] == [(4, 4), (4, 4), (5, 4)] and sum(k for *_, k in four) == 1


@pytest.mark.parametrize("block", [16, 512])
def test_near_duplicate_families_against_brute_force(spark, monkeypatch, block):
    """Chains of edited copies, which no pivot links: links between blocks of members are those of all pairs."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng, rows = np.random.default_rng(3), []
    for g in range(4):
        own = [f"g{g}w{i}" for i in range(60)]
        for i in range(70):
            if i % 3 == 0:
                at = rng.integers(0, 60)
                own = [*own[:at], f"g{g}e{i}", *own[at + 1 :]]
            extra = list(own)
            for at in rng.choice(60, rng.integers(0, 5), replace=False):
                extra[at] = f"g{g}i{i}x{at}"
            rows.append((1000 * g + i, " ".join(extra)))
    ids, sets = [i for i, _ in rows], [set(neardup.shingles(t, 2).tolist()) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), size=2).collect()}
    assert got == {ids[i]: ids[root(i)] for i in range(len(rows))}


def test_hot_keys_are_dealt(spark):
    big = spark.range(4000).select(F.when(F.col("id") < 3000, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    counts = big.groupBy("k").agg(F.count("*").alias("rows"))
    small = counts.select("k", (F.col("k") * 2).alias("v"))
    got = common.spread_join(big, small, "k", "id", counts)
    assert sorted((r["id"], r["v"]) for r in got.collect()) == [(i, 0 if i < 3000 else 2 * (i % 50)) for i in range(4000)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = [r["n"] for r in common.spread_join(big, small, "k", "id", counts).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert max(tasks) < 1500


def test_near_duplicate_group_against_brute_force(spark):
    """A large group of edited copies around one text: links within it are exactly those of all pairs."""
    rng = np.random.default_rng(1)
    base, rows = [f"w{i}" for i in range(120)], []
    for i in range(400):
        own = list(base)
        for at in rng.choice(120, rng.integers(0, 9), replace=False):
            own[at] = f"e{i}x{at}"
        rows.append((i, " ".join(own)))
    sets = [set(neardup.shingles(t, 2).tolist()) for _, t in rows]
    parent = list(range(400))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(400):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()}
    assert got == {i: root(i) for i in range(400)}


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf), name)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    check_pieces(corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


def test_pipeline_stages_against_brute_force(spark, sf):
    """Ids and texts that near_dedup, decontamination and masking keep, of the small table with rows planted for each."""
    import re

    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = docs_of(spark, sf)
    base = min(texts)
    new = {10**9: texts[base] + " end", 10**9 + 1: f"Before it. {items[0]} After it.", 10**9 + 2: "Write to a.b@example.com or 10.0.0.7 now", 10**9 + 3: "IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX"}
    extra = docs.filter(f"doc_id = {base}").drop("doc_id", "text").crossJoin(spark.createDataFrame(list(new.items()), "doc_id long, text string"))
    docs, texts = common.stored(docs.unionByName(extra.select(*docs.columns)), "planted"), texts | new
    after = lambda stage: {r["doc_id"]: r["text"] or "" for r in stage(spark, docs, sf).collect()}

    def sets(text):
        x = re.findall(r"[^\x20\x09-\x0D]+", text.translate({k: k + 32 for k in range(65, 91)}))
        return {tuple(x[i : i + 5]) for i in range(max(1, len(x) - 4))} if x else set()

    ids = sorted(texts)
    own = {i: sets(texts[i]) for i in ids}
    component = {i: i for i in ids}

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[:k]:
            n = len(own[i] & own[j])
            if n and 100 * n >= 80 * (len(own[i]) + len(own[j]) - n):
                a, b = sorted((root(i), root(j)))
                component[b] = a
    kept = {i: texts[i] for i in ids if root(i) == i}
    assert 10**9 not in kept and after(corpus_pipeline.near_dedup) == kept
    assert after(corpus_pipeline.benchmark_decontamination) == {i: t for i, t in texts.items() if not any(x in t for x in items)}
    got = after(corpus_pipeline.personal_data)
    assert got == {i: pii.masked(t, pii.spans(t)) for i, t in texts.items()}
    assert got[10**9 + 2] == "Write to <EMAIL> or <IP> now" and got[10**9 + 3] == "IBAN <IBAN> BIC COBADEFFXXX"


PAGES = "page_id long, url string, html string"


def archived(spark, pages):
    arc = warc.write_arc(pages, common.shared_dir(spark, "arc"))
    return warc.read_warc(spark, warc.convert(spark, arc, common.shared_dir(spark, "warc")))


def test_warc_empty_tables_and_partitions(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").repartitionByRange(4, "page_id")
    assert archived(spark, spark.createDataFrame([], PAGES)).count() == 0
    for some in (pages.filter("page_id >= 25"), pages.filter("page_id < 0"), pages.union(pages.filter("page_id < 0"))):
        assert sorted(r["page_id"] for r in archived(spark, some).collect()) == sorted(r["page_id"] for r in some.collect())
    assert list(warc.parse_arc(b"")) == list(warc.parse_warc(b"")) == []


def test_warc_members_and_rolling(spark, tmp_path):
    """A gzip member a record, files bounded in records and bytes, long pages, and the join beside the broadcast."""
    import gzip
    import zlib as z

    rows = [(i, f"http://h/{i}", "page " * (40_000 if i % 50 == 0 else 5) + str(i % 700)) for i in range(2600)] + [(9000 + i, "u", chr(97 + i) * (3 << 20)) for i in range(12)]
    pages = spark.createDataFrame(rows, PAGES).coalesce(1)
    arc = warc.write_arc(pages, str(tmp_path / "arc"))
    sizes = []
    for file in (tmp_path / "arc").rglob("part-*"):
        data, members = file.read_bytes(), 0
        sizes.append(len(gzip.decompress(data)))
        while data:
            member = z.decompressobj(31)
            members, one = members + 1, member.decompress(data)
            assert not one or one.startswith(b"filedesc://") or b"X-Page-Id" in one
            data = member.unused_data
        assert members <= 2 * warc.PER_FILE + 3
    assert len(sizes) >= 4 and max(sizes) < warc.FILE_BYTES + (1 << 20)
    got = [{r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read_warc(spark, warc.convert(spark, arc, str(tmp_path / f"warc{n}"), broadcast_max=n)).collect()} for n in (10**6, 0)]
    first, want = {}, {}
    for i, _, h in sorted(rows):
        n = len(h)
        want[i] = ("revisit", first[h], n) if n >= 100 and h in first else ("response", None, n)
        first.setdefault(h, i)
    assert got[0] == got[1] == want
    plain = b"".join([warc.version_block(1, "x", "2024"), warc.arc_record(1, "u", "20240101000000", b"a\nb" * 50_000, 0), b"\n\n", warc.arc_record(1, "v", "20240101000000", b"", 0)])
    for data in (plain, gzip.compress(plain)):
        assert [(r["URL"], len(r["content"])) for r in warc.parse_arc(data)][1:] == [("u", 150_000), ("v", 0)]
    with pytest.raises(ValueError):
        list(warc.parse_arc(gzip.compress(plain)[:-30]))


BASE_KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    """The base spans by the patterns as they are stated."""
    import re

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    keep = {"email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")), "card": lambda s: 14 <= sum(c.isdigit() for c in s) <= 19 and luhn(re.sub(r"\D", "", s)), "phone": lambda s: 10 <= sum(c.isdigit() for c in s) <= 15}
    found = [(m.start(), k, m.end()) for k, (name, p) in enumerate(BASE_KINDS.items()) for m in re.finditer(p, text) if keep[name](m[0])]
    names = list(BASE_KINDS)
    return [f"{names[k]}:{a}:{b}" for a, k, b in sorted(found)]


def test_personal_data_against_brute_force(spark, sf):
    texts = docs_of(spark, sf)
    odd = ["a@b@c.d", "x" * 30 + "@y", "1.2.3.4.5.6.7.8.9", "0256.1.1.1 000255.1.1.1", "+1 (743) 555-3824 4111-1111-1111-1111", "a.@b.c.@d.e", "é@b.c 1.2.3", "4111 1111 1111 1111 1111", "1@2.3.4.5"]
    rng = np.random.default_rng(4)
    odd += ["".join(rng.choice(list("ab.@1 2-9+(é3"), 60)) for _ in range(2000)]
    texts |= {10**6 + k: t for k, t in enumerate(odd)}
    made = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in pii.result(pii.find_personal_data(made)).collect():
        own = brute_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(own).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE_KINDS] == [sum(x.startswith(k + ":") for x in own) for k in BASE_KINDS]
        assert set(own) <= set(r["spans"].split(","))


@pytest.mark.parametrize("text", ["a" * 10**6 + "@", "1" * 10**6 + ".", "a@b.co 10.0.0.1 GB82 WEST 1234 5698 7654 32 " * 17_000, "AB12" * 250_000, "+1((" * 250_000, "a@" * 500_000, "-1" * 500_000], ids=["letters", "digits", "spans", "capitals", "signs", "ats", "dashes"])
def test_personal_data_in_long_texts(text):
    import time

    began = time.process_time()
    found = pii.spans(text)
    assert time.process_time() - began < 6 and len(found) == (51_000 if "GB82" in text else 0)
    assert len(pii.masked(text, found)) <= len(text)


def test_pipeline_stages_on_edge_rows(spark, sf, edge, empty):
    """Each stage on nulls, empty and long texts, repeated rows and rows without an id; and on no rows."""
    import corpus_pipeline

    columns = ["doc_id", "text", "lang", "source", "n_chars", "term"]
    docs, none = edge.select(*columns), empty.select(*columns)
    stages = dict(corpus_pipeline.STAGES)
    run = lambda name, rows: stages[name](spark, rows, sf)
    ids = lambda rows: sorted((r["doc_id"] for r in rows.collect()), key=lambda i: (i is not None, i))
    kept = run("quality_rules", docs)
    assert kept.columns == columns and not set(ids(kept)) & {1, 2, 3, 7, 8}
    one = run("near_dedup", docs)
    assert one.columns == columns and ids(one) == [None, 1, 2, 3, 4, 7, 8]
    clean = run("benchmark_decontamination", docs)
    assert clean.columns == columns and ids(clean) == ids(docs)
    masked = run("personal_data", docs)
    assert sorted(map(str, masked.select("doc_id", "text").collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))
    assert run("packing", docs).agg(F.sum("length")).first()[0] == sum(len(reference_ids(r["text"])) for r in docs.collect())
    assert all(run(name, none).count() == 0 for name in stages)
