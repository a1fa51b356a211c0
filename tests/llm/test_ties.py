"""Repeated and null ids in token files and packing, other vocabularies, and lines of licences without the word."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lumenframe.llm import common, licences, packing, tokens

ROWS = [(7, "one text"), (7, "another text of the same id"), (7, None), (7, "one text"), *((None, f"row {i} without an id " * (i % 5 + 1)) for i in range(300)), *((3, f"hot id {i}") for i in range(300)), (9, "last")]


def test_places_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    found = []
    for parts in (1, 5, 13):
        path = tokens.write_tokens(df.repartition(parts, F.rand(parts)), common.shared_dir(spark, "t"), rows_per_file=50)
        found.append(sorted(map(str, tokens.token_index(spark, path).collect())))
        assert tokens.read_tokens(spark, path).groupBy("part").count().agg(F.max("count")).first()[0] < 200
    assert found[0] == found[1] == found[2] and len(found[0]) == len(ROWS)
    start = {(r["doc_id"], r["ids_crc32"]): r["start"] for r in tokens.token_index(spark, path).collect()}
    assert min(v for (i, _), v in start.items() if i == 3) > max(v for (i, _), v in start.items() if i is None) and max(start.values()) == max(v for (i, _), v in start.items() if i == 9)


def test_shards_of_null_and_repeated_ids(spark, monkeypatch):
    """Rests without an id, or of one id, are dealt to shards by what they hold; an overfull shard is cut at its bound."""
    monkeypatch.setattr(packing, "SHARD", 32)
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    keys = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    found = [sorted(map(str, packing.pack(df.repartition(n, F.rand(n))).select(*keys).collect())) for n in (1, 7)]
    assert found[0] == found[1] and len(found[0]) == len(ROWS)
    shards = packing.pack(df).filter("doc_id is null").select(F.shiftright("sequence_id", 33).alias("shard")).groupBy("shard").count().collect()
    assert len(shards) > 4


def test_other_vocabularies_are_errors(spark):
    import public_tokenizers

    with pytest.raises(ValueError, match="other steps"):
        tokens.encoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_licence_lines_without_the_word(spark):
    isc = licences.KNOWN["ISC"][0]
    rows = [(1, f"some text\n{isc}\nmore"), (2, "a\nPermission to use this for any purpose is granted.\nb"), (3, "no such line")]
    got = {r["doc_id"]: r for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["line_licenses"] == "ISC" and got[2]["line_licenses"] == "" and got[3]["license_id"] is None
    own = {r["doc_id"]: r for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string"), known={"X": ["Permission to use this for any purpose is granted."]}).collect()}
    assert [own[i]["line_licenses"] for i in (1, 2, 3)] == ["", "X", ""]
