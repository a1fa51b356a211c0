"""Token ids in Parquet: list columns with dictionary or delta encoding, bounded row groups, small pages with page indexes.

A reader that wants a few documents, or the metadata alone, decodes only the pages and columns that hold them.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

VOCABULARY, END = "word_bpe_49k.json", 2
#: Ids that word_bpe_49k.json can give: 0 to 49407.
N_IDS = 49408
#: Pieces that a Python worker keeps, and letters of the longest; others are encoded each time.
KEPT, KEPT_LETTERS = 400_000, 64

# The vocabulary file's own split pattern, in general and for texts of code points below 256.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SPLIT_LATIN = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^\x09-\x0d\x20\x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level models use for each byte: itself if printable, else one from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Pieces(dict):
    """Ids, as little-endian bytes, of each piece that the split pattern makes; a piece is encoded when first met."""

    def __init__(self, model, decode: str):
        self.model, self.decode, self.letters = model, decode, byte_letters()

    def __missing__(self, piece):
        raw = piece.decode("latin-1").encode() if self.decode else piece.encode()
        got = np.array([x.id for x in self.model.tokenize(raw.decode("latin-1").translate(self.letters))], "<u4").tobytes()
        if len(self) < KEPT and len(piece) <= KEPT_LETTERS:
            self[piece] = got
        return got


class Encoder:
    """``Tokenizer.encode(text, add_special_tokens=False).ids`` of the word vocabulary, with a memo of pieces.

    The file's steps (normal form, lower case, split) are done on the text, the library's model encodes each new piece.
    Texts with the vocabulary's special strings go to the library whole. A file of other steps or more ids is an error.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        made = json.loads(self.whole.to_str())
        steps = [x["type"] for x in (made["normalizer"] or {}).get("normalizers", [])], [(x["type"], x.get("pattern", {}).get("Regex")) for x in (made["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if steps != (["NFC", "Replace", "Lowercase"], [("Split", SPLIT.pattern), ("ByteLevel", None)]) or self.whole.get_vocab_size() > N_IDS:
            raise ValueError(f"{path} has other steps than {VOCABULARY}, or more than {N_IDS} ids")
        self.latin, self.wide = Pieces(self.whole.model, "latin-1"), Pieces(self.whole.model, "")

    def __call__(self, text: str) -> bytes:
        if "<|" in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        try:
            return b"".join(map(self.latin.__getitem__, SPLIT_LATIN.findall(text.lower().encode("latin-1"))))
        except UnicodeEncodeError:
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            return b"".join(map(self.wide.__getitem__, SPLIT.findall(text)))


ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """This process's encoder; a Python worker keeps it from task to task."""
    import public_tokenizers

    path = path or public_tokenizers.path(VOCABULARY)
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]


def encoded(batch: pa.RecordBatch, vocabulary: str | None = None) -> list[np.ndarray]:
    """Ids of each whole text of the batch, with the end id."""
    encode, end = encoder(vocabulary), np.array([END], "<u4").tobytes()
    return [np.frombuffer(encode(x) + end, "<u4") for x in common.texts(batch["text"])]


def write_tokens(docs: DataFrame, path: str, *, text: str = "text", doc_id: str = "doc_id", encoding: str = "dictionary", rows_per_file: int = 20_000, file_bytes: int = 48 << 20, group_bytes: int = 16 << 20, page_bytes: int = 64 << 10, vocabulary: str | None = None) -> str:
    """Encode all documents and write them as Parquet in ascending id order; returns the path. Files have about
    ``rows_per_file`` documents or ``file_bytes`` of text at most, or one longer text.

    Columns: doc_id, part and part_start (ids of the documents before it in its file), n_tokens, tokens (list of int, end
    id included). ``encoding``: "dictionary", or "delta" (binary packed). Row groups hold ``group_bytes`` and pages
    ``page_bytes`` at most, with column and offset indexes, so a filter on doc_id skips pages. A null text is an empty one,
    a null id comes first, rows that share an id are ordered by a hash of their texts (so a row's place does not depend on
    partitions, and an id of many rows is spread over files), repeated rows stay, an empty table gives an empty dataset;
    other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-n // rows_per_file), -(-size // file_bytes), docs.sparkSession.sparkContext.defaultParallelism)
    schema = "doc_id long, part int, part_start long, n_tokens int, tokens array<int>"
    kinds = common.arrow_schema(docs.sparkSession, schema)

    def run(batches):
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = encoded(batch, vocabulary)
            sizes = np.array([len(x) for x in ids], np.int64)
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            yield common.batch_of({"doc_id": batch["doc_id"], "part": np.full(len(ids), part), "part_start": starts, "n_tokens": sizes, "tokens": common.lists(ids, pa.int32())}, kinds)

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    writer = ordered.mapInArrow(run, schema).write.option("compression", "zstd").option("parquet.block.size", group_bytes).option("parquet.page.size", page_bytes)
    if encoding == "delta":
        writer = writer.option("parquet.enable.dictionary", "false").option("parquet.writer.version", "v2")
    elif encoding != "dictionary":
        raise ValueError(f"encoding is {encoding!r}; it can be dictionary or delta")
    writer.parquet(path)
    return path


def read_tokens(spark: SparkSession, path: str, *, ids: list[int] | None = None, columns: list[str] | None = None) -> DataFrame:
    """The dataset, or the documents ``ids`` and columns asked for; both reach the Parquet scan."""
    df = spark.read.schema("doc_id long, part int, part_start long, n_tokens int, tokens array<int>").parquet(path)
    df = df if ids is None else df.filter(F.col("doc_id").isin(ids))
    return df if columns is None else df.select(*columns)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files.

    Each file's sum goes into one short running sum (a row per file), which is joined back to the documents.
    """
    sums = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    digests = common.mapped(
        read_tokens(spark, path),
        "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long",
        lambda batch: {k: batch[k] for k in ("doc_id", "part", "part_start", "n_tokens")} | {"ids_crc32": list_crcs(batch["tokens"])},
    )
    return digests.join(ahead, "part").select("doc_id", (F.col("ahead") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def list_crcs(column: pa.ListArray) -> list[int]:
    flat, ends = column.values.to_numpy(zero_copy_only=False).astype("<u4"), column.offsets.to_numpy()
    raw = memoryview(flat.tobytes())
    return [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return token_index(spark, write_tokens(docs, common.shared_dir(spark, "tokens")))
