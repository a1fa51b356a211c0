"""Token ids back to text by a vocabulary that is a table: ids are joined with their bytes and put in order again."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What marks the end of a word in a vocabulary of whole words' pieces.
WORD_END = "</w>"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for themselves, the others, in order,
    for the letters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """id, bytes (hex) and special of each token of a tokenizer's JSON file, a file of a model's size on the driver. Letters of a
    byte-level vocabulary are turned back to bytes, a word's end to a blank."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    letters = byte_letters()
    rows = {}
    for token, i in made["model"]["vocab"].items():
        end = token.endswith(WORD_END)
        body = token.removesuffix(WORD_END)
        raw = bytes(letters[c] for c in body) if all(c in letters for c in body) else body.encode()
        rows[i] = (i, (raw + b" " * end).hex(), False)
    for token in made.get("added_tokens", []):
        rows[token["id"]] = (token["id"], token["content"].encode().hex(), bool(token.get("special")))
    return spark.createDataFrame(sorted(rows.values()), "id int, bytes string, special boolean")


def decoded(df: DataFrame, key: str, ids: str, words: DataFrame) -> DataFrame:
    """``key`` and text of every row of ``df``, whose ``ids`` (an array) are decoded: special and unknown ids are left out, bytes that
    are no text become replacement marks, blanks at the ends go. No ids, or null, give an empty text. Keys are not repeated.

    The vocabulary is sent to the tasks; the ids' bytes are put in order by a sort that spills, and a task holds one row's text.
    """

    def run(batches):
        last, parts = None, []
        for batch in filter(len, batches):
            column = batch["bytes"]
            ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
            data, runs, at, out = column.buffers()[2], pc.run_end_encode(batch[key]), 0, []
            for k, end in zip(runs.values, runs.run_ends.to_pylist(), strict=True):
                if parts and k != last:
                    out.append((last, b"".join(parts)))
                    parts = []
                # The bytes of neighbouring rows lie side by side.
                parts.append(data[int(ends[at]) : int(ends[end])].to_pybytes() if data else b"")
                last, at = k, end
            if out:
                yield made(out)
        if parts:
            yield made([(last, b"".join(parts))])

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array([k.as_py() for k, _ in rows], rows[0][0].type), pa.array([x for _, x in rows], pa.binary())], names=[key, "bytes"])

    flat = df.select(key, F.posexplode(ids).alias("place", "id"))
    pieces = flat.join(F.broadcast(words.filter("not special").select("id", F.unhex("bytes").alias("bytes"))), "id").select(key, "place", "bytes")
    kind = df.select(key).schema[0].dataType.simpleString()
    texts = pieces.repartition(key).sortWithinPartitions(key, "place").select(key, "bytes").mapInArrow(run, f"{key} {kind}, bytes binary")
    text = F.trim(F.expr("make_valid_utf8(cast(bytes as string))"))
    return df.select(key).join(texts.select(key, text.alias("text")), key, "left").select(key, F.coalesce("text", F.lit("")).alias("text"))
