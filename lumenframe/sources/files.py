"""Sources: JSON documents, manifests, keyed JSON, JSON lines, newest artifacts, times."""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DOCUMENT = "title string, description string, transcripts map<string,string>, transcripts_token_ids map<string,array<int>>, video_description_by_neuro string, trend_words string, comments array<struct<text:string>>, speakers map<string,struct<name:string,description:string>>"


def utc(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Times without a zone are taken as UTC, whatever the session's zone is."""
    if dict(df.dtypes).get(ts) != "timestamp_ntz":
        return df
    return df.withColumn(ts, F.from_utc_timestamp(F.col(ts).cast("timestamp"), F.current_timezone()))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON document file; absent fields are null."""
    return spark.read.schema(DOCUMENT).option("multiLine", True).json(path).withColumn("path", F.input_file_name())


def manifests(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All manifest.json files below a folder; unreadable ones are left out."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).option("pathGlobFilter", "manifest.json").json(path)


#: Characters that open, close or quote; all others leave the parser's state as it is.
_MARKS = re.compile(r'["\\{}\[\]]')


class _Entries:
    """The entries of one JSON object, taken from its text between commas, piece by piece; only one entry is held at a time."""

    def __init__(self):
        self.parts, self.depth, self.quoted, self.begun, self.over = [], 0, False, False, False

    def take(self, piece: str) -> tuple[str, str] | None:
        """The entry that ends with this piece, as its key and its value's text, if one does."""
        if self.over:
            return None
        escaped = -1
        for m in _MARKS.finditer(piece):
            c, at = m[0], m.start()
            if self.quoted:
                if at == escaped:
                    continue
                if c == "\\":
                    escaped = at + 1
                elif c == '"':
                    self.quoted = False
            elif c == '"':
                self.quoted = True
            elif c in "{[":
                self.depth += 1
            elif c in "}]":
                self.depth -= 1
        # A backslash at the end of a piece quotes the comma, which needs no quoting.
        self.parts.append(piece)
        if self.quoted or self.depth > 1:
            return None
        text, self.parts = ",".join(self.parts).strip(), []
        if not self.begun:
            self.begun, text = True, text[1:] if text[:1] == "{" else "x"
        if self.depth == 0:
            self.over, text = True, text.rstrip()[:-1]
        try:
            key, end = json.JSONDecoder().raw_decode(text.lstrip())
            rest = text.lstrip()[end:].lstrip()
            if isinstance(key, str) and rest[:1] == ":":
                json.loads(rest[1:])
                return key, rest[1:]
        except ValueError:
            pass
        self.over = True
        return None


def keyed(spark: SparkSession, path: str, value: str) -> DataFrame:
    """Files that each hold one JSON object: a row per key and value (of the type ``value``; null where it does not fit).

    A file is read as the pieces between its commas, which any split of it yields; they are brought into order and one entry at a
    time is put together, so a task's memory follows the largest entry, not the file. Entries before a malformed one are kept.
    """

    def run(batches):
        file, entries = None, _Entries()
        for batch in filter(len, batches):
            out = []
            for name, piece in zip(batch["file"].to_pylist(), batch["piece"].to_pylist(), strict=True):
                if name != file:
                    file, entries = name, _Entries()
                if (entry := entries.take(piece)) is not None:
                    out.append(entry)
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.string()), pa.array([v for _, v in out], pa.string())], names=["key", "json"])

    pieces = spark.read.option("lineSep", ",").text(path).select(F.col("value").alias("piece"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    entries = pieces.repartition("file").sortWithinPartitions("file", "block", "place").select("file", "piece").mapInArrow(run, "key string, json string")
    return entries.select("key", F.from_json(F.concat(F.lit('{"v":'), "json", F.lit("}")), f"struct<v:{value}>")["v"].alias("value"))


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of JSON lines; malformed lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def newest(files: DataFrame, keys: list[str], modified: str = "modified", path: str = "path") -> DataFrame:
    """The newest file of each key; of equal times, the last path."""
    w = Window.partitionBy(*keys).orderBy(F.desc(modified), F.desc(path))
    return files.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
