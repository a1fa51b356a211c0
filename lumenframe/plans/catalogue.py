"""All queries of the library, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cluster_queries, curve_queries, extra_queries, flow_queries, fold_queries, lexicon_queries, mood_queries, pacing_queries, pair_queries, payload_queries, report_queries, rollup_queries, sequence_queries, signal_queries, text_queries, timeline_queries, vector_queries

FLAGSHIP = "p6_training_table"
MODULES = (timeline_queries, text_queries, vector_queries, flow_queries, signal_queries, report_queries, fold_queries, lexicon_queries, payload_queries, pacing_queries, pair_queries, rollup_queries, extra_queries, cluster_queries, curve_queries, sequence_queries, mood_queries)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLES: dict[str, str] = {k: v for m in MODULES for k, v in m.ORACLES.items()}
