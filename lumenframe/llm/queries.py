"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, langid, licences, neardup, packing, pii, quality, rules, runs, tokens, vectors, warc, whitening


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_output": tokens.op1,
    "op2_packing": packing.op2,
    "op3_quality_neighbours": quality.op3,
    "op4_quality_rules": rules.op4,
    "op5_warc": warc.op5,
    "op6_decontamination": decontam.op6,
    "op7_language": langid.op7,
    "op8_licences": licences.op8,
    "op9_personal_data": pii.op9,
    "op10_near_duplicates": neardup.op10,
    "op11_periodic_runs": runs.op11,
    "op12_whitening": whitening.op12,
    "op13_embedding_duplicates": vectors.op13,
    "pipeline": pipeline,
}

OP10_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS x FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(x) >= 2 THEN list_transform(range(1, len(x)), lambda i: x[i] || ' ' || x[i + 1]) ELSE x END) AS shingle FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
sym AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT sym.b, r.c FROM r JOIN sym ON r.doc_id = sym.a),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, w.doc_id = m.component_id AS kept
FROM w JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)"""

ORACLES: dict[str, str] = {"op5_warc": warc.OP5_SQL, "op8_licences": licences.op8_sql(), "op10_near_duplicates": OP10_SQL, "op11_periodic_runs": runs.OP11_SQL, "op13_embedding_duplicates": vectors.OP13_SQL}
