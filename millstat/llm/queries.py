"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, embed_dedup, jaccard_join, langid, license_scan, packing, periodic_runs, quality, secrets,
               sharding, token_align, token_files, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": embed_dedup.op1_embedding_dedup,
    "op2_sharding": sharding.op2_sharding,
    "op3_language_id": langid.op3_language_id,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_jaccard_join": jaccard_join.op6_jaccard_join,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_packing": packing.op8_packing,
    "op9_token_files": token_files.op9_token_files,
    "op10_quality": quality.op10_quality,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_license_scan": license_scan.op12_license_scan,
    "op13_token_align": token_align.op13_token_align,
    "pipeline": corpus_pipeline.run,
}

_REACH = """reach(id, other) AS (
  SELECT a, b FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other)"""

ORACLE_SQL: dict[str, str] = {
    # every pair by cosine in double precision
    "op1_embedding_dedup": f"""WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS q
  FROM embeddings),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id
  WHERE list_dot_product(x.e, y.e) >= 0.9 * sqrt(x.q) * sqrt(y.q)),
{_REACH}
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
  least(vec_id, coalesce((SELECT min(other) FROM reach WHERE id = vec_id), vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce((SELECT min(other) FROM reach WHERE id = vec_id), vec_id)) AS kept
FROM v""",
    # every pair with a common shingle
    "op6_jaccard_join": f"""WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle FROM (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (shingle)
  WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
{_REACH},
top AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(top.component_id, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN top ON top.id = w.doc_id""",
}
ORACLE_SQL["op12_license_scan"] = license_scan.oracle_sql()
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
