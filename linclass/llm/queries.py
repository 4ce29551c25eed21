"""Queries of the operators, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from linclass.llm.decontaminate import op2_decontaminate
from linclass.llm.fingerprint import op1_fingerprints
from linclass.llm.jaccard_join import op5_jaccard_join
from linclass.llm.lm_score import op13_lm_score
from linclass.llm.oracle import IMPORTANCE_RESAMPLING, SPELLING_VARIANTS
from linclass.llm.packing import op4_length_buckets
from linclass.llm.pii import op10_pii
from linclass.llm.quality import op8_quality
from linclass.llm.resample import op12_importance_resampling
from linclass.llm.suffix_dedup import op9_suffix_dedup
from linclass.llm.text import small_batches
from linclass.llm.token_counts import op7_section_tokens
from linclass.llm.token_store import op3_token_files
from linclass.llm.toxicity import op6_toxicity
from linclass.llm.variants import op11_spelling_variants


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return f(spark, sf_dir)

    return run


QUERIES = {f.__name__: _query(f) for f in (op1_fingerprints, op2_decontaminate, op3_token_files, op4_length_buckets, op5_jaccard_join, op6_toxicity, op7_section_tokens, op8_quality, op9_suffix_dedup, op10_pii, op11_spelling_variants, op12_importance_resampling, op13_lm_score)}

#: All pairs with a common shingle are counted, links are followed to their components.
JACCARD_JOIN = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)
  UNION ALL
  SELECT doc_id, array_to_string(w, ' ') FROM t WHERE len(w) BETWEEN 1 AND 4),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM g a JOIN g b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * shared >= 80 * (nx.n + ny.n - shared)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM t UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached)
SELECT t.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(reached)::BIGINT AS component_id
FROM t JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY t.doc_id"""

#: Bytes as hex digits; every string of 50 bytes, its least document, and the runs left over.
SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 100)) AS s2 FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d)),
f AS (SELECT s2, min(doc_id) AS least FROM w GROUP BY s2),
r AS (SELECT w.doc_id, w.i FROM w JOIN f USING (s2) WHERE f.least < w.doc_id),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS opens FROM r),
n AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM g),
s AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM n GROUP BY doc_id, span),
p AS (SELECT s.*, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
k AS (SELECT p.doc_id, sum(b - a) AS gone, count(*) AS spans, max(b) AS last,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
      FROM p JOIN d USING (doc_id) GROUP BY p.doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN gone IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""

#: The other operators are no SQL: tokenizers, trained models, fingerprints, edit distance and
#: matches in place are tested against plain Python in tests/llm.
ORACLE_SQL = {"op5_jaccard_join": JACCARD_JOIN, "op9_suffix_dedup": SUFFIX_DEDUP, "op11_spelling_variants": SPELLING_VARIANTS, "op12_importance_resampling": IMPORTANCE_RESAMPLING}
