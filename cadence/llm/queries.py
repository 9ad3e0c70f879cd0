"""Registered queries of the subpackage: name -> (spark, sf_dir) -> DataFrame,
and DuckDB SQL for those that SQL can express over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from cadence.llm import (
    decontaminate,
    exact_dedup,
    langid,
    lexical_search,
    nbsvm,
    periodic_runs,
    pii,
    quality_rules,
    sentencepiece_unigram,
    simhash,
    suffix_dedup,
    suffix_tree_dedup,
    token_counts,
)
from cadence.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def _labels(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(f"{d}/labels.parquet")


def _items(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(f"{d}/benchmark.parquet")


def llm_queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": lambda s, d: quality_rules.digest(documents(s, d), _labels(s, d)),
        "op2_simhash_near_dedup": lambda s, d: simhash.digest(documents(s, d)),
        "op3_sentencepiece": lambda s, d: sentencepiece_unigram.encode(documents(s, d)),
        "op4_quality_classifier": lambda s, d: nbsvm.digest(documents(s, d), _labels(s, d)),
        "op5_suffix_array_dedup": lambda s, d: suffix_dedup.digest(documents(s, d)),
        "op6_pii": lambda s, d: pii.detect(documents(s, d)),
        "op7_benchmark_decontamination": lambda s, d: decontaminate.digest(documents(s, d), _items(s, d)),
        "op8_language_id": lambda s, d: langid.digest(documents(s, d)),
        "op9_token_counts": lambda s, d: token_counts.count_redacted(documents(s, d)),
        "op10_substring_dedup": lambda s, d: suffix_tree_dedup.digest(documents(s, d)),
        "op11_periodic_runs": lambda s, d: periodic_runs.digest(documents(s, d)),
        "op12_exact_dedup": lambda s, d: exact_dedup.membership(documents(s, d)),
        "op13_lexical_search": lambda s, d: lexical_search.search(documents(s, d), _items(s, d)),
        "pipeline": corpus_pipeline.run,
    }


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
ig AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM iw),
sizes AS (SELECT DISTINCT n FROM ig),
dw AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
h AS (SELECT dw.doc_id, dw.i, dw.n, ig.item_id FROM dw JOIN ig ON ig.n = dw.n AND ig.g = array_to_string(dw.w[dw.i:dw.i + dw.n - 1], ' ')),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id),
dt AS (SELECT doc_id, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS p FROM d),
cnt AS (SELECT term, count(*) AS c FROM dt GROUP BY term),
wk AS (SELECT item_id, w, n, i, unnest(range(i, i + n)) AS k FROM iw),
rk AS (SELECT item_id, w, n, i, k, term, row_number() OVER (PARTITION BY item_id, w, i ORDER BY c, k) AS r
       FROM (SELECT *, w[k] AS term FROM wk) JOIN cnt USING (term)),
pr AS (SELECT a.item_id, a.w, a.n, a.i, a.k AS p1, a.term AS t1, b.k AS p2, b.term AS t2
       FROM rk a LEFT JOIN rk b ON b.item_id = a.item_id AND b.w = a.w AND b.i = a.i AND b.r = 2 WHERE a.r = 1),
pl AS (SELECT DISTINCT x.doc_id, x.p, pr.item_id, pr.w, pr.n, pr.i, pr.p1 FROM pr JOIN dt x ON x.term = pr.t1
       JOIN dt y ON y.doc_id = x.doc_id AND y.term = pr.t2 AND y.p <> x.p AND abs(y.p - x.p - (pr.p2 - pr.p1)) <= 2
       UNION ALL SELECT x.doc_id, x.p, pr.item_id, pr.w, pr.n, pr.i, pr.p1 FROM pr JOIN dt x ON x.term = pr.t1 WHERE pr.t2 IS NULL),
pk AS (SELECT *, w[k] AS term, p + k - p1 + unnest(range(-2, 3)) AS q FROM (SELECT *, unnest(range(i, i + n)) AS k FROM pl)),
pc AS (SELECT pk.doc_id, pk.p, item_id, w, n, i, count(DISTINCT k) AS held FROM pk JOIN dt ON dt.doc_id = pk.doc_id AND dt.term = pk.term
       AND dt.p = pk.q GROUP BY pk.doc_id, pk.p, item_id, w, n, i),
ni AS (SELECT doc_id, count(*) AS n_near, string_agg(s, ',' ORDER BY s) AS s FROM
       (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM pc WHERE 4 * held >= 3 * n) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(hw.n_hit, 0) AS n_hit, coalesce(hi.n_items, 0) AS n_items,
  sha256(coalesce(hi.s, '')) AS items_sha256, coalesce(hw.n_hit, 0) > 0 AND 20 * coalesce(hw.n_hit, 0) >= len(d.w) AS contaminated,
  coalesce(ni.n_near, 0) AS n_near_items, sha256(coalesce(ni.s, '')) AS near_items_sha256
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id) LEFT JOIN ni USING (doc_id)
"""

OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
m AS (SELECT k, min(doc_id) AS low FROM g GROUP BY k HAVING count(*) > 1),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM g JOIN m USING (k) WHERE low < doc_id),
rr AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM r GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM
      (SELECT d.doc_id, unnest(d.w) AS x, unnest(range(1, len(d.w) + 1)) AS p FROM d JOIN rr USING (doc_id)) a
      ANTI JOIN r ON r.doc_id = a.doc_id AND r.p = a.p GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(rr.n, 0) AS n_removed,
  sha256(CASE WHEN rr.n IS NULL THEN array_to_string(d.w, ' ') ELSE coalesce(kept.t, '') END) AS kept_sha256
FROM d LEFT JOIN rr USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


OP12_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""

OP13_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY doc_id, term),
al AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS wgt
       FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), al),
m AS (SELECT doc_id, 100 - 90 + ((90 * len(w) * n_docs) // n_terms) AS m FROM d, al WHERE len(w) > 0),
sc AS (SELECT b.item_id, tf.doc_id, sum(wgt * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
       FROM b JOIN tf USING (term) JOIN wt USING (term) JOIN m USING (doc_id) GROUP BY b.item_id, tf.doc_id)
SELECT item_id, CAST(rk AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rk FROM sc WHERE score > 0)
WHERE rk <= 10
"""


def llm_sql() -> dict[str, str]:
    return {"op7_benchmark_decontamination": OP7_SQL, "op10_substring_dedup": OP10_SQL,
            "op12_exact_dedup": OP12_SQL, "op13_lexical_search": OP13_SQL}
