"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import (
    debruijn,
    decontamination,
    html_text,
    licences,
    line_runs,
    mixing,
    periodic,
    resampling,
    simhash,
    subword,
    token_counts,
    topk,
    turn_trie,
)
from shelfline.llm.common import ship, table


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_runs.line_dedup(table(spark, folder, "documents"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_merge_dropout(spark: SparkSession, folder: str) -> DataFrame:
    return subword.segmentations(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.decontamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return debruijn.substring_dedup(table(spark, folder, "documents"))


def op9_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


def op10_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licences(table(spark, folder, "documents"))


def op11_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(table(spark, folder, "documents"))


def op12_turn_trie(spark: SparkSession, folder: str) -> DataFrame:
    return turn_trie.prefix_trie(turn_trie.rebuilt(turn_trie.sequences(table(spark, folder, "conversations"))))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return periodic.digests(periodic.periodic(docs, periodic.planted(docs)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": op1_main_text,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_merge_dropout": op4_merge_dropout,
    "op5_quality": op5_quality,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_decontamination": op7_decontamination,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_licences": op10_licences,
    "op11_source_mix": op11_source_mix,
    "op12_turn_trie": op12_turn_trie,
    "op13_periodic_runs": op13_periodic_runs,
}


def _shipping(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipping(query) for name, query in QUERIES.items()}


ORACLE_SQL: dict[str, str] = {}

# Later copies of runs of two lines or more: a line goes if it starts or ends a pair of lines that stands earlier too.
# Later copies of a line that holds a word go on their own as well.
ORACLE_SQL["op2_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
pairs AS (
  SELECT doc_id, i, md5(s) || md5(lead(s) OVER (PARTITION BY doc_id ORDER BY i)) AS p FROM lines),
marked AS (
  SELECT doc_id, i, p IS NOT NULL AND row_number() OVER (PARTITION BY p ORDER BY doc_id, i) > 1 AS copied FROM pairs),
alone AS (
  SELECT doc_id, i, regexp_matches(s, '[^\x20\x09-\x0D]') AND row_number() OVER (PARTITION BY md5(s) ORDER BY doc_id, i) > 1 AS again FROM lines),
gone AS (
  SELECT doc_id, i, again OR copied OR coalesce(lag(copied) OVER (PARTITION BY doc_id ORDER BY i), false) AS removed
  FROM marked JOIN alone USING (doc_id, i)),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed,
    coalesce(string_agg(s, chr(10) ORDER BY i) FILTER (WHERE NOT removed), '') AS text
  FROM gone JOIN lines USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

# Windows of 13 words that start in a smaller document too; every word under one goes.
ORACLE_SQL["op8_substring_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 12, 0) + 1)) AS i FROM t),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM starts),
judged AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) < doc_id AS repeated FROM windows),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM judged WHERE repeated)),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM t),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(gone.p) AS n_removed,
    coalesce(string_agg(x, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL), '') AS text
  FROM words LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

ORACLE_SQL["op9_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""


# Every prefix of every rebuilt conversation, named by a digest; crc32 by its bitwise definition.
ORACLE_SQL["op12_turn_trie"] = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, CAST(conv_id AS VARCHAR) AS s FROM t),
crc AS (
  SELECT conv_id, base, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) AS c
  FROM ids),
h AS (SELECT conv_id, base, xor(c, 4294967295) % 9 AS h FROM crc),
r AS (
  SELECT h.conv_id, 0 AS part, pos, role, text FROM h JOIN t ON t.conv_id = h.base AND pos <= h
  UNION ALL SELECT h.conv_id, 1, pos, role, text FROM h JOIN t ON t.conv_id = h.conv_id AND pos > h),
d AS (SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS size, string_agg(md5(role) || md5(text), '') OVER w AS path
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
m AS (SELECT conv_id, depth, size, md5(path) AS k FROM d UNION ALL SELECT conv_id, 0, 0, '' FROM h),
linked AS (
  SELECT *, lag(k) OVER (PARTITION BY conv_id ORDER BY depth) AS up, lead(k) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS final FROM m),
nodes AS (
  SELECT k, max(up) AS up, max(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * max(size) AS own,
    sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE final), '')) AS ends
  FROM linked GROUP BY k),
kids AS (SELECT up AS k, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT m.k, count(*) FILTER (WHERE kids.k IS NULL) AS n_leaves, CAST(sum(own) AS BIGINT) AS saved_tokens
  FROM nodes x JOIN m ON m.conv_id = x.conv_id AND m.depth <= x.depth LEFT JOIN kids ON kids.k = x.k GROUP BY m.k)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, saved_tokens, x.ends AS ends_sha256
FROM nodes x LEFT JOIN nodes p ON p.k = x.up LEFT JOIN kids ON kids.k = x.k JOIN below ON below.k = x.k
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
