"""Registered queries of the text operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from areastats.llm.common import table
from areastats.llm.decontam import find_leaks
from areastats.llm.disclosure import personal_data_report
from areastats.llm.importance import importance_draw
from areastats.llm.jaccard_join import near_documents
from areastats.llm.language import predict_language
from areastats.llm.license_scan import license_report
from areastats.llm.line_dedup import line_report
from areastats.llm.near_vectors import near_duplicates
from areastats.llm.prefix_trie import prefix_trie
from areastats.llm.quality import quality_scores
from areastats.llm.sharding import shard_documents
from areastats.llm.token_files import read_digests, write_token_files
from areastats.llm.unigram import encode_pieces, read_pieces
from areastats.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op2_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_report(table(spark, sf_dir, "documents"), context=None)


@query
def op3_unigram_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = read_pieces(public_tokenizers.path("piece_bpe_32k.model"), scores="ranks")
    coded = encode_pieces(table(spark, sf_dir, "documents"), pieces, with_ids=False)
    text = F.crc32(F.col("text").cast("binary"))
    return coded.select("doc_id", "n_tokens", "n_bytes", "ids_crc32", text.alias("text_crc32"), "round_trip")


@query
def op4_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


@query
def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_subspace_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(table(spark, sf_dir, "documents"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_language(table(spark, sf_dir, "documents"))


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "tokens")
    tokenizer = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer)
    return read_digests(spark, path)


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


@query
def op12_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


SQL["op8_line_dedup"] = r"""
WITH cut AS (
  SELECT doc_id, text,
         string_split(regexp_replace(text, '(\n|[.!?] )', '\1' || chr(1), 'g'), chr(1)) AS l
  FROM documents),
w AS (
  SELECT doc_id, unnest(range(0, len(l) - 2)) AS pos, [trim(x, E' \t\r\n') FOR x IN l] AS t FROM cut WHERE len(l) >= 3),
k AS (
  SELECT doc_id, pos, md5(t[pos + 1] || chr(1) || t[pos + 2] || chr(1) || t[pos + 3]) AS key
  FROM w WHERE t[pos + 1] || t[pos + 2] || t[pos + 3] <> ''),
f AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY key ORDER BY doc_id, pos) AS r FROM k),
c AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM f WHERE r > 1),
g AS (SELECT doc_id, list(pos) AS removed FROM c GROUP BY doc_id)
SELECT doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(removed), 0)::BIGINT AS n_removed,
       CASE WHEN removed IS NULL THEN text ELSE
         array_to_string([l[i] FOR i IN range(1, len(l) + 1) IF NOT list_contains(removed, i - 1)], '') END AS text
FROM cut LEFT JOIN g USING (doc_id)
"""

_COMPONENTS = """
reach(id, other) AS (SELECT x, y FROM links UNION SELECT r.id, l.y FROM reach r JOIN links l ON l.x = r.other),
lowest AS (SELECT id, least(id, min(other)) AS low FROM reach GROUP BY id)"""

SQL["op6_subspace_pigeonhole"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
          ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
{_COMPONENTS},
n AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(low, vec_id) AS component_id, coalesce(low, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN lowest ON id = vec_id
"""
SQL["op7_jaccard_join"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 3, 2))
                                    IF len(w) > 0]) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
{_COMPONENTS}
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(low, doc_id) AS component_id FROM s LEFT JOIN lowest ON id = doc_id
"""


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text."""
    byte = f"[('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT FOR i IN range(strlen({text}))]"
    bits = "list_reduce(list_prepend(xor(a, b), range(8)), lambda y, k: xor(y >> 1, 3988292384 * (y & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda a, b: {bits}), 4294967295)"


SQL["op12_importance_draw"] = rf"""
WITH f AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents),
a AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
w AS (SELECT w, {_crc32("w")} % 10000 AS bucket FROM (SELECT w FROM f UNION SELECT w FROM a)),
s AS (SELECT bucket, count(*) AS s FROM f JOIN w USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM a JOIN w USING (w) GROUP BY bucket),
g AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + 10000)::DOUBLE
                                 / ((s + 1)::DOUBLE * ((SELECT count(*) FROM a) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
d AS (
  SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM f JOIN w USING (w) JOIN g USING (bucket) GROUP BY doc_id),
c AS (
  SELECT doc_id, coalesce(n, 0) AS n, coalesce(weight, 0) AS weight,
         ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h FROM documents LEFT JOIN d USING (doc_id)),
e AS (SELECT doc_id, n, weight, weight + floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score FROM c),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS many FROM e WHERE n >= 20)
SELECT doc_id, n::BIGINT AS n_features, weight, score, CASE WHEN r <= many * 10 // 100 THEN r END AS rank
FROM e LEFT JOIN r USING (doc_id)
"""

SQL["op13_prefix_trie"] = rf"""
WITH c AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST,
                       sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, own, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM c),
b AS (
  SELECT h.conv_id, list_concat(coalesce(s.own, [])[1:h.h], h.own[h.h + 1:]) AS p
  FROM h LEFT JOIN c s ON s.conv_id = h.conv_id - h.conv_id % 20),
n AS (SELECT conv_id, len(p) AS size, p, unnest(range(len(p) + 1)) AS d FROM b),
k AS (
  SELECT conv_id, size, d, to_json(p[1:d]) AS key, CASE WHEN d > 0 THEN to_json(p[1:d - 1]) END AS up,
         CASE WHEN d > 0 THEN len(regexp_extract_all(p[d].t, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM n),
m AS (
  SELECT key, any_value(up) AS up, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '') AS ends
  FROM k GROUP BY key),
kids AS (SELECT up AS key, count(*) AS n FROM m WHERE up IS NOT NULL GROUP BY up),
sums AS (
  SELECT k.key, sum(m.saved) AS saved, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM m JOIN k ON k.conv_id = m.conv_id AND k.d <= m.d LEFT JOIN kids ON kids.key = m.key GROUP BY k.key)
SELECT m.conv_id, m.d::BIGINT AS depth, u.conv_id AS parent_conv_id, m.n_convs::BIGINT AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
       sums.leaves::BIGINT AS n_leaves, sums.saved::BIGINT AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN sums USING (key) LEFT JOIN kids ON kids.key = m.key LEFT JOIN m u ON u.key = m.up
"""
