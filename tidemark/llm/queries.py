"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.alignment import align
from tidemark.llm.bpe import encode_digest
from tidemark.llm.chat import chat_digest
from tidemark.llm.decontaminate import contamination_digest
from tidemark.llm.frames import kept
from tidemark.llm.language import languages
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.pii import pii_digest
from tidemark.llm.repeats import repeated_bytes
from tidemark.llm.token_counts import token_counts
from tidemark.llm.token_files import token_file_digest
from tidemark.llm.topk import top_k
from tidemark.llm.toxicity import toxicity
from tidemark.llm.turn_trie import prefix_trie

TOKEN_LIMIT = 4096
END_ID = 2
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"), lambda found: kept(found, "pii"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    roles = F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role"))))
    own = spark.range(1).select(roles.alias("r")).select(F.lit(-1).cast("long").alias("conv_id"), F.col("r.turn").cast("long").alias("turn"), "r.role", F.lit(CONTROL_TEXT).alias("text"))
    return chat_digest(turns.unionByName(own))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), END_ID)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("node0", "node1")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        *(op1_pii, op2_chat_format, op3_toxicity, op4_exact_top_k, op5_token_counts, op6_near_duplicates, op7_decontaminate),
        *(op8_bpe, op9_token_files, op10_repeats, op11_language, op12_alignment, op13_turn_trie),
    )
}

OP2_SQL = r"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) AS r(k)
), turns AS (
  SELECT *, length(regexp_replace(text, '(<</?SYS>>|\[/?INST\]|</?s>|\[/?ROLE\])', '\\\1', 'g'))
    + CASE role WHEN 'system' THEN 7 + 8 WHEN 'user' THEN 6 + 7 WHEN 'assistant' THEN 3 + 4 END + 3 AS size,
    CASE WHEN turn_before IS NULL THEN role IN ('system', 'user') WHEN turn_before = 'user' THEN role = 'assistant' ELSE role = 'user' END AS in_order
  FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS turn_before FROM every)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars, bool_and(in_order) AS valid
FROM turns GROUP BY conv_id
"""

OP7_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents
), item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item, n, array_to_string(words[k : k + n - 1], ' ') AS said
  FROM (SELECT item, words, least(10, len(words)) AS n, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS k FROM item_words WHERE len(words) > 0)
), places AS (
  SELECT d.doc_id, k, n, array_to_string(d.words[k : k + n - 1], ' ') AS said
  FROM (SELECT DISTINCT n FROM windows), doc_words d, unnest(range(1, len(d.words) - n + 2)) AS r(k)
), found AS (SELECT p.doc_id, p.k, p.n, w.item FROM places p JOIN windows w USING (n, said)),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS j FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id))
WHERE rank <= 20
"""

OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[k : k + 2], ' ') AS said
  FROM words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS r(k) WHERE len(words) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shingles a JOIN shingles b USING (said) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)
), reach AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT doc_id, b FROM reach JOIN links ON other = a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, low) AS component_id, doc_id = least(doc_id, low) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY 1) USING (doc_id)
"""

# The checksum is computed bit by bit: 3988292384 is the reversed polynomial of crc32.
OP13_SQL = """
WITH ids AS (
  SELECT c, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda x, b: list_reduce(list_concat([xor(x, b)], range(8)), lambda y, i: xor(y >> 1, CASE WHEN y % 2 = 1 THEN 3988292384 ELSE 0 END)))) % 9 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL)
), turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    sha256(coalesce(role, '')) || sha256(coalesce(text, '')) AS said, strlen(coalesce(text, '')) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (SELECT c, count(*) AS n FROM turns GROUP BY c),
rebuilt AS (
  SELECT i.c, b.k AS depth, said, bytes FROM ids i JOIN turns b ON b.c = i.c - i.c % 5 AND b.k <= h
  UNION ALL
  SELECT i.c, least(h, coalesce(n, 0)) + k - h, said, bytes
  FROM ids i JOIN turns t ON t.c = i.c AND t.k > h LEFT JOIN sizes s ON s.c = i.c - i.c % 5
), paths AS (
  SELECT c, depth, sha256(string_agg(said, '') OVER (PARTITION BY c ORDER BY depth)) AS path, bytes FROM rebuilt
  UNION ALL SELECT c, 0, '', 0 FROM ids
), lengths AS (SELECT c, max(depth) AS n FROM paths GROUP BY c),
nodes AS (
  SELECT path, depth, min(p.c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved, bool_and(n = depth) AS leaf,
    sha256(coalesce(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (n = depth), '')) AS ends_sha256
  FROM paths p JOIN lengths l ON l.c = p.c GROUP BY path, depth
), above AS (
  SELECT v.path AS below, v.depth AS d, p.path, p.depth, v.saved, v.leaf FROM nodes v JOIN paths p ON p.c = v.conv_id AND p.depth <= v.depth
)
SELECT u.conv_id, u.depth, max(o.conv_id) AS parent_conv_id, any_value(u.n_convs) AS n_convs, any_value(s.n_children) AS n_children,
  any_value(s.n_leaves) AS n_leaves, any_value(s.saved_tokens) AS saved_tokens, any_value(u.ends_sha256) AS ends_sha256
FROM nodes u
JOIN (SELECT path, depth, CAST(count_if(d = depth + 1) AS BIGINT) AS n_children, CAST(count_if(leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM above GROUP BY path, depth) s ON s.path = u.path AND s.depth = u.depth
LEFT JOIN above a ON a.below = u.path AND a.d = u.depth AND a.depth = u.depth - 1
LEFT JOIN nodes o ON o.path = a.path AND o.depth = a.depth
GROUP BY u.conv_id, u.depth
"""

ORACLE_SQL: dict[str, str] = {"op13_turn_trie": OP13_SQL, "op6_near_duplicates": OP6_SQL, "op4_exact_top_k": OP4_SQL, "op2_chat_format": OP2_SQL, "op7_decontaminate": OP7_SQL}
