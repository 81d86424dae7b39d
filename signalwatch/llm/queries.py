"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.llm import (
    bpe, chat_tree, chosen_path, compression_rules, ecoc_lang, lattice_lm, merkle, packing, projections, quality_gam, ranked_search,
    token_count, toxicity,
)
from signalwatch.llm.common import bucket, read


def op1_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marginal lattice probability of every document; crc32 mod 7 = 2 is held out."""
    docs = read(spark, sf_dir, "documents")
    got = lattice_lm.score(docs, bucket(7) != 2, public_tokenizers.path("piece_bpe_32k.model"))
    return got.withColumn("held_out", ~F.col("train")).drop("train")


def op2_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.95 or more between all vectors, by collision counting over projections."""
    return projections.near_duplicates(read(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by error-correcting output codes; crc32 mod 5 = 0 is held out."""
    docs = read(spark, sf_dir, "documents")
    model = ecoc_lang.fit(docs.filter(bucket(5) != 0))
    return ecoc_lang.identify(docs, model).withColumn("held_out", bucket(5) == 0)


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE ids of every document by batched merge rounds, decoded again."""
    return bpe.round_trip_digests(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the counterfactual-regularised classifier; crc32 mod 3 = 1 is held out."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(bucket(3) != 1))
    return toxicity.score(docs, model).withColumn("held_out", bucket(3) == 1)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document by heap-and-linked-list merging."""
    return token_count.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the additive model with interactions; crc32 mod 4 = 2 is held out."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = quality_gam.fit(docs, labels.filter(bucket(4) != 2))
    return quality_gam.score(docs, model).withColumn("held_out", bucket(4) == 2)


def op8_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and compression verdict of every document."""
    return compression_rules.apply_rules(read(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of at most 2048 tokens."""
    pieces = packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of five-word shingle sets with a Jaccard similarity of 0.8 or more between all documents."""
    return chosen_path.join(read(spark, sf_dir, "documents")).drop("text_hash")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; a third of the ids is tampered with and verified."""
    docs = read(spark, sf_dir, "documents")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.col("doc_id").isNotNull() & (bucket(3) == 0)
    changed = F.when(hit, merkle.leaf_hash([lower if c == "text" else F.col(c) for c in merkle.FIELDS]))
    rows = merkle.manifest(docs, carried={"tampered_leaf": changed})
    rows = rows.withColumn("folded_root", merkle.folded(F.coalesce("tampered_leaf", "leaf"), F.col("proof")))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.all_siblings(F.col("proof")), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item, by NRA over impact-sorted lists."""
    return ranked_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


#: The conversation that the contract adds.
EXTRA = "\\### Assistant: </turn> ok"


def op13_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one with control strings in it, formatted as a prefix tree and read back from it."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA).alias("text"))
    tree = chat_tree.ChatTree(rows.unionByName(extra), public_tokenizers.path("byte_bpe_50k.json"))
    return chat_tree.for_members(tree, chat_tree.read_back(tree)).drop("leaf")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_lattice_lm, op2_embedding_near_dup, op3_language_id, op4_bpe_round_trip, op5_toxicity, op6_token_counts, op7_quality,
             op8_compression_bands, op9_packing, op10_ngram_jaccard, op11_merkle_manifest,
             op12_ranked_search, op13_chat_tree]
    return {f.__name__: f for f in found}


#: All pairs of vectors; the least id reachable by links.
NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) >= 0.95 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))),
same AS (
  SELECT a.vec_id, min(b.vec_id) AS class_id FROM v a JOIN v b ON a.e = b.e GROUP BY a.vec_id),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT e.vec_id, coalesce(any_value(s.class_id), e.vec_id) AS class_id,
       (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
       min(r.b) AS component_id, min(r.b) = e.vec_id AS kept
FROM embeddings e JOIN reach r ON r.a = e.vec_id LEFT JOIN same s ON s.vec_id = e.vec_id GROUP BY e.vec_id"""

#: All pairs of documents that share a shingle, counted; the least id reachable by links.
NEAR_DOCUMENTS = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b, shared_n = na AND shared_n = nb AS same_set
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared_n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN (SELECT doc_id AS a, n AS na FROM sizes) USING (a) JOIN (SELECT doc_id AS b, n AS nb FROM sizes) USING (b)
  WHERE 5 * shared_n >= 4 * (na + nb - shared_n)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, least(d.doc_id, (SELECT min(l.b) FROM links l WHERE l.a = d.doc_id AND l.same_set)) AS class_id,
       (SELECT count(*) FROM links l WHERE l.a = d.doc_id) AS n_links, min(r.b) AS component_id, min(r.b) = d.doc_id AS kept
FROM documents d JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id"""


#: The CRC32 of a text of ASCII digits, bit by bit.
CRC32 = """(SELECT xor(4294967295::UBIGINT, list_reduce(list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT),
  lambda acc, c: list_reduce(list_transform(range(8), lambda k: 0::UBIGINT),
    lambda x, k: xor(x >> 1, 3988292384::UBIGINT * (x & 1)), xor(acc, c)), 4294967295::UBIGINT)))"""

#: Levels of all trees from the leaves on, in one recursion over the nodes of each; siblings of every node on the way.
MERKLE = """
WITH RECURSIVE f AS (
  SELECT doc_id, lang, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM documents),
h AS MATERIALIZED (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN doc_id IS NOT NULL AND CRC % 3 = 0 THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) END AS tampered
  FROM f),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
         dense_rank() OVER (ORDER BY lang IS NOT NULL, encode(coalesce(lang, ''))) - 1 AS tree FROM h),
nodes AS (
  SELECT 0 AS level, tree, pos, leaf AS node, n FROM leaves
  UNION ALL
  SELECT any_value(level) + 1, tree, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), any_value((n + 7) // 8)
  FROM nodes WHERE n > 1 GROUP BY tree, pos // 8),
kept AS MATERIALIZED (SELECT * FROM nodes),
subroots AS MATERIALIZED (SELECT tree AS pos, node, count(*) OVER () AS n FROM kept WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, node, n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), any_value((n + 7) // 8) FROM tops WHERE n > 1 GROUP BY pos // 8),
top_nodes AS MATERIALIZED (SELECT * FROM tops),
place AS (
  SELECT tree, pos AS leaf_pos, 0 AS level, pos, n FROM leaves
  UNION ALL SELECT tree, leaf_pos, level + 1, pos // 8, (n + 7) // 8 FROM place WHERE n > 1),
top_place AS (
  SELECT pos AS tree, 0 AS level, pos, n FROM subroots
  UNION ALL SELECT tree, level + 1, pos // 8, (n + 7) // 8 FROM top_place WHERE n > 1),
low_runs AS (
  SELECT p.tree, p.leaf_pos, p.level, coalesce(string_agg(k.node, '' ORDER BY k.pos) FILTER (k.pos < p.pos), '') AS l,
         coalesce(string_agg(k.node, '' ORDER BY k.pos) FILTER (k.pos > p.pos), '') AS r
  FROM place p JOIN kept k ON k.tree = p.tree AND k.level = p.level AND k.pos // 8 = p.pos // 8 WHERE p.n > 1 GROUP BY ALL),
high_runs AS (
  SELECT p.tree, p.level, coalesce(string_agg(k.node, '' ORDER BY k.pos) FILTER (k.pos < p.pos), '') AS l,
         coalesce(string_agg(k.node, '' ORDER BY k.pos) FILTER (k.pos > p.pos), '') AS r
  FROM top_place p JOIN top_nodes k ON k.level = p.level AND k.pos // 8 = p.pos // 8 WHERE p.n > 1 GROUP BY ALL),
runs AS (
  SELECT tree, leaf_pos, level, l, r FROM low_runs
  UNION ALL SELECT p.tree, p.pos, 1000 + h.level, h.l, h.r FROM leaves p JOIN high_runs h ON h.tree = p.tree),
proofs AS (
  SELECT tree, leaf_pos, list({'l': l, 'r': r} ORDER BY level) AS steps, sha256(string_agg(l || r, '' ORDER BY level)) AS proof_sha256
  FROM runs GROUP BY tree, leaf_pos),
done AS (
  SELECT x.doc_id, x.leaf, s.node AS subroot, (SELECT node FROM top_nodes WHERE n = 1) AS root,
         coalesce(p.proof_sha256, sha256('')) AS proof_sha256, coalesce(x.tampered, x.leaf) AS start, coalesce(p.steps, []) AS steps
  FROM leaves x JOIN subroots s ON s.pos = x.tree LEFT JOIN proofs p ON p.tree = x.tree AND p.leaf_pos = x.pos)
SELECT doc_id, leaf, subroot, root, proof_sha256,
       list_reduce(list_transform(steps, lambda s: s.l || ' ' || s.r), lambda acc, s: sha256(split_part(s, ' ', 1) || acc || split_part(s, ' ', 2)), start) AS folded_root,
       folded_root = root AS verified
FROM done""".replace("CRC %", CRC32.format("doc_id") + " %")


#: All scores of all documents that share a term with an item.
RANKED = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents),
sizes AS (SELECT row, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM sizes),
tf AS MATERIALIZED (SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * (SELECT docs FROM total) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf GROUP BY term),
items AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM benchmark),
q AS (SELECT item, item_id, term, count(*)::BIGINT AS times FROM (SELECT item, item_id, unnest(t) AS term FROM items) GROUP BY ALL),
scores AS (
  SELECT item, item_id, row, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * (SELECT docs FROM total)) // (SELECT length FROM total)))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN sizes USING (row) GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0) WHERE rank <= 10"""


#: Digests of the conversations' own rows; the length of a formatted text from that of its escaped parts.
CHATS = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, CASE t WHEN 0 THEN 'user' ELSE 'assistant' END, '\\### Assistant: </turn> ok' FROM range(2) r(t)),
longer AS (
  SELECT *, len(text) - len(replace(text, '\\', '')) + len(regexp_extract_all(text, '<turn>|</turn>|### Assistant:|### User:|### System:|<[|]')) AS more
  FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(len('<turn>') + len(role) + 1 + len(text) + more + len('</turn>') + 1)::BIGINT AS formatted_chars
FROM longer GROUP BY conv_id"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express; the others rest on models, tokenizers or compression."""
    return {"op2_embedding_near_dup": NEAR_VECTORS, "op10_ngram_jaccard": NEAR_DOCUMENTS, "op11_merkle_manifest": MERKLE,
            "op12_ranked_search": RANKED, "op13_chat_tree": CHATS}
