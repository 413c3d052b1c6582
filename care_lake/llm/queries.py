"""One query per operator, each over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from care_lake.llm import alignment, embedding_dedup, lines, minhash, neighbours, packing, pieces, pii, prefix_trie, secrets, sharding, token_files, toxicity
from care_lake.llm.common import table
from care_lake.session import shared_folder

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.span_digest(secrets.find_secrets(table(spark, sf_dir, "documents")), secrets.KINDS, 3)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.span_digest(pii.personal_spans(table(spark, sf_dir, "documents")), pii.KINDS, 4)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.read_model(PIECE_MODEL)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = pieces.decode(pieces.encode(docs, model).select("doc_id", "ids"), model)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(table(spark, sf_dir, "documents"), packing.read_tokenizer(WORD_TOKENIZER)))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_components(table(spark, sf_dir, "embeddings"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.drop_lines(docs, lines.line_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.with_scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleaved_shards(table(spark, sf_dir, "documents"), n_shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/token-files/{uuid.uuid4().hex}"
    token_files.write_tokens(table(spark, sf_dir, "documents"), packing.read_tokenizer(WORD_TOKENIZER), folder)
    return token_files.token_digests(spark, folder)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ranked_turns(table(spark, sf_dir, "conversations"))
    opens_as, shared = F.expr("seq - seq % 5"), F.crc32(F.col("seq").cast("string").cast("binary")) % 9
    return prefix_trie.prefix_trie(*prefix_trie.with_shared_openings(turns, opens_as, shared, longest=8))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.alignment_statistics(docs, packing.read_tokenizer(BYTE_TOKENIZER), pieces.read_model(PIECE_MODEL))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_pii, op3_sentencepiece, op4_minhash_dedup, op5_packing, op6_embedding_dedup, op7_line_dedup,
    op8_toxicity, op9_nearest_neighbours, op10_sharding, op11_token_files,
    op12_prefix_trie, op13_alignment,
)}

_UPPER, _LOWER, _BLANKS = lines.UPPER, lines.LOWER, "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE = {
    "op7_line_dedup": f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), line AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS key FROM line
), shared AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    # CRC-32 bit by bit: a byte is added, then eight steps of the register follow
    "op12_prefix_trie": """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    md5(strlen(role) || ':' || role || text)) - 1 AS pos FROM turns
), ids AS (
  SELECT DISTINCT conv_id, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
    lambda x: [ascii(x)::BIGINT] || [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])) AS steps FROM turns
), heads AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce([4294967295::BIGINT] || steps, lambda c, x:
    CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295) % 9 AS h FROM ids
), parts AS (
  SELECT h.conv_id, 0 AS side, o.pos, o.role, o.text FROM heads h JOIN own o ON o.conv_id = h.base AND o.pos < h.h
  UNION ALL SELECT h.conv_id, 1, o.pos, o.role, o.text FROM heads h JOIN own o ON o.conv_id = h.conv_id AND o.pos >= h.h
), rebuilt AS (
  SELECT h.conv_id, coalesce(list({'r': p.role, 't': p.text} ORDER BY p.side, p.pos) FILTER (WHERE p.side IS NOT NULL), []) AS seq
  FROM heads h LEFT JOIN parts p ON p.conv_id = h.conv_id GROUP BY h.conv_id
), prefixes AS (
  SELECT conv_id, len(seq) AS size, unnest(generate_series(0, len(seq)))::BIGINT AS depth, seq FROM rebuilt
), named AS (
  SELECT conv_id, depth, size, list_slice(seq, 1, depth) AS prefix FROM prefixes
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256
  FROM named GROUP BY prefix, depth
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.prefix[-1].t) END AS saved,
    (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND list_slice(c.prefix, 1, n.depth) = n.prefix) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = list_slice(n.prefix, 1, n.depth - 1)
), below AS (
  SELECT list_slice(prefix, 1, d) AS prefix, saved, n_children FROM (SELECT *, unnest(generate_series(0, depth)) AS d FROM linked)
), sums AS (
  SELECT prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM below GROUP BY prefix
)
SELECT l.conv_id, l.depth, l.parent_conv_id, l.n_convs, l.n_children, s.n_leaves, s.saved_tokens, l.ends_sha256
FROM linked l JOIN sums s ON s.prefix = l.prefix""",
}
