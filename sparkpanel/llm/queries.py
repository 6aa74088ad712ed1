"""The operators bound to the corpus tables, with SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkpanel.llm.bpe import bpe_decode, bpe_encode
from sparkpanel.llm.exact import exact_dedup
from sparkpanel.llm.language import fit_language, predict_language
from sparkpanel.llm.lm import fit_score, score_texts, word_counts
from sparkpanel.llm.minhash import near_duplicates
from sparkpanel.llm.negatives import hard_negatives
from sparkpanel.llm.packing import pack
from sparkpanel.llm.quality import fit_quality, predict_quality
from sparkpanel.llm.staging import new_path, small_batches
from sparkpanel.llm.substrings import drop_repeated_words
from sparkpanel.llm.suffixes import drop_repeated_bytes
from sparkpanel.llm.trie import ordered_turns, prefix_trie, with_shared_openings
from sparkpanel.llm.vectors import near_vectors
from sparkpanel.llm.warc import base32_sha1, read_warc, write_warc

QUERIES = {}
ORACLES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_col: str = "doc_id", folds: int = 5):
    """Whether a row is kept away from all learning."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs, "doc_id", "text", keep="max").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op9_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), "page_id", "html", path, uri_col="url", min_revisit_bytes=0)
    number = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    as_id = lambda c: F.when(number(c) != "", number(c).cast("long"))
    # A response's digest is that of the bytes read back; a revisit has the declared one alone.
    digest = F.coalesce(base32_sha1(F.col("payload")), F.substring_index("declared_digest", ":", -1))
    return read_warc(spark, path).select(
        as_id("record_id").alias("page_id"), "payload_bytes", digest.alias("payload_digest"), "record_type", as_id("refers_to").alias("refers_to")
    )


# No SQL: the archives are files; DuckDB has no base32 either. The tests compare with a plain reader.


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = pack(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), end_id=2, length=4096)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe_encode(docs, "text", ranks, public_tokenizers.PATTERN).drop("text")
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return bpe_decode(encoded, "ids", ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_words(docs, "doc_id", "text", window=50).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_bytes(docs, "doc_id", "text", length=400).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        # A cut may leave parts of a character, which are replaced here; the hash is that of the bytes.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
    )


@query
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return near_vectors(vectors, "vec_id", "embedding", cosine=0.9).select("vec_id", "n_links", "component_id", "kept")


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, "doc_id", "text", words=2, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    model = fit_language(docs.filter("not held_out"), "doc_id", "text", "lang")
    return predict_language(docs.select("doc_id", "held_out", "text"), "text", model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    model = fit_quality(docs.filter("not held_out"), labels, "doc_id", "text", "quality")
    scored = predict_quality(docs.select("doc_id", "held_out", "text"), "text", model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = ordered_turns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    taken = F.crc32(F.col("conv").cast("string")) % 6
    turns, convs = with_shared_openings(own, 100, taken, 5)
    return prefix_trie(turns, convs).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256"
    )


# The checksum of a decimal number, a bit at a time: 1 to 8 shifts follow each byte.
ORACLES["op11_conversation_trie"] = """
WITH RECURSIVE own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (
  SELECT c, count(*) AS n, c - c % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''),
             lambda x: [ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END), 4294967295::BIGINT) % 6 AS h
  FROM own GROUP BY c),
convs AS (
  SELECT s.c, s.base, s.h, least(s.h, coalesce(b.n, 0)) AS opened, least(s.h, coalesce(b.n, 0)) + greatest(s.n - s.h, 0) AS total
  FROM sizes s LEFT JOIN sizes b ON b.c = s.base),
turns AS (
  SELECT s.c, p, role, text FROM convs s JOIN own o ON o.c = s.base WHERE p <= h
  UNION ALL
  SELECT s.c, p - h + opened, role, text FROM convs s JOIN own o ON o.c = s.c WHERE p > h),
prefixes AS (
  SELECT c, 0 AS d, '' AS k, 0 AS chars FROM convs
  UNION ALL
  SELECT p.c, d + 1, k || length(role) || ':' || length(text) || ':' || role || text, length(text)
  FROM prefixes p JOIN turns t ON t.c = p.c AND t.p = d + 1),
nodes AS (
  SELECT k, d, min(p.c) AS c, count(*) AS n, min(chars) AS chars, coalesce(string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FILTER (d = total), '') AS ends,
         count(*) FILTER (d < total) = 0 AS leaf
  FROM prefixes p JOIN convs USING (c) GROUP BY k, d),
below AS (
  SELECT a.k, count(*) FILTER (b.leaf) AS n_leaves, sum((b.n - 1) * b.chars) AS saved, count(*) FILTER (b.d = a.d + 1) AS n_children
  FROM nodes b JOIN prefixes p ON p.c = b.c AND p.d <= b.d JOIN nodes a ON a.k = p.k GROUP BY a.k)
SELECT a.c AS conv_id, a.d::BIGINT AS depth, u.c AS parent_conv_id, a.n AS n_convs, n_children, n_leaves, saved::BIGINT AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM nodes a JOIN below w ON w.k = a.k LEFT JOIN prefixes q ON q.c = a.c AND q.d = a.d - 1 LEFT JOIN nodes u ON u.k = q.k
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    anchor = F.col("vec_id") % 50 == 0
    return hard_negatives(vectors.withColumn("label", label), "vec_id", "embedding", "label", anchor, scale=256.0)


ORACLES["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.id AS anchor_id, a.label = b.label AS alike, b.id, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON len(a.e) = len(b.e) WHERE a.id % 50 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE alike AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.id) QUALIFY row_number() OVER w <= 3
"""


@query
def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out(folds=10).alias("held_out"), "text")
    train = docs.filter("not held_out")
    counts = word_counts(train, "text")
    model = fit_score(train, "doc_id", "text", counts, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return score_texts(docs, "text", model, counts).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
