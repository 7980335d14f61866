"""Registered queries of the text operators and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, byte_pairs, decision_list, hard_negatives, language, mixing, radix, repeats, secret_spans, simhash, token_counts, toxicity
from .common import documents, embeddings, labels

WORD_FILE, BYTE_FILE = "word_bpe_49k.json", "byte_bpe_50k.json"
RANK_FILE, PIECE_FILE = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.quality(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans.secret_spans(documents(spark, sf_dir), keep=["doc_id"])

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(secret_spans.listed(base), 256).alias("base_sha256"),
        secret_spans.listed(F.col("spans")).alias("spans"),
    )


TOXIC_FROM = 0.7


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = language.held_out(F.col("doc_id"), 3, 1)
    scored = toxicity.toxicity(documents(spark, sf_dir), labels(spark, sf_dir).filter(~own), keep=["doc_id"])
    return scored.select(
        "doc_id", own.alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= TOXIC_FROM).cast("int").alias("predicted"), "toxic_words"
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(WORD_FILE))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    own = language.held_out(F.col("doc_id"), 5, 0)
    found = language.identify(docs, docs.filter(~own).select("lang", "text"), keep=["doc_id"])
    first = F.try_element_at("languages", F.lit(1))
    return found.select(
        "doc_id", own.alias("held_out"), F.coalesce(first["lang"], F.lit(language.UNKNOWN)).alias("lang_pred"), F.coalesce(first["share"], F.lit(0.0)).alias("score"),
        F.transform("languages", lambda x: x["lang"]).alias("languages"),
    )


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix.exact_groups(documents(spark, sf_dir))


OP9_SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(length(text), 0) AS chars, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body
  FROM documents
)
SELECT doc_id,
  first_value(doc_id) OVER best AS keep_id,
  count(*) OVER (PARTITION BY body) AS group_size,
  row_number() OVER best = 1 AS kept,
  sha256(body) AS text_sha256
FROM texts
WINDOW best AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_FILE)
    encoded = bpe.encode(documents(spark, sf_dir), path, keep=["doc_id"])
    decoded = bpe.decode(encoded.withColumn("ids_sha256", F.sha2("ids", 256)), path, keep=["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(embeddings(spark, sf_dir), label=label)


OP11_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
WINDOW best AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER best <= 10
"""


def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANK_FILE)
    decoded = byte_pairs.decode(byte_pairs.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN, keep=["doc_id"]), path)
    decimals = F.sequence(F.lit(0), F.lit(len(byte_pairs.read_ranks(path)["tokens"]) - 1)).cast("array<string>")  # a literal once planned
    shown = F.array_join(F.transform("ids", lambda i: F.get(decimals, i)), " ")
    return decoded.select("doc_id", "n_tokens", F.sha2(shown, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of groups is stored as its digest."""
    digest = lambda g: F.when(g == "", "").otherwise(F.sha2(g, 256))
    paths = public_tokenizers.path(BYTE_FILE), public_tokenizers.path(PIECE_FILE)
    aligned = alignment.align(documents(spark, sf_dir), *paths, keep=["doc_id"], groups=digest)
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_secrets": op3_secrets,
    "op4_toxicity": op4_toxicity,
    "op5_token_counts": op5_token_counts,
    "op6_mixing": op6_mixing,
    "op7_language": op7_language,
    "op8_repeats": op8_repeats,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_bpe": op10_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_byte_pairs": op12_byte_pairs,
    "op13_alignment": op13_alignment,
}
ORACLES = {"op9_exact_dedup": OP9_SQL, "op11_hard_negatives": OP11_SQL}
