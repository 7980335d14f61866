"""From raw documents to token ids: toxic documents out, one of equal and of near-equal texts, a mix of sources, encoding.

Every stage reads what its predecessor wrote. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import bpe, language, mixing, radix, simhash, toxicity
from ebbtide.llm.common import Scratch, documents, labels, unused
from ebbtide.llm.queries import BYTE_FILE, TOXIC_FROM


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit; the weights are learned from labelled documents that are not held out."""
    known = labels(spark, sf_dir)
    score, words = unused(docs, "toxic_score"), unused(docs, "toxic_words")
    scored = toxicity.toxicity(docs, known.filter(~language.held_out(F.col("doc_id"), 3, 1)), out=(score, words))
    return scored.filter(F.col(score) < TOXIC_FROM).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return radix.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document (unsigned 32 bits, little-endian), and whether they decode to its text."""
    path = public_tokenizers.path(BYTE_FILE)
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text")), path)
    decoded = bpe.decode(encoded, path)
    return decoded.select("doc_id", "lang", "source", "n_tokens", "ids", (F.col("decoded") == F.col("text")).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("encoding", encode),
]

# Scores and draws are learned or hashed in ways that SQL cannot repeat.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    tables, docs = Scratch(spark, "pipeline"), documents(spark, sf_dir)
    previous = None
    for name, stage in STAGES:
        step = name.replace(" ", "-")
        docs = tables.write(stage(spark, docs, sf_dir), step)
        if previous:
            tables.drop(previous)
        previous = step
    return docs
