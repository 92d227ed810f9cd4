"""A training corpus in five stages: toxic documents go, one document of each near-duplicate group stays,
word sequences that stood earlier go, documents that hold benchmark items go, and the rest is encoded.

Every stage takes the documents that the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellroll.llm import bpe_codec, decontam, jaccard_join, substring_dedup, toxicity
from cellroll.llm.tables import read, saved, with_row_key


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; the model learns from ``labels``."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each component linked by a Jaccard similarity of 0.8 on five-word shingles."""
    docs, key = with_row_key(docs)
    groups = jaccard_join.near_duplicates(docs, words=5, percent=80, id_col=key)
    keep = groups.where("d = first").select(F.col("doc_id").alias(key))
    out = docs.join(keep, key, "left_semi")
    return out if key == "doc_id" else out.drop(key)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 20-word sequences that stand in an earlier document or earlier in the same one."""
    docs, key = with_row_key(docs)
    out = substring_dedup.drop_earlier(docs, key, size_col="n_chars" if "n_chars" in docs.columns else None)
    return out if key == "doc_id" else out.drop(key)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, up to a fifth of its words edited."""
    docs, key = with_row_key(docs)
    found = decontam.contaminated(docs, read(spark, sf_dir, "benchmark"), id_col=key)
    out = docs.join(found.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti")
    return out if key == "doc_id" else out.drop(key)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    return bpe_codec.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), digests=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("substring_dedup", drop_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("bpe_encode_decode", encode),
]

# trained scores, edit distances and byte-pair merges are not SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
