"""Registered queries of this subpackage and their DuckDB SQL, where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .bpe_codec import encode_decode
from .decontam import contaminated
from .divergence import ORACLE_SQL as DIVERGENCE_SQL
from .divergence import source_divergence
from .jaccard_join import join_report
from .langid_crf import language
from .license_scan import license_scan
from .license_scan import oracle_sql as license_sql
from .oracles import jaccard_sql, substring_sql, suffix_sql
from .phrases import collocations
from .phrases import oracle_sql as phrases_sql
from .substring_dedup import remove_earlier
from .suffix_dedup import remove_repeated
from .tables import read
from .token_counts import token_counts
from .toxicity import toxicity
from .va_topk import top_k
from .winnowing import fingerprint_report


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digests=True)


def op1_va_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), threshold=0.7)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_report(read(spark, sf_dir, "documents"), words=4, percent=85)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(read(spark, sf_dir, "documents"), length=400, digests=True)


def op6_langid_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language(read(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_earlier(read(spark, sf_dir, "documents"), length=20, digests=True)


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = collocations(read(spark, sf_dir, "documents"), longest=3, least=10, top=2000)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read(spark, sf_dir, "documents"), least=10, top=10)


def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_va_topk": op1_va_topk,
    "op2_toxicity": op2_toxicity,
    "op3_jaccard_join": op3_jaccard_join,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_langid_crf": op6_langid_crf,
    "op7_substring_dedup": op7_substring_dedup,
    "op4_bpe_codec": op4_bpe_codec,
    "op8_decontam": op8_decontam,
    "op9_token_counts": op9_token_counts,
    "op10_license_scan": op10_license_scan,
    "op11_phrases": op11_phrases,
    "op12_divergence": op12_divergence,
    "op13_winnowing": op13_winnowing,
}

ORACLES: dict[str, str] = {
    "op1_va_topk": """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
      WHERE q.vec_id % 50 = 0),
    r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op3_jaccard_join": jaccard_sql(4, 85),
    "op5_suffix_dedup": suffix_sql(400),
    "op7_substring_dedup": substring_sql(20),
    "op10_license_scan": license_sql(),
    "op11_phrases": phrases_sql(),
    "op12_divergence": DIVERGENCE_SQL,
}
