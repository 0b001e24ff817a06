"""The registered queries of the operators in this folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.bpe import token_digests
from tidemill.llm.hard_negatives import hard_negatives
from tidemill.llm.language_id import fit, held_out, label_languages
from tidemill.llm.minhash import near_duplicates
from tidemill.llm.mixing import mix_sources
from tidemill.llm.oracle import DECONTAMINATION, HARD_NEGATIVES, LEXICAL_SEARCH, NEAR_TEXTS, NEAR_VECTORS, SOURCE_MIX, TOP_K
from tidemill.llm.personal_data import personal_data_digests
from tidemill.llm.projection_dedup import near_duplicate_vectors
from tidemill.llm.repeated_spans import remove_repeats
from tidemill.llm.secret_scan import secret_digests
from tidemill.llm.signature_search import search
from tidemill.llm.threshold_topk import top_k
from tidemill.llm.winnowing import decontaminate
from tidemill.llm.token_counts import count_tokens

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(_table(spark, sf_dir, "documents"), BYTE_BPE)


MIX_WEIGHTS = {"domain": {"dom0": 4, "dom1": 3, "dom2": 2, "dom3": 1}, "language": {"en": 5, "de": 2, "fr": 2, "es": 1}, "source": {}}
MIX_SEED, MIX_EPOCHS = 17, 3


def source_domain() -> Column:
    """The tables name no domain: sources are dealt into four by their number."""
    return F.concat(F.lit("dom"), F.coalesce(F.expr("cast(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '') as int)"), F.lit(0)) % 4)


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    half = F.expr("total div 2")
    mixed = mix_sources(docs, source_domain(), half, MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED)
    return mixed.select("doc_id", "lang", "source", "epoch")


def op7_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), length=400).drop("kept")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), BYTE_BPE, limit=512)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), words_each=3, percent=85).drop("text_hash")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    kept_out = held_out(F.col("doc_id"))
    net = fit(docs.where(~kept_out))
    return label_languages(docs.select("doc_id", "text"), net).select(
        "doc_id", kept_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digests(_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(_table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(_table(spark, sf_dir, "embeddings"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_personal_data": op2_personal_data,
    "op3_secret_scan": op3_secret_scan,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_source_mix": op6_source_mix,
    "op7_repeated_spans": op7_repeated_spans,
    "op8_token_counts": op8_token_counts,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_decontamination": op12_decontamination,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op4_embedding_near_dedup": NEAR_VECTORS,
    "op6_source_mix": SOURCE_MIX,
    "op9_exact_top_k": TOP_K,
    "op10_minhash_near_dedup": NEAR_TEXTS,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_decontamination": DECONTAMINATION,
    "op13_lexical_search": LEXICAL_SEARCH,
}
