"""A corpus made ready for training, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that
the stage before kept.  All but the last return the columns of ``documents``;
the last adds token ids.  Columns beyond those of ``documents`` travel through
every stage in one struct and come back unchanged, so that no name of the
caller's can clash with what a stage uses inside; ``encode`` refuses a table
that already holds a column it adds.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm import language_id, personal_data
from tidemill.llm.bpe import decode_ids, encode_texts
from tidemill.llm.minhash import near_duplicates
from tidemill.llm.mixing import mix_sources
from tidemill.llm.queries import BYTE_BPE, source_domain
from tidemill.session import scratch_path

MIN_LANGUAGE_SCORE = 0.35
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80
MIX_WEIGHTS = {"language": {"en": 5, "de": 2, "fr": 2, "es": 2}}
MIX_SEED = 29
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def carrying(stage):
    """The stage over the columns of ``documents``, the caller's other columns carried past it."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in DOCUMENT]
        if not others:
            return stage(spark, docs, sf_dir)
        carried = "_carried"
        while carried in docs.columns:
            carried += "_"
        slim = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c in DOCUMENT], F.struct(*[F.col(f"`{c}`") for c in others]).alias(carried))
        out = stage(spark, slim, sf_dir)
        added = [c for c in out.columns if c not in slim.columns]
        if clash := [c for c in added if c in docs.columns]:
            raise ValueError(f"stage {stage.__name__} adds columns that the table already holds: {clash}")
        back = [F.col(f"`{carried}`.`{c}`").alias(c) if c in others else F.col(f"`{c}`") for c in docs.columns]
        return out.select(*back, *[F.col(f"`{c}`") for c in added])

    return run


@carrying
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents without a letter or without a likely language go; a missing language is filled in."""
    labelled = language_id.label_languages(docs, language_id.fit(docs))
    sure = labelled.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("lang_score") >= MIN_LANGUAGE_SCORE))
    return sure.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


@carrying
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each group of near copies, and of repeated rows, one document stays."""
    judged = near_duplicates(docs, words_each=SHINGLE_WORDS, percent=SIMILARITY_PERCENT)
    told = judged.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.bool_or("kept").alias("_kept"), F.count("*").alias("_n")).where("not _kept or _n > 1")
    marked = docs.join(told, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left")
    nth = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", "lang"))
    return marked.where(F.coalesce("_kept", F.lit(True))).withColumn("_nth", nth).where("_nth = 1").select(*docs.columns)


@carrying
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: every span is replaced by the name of its kind."""
    found = personal_data.find_personal_data(docs, personal_data.fit(docs))
    clean = found.withColumn("text", personal_data.masked(F.col("text"), F.col("personal_data")))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@carrying
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: nine tenths of the tokens, by language weights, no document twice."""
    return mix_sources(docs, source_domain(), F.expr("total * 9 div 10"), MIX_WEIGHTS, max_epochs=1, seed=MIX_SEED, epoch=None)


@carrying
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: token ids, and whether they decode to the text they came from."""
    encoded = decode_ids(encode_texts(docs, BYTE_BPE), BYTE_BPE)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return encoded.select(*docs.columns, "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), same.alias("decodes"))


STAGES = [("language", language), ("near_dedup", near_dedup), ("personal_data", mask_personal_data), ("mix", mix), ("encode", encode)]

ORACLE_SQL = None
"""The learned and hashed stages have no SQL; tests hold each stage against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
