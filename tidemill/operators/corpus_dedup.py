"""Paragraphs repeated across documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.blank import let, strip


def dedup_corpus(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, text)`` with every paragraph kept only where it first occurs in the corpus, by id and place.

    Paragraphs are equal up to case and outer blanks, as within one text.  The
    first place of each is a minimum per hash, folded map-side, so a paragraph
    that a third of all documents share is one row per task.  Documents that
    lose all paragraphs stay, with an empty text.  A document is its id with
    its text: texts under one id stay apart (the earlier by text hash first),
    rows equal in both are copies that get the same text, and documents with
    a null id come after all others.
    """
    rows = documents.select(F.col(id_column).alias("id"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("t"))
    parts = rows.select("id", "th", F.posexplode(F.split(F.col("t"), fixed.PARAGRAPH_BREAK)).alias("at", "part"))
    keyed = parts.withColumn("key", F.lower(strip(F.col("part")))).where("key <> ''")
    # Places travel without their paragraphs: a text shuffles once, when it meets the places it keeps.
    place = F.struct(F.col("id").isNull().alias("late"), "id", "th", "at")
    firsts = keyed.groupBy(F.unhex(F.sha2("key", 256)).alias("hash")).agg(F.min(place).alias("first")).select("first.*")
    kept = firsts.groupBy(F.col("id").alias("kid"), F.col("th").alias("kth")).agg(F.sort_array(F.collect_list("at")).alias("places"))
    joined = rows.join(kept, F.col("id").eqNullSafe(F.col("kid")) & (F.col("th") == F.col("kth")), "left")
    left = let(F.split(F.col("t"), fixed.PARAGRAPH_BREAK), lambda parts: F.array_join(F.transform("places", lambda at: F.get(parts, at)), fixed.PARAGRAPH_BREAK))
    return joined.select(F.col("id").alias(id_column), F.when(F.col("t").isNotNull(), F.coalesce(left, F.lit(""))).alias(text))
