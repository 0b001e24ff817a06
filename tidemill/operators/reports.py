"""Counts over cleaned texts and extracted entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.extraction import entity_total


def reduction(df: DataFrame, before: Column, after: Column, by: list[str] | None = None) -> DataFrame:
    """Characters before and after cleaning and the reduction in percent."""
    total = lambda c: F.coalesce(F.sum(F.length(c)), F.lit(0)).cast("bigint")
    sizes = df.groupBy(*(by or [])).agg(total(before).alias("chars_before"), total(after).alias("chars_after"))
    share = (1 - F.col("chars_after") / F.nullif(F.col("chars_before"), F.lit(0))) * 100
    return sizes.withColumn("reduction_pct", F.round(share, 1))


def entity_totals(records: DataFrame, record: str = "record") -> DataFrame:
    """One row: texts and entities in them."""
    return records.agg(
        F.count("*").alias("texts"), F.coalesce(F.sum(entity_total(F.col(record))), F.lit(0)).alias("entities")
    )


def entity_rows(records: DataFrame, record: str = "record") -> DataFrame:
    """``(doc_id, kind, value)``: one row per entity."""
    r = F.col(record)

    def tagged(kind: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    every = F.concat(
        tagged("email", r["emails"]),
        tagged("phone", r["phones"]),
        tagged("url", r["urls"]),
        tagged("date", r["dates"]),
        tagged("money", F.transform(r["monetary"], lambda m: m["raw"])),
        tagged(
            "pair",
            F.transform(
                F.map_entries(r["key_value_pairs"]), lambda e: F.concat(e["key"], F.lit(": "), e["value"])
            ),
        ),
    )
    return records.select("doc_id", F.inline(every))


def entity_counts(records: DataFrame, record: str = "record") -> DataFrame:
    """``(kind, n, texts)``, from the sizes alone: no entity becomes a row."""
    r = F.col(record)
    sizes = {
        "email": F.size(r["emails"]),
        "phone": F.size(r["phones"]),
        "url": F.size(r["urls"]),
        "date": F.size(r["dates"]),
        "money": F.size(r["monetary"]),
        "pair": F.size(r["key_value_pairs"]),
    }
    counted = F.inline(
        F.array(*[F.struct(F.lit(k).alias("kind"), s.cast("bigint").alias("size")) for k, s in sizes.items()])
    )
    return (
        records.select(counted)
        .groupBy("kind")
        .agg(F.sum("size").alias("n"), F.count_if(F.col("size") > 0).alias("texts"))
    )
