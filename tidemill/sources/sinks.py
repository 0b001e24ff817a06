"""JSON and text outputs, and the vector store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _as_json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def _json_array_lines(df: DataFrame, order_by: str) -> DataFrame:
    """Lines that are one JSON array when read in order.

    The first record opens the array and every other one starts with a comma,
    so lines need no knowledge of each other and are written by many tasks.
    """
    low = df.agg(F.min(order_by).alias("low")).first()["low"]
    opens = F.col(order_by) == F.lit(low)
    if low is None or df.filter(opens).limit(2).count() != 1 or not df.filter(F.col(order_by).isNull()).isEmpty():
        raise ValueError(f"{order_by} must give every record a place of its own")
    records = df.select(
        F.col(order_by).alias("_order"), F.concat(F.when(opens, "[").otherwise(","), _as_json(df)).alias("value"),
    ).withColumn("_end", F.lit(0))
    end = df.sparkSession.range(1).select(
        F.lit(None).cast(records.schema["_order"].dataType).alias("_order"), F.lit("]").alias("value"), F.lit(1).alias("_end")
    )
    return records.unionByName(end).orderBy("_end", "_order").select("value")


def save_records(df: DataFrame, path: str, format: str = "jsonl", order_by: str | None = None) -> None:
    """One JSON object per line, or one array over the part files in order of name.

    NULL fields are written.  An array needs ``order_by``, a column without
    NULLs whose smallest value is unique.
    """
    if format == "jsonl":
        df.write.option("ignoreNullFields", False).json(path)
    elif format == "json":
        if df.isEmpty():
            df.sparkSession.range(1).select(F.lit("[]").alias("value")).write.text(path)
        else:
            if order_by is None:
                raise ValueError("a JSON array needs order_by")
            _json_array_lines(df, order_by).write.text(path)
    else:
        raise ValueError(f"unknown format {format!r}, expected 'jsonl' or 'json'")


def write_texts(df: DataFrame, path: str, text: str = "text", order_by: list[str] | None = None) -> None:
    """Texts one after the other with a blank line between them, over part files in order of name."""
    ordered = df.orderBy(*order_by) if order_by else df
    ordered.select(F.col(text)).write.option("lineSep", "\n\n").text(path)


def write_named_texts(df: DataFrame, path: str, name: str = "file", text: str = "markdown") -> None:
    """Texts as a table keyed by file name, in place of one small file per text."""
    df.select(F.col(name).alias("file"), F.col(text).alias("text")).write.parquet(path)


def build_store(chunks: DataFrame, path: str, embed, content: str = "content") -> None:
    """Embed every chunk and write ``(chunk_id, source, content, embedding)``."""
    chunks.select(
        "chunk_id", "source", F.col(content).alias("content"), embed(F.col(content)).alias("embedding")
    ).write.mode("overwrite").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
