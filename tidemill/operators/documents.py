"""Paged documents from rows ``(source, page_no, text)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.blank import is_blank, strip


def page_lines(pages: DataFrame) -> DataFrame:
    """``(source, page_no, line)`` of the pages that are not blank, each under its marker."""
    line = F.concat(F.lit("--- Page "), F.col("page_no").cast("string"), F.lit(" ---\n"), strip(F.col("text")))
    return pages.filter(~is_blank(F.col("text"))).select("source", "page_no", line.alias("line"))


def assemble_documents(pages: DataFrame, extractor: str = "table", pages_per_part: int | None = None) -> DataFrame:
    """``(source, part, parts, text, pages, extractor, chars)``: one row per document.

    ``pages`` and ``chars`` are those of the document.  Only on request, by
    ``pages_per_part``, a document comes as rows of so many page numbers each;
    their texts joined by a blank line in order of ``part`` are the document,
    and every row carries the figures of the whole and the number of its parts.
    """
    lines = page_lines(pages)
    in_order = F.sort_array(F.collect_list(F.struct("page_no", "line")))
    text = F.array_join(F.transform(in_order, lambda p: p["line"]), "\n\n").alias("text")
    figures = [F.lit(extractor).alias("extractor"), F.col("chars").cast("bigint").alias("chars")]
    if pages_per_part is None:
        whole = lines.groupBy("source").agg(text, F.count("*").alias("pages")).withColumn("chars", F.length("text"))
        return whole.select("source", F.lit(0).cast("bigint").alias("part"), F.lit(1).cast("bigint").alias("parts"), "text", "pages", *figures)
    part = F.floor((F.col("page_no") - 1) / pages_per_part)
    rows = lines.groupBy("source", part.alias("part")).agg(text, F.count("*").alias("_pages"), F.sum(F.length("line")).alias("_chars"))
    sizes = rows.groupBy("source").agg(
        F.count("*").alias("parts"), F.sum("_pages").alias("pages"), (F.sum("_chars") + 2 * (F.sum("_pages") - 1)).alias("chars")
    )
    return rows.join(sizes, "source").select("source", "part", "parts", "text", "pages", *figures)


def document_sizes(pages: DataFrame) -> DataFrame:
    """``(source, pages, chars)`` of the assembled documents, without assembling them."""
    return (
        page_lines(pages)
        .groupBy("source")
        .agg(
            F.count("*").alias("pages"),
            (F.sum(F.length("line")) + 2 * (F.count("*") - 1)).alias("chars"),
        )
    )


def document_totals(pages: DataFrame) -> DataFrame:
    """One row: documents with text, their pages and the length of all joined by blank lines."""
    return document_sizes(pages).agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"),
        F.coalesce(F.sum("chars") + 2 * (F.count("*") - 1), F.lit(0)).alias("chars"),
    )
