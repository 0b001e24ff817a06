"""Crawled pages ``(url, html, …)``: Markdown files and the manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import html_to_markdown
from ..functions.urls import url_filename


def page_files(pages: DataFrame, keep: list[str] | None = None, close_open_p: bool = False) -> DataFrame:
    """``url, file, markdown, error`` of each page, after the columns to ``keep``.

    A page without a body becomes an error and does not stop the others.  An
    error that the crawl recorded in a column ``error`` is taken over.
    """
    recorded = F.col("error") if "error" in pages.columns else F.lit(None).cast("string")
    missing = F.when(F.col("html").isNull(), F.lit("no body"))
    body = F.when(recorded.isNull(), F.col("html"))
    return pages.select(
        *(keep or []),
        "url",
        url_filename(F.col("url")).alias("file"),
        html_to_markdown(body, close_open_p).alias("markdown"),
        F.coalesce(recorded, missing).alias("error"),
    )


def page_manifest(files: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``url, status, chars, file, error`` of each page; no text is carried along."""
    good = F.col("error").isNull()
    return files.select(
        *(keep or []),
        "url",
        F.when(good, "success").otherwise("error").alias("status"),
        F.when(good, F.length("markdown").cast("bigint")).alias("chars"),
        F.when(good, F.col("file")).alias("file"),
        "error",
    )


def last_per_url(manifest: DataFrame, order_by: Column) -> DataFrame:
    """One row per URL, the latest by ``order_by``.

    ``max_by`` folds repeats map-side, so a URL crawled very often does not
    gather in one task.
    """
    rest = [c for c in manifest.columns if c != "url"]
    return (
        manifest.groupBy("url")
        .agg(F.max_by(F.struct(*rest), order_by).alias("last"))
        .select("url", "last.*")
    )


def file_collisions(manifest: DataFrame) -> DataFrame:
    """``(file, urls)``: file names that more than one URL maps to."""
    return (
        manifest.filter(F.col("file").isNotNull())
        .groupBy("file")
        .agg(F.count_distinct("url").alias("urls"))
        .filter(F.col("urls") > 1)
    )
