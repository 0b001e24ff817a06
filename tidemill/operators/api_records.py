"""Records from landed pages ``(endpoint, page, body)`` of paginated endpoints."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json_pages import page_envelope, page_items, parse_body, record_field
from ..functions.urls import page_url
from ..session import cut_lineage
from .lookup import join_per_key

MAX_PAGES = 10


def request_plan(
    endpoints: DataFrame, max_pages: int = MAX_PAGES, page_param: str = "page",
    per_page_param: str = "per_page", per_page: int = 30,
) -> DataFrame:
    """``(endpoint, page, url)``: the requests that fetch every page of every endpoint."""
    pages = F.explode(F.sequence(F.lit(1), F.lit(max_pages)))
    url = page_url(F.col("endpoint"), F.col("page"), page_param, per_page_param, per_page)
    return endpoints.select("endpoint", pages.alias("page")).withColumn("url", url)


def unwrap_pages(pages: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """``(endpoint, page, items, error)`` of the pages up to ``max_pages``.

    ``items`` is NULL for a response without a list; the page cap reaches the
    scan before any body is parsed.
    """
    wanted = pages.filter(F.col("page").between(1, max_pages))
    parsed = wanted.select("endpoint", "page", "body", parse_body(F.col("body")).alias("parsed"))
    opened = parsed.withColumn("envelope", page_envelope(F.col("parsed")))
    failed = F.col("body").isNull() | F.col("parsed").isNull()
    return opened.select(
        "endpoint", "page", page_items(F.col("parsed"), F.col("envelope")).alias("items"),
        F.when(failed, "undecodable JSON").alias("error"),
    )


def first_missing_page(unwrapped: DataFrame) -> DataFrame:
    """``(endpoint, stop)``: the first page number without items, landed or not, of ``(endpoint, page, full)``.

    Only page numbers move.  They are keyed by endpoint and page, so an
    endpoint with a large share of the pages spreads over all tasks.
    """
    full = F.col("full")
    page = F.col("page").cast("int")

    def mark(number, here: int):
        return F.struct(number.cast("int").alias("page"), F.lit(here).alias("here"))

    marks = F.when(full, F.array(mark(page, 1), mark(page + 1, 0), mark(F.lit(1), 0))).otherwise(
        F.array(mark(F.lit(1), 0))
    )
    return (
        unwrapped.select("endpoint", F.inline(marks))
        .groupBy("endpoint", "page")
        .agg(F.max("here").alias("here"))
        .filter(F.col("here") == 0)
        .groupBy("endpoint")
        .agg(F.min("page").alias("stop"))
    )


def pages_until_empty(pages: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """Pages ``(endpoint, page, items)`` before the first one without items.

    Bodies are parsed once and their items written once; the stop rule reads
    page numbers from there and the result the items.
    """
    opened = unwrap_pages(pages, max_pages).select("endpoint", "page", "items")
    parsed = cut_lineage(opened.withColumn("full", F.coalesce(F.size("items") > 0, F.lit(False))), "pages")
    stops = first_missing_page(parsed.select("endpoint", "page", "full"))
    kept = join_per_key(parsed.drop("full"), stops, "endpoint", salt_by=F.col("page"))
    return kept.filter(F.col("page") < F.col("stop")).select("endpoint", "page", "items")


def records(pages: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """``(endpoint, page, position, record)``: one VARIANT record per row."""
    return pages_until_empty(pages, max_pages).select(
        "endpoint", "page", F.posexplode("items").alias("position", "record")
    )


def project_fields(rows: DataFrame, fields: Mapping[str, str] | None, record: str = "record") -> DataFrame:
    """Exactly the named fields with their types, missing ones NULL; no fields keeps the record."""
    if not fields:
        return rows.select(record)
    return rows.select(*[record_field(F.col(record), f, t).alias(f) for f, t in fields.items()])


def project_columns(df: DataFrame, fields: list[str] | None) -> DataFrame:
    """The same for a table: exactly the named columns, missing ones NULL."""
    if not fields:
        return df
    return df.select(
        *[F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields]
    )
