"""Jobs from input to output."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chunking import CHUNK_SIZE, OVERLAP, chunk_characters
from ..functions.cleaning import CleaningOptions, clean_markdown, clean_text, deduplicate_paragraphs
from ..functions.embedding import hashing_embedding
from ..functions.extraction import extract_all
from ..functions.html import html_blocks, render_markdown
from ..operators.api_records import MAX_PAGES, project_fields, records
from ..operators.profile import profile_table
from ..operators.table_cleaning import TableCleaning, clean_table
from ..operators.vector_search import TOP_K, nearest
from ..session import cut_lineage
from ..sources.csv import read_csv, write_csv
from ..sources.sinks import build_store, read_store, save_records

Embedder = Callable[[Column], Column]


def csv_job(
    spark: SparkSession, source: str, target: str, cleaning: TableCleaning = TableCleaning(),
    encoding: str = "utf-8",
) -> tuple[DataFrame, DataFrame]:
    """Read, profile, clean and write a CSV table; gives the profile and the cleaned table."""
    table = read_csv(spark, source, encoding, empty_as_null=False)
    # The position in the scan stands for the order of rows, so it is fixed once.
    numbered = cut_lineage(table.withColumn("_row", F.monotonically_increasing_id()), "csv")
    table = numbered.drop("_row")
    profile = profile_table(numbered, F.col("_row"), table.columns)
    write_csv(clean_table(table, cleaning), target, encoding=encoding)
    return profile, read_csv(spark, target, encoding, empty_as_null=False)


def clean_corpus(
    documents: DataFrame, text: str = "text", options: CleaningOptions = CleaningOptions()
) -> DataFrame:
    """The documents with ``text`` cleaned and rid of repeated paragraphs."""
    return documents.withColumn(text, deduplicate_paragraphs(clean_text(F.col(text), options)))


def extract_corpus(documents: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One extraction record per document, next to the columns to ``keep``."""
    return documents.select(*keep, extract_all(F.col(text)).alias("record"))


def api_to_dataset(
    pages: DataFrame, target: str, fields: Mapping[str, str] | None = None, max_pages: int = MAX_PAGES
) -> None:
    """Landed pages to a JSON-lines data set of the wanted fields."""
    save_records(project_fields(records(pages, max_pages), fields), target)


def chunk_documents(documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = OVERLAP) -> DataFrame:
    """``(chunk_id, source, chunk_index, content)`` of documents ``(content, source, filename)``."""
    split = documents.select(
        "source", "filename", F.posexplode(chunk_characters(F.col("content"), size, overlap)).alias("chunk_index", "content")
    )
    chunk_id = F.concat_ws("_", "filename", F.col("chunk_index").cast("string"))
    return split.select(chunk_id.alias("chunk_id"), "source", "chunk_index", "content")


def web_documents(pages: DataFrame) -> DataFrame:
    """Cleaned Markdown documents ``(content, source, filename)`` of pages ``(page_id, url, html)``.

    Each page stays in its row from HTML to cleaned text: nothing shuffles.
    """
    blocks = pages.select("page_id", "url", html_blocks(F.col("html")).alias("blocks"))
    return blocks.filter(F.size("blocks") > 0).select(
        deduplicate_paragraphs(clean_markdown(render_markdown(F.col("blocks")))).alias("content"),
        F.col("url").alias("source"),
        F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".md")).alias("filename"),
    )


def search_text(
    store: DataFrame, queries: DataFrame, k: int = TOP_K, embed: Embedder = hashing_embedding
) -> DataFrame:
    """Nearest chunks of query texts ``(query_id, text)``."""
    vectors = queries.select("query_id", embed(F.col("text")).alias("embedding"))
    return nearest(store, vectors, k)


def build_web_store(
    pages: DataFrame, store: str, size: int = CHUNK_SIZE, overlap: int = OVERLAP,
    embed: Embedder = hashing_embedding,
) -> DataFrame:
    """Pages to a vector store; the store is the one thing written on the way."""
    spark = pages.sparkSession
    chunks = chunk_documents(web_documents(pages), size, overlap)
    build_store(chunks, store, embed)
    built = read_store(spark, store)
    if built.isEmpty():
        raise ValueError("no page has any content")
    return built


def search_web(
    pages: DataFrame, queries: DataFrame, store: str, k: int = TOP_K, embed: Embedder = hashing_embedding
) -> DataFrame:
    """Pages to Markdown, cleaned, chunked, embedded and stored, then searched."""
    return search_text(build_web_store(pages, store, embed=embed), queries, k, embed)
