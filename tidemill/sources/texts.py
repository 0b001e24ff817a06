"""Folders of text and of paged binary documents."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.blank import is_blank

# The file kinds taken from a folder.
TEXT_FILES = "*.{md,txt,text}"
DOCUMENT_FILES = "*.pdf"
UNDECODABLE = "\ufffd"

PAGE_SCHEMA = "source string, page_no int, text string, error string"


def text_documents(files: DataFrame) -> DataFrame:
    """``(content, source, filename)`` of whole text files, batch or stream."""
    marked = F.make_valid_utf8("value")
    content = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(
        F.replace(marked, F.lit(UNDECODABLE), F.lit(""))
    )
    return files.select(
        content.alias("content"),
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_name").alias("filename"),
    ).filter(~is_blank(F.col("content")))


def read_text_files(spark: SparkSession, directory: str) -> DataFrame:
    """``(content, source, filename)`` of the text files below ``directory``.

    Bytes that are not UTF-8 are dropped and blank files skipped.
    """
    files = (
        spark.read.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", TEXT_FILES)
        .load(directory)
    )
    return text_documents(files)


def read_document_pages(
    spark: SparkSession, directory: str, decode: Callable[[bytes], Iterable[str]],
    name_pattern: str = DOCUMENT_FILES,
) -> DataFrame:
    """``(source, page_no, text, error)`` of the documents in ``directory``.

    ``decode`` turns the bytes of one file into the texts of its pages.  A
    file that fails gives one row with its error and does not stop the job.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", name_pattern).load(directory)

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, content in zip(batch["path"], batch["content"]):
                try:
                    texts = list(decode(bytes(content)))
                    rows = [(source, i, text, None) for i, text in enumerate(texts, 1)]
                except Exception as problem:  # any decoder failure is a row, not the end of the job
                    rows = [(source, None, None, str(problem) or type(problem).__name__)]
                if rows:
                    frame = pd.DataFrame(rows, columns=["source", "page_no", "text", "error"])
                    yield frame.astype({"page_no": "Int32"})

    return files.select("path", "content").mapInPandas(pages, PAGE_SCHEMA)
