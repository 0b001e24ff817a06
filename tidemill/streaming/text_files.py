"""Text files cleaned as they land.

The column functions hold no state, so a stream needs nothing of its own but
source, sink and checkpoint; its plan has no shuffle and no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.cleaning import CleaningOptions, clean_text, deduplicate_paragraphs
from ..session import shared_dir
from ..sources.texts import TEXT_FILES, text_documents


def read_text_stream(spark: SparkSession, directory: str) -> DataFrame:
    """``(content, source, filename)`` of text files as they appear below ``directory``."""
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", TEXT_FILES)
        .load(directory)
    )
    return text_documents(files)


def clean_text_stream(
    documents: DataFrame, target: str, name: str, options: CleaningOptions = CleaningOptions()
) -> StreamingQuery:
    """Clean all documents there are and append them to ``target``, each exactly once.

    ``name`` names the checkpoint below the shared folder; a later run under
    the same name goes on where this one ends.
    """
    cleaned = documents.withColumn("content", deduplicate_paragraphs(clean_text(F.col("content"), options)))
    checkpoint = f"{shared_dir(documents.sparkSession).rstrip('/')}/streams/{name}"
    return (
        cleaned.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
