"""Group-by over text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.blank import to_number

AGGREGATES = {"sum": F.sum, "mean": F.avg, "count": F.count, "min": F.min, "max": F.max}


def group_aggregate(df: DataFrame, key: str, measure: str, function: str = "sum") -> DataFrame:
    """One row per key: the aggregate of the numbers in ``measure`` and their count.

    Cells that are not numbers are left out, and so are keys with none.  The
    aggregate is rounded to two decimals and the result sorted by key.  Partial
    aggregation leaves at most one row per key and task to shuffle, so a hot
    key costs no more than a cold one.
    """
    if function not in AGGREGATES:
        raise ValueError(f"unknown aggregate {function!r}, expected one of {list(AGGREGATES)}")
    numbers = df.select(
        F.coalesce(F.col(key), F.lit("")).alias(key), to_number(F.col(measure)).alias("_v")
    )
    aggregate = AGGREGATES[function]("_v")
    if function != "count":
        aggregate = F.round(aggregate, 2)
    # Filtering groups instead of rows parses each cell once.
    return (
        numbers.groupBy(key)
        .agg(aggregate.alias(f"{function}_{measure}"), F.count("_v").alias("count"))
        .filter(F.col("count") > 0)
        .orderBy(key)
    )
