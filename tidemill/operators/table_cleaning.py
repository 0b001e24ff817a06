"""Cleaning of text tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.blank import is_blank, strip


@dataclass(frozen=True)
class TableCleaning:
    """What :func:`clean_table` does, in the order of the fields.

    ``filter_rows`` keeps rows whose cell is among the allowed values; it sees
    the filled cells and the names from before renaming.
    """

    strip_whitespace: bool = True
    remove_duplicates: bool = True
    fill_nulls: Mapping[str, object] = field(default_factory=dict)
    filter_rows: Mapping[str, Sequence[str]] = field(default_factory=dict)
    drop_columns: Sequence[str] = ()
    rename_columns: Mapping[str, str] = field(default_factory=dict)


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def strip_all(df: DataFrame) -> DataFrame:
    """Strip every text cell."""
    return df.withColumns({name: strip(F.col(name)) for name in _text_columns(df)})


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows.

    Equal rows cannot be told apart, so keeping the first needs no order.
    Partial aggregation folds copies before the shuffle.
    """
    return df.dropDuplicates()


def fill_blanks(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Blank cells get the value as text; a column that is missing is created."""
    filled = {
        name: F.when(is_blank(F.col(name)), F.lit(str(value))).otherwise(F.col(name))
        if name in df.columns
        else F.lit(str(value))
        for name, value in values.items()
    }
    return df.withColumns(filled)


def filter_allowed(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows whose cells are all among the allowed values."""
    for name, values in allowed.items():
        df = df.filter(F.col(name).isin(list(values)))
    return df


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns, ignoring unknown names; two columns may not end up equal."""
    result = [names.get(c, c) for c in df.columns]
    twice = sorted({c for c in result if result.count(c) > 1})
    if twice:
        raise ValueError(f"renaming gives {twice} more than once")
    return df.toDF(*result)  # all at once, so names may be swapped


def clean_table(df: DataFrame, cleaning: TableCleaning = TableCleaning()) -> DataFrame:
    """Strip, drop duplicates, fill, filter, drop and rename."""
    if cleaning.strip_whitespace:
        df = strip_all(df)
    if cleaning.remove_duplicates:
        df = drop_duplicate_rows(df)
    df = fill_blanks(df, cleaning.fill_nulls)
    df = filter_allowed(df, cleaning.filter_rows)
    df = df.drop(*cleaning.drop_columns)
    return rename(df, cleaning.rename_columns)


def cleaning_report(df: DataFrame, cleaning: TableCleaning = TableCleaning()) -> DataFrame:
    """What :func:`clean_table` changes, as rows ``(change, target, n)``.

    Copies are folded into counted rows first, so one shuffle serves both the
    number of duplicates and the number of cells filled among the rows kept.
    """
    columns = df.columns
    if cleaning.strip_whitespace:
        df = strip_all(df)
    if cleaning.remove_duplicates:
        rows = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    else:
        rows = df.withColumn("_n", F.lit(1).cast("bigint"))

    def counted(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")

    removed = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint")
    entries = [("rows_removed", "", removed)]
    for name in cleaning.fill_nulls:
        blank = is_blank(F.col(name)) if name in columns else F.lit(True)
        entries.append(("cells_filled", name, counted(blank)))
    one_row = rows.agg(*[n.alias(f"_{i}") for i, (_, _, n) in enumerate(entries)])
    steps = [
        F.struct(F.lit(change).alias("change"), F.lit(target).alias("target"), F.col(f"_{i}").alias("n"))
        for i, (change, target, _) in enumerate(entries)
    ]
    return one_row.select(F.inline(F.array(*steps)))


def clean_and_report(df: DataFrame, path: str, cleaning: TableCleaning = TableCleaning()) -> list[tuple[str, str, int]]:
    """Write :func:`clean_table` of ``df`` to ``path``; return :func:`cleaning_report`'s rows from that one write.

    The counts are metrics observed while the write runs: rows before and
    after dropping duplicates, and blank cells of the kept rows before they
    are filled.  No second scan of the input is made.
    """
    columns = df.columns
    if cleaning.strip_whitespace:
        df = strip_all(df)
    before, after = Observation("rows in"), Observation("rows kept")
    df = df.observe(before, F.count(F.lit(1)).alias("rows"))
    if cleaning.remove_duplicates:
        df = drop_duplicate_rows(df)
    blanks = [
        F.coalesce(F.sum(F.when(is_blank(F.col(name)) if name in columns else F.lit(True), 1).otherwise(0)), F.lit(0)).cast("bigint").alias(f"_{i}")
        for i, name in enumerate(cleaning.fill_nulls)
    ]
    df = df.observe(after, F.count(F.lit(1)).alias("rows"), *blanks)
    df = fill_blanks(df, cleaning.fill_nulls)
    df = filter_allowed(df, cleaning.filter_rows)
    rename(df.drop(*cleaning.drop_columns), cleaning.rename_columns).write.parquet(path)
    kept = after.get
    entries = [("rows_removed", "", before.get["rows"] - kept["rows"])]
    entries += [("cells_filled", name, kept[f"_{i}"]) for i, name in enumerate(cleaning.fill_nulls)]
    return entries
