"""Profile of a text table: one row per column.

The table is read once into counted values ``(column, value, n, first_seen)``,
which is the only large shuffle and is folded map-side; it is written once and
everything else but the samples is computed from it.  No step gathers a
column's values in one task: top values go through a per-task limit, samples
through a per-task heap, and the median narrows histograms of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.blank import is_blank, to_number
from ..session import cut_lineage

TOP_VALUES = 5
SAMPLE_VALUES = 3
# Distinct numbers per column up to which one sorted pass finds the median.
MEDIAN_DIRECT = 1 << 18
# Fixed scale of the first histogram: |ln| of a double stays below 745.2.
LOG_OFFSET = 746
LOG_STEPS = 32
LINEAR_BUCKETS = (1 << 16) - 1


def counted_values(df: DataFrame, order_by: Column, columns: list[str] | None = None) -> DataFrame:
    """``(column, value, n, first_seen, num)``; blank cells count under a NULL value."""
    columns = columns or df.columns
    cells = df.select(
        order_by.alias("_order"),
        *[
            F.when(is_blank(F.col(c).cast("string")), F.lit(None)).otherwise(F.col(c).cast("string")).alias(c)
            for c in columns
        ],
    ).unpivot("_order", columns, "column", "value")
    return (
        cells.groupBy("column", "value")
        .agg(F.count("*").alias("n"), F.min("_order").alias("first_seen"))
        .withColumn("num", to_number(F.replace(F.col("value"), F.lit(","), F.lit(""))))
    )


def completeness(counts: DataFrame) -> DataFrame:
    """Totals, blanks, distinct values, type and plain numeric statistics."""

    def where(condition: Column, value: Column) -> Column:
        return F.sum(F.when(condition, value).otherwise(0))

    present, numeric = F.col("value").isNotNull(), F.col("num").isNotNull()
    raw = counts.groupBy("column").agg(
        F.sum("n").alias("total_rows"),
        where(present, F.col("n")).alias("non_null"),
        F.count("value").alias("unique_count"),
        where(numeric, F.col("n")).alias("n_num"),
        F.count("num").alias("unique_num"),
        F.min("num").alias("low"),
        F.max("num").alias("high"),
        F.sum(F.col("num") * F.col("n")).alias("weighted"),
    )
    is_numeric = (F.col("n_num") > 0) & (F.col("n_num") > F.col("non_null") * 0.5)
    return raw.select(
        "column", "total_rows", "non_null",
        (F.col("total_rows") - F.col("non_null")).alias("null_count"),
        F.round((F.col("total_rows") - F.col("non_null")) / F.col("total_rows") * 100, 1).alias("null_pct"),
        "unique_count", "n_num", "unique_num",
        F.when(is_numeric, "numeric").otherwise("categorical").alias("type"),
        F.when(is_numeric, F.col("low")).alias("min"),
        F.when(is_numeric, F.col("high")).alias("max"),
        F.when(is_numeric, F.col("weighted") / F.col("n_num")).alias("exact_mean"),
    )


def standard_deviation(counts: DataFrame, base: DataFrame) -> DataFrame:
    """Sample deviation around the known mean, NULL for a single number."""
    means = base.filter("type = 'numeric'").select("column", "exact_mean", "n_num")
    squares = F.sum(F.col("n") * F.pow(F.col("num") - F.col("exact_mean"), 2))
    return (
        counts.filter(F.col("num").isNotNull())
        .join(F.broadcast(means), "column")  # one row per column of the schema
        .groupBy("column", "n_num")
        .agg(squares.alias("squares"))
        .select(
            "column",
            F.when(
                F.col("n_num") > 1, F.round(F.sqrt(F.col("squares") / (F.col("n_num") - 1)), 2)
            ).alias("stdev"),
        )
    )


def _log_bucket(v: Column) -> Column:
    """A coarse position on the number line that grows with the number."""
    scaled = (F.log(F.abs(v)) + LOG_OFFSET) * LOG_STEPS
    edge = 4 * LOG_OFFSET * LOG_STEPS
    return (
        F.when(F.isnan(v), F.lit(edge + 1))
        .when(F.abs(v) == float("inf"), F.signum(v).cast("bigint") * edge)
        .when(v == 0, F.lit(0))
        .otherwise((F.signum(v) * F.floor(scaled)).cast("bigint"))
        .cast("bigint")
    )


def _linear_bucket(v: Column) -> Column:
    """Position between the bounds of the range found so far."""
    share = (v - F.col("lo")) / (F.col("hi") - F.col("lo"))
    return F.when(F.col("lo") == F.col("hi"), F.lit(0)).otherwise(F.floor(share * LINEAR_BUCKETS)).cast("bigint")


def _narrow(numbers: DataFrame, state: DataFrame, bucket: Column) -> DataFrame:
    """The bucket that holds each wanted rank, with its bounds and the rank inside it."""
    histogram = (
        numbers.join(F.broadcast(state), "column")  # two rows per column of the schema
        .filter(F.col("num").between(F.col("lo"), F.col("hi")))
        .groupBy("column", "side", "rank", bucket.alias("bucket"))
        .agg(F.sum("n").alias("w"), F.min("num").alias("lo"), F.max("num").alias("hi"))
    )
    order = Window.partitionBy("column", "side").orderBy("bucket")
    return (
        histogram.withColumn("upto", F.sum("w").over(order))
        .filter((F.col("upto") - F.col("w") <= F.col("rank")) & (F.col("rank") < F.col("upto")))
        .select("column", "side", (F.col("rank") - F.col("upto") + F.col("w")).alias("rank"), "lo", "hi")
    )


def median(counts: DataFrame, base: DataFrame, direct: int = MEDIAN_DIRECT) -> DataFrame:
    """Exact median of each numeric column, the midpoint when two are in the middle.

    Columns with few distinct numbers are sorted at once.  Others pass three
    histograms of at most ``2 ** 17`` buckets: one by magnitude, two inside
    the range found.  What then remains spans less than ``2 ** -36`` of its
    magnitude, at most ``2 ** 17`` doubles, so the last sort is bounded too.
    """
    numbers = counts.filter(F.col("num").isNotNull()).select("column", "num", "n")
    wanted = base.filter("type = 'numeric'").select(
        "column", "unique_num", F.col("min").alias("lo"), F.col("max").alias("hi"),
        F.inline(
            F.array(
                F.struct(F.lit("lower").alias("side"), F.floor((F.col("n_num") - 1) / 2).alias("rank")),
                F.struct(F.lit("upper").alias("side"), F.floor(F.col("n_num") / 2).alias("rank")),
            )
        ),
    )
    few = wanted.filter(F.col("unique_num") <= direct).drop("unique_num")
    state = wanted.filter(F.col("unique_num") > direct).drop("unique_num")
    if not state.isEmpty():
        state = _narrow(numbers, state, _log_bucket(F.col("num")))
        state = _narrow(numbers, state, _linear_bucket(F.col("num")))
        state = _narrow(numbers, state, _linear_bucket(F.col("num")))
        few = few.unionByName(state)
    found = _narrow(numbers, few, F.col("num"))
    return found.groupBy("column").agg(F.avg("lo").alias("median"))


def top_values(counts: DataFrame, base: DataFrame, k: int = TOP_VALUES) -> DataFrame:
    """``(column, rank, value, n)``: most frequent first, earlier first among equals."""
    categorical = base.filter("type = 'categorical'").select("column")
    order = Window.partitionBy("column").orderBy(F.desc("n"), "first_seen")
    return (
        counts.filter(F.col("value").isNotNull())
        .join(F.broadcast(categorical), "column")  # at most the columns of the schema
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("column", "rank", "value", "n")
    )


def first_values(
    df: DataFrame, order_by: Column, columns: list[str], k: int = SAMPLE_VALUES
) -> DataFrame:
    """``(column, rank, value)``: the first ``k`` values that are not blank, for each column.

    The table is read once, however many columns there are: every task keeps
    ``k`` cells per column and passes them on.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, rank int, value string")
    cells = df.select(order_by.alias("_order"), *[F.when(~is_blank(F.col(c).cast("string")), F.col(c).cast("string")).alias(c) for c in columns])
    schema = StructType([StructField("column", StringType()), cells.schema["_order"], StructField("value", StringType())])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, pa.Table] = {}
        for batch in batches:
            for name in columns:
                part = pa.table({"_order": batch.column("_order"), "value": batch.column(name).cast(pa.string())})
                part = part.filter(pc.is_valid(part["value"]))
                if part.num_rows:
                    both = pa.concat_tables([held[name], part]) if name in held else part
                    held[name] = both.take(pc.select_k_unstable(both, k, [("_order", "ascending")]))
        for name, part in held.items():
            yield from part.select(["_order", "value"]).add_column(0, "column", pa.array([name] * part.num_rows)).to_batches()

    rows = cells.mapInArrow(keep, schema)
    order = Window.partitionBy("column").orderBy("_order")
    return rows.select("column", F.row_number().over(order).alias("rank"), "value").filter(F.col("rank") <= k)


def profile_table(df: DataFrame, order_by: Column, columns: list[str] | None = None) -> DataFrame:
    """Everything known about each column, numeric and categorical fields side by side."""
    columns = columns or df.columns
    counts = cut_lineage(counted_values(df, order_by, columns), "counted-values")
    base = cut_lineage(completeness(counts), "completeness")
    kinds = {r["column"]: r["type"] for r in base.select("column", "type").collect()}
    samples = first_values(df, order_by, [c for c in columns if kinds.get(c) == "categorical"])

    def in_order(rows: DataFrame, value: Column, name: str) -> DataFrame:
        pairs = F.sort_array(F.collect_list(F.struct(F.col("rank"), value.alias("item"))))
        return rows.groupBy("column").agg(F.transform(pairs, lambda p: p["item"]).alias(name))

    top = in_order(top_values(counts, base), F.struct("value", "n"), "top_5")
    sample = in_order(samples, F.col("value"), "sample")
    categorical = F.col("type") == "categorical"
    parts = [median(counts, base), standard_deviation(counts, base), top, sample]
    whole = base
    for part in parts:
        whole = whole.join(part, "column", "left")
    return whole.select(
        "column", "total_rows", "non_null", "null_count", "null_pct", "unique_count", "type",
        "min", "max", F.round("exact_mean", 2).alias("mean"), F.round("median", 2).alias("median"),
        "stdev",
        F.when(categorical, F.coalesce("top_5", F.array().cast("array<struct<value:string,n:bigint>>"))).alias("top_5"),
        F.when(categorical, F.coalesce("sample", F.array().cast("array<string>"))).alias("sample"),
    )
