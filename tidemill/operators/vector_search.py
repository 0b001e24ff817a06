"""Exact nearest neighbours by squared Euclidean distance.

Each task scores its Arrow batches against the query vectors with a matrix
product and keeps ``k`` rows per query, so what is shuffled is ``k`` rows per
query and task, whatever the size of the store.  No pair of store row and query
ever becomes a row.  The search reads ids and vectors only; the other columns
of the hits are fetched at the end.  Rows whose vector is null or holds a
non-finite component have no distance: they are never found.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import cut_lineage

TOP_K = 4
# Query vectors sent to every task: at most this many rows and bytes.
QUERY_ROWS = 2048
QUERY_BYTES = 64 << 20
# Store rows and query rows in one cell of the blocked search: larger cells repeat both sides less often.
CELL_ROWS = 20_000
BLOCK_ROWS = 20_000
MERGE_GROUPS = 256
# Distances measured at once in a task.
TILE = 4 << 20
# Hits sent to every task to fetch their columns: at most this many.
HIT_ROWS = 200_000
# Distances count as equal if they agree to this many decimals, so that no order of summation decides a rank.
DECIMALS = 9
# Minima over stretches of rows that bound the k-th distance; candidates, times k, beyond which a bound is sought again.
MINIMA, LOOSE = 256, 8
# Squares below this bound can be summed in single precision.
SINGLE_RANGE = 1e30
# Relative slack that covers rounding of the matrix product.
SLACK = 1e-9
# Rounding may lift a distance by half a unit, on both sides of a comparison.
ROUNDING = 10.0**-DECIMALS


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of equal length as the rows of a matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
        if isinstance(vectors, pa.ChunkedArray):
            vectors = pa.concat_arrays(vectors.chunks)
    if not len(vectors):
        return np.zeros((0, 0))
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(values) % len(vectors) or len(set(np.diff(vectors.offsets.to_numpy()))) > 1:
        raise ValueError("vectors differ in dimension")
    return values.reshape(len(vectors), -1)


class _Rows:
    """Vectors ready for matrix products: the square of each stands beside it."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.squares = vectors, (vectors**2).sum(axis=1)
        self.highest = self.squares.max()
        self.single = self.highest < SINGLE_RANGE
        self.sides = self._sides(np.float32 if self.single else np.float64)

    def _sides(self, kind: type) -> np.ndarray:
        return np.hstack([self.vectors, self.squares[:, None]]).astype(kind).T

    def distances(self, queries: np.ndarray, q2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances less the square of the query, up to the slack of each query."""
        slack = SLACK * (q2 + self.highest) + ROUNDING
        sides = self.sides
        if self.single and not q2.max(initial=0.0) < SINGLE_RANGE:
            sides = self._sides(np.float64)
        if sides.dtype == np.float32:  # the casts, the products and their sums round
            steps = (self.vectors.shape[1] + 4) * float(np.finfo(np.float32).eps)
            slack = slack + steps * (self.highest + 2.0 * np.sqrt(q2 * self.highest))
        left = np.hstack([-2.0 * queries, np.ones((len(queries), 1))]).astype(sides.dtype)
        return left @ sides, slack


def _bound(rough: np.ndarray, k: int) -> np.ndarray:
    """A value per line that at least ``k`` of its members do not exceed: the k-th of the minima over stretches."""
    high = rough.shape[1] // max(MINIMA, k)
    if high > 1 and rough.dtype == np.float32:  # no member is NaN
        wide = rough.shape[1] // high
        rough = rough[:, : high * wide].reshape(len(rough), high, wide).min(axis=1)
    return np.partition(rough, k - 1, axis=1)[:, k - 1].astype(np.float64)


def _closest(
    rows: _Rows, queries: np.ndarray, k: int, beyond: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, row, distance)`` of all rows that may be among the ``k`` nearest.

    A matrix product gives distances up to rounding; rows within the slack of
    a bound on the k-th one, and not farther than ``beyond``, are measured
    again exactly.
    """
    vectors = rows.vectors
    if vectors.shape[1] != queries.shape[1]:
        raise ValueError(f"store dimension {vectors.shape[1]}, query dimension {queries.shape[1]}")
    q2 = (queries**2).sum(axis=1)
    rough, slack = rows.distances(queries, q2)

    def within(limit: np.ndarray) -> np.ndarray:
        most = limit - q2 + slack
        most = np.where(np.isnan(most), np.inf, most).astype(rough.dtype)
        return rough <= np.nextafter(most, rough.dtype.type(np.inf))[:, None]

    near = within(beyond) if len(vectors) <= k or np.isfinite(beyond).all() else None
    if near is None or (len(vectors) > k and np.count_nonzero(near) > LOOSE * k * len(queries)):
        near = within(np.minimum(beyond, _bound(rough, k) + q2 + slack))
    query, row = np.divmod(np.flatnonzero(near), len(vectors))
    exact = np.empty(len(row))
    step = max(1, TILE // (4 * max(vectors.shape[1], 1)))
    for at in range(0, len(row), step):  # equal vectors can be many
        some = slice(at, at + step)
        exact[some] = ((vectors[row[some]] - queries[query[some]]) ** 2).sum(axis=1)
    return query, row, np.round(exact, DECIMALS)


def _cut(query: np.ndarray, score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Which candidates are among the ``k`` nearest of their query, ties by ``place``."""
    order = np.lexsort((place, score, query))
    ordered = query[order]
    first = np.searchsorted(ordered, ordered, side="left")
    return order[np.arange(len(order)) - first < k]


def _keep(table: pa.Table, k: int, id_column: str) -> pa.Table:
    """The ``k`` nearest rows of each query, ties by id."""
    table = table.sort_by([("query_at", "ascending"), ("score", "ascending"), (id_column, "ascending")])
    query = table["query_at"].to_numpy()
    first = np.searchsorted(query, query, side="left")
    return table.take(pa.array(np.flatnonzero(np.arange(len(query)) - first < k)))


def _scored(
    batches: Iterator[pa.RecordBatch], queries: np.ndarray, k: int, id_column: str, vector: str,
    beyond: np.ndarray | None = None,
) -> pa.Table | None:
    """The ``k`` nearest rows of each query over all batches, with ``query_at`` and ``score``.

    Rows farther than ``beyond`` from their query may be left out.
    """
    best: pa.Table | None = None
    beyond = np.full(len(queries), np.inf) if beyond is None else beyond.copy()
    for batch in batches:
        batch = batch.filter(batch[vector].is_valid())
        if not batch.num_rows:
            continue
        matrix = _matrix(batch[vector])
        finite = np.isfinite(matrix).all(axis=1)
        if not finite.all():  # no distance is defined for these rows
            batch, matrix = batch.filter(pa.array(finite)), matrix[finite]
            if not batch.num_rows:
                continue
        ids = batch[id_column]
        place = np.empty(len(ids), np.int64)
        place[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        tiles, rows = [], _Rows(matrix)
        step = max(1, TILE // len(matrix))
        for at in range(0, len(queries), step):  # ties are cut to k before anything is taken
            query, row, score = _closest(rows, queries[at : at + step], k, beyond[at : at + step])
            kept = _cut(query, score, place[row], k)
            tiles.append((query[kept] + at, row[kept], score[kept]))
        query, row, score = (np.concatenate(x) for x in zip(*tiles, strict=True))
        found = pa.table({id_column: ids.take(pa.array(row)), "query_at": pa.array(query, pa.int64()), "score": pa.array(score, pa.float64())})
        best = _keep(found if best is None else pa.concat_tables([best, found]), k, id_column)
        at, scores = best["query_at"].to_numpy(), best["score"].to_numpy()
        full = np.flatnonzero(np.bincount(at, minlength=len(queries)) == k)
        worst = np.zeros(len(queries))
        np.maximum.at(worst, at, scores)
        beyond[full] = np.minimum(beyond[full], worst[full])
    return best


def _merge(partial: DataFrame, k: int, id_column: str) -> DataFrame:
    """The ``k`` best per query, merged in two steps so that no task sees every task's rows."""
    order = [F.col("score"), F.col(id_column)]
    grouped = partial.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    some = Window.partitionBy("query_id", "_group").orderBy(*order)
    final = Window.partitionBy("query_id").orderBy(*order)
    some_best = grouped.withColumn("_rank", F.row_number().over(some)).filter(F.col("_rank") <= k)
    ranked = some_best.drop("_group", "_rank").withColumn("rank", F.row_number().over(final))
    return ranked.filter(F.col("rank") <= k)


def block_side(spark: SparkSession) -> int:
    """Slices and blocks that keep every core busy however few the rows."""
    return ceil(sqrt(2 * spark.sparkContext.defaultParallelism))


def nearest(
    store: DataFrame, queries: DataFrame, k: int = TOP_K, id_column: str = "chunk_id",
    vector: str = "embedding", query_rows: int = QUERY_ROWS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``query_id, rank``, the store's columns without the vector, and ``score``.

    ``queries`` holds ``(query_id, embedding)`` and is evaluated once.  Query
    vectors within the bounds on rows and bytes go to every task with the
    function; more of them are searched block by block.  Rows without a vector
    have no neighbours.  Ids name the rows of the store.
    """
    queries = cut_lineage(queries.select("query_id", "embedding"), "queries")
    payload = [f for f in store.schema.fields if f.name not in (vector, id_column)]
    query_field = StructField("query_id", queries.schema["query_id"].dataType)
    schema = StructType([query_field, store.schema[id_column], StructField("score", DoubleType())])
    narrow = store.select(id_column, vector)
    size = queries.agg(F.count("*").alias("rows"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("width")).first()
    if size["rows"] <= query_rows and size["rows"] * size["width"] * 4 <= QUERY_BYTES:
        partial = _search_with_all(narrow, queries.toArrow(), k, id_column, vector, schema)
    else:
        per_block = max(1, min(BLOCK_ROWS, QUERY_BYTES // (4 * max(size["width"], 1))))
        blocks = max(ceil(size["rows"] / per_block), block_side(store.sparkSession))
        partial = _search_blocks(narrow, queries, k, id_column, vector, schema, blocks, cell_rows)
    hits = _merge(partial, k, id_column).select("query_id", "rank", id_column, "score")
    if not payload:
        return hits
    hits = cut_lineage(hits, "hits")
    side = F.broadcast(hits) if hits.count() <= HIT_ROWS else hits
    names = [f.name for f in store.schema.fields if f.name != vector]
    return store.drop(vector).join(side, id_column).select("query_id", "rank", *names, "score")


def _search_with_all(store, rows, k, id_column, vector, schema) -> DataFrame:
    """``rows`` holds the query vectors, within the bounds on rows and bytes."""
    rows = rows.filter(rows["embedding"].is_valid())
    ids, matrix = rows["query_id"], _matrix(rows["embedding"])
    names = schema.names

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _scored(batches, matrix, k, id_column, vector) if len(matrix) else None
        if best is not None:
            yield from best.append_column("query_id", ids.take(best["query_at"])).select(names).to_batches()

    return store.mapInArrow(search, schema)


def _search_blocks(store, queries, k, id_column, vector, schema, blocks, cell_rows) -> DataFrame:
    """Store slices meet query blocks in cells of bounded size on both sides.

    Rows are spread over slices and blocks by the hash of their id.
    """
    slices = max(block_side(store.sparkSession), ceil(store.count() / cell_rows))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_slice = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    left = store.withColumn("_slice", F.pmod(F.xxhash64(id_column), F.lit(slices)).cast("int")).withColumn(
        "_block", every_block
    )
    right = queries.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn(
        "_slice", every_slice
    )
    names = schema.names

    def search(rows: pa.Table, block: pa.Table) -> pa.Table:
        block = block.filter(block["embedding"].is_valid())
        matrix = _matrix(block["embedding"])
        rows = rows.drop_columns(["_slice", "_block"])
        best = _scored(rows.combine_chunks().to_batches(), matrix, k, id_column, vector) if len(matrix) else None
        if best is None:
            empty = rows.slice(0, 0).drop_columns([vector])
            best = empty.append_column("query_at", pa.array([], pa.int64())).append_column(
                "score", pa.array([], pa.float64())
            )
        return best.append_column("query_id", block["query_id"].take(best["query_at"])).select(names)

    return (
        left.groupBy("_block", "_slice").cogroup(right.groupBy("_block", "_slice")).applyInArrow(search, schema)
    )
