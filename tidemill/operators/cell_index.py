"""Approximate nearest neighbours over an inverted file of k-means cells.

Building the index:

* cells are fitted by k-means on a seeded sample of at most ``SAMPLE_ROWS``
  vectors (``round(sqrt(rows))`` cells, fewer if the sample is smaller);
* every row of the store is assigned to its nearest centroid on the
  executors; rows without a usable vector get cell ``-1`` and are never found;
* a cell holding more than ``SPLIT_ROWS`` rows is split into sub-cells by the
  hash of the id, so that no task holds more than about that many rows;
* the store is written partitioned by cell, beside a table of centroids with
  their row counts, so that a search reads only the folders of its cells.

Searching: every query lists its ``probes`` nearest centroids; store rows, in
groups of cells, and queries, in blocks, meet once per (group, block), each
query against the cells it lists there; the ``k`` nearest of each meeting are
kept, and a window per query merges them (ties by id).  ``probes`` is the caller's, or
the smallest power of two whose measured recall reaches ``TARGET`` on a seeded
calibration set of at most ``CALIBRATION`` queries compared with the exact
search; all cells give the exact answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from .vector_search import BLOCK_ROWS, _keep, _matrix, _scored, block_side, nearest

SAMPLE_ROWS = 20_000
SPLIT_ROWS = 20_000
# Store rows of the cells that meet queries in one task, and queries whose cells are listed at once.
GROUP_ROWS = 20_000
PROBE_ROWS = 1024
ITERATIONS = 12
SEED = 7
TARGET = 0.95
CALIBRATION = 200


@dataclass
class CellStore:
    path: str
    centroids: np.ndarray
    id_column: str
    vector: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")

    def cells(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/cells")


def _usable(vector: str) -> F.Column:
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x))


def kmeans(sample: np.ndarray, cells: int, seed: int = SEED, iterations: int = ITERATIONS) -> np.ndarray:
    """Centroids by Lloyd's iterations from a seeded k-means++ start."""
    rng = np.random.default_rng(seed)
    centres = [sample[rng.integers(len(sample))]]
    far = ((sample - centres[0]) ** 2).sum(1)
    for _ in range(1, cells):
        chosen = rng.choice(len(sample), p=far / far.sum()) if far.sum() > 0 else rng.integers(len(sample))
        centres.append(sample[chosen])
        far = np.minimum(far, ((sample - sample[chosen]) ** 2).sum(1))
    centres = np.array(centres)
    for _ in range(iterations):
        nearest_cell = _nearest_cells(sample, centres, 1)[:, 0]
        for c in range(cells):
            members = sample[nearest_cell == c]
            if len(members):
                centres[c] = members.mean(0)
    return centres


def _nearest_cells(vectors: np.ndarray, centres: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` nearest centroids of every vector, nearest first."""
    d = (vectors**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * vectors @ centres.T
    count = min(count, len(centres))
    part = np.argpartition(d, count - 1, axis=1)[:, :count] if count < len(centres) else np.tile(np.arange(len(centres)), (len(d), 1))
    order = np.take_along_axis(d, part, 1).argsort(1, kind="stable")
    return np.take_along_axis(part, order, 1)


def build(store: DataFrame, path: str, id_column: str = "vec_id", vector: str = "embedding") -> CellStore:
    """Fit the cells, assign every row and write the store partitioned by cell."""
    usable = store.where(_usable(vector))
    rows = usable.count()
    fraction = min(1.0, 1.2 * SAMPLE_ROWS / max(rows, 1))
    picked = usable.sample(fraction=fraction, seed=SEED).select(vector).limit(SAMPLE_ROWS).toArrow()
    sample = _matrix(picked[vector]) if picked.num_rows else np.zeros((0, 0))
    cells = max(1, min(round(sqrt(rows)), len(sample)))
    centres = kmeans(sample, cells) if len(sample) else np.zeros((0, 0))
    schema = StructType([*store.schema.fields, StructField("cell", IntegerType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.full(batch.num_rows, -1, np.int32)
            column = batch[vector]
            ok = column.is_valid().to_numpy(zero_copy_only=False)
            if ok.any() and len(centres):
                lengths = np.diff(column.offsets.to_numpy())
                flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
                starts = column.offsets.to_numpy()[:-1] - column.offsets.to_numpy()[0]
                good = ok & (lengths == centres.shape[1])
                if good.any():
                    at = np.flatnonzero(good)
                    matrix = np.stack([flat[starts[i] : starts[i] + lengths[i]] for i in at])
                    finite = np.isfinite(matrix).all(1)
                    cell[at[finite]] = _nearest_cells(matrix[finite], centres, 1)[:, 0]
            yield batch.append_column("cell", pa.array(cell, pa.int32()))

    placed = store.mapInArrow(assign, schema)
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
    subs = sizes.select("cell", "rows", F.greatest(F.lit(1), F.ceil(F.col("rows") / SPLIT_ROWS)).cast("int").alias("subs"))
    subs.write.mode("overwrite").parquet(f"{path}/sizes")
    split = store.sparkSession.read.parquet(f"{path}/sizes")
    tagged = placed.join(F.broadcast(split.select("cell", "subs")), "cell").withColumn(
        "sub", F.pmod(F.xxhash64(id_column), F.col("subs")).cast("int")
    ).drop("subs")
    tagged.repartition("cell", "sub").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
    spark = store.sparkSession
    table = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centroid array<double>")
    table.join(split, "cell", "left").write.mode("overwrite").parquet(f"{path}/cells")
    return CellStore(path, centres, id_column, vector)


def _cell_groups(index: CellStore, spark: SparkSession) -> list[tuple[int, int, int]]:
    """``(cell, sub, group)`` of all sub-cells: neighbours in number share a group of about ``GROUP_ROWS`` rows."""
    units, group, held = [], 0, 0
    for cell, rows, subs in sorted(index.cells(spark).where("subs is not null").select("cell", "rows", "subs").toLocalIterator()):
        for sub in range(subs):
            if held and held + rows / subs > GROUP_ROWS:
                group, held = group + 1, 0
            units.append((cell, sub, group))
            held += rows / subs
    return units


def search(index: CellStore, queries: DataFrame, k: int, probes: int) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest rows among the ``probes`` nearest cells.

    Cells meet queries in groups: a query goes once to every group that holds
    one of its cells, with the list of those cells, in blocks of queries of
    bounded size.
    """
    spark = queries.sparkSession
    centres = index.centroids
    names = queries.select("query_id", "embedding")
    units = _cell_groups(index, spark)
    groups_of: list[list[int]] = [[] for _ in range(len(centres))]
    for cell, _, group in units:
        if group not in groups_of[cell]:
            groups_of[cell].append(group)
    counts = np.array([len(g) for g in groups_of], np.int64)
    starts, flat = np.cumsum(counts) - counts, np.array([g for of in groups_of for g in of], np.int64)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PROBE_ROWS):
                batch = whole.slice(at, PROBE_ROWS)
                batch = batch.filter(batch["embedding"].is_valid())
                if not batch.num_rows or not len(centres):
                    continue
                near = _nearest_cells(_matrix(batch["embedding"]), centres, probes)
                query, cell = np.repeat(np.arange(batch.num_rows), near.shape[1]), near.ravel()
                times = counts[cell]
                within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                group = flat[np.repeat(starts[cell], times) + within]
                query, cell = np.repeat(query, times), np.repeat(cell, times)
                order = np.lexsort((cell, group, query))
                query, cell, group = query[order], cell[order], group[order]
                new = np.flatnonzero(np.r_[True, (np.diff(query) != 0) | (np.diff(group) != 0)][: len(query)])
                lists = pa.ListArray.from_arrays(pa.array(np.r_[new, len(query)].astype(np.int32)), pa.array(cell.astype(np.int32)))
                at_row = pa.array(query[new])
                yield pa.RecordBatch.from_arrays(
                    [batch["query_id"].take(at_row), batch["embedding"].take(at_row), lists, pa.array(group[new].astype(np.int32))],
                    names=["query_id", "embedding", "cells", "group"],
                )

    blocks = max(ceil(queries.count() / BLOCK_ROWS), block_side(spark))
    asked = names.mapInArrow(probe, "query_id long, embedding array<float>, cells array<int>, group int")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    placed = spark.createDataFrame(units, "cell int, sub int, group int")
    rows = index.read(spark).select(index.id_column, index.vector, "cell", "sub").join(F.broadcast(placed), ["cell", "sub"]).drop("sub")
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    schema = f"query_id long, {index.id_column} long, score double"

    def meet(store: pa.Table, block: pa.Table) -> pa.Table:
        found = []
        if store.num_rows and block.num_rows:
            store, block = store.combine_chunks(), block.combine_chunks()
            matrix = _matrix(block["embedding"])
            lists = block["cells"].combine_chunks()
            lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
            asks, asked_cell = np.repeat(np.arange(block.num_rows), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
            cell = store["cell"].to_numpy()
            nearest_yet = np.full((block.num_rows, k), np.inf)
            for c in np.unique(cell):
                some = asks[asked_cell == c]
                if not len(some):
                    continue
                held = store.select([index.id_column, index.vector]).take(pa.array(np.flatnonzero(cell == c))).combine_chunks()
                best = _scored(held.to_batches(), matrix[some], k, index.id_column, index.vector, nearest_yet[some, -1])
                if best is not None:
                    query, score = best["query_at"].to_numpy(), best["score"].to_numpy()
                    found.append(pa.table({"query_at": pa.array(some[query], pa.int64()), index.id_column: best[index.id_column], "score": best["score"]}))
                    here = np.full((len(some), k), np.inf)
                    here[query, np.arange(len(query)) - np.searchsorted(query, query)] = score
                    nearest_yet[some] = np.sort(np.hstack([nearest_yet[some], here]), axis=1)[:, :k]
        if not found:
            return pa.table({"query_id": [], index.id_column: [], "score": []}, schema=pa.schema([("query_id", pa.int64()), (index.id_column, pa.int64()), ("score", pa.float64())]))
        best = _keep(pa.concat_tables(found), k, index.id_column)
        return pa.table({"query_id": block["query_id"].take(best["query_at"]), index.id_column: best[index.id_column], "score": best["score"]})

    found = rows.groupBy("group", "block").cogroup(asked.groupBy("group", "block")).applyInArrow(meet, schema)
    order = Window.partitionBy("query_id").orderBy("score", index.id_column)
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", index.id_column, "score")


def calibrate(index: CellStore, store: DataFrame, k: int, target: float = TARGET) -> tuple[int, float]:
    """The fewest probes (a power of two, or all cells) whose recall on a sample of queries reaches ``target``."""
    spark = store.sparkSession
    picked = store.where(_usable(index.vector)).sample(fraction=min(1.0, 2.0 * CALIBRATION / max(store.count(), 1)), seed=SEED + 1)
    asked = picked.select(F.col(index.id_column).alias("query_id"), index.vector).where("query_id is not null")
    vectors = asked.limit(CALIBRATION).toArrow()  # taken once: a second evaluation may take other rows
    asked = spark.createDataFrame(vectors, asked.schema)
    exact = nearest(store.select(index.id_column, index.vector), asked, k, id_column=index.id_column)
    placed = index.read(spark).select(index.id_column, "cell")
    truth = exact.join(placed, index.id_column).select("query_id", "cell").toPandas()
    if not len(truth) or not len(index.centroids):
        return max(1, len(index.centroids)), 1.0
    order = _nearest_cells(_matrix(vectors[index.vector]), index.centroids, len(index.centroids))
    where = {q: {c: r for r, c in enumerate(row)} for q, row in zip(vectors["query_id"].to_pylist(), order, strict=True)}
    ranks = np.array([where[q][c] for q, c in zip(truth["query_id"], truth["cell"], strict=True)])
    probes = 1
    while probes < len(index.centroids) and (ranks < probes).mean() < target:
        probes *= 2
    probes = min(probes, len(index.centroids))
    return probes, float((ranks < probes).mean())


def recall(approx: DataFrame, exact: DataFrame, id_column: str) -> DataFrame:
    """``(query_id, recall)``: the share of the exact neighbours that the approximate search found."""
    truth = exact.select("query_id", id_column, F.lit(1).alias("t"))
    found = approx.select("query_id", id_column, F.lit(1).alias("a"))
    both = truth.join(found, ["query_id", id_column], "left")
    return both.groupBy("query_id").agg((F.count("a") / F.count("t")).alias("recall"))


def checked(index: CellStore, spark: SparkSession) -> DataFrame:
    """The stored rows with ``nearest_cell``: whether the folder they are read from is their nearest centroid's."""
    rows = index.read(spark)
    centres = index.centroids
    schema = StructType([*rows.schema.fields, StructField("nearest_cell", BooleanType())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch["cell"].to_numpy(zero_copy_only=False)
            good = np.zeros(batch.num_rows, bool)
            valid = (cell >= 0) & batch[index.vector].is_valid().to_numpy(zero_copy_only=False)
            if valid.any() and len(centres):
                at = np.flatnonzero(valid)
                good[at] = _nearest_cells(_matrix(batch[index.vector].take(pa.array(at))), centres, 1)[:, 0] == cell[at]
            yield batch.append_column("nearest_cell", pa.array(good))

    return rows.mapInArrow(check, schema)
