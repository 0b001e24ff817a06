"""Exact top-k inner products by the threshold algorithm over sorted lists per dimension.

Vectors become integers, ``floor(1024 * x)`` of every component.  Rows are
dealt into cells of bounded size, and every block of queries visits every
cell.  A cell sorts each dimension once.  A query then goes down all lists in
step, from the end that its own sign prefers, scores the rows met so far, and
stops as soon as no row below can reach its k-th score: the bound is the sum
over dimensions of its component times the value at the current depth.
Reports of cells merge by rank, cut to k per query before they are shuffled.

Vectors that are null, empty or hold null or non-finite components take no
part, nor do rows without an id, nor rows with a component whose integer
reaches ``sqrt(2^63 / dims)`` (their scores could leave 64 bits); vectors of
another length than the query meet it nowhere.  A query never meets rows with
its own id.  Ties go to the smaller id; repeated candidate rows are reported
as often as they occur, while a repeated query row asks once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL_ROWS = 16_384
QUERY_BLOCK = 1_024
SCALE = 1024
FIRST_DEPTH = 64


def integer_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, dims, ints)`` of the rows that take part."""
    number = F.col(vector).cast("array<double>")
    # A score must fit in 64 bits: |floor(1024 x)| below sqrt(2^63 / dims) for every component.
    reach = F.sqrt(F.lit(float(2**63)) / F.size(vector)) / SCALE
    sound = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < reach))
    return (
        rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & sound)
        .select(F.col(key).cast("long").alias("id"), F.size(vector).alias("dims"), F.transform(number, lambda x: F.floor(x * SCALE).cast("long")).alias("ints"))
    )


def _exact(values: np.ndarray) -> np.ndarray:
    """Integers in a type in which inner products of this size are exact."""
    peak = float(np.abs(values).max(initial=0))
    return values.astype(np.float64) if peak * peak * values.shape[1] < 2**52 else values.astype(object)


def top_of_cell(query: np.ndarray, own: int, data: np.ndarray, ids: np.ndarray, up: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the best ``k`` rows of a cell, by score and then by id.

    ``up[d]`` lists the rows by rising value of dimension ``d``.
    """
    count, width = data.shape
    used = np.flatnonzero(query != 0)
    rising = query[used] < 0
    seen = np.zeros(count, bool)
    places, scores = np.empty(0, np.int64), np.empty(0, data.dtype)
    depth, done = min(FIRST_DEPTH, count), 0
    while True:
        # The next stretch of every list, from the side that the sign of the query prefers.
        if len(used):
            new = np.where(rising[:, None], up[used, done:depth], up[used, count - depth : count - done])
            seen_before = seen.copy()
            seen[new.ravel()] = True
            fresh = np.flatnonzero(seen & ~seen_before)
        else:
            fresh, depth = np.arange(count), count
        fresh = fresh[ids[fresh] != own]
        places = np.concatenate([places, fresh])
        scores = np.concatenate([scores, data[fresh] @ query])
        best = np.lexsort((ids[places], -scores))[:k]
        places, scores = places[best], scores[best]
        if depth >= count:
            return places, scores
        edge = np.where(rising, up[used, depth - 1], up[used, count - depth])
        bound = (query[used] * data[edge, used]).sum()
        if len(scores) == k and scores[-1] > bound:
            return places, scores
        done, depth = depth, min(depth * 4, count)


def top_k(rows: DataFrame, query_filter: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best rows of every row that passes ``query_filter``."""
    data = integer_vectors(rows, key, vector)
    queries = integer_vectors(rows.where(query_filter), key, vector).dropDuplicates(["id", "ints"])
    cells = max(1, -(-data.count() // CELL_ROWS))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    spark = rows.sparkSession
    every_cell = F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    asked = queries.select("dims", "id", "ints", every_cell.alias("cell"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"))
    given = data.select("dims", "id", "ints", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(cells)).cast("int").alias("cell"), every_block.alias("block"))

    def answer(asking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(asking) and len(offered):
            data = _exact(np.stack(offered["ints"].to_numpy()))
            wanted = np.stack(asking["ints"].to_numpy()).astype(data.dtype)
            if data.dtype != object and float(np.abs(data).max(initial=0)) * float(np.abs(wanted).max(initial=0)) * data.shape[1] >= 2**52:
                data, wanted = data.astype(np.int64).astype(object), wanted.astype(np.int64).astype(object)
            ids = offered["id"].to_numpy()
            up = np.argsort(data.T.astype(np.float64), axis=1, kind="stable") if data.dtype != object else np.array([np.argsort(c, kind="stable") for c in data.T])
            for own, query in zip(asking["id"].to_numpy(), wanted, strict=True):
                places, scores = top_of_cell(query, own, data, ids, up, k)
                out["query_id"] += [own] * len(places)
                out["vec_id"] += ids[places].tolist()
                out["score"] += [int(s) for s in scores]
        return pd.DataFrame(out).astype("int64")

    keys = ["block", "cell", "dims"]
    best = asked.groupBy(*keys).cogroup(given.groupBy(*keys)).applyInPandas(answer, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
