"""Hard-negative mining with segment summaries that bound inner products.

Every vector is cut into segments, and each segment is stored as its mean and
its deviation.  For two vectors and a segment of ``m`` components

    sum a_i b_i = m mean_a mean_b + sum (a_i - mean_a)(b_i - mean_b),

and by Cauchy-Schwarz the second term lies within ``+- m dev_a dev_b``.  The
sums over the segments bound the score from both sides.  The coarse level (few
long segments) is computed for every pair of a task; only pairs that it cannot
exclude go on to the fine level (more, shorter segments), and only the pairs
that survive that are scored exactly.

The work is a stated query set against all rows, in blocks: anchors are dealt
into blocks of ``ANCHOR_BLOCK`` and rows into cells of ``CELL_ROWS`` by a hash
of their id, and each (block, cell) is one task.  No label is a key, so a label
that holds a third of all rows is spread like any other.  A first pass finds
every anchor's positives (best of its cell, then best overall by a window per
anchor); a second pass, with the positives' scores carried by the anchors,
finds the negatives in the same way.

Rules, given by the contract of the query:

* rows with a null id, label or vector, an empty vector, or a null or
  non-finite component take no part;
* a row whose id is divisible by 7 has its label moved to ``(label + 1) % 10``;
* components become ``floor(256 * x)`` with ``x`` as double; scores are exact
  integers (doubles while they are exact, Python integers beyond), and a score
  beyond 64 bits fails the query;
* rows equal in id, label and vector count once; rows that share an id but not
  their vector stay apart, each its own anchor and its own candidate;
* an anchor's positives are the best 5 rows of its label with another id;
  its negatives for a positive of score ``p`` are the best 10 rows of another
  label with ``30 p <= 100 n <= 90 p`` (none when ``p < 0``); ties go to the
  smaller id;
* vectors of another length than the anchor's never meet it;
* an empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
CELL_ROWS = 4_096
ANCHOR_BLOCK = 1_024
#: Segments per level, coarse first.
LEVELS = (4, 16)
POSITIVES, NEGATIVES = 5, 10
#: Anchors (or anchor and positive pairs) whose bound matrices a task holds at once.
CHUNK = 128
#: Above this share of pairs spared by the coarse level, the survivors are scored by one matrix product.
COARSE_ONLY = 0.5
LOW, HIGH = 30, 90


def usable_rows(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(id, label, dims, x)``: rows that take part, labels moved, exact repeats once."""
    number = F.col(vector).cast("array<double>")
    sound = F.forall(number, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    moved = F.when(F.col(key) % 7 == 0, F.pmod(F.col(label) + 1, F.lit(10))).otherwise(F.col(label))
    return (
        rows.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & sound)
        .select(F.col(key).cast("long").alias("id"), moved.cast("int").alias("label"), F.size(vector).alias("dims"), F.transform(number, lambda v: v * SCALE).alias("x"))
        .dropDuplicates(["id", "label", "x"])
    )


class Summaries:
    """Integer vectors of a task with their segment means and deviations per level."""

    def __init__(self, frame: pd.DataFrame):
        self.ids = frame["id"].to_numpy(np.int64)
        self.labels = frame["label"].to_numpy(np.int64)
        width = int(frame["dims"].iloc[0]) if len(frame) else 0
        self.v = np.floor(np.stack(frame["x"].to_numpy())) if len(frame) else np.zeros((0, width))
        peak = float(np.abs(self.v).max(initial=0))
        self.peak = peak
        self.levels = []
        for count in LEVELS:
            starts = np.array([part[0] for part in np.array_split(np.arange(width), min(count, width))], np.int64)
            sizes = np.diff(np.append(starts, width)).astype(np.float64)
            mean = np.add.reduceat(self.v, starts, axis=1) / sizes if len(self.v) else np.zeros((0, len(starts)))
            centred = self.v - np.repeat(mean, sizes.astype(np.int64), axis=1)
            dev = np.sqrt(np.add.reduceat(centred * centred, starts, axis=1) / sizes) if len(self.v) else mean
            self.levels.append((sizes, mean, dev))


def _bounds(a: Summaries, rows: Summaries, level: int, which, places) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of anchors ``which`` against rows ``places``, as a matrix."""
    sizes, mean_a, dev_a = a.levels[level]
    _, mean_r, dev_r = rows.levels[level]
    ma, da = mean_a[which] * sizes, dev_a[which] * sizes
    mr, dr = mean_r[places], dev_r[places]
    centre, spread = ma @ mr.T, da @ dr.T
    slack = 1e-9 * (np.abs(ma) @ np.abs(mr).T + spread) + 1e-6
    return centre - spread - slack, centre + spread + slack


def _pair_bounds(a: Summaries, rows: Summaries, level: int, ai: np.ndarray, rj: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same bounds for the pairs ``(ai[p], rj[p])`` alone."""
    sizes, mean_a, dev_a = a.levels[level]
    _, mean_r, dev_r = rows.levels[level]
    ma, mr = mean_a[ai] * sizes, mean_r[rj]
    centre = np.einsum("ps,ps->p", ma, mr)
    spread = np.einsum("ps,ps->p", dev_a[ai] * sizes, dev_r[rj])
    slack = 1e-9 * (np.einsum("ps,ps->p", np.abs(ma), np.abs(mr)) + spread) + 1e-6
    return centre - spread - slack, centre + spread + slack


def _exact(a: Summaries, rows: Summaries, ai: np.ndarray, rj: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the pairs ``(ai[p], rj[p])``."""
    peak = max(a.peak, rows.peak)
    if peak * peak * max(1, a.v.shape[1]) < 2**52:
        return np.rint(np.einsum("pd,pd->p", a.v[ai], rows.v[rj])).astype(np.int64)
    scores = [sum(int(p) * int(q) for p, q in zip(a.v[i], rows.v[j], strict=True)) for i, j in zip(ai, rj, strict=True)]
    return np.array(scores, dtype=np.int64)  # beyond 64 bits this raises


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th largest value of every row (minus infinity where fewer are finite)."""
    if values.shape[1] < k:
        return np.full(values.shape[0], -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def _first(group: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the best ``k`` scores of every group, ties to the smaller id."""
    order = np.lexsort((ids, -scores, group))
    group = group[order]
    starts = np.searchsorted(group, group, "left")
    return order[np.arange(len(order)) - starts < k]


def _choose(a: Summaries, rows: Summaries, owner: np.ndarray, anchors_lo: np.ndarray, anchors_hi: np.ndarray, keep, within, k: int):
    """Pairs ``(p, j)`` and exact scores of the best ``k`` rows ``j`` of every query row ``p``.

    ``owner[p]`` is the anchor of query row ``p`` (an index into the first
    axis of the anchor bound matrices).  ``keep(lo, hi, p)`` rules pairs out by
    their bounds, and ``within(scores, p)`` by their exact scores.  When the
    coarse level spares more than ``COARSE_ONLY`` of the pairs, the finer
    levels would spare as many: the survivors are then scored by one product of
    the chunk with the cell and chosen by partition.
    """
    local = np.unique(owner, return_inverse=True)
    lo, hi = anchors_lo[local[1]], anchors_hi[local[1]]
    chosen = keep(lo, hi, np.arange(len(owner)))
    if chosen.sum() > COARSE_ONLY * chosen.size and max(a.peak, rows.peak) ** 2 * max(1, a.v.shape[1]) < 2**52:
        exact = np.rint(a.v[local[0]] @ rows.v.T)[local[1]]
        allowed = chosen & within(exact, np.arange(len(owner))[:, None])
        values = np.where(allowed, exact, -np.inf)
        p, j = np.nonzero(allowed & (values >= _kth(values, k)[:, None]))
        scores = exact[p, j].astype(np.int64)
    else:
        p, j = np.nonzero(chosen)
        lo, hi = lo[p, j], hi[p, j]
        for level in range(1, len(LEVELS)):
            if not len(p):
                break
            flo, fhi = _pair_bounds(a, rows, level, owner[p], j)
            lo, hi = np.maximum(lo, flo), np.minimum(hi, fhi)
            dense_lo, dense_hi = np.full(chosen.shape, -np.inf), np.full(chosen.shape, -np.inf)
            dense_lo[p, j], dense_hi[p, j] = lo, hi
            spared = keep(dense_lo, dense_hi, np.arange(len(owner)))[p, j]
            p, j, lo, hi = p[spared], j[spared], lo[spared], hi[spared]
        scores = _exact(a, rows, owner[p], j)
        inside = within(scores, p)
        p, j, scores = p[inside], j[inside], scores[inside]
    best = _first(p, rows.ids[j], scores, k)
    return p[best], j[best], scores[best]


def positives_of_cell(anchors: pd.DataFrame, cell: pd.DataFrame, k: int = POSITIVES) -> pd.DataFrame:
    """The best ``k`` rows of the cell per anchor: its label, another id."""
    out = {"anchor": [], "positive_id": [], "positive_score": []}
    if len(anchors) and len(cell):
        a, rows = Summaries(anchors), Summaries(cell)
        for chunk in np.array_split(np.arange(len(a.ids)), -(-len(a.ids) // CHUNK)):
            lo, hi = _bounds(a, rows, 0, chunk, slice(None))
            mine = (rows.labels[None, :] == a.labels[chunk, None]) & (rows.ids[None, :] != a.ids[chunk, None])
            lo, hi = np.where(mine, lo, -np.inf), np.where(mine, hi, -np.inf)
            p, j, scores = _choose(a, rows, chunk, lo, hi, lambda lo, hi, _: np.isfinite(lo) & (hi >= _kth(lo, k)[:, None]), lambda s, _: np.ones(np.shape(s), bool), k)
            out["anchor"] += anchors["anchor"].to_numpy()[chunk[p]].tolist()
            out["positive_id"] += rows.ids[j].tolist()
            out["positive_score"] += scores.tolist()
    return pd.DataFrame(out).astype("int64")


def negatives_of_cell(anchors: pd.DataFrame, cell: pd.DataFrame, k: int = NEGATIVES) -> pd.DataFrame:
    """The best ``k`` rows of the cell in the window of every positive of every anchor."""
    out = {"anchor": [], "positive_id": [], "negative_id": [], "negative_score": []}
    if len(anchors) and len(cell):
        a, rows = Summaries(anchors), Summaries(cell)
        counts = anchors["positive_ids"].map(len).to_numpy()
        owner_all = np.repeat(np.arange(len(anchors)), counts)
        positive_all = np.concatenate([np.asarray(x, np.int64) for x in anchors["positive_ids"]]) if counts.sum() else np.empty(0, np.int64)
        score_all = np.concatenate([np.asarray(x, np.int64) for x in anchors["positive_scores"]]) if counts.sum() else np.empty(0, np.int64)
        ok = score_all >= 0
        owner_all, positive_all, score_all = owner_all[ok], positive_all[ok], score_all[ok]
        for chunk in np.array_split(np.arange(len(a.ids)), -(-len(a.ids) // CHUNK)):
            mine = np.isin(owner_all, chunk)
            if not mine.any():
                continue
            owner, positive, ps = owner_all[mine], positive_all[mine], score_all[mine]
            lo, hi = _bounds(a, rows, 0, np.unique(owner), slice(None))
            other = rows.labels[None, :] != a.labels[np.unique(owner), None]
            lo, hi = np.where(other, lo, -np.inf), np.where(other, hi, -np.inf)
            floor_, ceiling = LOW * ps.astype(np.float64), HIGH * ps.astype(np.float64)

            def keep(lo, hi, p, floor_=floor_, ceiling=ceiling):
                maybe = np.isfinite(lo) & (100 * hi >= floor_[p, None]) & (100 * lo <= ceiling[p, None])
                sure = maybe & (100 * lo >= floor_[p, None]) & (100 * hi <= ceiling[p, None])
                return maybe & (hi >= _kth(np.where(sure, lo, -np.inf), k)[:, None])

            def within(scores, p, ps=ps):
                return (100 * scores >= LOW * ps[p]) & (100 * scores <= HIGH * ps[p])

            p, j, scores = _choose(a, rows, owner, lo, hi, keep, within, k)
            out["anchor"] += anchors["anchor"].to_numpy()[owner[p]].tolist()
            out["positive_id"] += positive[p].tolist()
            out["negative_id"] += rows.ids[j].tolist()
            out["negative_score"] += scores.tolist()
    return pd.DataFrame(out).astype("int64")


def _dealt(data: DataFrame, anchors: DataFrame, extra: list[str]) -> tuple:
    """Anchors in every cell and rows in every block, keyed by ``(block, cell, dims)``."""
    cells = max(1, -(-data.count() // CELL_ROWS))
    blocks = max(1, -(-anchors.count() // ANCHOR_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = anchors.select(*[F.col(c).alias(c) for c in ["anchor", "id", "label", "dims", "x", *extra]], F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int").alias("block"), every(cells).alias("cell"))
    given = data.select(*[F.col(c).alias(c) for c in ["id", "label", "dims", "x"]], F.pmod(F.xxhash64("id", F.lit(5)), F.lit(cells)).cast("int").alias("cell"), every(blocks).alias("block"))
    keys = ["block", "cell", "dims"]
    return asked.groupBy(*keys), given.groupBy(*keys)


def hard_negatives(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for every anchor."""
    data = usable_rows(rows, key, vector, label)
    anchors = data.where(F.col("id") % 100 == 0).withColumn("anchor", F.xxhash64("id", "label", "x"))
    asked, given = _dealt(data, anchors, [])
    found = asked.cogroup(given).applyInPandas(lambda q, c: positives_of_cell(q, c), "anchor long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    positives = found.withColumn("p", F.row_number().over(first)).where(F.col("p") <= POSITIVES)
    carried = positives.groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("p", "positive_id", "positive_score"))).alias("ps")
    ).select("anchor", F.col("ps.positive_id").alias("positive_ids"), F.col("ps.positive_score").alias("positive_scores"))
    armed = anchors.join(carried, "anchor")
    asked, given = _dealt(data, armed, ["positive_ids", "positive_scores"])
    hits = asked.cogroup(given).applyInPandas(lambda q, c: negatives_of_cell(q, c), "anchor long, positive_id long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
    named = anchors.select("anchor", F.col("id").alias("anchor_id"))
    return ranked.join(positives.select("anchor", "positive_id", "positive_score"), ["anchor", "positive_id"]).join(named, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
