"""Near-duplicate vectors by sorted projection passes and exact comparison.

Every pass draws ``BITS`` random hyperplanes, writes the signs of a vector as
one 64-bit code and sorts the vectors of each label by it, so that codes with
a long common prefix stand together.  A sweep along each sorted range compares
every vector with the ``WINDOW`` before it, and pairs at or above the cosine
threshold unite.  The passes are independent, so what one order separates
another brings together.

The windows only unite early: what they miss, in dense labels above all, is
found by a second step over all pairs of a label, which counts the links and
unites the components that links connect.  A label of more than ``BLOCK``
vectors is cut into the cells of centres drawn from it; a vector visits the
cells that an angle bound does not rule out, so every partner of a vector is
in its home cell.  Tiles of bounded size are compared by matrix products, and
only counts and one link per pair of components leave a task.  What the bound
cannot rule out costs the square of a label.

Equal vectors of one label fold before the passes and count as links of each
other.  Vectors that are null, empty, zero or hold null or non-finite
components, and rows without label, link with nothing; neither do vectors of
different lengths.  Rows without id link with nothing and get a null
component.  Rows that repeat an id and a vector are one vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.components import connected_components
from tidemill.operators.lookup import join_per_key
from tidemill.session import cut_lineage

PASSES, BITS, WINDOW, SEED = 12, 63, 96, 20
#: Rows on a side of a tile, rows of it that are multiplied at once, and centres of a label at most: how the work is cut, not what is compared.
BLOCK, STEP, CENTERS = 8192, 512, 1024


def _matrix(column: pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(len(lists), -1)


def sound_vector(name: str) -> Column:
    """Whether a vector has a direction: all components finite, one of them not zero."""
    number = F.col(name).cast("array<double>")
    finite = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return finite & F.exists(number, lambda x: x != 0)


def _unit(rows: np.ndarray) -> np.ndarray:
    peak = np.abs(rows).max(axis=1, keepdims=True)
    rows = rows / peak
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def codes(vectors: np.ndarray, turn: int) -> np.ndarray:
    """The signs of one pass as an integer whose order is that of the signs."""
    planes = np.random.default_rng([SEED, turn, vectors.shape[1]]).standard_normal((vectors.shape[1], BITS))
    return (vectors @ planes > 0).astype(np.int64) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def with_codes(vectors: DataFrame) -> DataFrame:
    """``vectors(rep, label, dims, v)`` once per pass, with the pass and the code."""
    schema = T.StructType([*vectors.schema.fields, T.StructField("turn", T.IntegerType()), T.StructField("code", T.LongType())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dims").to_numpy()
            for dims in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dims))
                unit = _unit(_matrix(part.column("v")))
                for turn in range(PASSES):
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(np.full(part.num_rows, turn, np.int32)), pa.array(codes(unit, turn))], names=schema.names
                    )

    return vectors.mapInArrow(code, schema)


def sweep(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links between each row and the ``WINDOW`` rows before it of the same pass, label and length; rows come sorted."""
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        groups = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("turn", "label", "dims")], axis=1)
        cuts = np.flatnonzero(np.concatenate([[True], (groups[1:] != groups[:-1]).any(axis=1), [True]]))
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(a, b - a)
            ids, unit, group = part.column("rep").to_numpy(), _unit(_matrix(part.column("v"))), tuple(groups[a])
            if kept is not None and kept[0] == group:
                before, ids, unit = len(kept[1]), np.concatenate([kept[1], ids]), np.concatenate([kept[2], unit])
            else:
                before = 0
            left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for at in range(before, len(ids), WINDOW):
                low, high = max(0, at - WINDOW), min(len(ids), at + WINDOW)
                row, other = np.nonzero(unit[at:high] @ unit[low:high].T >= threshold)
                row, other = row + at, other + low
                within = (other < row) & (row - other <= WINDOW)
                left.append(other[within])
                right.append(row[within])
            kept = (group, ids[-WINDOW:], unit[-WINDOW:])
            root = roots(len(ids), np.concatenate(left), np.concatenate(right))
            moved = np.flatnonzero(root != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[root[moved]])], names=["u", "v"])


def roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The first row of the linked set of every row: as many edges as rows say which rows hang together."""
    root = np.arange(count)
    while len(left):
        lower = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], lower)
        np.minimum.at(root, root[right], lower)
        while (root != root[root]).any():
            root = root[root]
        open_edge = root[left] != root[right]
        left, right = left[open_edge], right[open_edge]
        if (root == before).all():
            break
    return root


def reach(unit: np.ndarray, centers: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, cell, home``: the cell of the closest centre of every row, and the others that may hold a partner of it.

    A partner lies within ``sqrt(2 - 2 threshold)``, so it can be closer to
    another centre only if the plane halfway to that centre is as near.
    """
    near = unit @ centers.T
    home = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * np.clip(centers @ centers.T, -1, 1), 0))
    gap = near[np.arange(len(unit)), home][:, None] - near
    row, cell = np.nonzero(gap <= (np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6) * apart[home] + 1e-6)
    return row, cell, cell == home[row]


def in_cells(vectors: DataFrame, threshold: float) -> DataFrame:
    """``vectors(rep, n, component, label, dims, v)`` with ``cell`` and ``home``: partners of a vector are all in its home cell, at home or not.

    A label with more than ``BLOCK`` vectors is cut at centres drawn from it.
    """
    named = vectors.withColumn("group", F.concat_ws(":", "label", "dims"))
    sized = join_per_key(named, named.groupBy("group").agg(F.count("*").alias("size")), "group", F.col("rep"))
    fields = ["rep", "n", "component", "label", "dims", "v"]
    schema = T.StructType([*vectors.select(*fields).schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("home", T.BooleanType())])
    small = sized.where(F.col("size") <= BLOCK).select(*fields, F.lit(0).alias("cell"), F.lit(True).alias("home"))
    large = sized.where(F.col("size") > BLOCK).withColumn("chunks", F.ceil(F.col("size") / BLOCK).cast("int"))
    drawn = F.pmod(F.xxhash64("rep", F.lit(5)), F.col("size")) < F.least(F.lit(CENTERS), 2 * F.col("chunks"))
    centers = large.where(drawn).select(
        F.col("group").alias("of"), F.col("rep").alias("center_rep"), F.col("v").alias("center"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("for_chunk")
    )
    chunked = large.select("group", F.pmod(F.xxhash64("rep", F.lit(4)), F.col("chunks")).cast("int").alias("chunk"), *fields)

    def deal(rows: pa.Table, given: pa.Table) -> pa.Table:
        rows = rows.select(fields)
        if not rows.num_rows:
            at, cell, home = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        elif not given.num_rows:
            at, cell, home = np.arange(rows.num_rows), np.zeros(rows.num_rows, np.int64), np.ones(rows.num_rows, bool)
        else:
            given = given.sort_by("center_rep")
            at, cell, home = reach(_unit(_matrix(rows.column("v"))), _unit(_matrix(given.column("center"))), threshold)
        dealt = rows.take(pa.array(at))
        return dealt.append_column("cell", pa.array(cell.astype(np.int32))).append_column("home", pa.array(home))

    cut = chunked.groupBy("group", "chunk").cogroup(centers.groupBy("of", "for_chunk")).applyInArrow(deal, schema)
    return small.union(cut)


def exact_links(vectors: DataFrame, threshold: float) -> DataFrame:
    """``(rep, links, other)`` over all pairs of a label: for ``vectors(rep, n, component, label, dims, v)``, how many rows each links with.

    Rows with ``other`` are links between the components ``rep`` and ``other``.
    """
    dealt = cut_lineage(in_cells(vectors, threshold).withColumn("place", F.concat_ws(":", "label", "dims", "cell")), "cells")
    counts = dealt.groupBy("place").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count("*").alias("rows")).where("homes > 0")
    packs = max(1, dealt.count() // (2 * STEP))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    block = lambda c: F.pmod(F.xxhash64("rep", F.lit(3)), F.col(c)).cast("int")
    split = join_per_key(dealt, counts, "place", F.col("rep")).withColumn("lefts", blocks("homes")).withColumn("rights", blocks("rows"))
    split = split.withColumn("left", block("lefts")).withColumn("right", block("rights"))
    tile = lambda i, j, l, r: F.struct(i.alias("i"), j.alias("j"), l.alias("is_left"), r.alias("is_right"))
    yes, no = F.lit(True), F.lit(False)
    as_left = F.transform(F.sequence(F.lit(0), F.col("rights") - 1), lambda j: tile(F.col("left"), j, yes, j == F.col("right")))
    as_right = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("lefts") - 1), lambda i: ~F.col("home") | (i != F.col("left"))), lambda i: tile(i, F.col("right"), no, yes)
    )
    tiles = split.withColumn("tile", F.explode(F.concat(F.when(F.col("home"), as_left).otherwise(F.filter(as_left, lambda _: no)), as_right)))
    alone = F.col("rows") > 2 * STEP
    pack = F.when(alone, F.xxhash64("place", "tile.i", "tile.j")).otherwise(-1 - F.pmod(F.xxhash64("place"), F.lit(packs)))
    names = ["rep", "n", "component", "v", "is_left", "is_right"]
    ready = tiles.select(pack.alias("pack"), "label", "dims", "cell", "tile.*", "rep", "n", "component", "v")

    def count(table: pa.Table) -> pa.Table:
        keys = [table.column(c).to_numpy() for c in ("label", "dims", "cell", "i", "j")]
        order = np.lexsort(keys)
        changed = np.zeros(max(0, len(order) - 1), bool)
        for k in keys:
            changed |= np.diff(k[order]) != 0
        edges = np.concatenate([[0], np.flatnonzero(changed) + 1, [len(order)]])
        out = [[], [], []]
        for a, b in zip(edges, edges[1:], strict=False):
            found = count_tile(table.select(names).take(pa.array(order[a:b])), threshold)
            for column, values in zip(out, found, strict=True):
                column.append(values)
        rep, links, other = (np.concatenate(c) for c in out)
        return pa.table({"rep": rep, "links": links, "other": pa.array(other, mask=links > 0)})

    return ready.groupBy("pack").applyInArrow(count, "rep long, links long, other long")


def count_tile(rows: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of the left rows with the right ones, then (with no links) components that they connect."""
    unit = _unit(_matrix(rows.column("v")))
    rep, many, component = (rows.column(c).to_numpy() for c in ("rep", "n", "component"))
    left, right = (np.flatnonzero(rows.column(c).to_numpy()) for c in ("is_left", "is_right"))
    links, pairs = np.zeros(len(rep), np.int64), [np.empty((0, 2), np.int64)]
    for at in range(0, len(left), STEP):
        a = left[at : at + STEP]
        for across in range(0, len(right), 4 * STEP):
            b = right[across : across + 4 * STEP]
            near = unit[a] @ unit[b].T >= threshold
            if not near.any():
                continue
            near &= rep[a][:, None] != rep[b][None, :]
            links[a] += (near @ many[b].astype(np.float64)).astype(np.int64)
            x, y = np.nonzero(near & (component[a][:, None] != component[b][None, :]))
            if len(x):
                pairs.append(np.unique(np.stack([component[a][x], component[b][y]], axis=1), axis=0))
    linked = np.flatnonzero(links)
    nodes, ends = np.unique(np.concatenate(pairs), return_inverse=True)
    ends = ends.reshape(-1, 2)
    root = roots(len(nodes), ends[:, 0], ends[:, 1])
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    none = np.zeros(len(linked), np.int64)
    return np.concatenate([rep[linked], nodes[moved]]), np.concatenate([links[linked], np.zeros(len(moved), np.int64)]), np.concatenate([none, nodes[root[moved]]])


def near_duplicate_vectors(rows: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per input row: ``key, n_links, component_id, kept``.

    ``n_links`` counts the other vectors at or above the threshold,
    ``component_id`` is the smallest id reachable, ``kept`` whether that is
    the row's own.
    """
    named = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))
    able = F.expr("id is not null and label is not null") & F.coalesce(sound_vector("v"), F.lit(False))
    identity = ["label", "h", "g"]
    plain = cut_lineage(
        named.select("id", *[F.when(able, c).alias(n) for n, c in (
            ("label", F.xxhash64("label")), ("v", F.col("v")), ("h", F.xxhash64("v")), ("g", F.xxhash64(F.lit(SEED), "v")))]),
        "vectors",
    )
    once = plain.where("h is not null").select("id", *identity).distinct().groupBy(*identity).agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    folded = cut_lineage(once, "folded")
    first = plain.select(F.col("id").alias("rep"), *identity, "v").join(folded, [*identity, "rep"]).dropDuplicates([*identity, "rep"])
    distinct = cut_lineage(first.select("rep", "n", "label", F.size("v").alias("dims"), "v"), "distinct")
    coded = with_codes(distinct.select("rep", "label", "dims", "v")).withColumn("tie", F.xxhash64("turn", "rep"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["turn", "label", "dims", "code", "tie"]
    ordered = coded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    swept = connected_components(ordered.mapInArrow(lambda batches: sweep(batches, threshold), "u long, v long"))
    first = distinct.join(swept.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    members = cut_lineage(first.select("rep", "n", "component", "label", "dims", "v"), "members")
    exact = cut_lineage(exact_links(members, threshold), "links")
    links = exact.where("other is null").groupBy("rep").agg(F.sum("links").alias("links"))
    joined = connected_components(exact.where("other is not null").select(F.col("rep").alias("u"), F.col("other").alias("v")))
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    components = members.select("rep", "component").join(joined, "component", "left").select("rep", F.coalesce("whole", "component").alias("component"))
    known = folded.join(components, "rep", "left").join(links, "rep", "left")
    found = plain.select("id", *identity).join(known.select(*identity, "rep", "n", "component", "links"), identity, "left")
    component = F.coalesce("component", "rep", "id")
    return found.select(
        F.col("id").alias(key),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("n") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
