"""Near-duplicate texts by b-bit MinHash.

1. Every text becomes the set of its word shingles, as 64-bit hashes, and
   ``SLOTS`` minima of it under random functions.  ``BITS`` low bits of each
   minimum are packed into 64-bit words; bands of full minima give bucket ids.
2. Texts with equal sets fold into one class before anything else, so a group
   of exact copies of any size is one member of the search.
3. In every bucket each class meets the smallest one.  Pairs are estimated
   from the packed signatures: the share of equal slots, corrected for slots
   that agree by chance, by bit counts in SQL.  Pairs that may reach the
   threshold are confirmed on full sets.
4. Buckets that still hold several components compare the members outside the
   largest component with all others, in cells of bounded size: estimate
   first, then full sets, and only one link per member and component leaves a
   cell.  So no cap limits partners, and a bucket of many mutual copies costs
   one pair each.
5. Components come from rounds of contraction (``components``).

The estimate only drops pairs ``SLACK`` below the threshold, over five standard
deviations.  A pair at the threshold 0.85 shares no band with a probability
below 1e-6 (at 0.8: 6e-5).

Texts without words, empty or null, have an empty set and link with nothing.
Fewer words than a shingle count as one shingle.  Repeated rows are exact
copies.  A row with a null key links with nothing: its component is null and
it is kept.  Rows that repeat a key are judged each by its text: graph nodes are
classes of equal sets, not keys, and a component is named by the smallest key of
its classes at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.arrow_text import flat_bytes, mix, prefix_hashes, ranges, slices, span_hashes
from tidemill.llm.components import connected_components
from tidemill.session import cut_lineage

SLOTS, BITS, BANDS, ROWS = 128, 4, 25, 5
WORDS = SLOTS * BITS // 64
SLACK = 0.17
OUTSIDE_BLOCK, MEMBER_BLOCK = 256, 1024
_SEED = np.uint64(0xD1B54A32D192ED03)


def shingles(column: pa.Array, words_each: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after another, and ``len + 1`` offsets.

    A-Z count as a-z; words are runs of anything but the ASCII blanks.
    """
    flat, bounds = flat_bytes(column, end=b" ")
    upper = (flat >= 65) & (flat <= 90)
    flat = flat + (upper * np.uint8(32))
    blank = (flat == 32) | ((flat >= 9) & (flat <= 13))
    inside = np.concatenate([[False], ~blank])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    words = span_hashes(prefix_hashes(flat), starts, ends)
    first = np.searchsorted(starts, bounds)
    counts = np.diff(first)
    found = []
    with np.errstate(over="ignore"):
        running = np.zeros(max(len(words) - words_each + 1, 0), np.uint64)
        for k in range(words_each):
            running = mix(running * _SEED + words[k : k + len(running)])
        for at, count in zip(first[:-1].tolist(), counts.tolist(), strict=True):
            if count >= words_each:
                found.append(np.unique(running[at : at + count - words_each + 1]))
            elif count:
                short = np.uint64(count)
                for word in words[at : at + count]:
                    short = mix(short * _SEED + word)
                found.append(np.array([short], np.uint64))
            else:
                found.append(np.empty(0, np.uint64))
    sizes = np.array([len(x) for x in found], np.int64)
    return (np.concatenate(found) if found else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def minima(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """32-bit minima of ``SLOTS`` random functions over every set; an empty set gets zeros."""
    out = np.zeros((len(offsets) - 1, SLOTS), np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    if not len(full):
        return out
    factors = mix(np.arange(1, SLOTS + 1, dtype=np.uint64) * _SEED) | np.uint64(1)
    with np.errstate(over="ignore"):
        shifts = mix(factors)
        for slot in range(SLOTS):
            out[full, slot] = np.minimum.reduceat((values * factors[slot] + shifts[slot]) >> np.uint64(32), offsets[full])
    return out


def packed(lows: np.ndarray) -> np.ndarray:
    """``BITS`` low bits of every minimum, packed into ``WORDS`` 64-bit integers."""
    per_word = 64 // BITS
    bits = (lows & np.uint64((1 << BITS) - 1)).reshape(len(lows), WORDS, per_word)
    return np.bitwise_or.reduce(bits << (np.arange(per_word, dtype=np.uint64) * np.uint64(BITS)), axis=2).view(np.int64)


def band_ids(lows: np.ndarray) -> np.ndarray:
    """One bucket id per band; bands never share ids but by chance of 64 bits."""
    bands = lows[:, : BANDS * ROWS].reshape(len(lows), BANDS, ROWS)
    out = np.tile(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(lows), 1))
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            out = mix(out * _SEED + bands[:, :, k])
    return out.view(np.int64)


def signatures(docs: DataFrame, key: str, text: str, words_each: int) -> DataFrame:
    """``(key, text_hash, n_shingles, set_a, set_b, s0.., bands)``: two fingerprints of the set, the packed minima, the buckets."""
    long = T.LongType()
    schema = T.StructType(
        [T.StructField("key", docs.schema[key].dataType), T.StructField("text_hash", long), T.StructField("n_shingles", long), T.StructField("set_a", long), T.StructField("set_b", long)]
        + [T.StructField(f"s{k}", long) for k in range(WORDS)]
        + [T.StructField("bands", T.ArrayType(long))]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, offsets = shingles(batch.column("text"), words_each)
            lows = minima(values, offsets)
            with np.errstate(over="ignore"):
                sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values), dtype=np.uint64)])
                more = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ _SEED), dtype=np.uint64)])
                set_a, set_b = sums[offsets[1:]] - sums[offsets[:-1]], more[offsets[1:]] - more[offsets[:-1]]
            words = packed(lows)
            bands = pa.FixedSizeListArray.from_arrays(pa.array(band_ids(lows).ravel()), BANDS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("text_hash"), pa.array(np.diff(offsets)), pa.array(set_a.view(np.int64)), pa.array(set_b.view(np.int64))]
                + [pa.array(words[:, k]) for k in range(WORDS)]
                + [bands],
                names=schema.names,
            )

    return docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")).mapInArrow(sign, schema)


def estimated_similarity(a: str, b: str) -> Column:
    """Similarity of the packed signatures under the prefixes ``a`` and ``b``, corrected for chance agreement."""
    differing = F.lit(0)
    for k in range(WORDS):
        bits = F.col(f"{a}s{k}").bitwiseXOR(F.col(f"{b}s{k}"))
        for step in (1, 2):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, step))
        differing = differing + F.bit_count(bits.bitwiseAND(F.lit(0x1111111111111111)))
    chance = 1.0 / (1 << BITS)
    return ((1 - differing / F.lit(float(SLOTS))) - chance) / (1 - chance)


def confirmed(pairs: DataFrame, texts: DataFrame, words_each: int, percent: int) -> DataFrame:
    """Those ``(u, v)`` whose full sets reach ``100 * intersection >= percent * union``."""
    schema = pairs.select("u", "v").schema
    u_text = texts.select(F.col("key").alias("u"), F.col("text").alias("u_text"))
    v_text = texts.select(F.col("key").alias("v"), F.col("text").alias("v_text"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "v_text"):
            (a, a_at), (b, b_at) = (shingles(batch.column(name), words_each) for name in ("u_text", "v_text"))
            keep = []
            for row in range(batch.num_rows):
                left, right = a[a_at[row] : a_at[row + 1]], b[b_at[row] : b_at[row + 1]]
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(left) + len(right) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(u_text, "u").join(v_text, "v").select("u", "v", "u_text", "v_text").mapInArrow(confirm, schema)


def shingle_sets(texts: DataFrame, words_each: int) -> DataFrame:
    """``(key, set)``: the sorted shingle hashes of ``texts(key, text)`` as bytes."""
    schema = T.StructType([texts.schema["key"], T.StructField("set", T.BinaryType())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, offsets = shingles(batch.column("text"), words_each)
            data = values.tobytes()
            sets = [data[8 * a : 8 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sets, pa.binary())], names=schema.names)

    return texts.select("key", "text").mapInArrow(gather, schema)


def cell_links(rows: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Places ``(u, v)`` of linked rows of one cell, one for each row outside and component that it meets."""
    packs = np.stack([rows.column(f"s{k}").to_numpy() for k in range(WORDS)], axis=1).view(np.uint64)
    _, labels = np.unique(rows.column("label").to_numpy(), return_inverse=True)
    outside = rows.column("outside").to_numpy(zero_copy_only=False)
    flat, bounds = flat_bytes(rows.column("set").combine_chunks())
    bounds = bounds // 8
    sizes = np.diff(bounds)
    words, codes = np.unique(np.frombuffer(flat.tobytes(), np.uint64), return_inverse=True)
    members = np.flatnonzero(~outside)
    present = np.zeros(len(words), bool)
    nibbles = np.uint64(0x1111111111111111)
    chance = 1.0 / (1 << BITS)
    found = []
    for u in np.flatnonzero(outside):
        others = members[labels[members] != labels[u]]
        bits = packs[others] ^ packs[u]
        bits |= bits >> np.uint64(1)
        bits |= bits >> np.uint64(2)
        alike = 1 - np.bitwise_count(bits & nibbles).sum(axis=1) / SLOTS
        others = others[(alike - chance) / (1 - chance) >= percent / 100 - SLACK]
        if not len(others):
            continue
        own = codes[bounds[u] : bounds[u + 1]]
        present[own] = True
        counts = sizes[others]
        hits = present[codes[ranges(bounds[others], counts)]]
        both = np.add.reduceat(hits.astype(np.int64), np.cumsum(counts) - counts)
        present[own] = False
        linked = others[100 * both >= percent * (counts + sizes[u] - both)]
        _, one = np.unique(labels[linked], return_index=True)
        found += [(int(u), int(v)) for v in linked[one]]
    return found


def open_links(cells: DataFrame, percent: int) -> DataFrame:
    """``(u, v)`` of every cell of ``cells(bucket, i, j, outside, key, label, s0.., set)``."""
    kind = cells.schema["key"].dataType
    schema = T.StructType([T.StructField("u", kind), T.StructField("v", kind)])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            found = np.array(cell_links(rows, percent), np.int64).reshape(-1, 2)
            keys = rows.column("key").combine_chunks()
            return pa.RecordBatch.from_arrays([keys.take(pa.array(found[:, 0])), keys.take(pa.array(found[:, 1]))], names=["u", "v"])

        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            places = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("bucket", "i", "j")], axis=1)
            cuts = np.flatnonzero(np.concatenate([[True], (places[1:] != places[:-1]).any(axis=1), [True]])) if len(places) else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                here = tuple(places[a])
                if held and here != last:
                    yield links(held)
                    held = []
                held.append(batch.slice(a, b - a))
                last = here
        if held:
            yield links(held)

    return cells.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(solve, schema)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words_each: int = 5, percent: int = 80) -> DataFrame:
    """One row per text: ``key, n_shingles, component_id, kept, text_hash``.

    ``component_id`` is the smallest key reachable by links of a Jaccard
    similarity of at least ``percent`` / 100, itself included; ``kept`` is
    whether that is the row's own key.
    """
    signed = cut_lineage(signatures(docs, key, text, words_each), "signatures")
    able = signed.where("key is not null and n_shingles > 0")
    # Graph nodes are classes of equal sets, numbered on a written table; each is
    # represented by one of its rows, so rows that share a key stay apart.
    classes = cut_lineage(able.groupBy("set_a", "set_b").agg(F.min("key").alias("rep"), F.min(F.struct("key", "text_hash")).alias("pick")), "classes")
    classes = cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    usable = F.expr("key is not null and n_shingles > 0")
    members = cut_lineage(
        signed.select("key", "text_hash", "n_shingles", "set_a", "set_b").join(classes.select("set_a", "set_b", "rep", "node"), ["set_a", "set_b"], "left").select(
            "key", "text_hash", "n_shingles", F.when(usable, F.col("rep")).alias("rep"), F.when(usable, F.col("node")).alias("node")
        ),
        "members",
    )
    picks = classes.select("set_a", "set_b", "node", F.col("pick.key").alias("pk"), F.col("pick.text_hash").alias("ph"))
    reps = cut_lineage(
        able.join(picks, ["set_a", "set_b"]).where("key = pk and text_hash = ph").dropDuplicates(["node"]).drop("key", "pk", "ph").withColumnRenamed("node", "key"), "reps"
    )
    rows = reps.select("key", F.explode("bands").alias("bucket")).distinct()
    shared = rows.groupBy("bucket").agg(F.min("key").alias("center"), F.count("*").alias("n")).where("n > 1").drop("n")
    buckets = cut_lineage(rows.join(shared, "bucket"), "buckets")
    involved = buckets.select("key").distinct()
    signed_in = cut_lineage(reps.drop("bands", "text_hash", "n_shingles", "set_a", "set_b").join(involved, "key", "leftsemi"), "candidates")
    wanted = picks.select(F.col("node").alias("key"), "pk", "ph").join(involved, "key", "leftsemi")
    picked = docs.select(F.col(key).alias("pk"), F.xxhash64(text).alias("ph"), F.col(text).alias("text")).join(wanted, ["pk", "ph"])
    texts = cut_lineage(picked.dropDuplicates(["key"]).select("key", "text"), "texts")
    u_signed, v_signed = (signed_in.select([F.col(c).alias(f"{side}_{c}" if c != "key" else side) for c in signed_in.columns]) for side in "uv")
    likely = estimated_similarity("u_", "v_") >= percent / 100 - SLACK

    first = buckets.where("key <> center").select(F.col("center").alias("u"), F.col("key").alias("v")).distinct()
    first = first.join(v_signed, "v").join(u_signed, "u").where(likely).select("u", "v").distinct()
    links = cut_lineage(confirmed(first, texts, words_each, percent), "links")
    labels = connected_components(links)

    labelled = cut_lineage(
        buckets.join(labels.withColumnRenamed("node", "key"), "key", "left").select("bucket", "center", "key", F.coalesce("component", "key").alias("label")), "labelled"
    )
    per_label = labelled.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    mixed = per_label.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("labels"), F.sum("n").alias("all")).where("labels > 1")
    open_rows = labelled.drop("center").join(mixed.select("bucket", "top", "all"), "bucket").withColumn("outside", F.col("label") != F.col("top.label"))
    blocks = {"i": F.ceil((F.col("all") - F.col("top.n")) / OUTSIDE_BLOCK), "j": F.ceil(F.col("all") / MEMBER_BLOCK)}
    own = {axis: F.pmod(F.xxhash64("key", F.lit(axis)), count).cast("int") for axis, count in blocks.items()}
    every = {axis: F.explode(F.sequence(F.lit(0), count.cast("int") - 1)).alias(axis) for axis, count in blocks.items()}
    # A row outside asks in every block of members; every row answers in every block of rows outside.
    columns = ["bucket", "key", "label"]
    asking = open_rows.where("outside").select(*columns, F.lit(True).alias("outside"), own["i"].alias("i"), every["j"])
    answering = open_rows.select(*columns, F.lit(False).alias("outside"), every["i"], own["j"].alias("j"))
    sets = shingle_sets(texts.join(open_rows.select("key").distinct(), "key", "leftsemi"), words_each)
    cells = asking.unionByName(answering).join(signed_in.join(sets, "key"), "key")
    more = cut_lineage(open_links(cells, percent).distinct(), "links")
    if not more.isEmpty():
        labels = connected_components(links.union(more))
    named = labels.join(classes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("smallest"))
    smallest = labels.join(named, "component").select("node", "smallest")
    found = members.join(smallest, "node", "left")
    component = F.coalesce("smallest", "rep", "key")
    return found.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"), "text_hash")
