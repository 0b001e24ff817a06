"""Byte strings that occur twice in a corpus, removed wherever they stand.

1. Every string of ``length`` bytes is filed under the smallest hash of its
   ``GRAM``-byte parts, so equal strings share a file wherever they occur.
   Neighbouring strings that mean the same part (their pivot) form a fragment,
   about one per 140 bytes.
2. Fragments are counted by file and content.  A fragment met twice is
   repeated as a whole; a file with one content holds nothing else.
3. Files with several contents send one copy of each to a task.  All strings
   of a fragment that start within a slot of 32 distances from the pivot share
   a core of ``length - 31`` bytes.  Slots whose core occurs once hold nothing;
   of the others the task builds a Burrows-Wheeler transform, each core
   abridged to its number, and finds the repeated strings by interval expansion
   (``bwt``).
4. A file with more contents than ``CROWD`` is split instead: its fragments
   are cut into slices by the distance from the pivot, filed under the bytes
   that all strings at these distances share, and counted again, in ever finer slices down to single strings.  So
   a passage that a third of all texts share stays within bounds, exactly.

Removed are all bytes covered by a repeated string.  Matches never cross texts.
Null and empty texts hold nothing.  A text shorter than ``length`` is never
touched.  Rows that repeat a key and a text are occurrences of their own; rows
without key are judged like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.arrow_text import flat_bytes, prefix_hashes, ranges, slices, span_hashes
from tidemill.llm.bwt import repeated_strings
from tidemill.session import cut_lineage

LENGTH, GRAM, CROWD = 400, 128, 256
SLICES = (32, 4, 1)
DIGIT_BITS = 4
BATCH_BYTES = 64 << 10
PIECE = 1 << 20
PLACE_BITS = np.uint64(24)  # enough for the places of two pieces
_TOP = np.uint64(2**64 - 1)
NAMES = ["key", "text_hash", "at", "starts", "pivot", "file", "content"]


def fragments(flat: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text, first start, number of starts, pivot (from the first start), file and content of all fragments."""
    if len(flat) < length:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    sums = prefix_hashes(flat)
    at = np.arange(len(flat) - gram + 1)
    hashes = span_hashes(sums, at, at + gram)
    width = length - gram + 1
    padded = np.full(-(-len(hashes) // width) * width + width, _TOP)
    # The leading bits decide, and among equal ones the place: the leftmost.
    padded[: len(hashes)] = hashes >> PLACE_BITS << PLACE_BITS | at.astype(np.uint64)
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    lowest = np.minimum(behind[: len(hashes) - width + 1], ahead[width - 1 : len(hashes)])
    pivot = (lowest & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    start = np.flatnonzero(np.arange(length, len(pivot) + length) <= np.repeat(bounds[1:], np.diff(bounds))[: len(pivot)])
    pivot = pivot[start]
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(pivot) != 0) | (np.diff(start) != 1)])[: len(start)])
    first, count, pivot = start[cut], np.diff(np.append(cut, len(start))), pivot[cut]
    text = np.searchsorted(bounds, first, "right") - 1
    return text, first - bounds[text], count, pivot - first, hashes[pivot], span_hashes(sums, first, first + count + length - 1)


def pieces(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Flat bytes and bounds of the texts of a batch, with row and offset of each; very long texts come in pieces that share ``length - 1`` bytes."""
    flat, bounds = flat_bytes(batch.column("text"))
    if len(flat) <= 2 * PIECE:
        yield flat, bounds, np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        return
    for row in range(batch.num_rows):
        for at in range(bounds[row], bounds[row + 1], PIECE):
            part = flat[at : min(at + PIECE + length - 1, bounds[row + 1])]
            yield part, np.array([0, len(part)]), np.array([row]), np.array([at - bounds[row]])


def all_fragments(texts: DataFrame, length: int) -> DataFrame:
    """``(key, text_hash, at, starts, pivot, file, content)`` of every fragment of ``texts(key, text_hash, text)``."""
    schema = T.StructType([texts.schema["key"], texts.schema["text_hash"]] + [T.StructField(c, T.IntegerType() if c in ("starts", "pivot") else T.LongType()) for c in NAMES[2:]])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for flat, bounds, rows, offsets in pieces(batch, length):
                text, at, starts, pivot, file, content = fragments(flat, bounds, length, GRAM)
                owner = pa.array(rows[text])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(owner), batch.column("text_hash").take(owner), pa.array(at + offsets[text])]
                    + [pa.array(starts.astype(np.int32)), pa.array(pivot.astype(np.int32)), pa.array(file.view(np.int64)), pa.array(content.view(np.int64))],
                    names=schema.names,
                )

    return texts.mapInArrow(split, schema)


def slots(pivots: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Fragment, number, farthest and nearest distance of all slots of ``width`` distances from the pivot that fragments reach into."""
    farthest = pivots // width
    parts = farthest - (pivots - counts + 1) // width + 1
    owner = np.repeat(np.arange(len(counts)), parts)
    slot = farthest[owner] - (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts))
    pivot, count = pivots[owner], counts[owner]
    return owner, slot, np.minimum(pivot, slot * width + width - 1), np.maximum(pivot - count + 1, slot * width)


def sliced(items: DataFrame, width: int, length: int) -> DataFrame:
    """The items with their bytes, cut into slices of ``width`` distances from the pivot, filed under the bytes that all strings at these distances share."""
    schema = items.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes"):
            flat, bounds = flat_bytes(batch.column("bytes"))
            sums = prefix_hashes(flat)
            counts, pivots = (batch.column(c).to_numpy().astype(np.int64) for c in ("starts", "pivot"))
            owner, slot, far, near = slots(pivots, counts, width)
            shift, starts = pivots[owner] - far, far - near + 1
            first = bounds[owner] + shift
            shared = bounds[owner] + pivots[owner] - slot * width
            core = span_hashes(sums, shared, shared - width + 1 + length)
            content = span_hashes(sums, first, first + starts + length - 1)
            data = flat.tobytes()
            cuts = [data[a : a + n + length - 1] for a, n in zip(first.tolist(), starts.tolist(), strict=True)]
            rows = pa.array(owner)
            at = batch.column("at").to_numpy()[owner] + shift
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(rows), batch.column("text_hash").take(rows), pa.array(at), pa.array(starts.astype(np.int32)), pa.array(far.astype(np.int32))]
                + [pa.array(core.view(np.int64)), pa.array(content.view(np.int64)), pa.array(cuts, pa.binary())],
                names=schema.names,
            )

    return items.mapInArrow(cut, schema)


def repeated_starts(flat: np.ndarray, bounds: np.ndarray, pivots: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """For every start of all fragments, one after another, whether its string occurs at another of these starts.

    A core of one number is one byte string, and whole strings hold one core,
    so abridged strings are equal if and only if the strings are.
    """
    width = min(SLICES[0], length)
    core = length - width + 1
    owner, slot, far, near = slots(pivots, counts, width)
    place = bounds[owner] + pivots[owner] - slot * width
    data, numbers = flat.tobytes(), {}
    number = np.array([numbers.setdefault(data[a : a + core], len(numbers)) for a in place.tolist()], np.int64)
    again = np.bincount(number)[number] > 1 if len(number) else np.empty(0, bool)
    found = np.zeros(int(counts.sum()), bool)
    if not again.any():
        return found
    owner, slot, far, near, place = (x[again] for x in (owner, slot, far, near, place))
    number = np.unique(number[again], return_inverse=True)[1]
    digits = max(1, -(-int(number.max()).bit_length() // DIGIT_BITS))
    left, right = far - slot * width, slot * width + width - 1 - near
    sizes = left + digits + right + 1
    begin = np.cumsum(sizes) - sizes
    symbols = np.zeros(int(sizes.sum()), np.int16)
    symbols[ranges(begin, left)] = flat[ranges(place - left, left)].astype(np.int16) + 1
    symbols[ranges(begin + left + digits, right)] = flat[ranges(place + core, right)].astype(np.int16) + 1
    for k in range(digits):
        symbols[begin + left + k] = 257 + (number >> k * DIGIT_BITS) % (1 << DIGIT_BITS)
    starts = far - near + 1
    found[ranges((np.cumsum(counts) - counts)[owner] + pivots[owner] - far, starts)] = repeated_strings(symbols, width - 1 + digits)[ranges(begin, starts)]
    return found


def expanded(crowds: DataFrame, length: int) -> DataFrame:
    """``(key, text_hash, start, stop)``: bytes covered by strings repeated within a file; all contents of a file must be given."""
    schema = T.StructType([crowds.schema["key"], crowds.schema["text_hash"], T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])

    def solve(rows: pa.Table) -> pa.RecordBatch:
        flat, bounds = flat_bytes(rows.column("bytes").combine_chunks())
        counts, pivots = (rows.column(c).to_numpy().astype(np.int64) for c in ("starts", "pivot"))
        hit = repeated_starts(flat, bounds, pivots, counts, length)
        owner = np.repeat(np.arange(len(counts)), counts)
        shift = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)) | np.concatenate([shift == 0, [True]]))
        begin, end = edge[:-1], edge[1:]
        begin, end = begin[hit[begin]], end[hit[begin]]
        item = owner[begin]
        start = rows.column("at").to_numpy()[item] + shift[begin]
        return pa.RecordBatch.from_arrays(
            [rows.column("key").combine_chunks().take(pa.array(item)), rows.column("text_hash").combine_chunks().take(pa.array(item))]
            + [pa.array(start), pa.array(start + (end - begin) + length - 1)],
            names=schema.names,
        )

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            file = batch.column("file").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], file[1:] != file[:-1], [True]])) if len(file) else np.empty(0, np.int64)
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(a, b - a)
                if size > BATCH_BYTES and held[-1].column("file")[-1].as_py() != int(file[a]):
                    yield solve(pa.Table.from_batches(held))
                    held, size = [], 0
                held.append(part)
                size += int(part.column("starts").to_numpy().sum()) + (length - 1) * part.num_rows
        if held:
            yield solve(pa.Table.from_batches(held))

    return crowds.repartition("file").sortWithinPartitions("file").mapInArrow(expand, schema)


def judged(items: DataFrame, carried: list[str]) -> DataFrame:
    """The items of files with a repeated or a second content, with ``n`` (items of the same content), ``contents`` (of the file) and ``first`` (one item of each content)."""
    place = F.struct("key", "text_hash", "at")
    per_content = items.groupBy("file", "content").agg(F.count("*").alias("n"), F.min(place).alias("one"))
    per_file = per_content.groupBy("file").agg(F.count("*").alias("contents"), F.max("n").alias("most")).where("contents > 1 or most > 1").drop("most")
    marked = per_content.join(per_file, "file").where("contents > 1 or n > 1")
    return items.join(marked, ["file", "content"]).select(*carried, "n", "contents", place.eqNullSafe(F.col("one")).alias("first"))


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(key, text_hash, start, stop)`` of bytes covered by repeated strings, for ``texts(key, text_hash, text)``; spans may overlap."""
    items = cut_lineage(all_fragments(texts, length), "fragments")
    told = cut_lineage(judged(items, NAMES), "judged")
    whole = [told.where("n > 1")]
    asked = told.where("first and contents > 1").groupBy("key", "text_hash").agg(F.collect_list(F.struct(*NAMES[2:], "contents")).alias("asked"))
    schema = T.StructType([told.schema[c] for c in NAMES] + [T.StructField("bytes", T.BinaryType()), told.schema["contents"]])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            flat, bounds = flat_bytes(batch.column("text"))
            lists = batch.column("asked")
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            items = lists.flatten()
            begin = bounds[owner] + items.field("at").to_numpy()
            end = begin + items.field("starts").to_numpy() + length - 1
            data = flat.tobytes()
            cut = pa.array([data[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(rows), batch.column("text_hash").take(rows)] + [items.field(c) for c in NAMES[2:]] + [cut, items.field("contents")],
                names=schema.names,
            )

    wanted = asked.withColumnsRenamed({"key": "_key", "text_hash": "_hash"})
    with_bytes = texts.join(wanted, texts["key"].eqNullSafe(wanted["_key"]) & (texts["text_hash"] == wanted["_hash"])).select("key", "text_hash", "text", "asked").mapInArrow(fetch, schema)
    contested = cut_lineage(with_bytes, "contested")
    crowds = [contested.where(F.col("contents") <= CROWD)]
    crowded = contested.where(F.col("contents") > CROWD)
    for width in SLICES:
        if crowded.isEmpty():
            break
        finer = cut_lineage(sliced(crowded.drop("contents"), width, length), "slices")
        told = cut_lineage(judged(finer, [*NAMES, "bytes"]), "judged")
        whole.append(told.where("n > 1"))
        open_files = told.where("first and contents > 1").drop("n", "first")
        crowds.append(open_files.where(F.col("contents") <= CROWD))
        crowded = open_files.where(F.col("contents") > CROWD)
    span = ["key", "text_hash", F.col("at").cast("long").alias("start"), (F.col("at") + F.col("starts") + length - 1).cast("long").alias("stop")]
    found = whole[0].select(*span)
    for part in whole[1:]:
        found = found.union(part.select(*span))
    together = crowds[0].select(*NAMES, "bytes")
    for part in crowds[1:]:
        together = together.union(part.select(*NAMES, "bytes"))
    return found.union(expanded(together, length))


def with_spans(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """``(key, text_hash, text, spans)``: every row with its repeated spans."""
    texts = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    spans = repeated_spans(texts, length).groupBy(F.col("key").alias("_key"), F.col("text_hash").alias("_hash")).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return texts.join(spans, texts["key"].eqNullSafe(spans["_key"]) & (texts["text_hash"] == spans["_hash"]), "left").select("key", "text_hash", "text", "spans")


def merged(spans: list | None) -> list[tuple[int, int]]:
    """Maximal runs of the bytes covered by ``spans``."""
    out: list[list[int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: ``key, n_bytes, n_removed, n_spans, kept_sha256, kept``.

    ``kept`` holds the bytes that are left (BINARY, since a cut may fall inside a character).
    """
    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
        + [T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())]
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            flat, bounds = flat_bytes(batch.column("text"))
            removed, runs, kept = [], [], []
            for row, spans in enumerate(batch.column("spans").to_pylist()):
                data = flat[bounds[row] : bounds[row + 1]].tobytes()
                cuts = merged(spans)
                edges = [0, *[x for cut in cuts for x in cut], len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                removed.append(sum(b - a for a, b in cuts))
                runs.append(len(cuts))
            digests = [hashlib.sha256(x).hexdigest() for x in kept]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(np.diff(bounds)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
                names=schema.names,
            )

    return with_spans(docs, key, text, length).mapInArrow(remove, schema)
