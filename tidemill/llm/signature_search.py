"""Ranked lexical search over bit-sliced Bloom signatures, rescored exactly.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``
once A-Z is lower-cased (null has none).  Every document gets a signature of
``BITS`` places: each of its distinct terms raises ``HASHES`` places to the
tier of its frequency (``TIERS``).  A batch of documents is laid out
bit-sliced: for every tier one bitmap over the batch per place, so that the
documents that may hold a term so often are the AND of its ``HASHES`` slices;
the signature can say too much, never too little.

The score of a document for an item is

    sum over the item's distinct terms of w(t) * ((10^9 tf) div (1000 tf + 20 m)),

with ``w(t) = floor(1000 ln((2N + 2) / (2 df + 1)))`` and
``m = 50 + (50 n N) div L`` (``N`` documents with a term, ``L`` all their
terms, ``n`` the document's terms, ``df``/``tf`` as usual).  A term's part
grows with ``tf``, so the parts at the highest ``tf`` of the tiers found add
up to an upper bound of the score (``n`` for the last tier).  Documents are
rescored exactly (their text tokenised once per batch) in order of falling
bound, until the 50th exact score that the task has found so far excludes the
rest: every document not provably excluded is rescored.  The best 50 of every
task meet in a window per item.

Items go through in blocks of at most ``BLOCK_TERMS`` terms, two passes over
the documents each: one counts ``N``, ``L`` and ``df`` over all rows (``df`` by
the bytes of the block's terms), one scores.  Blocks hold other items, so their
results are simply put together.

Null texts have no terms and never score; equal scores go to the smaller
doc_id; repeated rows are documents of their own each (counted and ranked as
often as they occur); only scores above 0 are returned; an empty table or
benchmark gives no rows; items with a null id are left out.
"""

from __future__ import annotations

import math
import re
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.arrow_text import flat_bytes, prefix_hashes, slices, span_hashes

# Fixed values of the contract: the term pattern, the number of hits and the constants of the score.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
TOP = 50

BITS = 8_192
HASHES = 2
TIERS = np.array([1, 2, 3, 4, 6, 9, 16])
BLOCK_TERMS = 200_000
GROUP_TERMS = 5_000
BATCH_ROWS, BATCH_BYTES, PIECE = 2_048, 16 << 20, 1 << 20
_TERM = re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_INSIDE = np.array([_TERM.fullmatch(bytes([b])) is not None for b in range(256)])
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_HASH_BITS = np.uint64(48)


def terms_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(TERM), 0)


def spans(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms in UTF-8 bytes (bytes of other characters than ASCII are inside terms)."""
    inside = np.concatenate([[False], _INSIDE[flat], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def pieces(flat: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about ``PIECE`` bytes that end with a text or, within a long one, where no term is cut."""
    at = 0
    while at < len(flat):
        to = int(bounds[np.searchsorted(bounds, at + PIECE, "right") - 1])
        if to <= at:
            to = min(at + PIECE, len(flat))
            while to < len(flat) and _INSIDE[flat[to - 1]]:
                apart = np.flatnonzero(~_INSIDE[flat[to : to + PIECE]])
                to = to + int(apart[0]) + 1 if len(apart) else min(to + PIECE, len(flat))
        yield at, to
        at = to


def places_of(hashes: np.ndarray) -> np.ndarray:
    """The signature places that terms raise, one row each."""
    return np.stack([hashes >> np.uint64(13 * j) & np.uint64(BITS - 1) for j in range(HASHES)], axis=1).astype(np.int64)


def term_bits(terms: list[bytes]) -> np.ndarray:
    """Signature places of given terms."""
    flat, bounds = flat_bytes(pa.array(terms, pa.binary()))
    return places_of(span_hashes(prefix_hashes(flat), bounds[:-1], bounds[1:]))


def index(texts: pa.Array) -> tuple[np.ndarray, pa.ListArray, np.ndarray]:
    """Number of terms, signature places and their tiers of every text.

    Terms of a text that agree in the hash bits kept are counted as one, which can only raise a tier.
    """
    flat, bounds = flat_bytes(texts, end=b"\0")
    n = np.zeros(len(texts), np.int64)
    found, counts = [], []
    for a, b in pieces(flat, bounds):
        starts, ends = spans(flat[a:b])
        rows = np.arange(np.searchsorted(bounds, a, "right") - 1, np.searchsorted(bounds, b, "left"))
        per_row = np.diff(np.searchsorted(starts, np.maximum(bounds[rows[0] : rows[-1] + 2] - a, 0)))
        n[rows] += per_row
        hashes = span_hashes(prefix_hashes(_LOWER[flat[a:b]]), starts, ends)
        keys = np.sort(np.repeat(rows, per_row).astype(np.uint64) << _HASH_BITS | hashes & (np.uint64(1) << _HASH_BITS) - np.uint64(1))
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
        found.append(keys[first])
        counts.append(np.diff(np.append(first, len(keys))))
    keys, count = np.concatenate([np.empty(0, np.uint64), *found]), np.concatenate([np.empty(0, np.int64), *counts])
    if (keys[1:] <= keys[:-1]).any():  # a text in several pieces
        order = np.argsort(keys, kind="stable")
        keys, count = keys[order], count[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, count = keys[first], np.add.reduceat(count, first)
    tiers = np.repeat(np.searchsorted(TIERS, count, "right").astype(np.uint8), HASHES)
    offsets = HASHES * np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) << _HASH_BITS)
    return n, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(places_of(keys).ravel(), pa.int32())), tiers


def part_of(tf: int, m: int) -> int:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Block:
    """Items of a block: their terms with weights and signature places, in groups of some ``GROUP_TERMS`` terms."""

    def __init__(self, rows: list[tuple[int, str, int, list[int]]], documents: int, total: int):
        self.documents, self.total = documents, total
        self.items: dict[int, list[tuple[str, int, list[int]]]] = {}
        for item, term, df, bits in rows:
            self.items.setdefault(item, []).append((term, weight(documents, df), bits))
        self.groups: list[dict[int, list[tuple[bytes, int, list[int]]]]] = [{}]
        size = 0
        for item, terms in self.items.items():
            if size and size + len(terms) > GROUP_TERMS:
                self.groups.append({})
                size = 0
            self.groups[-1][item] = [(t.encode(), w, bits) for t, w, bits in terms if w > 0]
            size += len(terms)


def _slices(bits: pa.ListArray, count: int, tiers: np.ndarray | None = None) -> np.ndarray:
    """Bit slices: one packed bitmap over the batch per signature place, and this for every tier if ``tiers`` gives that of each place."""
    offsets, flat = bits.offsets.to_numpy(), bits.values.to_numpy(zero_copy_only=False)
    places = flat[offsets[0] : offsets[-1]].astype(np.int64) * count + np.repeat(np.arange(count), np.diff(offsets))
    held = np.zeros((BITS, count), np.uint8)
    if tiers is None:
        held.reshape(-1)[places] = 1
        return np.packbits(held, axis=1)
    for tier in range(1, len(TIERS) + 1):  # the highest tier stays
        held.reshape(-1)[places[tiers == tier]] = tier
    return np.stack([np.packbits(held >= tier, axis=1) for tier in range(1, len(TIERS) + 1)])


def _rank(block: Block, doc_ids: np.ndarray, texts: pa.Array, n: np.ndarray, tiered: np.ndarray, k: int, found: dict[int, list]) -> int:
    """Merges the batch's documents into each item's best ``(-score, doc_id)``; how many were rescored."""
    count = len(doc_ids)
    n = n.astype(np.int64)
    m = 50 + (50 * n * block.documents) // max(block.total, 1)
    highest = [*(TIERS[1 : len(tiered)] - 1), np.iinfo(np.int64).max]
    caps = np.zeros((len(tiered) + 1, count))
    for tier, tf in enumerate(highest, 1):
        most = np.minimum(n, tf)
        caps[tier] = (1_000_000_000 * most) // (1000 * most + 20 * m)
    flat, bounds = flat_bytes(texts)
    counted: dict[int, Counter] = {}
    alike: dict[bytes, Counter] = {}  # copies share their counts

    def tf_of(i: int) -> Counter:
        if i not in counted:
            data = flat[bounds[i] : bounds[i + 1]].tobytes().lower()
            if data not in alike:
                alike[data] = Counter(_TERM.findall(data))
            counted[i] = alike[data]
        return counted[i]

    for group in block.groups:
        ceilings: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        for item, terms in group.items():
            bound = np.zeros(count)
            for term, w, bits in terms:
                if term not in ceilings:
                    maybe = np.bitwise_and.reduce(tiered[:, bits], axis=1)
                    tier = np.unpackbits(maybe, axis=1, count=count).sum(axis=0, dtype=np.uint8)
                    docs = np.flatnonzero(tier).astype(np.int32)
                    ceilings[term] = docs, caps[tier[docs], docs]
                docs, cap = ceilings[term]
                bound[docs] += w * cap
            if len(terms) > BLOCK_TERMS:  # sums beyond 2^53 are rounded
                bound *= 1 + 2**-30
            best = found.setdefault(item, [])
            known: dict[tuple[int, int], int] = {}

            def rescore(order: np.ndarray, terms=terms, bound=bound, best=best, known=known) -> None:
                for i in order.tolist():
                    if len(best) == k and (-bound[i], doc_ids[i]) >= best[-1]:
                        break
                    tf, of = tf_of(i), int(m[i])
                    at = id(tf), of
                    if at not in known:
                        known[at] = sum(w * part_of(tf[t], of) for t, w, _ in terms if t in tf)
                    if known[at] > 0:
                        insort(best, (-known[at], int(doc_ids[i])))
                        del best[k:]

            if len(best) < k < count:
                ahead = np.argpartition(-bound, k)[:k]
                ahead = ahead[bound[ahead] > 0]
                rescore(ahead[np.lexsort((doc_ids[ahead], -bound[ahead]))])
                bound[ahead] = 0
            still = np.flatnonzero((bound > 0) & (bound >= (-best[-1][0] if len(best) == k else 0)))
            rescore(still[np.lexsort((doc_ids[still], -bound[still]))])
    return len(counted)


def rank_batch(block: Block, doc_ids: np.ndarray, texts: pa.Array, n: np.ndarray, slices: np.ndarray, k: int = TOP) -> tuple[dict, int]:
    """Each item's best ``k`` documents of the batch, and how many were rescored."""
    best: dict[int, list] = {}
    rescored = _rank(block, doc_ids, texts, n, slices.reshape(-1, *slices.shape[-2:]), k, best)
    return {item: [(-s, d) for s, d in rows] for item, rows in best.items()}, rescored


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", BATCH_BYTES):
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def _scan(block: Block):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        for batch in _batches(batches):
            ids = batch.column("doc_id")
            n, bits, tiers = index(batch.column("text"))
            n[ids.is_null().to_numpy(zero_copy_only=False)] = 0
            _rank(block, ids.fill_null(0).to_numpy(), batch.column("text"), n, _slices(bits, batch.num_rows, tiers), TOP, best)
        rows = [(item, d, -s) for item, found in best.items() for s, d in found]
        schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else ([], [], []))], schema=schema)

    return scan


def _count(terms: list[bytes]):
    """``(term, docs, terms)``: documents that hold each term, by its place in ``terms``; at -1 those with any term, and all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(terms, pa.binary())
        df = np.zeros(len(terms), np.int64)
        documents = total = 0
        for batch in _batches(batches):
            flat, bounds = flat_bytes(batch.column("text"), end=b"\0")
            n = np.zeros(batch.num_rows, np.int64)
            held = [np.empty(0, np.int64)]
            for a, b in pieces(flat, bounds):
                starts, ends = spans(flat[a:b])
                rows = np.arange(np.searchsorted(bounds, a, "right") - 1, np.searchsorted(bounds, b, "left"))
                per_row = np.diff(np.searchsorted(starts, np.maximum(bounds[rows[0] : rows[-1] + 2] - a, 0)))
                n[rows] += per_row
                letters = _LOWER[flat[a:b][_INSIDE[flat[a:b]]]]
                offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
                words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
                place = pc.fill_null(pc.index_in(words, asked), -1).to_numpy()
                known = place >= 0
                held.append(np.unique(np.repeat(rows, per_row)[known] * len(terms) + place[known]))
            df += np.bincount(np.unique(np.concatenate(held)) % max(len(terms), 1), minlength=len(terms))
            documents, total = documents + int((n > 0).sum()), total + int(n.sum())
        some = np.flatnonzero(df)
        columns = np.append(some, -1), np.append(df[some], documents), np.append(np.zeros(len(some), np.int64), total)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["term", "docs", "terms"])

    return count


def _item_blocks(rows: DataFrame) -> list[DataFrame]:
    """Item terms in blocks of about ``BLOCK_TERMS`` terms, whole items each."""
    sizes = rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("terms"))
    upto = F.sum("terms").over(Window.orderBy("item_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = sizes.select("item_id", ((upto - 1) / BLOCK_TERMS).cast("long").alias("block"))
    last = placed.agg(F.max("block")).first()[0]
    tagged = rows.join(placed, "item_id")
    return [tagged.where(F.col("block") == b) for b in range(0 if last is None else last + 1)]


def search(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the best 50 documents of every item.

    Rows with a null doc_id count as documents but are never returned.
    """
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    item_terms = benchmark.where(F.col(item_key).isNotNull()).select(
        F.col(item_key).cast("long").alias("item_id"), F.explode(F.array_distinct(terms_of(F.col(item_text)))).alias("term")
    )
    parts = []
    for chosen in _item_blocks(item_terms):
        pairs = [(r["item_id"], r["term"]) for r in chosen.select("item_id", "term").collect()]
        terms = sorted({t for _, t in pairs})
        encoded = [t.encode() for t in terms]
        counts = rows.select("text").mapInArrow(_count(encoded), "term long, docs long, terms long").groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms"))
        told = {r["term"]: r for r in counts.collect()}
        df = {t: told[i]["docs"] if i in told else 0 for i, t in enumerate(terms)}
        bits = dict(zip(terms, term_bits(encoded).tolist(), strict=True))
        block = Block([(i, t, df[t], bits[t]) for i, t in pairs], *((told[-1]["docs"], told[-1]["terms"]) if told else (0, 0)))
        parts.append(rows.mapInArrow(_scan(block), "item_id long, doc_id long, score long"))
    if not parts:
        return documents.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
