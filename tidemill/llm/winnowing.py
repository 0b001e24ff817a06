"""Benchmark decontamination by winnowing.

Texts are cut into words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z
is lower-cased; null has none), and every word gets a 64-bit hash on the JVM.
Over consecutive ``GRAM`` words a polynomial hash is taken, and of every
``WINDOW`` consecutive gram hashes the smallest is kept (the rightmost of equal
ones): the fingerprints.  A shared span of ``GRAM + WINDOW - 1 = SPAN`` words
holds exactly one winnowing window on both sides, so its smallest gram is a
fingerprint of both: every occurrence of a window of ``SPAN`` item words in a
document shares a fingerprint with its item, at the same offset.

A fingerprint met in both gives a diagonal (document place minus item place);
from there the match is extended both ways while the words are equal, words
compared as text after their hashes agree, and within the item.  A run of at
least ``SPAN`` words is made of occurrences of windows, and every word in it is
hit; a shorter run holds none.  Items of fewer than ``SPAN`` words (but some)
are one window each; they are found by a hash of that many words at every
place of the document, one pass per length that such items have, and checked
word by word.

Items are fingerprinted once, and documents are scanned in one map pass with
the fingerprints of a block of items in memory; a block holds at most
``BLOCK_WORDS`` item words, so what every task holds is bounded, and a larger
benchmark takes more passes whose hits are merged per row.

Per document: ``n_words``, ``n_hit`` (words inside any occurrence of a
window), ``n_items`` (items with an occurring window), ``items_sha256``
(sha-256 of those item ids, sorted as strings and comma-joined) and
``contaminated`` (``n_hit > 0``).  Null and empty texts have no words and no
hits; repeated rows give repeated results; an empty benchmark hits nothing;
items with a null id or no words are left out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the contract: the word pattern and the length of a window.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
SPAN = 10

GRAM = 5
WINDOW = SPAN - GRAM + 1
BLOCK_WORDS = 2_000_000
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(WORD), 0)


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of every run of ``size`` words."""
    h = hashes.astype(np.uint64)
    count = len(h) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            out = out * _MULT + h[j : j + count]
    return out


def fingerprints(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the smallest gram hash of every window, rightmost of equals."""
    grams = _grams(hashes, GRAM)
    if len(grams) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    windows = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    rightmost = WINDOW - 1 - np.argmin(windows[:, ::-1], axis=1)
    places = np.unique(np.arange(len(windows)) + rightmost)
    return places, grams[places]


class Items:
    """Fingerprints and words of a block of benchmark items."""

    def __init__(self, rows: list[tuple[int, list[str], list[int]]]):
        self.words: dict[int, list[str]] = {}
        self.hashes: dict[int, np.ndarray] = {}
        keys, owners, places = [], [], []
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item, words, hashes in rows:
            self.words[item], self.hashes[item] = words, np.asarray(hashes, np.int64)
            if len(words) < SPAN:
                self.short[len(words)][int(_grams(self.hashes[item], len(words))[0])].append(item)
                continue
            at, value = fingerprints(self.hashes[item])
            keys.append(value)
            owners.append(np.full(len(at), item, np.int64))
            places.append(at)
        order = np.argsort(np.concatenate(keys)) if keys else np.empty(0, np.int64)
        self.keys = np.concatenate(keys)[order] if keys else np.empty(0, np.uint64)
        self.owners = np.concatenate(owners)[order] if keys else np.empty(0, np.int64)
        self.places = np.concatenate(places)[order] if keys else np.empty(0, np.int64)


def _extend(doc: list[str], dh: np.ndarray, item: list[str], ih: np.ndarray, p: int, q: int) -> tuple[int, int]:
    """The run of equal words through document place ``p`` and item place ``q``."""
    start, end = 0, 0
    while p - start - 1 >= 0 and q - start - 1 >= 0 and dh[p - start - 1] == ih[q - start - 1] and doc[p - start - 1] == item[q - start - 1]:
        start += 1
    while p + end < len(doc) and q + end < len(item) and dh[p + end] == ih[q + end] and doc[p + end] == item[q + end]:
        end += 1
    return p - start, p + end


def hits_of(doc: list[str], dh: np.ndarray, items: Items) -> tuple[list[tuple[int, int]], set[int]]:
    """Merged hit intervals of a document and the items that occur in it."""
    found: list[tuple[int, int]] = []
    named: set[int] = set()
    if len(items.keys):
        at, value = fingerprints(dh)
        lo = np.searchsorted(items.keys, value, "left")
        hi = np.searchsorted(items.keys, value, "right")
        runs: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for k in np.flatnonzero(hi > lo):
            p = int(at[k])
            for j in range(lo[k], hi[k]):
                item, q = int(items.owners[j]), int(items.places[j])
                diagonal = (item, p - q)
                if any(s <= p < e for s, e in runs[diagonal]):
                    continue
                s, e = _extend(doc, dh, items.words[item], items.hashes[item], p, q)
                runs[diagonal].append((s, max(e, p + 1)))
                if e - s >= SPAN:
                    found.append((s, e))
                    named.add(item)
    for size, table in items.short.items():
        grams = _grams(dh, size)
        for p in np.flatnonzero(np.isin(grams, np.fromiter(table, np.uint64, len(table)))):
            for item in table[int(grams[p])]:
                if doc[p : p + size] == items.words[item]:
                    found.append((int(p), int(p) + size))
                    named.add(item)
    found.sort()
    merged: list[tuple[int, int]] = []
    for s, e in found:
        if merged and s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], e))
        else:
            merged.append((s, e))
    return merged, named


_OUT = "row_key long, doc_id long, n_words long, spans array<struct<s:long,e:long>>, items array<long>"
_SCHEMA = pa.schema([
    ("row_key", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), ("items", pa.list_(pa.int64())),
])


class _Words:
    """The words of one document, read from the batch only where hashes agree."""

    def __init__(self, values: pa.Array, start: int, end: int):
        self.values, self.start, self.end = values, start, end

    def __len__(self) -> int:
        return self.end - self.start

    def __getitem__(self, at):
        if isinstance(at, slice):
            return [self.values[self.start + j].as_py() for j in range(*at.indices(len(self)))]
        return self.values[self.start + at].as_py()


def _scan(items: Items):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, hashes = batch.column("words"), batch.column("wh")
            offsets, flat = hashes.offsets.to_numpy(), hashes.values.to_numpy(zero_copy_only=False)
            word_offsets, values = words.offsets.to_numpy(), words.values
            out = {"row_key": batch.column("row_key"), "doc_id": batch.column("doc_id"), "n_words": [], "spans": [], "items": []}
            for i in range(batch.num_rows):
                dh = flat[offsets[i] : offsets[i + 1]].astype(np.int64)
                doc = _Words(values, int(word_offsets[i]), int(word_offsets[i + 1]))
                spans, named = hits_of(doc, dh, items) if len(dh) else ([], set())
                out["n_words"].append(len(dh))
                out["spans"].append([{"s": s, "e": e} for s, e in spans])
                out["items"].append(sorted(named))
            yield pa.RecordBatch.from_pydict(out, schema=_SCHEMA)

    return scan


def _item_blocks(benchmark: DataFrame, item_key: str, text: str) -> list[list[tuple[int, list[str], list[int]]]]:
    """Items in blocks of about ``BLOCK_WORDS`` words, each read on its own.

    The benchmark is a stated query set: only one block is held at a time.
    """
    words = words_of(F.col(text))
    items = benchmark.where(F.col(item_key).isNotNull()).select(F.col(item_key).cast("long").alias("item"), words.alias("words")).where(F.size("words") > 0)
    upto = F.sum(F.size("words")).over(Window.orderBy("item").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sized = items.select("item", "words", F.transform("words", lambda w: F.xxhash64(w)).alias("wh"), upto.alias("upto"))
    total = items.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    blocks = []
    for b in range(-(-total // BLOCK_WORDS)):
        part = sized.where((F.col("upto") > b * BLOCK_WORDS) & (F.col("upto") <= (b + 1) * BLOCK_WORDS))
        block = [(r["item"], r["words"], r["wh"]) for r in part.collect()]
        if block:
            blocks.append(block)
    return blocks or [[]]


def decontaminate(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` for every row of ``documents``."""
    blocks = _item_blocks(benchmark, item_key, item_text)
    words = words_of(F.col(text))
    docs = documents.select(
        F.xxhash64(F.col(key), F.col(text)).alias("row_key"), F.col(key).cast("long").alias("doc_id"), words.alias("words")
    ).withColumn("wh", F.transform("words", lambda w: F.xxhash64(w)))
    parts = [docs.mapInArrow(_scan(Items(block)), _OUT) for block in blocks]
    found = parts[0]
    if len(parts) > 1:
        every = parts[0]
        for more in parts[1:]:
            every = every.unionByName(more)
        found = every.groupBy("row_key", "doc_id", "n_words").agg(
            (F.count(F.lit(1)) / len(parts)).cast("long").alias("copies"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        ).withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    ordered = F.array_sort(F.col("spans"), lambda a, b: F.when(a["s"] < b["s"], -1).when(a["s"] > b["s"], 1).otherwise(0))
    covered = F.aggregate(
        ordered, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("reach")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(x["s"], acc["reach"]))).alias("n"), F.greatest(acc["reach"], x["e"]).alias("reach")),
    )["n"]
    named = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(named, ","), 256).alias("items_sha256"), (covered > 0).alias("contaminated"),
    )
