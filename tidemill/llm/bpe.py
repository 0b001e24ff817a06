"""Byte-pair encoding and decoding in batched numpy merge rounds.

All distinct words of an Arrow slice lie one after another in a flat array of
symbols.  A round looks up every adjacent pair by binary search among the
sorted pair keys, takes the lowest rank of each word and merges its
occurrences from the left, in all words at once.  Words without a pair that
can merge are done.  Encoded words are remembered per Python worker, up to a
bound.

Special strings of the vocabulary are cut out of a text first and become their
own id, as the library does by default.  Null texts are empty, an empty text
has no ids.  Every text is encoded whole, whatever its length.  Repeated rows
give repeated results.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemill.llm.arrow_text import flat_bytes, prefix_hashes, ranges, slices, span_hashes
from tidemill.llm.pretokens import word_spans

REMEMBERED_WORDS = 400_000
DECODED_IDS = 400_000
"""Ids decoded at once; a longer list is decoded alone."""
NO_RANK = np.int64(1 << 40)


def printable_bytes() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes each byte: itself if visible, else one above U+00FF."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in visible]
    return {chr(byte): byte for byte in visible} | {chr(256 + k): byte for k, byte in enumerate(hidden)}


@dataclass
class Vocabulary:
    """Sorted pair keys with rank and result, the id of each byte, and the bytes of each id."""

    size: int
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    pair_results: np.ndarray
    byte_ids: np.ndarray
    piece_bytes: np.ndarray
    piece_starts: np.ndarray
    special: dict[str, int]


@lru_cache(maxsize=4)
def load_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level vocabulary of the ``tokenizers`` library."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    ids = content["model"]["vocab"]
    special = {item["content"]: item["id"] for item in content["added_tokens"]}
    size = max([*ids.values(), *special.values()]) + 1
    to_byte = printable_bytes()
    pieces = [b""] * size
    for piece, number in ids.items():
        pieces[number] = bytes(to_byte[c] for c in piece)
    for text, number in special.items():
        pieces[number] = text.encode()
    byte_ids = np.zeros(256, np.int64)
    for character, byte in to_byte.items():
        byte_ids[byte] = ids[character]
    pairs = [line if isinstance(line, list) else line.split(" ") for line in content["model"]["merges"]]
    keys = np.array([ids[a] * size + ids[b] for a, b in pairs], np.int64)
    results = np.array([ids[a + b] for a, b in pairs], np.int64)
    order = np.argsort(keys)
    lengths = np.array([len(piece) for piece in pieces], np.int64)
    return Vocabulary(
        size=size,
        pair_keys=keys[order],
        pair_ranks=order.astype(np.int64),
        pair_results=results[order],
        byte_ids=byte_ids,
        piece_bytes=np.frombuffer(b"".join(pieces), np.uint8),
        piece_starts=np.concatenate([[0], np.cumsum(lengths)]),
        special=special,
    )


def merge_words(vocabulary: Vocabulary, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words at ``flat[starts:ends]``, one after another, and the number of ids of each word."""
    lengths = ends - starts
    symbol = vocabulary.byte_ids[flat[ranges(starts, lengths)]]
    word = np.repeat(np.arange(len(starts)), lengths)
    done_symbols, done_words = [], []
    while len(symbol):
        keys = symbol[:-1] * vocabulary.size + symbol[1:]
        place = np.minimum(np.searchsorted(vocabulary.pair_keys, keys), len(vocabulary.pair_keys) - 1)
        known = (vocabulary.pair_keys[place] == keys) & (word[:-1] == word[1:])
        rank = np.full(len(symbol), NO_RANK)
        rank[:-1][known] = vocabulary.pair_ranks[place[known]]
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        lowest = np.minimum.reduceat(rank, first)
        counts = np.diff(np.append(first, len(word)))
        open_word = np.repeat(lowest < NO_RANK, counts)
        if not open_word.all():
            done_symbols.append(symbol[~open_word])
            done_words.append(word[~open_word])
        merge = (rank == np.repeat(lowest, counts)) & open_word
        at = np.flatnonzero(merge)
        if not len(at):
            break
        # In a run of overlapping occurrences, as of (a, a) in aaa, every second one merges.
        run_start = np.concatenate([[True], np.diff(at) != 1])
        offset = np.arange(len(at)) - np.maximum.accumulate(np.where(run_start, np.arange(len(at)), 0))
        at = at[offset % 2 == 0]
        symbol[at] = vocabulary.pair_results[place[at]]
        stay = open_word
        stay[at + 1] = False
        symbol, word = symbol[stay], word[stay]
    if not done_words:
        return np.empty(0, np.int64), np.zeros(len(starts), np.int64)
    symbols, words = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(words, kind="stable")
    return symbols[order], np.bincount(words, minlength=len(starts))


class WordStore:
    """Encoded words by hash, up to ``REMEMBERED_WORDS``; beyond that it starts anew."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.starts, self.ids = np.empty(0, np.int64), np.empty(0, np.int32)

    def places(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The row of ``starts`` and ``counts`` that holds each word; unknown words are encoded first."""
        hashes, first, back = np.unique(span_hashes(prefix_hashes(flat), starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) > REMEMBERED_WORDS:
            self._clear()
        place = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        new = self.hashes[place] != hashes if len(self.hashes) else np.ones(len(hashes), bool)
        if new.any():
            ids, counts = merge_words(self.vocabulary, flat, starts[first[new]], ends[first[new]])
            begin = len(self.ids) + np.cumsum(counts) - counts
            all_hashes = np.concatenate([self.hashes, hashes[new]])
            order = np.argsort(all_hashes)
            self.hashes = all_hashes[order]
            self.starts = np.concatenate([self.starts, begin])[order]
            self.counts = np.concatenate([self.counts, counts])[order]
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            place = np.searchsorted(self.hashes, hashes)
        return place[back]


@lru_cache(maxsize=2)
def word_store(path: str) -> WordStore:
    """The encoded words of this Python worker, kept from task to task."""
    return WordStore(load_vocabulary(path))


def split_special(column: pa.Array, vocabulary: Vocabulary) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts cut at special strings: the parts, the row of each, and the special id that follows it (-1: none)."""
    rows = np.arange(len(column))
    plain = np.full(len(column), -1)
    held = np.zeros(len(column), bool)
    for string in vocabulary.special:
        held |= pc.fill_null(pc.match_substring(column, string), False).to_numpy(zero_copy_only=False)
    if not held.any():
        return column, rows, plain
    parts, owner, follows = [], [], []
    longest_first = sorted(vocabulary.special, key=len, reverse=True)
    for row, text in enumerate(column.to_pylist()):
        at = 0
        text = text or ""
        while held[row]:
            found = min(((p, -len(s), s) for s in longest_first if (p := text.find(s, at)) >= 0), default=None)
            if found is None:
                break
            parts.append(text[at : found[0]])
            owner.append(row)
            follows.append(vocabulary.special[found[2]])
            at = found[0] + len(found[2])
        parts.append(text[at:])
        owner.append(row)
        follows.append(-1)
    return pa.array(parts, pa.large_string()), np.array(owner), np.array(follows)


def encode_slice(store: WordStore, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a column, one after another, and ``len + 1`` offsets."""
    parts, owner, follows = split_special(column, store.vocabulary)
    flat, bounds = flat_bytes(parts, end=b"\n")
    starts, ends = word_spans(flat, bounds[1:] - 1)
    part = np.searchsorted(bounds, starts, "right") - 1
    place = store.places(flat, starts, ends) if len(starts) else np.empty(0, np.int64)
    counts = store.counts[place]
    ids = store.ids[ranges(store.starts[place], counts)]
    part_counts = np.bincount(part, weights=counts, minlength=len(parts)).astype(np.int64)
    special = np.flatnonzero(follows >= 0)
    if len(special):
        ids = np.insert(ids, np.cumsum(part_counts)[special], follows[special])
        part_counts[special] += 1
    row_counts = np.bincount(owner, weights=part_counts, minlength=len(column)).astype(np.int64)
    return ids.astype("<u4"), np.concatenate([[0], np.cumsum(row_counts)])


def decode_slice(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every run of ids, one after another, and their offsets."""
    starts = vocabulary.piece_starts[ids]
    lengths = vocabulary.piece_starts[ids.astype(np.int64) + 1] - starts
    total = np.concatenate([[0], np.cumsum(lengths)])
    return vocabulary.piece_bytes[ranges(starts, lengths)], total[offsets]


def encode_texts(docs: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of ``text`` as ``ids`` (ARRAY<INT>); a column of that name is replaced.

    The vocabulary file must lie at ``vocabulary_path`` on every executor.
    """
    source = docs.drop(ids)
    schema = T.StructType([*source.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = word_store(vocabulary_path)
        for batch in slices(batches, text):
            found, offsets = encode_slice(store, batch.column(text))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, ids])

    return source.mapInArrow(encode, schema)


def _bounded(batch: pa.RecordBatch, ids: str) -> Iterator[pa.RecordBatch]:
    """The batch cut between rows, at most ``DECODED_IDS`` ids or one row each."""
    total = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + DECODED_IDS, "right")))
        yield batch.slice(at, to - at)
        at = to


def decode_ids(encoded: DataFrame, vocabulary_path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of ``ids`` as ``text``; a column of that name is replaced.

    Null ids decode to an empty text; byte sequences that are not UTF-8 are replaced as the library does.
    """
    source = encoded.drop(text)
    schema = T.StructType([*source.schema.fields, T.StructField(text, T.StringType(), False)])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_vocabulary(vocabulary_path)
        for batch in (part for whole in batches for part in _bounded(whole, ids)):
            lists = pc.fill_null(batch.column(ids), [])
            numbers = np.asarray(lists.flatten()).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
            flat, bounds = decode_slice(vocabulary, numbers, offsets)
            data = flat.tobytes()
            texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])

    return source.mapInArrow(decode, schema)


def token_digests(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per text its id count and the SHA-256 of its ids and of what they decode to.

    The same rounds as :func:`encode_texts` and :func:`decode_ids`, without sending ids through Spark.
    """
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = word_store(vocabulary_path)
        for batch in slices(batches, text):
            ids, offsets = encode_slice(store, batch.column(text))
            flat, bounds = decode_slice(store.vocabulary, ids, offsets)
            of_ids = [hashlib.sha256(ids[a:b].tobytes()).hexdigest() for a, b in zip(offsets, offsets[1:], strict=False)]
            of_text = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(np.diff(offsets)), pa.array(of_ids), pa.array(of_text)], names=schema.names
            )

    return docs.select(key, text).mapInArrow(digest, schema)
