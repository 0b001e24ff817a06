"""Splitting a text into overlapping chunks."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .batches import text_slices
from .blank import let, words

CHUNK_SIZE = 1000
OVERLAP = 200


def _check(size: int, overlap: int) -> None:
    if not 0 <= overlap < size:
        raise ValueError(f"overlap {overlap} must be at least 0 and below the chunk size {size}")


def chunk_words(c: Column, size: int = CHUNK_SIZE, overlap: int = OVERLAP) -> Column:
    """Windows of ``size`` words, each starting ``size - overlap`` after the last."""
    _check(size, overlap)

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 1, F.lit(size - overlap))
        return F.when(
            F.size(w) > 0,
            F.transform(starts, lambda i: F.array_join(F.slice(w, i + 1, size), " ")),
        ).otherwise(F.array().cast("array<string>"))

    return let(words(c), windows)


def _pack(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Join neighbouring pieces up to ``size``, carrying back whole pieces up to ``overlap``."""
    chunks: list[str] = []
    held: deque[str] = deque()
    length = 0
    for piece in pieces:
        if held and length + len(piece) > size:
            chunks.append("".join(held).strip())
            while length > overlap or (length and length + len(piece) > size):
                length -= len(held.popleft())
        held.append(piece)
        length += len(piece)
    chunks.append("".join(held).strip())
    return [c for c in chunks if c]


def _cut(text: str, separator: str) -> list[str]:
    """Pieces of ``text``, each but the first led by its separator."""
    if not separator:
        return list(text)
    first, *rest = text.split(separator)
    return [p for p in [first, *(separator + r for r in rest)] if p]


def split_characters(
    text: str, size: int, overlap: int, separators: list[str] = fixed.CHUNK_SEPARATORS
) -> list[str]:
    """Chunks of at most ``size`` characters, cut at the coarsest separator that fits."""
    at = next(i for i, s in enumerate(separators) if s in text)
    finer = separators[at + 1 :]
    chunks: list[str] = []
    short: list[str] = []
    for piece in _cut(text, separators[at]):
        if len(piece) < size or not finer:
            short.append(piece)
            continue
        chunks += _pack(short, size, overlap)
        chunks += split_characters(piece, size, overlap, finer)
        short = []
    return chunks + _pack(short, size, overlap)


def chunk_characters(c: Column, size: int = CHUNK_SIZE, overlap: int = OVERLAP) -> Column:
    """Chunks cut at paragraphs, lines, sentences, blanks or characters.

    The cut depends on what came before it in the text, which array functions
    cannot express within reason, so the split runs as an Arrow UDF per text.
    """
    _check(size, overlap)

    @F.arrow_udf("array<string>")
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in text_slices(batch):
                chunks = [None if t is None else split_characters(t, size, overlap) for t in texts.to_pylist()]
                yield pa.array(chunks, pa.list_(pa.string()))

    return split.asNondeterministic()(c)  # so that no filter evaluates it again
