"""Texts of Arrow batches as flat byte arrays, and 64-bit hashes of their parts.

Helpers of the operators in this folder.  A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
"""Bytes of text handled at once; a longer text is handled alone."""

_ODD = np.uint64(0x9E3779B97F4A7C15)


def flat_bytes(column: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and ``len + 1`` offsets; ``end`` closes every text."""
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    if end:
        texts = pc.binary_join_element_wise(texts, pa.scalar(end, pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.empty(0, np.uint8)
    return flat, bounds - bounds[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut between rows so that each holds at most ``limit`` bytes of text or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@cache
def byte_values() -> np.ndarray:
    """A random value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if len(_POWERS["up"]) < count:
        size = max(count, SLICE_BYTES + (1 << 16))
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"][:count], _POWERS["down"][:count]


def prefix_hashes(flat: np.ndarray) -> np.ndarray:
    """Sums from which :func:`span_hashes` takes the hash of any stretch of ``flat``."""
    up, _ = _powers(len(flat) + 1)
    sums = np.zeros(len(flat) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(byte_values()[flat] * up[:-1], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings from ``starts`` to ``ends``, lengths included."""
    _, down = _powers(len(sums))
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The integers ``starts[i] .. starts[i] + counts[i] - 1`` of every ``i``, one after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)
