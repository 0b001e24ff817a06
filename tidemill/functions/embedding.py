"""Text to vector.

Any Arrow UDF from STRING to ARRAY<FLOAT> can take the place of
:func:`hashing_embedding`, for instance one that calls a model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import md5
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .batches import text_slices

DIMENSION = 64
CACHED_WORDS = 1 << 17


def word_hash(word: str) -> int:
    return int(md5(word.encode("utf-8", "surrogatepass")).hexdigest()[:4], 16)


def hash_text(text: str, dimension: int, hash_of: Callable[[str], int] = word_hash) -> np.ndarray:
    """Counts of hashed lower-case words, scaled to length one."""
    hashes = np.fromiter(map(hash_of, text.lower().split()), dtype=np.int64)
    counts = np.bincount(hashes % dimension, minlength=dimension)
    length = np.sqrt(float((counts * counts).sum()))
    return (counts / length if length else counts).astype(np.float32)


def hash_texts(texts: list[str | None], dimension: int, hash_of: Callable[[str], int] = word_hash) -> list[np.ndarray | None]:
    """:func:`hash_text` of many texts at once; NULL stays NULL."""
    words = [[] if t is None else t.lower().split() for t in texts]
    row = np.repeat(np.arange(len(texts)), [len(w) for w in words])
    codes, distinct = pd.factorize(np.array(list(chain.from_iterable(words)), dtype=object))
    bucket = np.fromiter(map(hash_of, distinct), dtype=np.int64, count=len(distinct)) % dimension
    counts = np.bincount(row * dimension + bucket[codes], minlength=len(texts) * dimension).reshape(len(texts), dimension)
    length = np.sqrt((counts * counts).sum(axis=1).astype(float))
    scaled = (counts / np.where(length, length, 1.0)[:, None]).astype(np.float32)
    return [None if t is None else scaled[k] for k, t in enumerate(texts)]


def hashing_embedding(c: Column, dimension: int = DIMENSION) -> Column:
    """Deterministic feature hashing.

    An Arrow UDF, because words repeat: each distinct word of a slice is
    hashed once, and one count over rows and buckets gives all vectors.
    """

    @F.arrow_udf("array<float>")
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hash_of = lru_cache(maxsize=CACHED_WORDS)(word_hash)
        for batch in batches:
            for texts in text_slices(batch):
                yield pa.array(hash_texts(texts.to_pylist(), dimension, hash_of), pa.list_(pa.float32()))

    return embed.asNondeterministic()(c)  # so that no filter evaluates it again
