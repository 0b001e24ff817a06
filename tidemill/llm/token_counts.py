"""Token counts by a compiled finite-state transducer, without token ids.

The transducer reads a text once and writes numbers.  Its control is the small
word automaton of ``pretokens``; the state map of a block of characters is
composed with those of other blocks by a parallel prefix scan, so that every
block knows its entry state without a pass from the start of the text.  The
transition that closes a word is annotated with the number of tokens that the
word emits.  Annotations are compiled when a word is first met, by merging its
bytes once, and stay with the Python worker up to a bound; a text is then
counted by adding the annotations on its path.

Special strings of the vocabulary emit one token.  A null or empty text has no
bytes and no tokens.  Whole texts are read, whatever their length; repeated
rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemill.llm.arrow_text import flat_bytes, prefix_hashes, slices, span_hashes
from tidemill.llm.bpe import Vocabulary, load_vocabulary, merge_words, split_special
from tidemill.llm.pretokens import word_spans

ANNOTATIONS = 2_000_000


class CountTransducer:
    """Emitted-token counts of closing transitions, compiled on demand."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._words = np.empty(0, np.uint64)
        self._emits = np.empty(0, np.int64)

    def _compile(self, words: np.ndarray, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Annotate the transitions that close the given words."""
        _, counts = merge_words(self.vocabulary, flat, starts, ends)
        merged = np.concatenate([self._words, words])
        order = np.argsort(merged, kind="stable")
        self._words, self._emits = merged[order], np.concatenate([self._emits, counts])[order]

    def _annotated(self, words: np.ndarray) -> np.ndarray:
        if not len(self._words):
            return np.zeros(len(words), bool)
        return self._words[np.minimum(np.searchsorted(self._words, words), len(self._words) - 1)] == words

    def run(self, column: pa.Array) -> np.ndarray:
        """The tokens that every text of the column emits."""
        parts, owner, follows = split_special(column, self.vocabulary)
        flat, bounds = flat_bytes(parts, end=b"\n")
        starts, ends = word_spans(flat, bounds[1:] - 1)
        words, first, back = np.unique(span_hashes(prefix_hashes(flat), starts, ends), return_index=True, return_inverse=True)
        new = ~self._annotated(words)
        if new.any():
            if len(self._words) + int(new.sum()) > ANNOTATIONS:  # start anew, with all words of these texts
                self._words, self._emits, new = self._words[:0], self._emits[:0], np.ones(len(words), bool)
            self._compile(words[new], flat, starts[first[new]], ends[first[new]])
        emitted = self._emits[np.searchsorted(self._words, words)][back] if len(words) else np.empty(0, np.int64)
        row = owner[np.searchsorted(bounds, starts, "right") - 1]
        counts = np.bincount(row, weights=emitted, minlength=len(column)).astype(np.int64)
        return counts + np.bincount(owner[follows >= 0], minlength=len(column))


@lru_cache(maxsize=2)
def transducer(path: str) -> CountTransducer:
    """The transducer of this Python worker, kept from task to task."""
    return CountTransducer(load_vocabulary(path))


def count_tokens(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """One row per text: ``key``, its UTF-8 bytes, its tokens, and whether these exceed ``limit``.

    The vocabulary file must lie at ``vocabulary_path`` on every executor.
    """
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(vocabulary_path)
        for batch in slices(batches, text):
            _, bounds = flat_bytes(batch.column(text))
            tokens = machine.run(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(np.diff(bounds)), pa.array(tokens), pa.array(tokens > limit)], names=schema.names
            )

    return docs.select(key, text).mapInArrow(count, schema)
