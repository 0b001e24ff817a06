"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text in windows of ``WINDOW`` bytes, all windows of a block
side by side, one layer of gated units from either end, and gives every
position a probability for each language.  A document's probabilities are the
means over all of its positions.  It is trained in numpy by backpropagation
through time on a bounded sample of labelled rows.

Training sees at most ``SAMPLE_DOCS`` rows per language in expectation (rows
are chosen by a hash of their key, at a rate set by the count of the language)
and ``SAMPLE_WINDOWS`` windows of each; prediction reads every byte of every
text.  Predictions use the text alone.

A null text, and one without a letter, is ``und`` with score 0.  Without
labelled rows every text is ``und``.  Rows without key are predicted but not
learned from.  Repeated rows give repeated predictions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.arrow_text import flat_bytes, slices

WINDOW, HIDDEN, BLOCK = 64, 8, 4096
SAMPLE_DOCS, SAMPLE_WINDOWS, ROUNDS, BATCH, RATE = 300, 3, 10, 128, 0.03
UNDETERMINED = "und"


@dataclass
class Direction:
    """One reading direction: gates in the order update, reset, candidate."""

    inputs: np.ndarray  # (3H, 256): contribution of each byte, biases included
    recur: np.ndarray  # (3H, H)
    shift: np.ndarray  # (H, 1): bias inside the reset gate
    out: np.ndarray  # (K, H)

    def arrays(self) -> list[np.ndarray]:
        return [self.inputs, self.recur, self.shift, self.out]


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    bias: np.ndarray  # (K, 1)

    def arrays(self) -> list[np.ndarray]:
        return [*self.forward.arrays(), *self.backward.arrays(), self.bias]


def new_network(languages: list[str], rng: np.random.Generator) -> Network:
    def direction() -> Direction:
        h, k = HIDDEN, len(languages)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        return Direction(draw(3 * h, 256), draw(3 * h, h), np.zeros((h, 1), np.float32), draw(k, h))

    return Network(languages, direction(), direction(), np.zeros((len(languages), 1), np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


def read(part: Direction, steps: np.ndarray, trace: list | None = None) -> np.ndarray:
    """Language scores of every step: ``steps`` is (T, B) bytes, the result (T, K, B).  ``trace`` gets what training needs."""
    h, many = HIDDEN, steps.shape[1]
    state = np.zeros((h, many), np.float32)
    scores = np.empty((len(steps), part.out.shape[0], many), np.float32)
    for t, byte in enumerate(steps):
        given = np.take(part.inputs, byte, axis=1)
        back = part.recur @ state
        gates = _sigmoid(given[: 2 * h] + back[: 2 * h])
        update, reset = gates[:h], gates[h:]
        inner = back[2 * h :] + part.shift
        fresh = np.tanh(given[2 * h :] + reset * inner)
        if trace is not None:
            trace.append((byte, state, update, reset, inner, fresh))
        state = fresh + update * (state - fresh)
        scores[t] = part.out @ state
    return scores


def learn_direction(part: Direction, trace: list, slope: np.ndarray) -> list[np.ndarray]:
    """Gradients of one direction, by backpropagation through time; ``slope`` is that of the scores, (T, K, B)."""
    h = HIDDEN
    inputs, recur, shift, out = (np.zeros_like(a) for a in part.arrays())
    later = np.zeros((h, slope.shape[2]), np.float32)
    for t in range(len(trace) - 1, -1, -1):
        byte, state, update, reset, inner, fresh = trace[t]
        now = fresh + update * (state - fresh)
        out += slope[t] @ now.T
        d = part.out.T @ slope[t] + later
        d_fresh = d * (1 - update) * (1 - fresh * fresh)
        d_update = d * (state - fresh) * update * (1 - update)
        d_reset = d_fresh * inner * reset * (1 - reset)
        d_inner = d_fresh * reset
        d_back = np.concatenate([d_update, d_reset, d_inner])
        d_given = np.concatenate([d_update, d_reset, d_fresh])
        recur += d_back @ state.T
        shift += d_inner.sum(axis=1, keepdims=True)
        hot = np.zeros((len(byte), 256), np.float32)
        hot[np.arange(len(byte)), byte] = 1
        inputs += d_given @ hot
        later = d * update + part.recur.T @ d_back
    return [inputs, recur, shift, out]


def _softmax(scores: np.ndarray, axis: int) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=axis, keepdims=True))
    return scores / scores.sum(axis=axis, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """A network fitted to ``windows`` (N, WINDOW) of bytes, every position of which has the label of its document."""
    rng = np.random.default_rng(seed)
    net = new_network(languages, rng)
    mean, square, step = [np.zeros_like(a) for a in net.arrays()], [np.zeros_like(a) for a in net.arrays()], 0
    total = ROUNDS * -(-len(windows) // BATCH)
    for _ in range(ROUNDS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            steps = np.ascontiguousarray(windows[chosen].T)
            ahead, behind = [], []
            scores = read(net.forward, steps, ahead) + read(net.backward, steps[::-1], behind)[::-1] + net.bias
            slope = _softmax(scores, axis=1)
            slope[:, labels[chosen], np.arange(len(chosen))] -= 1
            slope /= np.float32(len(chosen) * WINDOW)
            grads = learn_direction(net.forward, ahead, slope) + learn_direction(net.backward, behind, np.ascontiguousarray(slope[::-1]))
            grads.append(slope.sum(axis=(0, 2))[:, None])
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for array, grad, m, s in zip(net.arrays(), grads, mean, square, strict=True):
                m += np.float32(0.1) * (grad - m)
                s += np.float32(0.01) * (grad * grad - s)
                array -= np.float32(rate) * (m / np.float32(1 - 0.9**step)) / (np.sqrt(s / np.float32(1 - 0.99**step)) + np.float32(1e-7))
    return net


def predict(net: Network, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean position probabilities of every text, (texts, K); texts without bytes get zeros."""
    sizes = np.diff(bounds)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = bounds[owner] + nth * WINDOW
    lengths = np.minimum(WINDOW, bounds[owner + 1] - starts)
    padded = np.concatenate([flat, np.zeros(WINDOW, np.uint8)])
    sums = np.zeros((len(sizes), len(net.languages)))
    span = np.arange(WINDOW)
    for at in range(0, len(starts), BLOCK):
        begin, length = starts[at : at + BLOCK], lengths[at : at + BLOCK]
        ahead = read(net.forward, padded[begin + span[:, None]])
        behind = read(net.backward, padded[np.maximum(begin + length - 1 - span[:, None], 0)])
        full = int((length == WINDOW).all())
        if full:
            scores = ahead + behind[::-1]
        else:
            turned = np.maximum(length - 1 - span[:, None], 0)
            scores = ahead + np.take_along_axis(behind, turned[:, None, :], axis=0)
        scores = np.exp(scores + net.bias)
        scores /= scores.sum(axis=1, keepdims=True)
        if not full:
            scores *= (span[:, None] < length)[:, None, :]
        np.add.at(sums, owner[at : at + BLOCK], scores.sum(axis=0).T)
    return sums / np.maximum(sizes, 1)[:, None]


def with_letter(column: pa.Array, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    lower = flat | 0x20
    seen = np.concatenate([[0], np.cumsum((lower >= 97) & (lower <= 122))])
    found = seen[bounds[1:]] > seen[bounds[:-1]]
    for row in np.flatnonzero(~found & (np.diff(bounds) > 0)):
        found[row] = any(c.isalpha() for c in column[int(row)].as_py())
    return found


def training_sample(docs: DataFrame, key: str, text: str, lang: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows, their labels and the languages, from a bounded sample of the labelled rows."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(key).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(key).cast("string").alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    )
    counts = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return np.empty((0, WINDOW), np.uint8), np.empty(0, np.int64), []
    rate = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, SAMPLE_DOCS / counts[name]))])
    chance = F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 20)) / float(1 << 20)
    place = lambda k: F.pmod(F.xxhash64("key", F.lit(k)), F.greatest(F.length("text") - WINDOW, F.lit(1))).cast("int") + 1
    cut = F.array(*[F.substring("text", place(k), WINDOW) for k in range(SAMPLE_WINDOWS)])
    rows = labelled.where(chance < rate[F.col("lang")]).select("key", "lang", cut.alias("cuts")).orderBy("key", "lang", "cuts").collect()
    windows, labels = [], []
    for row in rows:
        for piece in row["cuts"]:
            data = piece.encode()
            data = (data * (WINDOW // max(len(data), 1) + 1))[:WINDOW]
            windows.append(np.frombuffer(data, np.uint8))
            labels.append(languages.index(row["lang"]))
    return np.stack(windows), np.array(labels), languages


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network learned from the labelled rows of ``docs``; None if there are none."""
    windows, labels, languages = training_sample(docs, key, text, lang)
    return train(windows, labels, languages) if languages else None


def label_languages(docs: DataFrame, net: Network | None, text: str = "text", pred: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """``docs`` with the predicted language and its probability; columns of these names are replaced."""
    source = docs.drop(pred, score)
    schema = T.StructType([*source.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*(net.languages if net else []), UNDETERMINED], dtype=object)
        for batch in slices(batches, text):
            column = batch.column(text)
            flat, bounds = flat_bytes(column)
            best, chance = np.full(len(column), len(names) - 1), np.zeros(len(column))
            if net is not None:
                mean = predict(net, flat, bounds)
                known = with_letter(column, flat, bounds)
                best[known] = mean.argmax(axis=1)[known]
                chance[known] = np.clip(mean.max(axis=1), 0, 1)[known]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names[best], pa.string()), pa.array(chance)], names=[*batch.schema.names, pred, score])

    return source.mapInArrow(label, schema)


def held_out(key: Column, part: int = 1, parts: int = 3) -> Column:
    """Whether a row is kept from training, by the checksum of its key as text; a null key counts as empty."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == part
