"""Benchmark decontamination against brute force."""

import random

import brute
import pytest

from tidemill.llm import winnowing

VOCAB = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "ünï", "x9"]


@pytest.fixture(scope="module")
def case():
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice(VOCAB) for _ in range(n))
    items = [(i, say(rng.randint(10, 40))) for i in range(1, 30)]
    items += [(100, "Alpha beta"), (101, "gamma"), (102, "one two three four five six seven eight nine"), (103, None), (None, "alpha beta gamma"), (104, "!!! ...")]
    items += [(105, "la " * 30), (106, items[3][1])]  # a periodic item and a repeated text under another id
    docs = []
    for d in range(120):
        parts = [say(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            text = rng.choice(items)[1] or ""
            words = text.split()
            cut = rng.randint(0, max(0, len(words) - 10))
            parts += [" ".join(words[cut : cut + rng.randint(5, 25)]).upper(), say(rng.randint(0, 5))]
        docs.append((d, ", ".join(parts)))
    docs += [(200, None), (201, ""), (202, "la " * 500), (203, "x " * 20000 + items[0][1]), (204, "one two three four five six seven eight nine"), (205, "ONE-two:three")]
    docs += [docs[3], docs[3]]
    return docs, items


def test_hits_equal_brute_force(spark, case, monkeypatch):
    docs, items = case
    want = sorted(brute.contamination(docs, items))
    assert sum(r[5] for r in want) > 30
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, winnowing.decontaminate(frame, bench).collect()))
    assert got == want
    monkeypatch.setattr(winnowing, "BLOCK_WORDS", 60)  # several passes over the documents, merged per row
    assert len(winnowing._item_blocks(bench, "item_id", "text")) > 5
    assert sorted(map(tuple, winnowing.decontaminate(frame, bench).collect())) == want


def test_empty_benchmark_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a b c", 5, "x"), (2, None, 6, "y")], "doc_id long, text string, words int, wh string")
    bench = spark.createDataFrame([], "item_id long, text string")
    got = sorted(map(tuple, winnowing.decontaminate(frame, bench).collect()))
    empty = brute.hashlib.sha256(b"").hexdigest()
    assert got == [(1, 3, 0, 0, empty, False), (2, 0, 0, 0, empty, False)]


def test_every_window_shares_a_fingerprint():
    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.integers(0, 5, 40)
        b = np.concatenate([rng.integers(0, 5, 7), a[13:23], rng.integers(0, 5, 9)])
        fa, fb = winnowing.fingerprints(a), winnowing.fingerprints(b)
        shared = {(int(p) - 13, int(v)) for p, v in zip(*fa) if 13 <= p <= 18}
        assert shared & {(int(q) - 7, int(v)) for q, v in zip(*fb)}
