"""Ranked lexical search against brute force."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from tidemill.llm import signature_search as lexical

VOCAB = ["river", "stone", "Lamp", "ORBIT", "kite", "maple", "x1", "42", "héllo", "naïve", "q_q", "über"]


@pytest.fixture(scope="module")
def case():
    rng = random.Random(9)
    say = lambda n: " ".join(rng.choice(VOCAB) + rng.choice(["", "", ",", "."]) for _ in range(n))
    docs = [(d, say(rng.randint(0, 60))) for d in range(300)]
    docs += [(400, None), (401, ""), (402, "river " * 5000), (403, docs[7][1]), (403, docs[7][1]), (404, "!!!"), (None, "river stone")]
    items = [(i, say(rng.randint(1, 6))) for i in range(25)] + [(90, "nothing matches"), (91, None), (None, "river"), (92, "river river RIVER")]
    return docs, items


def test_ranks_equal_brute_force(spark, case, monkeypatch):
    docs, items = case
    want = sorted(brute.lexical_search(docs, items))
    assert len(want) > 500
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, lexical.search(frame, bench).collect())) == want
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 7)  # items in several passes
    assert sorted(map(tuple, lexical.search(frame, bench).collect())) == want


def test_bounds_never_exclude_a_better_document():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 200))) for _ in range(400)]
    counted = [brute.Counter(t.split()) for t in texts]
    n = np.array([len(t.split()) for t in texts])
    block = lexical.Block([(1, "w3", sum(1 for c in counted if c["w3"]), [5, 9]), (1, "w7", sum(1 for c in counted if c["w7"]), [11, 2])], 400, int(n.sum()))
    bits = pa.array([sorted({b for w, bs in (("w3", [5, 9]), ("w7", [11, 2])) if c[w] for b in bs} | {100}) for c in counted], pa.list_(pa.int32()))
    found, rescored = lexical.rank_batch(block, np.arange(400), pa.array(texts), n, lexical._slices(bits, 400), k=10)
    assert rescored < 400
    exact = sorted((-sum(w * lexical.part_of(c[t], 50 + (50 * int(k) * 400) // int(n.sum())) for t, w, _ in block.items[1] if c[t]), d) for d, (c, k) in enumerate(zip(counted, n)))
    assert found[1] == [(-s, d) for s, d in exact if s < 0][:10]


def test_empty_inputs_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "river stone", "x", 3)], "doc_id long, text string, bits string, n int")
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical.search(docs, none).count() == 0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lexical.search(empty, spark.createDataFrame([(1, "river")], "item_id long, text string")).count() == 0
    got = [tuple(r) for r in lexical.search(docs, spark.createDataFrame([(1, "river")], "item_id long, text string")).collect()]
    assert got == [(1, 1, 1, brute.lexical_search([(1, "river stone")], [(1, "river")])[0][3])]


def test_tiers_spare_documents_that_plain_signatures_rescore():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words, rng.integers(20, 120))) for _ in range(1500)]
    counted = [brute.Counter(t.split()) for t in texts]
    n, bits, tiers = lexical.index(pa.array(texts))
    assert n.tolist() == [len(t.split()) for t in texts]
    asked = ["w3", "w7", "w11"]
    places = lexical.term_bits([t.encode() for t in asked]).tolist()
    block = lexical.Block([(1, t, sum(1 for c in counted if c[t]), p) for t, p in zip(asked, places, strict=True)], 1500, int(n.sum()))
    plain, many = lexical.rank_batch(block, np.arange(1500), pa.array(texts), n, lexical._slices(bits, 1500), k=10)
    found, few = lexical.rank_batch(block, np.arange(1500), pa.array(texts), n, lexical._slices(bits, 1500, tiers), k=10)
    assert found == plain
    assert few < 100 < many / 5


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_counts_and_tiers_of_texts_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(lexical, "PIECE", piece)
    texts = ["River" * 9 + " stone RIVER", None, "", "lamp,lamp;lamp" + " lamp" * 30, "lamp", "über Über ñ x 9_9", "a\0b\0a", "!!!", "stone" * 40]
    counted = [brute.Counter(lexical._TERM.findall((t or "").encode().lower())) for t in texts]
    column = pa.array(["cut off", *texts, "cut off"]).slice(1, len(texts))
    n, bits, tiers = lexical.index(column)
    assert n.tolist() == [sum(c.values()) for c in counted]
    terms = sorted({t for c in counted for t in c} | {b"nowhere"})
    planes = np.unpackbits(lexical._slices(bits, len(texts), tiers), axis=2, count=len(texts))
    for term, (a, b) in zip(terms, lexical.term_bits(terms).tolist(), strict=True):
        tier = (planes[:, a] & planes[:, b]).sum(axis=0)
        assert tier.tolist() == np.searchsorted(lexical.TIERS, [c[term] for c in counted], "right").tolist()
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    (out,) = lexical._count(terms)([batch, batch.slice(0, 0), batch.slice(3, 2)])
    got = {r["term"]: (r["docs"], r["terms"]) for r in out.to_pylist()}
    twice = counted + counted[3:5]
    assert got == {i: (df, 0) for i, t in enumerate(terms) if (df := sum(1 for c in twice if c[t]))} | {-1: (sum(1 for c in twice if c), sum(sum(c.values()) for c in twice))}


def test_best_of_a_task_over_batches_of_any_size(case, monkeypatch):
    docs, items = case
    want = sorted((i, d, s) for i, _, d, s in brute.lexical_search(docs, items))
    pairs = [(i, t) for i, text in items if i is not None for t in dict.fromkeys(x.decode() for x in lexical._TERM.findall((text or "").encode().lower()))]
    terms = sorted({t for _, t in pairs})
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs], pa.int64()), pa.array([t for _, t in docs])], names=["doc_id", "text"])
    for rows, size, group in ((1 << 20, 1 << 20, 5000), (3, 1 << 20, 2), (50, 100, 9)):
        monkeypatch.setattr(lexical, "BATCH_ROWS", rows)
        monkeypatch.setattr(lexical, "BATCH_BYTES", size)
        monkeypatch.setattr(lexical, "GROUP_TERMS", group)
        (out,) = lexical._count([t.encode() for t in terms])([batch.select(["text"])])
        told = {r["term"]: r for r in out.to_pylist()}
        df = {t: told[i]["docs"] if i in told else 0 for i, t in enumerate(terms)}
        bits = dict(zip(terms, lexical.term_bits([t.encode() for t in terms]).tolist(), strict=True))
        block = lexical.Block([(i, t, df[t], bits[t]) for i, t in pairs], told[-1]["docs"], told[-1]["terms"])
        (found,) = lexical._scan(block)([batch])
        assert sorted(tuple(r.values()) for r in found.to_pylist()) == want
