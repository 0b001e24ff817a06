"""Operators on vectors and the graph helper, against brute force."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import projection_dedup, threshold_topk
from tidemill.llm.components import connected_components

NAMES = "vec_id long, embedding array<float>, label int, rep long, v string"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        rows.append((i, rng.standard_normal(12).astype(np.float32).tolist(), int(i % 3)))
    center = np.array(rows[5][1])
    for i in range(400, 760):  # one dense group, all of label 2
        rows.append((i, (center + 0.05 * rng.standard_normal(12)).astype(np.float32).tolist(), 2))
    rows += [(800 + i, rows[7][1], 1) for i in range(4)]  # equal vectors
    return rows


ODD = [
    (900, None, 1), (901, [], 1), (902, [0.0] * 12, 1), (903, [float("nan")] * 12, 1), (904, [None] * 12, 1),
    (905, [float("inf")] * 12, 1), (906, [1.0] * 12, None), (907, [1.0, 2.0], 1), (None, [1.0] * 12, 1),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], NAMES).repartition(4)


def test_linked_vectors_equal_all_pairs(spark, vectors, monkeypatch):
    monkeypatch.setattr(projection_dedup, "BLOCK", 64)
    unit = np.array([r[1] for r in vectors], np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r[2] for r in vectors])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    ids = [r[0] for r in vectors]
    component = brute.closure(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)])
    want = {i: (int(n), component[i], component[i] == i) for i, n in zip(ids, near.sum(axis=1), strict=True)}
    want |= {r[0]: (0, r[0], True) for r in ODD if r[0] is not None}
    got = projection_dedup.near_duplicate_vectors(frame(spark, vectors + ODD)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is not None} == want
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is None] == [(0, None, True)]
    assert projection_dedup.near_duplicate_vectors(frame(spark, vectors).limit(0)).count() == 0


def test_links_that_no_window_shows(spark, monkeypatch):
    monkeypatch.setattr(projection_dedup, "PASSES", 2)
    monkeypatch.setattr(projection_dedup, "WINDOW", 4)
    monkeypatch.setattr(projection_dedup, "BLOCK", 64)
    rng = np.random.default_rng(8)
    base = np.ones(24) + 0.5 * rng.standard_normal((900, 24))  # a cone, with isolated pairs in it
    near = base[:200] + 0.17 * rng.standard_normal((200, 24))
    whole = np.concatenate([base, near, rng.standard_normal((300, 24))])
    rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(whole)]
    unit = np.array([r[1] for r in rows], np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.98
    np.fill_diagonal(linked, False)
    assert linked.sum() > 200
    component = brute.closure(range(len(rows)), list(zip(*(x.tolist() for x in np.nonzero(linked)), strict=True)))
    got = projection_dedup.near_duplicate_vectors(frame(spark, rows)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (int(n), component[i]) for i, n in enumerate(linked.sum(axis=1))}


def test_top_k_equals_sorting(spark, vectors, monkeypatch):
    monkeypatch.setattr(threshold_topk, "CELL_ROWS", 200)
    monkeypatch.setattr(threshold_topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(threshold_topk, "FIRST_DEPTH", 4)
    rows = threshold_topk.top_k(frame(spark, vectors + ODD), F.col("vec_id") % 100 == 0, k=10).collect()
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    whole = [r for r in vectors + [(906, [1.0] * 12, None)]]
    ints = np.floor(np.array([r[1] for r in whole], np.float64) * 1024).astype(np.int64)
    for q, row in enumerate(whole):
        if row[0] % 100 == 0:
            score = ints @ ints[q]
            best = sorted((-int(s), r[0]) for s, r in zip(score, whole, strict=True) if r[0] != row[0])[:10]
            assert [got[row[0]][k] for k in range(1, 11)] == [(i, -s) for s, i in best]
    assert set(got) == {r[0] for r in whole if r[0] % 100 == 0}
    assert threshold_topk.top_k(frame(spark, vectors).limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_few_candidates_and_zero_queries(spark):
    rows = [(0, [0.0, 0.0], 1), (1, [1.0, 2.0], 1), (2, [-1.0, 0.5], 1)]
    got = threshold_topk.top_k(frame(spark, rows), F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 0), (0, 2, 2, 0)]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 5000), (6001, 6000), (6000, 6001)]
    edges += [(None, 4), (7, None)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    sound = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    assert got == brute.closure({n for e in sound for n in e}, sound)


def test_top_k_with_repeated_queries_and_huge_components(spark):
    rows = [(100, [0.5, 0.25], 1), (100, [0.5, 0.25], 1), (1, [0.4, 0.1], 1), (2, [0.1, 0.9], 1), (3, [1e30, 1.0], 1), (4, [0.4, 0.1], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = [tuple(r) for r in threshold_topk.top_k(frame, F.col("vec_id") % 100 == 0, k=10).orderBy("rank").collect()]
    assert got == [(100, 1, 2, 288000), (100, 2, 1, 235520), (100, 3, 4, 235520)]  # the query asks once; 1e30 takes no part
