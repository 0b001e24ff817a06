"""Hard-negative mining against brute force."""

import brute
import numpy as np
import pytest

from tidemill.llm import hard_negatives as mining

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    centre = rng.standard_normal(16)
    found = []
    for i in range(1, 1400):
        v = 0.3 * centre + 0.2 * rng.standard_normal(16) if i % 3 else rng.standard_normal(16)
        found.append((i, v.astype(np.float32).tolist(), int(rng.integers(0, 4))))
    found += [found[99], found[99], (1400, found[199][1], 2), (1401, found[199][1], 2)]  # repeats and ties
    found += [(1500, None, 1), (1600, [0.5] * 16, None), (1700, [float("nan")] * 16, 1), (1800, [1.0, None] + [0.0] * 14, 1)]
    found += [(1900, [0.0] * 16, 1), (2000, [0.25] * 8, 1), (None, [0.1] * 16, 1), (2100, [float("inf")] + [0.0] * 15, 2)]
    return found


def test_mining_equals_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(mining, "CELL_ROWS", 97)
    monkeypatch.setattr(mining, "ANCHOR_BLOCK", 4)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(map(tuple, mining.hard_negatives(frame).collect()))
    want = sorted(brute.hard_negatives(rows))
    assert len(want) > 200
    assert got == want


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    import pandas as pd

    x = (256 * rng.standard_normal((300, 64))).tolist()
    frame = pd.DataFrame({"id": range(300), "label": [0] * 300, "dims": [64] * 300, "x": x})
    s = mining.Summaries(frame)
    exact = s.v @ s.v.T
    for level in range(len(mining.LEVELS)):
        lo, hi = mining._bounds(s, s, level, slice(None), slice(None))
        assert (lo <= exact).all() and (exact <= hi).all()
    coarse = mining._bounds(s, s, 0, slice(None), slice(None))
    fine = mining._bounds(s, s, 1, slice(None), slice(None))
    assert (fine[1] - fine[0]).mean() < (coarse[1] - coarse[0]).mean()


def test_no_anchor_or_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mining.hard_negatives(empty).count() == 0
    few = spark.createDataFrame([(1, [0.1, 0.2], 1), (2, [0.3, 0.1], 2)], SCHEMA)
    assert mining.hard_negatives(few).count() == 0


def test_clashing_extra_columns(spark):
    frame = spark.createDataFrame([(100, [0.5, 0.5], 1, 7, 8), (101, [0.4, 0.5], 1, 7, 8), (102, [0.2, 0.2], 2, 7, 8)], SCHEMA + ", anchor long, x long")
    assert [tuple(r) for r in mining.hard_negatives(frame).collect()] == [(100, 101, 1, 102, 29440, 13056)]
