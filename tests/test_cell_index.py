"""Approximate neighbours over k-means cells, against the exact search."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.operators import cell_index
from tidemill.operators.vector_search import nearest


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((12, 8))
    rows = [(i, (centres[i % 12] + 0.3 * rng.standard_normal(8)).astype(np.float32).tolist(), i % 3) for i in range(900)]
    rows += [(900, None, 1), (901, [float("nan")] * 8, 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)


def test_every_row_stored_in_its_nearest_cell(spark, vectors, tmp_path, monkeypatch):
    monkeypatch.setattr(cell_index, "SPLIT_ROWS", 40)  # crowded cells split
    index = cell_index.build(vectors, str(tmp_path / "store"))
    rows = cell_index.checked(index, spark)
    assert rows.count() == 902
    assert rows.where("cell >= 0 and not nearest_cell").count() == 0
    assert rows.where("cell = -1").select("vec_id").orderBy("vec_id").collect() == [(900,), (901,)]
    assert index.cells(spark).agg(F.max("subs")).first()[0] > 1
    plan = index.read(spark).where("cell = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan


def test_search_reaches_the_recall_it_measured(spark, vectors, tmp_path):
    index = cell_index.build(vectors, str(tmp_path / "store2"))
    probes, measured = cell_index.calibrate(index, vectors, 4)
    assert measured >= cell_index.TARGET
    queries = vectors.where("vec_id % 10 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    found = cell_index.search(index, queries, 4, probes)
    exact = nearest(vectors.select("vec_id", "embedding"), queries, 4, id_column="vec_id")
    assert cell_index.recall(found, exact, "vec_id").agg(F.avg("recall")).first()[0] >= 0.9
    every = cell_index.search(index, queries, 4, len(index.centroids))
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, exact.select("query_id", "rank", "vec_id", "score").collect()))


def test_groups_hold_every_cell_and_all_cells_give_the_exact_answer(spark, vectors, tmp_path, monkeypatch):
    """Cells meet queries in groups of bounded rows; small groups and blocks change nothing."""
    monkeypatch.setattr(cell_index, "GROUP_ROWS", 100)
    monkeypatch.setattr(cell_index, "BLOCK_ROWS", 50)
    index = cell_index.build(vectors, str(tmp_path / "grouped"))
    rows = {r["cell"]: r["rows"] for r in index.cells(spark).collect()}
    units = cell_index._cell_groups(index, spark)
    assert {c for c, _, _ in units} == {c for c, n in rows.items() if n}
    for group in {g for _, _, g in units}:
        held = [rows[c] for c, _, g in units if g == group]
        assert len(held) == 1 or sum(held) <= 100
    queries = vectors.select(F.col("vec_id").alias("query_id"), "embedding").where("query_id % 7 = 0")
    asked = [tuple(r) for r in cell_index.search(index, queries, 4, len(index.centroids)).collect()]
    exact = nearest(vectors.select("vec_id", "embedding"), queries, 4, id_column="vec_id")
    assert sorted(asked) == sorted(tuple(r) for r in exact.collect())


def test_calibration_takes_its_queries_once(spark, vectors, tmp_path):
    """The rows come in another order whenever they are read, as from shuffled blocks, so a second sample holds others."""
    index = cell_index.build(vectors, str(tmp_path / "shuffled"))

    def shuffled(batches):
        rng = np.random.default_rng()
        for batch in batches:
            yield batch.take(pa.array(rng.permutation(batch.num_rows)))

    store = vectors.unionAll(spark.createDataFrame([(None, [0.0] * 8, 1)], vectors.schema)).mapInArrow(shuffled, vectors.schema)
    for _ in range(3):
        probes, measured = cell_index.calibrate(index, store, 4)
        assert 1 <= probes <= len(index.centroids) and cell_index.TARGET <= measured <= 1
    assert cell_index.calibrate(index, store.limit(0), 4) == (len(index.centroids), 1.0)
