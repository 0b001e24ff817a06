import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.functions.embedding import hash_text, hashing_embedding
from tidemill.operators import vector_search
from tidemill.operators.vector_search import nearest
from tidemill.plans import jobs

SCHEMA = "chunk_id long, source string, embedding array<float>"


def brute(store, queries, k):
    want = []
    for query_id, q in queries:
        exact = [(float(((np.asarray(v, np.float32).astype(float) - np.asarray(q, np.float32).astype(float)) ** 2).sum()), i) for i, _, v in store]
        scored = sorted((round(score, 9), i) for score, i in exact)  # ranks go by distances of nine decimals
        want += [(query_id, rank, i) for rank, (_, i) in enumerate(scored[:k], 1)]
    return want


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    store = [(i, f"s{i % 3}", rng.normal(size=8).round(1).tolist()) for i in range(500)]
    store += [(1000 + i, "copy", store[i][2]) for i in range(40)]  # ties
    queries = [(q, store[q * 7][2]) for q in range(30)] + [(99, [0.0] * 8)]
    return store, queries


@pytest.mark.parametrize("k", [1, 4, 700])
@pytest.mark.parametrize("query_rows", [2048, 5])
def test_nearest_equals_brute_force(spark, data, k, query_rows):
    store, queries = data
    s = spark.createDataFrame(store, SCHEMA).repartition(5)
    q = spark.createDataFrame(queries, "query_id long, embedding array<float>")
    got = nearest(s, q, k, query_rows=query_rows, cell_rows=130).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["chunk_id"]) for r in got] == brute(store, queries, k)
    assert got[0]["score"] == 0.0 and set(got[0].asDict()) == {"query_id", "rank", "chunk_id", "source", "score"}


def test_dimension_mismatch_fails(spark, data):
    s = spark.createDataFrame(data[0], SCHEMA)
    q = spark.createDataFrame([(1, [1.0, 2.0])], "query_id long, embedding array<float>")
    with pytest.raises(Exception, match="dimension"):
        nearest(s, q).collect()


def test_empty_sides(spark, data):
    s = spark.createDataFrame(data[0], SCHEMA)
    q = spark.createDataFrame([], "query_id long, embedding array<float>")
    assert nearest(s, q).count() == 0
    assert nearest(s.limit(0), spark.createDataFrame(data[1], "query_id long, embedding array<float>")).count() == 0


def test_embedding(apply):
    got = apply(hashing_embedding, "A b  a", "", None)
    assert np.allclose(got[0], hash_text("a a B", 64)) and np.isclose(np.linalg.norm(got[0]), 1)
    assert got[1] == [0.0] * 64 and got[2] is None


PAGES = [
    (0, "https://h/a", "<nav><p>menu</p></nav><h1>Apples</h1><p>Apples are red fruit.</p><p>apples are RED fruit.</p>"),
    (1, "https://h/b", "<h1>Trains</h1><p>Trains run on rails.</p>"),
    (2, "https://h/c", "<script>1</script>"),
    (3, "https://h/d", None),
]


def test_web_pages_to_search(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    queries = spark.createDataFrame([(1, "trains run on rails."), (2, "red fruit. apples are")], "query_id long, text string")
    found = jobs.search_web(pages, queries, str(tmp_path / "store"), k=1).orderBy("query_id").collect()
    assert [r["source"] for r in found] == ["https://h/b", "https://h/a"]
    assert found[1]["chunk_id"] == "page_0.md_0" and found[0]["content"] == "# Trains\n\nTrains run on rails."
    documents = {r["filename"]: r["content"] for r in jobs.web_documents(pages).collect()}
    assert set(documents) == {"page_0.md", "page_1.md"}
    with pytest.raises(ValueError):
        jobs.build_web_store(pages.filter("page_id = 2"), str(tmp_path / "none"))


def test_many_equal_vectors_are_cut_before_they_are_taken(spark):
    store = spark.range(10_000).select(F.col("id").alias("chunk_id"), F.lit("s").alias("source"), F.lit("text " * 50).alias("content"), F.array(F.lit(0.0).cast("float"), F.lit(1.0).cast("float")).alias("embedding"))
    queries = spark.range(50).select(F.col("id").alias("query_id"), F.array(F.lit(1.0).cast("float"), F.lit(0.0).cast("float")).alias("embedding"))
    found = nearest(store, queries, 4)
    rows = found.orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["chunk_id"]) for r in rows] == [(q, k + 1, k) for q in range(50) for k in range(4)]
    assert rows[0]["content"] == "text " * 50


def test_many_queries_repeat_the_store_for_few_blocks(spark, monkeypatch):
    """The store is repeated once a block, so blocks are as large as a cell of the store."""
    seen = []

    def counted(store, queries, k, id_column, vector, schema, blocks, cell_rows):
        seen.append(blocks)
        return spark.createDataFrame([], schema)

    monkeypatch.setattr(vector_search, "_search_blocks", counted)
    rows = spark.range(30_000).select(F.col("id").alias("query_id"), F.array(F.lit(1.0).cast("float")).alias("embedding"))
    vector_search.nearest(rows.select(F.col("query_id").alias("chunk_id"), "embedding"), rows, 2)
    assert seen[0] <= max(30_000 // vector_search.CELL_ROWS + 1, 4)


@pytest.mark.parametrize("scale", [1e-12, 1.0, 1e6, 1e14, 1e20])
def test_rough_distances_leave_no_near_row_out(scale):
    """Single or double precision, bounds over stretches, limits given before: the rows are those of a full sort."""
    rng = np.random.default_rng(11)
    rows = rng.standard_normal((1500, 9)) * scale
    rows[700:1000] = rows[:300] * (1 + 1e-7)  # closer than single precision tells apart
    rows[1000:1100] = rows[7]
    queries = np.vstack([rows[:40], rng.standard_normal((10, 9)) * scale, np.full((1, 9), np.nan)])
    with np.errstate(invalid="ignore"):
        full = np.round(((queries[:, None, :] - rows[None]) ** 2).sum(2), vector_search.DECIMALS)
    want = [(q, r, full[q, r]) for q in range(50) for r in np.lexsort((np.arange(len(rows)), full[q]))[:5].tolist()]
    table = pa.table({"id": np.arange(len(rows)), "v": pa.array(rows.tolist(), pa.list_(pa.float64()))})
    for limit in (None, np.sort(full, axis=1)[:, 4], np.full(51, full[:50].max())):
        for chunk in (5000, 400, 4):
            found = vector_search._scored(iter(table.to_batches(max_chunksize=chunk)), queries, 5, "id", "v", limit)
            assert list(zip(found["query_at"].to_pylist(), found["id"].to_pylist(), found["score"].to_pylist(), strict=True)) == want
