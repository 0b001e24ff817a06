"""The registered queries and the pipeline on the smallest tables."""

import os

import brute
import duckdb
import pytest
from pyspark.sql import functions as F
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import canonical
from tidemill.llm import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    got, want = queries.QUERIES[name](spark, SF_DIR).toPandas(), connection.execute(queries.ORACLE_SQL[name]).df()
    assert len(got) and canonical(got).equals(canonical(want))


def test_queries_on_documents_equal_brute_force(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    want = brute.near_duplicates(list(texts.items()), 3, 85)
    got = queries.op10_minhash_near_dedup(spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == want
    for r in queries.op2_personal_data(spark, SF_DIR).collect():
        assert r["base_sha256"] == brute.sha(brute.personal_data(texts[r["doc_id"]]))
    for r in queries.op3_secret_scan(spark, SF_DIR).collect():
        assert r["base_sha256"] == brute.sha(brute.secrets(texts[r["doc_id"]]))
    few = [(i, t) for i, t in texts.items() if len(t) < 1500]
    assert len(few) > 50
    from tidemill.llm.repeated_spans import remove_repeats

    frame = spark.createDataFrame(few, "doc_id long, text string")
    assert sorted(map(tuple, remove_repeats(frame).drop("kept").collect())) == sorted(brute.remove_repeats(few, 400))


def test_language_accuracy_on_held_out_rows(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = [r for r in queries.op1_language_id(spark, SF_DIR).collect() if r["held_out"]]
    assert len(rows) > 40
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in rows) >= 0.9 * len(rows)


def test_pipeline_stage_by_stage(spark, documents, tmp_path):
    """Each stage is held against its own input."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    extra = spark.createDataFrame(
        [(10_000, "12345 !!", "en", "src1", 8), (10_001, None, None, None, None), (None, "no id here at all", "en", "src1", 17), (10_002, "again and again", "en", "src2", 15), (10_002, "again and again", "en", "src2", 15)],
        documents.schema,
    )
    docs, kept = documents.union(extra), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name != "encode":
            assert docs.columns == documents.columns
    ids = {name: {r["doc_id"] for r in rows} for name, rows in kept.items()}
    assert not {10_000, 10_001} & ids["language"] and len(ids["language"]) >= 0.97 * documents.count()
    sound = [(r["doc_id"], r["text"]) for r in kept["language"] if r["doc_id"] is not None]
    component = brute.near_duplicates(sound, 5, 80)
    assert ids["near_dedup"] - {None} == {i for i, (_, _, first) in component.items() if first}
    assert len(kept["near_dedup"]) == len(ids["near_dedup"])
    before = {r["doc_id"]: r["text"] for r in kept["near_dedup"]}
    for r in kept["personal_data"]:
        assert not brute.personal_data(r["text"]) and r["n_chars"] == len(r["text"])
        assert brute.personal_data(before[r["doc_id"]]) or r["text"] == before[r["doc_id"]]
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert 0.75 * words(kept["personal_data"]) <= words(kept["mix"]) <= 0.91 * words(kept["personal_data"])
    assert len(kept["mix"]) == len(ids["mix"])
    for r in kept["encode"]:
        assert r["token_ids"] == library.encode(r["text"], add_special_tokens=False).ids and r["decodes"]


CLASHING = ["lang_pred", "lang_score", "decoded", "_id", "_kept", "_nth", "_hash", "_n", "_leaf", "_epoch", "_epochs", "rest", "whole", "cut", "_plain", "personal_data", "_carried"]


def test_stages_carry_clashing_columns(spark, documents):
    """Every stage leaves the caller's other columns as they were, whatever their names."""
    docs = documents.where("doc_id < 300")
    extras = docs.select("*", *[(F.col("doc_id") * (k + 1)).cast("string").alias(name) for k, name in enumerate(CLASHING)])
    for name, stage in corpus_pipeline.STAGES:
        plain = sorted(map(tuple, stage(spark, docs, SF_DIR).collect()), key=repr)
        got = stage(spark, extras, SF_DIR)
        assert got.columns[: len(extras.columns)] == extras.columns, name
        rows = got.collect()
        for r in rows:
            assert all(r[c] == str(r["doc_id"] * (k + 1)) for k, c in enumerate(CLASHING)), name
        assert sorted((tuple(v for k, v in r.asDict().items() if k not in CLASHING) for r in rows), key=repr) == plain, name
    with pytest.raises(ValueError):
        corpus_pipeline.encode(spark, docs.withColumn("token_ids", F.lit(1)), SF_DIR)
