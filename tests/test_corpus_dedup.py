"""Paragraphs repeated across a corpus, with repeated and null ids."""

from tidemill.operators.corpus_dedup import dedup_corpus


def test_texts_under_one_id_stay_apart(spark):
    rows = [(1, "a\n\nb"), (2, "a\n\nc"), (2, "d\n\nb"), (None, "c\n\ne"), (3, "e"), (3, "e"), (4, None)]
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in dedup_corpus(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    # 2 "a\\n\\nc" keeps c; 2 "d\\n\\nb" keeps d (b is 1's); the null id comes last and loses c, keeps nothing of e (3's)
    want = sorted([(1, "a\n\nb"), (2, "c"), (2, "d"), (-1, ""), (3, "e"), (3, "e"), (4, None)])
    assert got == want


def test_first_places_travel_without_their_paragraphs(spark):
    df = spark.createDataFrame([("a", "x\n\ny"), ("b", "Y\n\nz")], "doc_id string, text string")
    plan = dedup_corpus(df)._jdf.queryExecution().executedPlan().toString()
    firsts = [line for line in plan.splitlines() if "partial_min(" in line]
    assert firsts and not any("part, part#" in line for line in firsts)
