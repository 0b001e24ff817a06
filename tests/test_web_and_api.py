import json

import pytest
from pyspark.sql import functions as F

from tidemill.functions.html import blocks_of, html_to_markdown
from tidemill.functions.urls import page_url, url_filename
from tidemill.operators import api_records, crawl, documents
from tidemill.operators.lookup import join_per_key
from tidemill.plans import jobs
from tidemill.sources import sinks, texts


def pairs(html, **options):
    return [(b["tag"], b["text"]) for b in blocks_of(html, **options)]


def test_blocks():
    assert pairs("<pre> a <code>b</code> c</pre>") == [("pre", "abc"), ("code", "b")]
    assert pairs("<li><p>x</p> y</li>") == [("li", "xy"), ("p", "x")]
    assert pairs("<p>a <b> bold </b> z</p>") == [("p", "aboldz")]
    assert pairs('<script>var t="</p>";</script><p>&amp; &eacute;</p>') == [("p", "& é")]
    assert pairs("<p>one<p>two</div>") == [("p", "onetwo"), ("p", "two")]
    assert pairs("<p>one<p>two", close_open_p=True) == [("p", "one"), ("p", "two")]
    assert pairs("<h1>1</h1><h2>2</h2><h3>3</h3><h4>4</h4><h5>5</h5><p> </p>") == [
        ("h1", "1"), ("h2", "2"), ("h3", "3"), ("h4", "4")
    ]
    assert pairs("<nav><p>menu</p></nav><footer>f</footer><header><h1>t</h1></header><p>x<style>p{}</style></p>") == [("p", "x")]
    assert pairs("<p>a<!-- c --> b</p><p>a<br>b</p><p/>tail") == [("p", "ab"), ("p", "ab")]
    assert pairs("<div><p>in</div>out</p><p>last") == [("p", "in"), ("p", "last")]
    assert pairs("") == [] and pairs("<p") == []


def test_markdown(apply):
    html = "<h1>T</h1><h2>U</h2><h3>V</h3><h4>W</h4><p>x</p><ul><li>i</li></ul><pre>c</pre>"
    want = "\n# T\n\n\n## U\n\n\n### V\n\n\n#### W\n\nx\n- i\n\n```\nc\n```\n"
    assert apply(html_to_markdown, html, None, "") == [want, None, ""]


def test_file_names(apply):
    cases = {
        "https://a.b.com/x/y/": "a_b_com_x_y.md", "http://u:p@h.io:80/": "u:p@h_io:80_index.md", "https://h": "h_index.md",
        "https://h/a_b/c?q=1#f": "h_a_b_c.md", "https://h/a/b_c": "h_a_b_c.md", "no/scheme": "_no_scheme.md",
        "https://h/a;v=1": "h_a.md", "https://h/a;v=1/b": "h_a;v=1_b.md",
    }
    assert apply(url_filename, *cases) == list(cases.values())


def test_manifest(spark):
    rows = [(1, "https://h/a_b/c", "<p>x</p>"), (2, "https://h/a/b_c", None), (3, "https://h/a_b/c", "<p>xyz</p>"), (4, "https://h/a/b_c", "")]
    files = crawl.page_files(spark.createDataFrame(rows, "page_id long, url string, html string"), keep=["page_id"])
    manifest = crawl.page_manifest(files, keep=["page_id"])
    failed = manifest.filter("page_id = 2").first()
    assert (failed["status"], failed["error"], failed["chars"], failed["file"]) == ("error", "no body", None, None)
    last = {r["url"]: (r["page_id"], r["status"], r["chars"]) for r in crawl.last_per_url(manifest, F.col("page_id")).collect()}
    assert last == {"https://h/a_b/c": (3, "success", 3), "https://h/a/b_c": (4, "success", 0)}
    assert [tuple(r) for r in crawl.file_collisions(manifest).collect()] == [("h_a_b_c.md", 2)]


API = [
    ("list", 1, '[{"a":1},{"a":2}]'), ("list", 2, "[]"), ("list", 3, '[{"a":3}]'),
    ("envelope", 1, '{"results":[{"a":1}]}'), ("envelope", 2, '{"items":[{"a":2}]}'), ("envelope", 3, '{"data":[{"b":3}]}'),
    ("null", 1, '{"results":null,"data":[1]}'), ("empty", 1, '{"results":[],"data":[1]}'),
    ("text", 1, '"text"'), ("bad", 1, '[{"a":1}]'), ("bad", 2, "{oops"), ("bad", 3, '[{"a":1}]'),
    ("gap", 1, '[{"a":1}]'), ("gap", 3, '[{"a":3}]'), ("late", 2, '[{"a":1}]'),
    *[("long", p, '[{"a":%d}]' % p) for p in range(1, 15)],
]


@pytest.fixture(scope="module")
def landed(spark):
    return spark.createDataFrame(API, "endpoint string, page int, body string")


def test_pages_stop_at_the_first_empty_one(landed):
    got = {}
    for r in api_records.pages_until_empty(landed).collect():
        got.setdefault(r["endpoint"], []).append(r["page"])
    assert {k: sorted(v) for k, v in got.items()} == {
        "list": [1], "envelope": [1, 2, 3], "bad": [1], "gap": [1], "long": list(range(1, 11))
    }
    errors = api_records.unwrap_pages(landed).filter("error is not null").collect()
    assert [(r["endpoint"], r["page"]) for r in errors] == [("bad", 2)]


def test_records_and_fields(landed):
    rows = api_records.project_fields(
        api_records.records(landed).filter("endpoint = 'envelope'").orderBy("page"), {"a": "bigint", "b": "string", "x.y": "string"}
    )
    assert [tuple(r) for r in rows.collect()] == [(1, None, None), (2, None, None), (None, "3", None)]
    assert api_records.project_fields(api_records.records(landed), None).columns == ["record"]


def test_lookup_join_gives_the_same_rows_beyond_the_broadcast_bound(spark):
    large = spark.range(1000).select(F.lit("hot").alias("k"), "id").unionAll(spark.range(5).select(F.lit("cold"), "id"))
    per_key = spark.createDataFrame([("hot", 1), ("other", 2)], "k string, v int")
    by_broadcast = join_per_key(large, per_key, "k", F.col("id"))
    salted = join_per_key(large, per_key, "k", F.col("id"), broadcast_bytes=0, salts=7)
    assert sorted(map(tuple, salted.select("k", "id", "v").collect())) == sorted(
        map(tuple, by_broadcast.select("k", "id", "v").collect())
    )
    assert salted.count() == 1000


def test_request_addresses(spark):
    df = spark.createDataFrame([("http://h/x",), ("http://h/x?k=1",)], "endpoint string")
    got = [r["url"] for r in api_records.request_plan(df, 2).orderBy("endpoint", "page").collect()]
    assert got == [
        "http://h/x?page=1&per_page=30", "http://h/x?page=2&per_page=30",
        "http://h/x?k=1&page=1&per_page=30", "http://h/x?k=1&page=2&per_page=30",
    ]
    one = df.limit(1).select(page_url(F.col("endpoint"), F.lit(3), "p", "size", 5).alias("u")).first()["u"]
    assert one == "http://h/x?p=3&size=5"


def test_api_job_writes_json_lines(spark, landed, tmp_path):
    jobs.api_to_dataset(landed, str(tmp_path / "out"), {"a": "bigint", "b": "string"})
    lines = [json.loads(l) for f in (tmp_path / "out").glob("part-*") for l in f.read_text().splitlines()]
    assert len(lines) == 2 + 3 + 1 + 1 + 10 and {"a": None, "b": "3"} in lines


def test_json_array(spark, tmp_path):
    df = spark.range(100).select("id", F.when(F.col("id") > 5, "é").alias("v")).repartition(7)
    sinks.save_records(df, str(tmp_path / "array"), "json", order_by="id")
    whole = "".join(f.read_text() for f in sorted((tmp_path / "array").glob("part-*")))
    records = json.loads(whole)
    assert [r["id"] for r in records] == list(range(100)) and records[0] == {"id": 0, "v": None}
    sinks.save_records(df.limit(0), str(tmp_path / "none"), "json", order_by="id")
    assert json.loads("".join(f.read_text() for f in (tmp_path / "none").glob("part-*"))) == []
    with pytest.raises(ValueError):
        sinks.save_records(df, str(tmp_path / "x"), "xml")
    with pytest.raises(ValueError):
        sinks.save_records(df.withColumn("id", F.lit(1)), str(tmp_path / "y"), "json", order_by="id")


PAGES = [
    ("a", 1, " first "), ("a", 2, " \n"), ("a", 3, "has --- Page 9 --- inside"), ("b", 1, None), ("c", 2, "x"),
]


def test_paged_documents(spark):
    pages = spark.createDataFrame(PAGES, "source string, page_no int, text string").repartition(3)
    a = "--- Page 1 ---\nfirst\n\n--- Page 3 ---\nhas --- Page 9 --- inside"
    c = "--- Page 2 ---\nx"
    got = {r["source"]: r for r in documents.assemble_documents(pages, "own").collect()}
    assert set(got) == {"a", "c"} and got["a"]["text"] == a and got["c"]["text"] == c
    assert (got["a"]["pages"], got["a"]["chars"], got["a"]["extractor"]) == (2, len(a), "own")
    assert tuple(documents.document_totals(pages).first()) == (2, 3, len(a + "\n\n" + c))
    parts = documents.assemble_documents(pages, pages_per_part=1).filter("source = 'a'").orderBy("part").collect()
    assert "\n\n".join(p["text"] for p in parts) == a and [p["part"] for p in parts] == [0, 2]
    assert tuple(documents.document_totals(pages.limit(0)).first()) == (0, 0, 0)


def test_document_folder(spark, tmp_path):
    (tmp_path / "b.pdf").write_bytes(b"one|two")
    (tmp_path / "a.pdf").write_bytes(b"broken")
    (tmp_path / "c.txt").write_bytes(b"ignored")
    (tmp_path / "sub").mkdir()

    def decode(content):
        if b"|" not in content:
            raise ValueError("no pages")
        return content.decode().split("|")

    rows = texts.read_document_pages(spark, str(tmp_path), decode).orderBy("source", "page_no").collect()
    assert [(r["source"][-5:], r["page_no"], r["text"], r["error"]) for r in rows] == [
        ("a.pdf", None, None, "no pages"), ("b.pdf", 1, "one", None), ("b.pdf", 2, "two", None)
    ]


def test_text_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.md").write_text("# A\nb")
    (tmp_path / "b.txt").write_bytes(b"x\xffy")
    (tmp_path / "sub" / "c.text").write_text("deep")
    (tmp_path / "d.csv").write_text("no")
    (tmp_path / "e.txt").write_text(" \n ")
    got = {r["filename"]: r["content"] for r in texts.read_text_files(spark, str(tmp_path)).collect()}
    assert got == {"a.md": "# A\nb", "b.txt": "xy", "c.text": "deep"}


def test_combined_text(spark, tmp_path):
    df = spark.createDataFrame([("b", "two\nlines"), ("a", "one")], "source string, text string")
    sinks.write_texts(df, str(tmp_path / "t"), order_by=["source"])
    whole = "".join(f.read_text() for f in sorted((tmp_path / "t").glob("part-*")))
    assert whole == "one\n\ntwo\nlines\n\n"
