import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemill.functions.blank import is_blank, strip, to_number
from tidemill.operators import profile
from tidemill.operators.aggregate import group_aggregate
from tidemill.operators.table_cleaning import TableCleaning, clean_table, cleaning_report, rename
from tidemill.plans.jobs import csv_job
from tidemill.sources.csv import read_csv, write_csv

HEADER = ["keeper", "section", "hours", "site", "since"]
STAFF = [
    ("Ada Quill", "Foundry", "41", "Harbour", "2019-02-11"),
    ("Ben Oakes", "Archive", "37", "Hillside", "2020-05-03"),
    ("Cleo Marsh", "Foundry", "52", "Harbour", "2018-09-27"),
    ("Dov Lind", "Archive", "33", "Hillside", "2022-12-01"),
    ("Ada Quill", "Foundry", "41", "Harbour", "2019-02-11"),
    ("Eve Thorn", "Garden", "", "Lakeside", "2021-07-19"),
    ("Finn Gray", "Foundry", "45", "", "2020-01-08"),
    ("Gil Stone", "Garden", "29", "Lakeside", "2023-04-14"),
    ("Hana Reed", "Archive", "38", "Hillside", ""),
    ("Ivo Birch", "Foundry", "58", "Harbour", "2017-06-30"),
]
CLEANING = TableCleaning(fill_nulls={"site": "Unknown", "since": "N/A"})


@pytest.fixture(scope="module")
def staff(spark):
    rows = [(i, *r) for i, r in enumerate(STAFF)]
    return spark.createDataFrame(rows, "row long, " + ", ".join(f"{h} string" for h in HEADER))


def test_cleaned_staff(staff):
    cleaned = clean_table(staff.drop("row"), CLEANING)
    rows = {tuple(r) for r in cleaned.collect()}
    assert cleaned.count() == 9 == len(rows)
    assert ("Finn Gray", "Foundry", "45", "Unknown", "2020-01-08") in rows
    assert ("Hana Reed", "Archive", "38", "Hillside", "N/A") in rows
    report = {(r["change"], r["target"]): r["n"] for r in cleaning_report(staff.drop("row"), CLEANING).collect()}
    assert report == {("rows_removed", ""): 1, ("cells_filled", "site"): 1, ("cells_filled", "since"): 1}
    assert clean_table(cleaned, CLEANING).count() == 9


def test_mean_hours(staff):
    rows = group_aggregate(clean_table(staff.drop("row"), CLEANING), "section", "hours", "mean").collect()
    assert [tuple(r) for r in rows] == [("Archive", 36.0, 3), ("Foundry", 49.0, 4), ("Garden", 29.0, 1)]


@pytest.mark.parametrize("partitions", [1, 8])
def test_staff_profile(staff, partitions):
    shuffled = staff.repartition(partitions, "hours")
    p = {r["column"]: r for r in profile.profile_table(shuffled, F.col("row"), HEADER).collect()}
    hours = p["hours"]
    assert (hours["total_rows"], hours["non_null"], hours["null_count"], hours["null_pct"]) == (10, 9, 1, 10.0)
    assert (hours["unique_count"], hours["type"], hours["min"], hours["max"]) == (8, "numeric", 29.0, 58.0)
    assert (hours["mean"], hours["median"], hours["stdev"]) == (41.56, 41.0, 9.06)
    assert hours["top_5"] is None and hours["sample"] is None
    section = p["section"]
    assert section["type"] == "categorical" and section["mean"] is None
    assert [tuple(t) for t in section["top_5"]] == [("Foundry", 5), ("Archive", 3), ("Garden", 2)]
    assert section["sample"] == ["Foundry", "Archive", "Foundry"]
    keepers = [t["value"] for t in p["keeper"]["top_5"]]
    assert keepers == ["Ada Quill", "Ben Oakes", "Cleo Marsh", "Dov Lind", "Eve Thorn"]


def test_profile_of_blank_and_half_numeric_columns(spark):
    rows = [(1, "1", "1", " "), (2, "2", "x", None), (3, "x", "2", ""), (4, "y", "3", " ")]
    df = spark.createDataFrame(rows, "row long, half string, more string, blank string")
    p = {r["column"]: r for r in profile.profile_table(df, F.col("row"), ["half", "more", "blank"]).collect()}
    assert p["half"]["type"] == "categorical" and p["more"]["type"] == "numeric"
    assert p["blank"]["non_null"] == 0 and p["blank"]["null_pct"] == 100.0
    assert p["blank"]["top_5"] == [] and p["blank"]["sample"] == []


def _medians(spark, columns):
    rows = [(i, name, repr(v)) for name, values in columns.items() for i, v in enumerate(values)]
    cells = spark.createDataFrame(rows, "row long, column string, value string")
    counts = (
        cells.groupBy("column", "value")
        .agg(F.count("*").alias("n"), F.min("row").alias("first_seen"))
        .withColumn("num", to_number(F.col("value")))
    )
    return counts, profile.completeness(counts)


def test_median_by_narrowing_is_exact(spark):
    rng = random.Random(7)
    columns = {
        "spread": [rng.uniform(-1e6, 1e6) for _ in range(3001)],
        "scales": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(2000)],
        "hot": [5.0] * 1500 + [rng.gauss(0, 1e-200) for _ in range(1501)],
        "tight": [1 + i * 2.0**-52 for i in range(1000)],
        "one": [3.25],
        "zeros": [0.0, -0.0, 0.0, 1.0],
    }
    counts, base = _medians(spark, columns)
    for direct in (0, 1 << 18):
        got = {r["column"]: r["median"] for r in profile.median(counts, base, direct).collect()}
        for name, values in columns.items():
            assert got[name] == statistics.median(values), (name, direct)


def test_numbers(spark):
    texts = ["1,000", "1_000", " 5 ", "1e5", "+5", "NaN", "inf", "1.0d", "0x1p3", " ", None, "abc", "1__0", "-.5"]
    df = spark.createDataFrame([(t,) for t in texts], "v string").select(to_number(F.col("v")))
    got = [r[0] for r in df.collect()]
    assert str(got[5]) == "nan"
    got[5] = None
    assert got == [None, 1000.0, 5.0, 1e5, 5.0, None, float("inf"), None, None, None, None, None, None, -0.5]


def test_blanks(apply):
    texts = [None, "", "  ", "\t", " ", "\x1c", "x "]
    assert apply(is_blank, *texts) == [True] * 6 + [False]
    assert apply(strip, *texts) == [None, "", "", "", "", "", "x"]


def test_configuration_errors(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    with pytest.raises(ValueError):
        rename(df, {"a": "b"})
    assert rename(df, {"a": "b", "b": "a", "zz": "q"}).columns == ["b", "a"]
    with pytest.raises(ValueError):
        group_aggregate(df, "a", "b", "mode")
    cleaned = clean_table(df, TableCleaning(fill_nulls={"new": 7}, drop_columns=["zz", "a"], filter_rows={"b": ["2"]}))
    assert [r.asDict() for r in cleaned.collect()] == [{"b": "2", "new": "7"}]


def test_null_key_groups_as_empty(spark):
    df = spark.createDataFrame([(None, "1"), ("", "2"), ("k", "x"), ("k", None)], "k string, v string")
    assert [tuple(r) for r in group_aggregate(df, "k", "v", "sum").collect()] == [("", 3.0, 2)]


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,note\n"Doe, Jane","said ""hi""\nthen left"\n  padded ,\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("name,note\nplain,x\n", encoding="utf-8")
    df = read_csv(spark, str(tmp_path))
    want = {("Doe, Jane", 'said "hi"\nthen left'), ("  padded ", None), ("plain", "x")}
    assert {tuple(r) for r in df.collect()} == want
    write_csv(df, str(tmp_path / "out"), ["note", "name"])
    back = read_csv(spark, str(tmp_path / "out"), empty_as_null=False)
    assert {tuple(r) for r in back.collect()} == {(b or "", a) for a, b in want}


def read_cells(spark, path, **options):
    return sorted(tuple(r) for r in read_csv(spark, str(path), **options).collect())


def test_csv_breaks_of_every_kind_inside_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'a,b\n"x\ry",1\r\n"p\r\nq",2\n"r\n\ns",3\n\nplain"quote,4\n')
    assert read_cells(spark, tmp_path) == [("p\r\nq", "2"), ('plain"quote', "4"), ("r\n\ns", "3"), ("x\ry", "1")]


def test_csv_columns_by_name_and_long_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a,c\n3,4,5\n6\n")
    df = read_csv(spark, str(tmp_path))
    assert df.columns == ["a", "b", "c"]
    assert sorted(df.collect(), key=str) == sorted([("1", "2", None), ("4", "3", "5"), (None, "6", None)], key=str)
    (tmp_path / "c.csv").write_text("a,b\n7,8,9\n")
    with pytest.raises(Exception, match="3 cells under 2 columns"):
        read_csv(spark, str(tmp_path)).collect()
    kept = read_csv(spark, str(tmp_path), keep_extra=True).filter("a = '7'").first()
    assert kept["_extra_cells"] == ["9"]


@pytest.mark.parametrize("chunk_lines", [1, 3])
def test_csv_splits_give_the_same_rows(spark, tmp_path, monkeypatch, chunk_lines):
    rng = random.Random(chunk_lines)
    cells = ["x", "", "two\nlines", "\n\n\n", 'say ""hi""', "a,b", "c\rd", "long " * 40]
    want = [(str(k), rng.choice(cells), rng.choice(cells)) for k in range(400)]
    text = "id,one,two\n" + "".join(f'{i},"{a}","{b}"\n' for i, a, b in want)
    (tmp_path / "a.csv").write_bytes(text.encode())
    monkeypatch.setattr("tidemill.sources.csv.CHUNK_LINES", chunk_lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = read_cells(spark, tmp_path, empty_as_null=False)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == sorted((i, a.replace('""', '"'), b.replace('""', '"')) for i, a, b in want)


def test_csv_in_latin_1(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("name\nJosé\n".encode("latin-1"))
    assert read_csv(spark, str(tmp_path), encoding="latin-1").first()["name"] == "José"


def test_csv_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [",".join(HEADER)] + [",".join(r) for r in STAFF]
    (tmp_path / "in" / "e.csv").write_text("\n".join(lines), encoding="utf-8")
    profiled, cleaned = csv_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), CLEANING)
    p = {r["column"]: r for r in profiled.collect()}
    assert p["hours"]["median"] == 41.0
    assert p["section"]["sample"] == ["Foundry", "Archive", "Foundry"]
    assert cleaned.count() == 9
