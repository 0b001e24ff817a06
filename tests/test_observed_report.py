"""The cleaning report observed on the write of the cleaned table."""

from tidemill.operators import table_cleaning as tc


def test_observed_report_equals_the_counted_one(spark, tmp_path):
    rows = [(1, " a ", None), (1, "a", None), (2, "", "x"), (3, "b", "  "), (3, "b", "  "), (4, None, "y")]
    df = spark.createDataFrame(rows, "id long, name string, note string")
    cleaning = tc.TableCleaning(fill_nulls={"name": "none", "note": "-", "absent": "?"}, drop_columns=["absent"], rename_columns={"note": "remark"})
    entries = tc.clean_and_report(df, str(tmp_path / "out"), cleaning)
    assert sorted(entries) == sorted(map(tuple, tc.cleaning_report(df, cleaning).collect()))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, written.collect()), key=repr) == sorted(map(tuple, tc.clean_table(df, cleaning).collect()), key=repr)
