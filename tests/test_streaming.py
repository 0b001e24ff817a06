import uuid

from tidemill.streaming.text_files import clean_text_stream, read_text_stream


def test_files_are_cleaned_once_as_they_land(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.txt").write_text("x  <b>y</b>\n\nX Y")
    name = uuid.uuid4().hex  # the shared folder may outlive the test

    def run():
        clean_text_stream(read_text_stream(spark, str(source)), target, name).awaitTermination(60)
        return {(r["filename"], r["content"]) for r in spark.read.parquet(target).collect()}

    assert run() == {("a.txt", "x y")}
    (source / "b.md").write_text("second")
    assert run() == {("a.txt", "x y"), ("b.md", "second")}
    assert spark.read.parquet(target).count() == 2
