"""CSV tables whose cells are all text.

A file is read in splits even where cells hold line breaks.  Lines end at LF
for the scan and are packed into chunks; a chunk maps the state in which it
starts (inside quotes or not) to the one in which it ends.  Composing these
maps along a file tells every chunk its state, so each parses alone; the few
records that cross chunks are put together from their pieces.  The driver sees
distinct headers, never a list of files or chunks.
"""

from __future__ import annotations

import codecs
import csv
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.lookup import join_per_key

# Quoting by doubled quotes, blanks kept, every cell a string.
FORMAT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Names of encodings in which a quote is one ASCII byte, as Spark calls them.
ASCII_BASED = {"utf-8": "utf-8", "ascii": "us-ascii", "iso8859-1": "iso-8859-1"}
CHUNK_LINES = 4096
EXTRA = "_extra_cells"
LARGEST_CELL = 1 << 30

_QUOTED = re.compile(rb'(?:^|(?<=[,\r\n]))"[^"]*+(?:""[^"]*+)*+("?)')
_REST = re.compile(rb'[^"]*+(?:""[^"]*+)*+("?)')
_BREAK = re.compile(rb"\r\n|\r|\n")


def _charset(encoding: str) -> str:
    name = codecs.lookup(encoding).name
    return ASCII_BASED.get(name, name.replace("-le", "le").replace("-be", "be"))


def record_bounds(text: bytes, inside: bool) -> tuple[int, int, bool]:
    """Where the first record that starts in ``text`` begins, where an unfinished one begins, and whether quotes are open at the end.

    ``inside`` says whether the text starts within quotes.  Without a start,
    the first number is the length of the text.
    """
    at = 0
    if inside:
        rest = _REST.match(text)
        if not rest.group(1):
            return len(text), len(text), True
        at = rest.end()
    first = None if inside else 0
    record = 0
    for quoted in _QUOTED.finditer(text, at):
        breaks = list(_BREAK.finditer(text, at, quoted.start()))
        if breaks:
            first = breaks[0].end() if first is None else first
            record = breaks[-1].end()
        if not quoted.group(1):
            return (len(text) if first is None else first), record, True
        at = quoted.end()
    if first is None:
        found = _BREAK.search(text, at)
        first = found.end() if found else len(text)
    return first, len(text), False


def _chunks(lines: DataFrame) -> DataFrame:
    """``(file, block, chunk, text)``: runs of ``CHUNK_LINES`` lines of each split, in the order of the scan."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, number = None, [], 0

        def out() -> pa.RecordBatch:
            text = b"".join(line + b"\n" for line in held)
            return pa.RecordBatch.from_pydict(
                {"file": [here[0]], "block": pa.array([here[1]], pa.int64()), "chunk": pa.array([number], pa.int32()), "text": pa.array([text], pa.binary())}
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("value", "file", "block"))
            for value, file, block in zip(*columns, strict=True):
                if (file, block) != here or len(held) == CHUNK_LINES:
                    if held:
                        yield out()
                    number = number + 1 if (file, block) == here else 0
                    here, held = (file, block), []
                held.append(value)
        if held:
            yield out()

    return lines.mapInArrow(pack, "file string, block long, chunk int, text binary")


def _header_cells(text: bytes, encoding: str) -> list[str] | None:
    csv.field_size_limit(LARGEST_CELL)
    for cells in csv.reader(io.StringIO(text.decode(encoding).removeprefix("\ufeff"), newline="")):
        if cells:
            return cells
    return None


def _states(chunks: DataFrame, encoding: str) -> DataFrame:
    """``(place, inside, header)`` of every chunk: the state it starts in and the header of its file."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, blocks, numbers = (batch.column(c).to_pylist() for c in ("text", "block", "chunk"))
            plain = [record_bounds(t, False)[2] for t in texts]
            within = [record_bounds(t, True)[2] for t in texts]
            headers = [_header_cells(t, encoding) if b == 0 and n == 0 else None for t, b, n in zip(texts, blocks, numbers, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(plain), pa.array(within), pa.array(headers, pa.list_(pa.string()))], names=["file", "block", "chunk", "plain", "within", "header"]
            )

    maps = chunks.mapInArrow(measure, "file string, block long, chunk int, plain boolean, within boolean, header array<string>")
    per_file = maps.groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct("block", "chunk", "plain", "within"))).alias("maps"), F.first("header", ignorenulls=True).alias("header")
    )
    start = F.struct(F.lit(False).alias("inside"), F.array().cast("array<boolean>").alias("all"))
    states = F.aggregate(
        "maps",
        start,
        lambda s, m: F.struct(F.when(s["inside"], m["within"]).otherwise(m["plain"]).alias("inside"), F.concat(s["all"], F.array(s["inside"])).alias("all")),
        lambda s: s["all"],
    )
    each = per_file.select("file", "header", F.explode(F.arrays_zip("maps", states.alias("inside"))).alias("c"))
    return each.select(_place(F.col("file"), F.col("c.maps.block"), F.col("c.maps.chunk")).alias("place"), F.col("c.inside").alias("inside"), "header")


def _place(file, block, chunk):
    return F.concat_ws("\t", file, block.cast("string"), chunk.cast("string"))


def _pieces(chunks: DataFrame) -> DataFrame:
    """Chunks cut into a stretch of whole records (part 1) and the pieces of records that cross chunks (0: an end, 2: a start)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts, texts = [], [], []
            for row, (text, inside) in enumerate(zip(batch.column("text").to_pylist(), batch.column("inside").to_pylist(), strict=True)):
                first, last, _ = record_bounds(text, inside)
                for part, piece in enumerate((text[:first], text[first:last], text[max(first, last) :])):
                    if piece:
                        rows.append(row)
                        parts.append(part)
                        texts.append(piece)
            kept = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("file", "block", "chunk", "header")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(parts, pa.int32()), pa.array(texts, pa.binary())], names=["file", "block", "chunk", "header", "part", "text"])

    return chunks.select("file", "block", "chunk", "header", "inside", "text").mapInArrow(
        cut, "file string, block long, chunk int, header array<string>, part int, text binary"
    )


def _parsed(pieces: DataFrame, names: list[str], encoding: str, empty_as_null: bool, keep_extra: bool) -> DataFrame:
    """The records of ``pieces(file, header, opens, text)`` under ``names``."""
    schema = ", ".join([f"`{n.replace('`', '``')}` string" for n in names] + [f"`{EXTRA}` array<string>"] * keep_extra)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(LARGEST_CELL)
        for batch in batches:
            columns: dict[str, list] = {n: [] for n in names}
            extra: list = []
            for file, header, opens, text in zip(*(batch.column(c).to_pylist() for c in ("file", "header", "opens", "text")), strict=True):
                rows = (cells for cells in csv.reader(io.StringIO(text.decode(encoding).removeprefix("\ufeff") if opens else text.decode(encoding), newline="")) if cells)
                if opens:
                    next(rows, None)
                place = {n: k for k, n in reversed(list(enumerate(header)))}
                width, wanted = len(header), [place.get(n) for n in names]
                for cells in rows:
                    if len(cells) > width and not keep_extra:
                        raise ValueError(f"{file}: {len(cells)} cells under {width} columns: {cells[:5]}")
                    extra.append(cells[width:] or None)
                    for n, k in zip(names, wanted, strict=True):
                        value = cells[k] if k is not None and k < len(cells) else None
                        columns[n].append(None if value == "" and empty_as_null else "" if value is None and not empty_as_null else value)
            arrays = [pa.array(v, pa.string()) for v in columns.values()] + [pa.array(extra, pa.list_(pa.string()))] * keep_extra
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *[EXTRA] * keep_extra])

    return pieces.select("file", "header", "opens", "text").mapInArrow(parse, schema)


def read_csv(
    spark: SparkSession, path: str, encoding: str = "utf-8", empty_as_null: bool = True, keep_extra: bool = False
) -> DataFrame:
    """Header row, then text cells; an empty or missing cell is NULL, or ``''`` on request.

    Columns are matched by name, whatever their order in each file, and are
    NULL where a file lacks them.  A record with more cells than its header
    raises; with ``keep_extra`` these cells come in ``_extra_cells``.  A header
    must end within its first ``CHUNK_LINES`` lines.  Encodings
    in which a line feed is not one byte are read one file per task.
    """
    charset = _charset(encoding)
    if charset not in ASCII_BASED.values():
        reader = spark.read.options(**FORMAT).option("encoding", charset).option("multiLine", True).option("enforceSchema", False)
        df = reader.csv(path)
        return df if empty_as_null else df.na.fill("")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    chunks = _chunks(lines)
    states = _states(chunks, encoding)
    headers = states.where("header is not null").groupBy("header").agg(F.min("place").alias("at")).orderBy("at").select("header").collect()
    names = list(dict.fromkeys(name for row in headers for name in row["header"]))
    if not names:
        return spark.createDataFrame([], "value string").drop("value")
    known = chunks.withColumn("place", _place(F.col("file"), F.col("block"), F.col("chunk")))
    pieces = _pieces(join_per_key(known, states, "place", F.col("chunk")))
    opens = (F.col("block") == 0) & (F.col("chunk") == 0)
    whole = pieces.where("part = 1").select("file", "header", opens.alias("opens"), "text")
    # A crossing record is a start (2) and the ends (0) that follow it before the next start.
    order = Window.partitionBy("file").orderBy("block", "chunk", "part")
    crossing = pieces.where("part <> 1").withColumn("record", F.sum(F.when(F.col("part") == 2, 1).otherwise(0)).over(order))
    ordered = F.sort_array(F.collect_list(F.struct("block", "chunk", "part", "text")))
    joined = crossing.groupBy("file", "header", "record").agg(ordered.alias("p"))
    glued = joined.select(
        "file", "header", F.lit(False).alias("opens"),
        F.aggregate(F.col("p.text"), F.lit(b""), lambda a, t: F.concat(a, t)).alias("text"),
    )
    return _parsed(whole.unionByName(glued), names, encoding, empty_as_null, keep_extra)


def write_csv(df: DataFrame, path: str, headers: list[str] | None = None, encoding: str = "utf-8") -> None:
    """Header and rows in the given column order, quoted only where needed."""
    out = df.select(*(headers or df.columns)).write.options(**FORMAT).option("encoding", _charset(encoding))
    out.option("emptyValue", "").option("nullValue", "").csv(path)
