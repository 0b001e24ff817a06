"""Secrets in texts, with multipart credentials linked inside scopes.

Strong spans stand alone: assigned secrets, access identifiers and long hex
strings.  Weak candidates are identifiers, unlabelled random strings and
endpoints, each harmless by itself.  An interval join inside a scope (a block
of lines without a blank line, whatever its length) reports a weak candidate
only when its complement is there:

* an identifier next to a strong secret, a random string next to a strong identifier;
* a weak identifier and a random string only if an endpoint is near as well;
* an endpoint next to both an identifier and a secret.

The join searches sorted interval ends, so a scope with many parts costs
n log n and no pair is ever listed.  A scope never leaves its text, so nothing
is shuffled.  Null and empty texts have no spans; texts are read whole;
repeated rows give repeated results.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.arrow_text import slices

KINDS = ("assign", "access", "hex")

# The strong patterns.  Letters of key words match in either case, ASCII only.
_KEYWORDS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"(?:{_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGNED_LENGTH = 12

IDENTIFIER = re.compile(
    r"(?<![A-Za-z0-9])(?:client[_-]?id|access[_-]?key[_-]?id|account(?:[_-]?id)?|user(?:[_-]?name|[_-]?id)?|login)[\"']?[ \t]*[:=][ \t]*[\"']?[A-Za-z0-9._@+-]{3,}",
    re.ASCII | re.IGNORECASE,
)
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
ENDPOINT = re.compile(r"[A-Za-z][A-Za-z0-9+-]{1,20}://[^\s\"'<>]+|(?<![A-Za-z0-9])(?:host|endpoint|server)[\"']?[ \t]*[:=][ \t]*[\"']?[A-Za-z0-9.:/_-]{4,}", re.ASCII | re.IGNORECASE)
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")
MIN_ENTROPY = 3.5

Span = tuple[int, int, int]  # start, kind, end


def strong_spans(text: str) -> list[Span]:
    """Spans of the strong patterns by start and kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGNED_LENGTH]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def looks_random(value: str) -> bool:
    """Mixed upper case, lower case and digits, and close to evenly distributed."""
    if not (re.search("[A-Z]", value) and re.search("[a-z]", value) and re.search("[0-9]", value)):
        return False
    counts = Counter(value)
    return -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values()) >= MIN_ENTROPY


class Parts:
    """Spans of one role, searchable by the interval within which they must lie."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = sorted(spans)
        self.starts = [a for a, _ in self.spans]
        self.ends = sorted(b for _, b in self.spans)

    def within(self, low: int, high: int, beside: tuple[int, int]) -> bool:
        """Whether a span other than ``beside`` touches ``low .. high``."""
        touching = bisect_left(self.starts, high) - bisect_right(self.ends, low)
        return touching > (beside in self.spans[bisect_left(self.starts, beside[0]) : bisect_right(self.starts, beside[0])])


def linked_spans(text: str, strong: list[Span]) -> list[tuple[str, int, int]]:
    """Weak candidates whose complement lies in the same scope."""
    weak_ids = [m.span() for m in IDENTIFIER.finditer(text)]
    endpoints = [m.span() for m in ENDPOINT.finditer(text)]
    taken = Parts([(a, b) for a, _, b in strong] + endpoints)
    free = lambda a, b: not taken.within(a, b, (-1, -1))
    weak_secrets = [m.span() for m in RANDOM.finditer(text) if looks_random(m.group()) and free(*m.span())]
    weak_ids = [x for x in weak_ids if free(*x)]
    if not (weak_ids or weak_secrets or endpoints):
        return []
    strong_ids = Parts([(a, b) for a, kind, b in strong if kind == 1])
    strong_secrets = Parts([(a, b) for a, kind, b in strong if kind != 1])
    ids, secrets, places = Parts(weak_ids), Parts(weak_secrets), Parts(endpoints)
    breaks = [m.end() for m in BLANK_LINE.finditer(text)]

    def scope(a: int, b: int) -> tuple[int, int]:
        k = bisect_right(breaks, a)
        low, high = (breaks[k - 1] if k else 0), (breaks[k] if k < len(breaks) else len(text) + 1)
        return low, high

    found = []
    for span in weak_ids:
        near = (*scope(*span), span)
        if strong_secrets.within(*near) or secrets.within(*near) and places.within(*near):
            found.append(("identifier", *span))
    for span in weak_secrets:
        near = (*scope(*span), span)
        if strong_ids.within(*near) or ids.within(*near) and places.within(*near):
            found.append(("random", *span))
    for span in endpoints:
        near = (*scope(*span), span)
        if (ids.within(*near) or strong_ids.within(*near)) and (secrets.within(*near) or strong_secrets.within(*near)):
            found.append(("endpoint", *span))
    return found


SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("value", T.StringType())])
)
LINKED = ("identifier", "random", "endpoint")


def find_secrets(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with all spans of ``text`` by start and kind; a column named ``out`` is replaced."""
    source = docs.drop(out)
    schema = T.StructType([*source.schema.fields, T.StructField(out, SPANS)])
    kind_of = {name: k for k, name in enumerate((*KINDS, *LINKED))}
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            rows = []
            for value in batch.column(text).to_pylist():
                value = value or ""
                strong = strong_spans(value)
                spans = [(KINDS[kind], a, b) for a, kind, b in strong] + linked_spans(value, strong)
                spans.sort(key=lambda s: (s[1], kind_of[s[0]]))
                rows.append([{"kind": k, "start": a, "end": b, "value": value[a:b]} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, arrow)], names=[*batch.schema.names, out])

    return source.mapInArrow(scan, schema)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def secret_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per text the counts of strong spans, the hash of their positions, and all spans as text."""
    found = find_secrets(docs.select(F.col(key), F.col(text)), text).drop(text)
    base = F.filter("secrets", lambda s: s["kind"].isin(*KINDS))
    kinds = F.col("secrets.kind")
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, name))).cast("long").alias(f"n_{name}") for name in KINDS]
    return found.select(key, *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
