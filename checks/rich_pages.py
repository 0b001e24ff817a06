"""Web pages made from order rows, with every block tag, and the blocks they must give.

Both are lists of texts and of pairs of a Spark and a DuckDB expression, so the
expected blocks come from how a page was made, not from another parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .notes import CUSTOMER, ISO_DATE, KEY, PRICE, STATUS

HTML = [
    "<html><head><title>t</title><style>p{}</style></head><body><nav><p>menu</p></nav><header><h1>site</h1></header><h2>Order ", KEY,
    "</h2><h3>Part &amp; ", STATUS, "</h3><h4>", ISO_DATE, "</h4><ul><li>Total <b>", PRICE, "</b></li><li><p>in ", KEY,
    '</p> tail</li></ul><pre>code <code>x = ', KEY, '</code> end</pre><script>var a="</p>";</script><div><p>first ', CUSTOMER,
    "<p>second &eacute;</div><code>f(", KEY, ")</code><p> </p></span><footer>f</footer></body></html>",
]
BLOCKS = [
    ("h2", ["Order ", KEY]), ("h3", ["Part & ", STATUS]), ("h4", [ISO_DATE]), ("li", ["Total", PRICE]), ("li", ["in ", KEY, "tail"]),
    ("p", ["in ", KEY]), ("pre", ["codex = ", KEY, "end"]), ("code", ["x = ", KEY]), ("p", ["first ", CUSTOMER, "second é"]),
    ("p", ["second é"]), ("code", ["f(", KEY, ")"]),
]
LINES = {"h2": ("\n## ", "\n"), "h3": ("\n### ", "\n"), "h4": ("\n#### ", "\n"), "li": ("- ", ""), "p": ("", ""), "pre": ("\n```\n", "\n```\n"), "code": ("\n```\n", "\n```\n")}
URL = ["https://shop.example.org/order/", KEY]


def spark_text(parts: list) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.expr(p[0]) for p in parts])


def duck_text(parts: list) -> str:
    return " || ".join("'" + p.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" if isinstance(p, str) else p[1] for p in parts)


def rich_pages(orders: DataFrame) -> DataFrame:
    """``(page_id, url, html, error)``; some pages have no body, some a recorded error."""
    key = F.col("o_orderkey")
    return orders.select(
        key.alias("page_id"), spark_text(URL).alias("url"), F.when(key % 5 != 0, spark_text(HTML)).alias("html"), F.when(key % 7 == 0, "timeout").alias("error")
    )


def duck_blocks() -> str:
    items = ", ".join(f"{{'position': {k}, 'tag': '{tag}', 'text': {duck_text(parts)}}}" for k, (tag, parts) in enumerate(BLOCKS))
    return f"select page_id, b.position, b.tag, b.text from (select o_orderkey as page_id, unnest([{items}]) as b from orders where o_orderkey % 5 <> 0)"


def duck_markdown() -> str:
    lines: list = []
    for k, (tag, parts) in enumerate(BLOCKS):
        lines += [("\n" if k else "") + LINES[tag][0], *parts, LINES[tag][1]]
    return duck_text(lines)
