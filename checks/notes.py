"""Order notes: texts made from order rows, with every feature the text operators treat.

The same parts build the Spark column and the DuckDB expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY = ("cast(o_orderkey as string)", "cast(o_orderkey as varchar)")
CUSTOMER = ("cast(o_custkey as string)", "cast(o_custkey as varchar)")
PRICE = ("cast(o_totalprice as string)", "cast(o_totalprice as varchar)")
FOUR_DIGITS = ("lpad(cast(o_orderkey as string), 4, '0')", "lpad(cast(o_orderkey as varchar), 4, '0')")
ISO_DATE = ("date_format(o_orderdate, 'yyyy-MM-dd')", "strftime(o_orderdate, '%Y-%m-%d')")
US_DATE = ("date_format(o_orderdate, 'M/d/yyyy')", "strftime(o_orderdate, '%-m/%-d/%Y')")
MONTH_FIRST = ("date_format(o_orderdate, 'MMM d, yyyy')", "strftime(o_orderdate, '%b %-d, %Y')")
DAY_FIRST = ("date_format(o_orderdate, 'd MMMM yyyy')", "strftime(o_orderdate, '%-d %B %Y')")
STATUS = ("o_orderstatus", "o_orderstatus")
PRIORITY = ("o_orderpriority", "o_orderpriority")

NOTE: list[str | tuple[str, str]] = [
    "Skip to main content\n# \n\n\n<p>Order: ", KEY, "</p>  \n\n\n\n## Details <b>of ", KEY,
    "</b>\t \n===========\nWe use cookies to improve ", STATUS, "\nDate = ", ISO_DATE, "   \n  Placed on ",
    MONTH_FIRST, " or ", US_DATE, ", also ", DAY_FIRST, "\nTotal: $", PRICE, " and €", CUSTOMER,
    ",000.50, £", FOUR_DIGITS, ".5\n", CUSTOMER, ",250.75 USD again ", CUSTOMER, " INR, $ and $", CUSTOMER,
    " USD\nContact - clerk.", CUSTOMER, "@mail.example.org, (415) 555-", FOUR_DIGITS, ", +44-207-946-",
    FOUR_DIGITS, " or a@b.co1@c.de\nSee https://example.org/o/", KEY, "?c=", CUSTOMER,
    "&x=%20 or http://h.example.com/~", CUSTOMER, ".\nStatus: ", STATUS, "\nStatus: ", PRIORITY, "\n: odd: ",
    KEY, "\nk:\nA key that is much too long to be taken as the key of a pair, so it is refused: ", KEY,
    "\n\n\n\n\n### The “quoted” ‘part’…\n\nSame paragraph – ", STATUS, "\n\n  same PARAGRAPH – ", STATUS,
    " \n\n\n\nMary Ann Jones left. John Smith stayed. New York City slept! The Big House\n\nSame paragraph – ",
    STATUS, "\x07\x1f\n-----\nTable of contents\nJump to the end",
]


def spark_note() -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.expr(p[0]) for p in NOTE])


def duck_note() -> str:
    return " || ".join("'" + p.replace("'", "''") + "'" if isinstance(p, str) else p[1] for p in NOTE)
