"""Entities found in a text, as array and map columns."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .batches import text_slices
from .blank import is_ascii, let, strip, words
from .entity_batches import RECORD, records


def _find(c: Column, pattern: str, *needles: str, where: str | None = None) -> Column:
    """All matches of ``pattern``.

    Texts without any needle, or without a match of the simple pattern
    ``where``, skip it.  In ASCII texts the Unicode classes hold nothing more
    than the plain ones, which are faster.
    """
    every = F.lit(True)
    if needles:
        every = F.contains(c, F.lit(needles[0]))
        for needle in needles[1:]:
            every = every | F.contains(c, F.lit(needle))
    if where:
        every = every & F.rlike(c, F.lit(where))
    found = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    plain = fixed.without_unicode_classes(pattern)
    if plain != pattern:
        found = F.when(is_ascii(c), F.regexp_extract_all(c, F.lit(plain), F.lit(0))).otherwise(found)
    nothing = F.array().cast("array<string>")
    return F.when(c.isNull(), F.lit(None)).when(every, found).otherwise(nothing)


def _distinct(c: Column) -> Column:
    """Distinct values, sorted so that the result does not depend on chance."""
    return F.sort_array(F.array_distinct(c))


def extract_emails(c: Column) -> Column:
    return _distinct(_find(c, fixed.EMAIL, "@"))


def extract_phones(c: Column) -> Column:
    def search(run: Column) -> Column:
        american = F.regexp_extract_all(run, F.lit(fixed.PHONE_US), F.lit(0))
        return F.concat(american, F.regexp_extract_all(run, F.lit(fixed.PHONE_INTERNATIONAL), F.lit(0)))

    runs = F.filter(F.split(c, fixed.NOT_IN_PHONE), lambda r: F.length(r) >= fixed.SHORTEST_PHONE)
    return _distinct(F.flatten(F.transform(runs, search)))


def extract_urls(c: Column) -> Column:
    return _distinct(_find(c, fixed.URL, "://"))


def extract_dates(c: Column) -> Column:
    return _distinct(
        F.concat(
            _find(c, fixed.DATE_ISO, "-", where=fixed.FOUR_DIGITS),
            _find(c, fixed.DATE_SLASHED, "/"),
            _find(c, fixed.DATE_MONTH_FIRST, where=fixed.FOUR_DIGITS),
            _find(c, fixed.DATE_DAY_FIRST, where=fixed.FOUR_DIGITS),
        )
    )


def extract_money(c: Column) -> Column:
    """Amounts by prefix sign, then by suffix code; repeated amounts stay."""

    def entries(found: Column, currency) -> Column:
        amounts = F.transform(
            found,
            lambda m: F.struct(
                strip(m).alias("raw"),
                F.regexp_replace(m, r"(?U)[^\d.]", "").try_cast("double").alias("amount"),
                currency(m).alias("currency"),
            ),
        )
        return F.filter(amounts, lambda e: e["amount"].isNotNull())

    prefixed = [
        entries(
            _find(c, rf"(?U)\Q{sign}\E{fixed.MONEY_AFTER_PREFIX}", sign),
            lambda m, code=code: F.lit(code),
        )
        for sign, code in fixed.MONEY_PREFIXES.items()
    ]
    code_length = len(fixed.MONEY_CODES[0])
    suffixed = entries(
        _find(c, fixed.MONEY_BEFORE_CODE, *fixed.MONEY_CODES), lambda m: F.right(m, F.lit(code_length))
    )
    return F.concat(*prefixed, suffixed)


def extract_names(c: Column) -> Column:
    """Two or more capitalised words at the start of the text or a sentence."""
    stop = F.array(*[F.lit(w) for w in fixed.NAME_STOP_WORDS])
    found = F.filter(
        _find(c, fixed.NAME), lambda n: ~F.array_contains(stop, F.element_at(words(n), 1))
    )
    return _distinct(found)


def extract_pairs(c: Column) -> Column:
    """Key/value lines as a map; a repeated key keeps its last value.

    For each line the first separator in the fixed order that stands between
    two characters decides, even when the key it gives is then refused.
    """

    def pair(line: Column, i: Column) -> Column:
        size = F.length(line)
        cut = F.lit(None).cast("int")
        for separator in reversed(fixed.PAIR_SEPARATORS):
            at = F.locate(separator, line, 2)
            cut = F.when((at > 0) & (at < size), at).otherwise(cut)
        return let(
            F.struct(line.alias("line"), cut.alias("cut")),
            lambda x: F.struct(
                strip(F.left(x["line"], x["cut"] - 1)).alias("key"),
                (-i).alias("back"),
                strip(F.substring(x["line"], x["cut"] + 1, F.length(x["line"]))).alias("value"),
            ),
        )

    lines = F.transform(F.split(c, "\n"), strip)
    pairs = F.filter(
        F.transform(lines, pair),
        lambda p: p["key"].isNotNull() & (F.length(p["key"]) < fixed.PAIR_KEY_LIMIT),
    )
    last = let(
        F.sort_array(pairs),
        lambda s: F.filter(
            s, lambda p, i: (i == 0) | (F.get(s, F.greatest(i - 1, F.lit(0)))["key"] != p["key"])
        ),
    )
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["key"], p["value"])))


def extract_all(c: Column) -> Column:
    """One record with every kind of entity except names.

    Texts whose characters beyond ASCII are neither letters, digits nor blanks
    are searched in Arrow batches, where the many patterns cost least; the
    others by the columns above, with the same results.
    """
    plain = F.is_valid_utf8(c) & ~F.rlike(c, F.lit(fixed.CLASSED_BEYOND_ASCII))

    @F.arrow_udf(RECORD)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in text_slices(batch):
                yield records(texts)

    found = search.asNondeterministic()(F.when(plain, c))  # so that no filter evaluates it again
    return F.when(plain, found).otherwise(_record(c))


def _record(c: Column) -> Column:
    return F.struct(
        extract_emails(c).alias("emails"),
        extract_phones(c).alias("phones"),
        extract_urls(c).alias("urls"),
        extract_dates(c).alias("dates"),
        extract_money(c).alias("monetary"),
        extract_pairs(c).alias("key_value_pairs"),
    )


def entity_total(record: Column) -> Column:
    """Number of entities in a record of :func:`extract_all`."""
    fields = ["emails", "phones", "urls", "dates", "monetary", "key_value_pairs"]
    sizes = [F.size(record[f]) for f in fields]
    return sum(sizes[1:], sizes[0]).cast("bigint")
