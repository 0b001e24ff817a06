"""Blanks, null and numbers held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times inside ``body(value)``.

    A column used twice inside a lambda is evaluated for each use; passing it
    through a one-element array evaluates it once per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    """Drop blanks of every kind at both ends (plain ``trim`` drops spaces only)."""
    return F.btrim(c, F.lit(fixed.BLANKS))


def is_blank(c: Column) -> Column:
    """True for NULL, empty and all-blank cells."""
    return F.coalesce(strip(c) == "", F.lit(True))


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def words(c: Column) -> Column:
    """Words between blanks, without empty ones."""
    return F.filter(F.split(c, fixed.BLANK_RUN), lambda w: w != "")


def to_number(c: Column) -> Column:
    """Text as a double, NULL when it is not a number.

    The guard keeps out what the cast would take beyond plain numbers
    (``1.0d``, ``0x1p3``) and lets ``1_000`` in.
    """
    text = strip(c)
    guarded = F.when(text.rlike(rf"\A(?:{fixed.NUMBER})\z"), F.replace(text, F.lit("_"), F.lit("")))
    return guarded.try_cast("double")
