"""Landed API responses as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed

_LIST = "array<variant>"


def parse_body(body: Column) -> Column:
    """A response as VARIANT, NULL when it is not JSON."""
    return F.try_parse_json(body)


def page_envelope(parsed: Column) -> Column:
    """The value under the first envelope key that is present, JSON null included."""
    return F.coalesce(*[F.try_variant_get(parsed, f"$.{key}", "variant") for key in fixed.ENVELOPE_KEYS])


def page_items(parsed: Column, envelope: Column) -> Column:
    """Items of a response: the list itself or the list in its envelope, NULL without a list."""
    return F.coalesce(
        F.try_variant_get(parsed, "$", _LIST), F.try_variant_get(envelope, "$", _LIST)
    )


def record_field(record: Column, name: str, type_name: str = "string") -> Column:
    """One top-level field of a record; a missing field gives NULL."""
    quoted = name.replace("'", "\\'")
    return F.try_variant_get(record, f"$['{quoted}']", type_name)
