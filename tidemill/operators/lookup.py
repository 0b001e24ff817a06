"""Joining a large table to one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

BROADCAST_BYTES = 64 << 20
ROW_OVERHEAD = 64
SALTS = 64


def join_per_key(
    large: DataFrame, per_key: DataFrame, key: str, salt_by: Column,
    broadcast_bytes: int = BROADCAST_BYTES, salts: int = SALTS,
) -> DataFrame:
    """Inner join of ``large`` with ``per_key``, which holds one row per key.

    ``per_key`` is written once and measured.  Below the bound it is broadcast
    and ``large`` does not move; above it both sides shuffle on the key and a
    salt, so that a key with a large share of the rows spreads over ``salts``
    tasks at the price of ``salts`` copies of the narrow side.
    """
    per_key = cut_lineage(per_key)
    row_bytes = F.octet_length(F.to_json(F.struct(*per_key.columns))) + ROW_OVERHEAD
    size = per_key.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("size")).first()["size"]
    if size <= broadcast_bytes:
        return large.join(F.broadcast(per_key), key)
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [key, "_salt"]).drop("_salt")
