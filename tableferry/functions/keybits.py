"""A bit map of 64-bit hashes, small enough to be sent to all tasks whatever the number of keys.

A row whose bit is not set is certainly not among the keys. Of others a share, the number of keys over ``2 ** BITS``, passes by chance:
an exact join on the key has to follow. It then moves rows that are mostly wanted, not the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 16 MB in all: buckets of 32,768 bits, the size of Spark's bitmaps.
BITS = 27
_IN_BUCKET = 15


def _bucket(key: Column) -> Column:
    return F.shiftrightunsigned(key, _IN_BUCKET).bitwiseAND(F.lit((1 << BITS - _IN_BUCKET) - 1).cast("bigint"))


def _place(key: Column) -> Column:
    return key.bitwiseAND(F.lit((1 << _IN_BUCKET) - 1).cast("bigint"))


def marked(keys: DataFrame, key: str) -> DataFrame:
    """(_bucket, _bits) of all keys; they are hashes, so buckets are even."""
    placed = keys.select(_bucket(F.col(key)).alias("_bucket"), _place(F.col(key)).alias("_place"))
    # Dealt by bucket first: a task that saw all buckets would send off a whole map.
    return placed.repartition("_bucket").groupBy("_bucket").agg(F.bitmap_construct_agg("_place").alias("_bits"))


def only_marked(rows: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """Rows whose key may be among the marked ones; no key that is, is lost."""
    named = bits.select(F.col("_bucket").alias("_b"), "_bits")
    met = rows.join(F.broadcast(named), _bucket(F.col(key)) == F.col("_b"))
    place = _place(F.col(key))
    byte = F.substring("_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
    # Spark counts bits from the lowest of each byte.
    held = F.conv(F.hex(byte), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (place.bitwiseAND(F.lit(7).cast("bigint")) + 1).cast("int"))
    return met.where(held.bitwiseAND(mask) != 0).select(*[F.col(f"`{c}`") for c in rows.columns])
