"""W4 with little shuffle: keys that break the key, found in two steps, and against rows that are there already.

Step one moves no keys: 64-bit hashes of keys are counted (partial counts per task) and those that occur twice are set in a
sketch, bitmaps of ``bits`` bits in all, made with Spark's bitmap functions. Its size is fixed by ``bits``, whatever the input's
size, so it can be broadcast. Step two scans the keys again, lets only those through whose bit is set (suspects), and groups
them exactly. A bit set by another key only lets more rows through; the result is exact. With more suspects than bits the sketch
lets most rows through and step two is the plain grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import col

#: Bits of a sketch: 4 MB of bitmaps.
BITS = 1 << 25


def _slot(keys: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*[col(k) for k in keys]), F.lit(bits))


def _any_null(keys: list[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | col(k).isNull()
    return out


def key_sketch(slots: DataFrame) -> DataFrame:
    """``(bucket, bitmap)`` of a frame with the column ``slot``: a row of 4 KB for each 32,768 slots, at most."""
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))


def in_sketch(df: DataFrame, keys: list[str], sketch: DataFrame, bits: int, or_null: bool = True) -> DataFrame:
    """The rows of ``df`` whose key may be in the sketch; with ``or_null`` those with a NULL in the key too."""
    slot = _slot(keys, bits)
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col("__bitmap"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    told = sketch.select(F.col("bucket").alias("__bucket"), F.col("bitmap").alias("__bitmap"))
    joined = df.join(F.broadcast(told), F.bitmap_bucket_number(slot) == F.col("__bucket"), "left")  # bits / 8 bytes at most
    return joined.where(is_set | _any_null(keys) if or_null else is_set).drop("__bucket", "__bitmap")


def key_suspects(df: DataFrame, keys, bits: int = BITS) -> DataFrame:
    """The key columns of the rows whose key may occur twice or has a NULL."""
    keys = list(keys)
    only = df.select(*[col(k) for k in keys])
    twice = only.select(F.xxhash64(*[col(k) for k in keys]).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return in_sketch(only, keys, key_sketch(twice.select(F.pmod("h", F.lit(bits)).alias("slot"))), bits)


def key_violations_in_two_steps(df: DataFrame, keys, bits: int = BITS) -> DataFrame:
    """The result of ``key_violations``; the shuffles carry hashes and suspects instead of all keys."""
    from .write import key_violations

    return key_violations(key_suspects(df, keys, bits), keys)


def key_violations_against(new: DataFrame, existing: DataFrame, keys, bits: int = BITS) -> DataFrame:
    """Keys of ``new`` that break the key among ``new`` and the rows of ``existing``: ``(keys..., n_rows, n_new, violation)``.

    The sketch holds the new keys, so ``existing`` is scanned for its key columns and only what may match moves.
    """
    keys = list(keys)
    columns = [col(k) for k in keys]
    fresh = new.select(*columns, F.lit(1).alias("__new"))
    sketch = key_sketch(fresh.where(~_any_null(keys)).select(_slot(keys, bits).alias("slot")).distinct())
    met = in_sketch(existing.select(*columns), keys, sketch, bits, or_null=False).withColumn("__new", F.lit(0))
    groups = fresh.union(met).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("__new").alias("n_new"))
    return (groups.where((F.col("n_new") > 0) & (_any_null(keys) | (F.col("n_rows") > 1)))
            .withColumn("violation", F.when(_any_null(keys), F.lit("null_key")).otherwise(F.lit("duplicate"))))
