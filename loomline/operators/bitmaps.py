"""Which keys a table holds, as bitmaps over dense numbers of the keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys are numbered within so many hash buckets, so that no task sees all; a bucket's numbers begin at a multiple of SPAN.
BUCKETS, SPAN = 64, 1 << 40


def number_keys(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """(key, number) of the keys not known yet, once each and without null; numbers go on from the known ones and never change."""
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct()
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS))
    start = F.col("_bucket") * SPAN
    if known is not None:
        fresh = fresh.join(known, key, "left_anti")
        # One row a bucket.
        ends = known.groupBy(bucket.alias("_known")).agg((F.max("number") + 1).alias("_next"))
        fresh = fresh.withColumn("_bucket", bucket).join(F.broadcast(ends), F.col("_bucket") == F.col("_known"), "left").drop("_known")
        start = F.coalesce("_next", start)
    else:
        fresh = fresh.withColumn("_bucket", bucket)
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    return fresh.select(key, (start + rank).cast("long").alias("number"))


def bitmaps_of(members: DataFrame, numbers: DataFrame, key: str) -> DataFrame:
    """(page, bits): a bit for each numbered key that the members hold, 4 KB for a page of 32,768 numbers. Keys without a number are left out."""
    held = members.select(key).distinct().join(numbers, key)
    return held.groupBy(F.bitmap_bucket_number("number").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def bit_at(bits: Column, number: str) -> Column:
    """Whether the number's bit is set; false for no bitmap."""
    place = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))


def bitmap_flags(index: DataFrame, numbers: DataFrame, key: str, bitmaps: dict[str, DataFrame]) -> DataFrame:
    """The index with a flag per name: whether any of the name's bitmaps has the row's key; a null key has none.

    A name's bitmaps may hold a page several times, say for each season; those are united.
    """
    if not bitmaps:
        return index
    named = [df.select("page", "bits", F.lit(name).alias("_name")) for name, df in bitmaps.items()]
    pages = reduce(lambda a, b: a.unionByName(b), named).groupBy("page").agg(*[F.bitmap_or_agg(F.when(F.col("_name") == name, F.col("bits"))).alias(f"_bits_{i}") for i, name in enumerate(bitmaps)])
    placed = index.drop(*bitmaps).join(numbers, key, "left").withColumn("_page", F.bitmap_bucket_number("number"))
    met = placed.join(pages, F.col("_page") == F.col("page"), "left")
    return met.withColumns({name: bit_at(F.col(f"_bits_{i}"), "number") for i, name in enumerate(bitmaps)}).drop("number", "_page", "page", *[f"_bits_{i}" for i in range(len(bitmaps))])
