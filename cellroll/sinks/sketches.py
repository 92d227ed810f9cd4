"""Key sketches of a history table: which dates can hold a key of a load.

Next to the table lies a small table of Bloom filters, a few bitmaps for
each date and append.  Before a load is published its keys are looked up
there.  A date in which no key of the load can be is not opened at all; in
the others only the keys that may be there are compared with the table's.

A bitmap has 2^15 bits and takes the keys of one block: a date's keys are
dealt to as many blocks as its number of rows in the append asks for
(KEYS_PER_BLOCK each, about 1 of 1,000 absent keys is taken for present).
Such a false positive costs the read of a date and changes no result.

Bits are written before the rows of an append, so that after a crash
between the two the sketch holds keys too many, never too few.  Appends that
go past the sketch must be followed by ``build_sketch`` of their dates.

Rows with a NULL in the key never equal another row, as in a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import PARTITION_COL, append_partitioned, overwrite_partitions, read_table, restrict_to

BITS = 1 << 15  # of the bitmap that bitmap_construct_agg makes
KEYS_PER_BLOCK = 2048
HASHES = 6


def _hash(keys, seed: int, size) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), size)


def _bits(keys) -> list[Column]:
    return [_hash(keys, i, F.lit(BITS).cast("long")) for i in range(1, HASHES + 1)]


def sketch_rows(rows: DataFrame, keys, col: str = PARTITION_COL) -> DataFrame:
    """date, blocks, block, bitmap: the filters of these rows' keys; bits are joined before the shuffle."""
    each = rows.select(col, *keys)
    sizes = each.groupBy(col).agg(F.ceil(F.count(F.lit(1)) / KEYS_PER_BLOCK).cast("long").alias("blocks"))
    bits = each.join(sizes, col).select(col, "blocks", _hash(keys, 0, F.col("blocks")).alias("block"), F.explode(F.array(*_bits(keys))).alias("bit"))
    return bits.groupBy(col, "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def add_to_sketch(rows: DataFrame, sketch: str, keys, col: str = PARTITION_COL) -> None:
    append_partitioned(sketch_rows(rows, keys, col), sketch, col=col)


def build_sketch(spark: SparkSession, target: str, sketch: str, keys, low=None, high=None, col: str = PARTITION_COL) -> None:
    """The sketch of all dates, or those from ``low`` to ``high``, anew from the table's keys: one filter set a date."""
    rows = read_table(spark, target)
    if low is not None:
        rows = restrict_to(rows, low, high, col)
    overwrite_partitions(sketch_rows(rows, keys, col), sketch, col=col)


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def maybe_there(rows: DataFrame, sketch: DataFrame, keys, col: str = PARTITION_COL) -> DataFrame:
    """Distinct (date, key) of ``rows`` that the sketch can't exclude; every key that is in the table is among them."""
    sizes = sketch.select(col, "blocks").distinct()
    asked = rows.select(col, *keys).distinct().join(sizes, col).withColumn("block", _hash(keys, 0, F.col("blocks")))
    found = asked.join(sketch, [col, "blocks", "block"])
    for bit in _bits(keys):
        found = found.where(_is_set(F.col("bitmap"), bit))
    return found.select(col, *keys).distinct()
