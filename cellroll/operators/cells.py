"""The cells behind a feed over time: which names and numbers a key stood for, and when.

A cell that is renamed or renumbered keeps its key, and two cells may share
one (the key is joined text), so a key's dimensions are facts with a time:
rows (unique_id, dimensions, valid_from, valid_to), cut where a dimension
changes from one hour of the key to the next.

Scale: a key has one row an hour, so the window over a key is as long as its
history; the rows carry the key, the hour and the dimensions only.  A load
refreshes the keys it touches (``refresh_intervals``); nothing else is read
again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import day_of
from ..schema import DIM_COLS, KEY_COL, TIME_COL


def cell_intervals(hourly: DataFrame, dims=DIM_COLS) -> DataFrame:
    """unique_id, dims, valid_from, valid_to, last_seen, hours: the stretches of a key's hours with equal dimensions.

    ``valid_to`` is the hour at which the next stretch begins (exclusive), NULL for the last one.  Rows of one
    key and hour (from different feeds) are ordered by their dimensions.
    """
    dims = list(dims)
    rows = hourly.select(KEY_COL, TIME_COL, *dims)
    by_time = Window.partitionBy(KEY_COL).orderBy(TIME_COL, *dims)
    now = F.struct(*dims)
    rows = rows.withColumn("_new", (~F.lag(now).over(by_time).eqNullSafe(now)).cast("int"))
    rows = rows.withColumn("_part", F.sum("_new").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
    parts = rows.groupBy(KEY_COL, "_part", *dims).agg(F.min(TIME_COL).alias("valid_from"), F.max(TIME_COL).alias("last_seen"), F.count(F.lit(1)).alias("hours"))
    following = F.lead("valid_from").over(Window.partitionBy(KEY_COL).orderBy("_part"))
    return parts.withColumn("valid_to", following).select(KEY_COL, *dims, "valid_from", "valid_to", "last_seen", "hours")


def refresh_intervals(known: DataFrame | None, load: DataFrame, hourly: DataFrame, dims=DIM_COLS) -> DataFrame:
    """The intervals after a load: those of the keys in ``load`` from all hours of these keys in ``hourly``, the others as known.

    Late hours may split a stretch, so a touched key's stretches are cut anew.
    """
    touched = load.select(KEY_COL).distinct()
    new = cell_intervals(hourly.join(touched, KEY_COL, "left_semi"), dims)
    if known is None:
        return new
    return known.join(touched, KEY_COL, "left_anti").select(*new.columns).unionByName(new)


def as_of(rows: DataFrame, intervals: DataFrame, dims=DIM_COLS, time_col: str = TIME_COL, prefix: str = "") -> DataFrame:
    """``rows`` with the dimensions that their key had at ``time_col`` (NULL before its first hour); names get ``prefix``."""
    dims = list(dims)
    known = intervals.select(F.col(KEY_COL).alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *[F.col(c).alias(f"{prefix}{c}") for c in dims])
    # a stretch that a second cell of the same hour cut off is empty
    inside = (F.col(KEY_COL) == F.col("_key")) & (F.col(time_col) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(time_col) < F.col("_to")))
    return rows.join(known, inside, "left").drop("_key", "_from", "_to")


def conflict_names(hourly: DataFrame, dims=DIM_COLS) -> DataFrame:
    """date, unique_id, dims, first_hour, last_hour, hours: the cells behind each daily key that has several."""
    dims = list(dims)
    one = hourly.groupBy(day_of(TIME_COL).alias("date"), KEY_COL, *dims).agg(F.min(TIME_COL).alias("first_hour"), F.max(TIME_COL).alias("last_hour"), F.count(F.lit(1)).alias("hours"))
    several = one.groupBy("date", KEY_COL).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return one.join(several, ["date", KEY_COL], "left_semi")


def collision_history(intervals: DataFrame, parts=("lac", "ci")) -> DataFrame:
    """unique_id, parts, valid_from, last_seen, hours: the numbers behind each key that stood for several, over all loads."""
    parts = list(parts)
    one = intervals.groupBy(KEY_COL, *parts).agg(F.min("valid_from").alias("valid_from"), F.max("last_seen").alias("last_seen"), F.sum("hours").alias("hours"))
    several = one.groupBy(KEY_COL).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return one.join(several, KEY_COL, "left_semi")
