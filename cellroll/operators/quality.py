"""Data-quality checks that stand in for the database constraints.

Row checks (arity, NOT NULL, casts, text width) are computed while parsing
(``sources.feed.parse_lines``, column ``reject_reasons``).  Here are the
checks that need more than one row (key uniqueness, key collisions) and the
report that counts everything in one place.  All are aggregations with
map-side partial aggregation, so a hot key costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import HOURLY_UNIQUE, KEY_COL
from ..sources.feed import REJECT_COL


def duplicate_keys(df: DataFrame, keys=HOURLY_UNIQUE) -> DataFrame:
    """Keys that occur more than once, with their row count ``n``."""
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def quality_report(parsed: DataFrame, keys=HOURLY_UNIQUE) -> DataFrame:
    """(check, n_rows): row-level reasons, plus ``duplicate_key`` = rows of the
    good part whose key occurs more than once, plus ``rows`` and ``good``.

    One scan: the parsed lines are counted per (key, reasons) once, and the
    three parts of the report read that small result (the exchange is
    reused, so the text is read and split once).
    """
    keys = list(keys)
    # "good" is an aggregate output, not a grouping column, so the filters
    # below stay above the shared exchange instead of being pushed under it
    base = parsed.groupBy(*keys, REJECT_COL).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.col(REJECT_COL) == F.lit("")).alias("_good"))
    good = F.col("_good")
    totals = base.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.sum(F.when(good, F.col("_n")).otherwise(0)), F.lit(0)).cast("bigint").alias("good"),
    ).select(F.expr("stack(2, 'rows', rows, 'good', good) as (check, n_rows)"))
    reasons = (base.filter(~good)
               .select(F.explode(F.split(REJECT_COL, ",")).alias("check"), "_n")
               .groupBy("check").agg(F.sum("_n").cast("bigint").alias("n_rows")))
    dup = (base.filter(good & (F.col("_n") > 1))
           .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"))
           .select(F.lit("duplicate_key").alias("check"), "n_rows"))
    return totals.unionByName(reasons).unionByName(dup)


def cell_key_collisions(df: DataFrame, key: str = KEY_COL, parts=("lac", "ci")) -> DataFrame:
    """Keys shared by more than one (lac, ci) pair: unique_id, n_pairs, n_rows."""
    parts = list(parts)
    per_pair = df.groupBy(key, *parts).agg(F.count(F.lit(1)).alias("_n"))
    per_key = per_pair.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_pairs"), F.sum("_n").alias("n_rows"))
    return per_key.filter(F.col("n_pairs") > 1)
