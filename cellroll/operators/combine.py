"""Join the two feeds of one cell and hour into one wide row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import HOURLY_KEYS, HOURLY_UNIQUE, metrics_of


def feed_join(counter: DataFrame, qual: DataFrame, keys=HOURLY_UNIQUE, qual_metrics=None) -> DataFrame:
    """Inner join on (unique_id, resulttime): every counter column, then the
    quality metrics.  The quality feed's own dimension columns are not read.
    Rows of either feed without a partner are dropped (see ``feed_join_audit``).

    Both sides are large, so this is a shuffle join on the two keys; AQE
    turns it into a broadcast join only when a side is measured small at
    run time.  Keys must be unique per feed (``run_load`` checks this, or
    resolves duplicates first-wins, before joining), so the join is at most
    1:1 and has no hot key.
    """
    keys = list(keys)
    qual_metrics = list(qual_metrics) if qual_metrics is not None else metrics_of(qual, HOURLY_KEYS)
    clash = set(qual_metrics) & set(counter.columns)
    if clash:
        raise ValueError(f"metric names in both feeds: {sorted(clash)}")
    joined = counter.join(qual.select(*keys, *qual_metrics), keys, "inner")
    return joined.select(*counter.columns, *qual_metrics)


def feed_join_audit(counter: DataFrame, qual: DataFrame, keys=HOURLY_UNIQUE) -> DataFrame:
    """One row: keys matched, keys only in the counter feed, only in the quality feed.

    Distinct keys of each side (partial aggregation, so a repeated key costs
    one row per task), then one full outer join of key columns only.
    """
    keys = list(keys)
    a = counter.select(*keys).distinct().withColumn("_a", F.lit(True))
    b = qual.select(*keys).distinct().withColumn("_b", F.lit(True))
    j = a.join(b, keys, "full_outer")
    n = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")
    return j.agg(
        n(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("matched"),
        n(F.col("_b").isNull()).alias("counter_only"),
        n(F.col("_a").isNull()).alias("qual_only"),
    )


def unmatched_keys(counter: DataFrame, qual: DataFrame, keys=HOURLY_UNIQUE) -> DataFrame:
    """The distinct keys dropped by ``feed_join``, with the feed they came from."""
    keys = list(keys)
    ck = counter.select(*keys).distinct()
    qk = qual.select(*keys).distinct()
    a = ck.join(qk, keys, "left_anti").withColumn("feed", F.lit("counter"))
    b = qk.join(ck, keys, "left_anti").withColumn("feed", F.lit("qual"))
    return a.unionByName(b)
