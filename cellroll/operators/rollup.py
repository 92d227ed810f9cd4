"""Roll-ups of wide metric rows.

Sums are built in ``agg`` calls (never chained ``withColumn``): partial +
final hash aggregation, so map-side partial aggregation keeps a hot cell to
one row per task and day before the shuffle.

A hash aggregate slows down per value as it carries more sums (measured on
600,000 rows, local[8]: 100 sums 4 s, 200 sums 12 s, 379 sums 29-31 s).
Wider roll-ups are therefore done in passes of at most ``SUMS_PER_PASS``
metrics over the same input, joined back on the group keys (379 sums in
passes of 96: 8-11 s).  From columnar input each pass reads only its own
metric columns plus the keys, and every pass is hash partitioned on the
same keys, so the joins add no exchange.

Metrics that are derived from a few columns are better given as expressions:
a partial sum of every metric for every group of a task is many times wider
than the rows it is made of.  Then the rows are shuffled once, as they are,
and every pass derives and sums its metrics where a group's rows lie.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import day_of, time_bucket
from ..schema import DAILY_KEYS, DAILY_UNIQUE, DIM_COLS, HOURLY_KEYS, KEY_COL, TIME_COL, metrics_of
from .publish import first_wins


SUMS_PER_PASS = 96


# What stands for a NULL key in a group's key columns, next to a flag that says so.
_FILL = {"string": "''", "timestamp_ntz": "timestamp_ntz'1970-01-01 00:00:00'", "timestamp": "timestamp'1970-01-01 00:00:00'",
         "date": "date'1970-01-01'", "boolean": "false"}


def sum_metrics(df: DataFrame, dims, metrics, *, per_pass: int | None = SUMS_PER_PASS,
                keys_not_null: bool = False) -> DataFrame:
    """GROUP BY ``dims``; SUM of every metric (NULLs ignored, all-NULL -> NULL).

    More than ``per_pass`` metrics: one aggregate per slice of metrics, then
    the slices joined on the group keys (one row per group on every side, so
    1:1).  All joins are plain equalities on columns the aggregates are
    partitioned by, so they add no exchange; a key that may be NULL is
    grouped as a filled value and a flag.  ``keys_not_null=True`` (validated
    key columns) leaves the flags out.

    ``metrics`` as {name: expression over the columns of ``df``}: the rows of
    ``df`` are brought to their groups once, before the metrics are derived.
    ``df`` should have no more columns than these need.
    """
    dims = list(dims)
    if isinstance(metrics, Mapping):
        return _sum_derived(df, dims, metrics, per_pass, keys_not_null)
    metrics = list(metrics)
    if not per_pass or len(metrics) <= per_pass:
        return df.groupBy(*dims).agg(*[F.sum(m).alias(m) for m in metrics])
    keys, back = dims, [F.col(d) for d in dims]
    if not keys_not_null:
        types = dict(df.dtypes)
        flags = [f"_null_{i}" for i in range(len(dims))]
        fill = [F.coalesce(F.col(d), F.expr(_FILL.get(types[d], "0")).cast(types[d])).alias(d) for d in dims]
        rest = [m for m in metrics if m not in set(dims)]
        df = df.select(*fill, *[F.col(d).isNull().alias(f) for d, f in zip(dims, flags, strict=True)], *rest)
        keys = [*dims, *flags]
        back = [F.when(~F.col(f), F.col(d)).alias(d) for d, f in zip(dims, flags, strict=True)]
    out = None
    for i in range(0, len(metrics), per_pass):
        agg = df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in metrics[i:i + per_pass]])
        out = agg if out is None else out.join(agg, keys, "inner")
    return out.select(*back, *metrics)


def _sum_derived(df: DataFrame, dims, metrics: Mapping, per_pass: int | None, keys_not_null: bool) -> DataFrame:
    """``sum_metrics`` of expressions: one shuffle of the narrow rows, which all passes read."""
    types, names = dict(df.dtypes), list(metrics)
    # the metrics may use the keys too, so these are filled under names of their own
    keys = [f"_key_{i}" for i in range(len(dims))]
    if keys_not_null:
        made, back = [F.col(d).alias(k) for d, k in zip(dims, keys, strict=True)], [F.col(k).alias(d) for d, k in zip(dims, keys, strict=True)]
    else:
        flags = [f"_null_{i}" for i in range(len(dims))]
        made = [F.coalesce(F.col(d), F.expr(_FILL.get(types[d], "0")).cast(types[d])).alias(k) for d, k in zip(dims, keys, strict=True)]
        made += [F.col(d).isNull().alias(f) for d, f in zip(dims, flags, strict=True)]
        back = [F.when(~F.col(f), F.col(k)).alias(d) for d, k, f in zip(dims, keys, flags, strict=True)]
        keys = [*keys, *flags]
    # a fixed number: the sums are far wider than the rows by whose bytes partitions would be joined
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(*made, *df.columns).repartition(parts, *keys)
    out = None
    for i in range(0, len(names), per_pass or len(names)):
        part = names[i:i + (per_pass or len(names))]
        agg = rows.select(*keys, *[metrics[m].alias(m) for m in part]).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in part])
        out = agg if out is None else out.join(agg, keys, "inner")
    return out.select(*back, *names)


def with_day(hourly: DataFrame, metrics=None) -> DataFrame:
    """Hourly rows keyed by the day of ``resulttime`` instead of the hour."""
    metrics = metrics if metrics is not None else metrics_of(hourly, HOURLY_KEYS)
    return hourly.select(day_of(TIME_COL).alias("date"), KEY_COL, *DIM_COLS, *metrics)


def daily_rollup(hourly: DataFrame, metrics=None) -> DataFrame:
    """Daily sums grouped by (date, unique_id, mbsc, cellname, cellindex, lac, ci).

    The dimensions are part of the grouping, so a cell renamed within a day
    gives two rows with one (date, unique_id); ``daily_rows`` keeps one.
    """
    metrics = metrics if metrics is not None else metrics_of(hourly, HOURLY_KEYS)
    # the seven keys are NOT NULL (checked when the feeds are loaded)
    return sum_metrics(with_day(hourly, metrics), DAILY_KEYS, metrics, keys_not_null=True)


def daily_rows(hourly: DataFrame, metrics=None, order_by=DIM_COLS) -> DataFrame:
    """What one insert-ignore of the roll-up leaves in an empty daily table:
    one row per (date, unique_id), the first by ``order_by``."""
    return first_wins(daily_rollup(hourly, metrics), DAILY_UNIQUE, order_by)


def bucket_rollup(df: DataFrame, width: str, dims, metrics, ts_col: str = TIME_COL,
                  bucket_col: str = "bucket") -> DataFrame:
    """Sums per time bucket of any width ('1 hour', '15 minutes', '7 days')."""
    with_bucket = df.select(time_bucket(ts_col, width).alias(bucket_col), *dims, *metrics)
    return sum_metrics(with_bucket, [bucket_col, *dims], metrics)


def round_metrics(df: DataFrame, metrics, places: int) -> DataFrame:
    """Round the given double columns (for comparing sums across engines)."""
    ms = set(metrics)
    return df.select(*[F.round(c, places).alias(c) if c in ms else F.col(c) for c in df.columns])
