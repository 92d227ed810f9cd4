"""Daily totals kept up to date from each load's own contribution (``mode='delta'`` of ``run_load``).

``mode='recompute'`` reads all hours of every date that a load touches.  Here
a date's totals are a state: one row for each group of the daily roll-up,
with the ids of the loads that are in it.  A load adds the sums of the rows
that it brought newly; it reads itself, the target's keys and the state of
its dates, never the hours.

Order of a load, so that a crash at any point is mended by running the same
load again:

1. the contribution (sums of the rows whose key hourly lacks) is written to
   ``pending/load=<id>``;
2. the rows are appended to hourly;
3. contribution and state are merged and written over the state of the
   load's dates, with the id;
4. the dates' daily rows are written over from the state;
5. the pending contribution is removed.

On a second run hourly holds the keys already if step 2 was done; then the
pending contribution stands, else it is made anew.  A date whose state has
the load's id is not added to again.  While another load is pending no load
begins, as its dates' totals are not known to be whole: run that load again,
or ``rebuild`` its dates from hourly.

The id is a fingerprint of the feed files (path, length, time of change)
unless the caller names the load.  One writer at a time, as for the tables.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.publish import first_wins, new_keys
from ..operators.rollup import sum_metrics, with_day
from ..schema import DAILY_KEYS, DAILY_UNIQUE, DIM_COLS, HOURLY_UNIQUE, KEY_COL, metrics_of
from ..session import delete_path, path_exists
from ..sinks.tables import PARTITION_COL, append_partitioned, overwrite_partitions, read_table, restrict_to

LOADS = "_loads"


class PendingLoad(RuntimeError):
    """Another load was begun and not finished."""


def load_fingerprint(spark: SparkSession, *paths) -> str:
    """One id for these files: of their paths, lengths and times of change."""
    digest = hashlib.sha256()
    conf = spark._jsc.hadoopConfiguration()
    for group in paths:
        files = spark.read.format("text").load(group).inputFiles()
        for name in sorted(files):
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
            status = path.getFileSystem(conf).getFileStatus(path)
            digest.update(f"{name}\t{status.getLen()}\t{status.getModificationTime()}\n".encode())
        digest.update(b"\n")
    return digest.hexdigest()[:32]


def pending_loads(spark: SparkSession, ledger: str) -> list[str]:
    """Ids of the loads that were begun and not finished."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/pending")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName().removeprefix("load=") for s in fs.listStatus(path)) if fs.exists(path) else []


def daily_from_state(state: DataFrame) -> DataFrame:
    """The daily rows: of groups with one (date, unique_id), the first by the dimensions."""
    return first_wins(state.drop(LOADS), DAILY_UNIQUE, DIM_COLS)


def _order():
    return (F.col(KEY_COL).asc(),)


def _state(spark: SparkSession, ledger: str, span) -> DataFrame | None:
    have = read_table(spark, f"{ledger}/state")
    return None if have is None else restrict_to(have, *span)


def merged_state(state: DataFrame | None, added: DataFrame, load_id: str, metrics) -> DataFrame:
    """The state of the dates in ``added`` after the load; a date that has the load already stays as it is."""
    own = added.withColumn(LOADS, F.array(F.lit(load_id)))
    if state is None:
        return own
    dates = added.select(PARTITION_COL).distinct()
    state = state.join(dates, PARTITION_COL, "left_semi")
    loads = state.groupBy(PARTITION_COL).agg(F.first(LOADS).alias(LOADS))
    done = loads.where(F.array_contains(LOADS, load_id)).select(PARTITION_COL)
    own = own.join(done, PARTITION_COL, "left_anti")
    sums = sum_metrics(state.drop(LOADS).unionByName(own.drop(LOADS)), DAILY_KEYS, metrics, keys_not_null=True)
    # the ids of a date: as before, and this one where it was not in
    ids = dates.join(loads, PARTITION_COL, "left").select(PARTITION_COL, F.array_union(F.coalesce(LOADS, F.array().cast("array<string>")), F.array(F.lit(load_id))).alias(LOADS))
    return sums.join(ids, PARTITION_COL)


def publish_delta(spark: SparkSession, hourly_new: DataFrame, span, hourly_path: str, daily_path: str, ledger: str, load_id: str,
                  work: str, hourly_order) -> tuple[int, int]:
    """Steps 1 to 5 for the checked rows of a load (with ``date``); rows appended to hourly, and dates updated."""
    ledger = ledger.rstrip("/")
    others = [x for x in pending_loads(spark, ledger) if x != load_id]
    if others:
        raise PendingLoad(f"loads {others} were begun and not finished: run them again, or rebuild their dates")
    if span[0] is None:
        return 0, 0
    metrics = [c for c in metrics_of(hourly_new, [PARTITION_COL, *HOURLY_UNIQUE, *DIM_COLS])]
    pending = f"{ledger}/pending/load={load_id}"
    have = read_table(spark, hourly_path)
    fresh, n_fresh = hourly_new, 1
    if have is not None:
        keys, n_fresh, clashing = new_keys(hourly_new, restrict_to(have, *span), HOURLY_UNIQUE, f"{work}/fresh")
        if clashing:
            fresh = hourly_new.join(keys, list(HOURLY_UNIQUE), "left_semi").select(*hourly_new.columns)
    appended = 0
    if n_fresh:
        part = sum_metrics(with_day(fresh.drop(PARTITION_COL), metrics), DAILY_KEYS, metrics, keys_not_null=True)
        part.write.mode("overwrite").parquet(pending)
        appended = append_partitioned(fresh, hourly_path, hourly_order)
    elif not path_exists(spark, f"{pending}/_SUCCESS"):
        return 0, 0  # all of it was published by loads that are finished
    added = spark.read.parquet(pending)
    merged = merged_state(_state(spark, ledger, span), added, load_id, metrics)
    merged.write.mode("overwrite").parquet(f"{work}/state")
    merged = spark.read.schema(merged.schema).parquet(f"{work}/state")
    overwrite_partitions(merged, f"{ledger}/state", _order())
    overwrite_partitions(daily_from_state(merged), daily_path, _order())
    n = merged.select(PARTITION_COL).distinct().count()
    delete_path(spark, pending)
    return appended, n


def rebuild(spark: SparkSession, hourly_path: str, daily_path: str, ledger: str, low, high) -> None:
    """State and daily rows of the dates from ``low`` to ``high`` from all their hours; forgets pending loads of these dates only."""
    ledger = ledger.rstrip("/")
    hours = restrict_to(read_table(spark, hourly_path), low, high)
    metrics = metrics_of(hours, [PARTITION_COL, *HOURLY_UNIQUE, *DIM_COLS])
    state = sum_metrics(with_day(hours.drop(PARTITION_COL), metrics), DAILY_KEYS, metrics, keys_not_null=True)
    state = state.withColumn(LOADS, F.array(F.lit("rebuilt")))
    overwrite_partitions(state, f"{ledger}/state", _order())
    overwrite_partitions(daily_from_state(state), daily_path, _order())
    for load_id in pending_loads(spark, ledger):
        path = f"{ledger}/pending/load={load_id}"
        if not path_exists(spark, f"{path}/_SUCCESS") or not spark.read.parquet(path).where(~F.col(PARTITION_COL).between(F.lit(low), F.lit(high))).limit(1).count():
            delete_path(spark, path)
