"""Many small appends to a date become few sorted files, while others read the table.

For catalog tables.  The rows of a date are written to a new folder and the
partition's location is then set to it, one change in the catalog: a query
that is planned before reads the old files, one planned after the new ones,
each row once.  The old files stay until ``remove_retired``, for queries that
are still running.

A crash before a date's change leaves the date as it was, and an unused
folder in the store.  Rows appended while the date was being rewritten are
seen by a second count before the change; such a date is left for the next
time.  (Between that count and the change the table must have no writer; the
library's rule is one writer at a time anyway.)

Folders of plain paths have no such single step: there, a date's files can
only be replaced one after the other.  They are refused.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path
from .tables import PARTITION_COL, is_path, read_table, restrict_to, _by_date

_RETIRED = "date date, location string, retired_at timestamp"


def _partition(day: dt.date, col: str) -> str:
    return f"PARTITION ({col} = DATE'{day.isoformat()}')"


def location_of(spark: SparkSession, table: str, day: dt.date, col: str = PARTITION_COL) -> str:
    """The folder of one date's files."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {_partition(day, col)}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def files_by_date(rows: DataFrame, col: str = PARTITION_COL) -> DataFrame:
    """date, files, rows: counted from the files' metadata and their lengths in rows, no column is read."""
    each = rows.select(col, F.col("_metadata.file_path").alias("file")).groupBy(col, "file").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy(col).agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"))


def compact_dates(spark: SparkSession, table: str, store: str, low, high, *, order_within=None, min_files: int = 8,
                  col: str = PARTITION_COL) -> list[dt.date]:
    """Rewrite the dates from ``low`` to ``high`` that have ``min_files`` files or more; the dates that were changed.

    ``store``: a folder of the table's own, beside it, for the new files and
    the list of retired ones.  Every row stays; ``order_within`` sorts each file.
    """
    if is_path(table):
        raise ValueError(f"{table} is a folder: only the dates of a catalog table can be exchanged in one step")
    store = store.rstrip("/")
    rows = restrict_to(read_table(spark, table), low, high, col)
    before = {r[col]: r["rows"] for r in files_by_date(rows, col).where(F.col("files") >= min_files).collect()}
    if not before:
        return []
    days = sorted(before)
    new = f"{store}/files/{uuid.uuid4().hex}"
    _by_date(rows.where(F.col(col).isin(days)), order_within, col).write.partitionBy(col).parquet(new)
    # both sides counted again: what was written, and what the table holds by now
    written = spark.read.parquet(new)
    spark.catalog.refreshTable(table)
    now = {r[col]: r["rows"] for r in files_by_date(restrict_to(read_table(spark, table), low, high, col), col).collect()}
    done = {r[col]: r["rows"] for r in files_by_date(written, col).collect()}
    ready = [d for d in days if before[d] == now.get(d) == done.get(d)]
    old = [(d, location_of(spark, table, d, col), dt.datetime.now()) for d in ready]
    if old:  # listed first: a folder that is listed and still in use is not removed
        spark.createDataFrame(old, _RETIRED).coalesce(1).write.mode("append").parquet(f"{store}/retired")
    for day in ready:
        spark.sql(f"ALTER TABLE {table} {_partition(day, col)} SET LOCATION '{new}/{col}={day.isoformat()}'")
    spark.catalog.refreshTable(table)
    return ready


def remove_retired(spark: SparkSession, table: str, store: str, before: dt.datetime, col: str = PARTITION_COL) -> list[str]:
    """Remove the old folders of dates changed before that time, unless the table still reads them; their paths."""
    have = read_table(spark, f"{store.rstrip('/')}/retired")
    if have is None:
        return []
    gone = []
    for r in have.where(F.col("retired_at") < F.lit(before)).dropDuplicates(["location"]).orderBy("location").collect():
        if location_of(spark, table, r["date"], col) != r["location"]:
            delete_path(spark, r["location"])
            gone.append(r["location"])
    return gone
