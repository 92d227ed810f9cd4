"""Date-partitioned Parquet history tables.

A target is a path, or the name of a catalog table (anything without a
slash).  Layout: ``partitionBy('date')`` with rows sorted newest-first
inside each file, so readers that ask for recent hours prune whole date
directories and read few row groups.  Appends only add files; an overwrite
is only ever done per date (dynamic partition overwrite) and never on a
target the same plan reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

PARTITION_COL = "date"


class SchemaMismatch(ValueError):
    """Rows don't have the columns and types of the table they are meant for."""


def is_path(target: str) -> bool:
    return "/" in target


def table_exists(spark: SparkSession, target: str) -> bool:
    """True when the target holds data: a catalog table, or a folder with any entry that isn't hidden."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(target)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p)) and any(s.getPath().getName()[0] not in "._" for s in fs.listStatus(p))


def read_table(spark: SparkSession, target: str) -> DataFrame | None:
    """The target's rows, or None when nothing was written there yet; a target that can't be read raises."""
    if not table_exists(spark, target):
        return None
    return spark.read.parquet(target) if is_path(target) else spark.table(target)


def check_columns(df: DataFrame, target: DataFrame) -> None:
    """Raise unless ``df`` has exactly the target's columns with the target's types (in any order)."""
    want, have = dict(target.dtypes), dict(df.dtypes)
    wrong = [f"missing {c}" for c in want if c not in have] + [f"extra {c}" for c in have if c not in want]
    wrong += [f"{c} is {have[c]}, not {want[c]}" for c in want if c in have and have[c] != want[c]]
    if wrong:
        raise SchemaMismatch("rows don't fit the table: " + "; ".join(wrong))


def restrict_to(target: DataFrame, low, high, col: str = PARTITION_COL) -> DataFrame:
    """Target rows of the dates from ``low`` to ``high`` (literals reach PartitionFilters); None: no rows."""
    if low is None or high is None:
        return target.where(F.lit(False))
    return target.filter(F.col(col).between(F.lit(low), F.lit(high)))


def _by_date(df: DataFrame, order_within, col: str) -> DataFrame:
    """Rows brought together by date, without one task for a whole date.

    The rebalance hint lets Spark split the partition of a date that is much
    larger than the advisory size, and join small ones, so the number of
    files follows the data and not tasks times dates.
    """
    return df.hint("rebalance", col).sortWithinPartitions(col, *(order_within or ()))


def append_partitioned(df: DataFrame, target: str, order_within=None, col: str = PARTITION_COL) -> int:
    """Append ``df`` to the target by date; the columns must be the target's.  Returns the rows written."""
    spark = df.sparkSession
    have = read_table(spark, target)
    if have is not None:
        check_columns(df, have)
    if have is not None and not is_path(target):
        df = df.select(*have.columns)
    # observed on top of the plan: what lies below an empty exchange may be cut away at run time
    obs = Observation()
    out = _by_date(df, order_within, col).observe(obs, F.count(F.lit(1)).alias("n"))
    if is_path(target):
        out.write.mode("append").partitionBy(col).parquet(target)
    elif have is None:
        out.write.format("parquet").partitionBy(col).saveAsTable(target)
    else:
        out.write.insertInto(target)
    return int(obs.get["n"])


def overwrite_partitions(df: DataFrame, target: str, order_within=None, col: str = PARTITION_COL) -> None:
    """Replace only the dates present in ``df`` (dynamic partition overwrite)."""
    spark = df.sparkSession
    have = read_table(spark, target)
    if have is None:
        append_partitioned(df, target, order_within, col)
        return
    check_columns(df, have)
    out = _by_date(df, order_within, col)
    out = out.select(*have.columns)
    if is_path(target):
        out.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(col).parquet(target)
        return
    # the writer's option does not reach an insert into a catalog table
    key = "spark.sql.sources.partitionOverwriteMode"
    mode = spark.conf.get(key)
    try:
        spark.conf.set(key, "dynamic")
        out.write.insertInto(target, overwrite=True)
    finally:
        spark.conf.set(key, mode)


def write_staging(df: DataFrame, path: str, truncate: bool = True) -> None:
    """Write a loaded feed to a staging table; ``truncate`` replaces what was there.

    Never point ``path`` at a table the plan of ``df`` reads: an overwrite
    deletes the old files before the new ones are complete.
    """
    df.write.mode("overwrite" if truncate else "append").parquet(path)


def read_recent(spark: SparkSession, target: str, since, col: str = PARTITION_COL) -> DataFrame:
    """Rows of a date-partitioned table (path or name) from ``since`` (a date) on.

    The literal bound reaches PartitionFilters, so older date folders are not
    listed or read.
    """
    have = read_table(spark, target)
    if have is None:
        raise ValueError(f"{target} holds no rows yet")
    return have.filter(F.col(col) >= F.lit(since))
