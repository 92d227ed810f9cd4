"""The newest rows of every cell, from a date-partitioned history, without reading all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import KEY_COL, TIME_COL
from ..session import delete_path, scratch_path
from ..sinks.tables import PARTITION_COL, read_table


def newest_rows(spark: SparkSession, target: str, cells: DataFrame, k: int = 1, *, key: str = KEY_COL, time_col: str = TIME_COL,
                date_col: str = PARTITION_COL, first_dates: int = 1, opened: list | None = None) -> DataFrame:
    """The ``k`` newest rows of each key in ``cells`` (a column ``key``; repeats count once), newest date first.

    Dates are opened in steps of 1, 2, 4, ... until every cell has its k rows or no date is left; each step
    reads its dates only, for the cells that still lack rows.  So a step costs at most about as much as all
    before it, and a cell that died long ago decides how far back the last steps go.  ``target``: path or
    name; ``opened`` receives the dates that were read.  Rows of one cell and hour are ordered by their other
    columns' text, so the result is the same at every run.
    """
    table = read_table(spark, target)
    if table is None:
        raise ValueError(f"{target} holds no rows yet")
    # distinct folders: answered from the file listing, no row is read
    dates = [r[0] for r in table.select(date_col).distinct().orderBy(F.desc(date_col)).collect()]
    work = scratch_path(spark, "newest")
    lacking = cells.select(key).distinct().withColumn("_lacks", F.lit(k))
    lacking.write.parquet(f"{work}/lacking-0")
    lacking = spark.read.schema(lacking.schema).parquet(f"{work}/lacking-0")
    found, step, size = [], 0, first_dates
    rest = [c for c in table.columns if c not in (key, time_col)]
    order = Window.partitionBy(key).orderBy(F.desc(time_col), F.to_json(F.struct(*rest)))
    while dates:
        now, dates, size, step = dates[:size], dates[size:], size * 2, step + 1
        if opened is not None:
            opened += now
        rows = table.where(F.col(date_col).between(F.lit(now[-1]), F.lit(now[0]))).join(lacking, key)
        # k is the most that any cell lacks: rows beyond it go before the shuffle
        rows = rows.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= k).where("_nth <= _lacks").drop("_nth")
        schema = rows.drop("_lacks").schema
        rows.drop("_lacks").write.parquet(f"{work}/rows-{step}")
        rows = spark.read.schema(schema).parquet(f"{work}/rows-{step}")
        found.append(rows)
        got = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_got"))
        after = lacking.join(got, key, "left").select(key, (F.col("_lacks") - F.coalesce("_got", F.lit(0))).cast("int").alias("_lacks")).where("_lacks > 0")
        after.write.parquet(f"{work}/lacking-{step}")
        lacking = spark.read.schema(after.schema).parquet(f"{work}/lacking-{step}")
        if lacking.limit(1).count() == 0:
            break
    delete_path(spark, f"{work}/lacking-0")
    if not found:
        return table.where(F.lit(False))
    out = found[0]
    for rows in found[1:]:
        out = out.unionByName(rows)
    return out.select(*table.columns)
