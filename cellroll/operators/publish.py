"""Insert-if-absent publication (``insert ... on conflict do nothing``).

Semantics: among incoming rows with one key the first in a stated order is
kept (``first_wins``); a key already present in the target is never
replaced (``new_only``); the survivors are appended.  Re-applying a load is
therefore a no-op.

Scale notes:
* ``first_wins`` is ``row_number() == 1`` over the key; Catalyst turns it
  into a partial WindowGroupLimit before the shuffle, so a key that holds a
  third of the rows sends one row per map task, not the whole group.
* ``insert_ignore_into`` decides on key columns: the load's keys are joined
  once with the target's keys (only the dates the load spans are read), and
  the keys that are new are written to a scratch folder (removed at the end).  With no new key
  nothing is written; with no clash the wide rows are appended as they are;
  otherwise they are joined with the written keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path
from ..sinks.sketches import add_to_sketch, build_sketch, maybe_there
from ..sinks.tables import PARTITION_COL, append_partitioned, check_columns, read_table, restrict_to, table_exists

# up to so many dates are named one by one to the scan, more as a range
NAMED_DATES = 366


def _order_cols(df: DataFrame, keys, order_by) -> list[Column]:
    if order_by is None:
        order_by = [c for c in df.columns if c not in set(keys)]
    out = []
    for c in order_by:
        out.append(c if isinstance(c, Column) else F.col(c).asc_nulls_last())
    return out


def first_wins(df: DataFrame, keys, order_by=None) -> DataFrame:
    """One row per key: the first by ``order_by`` (default: every other
    column ascending, NULLs last), so the survivor is deterministic."""
    keys = list(keys)
    order = _order_cols(df, keys, order_by)
    if not order:
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def new_only(new: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Rows of ``new`` whose key is absent from ``target`` (one LeftAnti)."""
    keys = list(keys)
    return new.join(target.select(*keys), keys, "left_anti")


def insert_ignore(target: DataFrame, new: DataFrame, keys, order_by=None) -> DataFrame:
    """Pure form: the target after ``insert into target select new on conflict do nothing``."""
    added = new_only(first_wins(new, keys, order_by), target, keys)
    return target.unionByName(added.select(*target.columns))


def new_keys(keys_of_load: DataFrame, existing: DataFrame, keys, path: str | None = None) -> tuple[DataFrame, int, int]:
    """The load's keys that the target lacks, written once; with their number and the number of the others.

    ``path``: where they are written, for the caller to remove (default: a fresh scratch folder).
    """
    keys = list(keys)
    spark = keys_of_load.sparkSession
    path = path or scratch_path(spark, "keys")
    left = keys_of_load.select(*keys).distinct()
    mark = existing.select(*keys, F.lit(True).alias("_there")).distinct()
    obs = Observation()
    joined = left.join(mark, keys, "left").observe(obs, F.count(F.lit(1)).alias("n"), F.count("_there").alias("there"))
    joined.where(F.col("_there").isNull()).select(*keys).write.parquet(path)
    n, there = int(obs.get["n"]), int(obs.get["there"])
    return spark.read.schema(left.schema).parquet(path), n - there, there


def clashing_keys(new: DataFrame, target: DataFrame, sketch: DataFrame, keys, path: str,
                  partition_col: str = PARTITION_COL) -> tuple[DataFrame, int]:
    """The keys of ``new`` that the target holds, written once below ``path``, and their number.

    The sketch says which may be there; only their dates are read, by key columns.
    """
    keys = list(keys)
    spark = new.sparkSession
    maybe = maybe_there(new, sketch, keys, partition_col)
    maybe.write.parquet(f"{path}/maybe")
    maybe = spark.read.schema(maybe.schema).parquet(f"{path}/maybe")
    dates = [r[0] for r in maybe.select(partition_col).distinct().limit(NAMED_DATES + 1).collect()]
    if not dates:
        return maybe.select(*keys), 0
    if len(dates) > NAMED_DATES:
        low, high = maybe.agg(F.min(partition_col), F.max(partition_col)).first()
        rows = restrict_to(target, low, high, partition_col)
    else:
        rows = target.where(F.col(partition_col).isin(dates))
    obs = Observation()
    there = maybe.select(*keys).join(rows.select(*keys), keys, "left_semi").observe(obs, F.count(F.lit(1)).alias("n"))
    there.write.parquet(f"{path}/there")
    return spark.read.schema(there.schema).parquet(f"{path}/there"), int(obs.get["n"])


def insert_ignore_into(spark: SparkSession, new: DataFrame, target: str, keys, *, order_by=None,
                       order_within=None, partition_col: str = PARTITION_COL, dedup: bool = True,
                       span=None, sketch: str | None = None) -> dict:
    """Append the absent rows of ``new`` to the date-partitioned table ``target`` (path or name).

    ``new`` must carry ``partition_col`` and have the target's columns.
    ``dedup=False`` skips the first-wins pass when the keys of ``new`` are
    already known to be unique.  ``span``: (first date, last date) of
    ``new`` when the caller knows them (else they are computed).  Returns
    the rows appended (observed during the write) and the keys that already
    existed.  Safe to repeat: a second run appends nothing.

    ``sketch``: folder of the table's key sketch (``sinks.sketches``), made
    here if it is missing; only dates in which a key of ``new`` may be are read.
    """
    keys = list(keys)
    have = read_table(spark, target)
    cand = first_wins(new, keys, order_by) if dedup else new
    if have is None:
        if sketch is not None:
            add_to_sketch(cand, sketch, keys, partition_col)
        return {"appended": append_partitioned(cand, target, order_within, partition_col), "existing_keys": 0}
    check_columns(new, have)
    if span is None:
        r = new.agg(F.min(partition_col), F.max(partition_col)).first()
        span = (r[0], r[1])
    path = scratch_path(spark, "keys")
    try:
        if sketch is not None:
            if not table_exists(spark, sketch):
                build_sketch(spark, target, sketch, keys, col=partition_col)
            there, clashing = clashing_keys(new, have, restrict_to(read_table(spark, sketch), *span, partition_col), keys, path, partition_col)
            if clashing:
                cand = cand.join(there, keys, "left_anti")
            add_to_sketch(cand, sketch, keys, partition_col)
            return {"appended": append_partitioned(cand, target, order_within, partition_col), "existing_keys": clashing}
        fresh, n_fresh, clashing = new_keys(new, restrict_to(have, *span, partition_col), keys, path)
        if not n_fresh:
            return {"appended": 0, "existing_keys": clashing}
        if clashing:
            # a key with a NULL equals no other, so such rows are new; it must find itself here
            same = [cand[k].eqNullSafe(fresh[k]) for k in keys]
            cand = cand.join(fresh, same, "left_semi")
        return {"appended": append_partitioned(cand, target, order_within, partition_col), "existing_keys": clashing}
    finally:
        delete_path(spark, path)
