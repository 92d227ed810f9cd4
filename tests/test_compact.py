"""Compaction of a date: few sorted files, every row once before, during and after."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cellroll.sinks import compact
from cellroll.sinks.compact import compact_dates, files_by_date, location_of, remove_retired
from cellroll.sinks.tables import append_partitioned, overwrite_partitions

LOW, HIGH = dt.date(2018, 8, 1), dt.date(2018, 8, 3)
LATER = dt.datetime(2999, 1, 1)


def rows(spark, low, high, days=2):
    return spark.range(low, high).select(F.col("id").alias("k"), (F.expr("date'2018-08-01'") + (F.col("id") % days).cast("int")).alias("date")).coalesce(1)


@pytest.fixture()
def table(spark):
    name = "compacted"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for i in range(9):
        append_partitioned(rows(spark, i * 10, i * 10 + 10), name)
    append_partitioned(rows(spark, 1000, 1001, days=1).withColumn("date", F.lit(HIGH)), name)
    yield name
    spark.sql(f"DROP TABLE {name}")


def keys(spark, name):
    return sorted(r.k for r in spark.table(name).collect())


def test_many_appends_become_few_sorted_files(spark, table, tmp_dir):
    want = keys(spark, table)
    before = {r.date: r.files for r in files_by_date(spark.table(table)).collect()}
    assert before == {LOW: 9, dt.date(2018, 8, 2): 9, HIGH: 1}
    assert compact_dates(spark, table, f"{tmp_dir}/store", LOW, HIGH, order_within=(F.col("k").desc(),)) == [LOW, dt.date(2018, 8, 2)]
    assert {r.date: r.files for r in files_by_date(spark.table(table)).collect()} == dict.fromkeys(before, 1)
    assert keys(spark, table) == want
    one = [r.k for r in spark.read.parquet(location_of(spark, table, LOW)).collect()]
    assert one == sorted(one, reverse=True)
    assert compact_dates(spark, table, f"{tmp_dir}/store", LOW, HIGH) == []


def test_a_query_planned_before_ends_with_every_row_once(spark, table, tmp_dir):
    want = keys(spark, table)
    reader = spark.table(table)
    files = reader.inputFiles()
    compact_dates(spark, table, f"{tmp_dir}/store", LOW, HIGH)
    # the files it was planned with are all still there
    assert sorted(r.k for r in spark.read.parquet(*files).collect()) == want
    gone = remove_retired(spark, table, f"{tmp_dir}/store", LATER)
    assert len(gone) == 2 and keys(spark, table) == want
    assert remove_retired(spark, table, f"{tmp_dir}/store", dt.datetime(2000, 1, 1)) == []


def test_appends_and_overwrites_after_it(spark, table, tmp_dir):
    compact_dates(spark, table, f"{tmp_dir}/store", LOW, HIGH)
    append_partitioned(rows(spark, 500, 510), table)
    assert keys(spark, table) == [*range(90), *range(500, 510), 1000]
    overwrite_partitions(rows(spark, 600, 603, days=1), table)
    assert sorted(r.k for r in spark.table(table).where(F.col("date") == F.lit(LOW)).collect()) == [600, 601, 602]
    assert compact_dates(spark, table, f"{tmp_dir}/store", LOW, HIGH, min_files=2) == [dt.date(2018, 8, 2)]
    remove_retired(spark, table, f"{tmp_dir}/store", LATER)
    assert keys(spark, table) == [*range(1, 90, 2), *range(501, 510, 2), 600, 601, 602, 1000]


def test_crash_before_the_change(spark, table, tmp_dir, monkeypatch):
    want = keys(spark, table)
    with monkeypatch.context() as m:
        m.setattr(compact, "location_of", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact_dates(spark, table, f"{tmp_dir}/store", LOW, HIGH)
    assert keys(spark, table) == want
    assert compact_dates(spark, table, f"{tmp_dir}/store", LOW, HIGH) and keys(spark, table) == want


def test_crash_between_two_dates(spark, table, tmp_dir, monkeypatch):
    """One date changed, the other listed as retired but still read: it is not removed."""
    want = keys(spark, table)
    real = compact._partition
    calls = []

    def second_fails(day, col):
        calls.append(day)
        if len(calls) == 4:  # two locations asked for, one change made
            raise RuntimeError("crash")
        return real(day, col)

    with monkeypatch.context() as m:
        m.setattr(compact, "_partition", second_fails)
        with pytest.raises(RuntimeError, match="crash"):
            compact_dates(spark, table, f"{tmp_dir}/store", LOW, HIGH)
    spark.catalog.refreshTable(table)
    assert keys(spark, table) == want
    assert len(remove_retired(spark, table, f"{tmp_dir}/store", LATER)) == 1
    assert keys(spark, table) == want


def test_rows_appended_meanwhile_keep_the_date_as_it_is(spark, table, tmp_dir, monkeypatch):
    real = compact._by_date

    def append_first(df, *args):
        out = real(df, *args)
        append_partitioned(rows(spark, 700, 701, days=1), table)
        return out

    monkeypatch.setattr(compact, "_by_date", append_first)
    assert compact_dates(spark, table, f"{tmp_dir}/store", LOW, HIGH) == [dt.date(2018, 8, 2)]
    assert keys(spark, table) == [*range(90), 700, 1000]


def test_folders_are_refused(spark, tmp_dir):
    with pytest.raises(ValueError, match="one step"):
        compact_dates(spark, f"{tmp_dir}/t", f"{tmp_dir}/store", LOW, HIGH)
