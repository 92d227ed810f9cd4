"""Cells over time, and the newest rows of each."""

import datetime as dt

from pyspark.sql import functions as F

from cellroll.operators.cells import as_of, cell_intervals, collision_history, conflict_names, refresh_intervals
from cellroll.operators.newest import newest_rows
from cellroll.sinks.tables import append_partitioned

DIMS = ["mbsc", "cellname", "cellindex", "lac", "ci"]


def t(day, hour=0):
    return dt.datetime(2018, 8, day, hour)


def hours(spark, rows):
    """(key, time, name, lac, ci) rows."""
    return spark.createDataFrame([(x, k, "M", n, 1, a, b) for k, x, n, a, b in rows], "resulttime timestamp_ntz, unique_id int, mbsc string, cellname string, cellindex int, lac int, ci int")


HISTORY = [(1, t(1, 0), "A", 12, 3), (1, t(1, 1), "A", 12, 3), (1, t(2, 5), "B", 12, 3), (1, t(3), "A", 12, 3), (2, t(1), None, 4, 5), (2, t(2), None, 4, 5), (12345, t(1), "X", 12, 345), (12345, t(4), "Y", 123, 45)]


def shown(intervals):
    return sorted((r.unique_id, r.valid_from, r.cellname or "", r.valid_to, r.last_seen, r.hours) for r in intervals.collect())


def test_intervals(spark):
    assert shown(cell_intervals(hours(spark, HISTORY))) == [
        (1, t(1, 0), "A", t(2, 5), t(1, 1), 2), (1, t(2, 5), "B", t(3), t(2, 5), 1), (1, t(3), "A", None, t(3), 1),
        (2, t(1), "", None, t(2), 2), (12345, t(1), "X", t(4), t(1), 1), (12345, t(4), "Y", None, t(4), 1)]


def test_late_hours_split_a_stretch_and_other_keys_stay(spark):
    all_hours = [*HISTORY, (1, t(1, 0) + dt.timedelta(minutes=30), "C", 12, 3)]
    load = hours(spark, all_hours[-1:])
    known = cell_intervals(hours(spark, HISTORY)).withColumn("hours", F.col("hours") + F.when(F.col("unique_id") == 2, 100).otherwise(0))
    got = shown(refresh_intervals(known, load, hours(spark, all_hours)))
    assert [x[:3] for x in got if x[0] == 1] == [(1, t(1, 0), "A"), (1, t(1, 0) + dt.timedelta(minutes=30), "C"), (1, t(1, 1), "A"), (1, t(2, 5), "B"), (1, t(3), "A")]
    assert [x[5] for x in got if x[0] == 2] == [102]  # not cut anew
    assert shown(refresh_intervals(None, load, hours(spark, all_hours)))[0][0] == 1


def test_as_of(spark):
    asked = spark.createDataFrame([(1, t(1, 0), "c"), (1, t(2, 4), "c"), (1, t(2, 5), "c"), (1, t(9), "c"), (1, dt.datetime(2018, 7, 1), "c"), (9, t(1), "c")], "unique_id int, resulttime timestamp_ntz, cellname string")
    got = as_of(asked, cell_intervals(hours(spark, HISTORY)), ["cellname"], prefix="old_")
    assert got.columns == ["unique_id", "resulttime", "cellname", "old_cellname"]
    assert sorted((r.unique_id, r.resulttime, r.old_cellname or "") for r in got.collect()) == [
        (1, dt.datetime(2018, 7, 1), ""), (1, t(1, 0), "A"), (1, t(2, 4), "A"), (1, t(2, 5), "B"), (1, t(9), "A"), (9, t(1), "")]


def test_conflicts_and_collisions(spark):
    rows = hours(spark, [*HISTORY, (1, t(2, 7), "A", 12, 3)])
    got = sorted((r.date, r.unique_id, r.cellname, r.first_hour, r.last_hour, r.hours) for r in conflict_names(rows).collect())
    assert got == [(dt.date(2018, 8, 2), 1, "A", t(2, 7), t(2, 7), 1), (dt.date(2018, 8, 2), 1, "B", t(2, 5), t(2, 5), 1)]
    got = sorted((r.unique_id, r.lac, r.ci, r.valid_from, r.last_seen) for r in collision_history(cell_intervals(rows)).collect())
    assert got == [(12345, 12, 345, t(1), t(1)), (12345, 123, 45, t(4), t(4))]


def table(spark, path, days=40):
    rows = spark.range(days * 24).selectExpr("cast(id div 24 as int) as day", "cast(id % 24 as int) as hour")
    # cell 0 every hour, cell 1 once a day, cell 2 in the first five days only
    rows = rows.selectExpr("timestamp_ntz'2018-08-01 00:00:00' + make_dt_interval(day, hour) as resulttime", "explode(filter(array(0, 1, 2), c -> c = 0 or (c = 1 and hour = 3) or (c = 2 and day < 5))) as unique_id", "hour as v")
    append_partitioned(rows.withColumn("date", F.to_date("resulttime")), path)
    return rows


def expected(rows, cells, k):
    every = sorted(((r.unique_id, r.resulttime) for r in rows.collect()), key=lambda x: x[1], reverse=True)
    return sorted(x for c in cells for x in [y for y in every if y[0] == c][:k])


def test_newest_rows_open_only_the_dates_they_need(spark, tmp_dir):
    rows = table(spark, f"{tmp_dir}/t")
    for cells, k, most in (([0], 3, 1), ([0, 1], 3, 3), ([0, 1], 4, 7), ([0, 1, 2], 2, 40), ([2, 2, 99], 1000, 40)):
        opened = []
        asked = spark.createDataFrame([(c,) for c in cells], "unique_id int")
        got = newest_rows(spark, f"{tmp_dir}/t", asked, k, opened=opened)
        assert sorted((r.unique_id, r.resulttime) for r in got.collect()) == expected(rows, dict.fromkeys(cells), k)
        assert len(opened) == most and opened == sorted(opened, reverse=True)


def test_newest_rows_of_a_named_table(spark, tmp_dir):
    spark.sql("DROP TABLE IF EXISTS newest_hours")
    rows = table(spark, "newest_hours", days=3)
    got = newest_rows(spark, "newest_hours", spark.createDataFrame([(1,)], "unique_id int"), 2)
    assert sorted((r.unique_id, r.resulttime) for r in got.collect()) == expected(rows, [1], 2)
    spark.sql("DROP TABLE newest_hours")
