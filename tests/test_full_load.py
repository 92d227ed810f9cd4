"""End-to-end loads: publish, replay, late hours, duplicates, renamed cells, full width."""

import datetime as dt

import pytest

from cellroll.plans.full_load import LoadError, run_load
from cellroll.schema import cell_feed_spec, metric_names

from core_helpers import write_text

CSPEC = cell_feed_spec(["m1"])
QSPEC = cell_feed_spec(["q1"])


def _feed(tmp, name, hours_values, cell="CELL A", day="2018-08-01"):
    lines = [f"{day} {h:02d}:00:00,MBSC1,{cell},7,12,345,{v}" for h, v in hours_values]
    return write_text(f"{tmp}/{name}", lines, end=bool(lines))


def _load(spark, tmp, run, counter, qual, mode="ignore", on_error="raise"):
    c = _feed(tmp, f"{run}/counter.csv", counter)
    q = _feed(tmp, f"{run}/qual.csv", qual)
    return run_load(spark, c, q, counter_spec=CSPEC, qual_spec=QSPEC, hourly_path=f"{tmp}/hourly",
                    daily_path=f"{tmp}/daily", mode=mode, on_error=on_error)


def _hourly(spark, tmp):
    return sorted((r.resulttime.hour, r.m1, r.q1) for r in spark.read.parquet(f"{tmp}/hourly").collect())


def _daily(spark, tmp):
    return [(r.date, r.m1, r.q1) for r in spark.read.parquet(f"{tmp}/daily").collect()]


@pytest.mark.parametrize("mode,expect", [("ignore", 3.0), ("recompute", 7.0)])
def test_late_hours(spark, tmp_dir, mode, expect):
    _load(spark, tmp_dir, "r1", [(0, 1), (1, 2)], [(0, 0), (1, 0)], mode)
    rep = _load(spark, tmp_dir, "r2", [(1, 9), (2, 4)], [(1, 0), (2, 0)], mode)
    assert rep.hourly_appended == 1
    assert (rep.counter_lines, rep.qual_lines, rep.joined) == (2, 2, 2)
    assert [h[:2] for h in _hourly(spark, tmp_dir)] == [(0, 1.0), (1, 2.0), (2, 4.0)]
    assert _daily(spark, tmp_dir) == [(dt.date(2018, 8, 1), expect, 0.0)]


def test_replay_is_harmless(spark, tmp_dir):
    for run in ("r1", "r2"):
        _load(spark, tmp_dir, run, [(0, 1), (1, 2), (3, 5)], [(0, 1), (1, 1)])
    assert _hourly(spark, tmp_dir) == [(0, 1.0, 1.0), (1, 2.0, 1.0)]
    assert _daily(spark, tmp_dir) == [(dt.date(2018, 8, 1), 3.0, 2.0)]


def test_duplicate_key_in_feed(spark, tmp_dir):
    with pytest.raises(LoadError, match="duplicate"):
        _load(spark, tmp_dir, "r1", [(0, 1), (0, 5)], [(0, 1)])
    rep = _load(spark, tmp_dir, "r2", [(0, 5), (0, 1)], [(0, 1)], on_error="reject")
    assert rep.counter_duplicates == 2
    assert _hourly(spark, tmp_dir) == [(0, 1.0, 1.0)]


def test_bad_line_stops_before_publish(spark, tmp_dir):
    c = write_text(f"{tmp_dir}/c.csv", ["2018-08-01 00:00:00,MBSC1,CELL A,7,12,345,oops"])
    q = _feed(tmp_dir, "q.csv", [(0, 1)])
    with pytest.raises(Exception, match="bad line"):
        run_load(spark, c, q, counter_spec=CSPEC, qual_spec=QSPEC, hourly_path=f"{tmp_dir}/hourly",
                 daily_path=f"{tmp_dir}/daily")
    import os
    assert not os.path.exists(f"{tmp_dir}/hourly")


def test_renamed_cell_keeps_one_daily_row(spark, tmp_dir):
    c1 = [f"2018-08-01 0{h}:00:00,MBSC1,{name},7,12,345,{h + 1}" for h, name in ((0, "CELL B"), (1, "CELL A"))]
    c = write_text(f"{tmp_dir}/c.csv", c1)
    q = _feed(tmp_dir, "q.csv", [(0, 1), (1, 1)])
    run_load(spark, c, q, counter_spec=CSPEC, qual_spec=QSPEC, hourly_path=f"{tmp_dir}/hourly",
             daily_path=f"{tmp_dir}/daily")
    rows = spark.read.parquet(f"{tmp_dir}/daily").collect()
    assert [(r.cellname, r.m1) for r in rows] == [("CELL A", 2.0)]


def test_full_width_feed(spark, tmp_dir):
    cm = metric_names(291)
    qm = metric_names(88, "q")
    assert len(cm) == 291 and len(qm) == 88
    keys = "MBSC1,CELL A,7,12,345"
    c = write_text(f"{tmp_dir}/c.csv", [f"2018-08-01 0{h}:00:00,{keys}," + ",".join(str(h + j) for j in range(291))
                                         for h in range(3)])
    q = write_text(f"{tmp_dir}/q.csv", [f"2018-08-01 0{h}:00:00,{keys}," + ",".join(str(j) for j in range(88))
                                         for h in range(3)])
    run_load(spark, c, q, counter_spec=cell_feed_spec(cm), qual_spec=cell_feed_spec(qm),
             hourly_path=f"{tmp_dir}/hourly", daily_path=f"{tmp_dir}/daily")
    hourly = spark.read.parquet(f"{tmp_dir}/hourly")
    assert len(hourly.columns) == 7 + 379 + 1
    daily = spark.read.parquet(f"{tmp_dir}/daily").collect()
    assert len(daily) == 1
    r = daily[0]
    assert r[cm[0]] == 0 + 1 + 2 and r[cm[-1]] == 3 * 290 + 3 and r[qm[-1]] == 3 * 87.0


def test_load_with_no_matching_hours(spark, tmp_dir):
    for mode in ("ignore", "recompute"):
        rep = _load(spark, f"{tmp_dir}/{mode}", "r1", [(0, 1)], [(5, 1)], mode)
        assert rep.joined == 0 and rep.hourly_appended == 0


def test_rerun_after_crash_between_hourly_and_daily(spark, tmp_dir):
    from pyspark.sql import functions as F

    from cellroll.operators.combine import feed_join
    from cellroll.operators.publish import insert_ignore_into
    from cellroll.sources.feed import load_feed

    c = _feed(tmp_dir, "r1/counter.csv", [(0, 1), (1, 2)])
    q = _feed(tmp_dir, "r1/qual.csv", [(0, 0), (1, 0)])
    # the first attempt got as far as the hourly append, then died
    load = feed_join(load_feed(spark, c, CSPEC).rows, load_feed(spark, q, QSPEC).rows)
    insert_ignore_into(spark, load.withColumn("date", F.to_date("resulttime")), f"{tmp_dir}/hourly",
                       ["resulttime", "unique_id"])
    rep = run_load(spark, c, q, counter_spec=CSPEC, qual_spec=QSPEC, hourly_path=f"{tmp_dir}/hourly",
                   daily_path=f"{tmp_dir}/daily")
    assert rep.hourly_appended == 0 and rep.daily_appended == 1
    assert [h[:2] for h in _hourly(spark, tmp_dir)] == [(0, 1.0), (1, 2.0)]
    assert _daily(spark, tmp_dir) == [(dt.date(2018, 8, 1), 3.0, 0.0)]


def test_empty_feeds_load_as_empty(spark, tmp_dir):
    for counter, qual in (([], [(0, 1)]), ([(0, 1)], []), ([], [])):
        for mode in ("ignore", "recompute"):
            rep = _load(spark, f"{tmp_dir}/{len(counter)}{len(qual)}{mode}", "r1", counter, qual, mode)
            assert (rep.joined, rep.hourly_appended, rep.daily_appended) == (0, 0, 0)
    rep = _load(spark, f"{tmp_dir}/10ignore", "r2", [(0, 1)], [(0, 1)])
    assert rep.hourly_appended == 1


@pytest.mark.parametrize("days", [1, 2, 400])
def test_recompute_leaves_other_days(spark, tmp_dir, days):
    def lines(name, rows):
        return write_text(f"{tmp_dir}/{name}.csv", [f"{d} {h:02d}:00:00,MBSC1,CELL A,7,12,345,{v}" for d, h, v in rows])

    kw = dict(counter_spec=CSPEC, qual_spec=QSPEC, hourly_path=f"{tmp_dir}/hourly", daily_path=f"{tmp_dir}/daily")
    frozen = dt.date(2018, 8, 3)
    # published with one hour, then another hour reaches hourly only
    run_load(spark, lines("c0", [(frozen, 0, 1)]), lines("q0", [(frozen, 0, 0)]), **kw)
    run_load(spark, lines("c1", [(frozen, 1, 5)]), lines("q1", [(frozen, 1, 0)]), **kw)
    # the load spans dates on both sides of the frozen one
    touched = [dt.date(2018, 8, 1) + dt.timedelta(days=i) for i in range(days + 1)]
    touched = [d for d in touched if d != frozen][:days]
    if days == 2:
        touched = [dt.date(2018, 8, 1), dt.date(2018, 8, 9)]
    rows = [(d, 2, 7) for d in touched]
    rep = run_load(spark, lines("c2", rows), lines("q2", rows), mode="recompute", **kw)
    got = {r.date: r.m1 for r in spark.read.parquet(f"{tmp_dir}/daily").collect()}
    assert got == {frozen: 1.0, **{d: 7.0 for d in touched}} and rep.recomputed == days


def test_staging_is_removed_also_after_a_failure(spark, tmp_dir):
    import os

    from cellroll.plans.full_load import audit, reject_rows

    c, q = _feed(tmp_dir, "c.csv", [(0, 1), (0, 2)]), _feed(tmp_dir, "q.csv", [(0, 1)])
    kw = dict(counter_spec=CSPEC, qual_spec=QSPEC, hourly_path=f"{tmp_dir}/hourly", daily_path=f"{tmp_dir}/daily", work=f"{tmp_dir}/work")
    with pytest.raises(LoadError):
        run_load(spark, c, q, **kw)
    assert not os.path.exists(f"{tmp_dir}/work")
    rep = run_load(spark, c, q, on_error="reject", cleanup=False, **kw)
    assert rep.counter_duplicates == 2 and audit(spark, rep.work, CSPEC, QSPEC).count() == 1
    assert reject_rows(spark, f"{rep.work}/counter", CSPEC).count() == 0


def test_catalog_tables_as_targets(spark, tmp_dir):
    names = {"hourly_path": "load_hourly", "daily_path": "load_daily"}
    for t in names.values():
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    try:
        for run in range(2):
            rep = run_load(spark, _feed(tmp_dir, "c.csv", [(0, 1), (1, 2)]), _feed(tmp_dir, "q.csv", [(0, 1), (1, 1)]), counter_spec=CSPEC, qual_spec=QSPEC, **names)
            assert rep.hourly_appended == (2, 0)[run]
        assert spark.table("load_hourly").count() == 2 and spark.table("load_daily").first().m1 == 3.0
        run_load(spark, _feed(tmp_dir, "c2.csv", [(2, 4)]), _feed(tmp_dir, "q2.csv", [(2, 1)]), counter_spec=CSPEC, qual_spec=QSPEC, mode="recompute", **names)
        assert spark.table("load_daily").first().m1 == 7.0
    finally:
        for t in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {t}")
