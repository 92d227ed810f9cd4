"""Feeds that arrive in any order, paired through the backlog."""

import datetime as dt
import itertools
import os

import pytest
from core_helpers import write_text

from cellroll.plans import full_load
from cellroll.plans.full_load import LoadError
from cellroll.schema import cell_feed_spec
from cellroll.streaming import backlog as bl
from cellroll.streaming.backlog import backlog_report, load_arrivals, read_backlog, run_backlog

CSPEC = cell_feed_spec(["m1"])
QSPEC = cell_feed_spec(["q1"])
DAY = dt.date(2018, 8, 1)


def line(hour, value, day=1, ci=345):
    return f"2018-08-{day:02d} {hour:02d}:00:00,MBSC1,CELL A,7,12,{ci},{value}"


class Site:
    def __init__(self, spark, tmp, counter_spec=CSPEC, qual_spec=QSPEC):
        self.spark, self.tmp = spark, tmp
        self.kw = dict(counter_spec=counter_spec, qual_spec=qual_spec, hourly_path=f"{tmp}/hourly", daily_path=f"{tmp}/daily", backlog=f"{tmp}/backlog")
        self.files = itertools.count()
        for feed in ("counter", "qual"):
            write_text(f"{tmp}/{feed}/.keep", [])

    def put(self, feed, *lines):
        write_text(f"{self.tmp}/{feed}/in{next(self.files)}/x.csv", lines)

    def run(self, **kw):
        reports = []
        run_backlog(self.spark, f"{self.tmp}/counter", f"{self.tmp}/qual", checkpoint=f"{self.tmp}/ck", reports=reports, **self.kw | kw)
        return [r for _, r in reports]

    def hourly(self):
        return sorted((r.resulttime.day, r.resulttime.hour, r.m1, r.q1) for r in self.spark.read.parquet(self.kw["hourly_path"]).collect())

    def daily(self):
        return sorted((r.date, r.m1, r.q1) for r in self.spark.read.parquet(self.kw["daily_path"]).collect())

    def waiting(self, feed):
        spec = self.kw[f"{feed}_spec"]
        return sorted((r.resulttime.hour, r[-1]) for r in read_backlog(self.spark, self.kw["backlog"], feed, spec).select("resulttime", spec.column_names[-1]).collect())


def test_partners_come_days_apart(spark, tmp_dir):
    site = Site(spark, tmp_dir)
    site.put("counter", line(0, 1), line(1, 2))
    first = site.run()[0]
    assert (first.joined, first.counter_waiting, first.qual_waiting) == (0, 2, 0) and site.waiting("counter") == [(0, 1.0), (1, 2.0)]
    site.put("qual", line(1, 20), line(2, 30))
    second = site.run()[0]
    assert (second.joined, second.hourly_appended, second.counter_waiting, second.qual_waiting) == (1, 1, 1, 1)
    assert site.hourly() == [(1, 1, 2.0, 20.0)] and site.daily() == [(DAY, 2.0, 20.0)]
    # the rest, and files that were sent before, some with other values
    site.put("counter", line(2, 3), line(1, 99), line(0, 1))
    site.put("qual", line(0, 10), line(2, 77))
    third = site.run()[0]
    assert (third.hourly_appended, third.counter_waiting, third.qual_waiting) == (2, 0, 0)
    # the earliest row of a key counts
    assert site.hourly() == [(1, 0, 1.0, 10.0), (1, 1, 2.0, 20.0), (1, 2, 3.0, 30.0)]
    assert site.daily() == [(DAY, 6.0, 60.0)]


def test_replay_changes_nothing(spark, tmp_dir):
    site = Site(spark, tmp_dir)
    site.put("counter", line(0, 1), line(1, 2))
    site.run()
    site.put("qual", line(0, 10))
    site.run()
    before = site.hourly(), site.daily(), site.waiting("counter"), site.waiting("qual")
    site.put("counter", line(0, 5))  # published before
    assert site.run()[0].hourly_appended == 0
    assert (site.hourly(), site.daily(), site.waiting("counter"), site.waiting("qual")) == before
    # all files once more, under a new checkpoint and a new backlog
    run_backlog(spark, f"{tmp_dir}/counter", f"{tmp_dir}/qual", checkpoint=f"{tmp_dir}/ck2", **site.kw | {"backlog": f"{tmp_dir}/backlog2"}, on_error="reject")
    assert (site.hourly(), site.daily()) == before[:2]
    assert [(r.resulttime.hour, r.m1) for r in read_backlog(spark, f"{tmp_dir}/backlog2", "counter", CSPEC).collect()] == [(1, 2.0)]


@pytest.mark.parametrize("step", ["publish", "backlog"])
def test_crash_between_steps(spark, tmp_dir, monkeypatch, step):
    site = Site(spark, tmp_dir)
    site.put("counter", line(0, 1), line(1, 2), line(2, 3))
    site.run()
    site.put("qual", line(0, 10), line(1, 20), line(5, 50))

    def crash(*args, **kw):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        if step == "publish":  # hourly is written, daily isn't
            m.setattr(full_load, "overwrite_partitions", crash)
        else:  # published, no next backlog
            m.setattr(bl, "_keep_waiting", crash)
        with pytest.raises(Exception, match="crash"):
            site.run()
    assert site.hourly() == [(1, 0, 1.0, 10.0), (1, 1, 2.0, 20.0)]
    rep = site.run()[0]
    assert (rep.joined, rep.hourly_appended, rep.counter_waiting, rep.qual_waiting) == (2, 0, 1, 1)
    assert site.daily() == [(DAY, 3.0, 30.0)] and site.waiting("counter") == [(2, 3.0)] and site.waiting("qual") == [(5, 50.0)]


def test_a_half_written_version_does_not_count(spark, tmp_dir):
    site = Site(spark, tmp_dir)
    site.put("counter", line(0, 1))
    site.run()
    write_text(f"{tmp_dir}/backlog/batch=7/qual/_SUCCESS", [])
    assert site.waiting("counter") == [(0, 1.0)]
    report = [tuple(r) for r in backlog_report(spark, f"{tmp_dir}/backlog", CSPEC, QSPEC).collect()]
    assert report == [("counter", DAY, 1, 0)]


def test_two_versions_are_kept(spark, tmp_dir):
    import os

    site = Site(spark, tmp_dir)
    for hour in range(4):
        site.put("counter", line(hour, hour))
        site.run()
    kept = sorted(n for n in os.listdir(f"{tmp_dir}/backlog"))
    assert kept == ["batch=2", "batch=3"] and len(site.waiting("counter")) == 4


def test_duplicates_and_bad_lines_of_one_batch(spark, tmp_dir):
    site = Site(spark, tmp_dir)
    site.put("counter", line(0, 2), line(0, 1), "short,line")
    site.put("qual", line(0, 9))
    with pytest.raises(Exception, match="arity"):
        site.run()
    rep = site.run(on_error="reject")[0]
    assert (rep.counter_rejects, rep.counter_duplicates, rep.hourly_appended) == (1, 2, 1) and site.hourly() == [(1, 0, 1.0, 9.0)]
    lines = [spark.createDataFrame([(line(3, 1), "f"), (line(3, 2), "f")], "value string, source_file string")] * 2
    with pytest.raises(LoadError, match="duplicate"):
        load_arrivals(spark, *lines, 9, **site.kw)


def test_headers_in_a_stream(spark, tmp_dir):
    site = Site(spark, tmp_dir, CSPEC.with_options(header=True), QSPEC.with_options(header=True))
    for feed, value in (("counter", 1), ("qual", 2)):
        for hour in range(3):
            site.put(feed, "resulttime,mbsc,cellname,cellindex,lac,ci,x", line(hour, value), line(hour + 10, value))
    assert sum(r.hourly_appended for r in site.run(max_files_per_trigger=2)) == 6
    assert site.daily() == [(DAY, 6.0, 12.0)]


def test_rows_without_backlog_and_repeats_are_not_moved(spark, tmp_dir):
    schema = CSPEC.schema()
    at = dt.datetime(2018, 8, 1)
    row = lambda hour, name, m: (at + dt.timedelta(hours=hour), 12345, "MBSC1", name, 7, 12, 345, m)
    frame = lambda *rows: spark.createDataFrame(list(rows), schema)
    old = lambda *rows: spark.createDataFrame([(0, *r) for r in rows], bl._schema(CSPEC))
    found = lambda df: sorted((r._batch, r.resulttime.hour, r.cellname, r.m1) for r in df.collect())

    rows, again = bl._arrived(frame(row(0, "A", 1.0), row(1, "A", 2.0)), old(), 3, "counter", "raise", f"{tmp_dir}/none")
    assert again == 0 and found(rows) == [(3, 0, "A", 1.0), (3, 1, "A", 2.0)] and not os.path.exists(f"{tmp_dir}/none")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    # the backlog's row is the earlier one, whatever the other columns say; repeats among the new rows are resolved
    new = frame(row(0, "A", 0.0), row(1, "B", 2.0), row(1, "A", 2.0), row(2, "A", 3.0))
    rows, again = bl._arrived(new, old(row(0, "Z", 9.0)), 3, "counter", "reject", f"{tmp_dir}/both")
    assert again == 2 and found(rows) == [(0, 0, "Z", 9.0), (3, 1, "A", 2.0), (3, 2, "A", 3.0)]
    assert rows._jdf.queryExecution().executedPlan().toString().count("Window") == 0
    with pytest.raises(LoadError):
        bl._arrived(new, old(), 3, "counter", "raise", f"{tmp_dir}/no")
