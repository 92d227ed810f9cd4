"""Ledger of loads: done ones are skipped unread, half-published ones made whole, totals by file."""

import os

import pytest
from test_delta import CSPEC, QSPEC, write_pair

from cellroll.plans import full_load, ledger
from cellroll.plans.full_load import run_load
from cellroll.plans.ledger import UnfinishedLoad, finish_loads, forget_load, loaded_files, run_once, unfinished_loads


class Site:
    def __init__(self, spark, tmp):
        self.spark, self.tmp, self.loads = spark, tmp, f"{tmp}/loads"
        self.kw = dict(counter_spec=CSPEC, qual_spec=QSPEC, hourly_path=f"{tmp}/hourly", daily_path=f"{tmp}/daily")

    def once(self, pair, **kw):
        return run_once(self.spark, *pair, loads=self.loads, **self.kw | kw)

    def rows(self, name):
        return sorted(tuple(r) for r in self.spark.read.parquet(f"{self.tmp}/{name}").collect())

    def unfinished(self):
        return [r.load for r in unfinished_loads(self.spark, self.loads).collect()]


def test_a_done_load_is_skipped_unread(spark, tmp_dir, monkeypatch):
    site = Site(spark, tmp_dir)
    pair = write_pair(tmp_dir, "r0", [(1, 0, 345, "A", 1), (1, 1, 345, "A", 2)])
    first, skipped = site.once(pair)
    assert not skipped and (first.joined, first.hourly_appended, first.daily_appended) == (2, 2, 1)
    files = sorted((r.feed, os.path.basename(r.file), r.lines, r.rejects) for r in loaded_files(spark, site.loads).collect())
    assert files == [("counter", "c.csv", 2, 0), ("qual", "q.csv", 2, 0)]
    before = site.rows("hourly"), site.rows("daily")
    with monkeypatch.context() as m:
        m.setattr(ledger, "run_load", lambda *a, **kw: 1 / 0)
        again, skipped = site.once(pair)
    assert skipped and again == first and (site.rows("hourly"), site.rows("daily")) == before
    # new content is another load
    write_pair(tmp_dir, "r0", [(1, 0, 345, "A", 1), (2, 1, 345, "A", 77)])
    assert site.once(pair)[1] is False and len(site.rows("hourly")) == 3


@pytest.mark.parametrize("mode", ["ignore", "recompute"])
def test_a_half_published_load_is_finished(spark, tmp_dir, monkeypatch, mode):
    """Crash after hourly, before daily: no other load may come first; then all is as without the crash."""
    site = Site(spark, tmp_dir)
    one = write_pair(tmp_dir, "r0", [(1, 0, 345, "A", 1), (2, 0, 45, "B", 5)])
    two = write_pair(tmp_dir, "r1", [(1, 1, 345, "A", 4), (1, 0, 345, "A", 9)])
    with monkeypatch.context() as m:
        m.setattr(full_load, "daily_rows", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            site.once(one, mode=mode)
    assert len(site.rows("hourly")) == 2 and len(site.unfinished()) == 1
    with pytest.raises(UnfinishedLoad):
        site.once(two, mode=mode)
    (rep,) = finish_loads(spark, loads=site.loads, **site.kw)
    assert rep.joined == 2 and site.unfinished() == []
    site.once(two, mode=mode)
    plain = f"{tmp_dir}/plain"
    for pair in (one, two):
        run_load(spark, *pair, **site.kw | dict(hourly_path=f"{plain}/hourly", daily_path=f"{plain}/daily"), mode=mode)
    assert site.rows("hourly") == site.rows("plain/hourly") and site.rows("daily") == site.rows("plain/daily")


def test_forget(spark, tmp_dir):
    site = Site(spark, tmp_dir)
    pair = write_pair(tmp_dir, "r0", [(1, 0, 345, "A", 1), (1, 0, 345, "A", 1)])
    with pytest.raises(full_load.LoadError):
        site.once(pair)
    (load,) = site.unfinished()
    forget_load(spark, site.loads, load)
    rep, skipped = site.once(write_pair(tmp_dir, "r1", []))
    assert not skipped and rep.joined == 0 and loaded_files(spark, site.loads).count() == 0
    assert site.once(write_pair(tmp_dir, "r2", [(1, 0, 345, "A", 1)]), on_error="reject")[0].hourly_appended == 1
