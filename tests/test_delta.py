"""Daily totals from contributions: equal to a rebuild from the hours, at any order, replay or crash."""

import datetime as dt
import random

import pytest
from core_helpers import write_text

from cellroll.operators.rollup import daily_rows
from cellroll.plans import delta
from cellroll.plans.delta import PendingLoad, load_fingerprint, pending_loads, rebuild
from cellroll.plans.full_load import run_load
from cellroll.schema import cell_feed_spec

CSPEC, QSPEC = cell_feed_spec(["m1"]), cell_feed_spec(["q1"])


def write_pair(tmp, run, rows):
    """rows: (day, hour, cell, name, value); the qual value is 10 times the counter value."""
    def lines(factor):
        return [f"2018-08-{d:02d} {h:02d}:00:00,M,{name},7,12,{cell},{v * factor}" for d, h, cell, name, v in rows]
    return tuple(write_text(f"{tmp}/{run}/{n}.csv", lines(x), end=bool(rows)) for n, x in (("c", 1), ("q", 10)))


class Site:
    def __init__(self, spark, tmp):
        self.spark, self.tmp = spark, tmp
        self.kw = dict(counter_spec=CSPEC, qual_spec=QSPEC, hourly_path=f"{tmp}/hourly", daily_path=f"{tmp}/daily", ledger=f"{tmp}/ledger", mode="delta")

    def load(self, pair, **kw):
        return run_load(self.spark, *pair, **self.kw | kw)

    def daily(self):
        return sorted((r.date, r.unique_id, r.cellname, r.m1, r.q1) for r in self.spark.read.parquet(f"{self.tmp}/daily").collect())

    def from_hours(self):
        hours = self.spark.read.parquet(f"{self.tmp}/hourly").drop("date")
        return sorted((r.date, r.unique_id, r.cellname, r.m1, r.q1) for r in daily_rows(hours).collect())


def test_equal_to_a_rebuild_after_every_load(spark, tmp_dir):
    r = random.Random(6)
    site = Site(spark, tmp_dir)
    every = [(d, h, c, r.choice("AB"), r.randint(0, 50)) for d in (1, 2, 3) for h in range(6) for c in (345, 45)]
    r.shuffle(every)
    pairs = [write_pair(tmp_dir, f"r{i}", sorted(set(r.sample(every, 14)))) for i in range(4)]
    for pair in [pairs[0], pairs[1], pairs[0], pairs[2], pairs[3], pairs[1]]:
        site.load(pair)
        assert site.daily() == site.from_hours()
    assert pending_loads(spark, f"{tmp_dir}/ledger") == []


@pytest.mark.parametrize("step", ["append_partitioned", "merged_state", "daily_from_state"])
def test_crash_between_steps(spark, tmp_dir, monkeypatch, step):
    site = Site(spark, tmp_dir)
    site.load(write_pair(tmp_dir, "r0", [(1, 0, 345, "A", 1), (2, 0, 345, "A", 2)]))
    pair = write_pair(tmp_dir, "r1", [(1, 0, 345, "A", 9), (1, 1, 345, "A", 4), (3, 0, 45, "B", 8)])

    def crash(*args, **kw):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(delta, step, crash)
        with pytest.raises(RuntimeError, match="crash"):
            site.load(pair)
    assert len(pending_loads(spark, f"{tmp_dir}/ledger")) == 1
    with pytest.raises(PendingLoad):  # no other load begins before this one is whole
        site.load(write_pair(tmp_dir, "r2", [(4, 0, 345, "A", 1)]))
    site.load(pair)
    assert site.daily() == site.from_hours() and (dt.date(2018, 8, 1), 12345, "A", 5.0, 50.0) in site.daily()
    site.load(pair)
    assert site.daily() == site.from_hours() and pending_loads(spark, f"{tmp_dir}/ledger") == []


def test_rebuild_instead_of_the_pending_load(spark, tmp_dir, monkeypatch):
    site = Site(spark, tmp_dir)
    with monkeypatch.context() as m:
        m.setattr(delta, "merged_state", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            site.load(write_pair(tmp_dir, "r0", [(1, 0, 345, "A", 1), (2, 0, 345, "A", 2)]))
    low = dt.date(2018, 8, 1)
    rebuild(spark, f"{tmp_dir}/hourly", f"{tmp_dir}/daily", f"{tmp_dir}/ledger", low, low)
    assert len(pending_loads(spark, f"{tmp_dir}/ledger")) == 1  # it reaches beyond these dates
    rebuild(spark, f"{tmp_dir}/hourly", f"{tmp_dir}/daily", f"{tmp_dir}/ledger", low, dt.date(2018, 8, 2))
    assert pending_loads(spark, f"{tmp_dir}/ledger") == [] and site.daily() == site.from_hours()
    site.load(write_pair(tmp_dir, "r1", [(2, 5, 345, "A", 3)]))
    assert site.daily() == site.from_hours()


def test_hours_are_not_read_again(spark, tmp_dir, monkeypatch):
    """The merge reads the pending contribution and the state; of hourly only keys are asked for."""
    site = Site(spark, tmp_dir)
    site.load(write_pair(tmp_dir, "r0", [(1, 0, 345, "A", 1)]))
    plans = []
    real = delta.overwrite_partitions
    monkeypatch.setattr(delta, "overwrite_partitions", lambda df, *a: (plans.append(sorted(df.inputFiles())), real(df, *a)))
    asked = []
    keys = delta.new_keys
    monkeypatch.setattr(delta, "new_keys", lambda new, have, *a: (asked.append(have.select("resulttime", "unique_id")._jdf.queryExecution().executedPlan().toString()), keys(new, have, *a))[1])
    site.load(write_pair(tmp_dir, "r1", [(1, 1, 345, "A", 2)]))
    assert plans and not any("/hourly/" in f for files in plans for f in files)
    assert "ReadSchema: struct<resulttime:timestamp_ntz,unique_id:int>" in asked[0] and "PartitionFilters: [isnotnull(date" in asked[0]


def test_fingerprint(spark, tmp_dir):
    a, b = write_pair(tmp_dir, "r0", [(1, 0, 345, "A", 1)])
    one = load_fingerprint(spark, a, b)
    assert one == load_fingerprint(spark, [a], b) != load_fingerprint(spark, b, a)
    write_pair(tmp_dir, "r0", [(1, 0, 345, "A", 77)])
    assert load_fingerprint(spark, a, b) != one


def test_modes(spark, tmp_dir):
    site = Site(spark, tmp_dir)
    pair = write_pair(tmp_dir, "r0", [])
    for wrong in (dict(ledger=None), dict(mode="recompute")):
        with pytest.raises(ValueError, match="ledger"):
            site.load(pair, **wrong)
    assert site.load(pair).hourly_appended == 0  # an empty load
