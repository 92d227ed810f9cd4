"""Incremental loads from a manifest stream: order, replay, late hours."""

import datetime as dt

from cellroll.schema import cell_feed_spec
from cellroll.streaming.incremental import run_incremental, write_manifest

from core_helpers import write_text

CSPEC = cell_feed_spec(["m1"])
QSPEC = cell_feed_spec(["q1"])


def _pair(tmp, run, counter, qual):
    def feed(name, hv):
        return write_text(f"{tmp}/{run}/{name}.csv",
                          [f"2018-08-01 {h:02d}:00:00,MBSC1,CELL A,7,12,345,{v}" for h, v in hv])
    return feed("counter", counter), feed("qual", qual)


def test_manifest_stream_loads_in_order_and_replays_harmlessly(spark, tmp_dir):
    manifests = f"{tmp_dir}/manifests"
    write_manifest(spark, manifests, [_pair(tmp_dir, "r1", [(0, 1), (1, 2)], [(0, 0), (1, 0)])], 0)
    write_manifest(spark, manifests, [_pair(tmp_dir, "r2", [(1, 9), (2, 4)], [(1, 0), (2, 0)])], 1)
    kw = dict(counter_spec=CSPEC, qual_spec=QSPEC, hourly_path=f"{tmp_dir}/hourly", daily_path=f"{tmp_dir}/daily")
    reports = []
    run_incremental(spark, manifests, checkpoint=f"{tmp_dir}/ck", reports=reports, **kw)
    assert [e for e, _ in reports] == [0, 1]
    assert [r.hourly_appended for _, r in reports] == [2, 1]

    def state():
        hourly = sorted((r.resulttime.hour, r.m1) for r in spark.read.parquet(f"{tmp_dir}/hourly").collect())
        daily = [(r.date, r.m1) for r in spark.read.parquet(f"{tmp_dir}/daily").collect()]
        return hourly, daily

    first = state()
    assert first == ([(0, 1.0), (1, 2.0), (2, 4.0)], [(dt.date(2018, 8, 1), 3.0)])
    # same checkpoint: nothing new; fresh checkpoint: every manifest replayed, no change
    run_incremental(spark, manifests, checkpoint=f"{tmp_dir}/ck", **kw)
    run_incremental(spark, manifests, checkpoint=f"{tmp_dir}/ck2", **kw)
    assert state() == first


def test_a_manifest_of_any_length_in_its_order(spark, tmp_dir):
    from cellroll.streaming.incremental import _pairs

    pairs = [(f"c{i}", f"q{i}") for i in range(25_000)]
    write_manifest(spark, f"{tmp_dir}/m", pairs[:100], 0)
    write_manifest(spark, f"{tmp_dir}/m", pairs[100:], 1)
    batch = spark.read.text(f"{tmp_dir}/m").selectExpr("value", "_metadata.file_path as file")
    assert list(_pairs(batch)) == pairs
