"""Key sketches: no key of the table is missed, dates without one are not opened."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cellroll.operators import publish
from cellroll.operators.publish import insert_ignore_into
from cellroll.sinks import sketches
from cellroll.sinks.sketches import build_sketch, maybe_there, sketch_rows
from cellroll.sinks.tables import append_partitioned

KEYS = ["k", "t"]


def rows(spark, low, high, days=5, value=0):
    day = F.expr("date'2018-08-01'") + (F.col("id") % days).cast("int")
    return spark.range(low, high).select(day.alias("date"), F.col("id").alias("k"), (F.col("id") % 24).cast("int").alias("t"), F.lit(value).alias("v"))


def test_no_key_is_missed_and_few_are_taken_for_present(spark):
    """With many blocks in a date, too."""
    there = rows(spark, 0, 40000, days=2)
    sketch = sketch_rows(there, KEYS)
    assert {r.blocks for r in sketch.select("blocks").distinct().collect()} == {10}
    found = maybe_there(rows(spark, 0, 80000, days=2), sketch, KEYS)
    assert found.where("k < 40000").count() == 40000
    assert found.where("k >= 40000").count() < 400


def test_several_appends_and_a_sketch_built_anew(spark, tmp_dir):
    target, sketch = f"{tmp_dir}/t", f"{tmp_dir}/s"
    for low in (0, 700, 300):
        insert_ignore_into(spark, rows(spark, low, low + 500), target, KEYS, sketch=sketch)
    assert spark.read.parquet(target).count() == 1200
    found = maybe_there(rows(spark, 0, 1200), spark.read.parquet(sketch), KEYS)
    assert found.count() == 1200
    build_sketch(spark, target, sketch, KEYS, dt.date(2018, 8, 1), dt.date(2018, 8, 2))
    again = spark.read.parquet(sketch)
    assert maybe_there(rows(spark, 0, 1200), again, KEYS).count() == 1200
    assert {r.date.day: r["count"] for r in again.groupBy("date").count().collect()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3}


@pytest.mark.parametrize("sketched", [True, False])
def test_equal_to_the_insert_without_a_sketch(spark, tmp_dir, sketched):
    """Old values stay; repeated rows, NULL keys and an empty load too."""
    target, sketch = f"{tmp_dir}/t", f"{tmp_dir}/s" if sketched else None
    odd = spark.createDataFrame([(dt.date(2018, 8, 1), None, 1, 5), (dt.date(2018, 8, 1), 7, 7, 6), (dt.date(2018, 8, 1), 7, 7, 4)], "date date, k bigint, t int, v int")
    got = [insert_ignore_into(spark, df, target, KEYS, sketch=sketch) for df in (rows(spark, 0, 50), odd, rows(spark, 0, 60, value=1), rows(spark, 0, 0), odd)]
    assert got == [{"appended": 50, "existing_keys": 0}, {"appended": 2, "existing_keys": 0}, {"appended": 10, "existing_keys": 50},
                   {"appended": 0, "existing_keys": 0}, {"appended": 1, "existing_keys": 1}]
    kept = spark.read.parquet(target)
    assert kept.where("v = 0").count() == 50 and kept.where("k is null").count() == 2 and kept.where("date = '2018-08-01' and k = 7").first().v == 4


def test_only_dates_that_may_hold_a_key_are_opened(spark, tmp_dir, monkeypatch):
    target, sketch = f"{tmp_dir}/t", f"{tmp_dir}/s"
    append_partitioned(rows(spark, 0, 500), target)  # before there was a sketch
    asked = []
    real = publish.clashing_keys

    def spy(new, have, *args):
        class Spy:
            def where(self, cond):
                asked.append(have.where(cond).select(*KEYS)._jdf.queryExecution().executedPlan().toString())
                return have.where(cond)
        return real(new, Spy(), *args)

    monkeypatch.setattr(publish, "clashing_keys", spy)
    assert insert_ignore_into(spark, rows(spark, 1000, 1010), target, KEYS, sketch=sketch)["appended"] == 10
    assert asked == []
    late = rows(spark, 2000, 2010).unionByName(rows(spark, 3, 4))
    assert insert_ignore_into(spark, late, target, KEYS, sketch=sketch) == {"appended": 10, "existing_keys": 1}
    assert len(asked) == 1 and "2018-08-04)]" in asked[0].split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "2018-08-03" not in asked[0] and "ReadSchema: struct<k:bigint,t:int>" in asked[0]


def test_crash_between_sketch_and_rows(spark, tmp_dir, monkeypatch):
    target, sketch = f"{tmp_dir}/t", f"{tmp_dir}/s"
    insert_ignore_into(spark, rows(spark, 0, 10), target, KEYS, sketch=sketch)
    with monkeypatch.context() as m:
        m.setattr(publish, "append_partitioned", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            insert_ignore_into(spark, rows(spark, 5, 20), target, KEYS, sketch=sketch)
    assert insert_ignore_into(spark, rows(spark, 5, 20), target, KEYS, sketch=sketch) == {"appended": 10, "existing_keys": 5}
    assert spark.read.parquet(target).count() == 20


def test_falsely_present_keys_change_nothing(spark, tmp_dir, monkeypatch):
    target, sketch = f"{tmp_dir}/t", f"{tmp_dir}/s"
    monkeypatch.setattr(sketches, "_bits", lambda keys: [F.lit(0).cast("long")])  # every key of a known block may be there
    for low in (0, 5):
        insert_ignore_into(spark, rows(spark, low, low + 10), target, KEYS, sketch=sketch)
    assert spark.read.parquet(target).count() == 15
