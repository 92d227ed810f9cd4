"""First-wins, insert-ignore (pure and on tables), and their plans."""

import datetime as dt

from pyspark.sql import functions as F

from cellroll.operators.publish import first_wins, insert_ignore, insert_ignore_into, new_only


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_wins_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 9.0), (1, "a", 3.0), (2, None, 1.0), (2, "z", 1.0)],
                               "k int, s string, v double")
    got = sorted((r.k, r.s, r.v) for r in first_wins(df, ["k"]).collect())
    assert got == [(1, "a", 3.0), (2, "z", 1.0)]


def test_first_wins_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = _plan(first_wins(df, ["k"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_insert_ignore_keeps_existing(spark):
    target = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, v double")
    new = spark.createDataFrame([(2, 99.0), (3, 30.0), (3, 31.0)], "k int, v double")
    got = sorted(tuple(r) for r in insert_ignore(target, new, ["k"]).collect())
    assert got == [(1, 10.0), (2, 20.0), (3, 30.0)]
    assert "LeftAnti" in _plan(new_only(new, target, ["k"]))


def test_insert_ignore_into_is_idempotent_and_prunes(spark, tmp_dir):
    d1, d2 = dt.date(2018, 8, 1), dt.date(2018, 8, 2)
    rows = [(d1, 1, 1.0), (d1, 2, 2.0), (d2, 1, 3.0)]
    df = spark.createDataFrame(rows, "date date, k int, v double")
    path = f"{tmp_dir}/t"
    assert insert_ignore_into(spark, df, path, ["date", "k"])["appended"] == 3
    assert insert_ignore_into(spark, df, path, ["date", "k"])["appended"] == 0
    late = spark.createDataFrame([(d2, 1, 9.0), (d2, 2, 4.0)], "date date, k int, v double")
    assert insert_ignore_into(spark, late, path, ["date", "k"])["appended"] == 1
    got = sorted((r.date, r.k, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(d1, 1, 1.0), (d1, 2, 2.0), (d2, 1, 3.0), (d2, 2, 4.0)]


def test_anti_join_reads_only_touched_dates(spark, tmp_dir):
    from cellroll.sinks.tables import restrict_to

    d1 = dt.date(2018, 8, 1)
    df = spark.createDataFrame([(d1, 1, 1.0), (dt.date(2018, 8, 2), 1, 1.0)], "date date, k int, v double")
    df.write.partitionBy("date").parquet(f"{tmp_dir}/t")
    target = spark.read.parquet(f"{tmp_dir}/t")
    plan = _plan(restrict_to(target, d1, d1).select("k"))
    assert "PartitionFilters: [isnotnull(date" in plan and "2018-08-01" in plan


def test_keys_decide_and_a_replay_moves_no_wide_rows(spark, tmp_dir):
    from cellroll.operators import publish

    d = dt.date(2018, 8, 1)
    new = spark.createDataFrame([(d, 1, 1.0), (d, 2, 2.0), (d, 3, 3.0)], "date date, k int, v double")
    fresh, n, there = publish.new_keys(new, spark.createDataFrame([(d, 9)], "date date, k int"), ["date", "k"])
    assert (n, there) == (3, 0)
    fresh, n, there = publish.new_keys(new, spark.createDataFrame([(d, 2), (d, 3), (d, 3)], "date date, k int"), ["date", "k"])
    assert (n, there) == (1, 2) and [r.k for r in fresh.collect()] == [1]
    path = f"{tmp_dir}/t"
    insert_ignore_into(spark, new, path, ["date", "k"])
    import os
    before = sorted(x for _, _, f in os.walk(path) for x in f)
    assert insert_ignore_into(spark, new, path, ["date", "k"]) == {"appended": 0, "existing_keys": 3}
    assert sorted(x for _, _, f in os.walk(path) for x in f) == before


def test_other_columns_are_refused_before_anything_is_written(spark, tmp_dir):
    import os

    import pytest

    from cellroll.sinks.tables import SchemaMismatch, append_partitioned, overwrite_partitions

    d = dt.date(2018, 8, 1)
    path = f"{tmp_dir}/t"
    insert_ignore_into(spark, spark.createDataFrame([(d, 1, 1.0)], "date date, k int, v double"), path, ["date", "k"])
    before = sorted(x for _, _, f in os.walk(path) for x in f)
    for bad in ("date date, k int, v double, m2 double", "date date, k bigint, v double", "date date, k int"):
        row = (d, 5, 5.0, 6.0)[: bad.count(",") + 1]
        df = spark.createDataFrame([row], bad)
        for write in (lambda: insert_ignore_into(spark, df, path, ["date", "k"]), lambda: append_partitioned(df, path), lambda: overwrite_partitions(df, path)):
            with pytest.raises(SchemaMismatch):
                write()
    assert sorted(x for _, _, f in os.walk(path) for x in f) == before


def test_files_follow_the_data_not_tasks_times_dates(spark, tmp_dir):
    import glob

    from cellroll.sinks.tables import append_partitioned

    df = spark.range(16_000).selectExpr("date_add(date'2018-01-01', cast(id % 30 as int)) as date", "cast(id as int) as k").repartition(16)
    append_partitioned(df, f"{tmp_dir}/t")
    assert 30 <= len(glob.glob(f"{tmp_dir}/t/date=*/*.parquet")) <= 60
    # one date holds nearly all rows: its partition is split
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "64k")
        hot = spark.range(200_000).selectExpr("date_add(date'2018-01-01', cast(if(id % 50 = 0, id % 30, 3) as int)) as date", "id as k", "rand(1) as v").repartition(16)
        append_partitioned(hot, f"{tmp_dir}/h")
        assert len(glob.glob(f"{tmp_dir}/h/date=2018-01-04/*.parquet")) >= 4
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_catalog_targets(spark):
    from cellroll.sinks.tables import overwrite_partitions, read_table

    d1, d2 = dt.date(2018, 8, 1), dt.date(2018, 8, 2)
    name = "publish_target"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.createDataFrame([(1, d1, 1.0), (2, d2, 2.0)], "k int, date date, v double")
    try:
        assert read_table(spark, name) is None
        assert insert_ignore_into(spark, df, name, ["date", "k"])["appended"] == 2
        more = spark.createDataFrame([(9.0, 2, d2), (3.0, 3, d2)], "v double, k int, date date")
        assert insert_ignore_into(spark, more, name, ["date", "k"])["appended"] == 1
        overwrite_partitions(spark.createDataFrame([(7, d1, 7.0)], "k int, date date, v double"), name)
        assert sorted((r.k, r.v) for r in spark.table(name).collect()) == [(2, 2.0), (3, 3.0), (7, 7.0)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_read_recent_prunes_dates(spark, tmp_dir):
    from cellroll.sinks.tables import read_recent, write_staging

    d1, d2 = dt.date(2018, 8, 1), dt.date(2018, 8, 2)
    df = spark.createDataFrame([(d1, 1), (d2, 2)], "date date, k int")
    df.write.partitionBy("date").parquet(f"{tmp_dir}/h")
    recent = read_recent(spark, f"{tmp_dir}/h", d2)
    assert [r.k for r in recent.collect()] == [2]
    assert "PartitionFilters: [isnotnull(date" in _plan(recent)
    write_staging(df, f"{tmp_dir}/s")
    write_staging(df.limit(1), f"{tmp_dir}/s", truncate=True)
    assert spark.read.parquet(f"{tmp_dir}/s").count() == 1


def test_no_key_folder_stays(spark, tmp_dir):
    """The keys that an insert writes on the way are gone at its end, also when it fails."""
    import os

    import pytest

    from cellroll.operators import publish
    from cellroll.session import scratch_root

    keys = scratch_root(spark).removeprefix("file:") + "/cellroll/keys"

    def folders():
        return sorted(os.listdir(keys)) if os.path.isdir(keys) else []

    before = folders()
    rows = spark.range(10).selectExpr("cast(id as int) as k", "date'2018-08-01' as date", "id as v")
    publish.insert_ignore_into(spark, rows.where("k < 5"), f"{tmp_dir}/t", ["k"])
    assert publish.insert_ignore_into(spark, rows, f"{tmp_dir}/t", ["k"]) == {"appended": 5, "existing_keys": 5}
    real = publish.append_partitioned
    publish.append_partitioned = lambda *a: 1 / 0
    try:
        with pytest.raises(ZeroDivisionError):
            publish.insert_ignore_into(spark, rows.selectExpr("k + 7 as k", "date", "v"), f"{tmp_dir}/t", ["k"])
    finally:
        publish.append_partitioned = real
    assert folders() == before
