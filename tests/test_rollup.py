"""Roll-up in passes equals one pass, NULL group keys included."""

from pyspark.sql import functions as F

from cellroll.operators.rollup import sum_metrics


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))


def test_passes_equal_single_pass(spark):
    base = spark.range(200).select(
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 5).alias("g"),
        (F.col("id") % 3).alias("h"),
        *[F.when(F.col("id") % (j + 2) == 0, None).otherwise(F.col("id") * (j + 1)).cast("double").alias(f"m{j}")
          for j in range(10)])
    metrics = [f"m{j}" for j in range(10)]
    one = sum_metrics(base, ["g", "h"], metrics, per_pass=None)
    split = sum_metrics(base, ["g", "h"], metrics, per_pass=3)
    assert split.columns == one.columns
    assert _rows(split) == _rows(one)
    assert any(r[0] is None for r in _rows(split))


def test_passes_on_non_null_keys_add_no_exchange(spark):
    base = spark.range(100).select((F.col("id") % 4).alias("g"),
                                   *[(F.col("id") * j).cast("double").alias(f"m{j}") for j in range(6)])
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = sum_metrics(base, ["g"], [f"m{j}" for j in range(6)], per_pass=2, keys_not_null=True)
        plan = df._jdf.queryExecution().executedPlan().toString()
        # one exchange per pass (the aggregates), none added by the joins
        assert plan.count("Exchange hashpartitioning") == 3
        assert plan.count("SortMergeJoin") == 2
        assert len(df.collect()) == 4
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_daily_rollup_reduces_a_hot_cell_map_side(spark):
    import datetime as dt

    from cellroll.operators.rollup import daily_rollup

    # one cell holds every row: partial sums before the exchange keep it to
    # one row per task and day
    rows = [(dt.datetime(2018, 8, 1, h % 24), 12345, "M", "C", 7, 12, 345, float(h)) for h in range(500)]
    df = spark.createDataFrame(rows, "resulttime timestamp_ntz, unique_id int, mbsc string, cellname string, "
                                     "cellindex int, lac int, ci int, m1 double").repartition(4)
    out = daily_rollup(df, ["m1"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    got = out.collect()
    assert len(got) == 1 and got[0]["m1"] == float(sum(range(500)))


def test_bucket_rollup_quarter_hours(spark):
    import datetime as dt

    from cellroll.operators.rollup import bucket_rollup

    t0 = dt.datetime(2018, 8, 1, 10, 0)
    rows = [(t0 + dt.timedelta(minutes=m), 1, float(m)) for m in range(0, 60, 5)]
    df = spark.createDataFrame(rows, "resulttime timestamp_ntz, unique_id int, m1 double")
    got = sorted((r.bucket.minute, r.m1) for r in bucket_rollup(df, "15 minutes", ["unique_id"], ["m1"]).collect())
    assert got == [(0, 0.0 + 5 + 10), (15, 15.0 + 20 + 25), (30, 30.0 + 35 + 40), (45, 45.0 + 50 + 55)]


def test_passes_with_null_keys_add_no_exchange(spark):
    base = spark.range(100).select(F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("g"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("h"),
                                   *[(F.col("id") * j).cast("double").alias(f"m{j}") for j in range(8)])
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = sum_metrics(base, ["g", "h"], [f"m{j}" for j in range(8)], per_pass=2)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 4 and plan.count("SortMergeJoin") == 3
        one = sum_metrics(base, ["g", "h"], [f"m{j}" for j in range(8)], per_pass=None)
        assert _rows(df) == _rows(one)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_derived_metrics_shuffle_the_rows_once_as_they_are(spark):
    base = spark.range(300).select(
        F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 5).cast("string")).alias("g"),
        (F.col("id") % 3).alias("h"), F.when(F.col("id") % 11 != 0, F.col("id").cast("double")).alias("x"))
    metrics = {f"m{j}": F.expr(f"CASE WHEN g <> '1' OR h = {j % 3} THEN x * {j} END") for j in range(10)}
    columns = base.select("g", "h", *[c.alias(m) for m, c in metrics.items()])
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = sum_metrics(base, ["g", "h"], metrics, per_pass=4)
        plan = df._jdf.queryExecution().executedPlan().toString()
        made = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
        assert plan.count("ReusedExchange") == 2 and len(made) == 1
        below = plan.split(made[0])[1].split("ReusedExchange")[0]
        assert "partial_sum" not in below.split("SortMergeJoin")[0].split("HashAggregate")[0]
        for per_pass in (4, None):
            assert _rows(sum_metrics(base, ["g", "h"], metrics, per_pass=per_pass)) == _rows(sum_metrics(columns, ["g", "h"], list(metrics)))
        some = base.where("g is not null")
        assert _rows(sum_metrics(some, ["g", "h"], metrics, per_pass=4, keys_not_null=True)) == _rows(sum_metrics(columns.where("g is not null"), ["g", "h"], list(metrics)))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
