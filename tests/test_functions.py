"""Scalar functions: time buckets of several widths, separators."""

import datetime as dt

from pyspark.sql import functions as F

from cellroll.functions.time import day_of, time_bucket
from cellroll.schema import cell_feed_spec

ALIGN = dt.datetime(2000, 1, 3)


def _floor(ts, width):
    return ALIGN + ((ts - ALIGN) // width) * width


def test_time_buckets_match_floor_from_monday_2000(spark):
    stamps = [dt.datetime(2024, 1, d, h, m, 7) for d in (1, 2, 6, 7, 8, 30) for h in (0, 11, 23) for m in (0, 14, 15, 59)]
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    for width, delta in (("15 minutes", dt.timedelta(minutes=15)), ("1 hour", dt.timedelta(hours=1)),
                         ("1 day", dt.timedelta(days=1)), ("5 days", dt.timedelta(days=5)),
                         ("7 days", dt.timedelta(days=7))):
        got = [r[0] for r in df.select(time_bucket("ts", width)).collect()]
        assert got == [_floor(t, delta) for t in stamps], width
    days = [r[0] for r in df.select(day_of("ts")).collect()]
    assert days == [t.date() for t in stamps]


def test_tab_given_as_text():
    assert cell_feed_spec(["m"], sep="\\t").sep == "\t"


def test_cluster_conf_scales_partitions():
    from cellroll.session import cluster_conf

    c = cluster_conf(100 << 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert int(cluster_conf(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 24
    assert c["spark.sql.codegen.hugeMethodLimit"] == "8000"


def test_time_bucket_null_rows_and_odd_widths(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from cellroll.functions.time import time_bucket

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 3), 1), (None, 2), (dt.datetime(1999, 12, 31, 23, 59, 59, 999999), 3)], "ts timestamp_ntz, k int")
    rows = df.select("k", time_bucket("ts", "7 hours").alias("a"), time_bucket("ts", "5 hours").alias("b"), time_bucket("ts", "11 minutes").alias("c")).orderBy("k").collect()
    assert tuple(rows[0])[1:] == (dt.datetime(2024, 1, 1), dt.datetime(2023, 12, 31, 23), dt.datetime(2024, 1, 1, 2, 53))
    assert tuple(rows[1])[1:] == (None, None, None)
    con = __import__("duckdb").connect()
    for w in ("7 minutes", "5 hours", "7 hours", "36 hours", "7 days", "1 second"):
        want = con.execute(f"SELECT time_bucket(INTERVAL '{w}', TIMESTAMP '1999-12-31 23:59:59.999999')").fetchone() if hasattr(con, "fetchone") else con.execute(f"SELECT time_bucket(INTERVAL '{w}', TIMESTAMP '1999-12-31 23:59:59.999999')").fetchall()[0]
        got = df.where("k = 3").select(time_bucket("ts", w)).first()
        assert got[0] == want[0], w
    assert df.select(time_bucket("ts", "1 hour").alias("b")).schema["b"].dataType.simpleString() == "timestamp_ntz"
    assert df.where(F.col("k") == 2).count() == 1
