"""Line loading: split, arity, cell key, NULL marker, casts, widths, headers."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cellroll.schema import cell_feed_spec
from cellroll.sources.feed import load_feed, parse_lines
from cellroll.sources.lines import read_lines

from core_helpers import write_text

LINES = [
    "2018-08-01 00:00:00,MBSC1,CELL A,7,12,345,1.5,2,3",
    "2018-08-01 00:00:00,MBSC1,CELL B,8,123,45,1,2,3",
    "2018-08-01 01:00:00,MBSC1,CELL A,7,12,045,1,2,3",
    "2018-08-01 01:00:00,MBSC1,CELL C,9,65535,65535,1,2,3",
    "2018-08-01 02:00:00,MBSC1,CELL A,7,12,345,,2,3",
    "2018-08-01 03:00:00,MBSC1,CELL A,7,12,345,NULL,2,3",
    "2018-08-01 04:00:00,MBSC1,CELL A   ,7,12,345,NaN,1e3,-0",
    '2018-08-01 05:00:00,MBSC1,"CELL, A",7,12,345,1,2,3',
    "2018-08-01 06:00:00,MBSC1,CELL A",
    "",
]
SPEC = cell_feed_spec(["m1", "m2", "m3"], null_marker="NULL")


def _parsed(spark, path, spec=SPEC):
    rows = parse_lines(read_lines(spark, path, header=spec.header), spec).collect()
    return {r["line"]: r for r in rows}


def test_cell_feed_lines(spark, tmp_dir):
    path = write_text(f"{tmp_dir}/feed.csv", LINES)
    got = _parsed(spark, path)
    assert len(got) == len(LINES)
    ok = got[LINES[0]]
    assert ok["reject_reasons"] == "" and ok["unique_id"] == 12345 and ok["m1"] == 1.5
    assert ok["resulttime"] == dt.datetime(2018, 8, 1, 0, 0)
    # text concatenation: lac=123, ci=45 also gives 12345
    assert got[LINES[1]]["unique_id"] == 12345 and got[LINES[1]]["lac"] == 123
    # a leading zero of ci is part of the key, not of ci
    assert got[LINES[2]]["unique_id"] == 12045 and got[LINES[2]]["ci"] == 45
    # ten digits overflow int4
    assert "null:unique_id" in got[LINES[3]]["reject_reasons"].split(",")
    # empty field is not NULL: it fails the double cast
    assert got[LINES[4]]["reject_reasons"] == "cast:m1"
    # the marker is NULL
    assert got[LINES[5]]["reject_reasons"] == "" and got[LINES[5]]["m1"] is None
    # trailing blanks cut from char columns; float forms parse
    r = got[LINES[6]]
    assert r["reject_reasons"] == "" and r["cellname"] == "CELL A"
    assert math.isnan(r["m1"]) and r["m2"] == 1000.0 and r["m3"] == 0.0
    # quotes are data: one extra field
    assert got[LINES[7]]["reject_reasons"] == "arity"
    assert got[LINES[8]]["reject_reasons"] == "arity"
    assert got[""]["reject_reasons"] == "arity"


def test_strict_load_raises_with_line(spark, tmp_dir):
    path = write_text(f"{tmp_dir}/feed.csv", LINES)
    rows = load_feed(spark, path, SPEC).rows
    with pytest.raises(Exception, match="bad line"):
        rows.collect()


def test_reject_mode_splits(spark, tmp_dir):
    path = write_text(f"{tmp_dir}/feed.csv", LINES)
    feed = load_feed(spark, path, SPEC, on_error="reject")
    assert feed.rows.count() == 5
    rej = feed.rejects.collect()
    assert len(rej) == 5
    assert all(r["source_file"].endswith("feed.csv") for r in rej)


def test_width_check(spark, tmp_dir):
    path = write_text(f"{tmp_dir}/feed.csv", [f"2018-08-01 00:00:00,M,{'X' * 101},1,1,1,1,2,3",
                                               f"2018-08-01 00:00:00,M,{'X' * 100}    ,1,1,2,1,2,3"])
    got = _parsed(spark, path)
    reasons = sorted(r["reject_reasons"] for r in got.values())
    assert reasons == ["", "width:cellname"]


def test_crlf_and_lone_cr(spark, tmp_dir):
    path = write_text(f"{tmp_dir}/feed.csv", ["2018-08-01 00:00:00,M,C\rD,1,1,1,1,2,3",
                                               "2018-08-01 01:00:00,M,C,1,1,1,1,2,3"], newline="\r\n")
    got = parse_lines(read_lines(spark, path), SPEC).collect()
    assert len(got) == 2
    assert all(r["reject_reasons"] == "" for r in got)
    assert sorted(r["cellname"] for r in got) == ["C", "C\rD"]


def test_skip_header_per_file(spark, tmp_dir):
    head = "resulttime,mbsc,cellname,cellindex,lac,ci,m1,m2,m3"
    write_text(f"{tmp_dir}/in/a.csv", [head, LINES[0]])
    write_text(f"{tmp_dir}/in/b.csv", [head, LINES[2]])
    rows = load_feed(spark, f"{tmp_dir}/in", SPEC.with_options(header=True)).rows.collect()
    assert sorted(r["unique_id"] for r in rows) == [12045, 12345]


def test_tab_and_other_separators(spark, tmp_dir):
    for sep in ("\t", "|", ";;"):
        line = sep.join(["2018-08-01 00:00:00", "M", "C", "1", "12", "345", "1", "2", "3"])
        path = write_text(f"{tmp_dir}/{len(sep)}{ord(sep[0])}.txt", [line])
        rows = load_feed(spark, path, SPEC.with_options(sep=sep)).rows.collect()
        assert rows[0]["unique_id"] == 12345 and rows[0]["m3"] == 3.0


def test_column_list_and_wide_key(spark, tmp_dir):
    spec = cell_feed_spec(["m1", "m2", "m3"], wide_key=True,
                          fields=["resulttime", "mbsc", "cellname", "cellindex", "lac", "ci", "m2"])
    path = write_text(f"{tmp_dir}/feed.csv", ["2018-08-01 00:00:00,M,C,1,65535,65535,7"])
    rows = load_feed(spark, path, spec).rows.collect()
    assert rows[0]["unique_id"] == 6553565535
    assert rows[0]["m1"] is None and rows[0]["m2"] == 7.0 and rows[0]["m3"] is None


def test_folder_with_empty_file_and_markers(spark, tmp_dir):
    write_text(f"{tmp_dir}/in/part-0.csv", [LINES[0], LINES[2]])
    write_text(f"{tmp_dir}/in/part-1.csv", [], end=False)
    write_text(f"{tmp_dir}/in/_SUCCESS", [], end=False)
    write_text(f"{tmp_dir}/in/.part-0.csv.crc", ["junk"])
    rows = load_feed(spark, f"{tmp_dir}/in", SPEC).rows.collect()
    assert sorted(r["unique_id"] for r in rows) == [12045, 12345]


def test_exactly_line_one_goes(spark, tmp_dir):
    import os

    from cellroll.sources.lines import read_lines

    os.makedirs(f"{tmp_dir}/in")
    write_text(f"{tmp_dir}/in/a.csv", ["", "a1", "", "a2"])  # line 1 is blank
    write_text(f"{tmp_dir}/in/b.csv", ["head", "b1"])
    write_text(f"{tmp_dir}/in/c.csv", ["only"])
    write_text(f"{tmp_dir}/in/d.csv", ["head", *[f"d{i:05d}" for i in range(5000)]])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("4096", old):  # one file in many splits; many files in one task
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = sorted(r.value for r in read_lines(spark, f"{tmp_dir}/in", header=True).collect())
            assert got == sorted(["a1", "", "a2", "b1", *[f"d{i:05d}" for i in range(5000)]])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_strict_value_forms(spark):
    from pyspark.sql import functions as F

    from cellroll.functions.casting import typed_value

    texts = ["1d", "2.5f", "0x1p3", "1", "-2.5e3", ".5", "5.", " 7 ", "NaN", "-Infinity", "", "2018", "2018-08", "2018-08-01", "2018-08-01 10:00:00", "2018-08-01T10:00", "1e"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.d is not None, r.ts is not None) for r in df.select("t", typed_value(F.col("t"), "double").alias("d"), typed_value(F.col("t"), "timestamp").alias("ts")).collect()}
    assert {t for t in texts if got[t][0]} == {"1", "-2.5e3", ".5", "5.", " 7 ", "NaN", "-Infinity", "2018"}
    assert {t for t in texts if got[t][1]} == {"2018-08-01", "2018-08-01 10:00:00", "2018-08-01T10:00"}


def test_header_lines_go_in_one_scan_without_exchange(spark, tmp_dir):
    write_text(f"{tmp_dir}/in/a.csv", ["h", "1"])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (limit, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            plan = read_lines(spark, f"{tmp_dir}/in", header=True)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        assert plan.count("FileScan text") == 1 and "Exchange" not in plan and "Join" not in plan
        # the line itself isn't sent to Python
        call = next(x for x in plan.splitlines() if "ArrowEvalPython" in x)
        assert "first_rows(" in call and "value" not in call.split("first_rows(")[1].split(")")[0]


def test_header_of_many_files_in_one_task(spark, tmp_dir):
    for i in range(30):
        write_text(f"{tmp_dir}/in/f{i:02d}.csv", [f"head{i}", *[f"{i}-{k}" for k in range(i % 4)]])
    write_text(f"{tmp_dir}/in/empty.csv", [], end=False)
    paths = [f"{tmp_dir}/in", f"{tmp_dir}/in"]
    got = sorted(r.value for r in read_lines(spark, paths, header=True).collect())
    assert got == sorted(f"{i}-{k}" for i in range(30) for k in range(i % 4))
