"""Cell key, key collisions, duplicate keys and the quality report."""

from pyspark.sql import functions as F

from cellroll.functions.keys import cell_key
from cellroll.functions.text import reshape_line
from cellroll.operators.quality import cell_key_collisions, duplicate_keys, quality_report
from cellroll.schema import cell_feed_spec
from cellroll.sources.feed import parse_lines
from cellroll.sources.lines import read_lines

from core_helpers import write_text


def test_cell_key_text_semantics(spark):
    df = spark.createDataFrame([("12", "345"), ("123", "45"), ("12", "045"), ("012", "45"), ("65535", "65535")],
                               "lac string, ci string")
    got = [r[0] for r in df.select(cell_key("lac", "ci")).collect()]
    assert got == [12345, 12345, 12045, 1245, None]
    wide = [r[0] for r in df.select(cell_key("lac", "ci", wide=True)).collect()]
    assert wide[-1] == 6553565535


def test_collisions(spark):
    df = spark.createDataFrame([(12345, 12, 345), (12345, 123, 45), (12345, 12, 345), (999, 9, 99)],
                               "unique_id int, lac int, ci int")
    got = cell_key_collisions(df).collect()
    assert [(r["unique_id"], r["n_pairs"], r["n_rows"]) for r in got] == [(12345, 2, 3)]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert [(r.a, r.b, r.n) for r in duplicate_keys(df, ["a", "b"]).collect()] == [(1, 1, 2)]


def test_reshape_line(spark):
    df = spark.createDataFrame([("t,M,C,7,12,045,1,2",), ("t,M",)], "value string")
    got = [r[0] for r in df.select(reshape_line("value")).collect()]
    assert got == ["t,12045,M,C,7,12,045,1,2", None]


def test_quality_report(spark, tmp_dir):
    spec = cell_feed_spec(["m1"], null_marker="NULL")
    lines = ["2018-08-01 00:00:00,M,C,1,12,345,1",
             "2018-08-01 00:00:00,M,C,1,12,345,2",
             "2018-08-01 00:00:00,NULL,C,1,12,346,1",
             "2018-08-01 00:00:00,M,C,1,12,347,x",
             "2018-08-01 00:00:00,M,C"]
    path = write_text(f"{tmp_dir}/q.csv", lines)
    rep = {r["check"]: r["n_rows"] for r in quality_report(parse_lines(read_lines(spark, path), spec)).collect()}
    assert rep == {"rows": 5, "good": 2, "null:mbsc": 1, "cast:m1": 1, "arity": 1, "duplicate_key": 2}
