"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cellroll.queries.registry import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _key(row):
    return tuple((x is None, type(x).__name__ if x is not None else "", x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("lineitem", "events", "orders", "nation", "region"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "date" in df.columns


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = {c: i for i, c in enumerate(ocols)}
    want = sorted((tuple(_norm(r[idx[c]]) for c in cols) for r in res.fetchall()), key=_key)
    assert got == want


def test_header_files_grow_in_number_not_in_share(spark, tmp_dir):
    """No task writes or reads a fixed share of the lines: a larger table gives more files of the same size."""
    rows = spark.range(12000).select(
        F.floor(F.col("id") / 4).alias("l_orderkey"), F.lit(7).cast("long").alias("l_partkey"),
        (F.col("id") % 9).alias("l_suppkey"), (F.col("id") % 4 + 1).cast("int").alias("l_linenumber"),
        *[F.col("id").cast("double").alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), F.lit("1998-01-01").cast("timestamp_ntz").alias("l_shipdate"))
    rows.repartition(12).write.parquet(f"{tmp_dir}/lineitem.parquet")
    got = rows.collect()
    want = Counter(f"{r.l_orderkey},{r.l_linenumber}" for r in got)
    want[""] = sum(r.l_orderkey % 7 == 0 and r.l_linenumber == 1 for r in got)
    conf = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(conf)
    for size in ("20000", "128m"):  # many tasks, few tasks
        spark.conf.set(conf, size)
        sf = tmp_dir if size == "20000" else f"{tmp_dir}/."  # each its own exports
        try:
            loaded = QUERIES["load_skip_header"](spark, sf)
            assert Counter(map(tuple, loaded.collect())) == Counter(map(tuple, got))
            blank = QUERIES["load_skip_header_blank"](spark, sf)
            assert {r.value: r.n for r in blank.collect()} == want
        finally:
            spark.conf.set(conf, old)
        for files in (loaded.inputFiles(), blank.inputFiles()):
            assert len(files) >= (12 if size == "20000" else 3)
