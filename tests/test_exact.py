"""Sums of doubles that no order of rows changes, against fractions."""

import math
import random
import struct
from fractions import Fraction

import pytest

from cellroll.operators.exact import Grid, exact_sums, grids


def nearest_sum(values):
    values = [x for x in values if x is not None]
    odd = [x for x in values if not math.isfinite(x)]
    if odd:
        return sum(odd)
    if not values:
        return None
    total = sum(map(Fraction, values))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def bits(x):
    return None if x is None else "nan" if x != x else struct.pack("d", x + 0.0)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)

    def any_double():
        return struct.unpack("d", struct.pack("Q", r.getrandbits(64)))[0]

    out = []
    for _ in range(1500):
        g = r.choice([None, *range(9)])
        out.append((g, round(r.uniform(-1000, 1e6), 2), any_double() if (g or 0) < 7 else r.choice([None, 1e308, 5e-324, -1e308]),
                    None if g == 3 else r.choice([None, 1.0, 2.0**70, -(2.0**70), 1e-3]), math.inf if g == 1 else r.choice([math.nan, 1.0]) if g == 2 else 0.1, 0.0, r.choice([1, -7])))
    return out


METRICS = ["a", "b", "c", "d", "e", "n"]


def test_sums_are_the_nearest_doubles_at_any_partitioning(spark, rows):
    df = spark.createDataFrame(rows, "g int, a double, b double, c double, d double, e double, n long")
    want = {g: [bits(nearest_sum([x[k] for x in rows if x[0] == g])) for k in range(1, 7)] for g in {x[0] for x in rows}}
    for parts in (1, 7, 200):
        got = {r.g: [bits(r[m]) for m in METRICS] for r in exact_sums(df.repartition(parts), ["g"], METRICS).collect()}
        assert got == want


def test_grids(spark):
    df = spark.createDataFrame([(0.01, 0.0, None, 2.0**1023, math.inf), (123456.78, -0.0, None, 5e-324, 1.0)], "a double, z double, n double, w double, i double")
    assert grids(df, df.columns) == {"a": Grid(59, 3), "z": Grid(0, 1), "n": Grid(0, 1), "w": Grid(1074, 66), "i": Grid(52, 2)}


def test_cancellation_and_ties(spark):
    """What a running sum loses; and sums half-way between two doubles, which go to the even one."""
    cases = [[1e16, 1.0, -1e16], [2.0**53, 1.0], [2.0**53, 1.0, 2.0**-60], [2.0**53 + 2, 1.0], [0.1] * 10, [1e308, 1e308, -1e308], [5e-324, 5e-324]]
    df = spark.createDataFrame([(i, x) for i, v in enumerate(cases) for x in v], "g int, x double")
    got = {r.g: r.x for r in exact_sums(df, ["g"], ["x"]).collect()}
    assert got == {i: nearest_sum(v) for i, v in enumerate(cases)} and got[4] == 1.0 and got[0] == 1.0


def test_plan_is_one_aggregate_of_longs(spark):
    df = spark.range(100).selectExpr("id % 3 as g", "id / 7 as x")
    plan = exact_sums(df, ["g"], ["x"], {"x": Grid(60, 3)})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "HashAggregate" in plan


def test_many_metrics_go_in_passes(spark):
    df = spark.range(50).selectExpr("if(id % 5 = 0, null, id % 5) as g", *[f"id / {k + 3} as m{k}" for k in range(40)])
    rows = df.collect()
    got = {r.g: [r[f"m{k}"] for k in range(40)] for r in exact_sums(df, ["g"], [f"m{k}" for k in range(40)]).collect()}
    assert got == {g: [nearest_sum([r[f"m{k}"] for r in rows if r.g == g]) for k in range(40)] for g in {r.g for r in rows}}


def test_empty(spark):
    assert exact_sums(spark.createDataFrame([], "g int, x double"), ["g"], ["x"]).count() == 0
