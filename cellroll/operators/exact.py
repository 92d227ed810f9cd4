"""Sums of doubles that don't depend on the order of the rows.

A sum of doubles rounds at every step, so it differs with partitions and
tasks.  Here every value is cut, without any rounding, into whole-number
pieces of 32 bits on a fixed grid (piece k counts units of 2**(32 k - unit)),
and the pieces are summed as integers: a plain partial and final hash
aggregate of a few longs for each metric.  At the end the pieces of a group
are put together as one integer and rounded to a double once.  The result is
the double nearest to the true sum of the doubles.

``grids`` finds the pieces that each metric needs from the smallest and
largest magnitude in it (one aggregate without a shuffle of rows).  Usual
counters need three; values over the whole range of doubles need some sixty.

NaN and infinities are summed on the side: a group that holds one has the
sum that IEEE arithmetic gives.  NULLs are left out; a group of NULLs is NULL.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DAILY_KEYS, HOURLY_KEYS, metrics_of
from .rollup import sum_metrics, with_day

PIECE = 32  # bits; a sum of 2**31 pieces still fits in a long
DECIMAL_PIECES = 3  # 3 * 32 bits and 30 bits of rows fit in the 126 bits of a decimal


class Grid(NamedTuple):
    """Pieces of a metric: ``pieces`` of them, the lowest in units of 2**-unit."""

    unit: int
    pieces: int


def _finite(c: Column) -> Column:
    return F.when(F.abs(c) < F.lit(math.inf), c)


def grids(df: DataFrame, metrics) -> dict[str, Grid]:
    """The grid of each metric: no bit of any of its values lies outside."""
    size = {m: _finite(F.abs(F.col(m).cast("double"))) for m in metrics}
    stats = [x for m in metrics for x in (F.min(F.when(size[m] > 0, size[m])), F.max(size[m]))]
    row = df.agg(*stats).first()
    out = {}
    for i, m in enumerate(metrics):
        low, high = row[2 * i], row[2 * i + 1]
        if not high:
            out[m] = Grid(0, 1)
            continue
        # the lowest bit of a double is 52 places below its highest one, and at 2**-1074 at the lowest
        unit = min(1074, 53 - math.frexp(low)[1])
        out[m] = Grid(unit, max(1, -(-(math.frexp(high)[1] + unit) // PIECE)))
    return out


def _scaled(c: Column, power: int) -> Column:
    """c * 2**power, in two factors: one power of two may lie outside the range of doubles."""
    half = power // 2
    return c * math.ldexp(1.0, half) * math.ldexp(1.0, power - half)


def _truncated(c: Column) -> Column:
    """The whole number in a double, as a double; from 2**53 on a double is one."""
    return F.when(F.abs(c) >= 2.0**53, c).otherwise(c.cast("bigint").cast("double"))


def _pieces(c: Column, grid: Grid) -> list[Column]:
    """Whole numbers whose sum, each times 2**(32 k - unit), is the value; highest first.  All have its sign.

    Piece k is the whole part of the value in its units, less that in the next units.  A value whose lowest
    bit lies above the piece has a zero there.
    """
    out = []
    for k in reversed(range(grid.pieces)):
        place = PIECE * k - grid.unit
        piece = _truncated(_scaled(c, -place))
        if k + 1 < grid.pieces:
            piece = piece - _truncated(_scaled(c, -place - PIECE)) * 2.0**PIECE
        if place + PIECE + 53 < 1024:
            piece = F.when(F.abs(c) >= math.ldexp(1.0, place + PIECE + 53), c - c).otherwise(piece)
        out.append(piece.cast("bigint"))
    return out


def _with_pieces(df: DataFrame, dims, metrics, grid: dict[str, Grid]) -> tuple[DataFrame, list[str]]:
    """The columns to sum: the pieces of each metric, and its NaN and infinite values."""
    out = []
    for m in metrics:
        c = F.col(m).cast("double")
        out += [p.alias(f"{m}:{k}") for k, p in enumerate(_pieces(_finite(c), grid[m]))]
        out.append(F.when(_finite(c).isNull(), c).alias(f"{m}:odd"))
    df = df.select(*dims, *out)
    return df, df.columns[len(dims):]


def nearest(metric: str, grid: Grid) -> Column:
    """The double nearest to the sum of a group's pieces."""
    pieces = [F.col(f"`{metric}:{k}`") for k in range(grid.pieces)]
    if grid.pieces <= DECIMAL_PIECES:
        whole = F.lit(0).cast("decimal(38,0)")
        for p in pieces:
            whole = (whole * F.lit(2**PIECE).cast("decimal(10,0)")).cast("decimal(38,0)") + p.cast("decimal(19,0)")
            whole = whole.cast("decimal(38,0)")
        value = _scaled(whole.cast("double"), -grid.unit)
    else:
        value = _put_together(grid)(*pieces)
    odd = F.col(f"`{metric}:odd`")
    return F.coalesce(odd, value).alias(metric)


def _put_together(grid: Grid):
    """Pieces beyond the width of decimals, put together as Python integers: once for each group."""

    def run(*columns: pd.Series) -> pd.Series:
        out = []
        for row in zip(*columns, strict=True):
            if any(pd.isna(x) for x in row):
                out.append(None)
                continue
            whole = 0
            for x in row:
                whole = (whole << PIECE) + int(x)
            try:
                out.append(whole / (1 << grid.unit) if grid.unit >= 0 else float(whole << -grid.unit))
            except OverflowError:
                out.append(math.inf if whole > 0 else -math.inf)
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(run, "double")


def exact_sums(df: DataFrame, dims, metrics, grid: dict[str, Grid] | None = None, *, keys_not_null: bool = False) -> DataFrame:
    """GROUP BY ``dims``; the exactly rounded SUM of every metric, in passes like ``sum_metrics``.

    ``grid``: from ``grids`` of this or of a larger table, when it is known.
    """
    dims, metrics = list(dims), list(metrics)
    grid = grids(df, metrics) if grid is None else grid
    pieces, names = _with_pieces(df, dims, metrics, grid)
    sums = sum_metrics(pieces, dims, names, keys_not_null=keys_not_null)
    return sums.select(*dims, *[nearest(m, grid[m]) for m in metrics])


def exact_daily_rollup(hourly: DataFrame, metrics=None) -> DataFrame:
    """``daily_rollup`` with exactly rounded sums: the same bits however the hours are partitioned."""
    metrics = list(metrics) if metrics is not None else metrics_of(hourly, HOURLY_KEYS)
    return exact_sums(with_day(hourly, metrics), DAILY_KEYS, metrics, keys_not_null=True)
