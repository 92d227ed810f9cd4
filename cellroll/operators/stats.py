"""Load totals: lines read and fields carried, as the loader reports them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import split_fields


def _field_count(spec, line_col: str) -> Column:
    n = F.size(split_fields(line_col, spec.sep))
    # the derived key is inserted into each staging row
    return n + F.lit(1) if spec.cell_key is not None else n


def load_totals(lines: DataFrame, spec, line_col: str = "value") -> DataFrame:
    """One row: n_lines and n_fields (fields per staging row, summed)."""
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.coalesce(F.sum(_field_count(spec, line_col)), F.lit(0)).cast("bigint").alias("n_fields"),
    )


def observe_line_totals(lines: DataFrame, spec, name: str = "load", line_col: str = "value"):
    """Count lines and fields while another action runs over ``lines``.

    Returns (lines_with_observer, Observation); read ``obs.get`` after the action.
    """
    obs = Observation(name)
    out = lines.observe(obs, F.count(F.lit(1)).alias("n_lines"),
                        F.sum(_field_count(spec, line_col)).alias("n_fields"))
    return out, obs
