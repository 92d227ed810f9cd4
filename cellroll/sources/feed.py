"""Load a delimited feed into typed rows of its target table.

One pass over the text: split, check arity, derive the cell key from the raw
fields, apply the NULL marker, cast every column, and collect the reasons a
line is rejected.  All of it is built-in column expressions, so the whole
projection runs in generated code next to the scan.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.casting import apply_null_marker, reasons, typed_value
from ..functions.keys import cell_key_text
from ..functions.text import field, split_fields
from ..schema import FeedSpec, spark_type
from .lines import read_lines

REJECT_COL = "reject_reasons"
LINE_COL = "line"


class Feed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame
    totals: Observation  # n_lines, n_rejects of the first action over the feed


def parse_lines(lines: DataFrame, spec: FeedSpec, line_col: str = "value") -> DataFrame:
    """DataFrame of lines -> target columns + ``reject_reasons`` + ``line``.

    ``reject_reasons`` is a comma-separated list of failed checks, empty for
    a good row (``concat_ws`` skips the NULLs of passed checks and stays in
    generated code).  A line with the wrong number of fields gets the single
    reason ``arity``.
    """
    fields = spec.file_fields
    pos = {n: i for i, n in enumerate(fields)}
    unknown = set(fields) - set(spec.column_names)
    if unknown:
        raise ValueError(f"file fields not in the target table: {sorted(unknown)}")

    keep = [c for c in lines.columns if c not in (line_col,)]
    split = lines.select(*keep, F.col(line_col).alias(LINE_COL), split_fields(line_col, spec.sep).alias("_f"))

    raw: dict[str, Column] = {}
    for name, type_name in spec.columns:
        if spec.cell_key is not None and name == spec.cell_key.name:
            k = spec.cell_key
            raw[name] = cell_key_text(field("_f", pos[k.left]), field("_f", pos[k.right]))
        elif name in pos:
            raw[name] = apply_null_marker(field("_f", pos[name]), spec.null_marker)
        else:
            raw[name] = F.lit(None).cast("string")

    typed_cols = []
    for name, type_name in spec.columns:
        if name in pos or (spec.cell_key is not None and name == spec.cell_key.name):
            v = typed_value(raw[name], type_name)
        else:
            v = F.lit(None).cast(spark_type(type_name))
        typed_cols.append(v.alias(name))

    # Keep the raw text of each cast column next to its value so the checks
    # below do not re-run the casts.
    raw_cols = [raw[n].alias(f"_raw_{i}") for i, (n, t) in enumerate(spec.columns) if n in pos or n == getattr(spec.cell_key, "name", None)]
    typed = split.select(*keep, LINE_COL, F.size("_f").alias("_n"), *typed_cols, *raw_cols)

    checks: list[Column] = []
    not_null = set(spec.not_null)
    for i, (name, type_name) in enumerate(spec.columns):
        has_raw = name in pos or name == getattr(spec.cell_key, "name", None)
        r = F.col(f"_raw_{i}") if has_raw else F.lit(None).cast("string")
        checks += reasons(name, r, F.col(name), type_name, name in not_null)
    arity_bad = F.col("_n") != F.lit(len(fields))
    reason = F.when(arity_bad, F.lit("arity")).otherwise(F.concat_ws(",", *checks) if checks else F.lit(""))
    return typed.select(*keep, *spec.column_names, reason.alias(REJECT_COL), LINE_COL)


def is_bad(reasons=REJECT_COL) -> Column:
    return F.col(reasons) != F.lit("")


def observe_totals(parsed: DataFrame) -> tuple[DataFrame, Observation]:
    """Count lines and rejects while the feed is read (load totals).

    The observation node also keeps later filters on the reject column from
    being pushed below the parse, where they would repeat the split of the
    line once per field.
    """
    obs = Observation()
    out = parsed.observe(obs, F.count(F.lit(1)).alias("n_lines"),
                         F.coalesce(F.sum(F.when(is_bad(), 1).otherwise(0)), F.lit(0)).alias("n_rejects"))
    return out, obs


def stop_at_bad(parsed: DataFrame) -> DataFrame:
    """The rows; a bad one fails the job with its reasons and its line."""
    message = F.concat(F.lit("bad line ["), F.col(REJECT_COL), F.lit("]: "), F.col(LINE_COL))
    return parsed.filter(F.when(is_bad(), F.raise_error(message)).isNull())


def split_rejects(parsed: DataFrame, spec: FeedSpec, on_error: str = "raise") -> Feed:
    """Good rows and reject rows of a parsed feed.

    on_error='raise': a bad line fails the job (with the line in the
    message) when the rows are computed; nothing is silently dropped.
    on_error='reject': bad lines go to ``rejects`` (line, reasons, source_file).
    """
    if on_error not in ("raise", "reject"):
        raise ValueError("on_error must be 'raise' or 'reject'")
    parsed, obs = observe_totals(parsed)
    bad = is_bad()
    extra = [c for c in parsed.columns if c not in (*spec.column_names, REJECT_COL, LINE_COL)]
    rejects = parsed.filter(bad).select(*extra, LINE_COL, REJECT_COL)
    if on_error == "raise":
        rows = stop_at_bad(parsed)
    else:
        rows = parsed.filter(~bad)
    return Feed(rows.select(*spec.column_names), rejects, obs)


def load_feed(spark: SparkSession, paths, spec: FeedSpec, *, on_error: str = "raise") -> Feed:
    """Read, split, check and type one feed (files or directories)."""
    lines = read_lines(spark, paths, header=spec.header, line_sep=spec.line_sep)
    return split_rejects(parse_lines(lines, spec), spec, on_error)
