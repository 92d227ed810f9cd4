"""Field splitting and line reshaping, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(line, sep: str = ",") -> Column:
    """Plain split: no quoting, no trimming; empty and trailing fields kept.

    ``sep`` is taken literally (regex-escaped); the -1 limit keeps trailing
    empty fields.
    """
    return F.split(_col(line), re.escape(sep), -1)


def field(fields, i: int) -> Column:
    """0-based field access; NULL past the end of the array."""
    return F.get(_col(fields), F.lit(i))


def strip_cr(line) -> Column:
    """Drop one trailing carriage return (CRLF files read with '\\n')."""
    c = _col(line)
    return F.when(c.endswith("\r"), F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c)


def reshape_line(line, sep: str = ",", out_sep: str = ",", left: int = 4, right: int = 5) -> Column:
    """The staging row text of an export line.

    Splits the line, derives the key as the text concatenation of fields
    ``left`` and ``right``, puts it in second place and joins the result with
    ``out_sep``: ``t,mbsc,cell,idx,lac,ci,m...`` -> ``t,lacci,mbsc,cell,idx,lac,ci,m...``.
    A line with too few fields gives NULL.
    """
    f = split_fields(line, sep)
    key = F.concat(field(f, left), field(f, right))
    rest = F.slice(f, 2, F.size(f) - 1)
    joined = F.array_join(F.concat(F.array(field(f, 0), key), rest), out_sep)
    return F.when(F.size(f) > F.lit(max(left, right)), joined)


def join_fields(cols, sep: str = ",", null_text: str = "") -> Column:
    """Render columns as one delimited line; NULL renders as ``null_text``."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit(null_text)) for c in cols])
