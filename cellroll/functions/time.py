"""Time buckets on zone-free timestamps."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}
# Fixed value: buckets of every width are aligned to Monday 2000-01-03.
_ORIGIN = "timestamp_ntz'2000-01-03 00:00:00'"


def _width_seconds(width: str) -> int:
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", width.lower())
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"unsupported bucket width: {width!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def time_bucket(ts, width: str) -> Column:
    """Floor ``ts`` to a bucket of ``width`` ('1 day', '7 hours', '15 minutes').

    Whole-number arithmetic on the microseconds since 2000-01-03, where a
    bucket of any width starts.  Keeps the input type (TIMESTAMP_NTZ stays
    NTZ); NULL stays NULL; several buckets can stand in one select.
    """
    micros = _width_seconds(width) * 1_000_000
    since = F.timestamp_diff("MICROSECOND", F.expr(_ORIGIN), _col(ts).cast("timestamp_ntz"))
    return F.timestamp_add("MICROSECOND", -F.pmod(since, F.lit(micros).cast("bigint")), _col(ts))


def day_of(ts) -> Column:
    """1-day bucket stored as a DATE (the daily table's key)."""
    return F.to_date(_col(ts))
