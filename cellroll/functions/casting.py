"""Typed coercion of raw text fields, with a reject reason per check.

Every cast is a ``try_cast`` so the result does not depend on the session's
ANSI setting; a field that is present but does not parse yields a reason
``cast:<column>`` instead of an exception.  The caller decides whether a
reason aborts the job (strict) or routes the row to the reject output.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import char_width, spark_type


# Written forms that the target types accept.  Spark's own casts take more:
# a type letter after a number ('1d') and dates without a month or day.
_FORMS = {
    "double": r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[+-]?(?i:inf|infinity)|(?i:nan))\s*$",
    "timestamp": r"^\s*\d{4,6}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?)?\s*$",
    "date": r"^\s*\d{4,6}-\d{1,2}-\d{1,2}\s*$",
}


def apply_null_marker(raw: Column, marker: str | None) -> Column:
    if marker is None:
        return raw
    return F.when(raw == F.lit(marker), F.lit(None).cast("string")).otherwise(raw)


def typed_value(raw: Column, type_name: str) -> Column:
    """Text -> value of ``type_name``; char(n) is right-trimmed, not cut."""
    width = char_width(type_name)
    if width is not None:
        return F.rtrim(raw)
    if type_name == "string":
        return raw
    form = _FORMS.get(type_name)
    if type_name == "double":
        # of these characters alone the cast takes plain numbers only; the pattern looks at the other fields
        odd = raw.rlike(r"[^0-9.eE+-]")
        return F.when(~odd | raw.rlike(form), raw).try_cast("double")
    if form is not None:
        raw = F.when(raw.rlike(form), raw)
    return raw.try_cast(spark_type(type_name))


def reasons(name: str, raw: Column, value: Column, type_name: str, not_null: bool) -> list[Column]:
    """Reject reasons of one column; each is NULL when the check passes."""
    out = []
    width = char_width(type_name)
    if width is not None:
        out.append(F.when(F.length(value) > width, F.lit(f"width:{name}")))
    elif type_name != "string":
        out.append(F.when(raw.isNotNull() & value.isNull(), F.lit(f"cast:{name}")))
    if not_null:
        out.append(F.when(value.isNull(), F.lit(f"null:{name}")))
    return out
