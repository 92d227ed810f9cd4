"""Cell key: text concatenation of the raw lac and ci fields.

The key is built from the text as it appears in the file, before lac and ci
are cast: ``'12' || '045'`` is 12045 while ``'12' || '45'`` is 1245, and
leading zeros of lac vanish in the cast.  Different (lac, ci) pairs can map
to one key (see ``operators.quality.cell_key_collisions``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def cell_key_text(lac_raw, ci_raw) -> Column:
    return F.concat(_col(lac_raw), _col(ci_raw))


def cell_key(lac_raw, ci_raw, wide: bool = False) -> Column:
    """Key as int (default, NULL when out of range or not a number) or bigint."""
    return cell_key_text(lac_raw, ci_raw).try_cast("bigint" if wide else "int")
