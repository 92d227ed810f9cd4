"""Feed and table layouts.

A feed is described by a ``FeedSpec``: the target table's columns (name and
type, in table order), the order of the fields in the file, the separator,
the NULL marker, and whether a cell key is derived from two raw fields.
Nothing is inferred from the file; binding is positional in the file and by
name in the table.

Metric columns are never listed in code: they are every non-key column of a
table (``metrics_of``) or are supplied by the caller; ``metric_names`` makes
names for synthetic feeds.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Type names a FeedSpec accepts.  ``char(n)`` behaves like a blank-padded
# column: trailing blanks are cut on load and the rest must fit in n.
SPARK_TYPES = {
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}

# The key layout of the cell tables (hourly / staging), in
# table order, and of the daily table, where "date" replaces resulttime.
TIME_COL = "resulttime"
KEY_COL = "unique_id"
DIM_COLS = ("mbsc", "cellname", "cellindex", "lac", "ci")
HOURLY_KEYS = (TIME_COL, KEY_COL, *DIM_COLS)
DAILY_KEYS = ("date", KEY_COL, *DIM_COLS)
HOURLY_UNIQUE = (TIME_COL, KEY_COL)
DAILY_UNIQUE = ("date", KEY_COL)
CELL_KEY_TYPES = {
    TIME_COL: "timestamp",
    KEY_COL: "int",
    "mbsc": "char(100)",
    "cellname": "char(100)",
    "cellindex": "int",
    "lac": "int",
    "ci": "int",
}

def spark_type(type_name: str) -> T.DataType:
    if type_name.startswith("char("):
        return T.StringType()
    return SPARK_TYPES[type_name]


def char_width(type_name: str) -> int | None:
    if type_name.startswith("char(") and type_name.endswith(")"):
        return int(type_name[5:-1])
    return None


@dataclass(frozen=True)
class CellKey:
    """Derive ``name`` as the text concatenation of two raw fields.

    ``wide=False`` keeps the int4 key of the original tables (a 10-digit
    concatenation is out of range and is rejected); ``wide=True`` uses bigint.
    """

    name: str = KEY_COL
    left: str = "lac"
    right: str = "ci"
    wide: bool = False


@dataclass(frozen=True)
class FeedSpec:
    """How to turn delimited lines into typed rows of a target table.

    columns:     (name, type) of the target table in table order.
    fields:      file field names in file order; default = every column but
                 the derived key.  Columns not in ``fields`` (and not derived)
                 load as typed NULL.
    sep:         field separator, any string (taken literally); the two
                 characters backslash-t given as text mean a tab.
    header:      drop the first line of every input file.
    null_marker: a field equal to this text loads as NULL; None = no marker,
                 so an empty field is a value (and fails a numeric cast).
    cell_key:    derive a key column from two raw fields.
    not_null:    columns that must be present (default: all key columns of a
                 cell feed, nothing otherwise).
    """

    columns: tuple[tuple[str, str], ...]
    fields: tuple[str, ...] | None = None
    sep: str = ","
    header: bool = False
    null_marker: str | None = None
    cell_key: CellKey | None = None
    not_null: tuple[str, ...] = ()
    line_sep: str = "\n"

    def __post_init__(self):
        if self.sep == "\\t":
            object.__setattr__(self, "sep", "\t")
        if not self.sep:
            raise ValueError("empty separator")

    @property
    def column_names(self) -> tuple[str, ...]:
        return tuple(n for n, _ in self.columns)

    @property
    def file_fields(self) -> tuple[str, ...]:
        if self.fields is not None:
            return self.fields
        derived = {self.cell_key.name} if self.cell_key else set()
        return tuple(n for n in self.column_names if n not in derived)

    def with_options(self, **kw) -> "FeedSpec":
        return replace(self, **kw)

    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(n, spark_type(t), n not in self.not_null) for n, t in self.columns]
        )


def cell_feed_spec(metrics, *, sep=",", header=False, null_marker=None,
                   wide_key=False, fields=None) -> FeedSpec:
    """Spec of one counter feed: 7 key columns then ``metrics`` (doubles).

    File layout is the one of the exports: resulttime, mbsc, cellname,
    cellindex, lac, ci, metrics...; unique_id is derived from lac and ci.
    """
    cols = [(n, CELL_KEY_TYPES[n]) for n in HOURLY_KEYS]
    if wide_key:
        cols[1] = (KEY_COL, "bigint")
    cols += [(m, "double") for m in metrics]
    return FeedSpec(
        columns=tuple(cols),
        fields=tuple(fields) if fields is not None else None,
        sep=sep,
        header=header,
        null_marker=null_marker,
        cell_key=CellKey(wide=wide_key),
        not_null=HOURLY_KEYS,
    )


def table_spec(schema: T.StructType, **kw) -> FeedSpec:
    """Spec whose columns are those of an existing table schema."""
    names = {v: k for k, v in SPARK_TYPES.items()}
    cols = []
    for f in schema.fields:
        tname = names.get(f.dataType)
        if tname is None:
            raise TypeError(f"column {f.name}: type {f.dataType} is not loadable from text")
        cols.append((f.name, tname))
    return FeedSpec(columns=tuple(cols), **kw)


def metrics_of(df: DataFrame, keys=HOURLY_KEYS) -> list[str]:
    """Every column of ``df`` that is not a key (and not a partition 'date')."""
    skip = set(keys) | {"date"}
    return [c for c in df.columns if c not in skip]


def metric_names(n: int, prefix: str = "m") -> list[str]:
    """Names for the metrics of a synthetic feed: m000, m001, ..."""
    return [f"{prefix}{i:03d}" for i in range(n)]
