"""Write rows as delimited text lines (exports and test feeds)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.text import join_fields

_NO_QUOTE = "\u0000"


def to_lines(df: DataFrame, cols=None, sep: str = ",", null_text: str = "") -> DataFrame:
    """DataFrame[value] with one delimited line per row (no quoting)."""
    cols = list(cols) if cols is not None else df.columns
    return df.select(join_fields(cols, sep, null_text).alias("value"))


def write_lines(df: DataFrame, path: str, cols=None, *, sep: str = ",", header: bool = False,
                null_text: str = "", mode: str = "errorifexists") -> str:
    """Write ``df`` as plain delimited text files under ``path``.

    With ``header=True`` every output file starts with the column names.
    Values are written as they are: no quotes, no escapes, no trimming.
    """
    cols = list(cols) if cols is not None else df.columns
    lines = to_lines(df, cols, sep, null_text)
    if header:
        (lines.withColumnRenamed("value", sep.join(cols)).write.mode(mode)
         .option("header", True).option("sep", "\u0001").option("quote", _NO_QUOTE)
         .option("escapeQuotes", False).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).option("emptyValue", "")
         .option("lineSep", "\n").csv(path))
    else:
        lines.write.mode(mode).option("lineSep", "\n").text(path)
    return path
