"""Delimited line source.

Lines are read whole, as one string column; fields are split later with a
plain split so that quotes and escapes have no meaning, like the exports this
library loads.  Uncompressed files are split across tasks by the file
source, so one large export is read in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_cr


def starts_file() -> Column:
    """True at the first line of every file, in rows of the text source.

    A task reads whole blocks of files one after another, so a file's line 1
    is the first row of a run of rows of its block at byte 0.  The function
    sees two numbers of each row, not the line, and keeps the last ones it
    saw: no second reading and no exchange, in batches and streams alike.
    """

    def first_rows(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        last = None
        for file, block in batches:
            file, block = file.to_numpy(), block.to_numpy()
            new = np.ones(len(file), dtype=bool)
            new[1:] = (file[1:] != file[:-1]) | (block[1:] != block[:-1])
            if len(file):
                new[0] = last != (file[0], block[0])
                last = file[-1], block[-1]
            yield pd.Series(new & (block == 0))

    udf = F.pandas_udf(first_rows, "boolean").asNondeterministic()
    return udf(F.xxhash64("_metadata.file_path"), F.col("_metadata.file_block_start"))


def lines_of(df: DataFrame, *, header: bool = False, line_sep: str = "\n") -> DataFrame:
    """DataFrame[value: string, source_file: string] of rows of the text source, batch or stream."""
    file = F.col("_metadata.file_path").alias("source_file")
    value = (strip_cr("value") if line_sep == "\n" else F.col("value")).alias("value")
    if not header:
        return df.select(value, file)
    return df.select(value, file, starts_file().alias("_first")).where(~F.col("_first")).drop("_first")


def read_lines(spark: SparkSession, paths, *, header: bool = False, line_sep: str = "\n") -> DataFrame:
    """Read newline-separated records as DataFrame[value: string, source_file: string].

    Every line is kept, blank lines too (a blank line is a record, and fails
    the arity check later).  header=True: exactly the first line of every
    file is dropped, blank or not, however the file is split.  A path that is
    given twice is read once.
    With ``line_sep='\\n'`` a trailing '\\r' is removed, so CRLF files load;
    a lone '\\r' inside a line is data.
    """
    paths = [paths] if isinstance(paths, str) else list(dict.fromkeys(paths))
    return lines_of(spark.read.format("text").option("lineSep", line_sep).load(paths), header=header, line_sep=line_sep)
