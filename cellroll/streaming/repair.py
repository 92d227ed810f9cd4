"""Bad lines that come back mended.

A reject of the backlog load (``load_arrivals(rejects=...)``) is known by its
line id, the digest of feed, file and text.  It is open until a corrected
text for its id was loaded:

    found/batch=n    bad lines of batch n: line_id, feed, source_file, line, reasons, copies
    tried/batch=n    corrected texts of batch n that are bad too; their rejects stay open
    closed/batch=n   line ids whose corrected text was good in batch n, with the text

A corrected line enters like one that has just arrived: it is checked, pairs
with the backlog (where the other feed's row still waits) and is published
once.  Equal bad lines of one file are one reject with a number of copies.
A line sent again after it was mended is not opened again.  Of several texts
for one id in a batch the first in text order is taken; texts for ids that
are unknown or closed are left out.

Every folder belongs to one batch and is written over when the batch is run
again; a batch looks at folders of earlier batches only, so it takes the
same corrections both times.  Rejects are joined by id and never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.publish import first_wins
from ..plans.full_load import good_rows, reject_rows
from ..sinks.tables import table_exists
from ..sources.feed import REJECT_COL

MENDED = "mended:"

_FOUND = f"line_id string, feed string, source_file string, line string, {REJECT_COL} string, copies bigint, batch bigint"
_CLOSED = "line_id string, line string, batch bigint"


def _read(spark: SparkSession, folder: str, schema: str, before: int | None) -> DataFrame:
    if not table_exists(spark, folder):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(folder)
    return rows if before is None else rows.where(F.col("batch") < before)


def all_rejects(spark: SparkSession, rejects: str, before: int | None = None) -> DataFrame:
    """One row for each line id as it was first found, with ``closed_in`` (batch; NULL while open) and the mended text.

    ``before``: as it stood before that batch.
    """
    found = _read(spark, f"{rejects}/found", _FOUND, before)
    first = first_wins(found, ["line_id"], ["batch"])
    closed = _read(spark, f"{rejects}/closed", _CLOSED, before).groupBy("line_id").agg(F.min(F.struct("batch", "line")).alias("c"))
    return first.join(closed, "line_id", "left").select(*first.columns, F.col("c.batch").alias("closed_in"), F.col("c.line").alias("mended"))


def open_rejects(spark: SparkSession, rejects: str, before: int | None = None) -> DataFrame:
    return all_rejects(spark, rejects, before).where(F.col("closed_in").isNull()).drop("closed_in", "mended")


def reject_report(spark: SparkSession, rejects: str) -> DataFrame:
    """feed, reasons, found, mended, open: numbers of distinct bad lines."""
    return all_rejects(spark, rejects).groupBy("feed", F.col(REJECT_COL).alias("reasons")).agg(
        F.count(F.lit(1)).alias("found"), F.count("closed_in").alias("mended"), F.count_if(F.col("closed_in").isNull()).alias("open"))


def fixes_of_lines(lines: DataFrame) -> DataFrame:
    """(line_id, line) of text lines: the id, a tab, the corrected line (which may hold tabs); others are left out."""
    at = F.locate("\t", F.col("value"))
    return lines.where(at > 0).select(F.substring("value", F.lit(1), at - 1).alias("line_id"), F.substring("value", at + 1, F.length("value")).alias("line"))


def chosen_fixes(spark: SparkSession, fixes: DataFrame, rejects: str, batch: int, path: str) -> DataFrame:
    """value, source_file, feed: a corrected line for each open reject that has one, written once to ``path``."""
    texts = first_wins(fixes.select("line_id", "line").where(F.col("line").isNotNull()), ["line_id"])
    known = open_rejects(spark, rejects, before=batch).select("line_id", "feed")
    lines = known.join(texts, "line_id").select(F.col("line").alias("value"), F.concat(F.lit(MENDED), "line_id").alias("source_file"), "feed")
    lines.write.parquet(path)
    return spark.read.schema(lines.schema).parquet(path)


def keep_rejects(spark: SparkSession, staged: dict, mended_lines: DataFrame | None, rejects: str, batch: int) -> None:
    """Write what batch ``batch`` found, tried in vain and closed, from its staged feeds: {feed: (path, spec)}.

    ``mended_lines``: the ``chosen_fixes`` among them.
    """
    mended = F.col("source_file").startswith(MENDED)
    line_id = F.substring("source_file", len(MENDED) + 1, 64)
    found, tried, closed = [], [], []
    for feed, (path, spec) in staged.items():
        bad = reject_rows(spark, path, spec).select(F.lit(feed).alias("feed"), F.coalesce("source_file", F.lit("")).alias("source_file"), "line", REJECT_COL)
        found.append(bad.where(~mended))
        tried.append(bad.where(mended).select(line_id.alias("line_id"), "line", REJECT_COL))
        closed.append(good_rows(spark, path, spec).where(mended).select("source_file"))
    new = found[0].unionByName(found[1]).groupBy("feed", "source_file", "line", REJECT_COL).agg(F.count(F.lit(1)).alias("copies"))
    new = new.withColumn("line_id", F.sha2(F.concat_ws("\n", "feed", "source_file", "line"), 256))
    new.write.mode("overwrite").parquet(f"{rejects}/found/batch={batch}")
    tried[0].unionByName(tried[1]).write.mode("overwrite").parquet(f"{rejects}/tried/batch={batch}")
    if mended_lines is None:
        return
    good = mended_lines.join(closed[0].unionByName(closed[1]), "source_file", "left_semi")
    good.select(line_id.alias("line_id"), F.col("value").alias("line")).write.mode("overwrite").parquet(f"{rejects}/closed/batch={batch}")
