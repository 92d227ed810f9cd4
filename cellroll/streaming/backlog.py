"""Incremental loads without manifests: two folders of feed files, paired by key as they come.

Counter and quality files arrive in any order, a partner hours or days after
its feed.  A backlog table carries the rows that still lack their partner
from one micro-batch to the next:

    new counter rows + counter backlog --+
                                         +--join (unique_id, resulttime)--> publish hourly, daily
    new qual rows    + qual backlog    --+
    next backlog = rows of either side whose key is not in hourly

A key is published once.  Of several rows with one key of a feed the one of
the earliest batch counts; a file that is sent again, or a row whose key was
published before, leaves no trace: its key is in hourly.

Each batch reads the backlog version of the batch before it and writes its
own, so a batch that is run again after a crash (``foreachBatch`` is
at-least-once) starts from the same rows.  A version counts once both its
parts are complete.  The two newest versions are kept.

The backlog holds no rows but those without a partner, and nothing expires
by itself: late loads of old days must still publish.  ``backlog_report``
shows what waits and since when.

With ``rejects`` (a folder) bad lines are kept and may come back mended, see
``streaming.repair``.

Scale: a batch moves its own rows and the backlog.  Hourly is read for key
columns, on the dates that these rows span.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.time import day_of
from ..operators.quality import duplicate_keys
from ..plans.full_load import LoadError, LoadReport, join_and_publish, resolve_duplicates, stage_lines
from ..schema import HOURLY_UNIQUE, TIME_COL, FeedSpec
from ..session import delete_path, path_exists, scratch_path, tune_wide
from ..sinks.tables import read_table, restrict_to
from ..sources.lines import lines_of
from .repair import chosen_fixes, fixes_of_lines, keep_rejects

BATCH_COL = "_batch"
FEEDS = ("counter", "qual")


@dataclass
class BacklogReport(LoadReport):
    counter_waiting: int = 0  # backlog rows after the batch
    qual_waiting: int = 0


def _version(backlog: str, batch: int) -> str:
    return f"{backlog.rstrip('/')}/batch={batch}"


def _versions(spark: SparkSession, backlog: str) -> list[int]:
    """Batches with a folder, complete or not, newest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(backlog)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted((int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")), reverse=True)


def _complete(spark: SparkSession, backlog: str, batch: int) -> bool:
    return all(path_exists(spark, f"{_version(backlog, batch)}/{feed}/_SUCCESS") for feed in FEEDS)


def _schema(spec: FeedSpec) -> StructType:
    return StructType([StructField(BATCH_COL, LongType()), *spec.schema().fields])


def read_backlog(spark: SparkSession, backlog: str, feed: str, spec: FeedSpec, before: int | None = None) -> DataFrame:
    """Rows of ``feed`` that wait for their partner (batch of their arrival in ``_batch``), as the newest complete
    version has them; ``before``: the newest one of an earlier batch than this."""
    for batch in _versions(spark, backlog):
        if (before is None or batch < before) and _complete(spark, backlog, batch):
            return spark.read.schema(_schema(spec)).parquet(f"{_version(backlog, batch)}/{feed}")
    return spark.createDataFrame([], _schema(spec))


def backlog_report(spark: SparkSession, backlog: str, counter_spec: FeedSpec, qual_spec: FeedSpec) -> DataFrame:
    """feed, date, rows, first_batch: what waits, by the day of its hours, and the batch that brought the oldest."""
    both = [read_backlog(spark, backlog, feed, spec).select(F.lit(feed).alias("feed"), day_of(TIME_COL).alias("date"), BATCH_COL)
            for feed, spec in zip(FEEDS, (counter_spec, qual_spec), strict=True)]
    return both[0].unionByName(both[1]).groupBy("feed", "date").agg(F.count("*").alias("rows"), F.min(BATCH_COL).alias("first_batch"))


def _arrived(staged: DataFrame, waiting: DataFrame, batch: int, feed: str, on_error: str, path: str) -> tuple[DataFrame, int]:
    """Backlog and new rows of a feed with one row for each key, the earliest; and the repeats among the new rows.

    The backlog has one row for each key and is older than what came, so only new rows are compared with its
    keys, and what is left of them is written to ``path``.  Without a backlog and repeats nothing is moved.
    """
    again = int(duplicate_keys(staged, list(HOURLY_UNIQUE)).agg(F.sum("n")).first()[0] or 0)
    if again and on_error == "raise":
        raise LoadError(f"duplicate (resulttime, unique_id) rows in the {feed} files of one batch: {again}; nothing published")
    new = resolve_duplicates(staged) if again else staged
    backlog = not waiting.isEmpty()
    if backlog:
        keys = list(HOURLY_UNIQUE)
        new = new.join(waiting.select(*keys), keys, "left_anti").select(*staged.columns)
    if again or backlog:
        new.write.parquet(path)
        new = staged.sparkSession.read.schema(new.schema).parquet(path)
    new = new.select(F.lit(batch).cast("long").alias(BATCH_COL), *staged.columns)
    return (waiting.select(*new.columns).unionByName(new) if backlog else new), again


def load_arrivals(spark: SparkSession, counter_lines: DataFrame, qual_lines: DataFrame, batch: int, *, counter_spec: FeedSpec,
                  qual_spec: FeedSpec, hourly_path: str, daily_path: str, backlog: str, mode: str = "recompute",
                  on_error: str = "raise", rejects: str | None = None, fixes: DataFrame | None = None) -> BacklogReport:
    """One step: pair the lines that came with the backlog, publish, write the next backlog.

    ``rejects``: folder in which bad lines are kept (on_error='reject' only);
    ``fixes``: (line_id, line) corrected texts of open ones, which enter with this step.

    ``batch`` numbers rise from step to step; a step that is run again with
    its number leaves the same state.
    """
    if mode not in ("ignore", "recompute"):
        raise ValueError("mode must be 'ignore' or 'recompute'")
    if rejects is not None and on_error != "reject":
        raise ValueError("rejects are kept with on_error='reject' only")
    if fixes is not None and rejects is None:
        raise ValueError("fixes need the folder of the rejects")
    tune_wide(spark, len(counter_spec.columns) + len(qual_spec.columns))
    work = scratch_path(spark, "backlog")
    rep = BacklogReport(work=work)
    specs = {"counter": counter_spec, "qual": qual_spec}
    try:
        rows, mended = {}, None
        if fixes is not None:
            mended = chosen_fixes(spark, fixes, rejects, batch, f"{work}/fixes")
            counter_lines, qual_lines = (
                lines.select("value", "source_file").unionByName(mended.where(F.col("feed") == feed).select("value", "source_file"))
                for feed, lines in zip(FEEDS, (counter_lines, qual_lines), strict=True))
        for feed, lines in zip(FEEDS, (counter_lines, qual_lines), strict=True):
            totals = {}
            staged = stage_lines(lines, specs[feed], f"{work}/{feed}", on_error, totals)
            setattr(rep, f"{feed}_lines", totals.get("n_lines", 0))
            setattr(rep, f"{feed}_rejects", totals.get("n_rejects", 0))
            waiting = read_backlog(spark, backlog, feed, specs[feed], before=batch)
            rows[feed], again = _arrived(staged, waiting, batch, feed, on_error, f"{work}/{feed}-arrived")
            setattr(rep, f"{feed}_duplicates", again)
        join_and_publish(spark, *(rows[f].drop(BATCH_COL) for f in FEEDS), counter_spec, qual_spec, hourly_path, daily_path, mode, work, rep)
        for feed in reversed(FEEDS):
            setattr(rep, f"{feed}_waiting", _keep_waiting(spark, rows[feed], hourly_path, f"{_version(backlog, batch)}/{feed}"))
        if rejects is not None:
            keep_rejects(spark, {feed: (f"{work}/{feed}", specs[feed]) for feed in FEEDS}, mended, rejects, batch)
        for old in [b for b in _versions(spark, backlog) if b < batch][1:]:
            delete_path(spark, _version(backlog, old))
    finally:
        delete_path(spark, work)
    return rep


def _keep_waiting(spark: SparkSession, rows: DataFrame, hourly_path: str, path: str) -> int:
    """Write the rows whose key is not in hourly; their number."""
    hourly = read_table(spark, hourly_path)
    if hourly is not None:
        low, high = rows.agg(F.min(day_of(TIME_COL)), F.max(day_of(TIME_COL))).first()
        keys = list(HOURLY_UNIQUE)
        rows = rows.join(restrict_to(hourly, low, high).select(*keys), keys, "left_anti").select(*rows.columns)
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path).count()


def run_backlog(spark: SparkSession, counter_dir: str, qual_dir: str, *, counter_spec: FeedSpec, qual_spec: FeedSpec, hourly_path: str,
                daily_path: str, backlog: str, checkpoint: str, mode: str = "recompute", on_error: str = "raise",
                max_files_per_trigger: int = 1000, available_now: bool = True, reports: list | None = None,
                rejects: str | None = None, fixes_dir: str | None = None):
    """Load the files that come into two folders (and folders below them), in any order.

    ``checkpoint``: the stream's own folder; ``backlog``: the folder of the
    backlog versions.  Both belong together: with a new checkpoint the batch
    numbers begin again, so give it a new backlog too (nothing is published
    twice either way).  mode='recompute' by default, as the hours of a day
    may pair in any batch.  ``rejects``: see ``load_arrivals``; ``fixes_dir``: a
    folder of text files with a line id, a tab and the corrected line in each line.
    """

    def stream(feed: str, folder: str, spec: FeedSpec) -> DataFrame:
        lines = (spark.readStream.format("text").option("lineSep", spec.line_sep).option("recursiveFileLookup", "true")
                 .option("maxFilesPerTrigger", max_files_per_trigger).load(folder))
        return lines_of(lines, header=spec.header, line_sep=spec.line_sep).select("value", "source_file", F.lit(feed).alias("feed"))

    def load_batch(batch: DataFrame, epoch: int) -> None:
        counter, qual, fixes = (batch.where(F.col("feed") == f).drop("feed") for f in (*FEEDS, "fixes"))
        rep = load_arrivals(batch.sparkSession, counter, qual, epoch, counter_spec=counter_spec, qual_spec=qual_spec,
                            hourly_path=hourly_path, daily_path=daily_path, backlog=backlog, mode=mode, on_error=on_error,
                            rejects=rejects, fixes=fixes_of_lines(fixes) if fixes_dir else None)
        if reports is not None:
            reports.append((epoch, rep))

    both = stream("counter", counter_dir, counter_spec).unionByName(stream("qual", qual_dir, qual_spec))
    if fixes_dir:
        texts = spark.readStream.format("text").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files_per_trigger).load(fixes_dir)
        both = both.unionByName(texts.select("value", F.lit(None).cast("string").alias("source_file"), F.lit("fixes").alias("feed")))
    writer = both.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
