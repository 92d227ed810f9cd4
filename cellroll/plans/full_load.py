"""One full load: two feeds -> hourly history -> daily totals.

    counter files --parse/check--> staged counter --+
                                                    +--join (unique_id, resulttime)--> load
    qual files    --parse/check--> staged qual    --+
    load --insert-ignore--> hourly (partitioned by date)
    load --group by day + 6 dims, SUM(all metrics)--> insert-ignore --> daily
         (mode='recompute': touched dates of daily rebuilt from hourly)

Every intermediate table is written to a per-run folder under the shared
checkpoint folder, so each step starts from files (short lineage: a lost
executor re-reads a staged file, not the text export) and a failed step can
be re-run.  Nothing reaches the history tables unless both feeds parsed and
checked clean (on_error='raise'), and publication is insert-if-absent, so
re-running a whole load is harmless.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.time import day_of
from ..operators.combine import feed_join, feed_join_audit
from ..operators.publish import first_wins, insert_ignore_into
from ..operators.quality import duplicate_keys
from ..operators.rollup import daily_rows
from ..schema import DAILY_UNIQUE, DIM_COLS, HOURLY_KEYS, HOURLY_UNIQUE, KEY_COL, TIME_COL, FeedSpec
from ..session import delete_path, scratch_path, tune_wide
from ..sinks.tables import PARTITION_COL, overwrite_partitions, read_table, restrict_to
from ..sources.feed import REJECT_COL, is_bad, observe_totals, parse_lines, stop_at_bad
from ..sources.lines import read_lines
from .delta import load_fingerprint, publish_delta

def hourly_order():
    """Newest hour first inside each date's files."""
    return (F.col(TIME_COL).desc(), F.col(KEY_COL).asc())


def daily_order():
    return (F.col(KEY_COL).asc(),)


REPORT_DATES = 366


class LoadError(RuntimeError):
    pass


@dataclass
class LoadReport:
    work: str
    counter_lines: int = 0  # lines read per feed (observed while staging)
    qual_lines: int = 0
    counter_rejects: int = 0
    qual_rejects: int = 0
    counter_duplicates: int = 0
    qual_duplicates: int = 0
    joined: int = 0
    hourly_appended: int = 0
    daily_appended: int = 0
    recomputed: int = 0  # dates whose daily rows were rebuilt
    recomputed_dates: list = field(default_factory=list)  # the first REPORT_DATES of them


def stage_feed(spark: SparkSession, paths, spec: FeedSpec, out: str, on_error: str = "raise",
               totals: dict | None = None) -> DataFrame:
    """Parse one feed and write it once as Parquet, good and reject rows
    side by side (``status=good`` / ``status=reject``); returns the good rows.

    on_error='raise' fails the job at the first bad line instead.
    ``totals`` receives n_lines / n_rejects observed during the write.
    """
    return stage_lines(read_lines(spark, paths, header=spec.header, line_sep=spec.line_sep), spec, out, on_error, totals)


def stage_lines(lines: DataFrame, spec: FeedSpec, out: str, on_error: str = "raise", totals: dict | None = None) -> DataFrame:
    """``stage_feed`` for lines that are read already (value, source_file)."""
    spark = lines.sparkSession
    parsed, obs = observe_totals(parse_lines(lines, spec))
    bad = is_bad()
    if on_error == "raise":
        parsed = stop_at_bad(parsed)
    staged = parsed.select(*spec.column_names, F.when(bad, F.col("line")).alias("line"),
                           REJECT_COL, "source_file",
                           F.when(bad, F.lit("reject")).otherwise(F.lit("good")).alias("status"))
    staged.write.mode("errorifexists").partitionBy("status").parquet(out)
    if totals is not None:
        totals.update({k: int(v or 0) for k, v in obs.get.items()})
    return good_rows(spark, out, spec).select(*spec.column_names)


def staged_rows(spark: SparkSession, staged: str, spec: FeedSpec) -> DataFrame:
    # an empty feed leaves no file to take a schema from
    schema = spec.schema().add("line", "string").add(REJECT_COL, "string").add("source_file", "string").add("status", "string")
    return spark.read.schema(schema).parquet(staged)


def good_rows(spark: SparkSession, staged: str, spec: FeedSpec) -> DataFrame:
    return staged_rows(spark, staged, spec).filter(F.col("status") == "good")


def reject_rows(spark: SparkSession, staged: str, spec: FeedSpec) -> DataFrame:
    return staged_rows(spark, staged, spec).filter(F.col("status") == "reject")


def resolve_duplicates(feed: DataFrame, keys=HOURLY_UNIQUE) -> DataFrame:
    """First-wins for the keys that repeat; all other rows pass untouched by a sort or an order."""
    keys = list(keys)
    again = duplicate_keys(feed, keys).select(*keys)
    return feed.join(again, keys, "left_anti").select(*feed.columns).unionByName(first_wins(feed.join(again, keys, "left_semi").select(*feed.columns), keys))


def _duplicates(counter: DataFrame, qual: DataFrame) -> tuple[int, int]:
    """Rows in duplicated (resulttime, unique_id) keys of each feed, one job
    over the key columns of both staged feeds."""
    keys = list(HOURLY_UNIQUE)
    both = (counter.select(*keys, F.lit("counter").alias("feed"))
            .unionByName(qual.select(*keys, F.lit("qual").alias("feed"))))
    got = {r["feed"]: int(r["n"]) for r in
           duplicate_keys(both, [*keys, "feed"]).groupBy("feed").agg(F.sum("n").alias("n")).collect()}
    return got.get("counter", 0), got.get("qual", 0)


def run_load(spark: SparkSession, counter_paths, qual_paths, *, counter_spec: FeedSpec, qual_spec: FeedSpec,
             hourly_path: str, daily_path: str, mode: str = "ignore", on_error: str = "raise",
             work: str | None = None, cleanup: bool = True, ledger: str | None = None, load_id: str | None = None,
             sketch: str | None = None) -> LoadReport:
    """Load one pair of feed exports and publish them.

    mode='ignore'    (as the original): a daily row, once written, is never
                     changed; late hours reach hourly only.
    mode='recompute': the daily rows of every date the load touches are
                     rebuilt from hourly after it is published.
    mode='delta':    the same daily rows as 'recompute', from this load's new rows
                     and the totals so far in the folder ``ledger`` (see
                     ``plans.delta``); ``load_id`` names the load.
    on_error='raise': bad lines or duplicate keys in a feed stop the load
                     before anything is published.
    on_error='reject': bad lines are kept in the staged ``status=reject`` rows,
                     duplicates resolved first-wins; both are counted.
    hourly_path, daily_path: folders, or names of catalog tables.
    sketch: folder of hourly's key sketch (``sinks.sketches``): history dates
             that can't hold a key of the load are not opened (not with 'delta').
    cleanup: remove the staged tables at the end, also after a failed load;
             pass False to look at them (``reject_rows``, ``audit``).
    """
    if mode not in ("ignore", "recompute", "delta"):
        raise ValueError("mode must be 'ignore', 'recompute' or 'delta'")
    if (mode == "delta") != (ledger is not None):
        raise ValueError("mode 'delta' needs a ledger, the other modes have none")
    if mode == "delta" and sketch is not None:
        raise ValueError("mode 'delta' works without a sketch")
    tune_wide(spark, len(counter_spec.columns) + len(qual_spec.columns))
    work = work or scratch_path(spark, "load")
    if mode == "delta" and load_id is None:
        load_id = load_fingerprint(spark, counter_paths, qual_paths)
    try:
        return _load(spark, counter_paths, qual_paths, counter_spec, qual_spec, hourly_path, daily_path, mode, on_error, work, ledger, load_id, sketch)
    finally:
        if cleanup:
            delete_path(spark, work)


def _load(spark, counter_paths, qual_paths, counter_spec, qual_spec, hourly_path, daily_path, mode, on_error, work, ledger, load_id, sketch) -> LoadReport:
    rep = LoadReport(work=work)
    ct, qt = {}, {}
    counter = stage_feed(spark, counter_paths, counter_spec, f"{work}/counter", on_error, ct)
    qual = stage_feed(spark, qual_paths, qual_spec, f"{work}/qual", on_error, qt)
    rep.counter_lines, rep.qual_lines = ct.get("n_lines", 0), qt.get("n_lines", 0)
    rep.counter_duplicates, rep.qual_duplicates = _duplicates(counter, qual)
    if on_error == "raise":
        if rep.counter_duplicates or rep.qual_duplicates:
            raise LoadError(f"duplicate (resulttime, unique_id) rows: counter {rep.counter_duplicates}, "
                            f"qual {rep.qual_duplicates}; nothing published")
    else:
        rep.counter_rejects, rep.qual_rejects = ct.get("n_rejects", 0), qt.get("n_rejects", 0)
        if rep.counter_duplicates:
            counter = resolve_duplicates(counter)
        if rep.qual_duplicates:
            qual = resolve_duplicates(qual)

    join_and_publish(spark, counter, qual, counter_spec, qual_spec, hourly_path, daily_path, mode, work, rep, ledger, load_id, sketch)
    return rep


def join_and_publish(spark, counter: DataFrame, qual: DataFrame, counter_spec: FeedSpec, qual_spec: FeedSpec,
                     hourly_path: str, daily_path: str, mode: str, work: str, rep: LoadReport,
                     ledger: str | None = None, load_id: str | None = None, sketch: str | None = None) -> None:
    """Join two checked feeds (unique keys) and publish what pairs: hourly, then daily by ``mode``."""
    qual_metrics = [c for c in qual_spec.column_names if c not in set(counter_spec.column_names)]
    joined = feed_join(counter, qual, HOURLY_UNIQUE, qual_metrics)
    # rows, first and last date of the load, observed while it is written
    obs = Observation()
    joined = joined.observe(obs, F.count(F.lit(1)).alias("rows"), F.min(day_of(TIME_COL)).alias("low"), F.max(day_of(TIME_COL)).alias("high"))
    joined.write.mode("errorifexists").parquet(f"{work}/load")
    seen = obs.get
    rep.joined = int(seen["rows"])
    span = (seen["low"], seen["high"])
    load = spark.read.schema(joined.schema).parquet(f"{work}/load")
    metrics = [c for c in load.columns if c not in set(HOURLY_KEYS)]

    hourly_new = load.withColumn("date", day_of(TIME_COL))
    if mode == "delta":
        rep.hourly_appended, rep.recomputed = publish_delta(spark, hourly_new, span, hourly_path, daily_path, ledger, load_id, work, hourly_order())
        return
    # Within one load the keys are unique (checked or resolved above), so no
    # first-wins pass is needed before the anti-join.
    got = insert_ignore_into(spark, hourly_new, hourly_path, HOURLY_UNIQUE, dedup=False,
                             order_within=hourly_order(), span=span, sketch=sketch)
    rep.hourly_appended = int(got.get("appended", 0))

    if mode == "ignore":
        # the day's rows, first-wins within this load, written once: the
        # clash check and the append then read a small table instead of
        # running the wide roll-up twice
        daily = daily_rows(load, metrics)
        daily.write.mode("errorifexists").parquet(f"{work}/daily")
        daily_new = spark.read.schema(daily.schema).parquet(f"{work}/daily")
        got = insert_ignore_into(spark, daily_new, daily_path, DAILY_UNIQUE, dedup=False,
                                 order_within=daily_order(), span=span)
        rep.daily_appended = int(got.get("appended", 0))
    else:
        hourly = read_table(spark, hourly_path)
        if hourly is not None and rep.joined:
            # exactly the dates of the load, at any number of them; the literal range prunes folders
            hourly_new.select(PARTITION_COL).distinct().write.mode("errorifexists").parquet(f"{work}/dates")
            touched = spark.read.schema("date date").parquet(f"{work}/dates")
            hours = restrict_to(hourly, *span).join(touched, PARTITION_COL, "left_semi")
            rows = daily_rows(hours.drop(PARTITION_COL), metrics)
            overwrite_partitions(rows, daily_path, daily_order())
            rep.recomputed = touched.count()
            rep.recomputed_dates = [r[0] for r in touched.orderBy(PARTITION_COL).limit(REPORT_DATES).collect()]


def audit(spark: SparkSession, work: str, counter_spec: FeedSpec, qual_spec: FeedSpec) -> DataFrame:
    """Matched / unmatched key counts of a staged run (what the join dropped), run with cleanup=False."""
    c = good_rows(spark, f"{work}/counter", counter_spec)
    q = good_rows(spark, f"{work}/qual", qual_spec)
    return feed_join_audit(c, q)
