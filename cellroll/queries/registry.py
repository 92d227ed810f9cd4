"""Registered queries and their DuckDB oracles.

Each query takes (spark, sf_dir) and returns a DataFrame over the driver
tables (or text exports Spark derives from them).  ``ORACLES`` holds the SQL
that states the expected result; column names match.  Sums of doubles that
are not whole numbers are rounded to 2 places on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import cell_key, cell_key_text
from ..functions.text import field, reshape_line, split_fields
from ..functions.time import day_of, time_bucket
from ..operators.cells import as_of, cell_intervals, conflict_names
from ..operators.combine import feed_join, feed_join_audit, unmatched_keys
from ..operators.exact import exact_daily_rollup, exact_sums
from ..operators.newest import newest_rows
from ..operators.publish import first_wins, insert_ignore
from ..operators.quality import cell_key_collisions, duplicate_keys, quality_report
from ..operators.rollup import daily_rows, round_metrics, sum_metrics
from ..operators.stats import load_totals
from ..plans.full_load import run_load
from ..plans.ledger import loaded_files, run_once
from ..schema import HOURLY_KEYS, KEY_COL, TIME_COL, FeedSpec, cell_feed_spec, metric_names, table_spec
from ..session import scratch_path, tune_wide
from ..sinks.tables import write_staging
from ..sources.feed import load_feed, parse_lines
from ..sources.lines import read_lines
from ..streaming.backlog import backlog_report, load_arrivals
from ..streaming.incremental import run_incremental, write_manifest
from ..streaming.repair import open_rejects, reject_report
from . import feeds as fx

LINEITEM_ORDER = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus", "l_shipdate")
LINEITEM_KEY = ("l_orderkey", "l_linenumber")
SPLIT_DATE = "1998-01-01"


def _li(spark, sf):
    return fx.table(spark, sf, "lineitem")


def _lineitem_spec(spark, sf, **kw):
    return table_spec(_li(spark, sf).schema, **kw)


def in_files(df, least):
    """At least ``least`` partitions, so that as many files are written; a larger table keeps those of its scan,
    and no task gets a share that grows with the table."""
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)


def _lineitem_export(spark, sf, name, sep=",", header=False, where=None, parts=None):
    def build():
        df = _li(spark, sf)
        if where is not None:
            df = df.filter(where)
        return in_files(df, parts) if parts else df
    return fx.cached_export(spark, name, sf, build, sep=sep, header=header)


# ------------------------------------------------------------------ loading

def q_load_lines_comma(spark, sf):
    path = _lineitem_export(spark, sf, "lineitem-comma")
    return load_feed(spark, path, _lineitem_spec(spark, sf)).rows


def q_load_lines_tab(spark, sf):
    path = _lineitem_export(spark, sf, "lineitem-tab", sep="\t")
    return load_feed(spark, path, _lineitem_spec(spark, sf, sep="\t")).rows


def q_load_skip_header(spark, sf):
    path = _lineitem_export(spark, sf, "lineitem-header", header=True, parts=4)
    return load_feed(spark, path, _lineitem_spec(spark, sf, header=True)).rows


COLUMN_LIST = ("l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


def q_load_column_list(spark, sf):
    def build():
        return _li(spark, sf).select(*COLUMN_LIST)
    path = fx.cached_export(spark, "lineitem-columns", sf, build)
    return load_feed(spark, path, _lineitem_spec(spark, sf, fields=COLUMN_LIST)).rows


def q_load_null_marker(spark, sf):
    def build():
        ev = fx.table(spark, sf, "events")
        return ev.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    path = fx.cached_export(spark, "events-null", sf, build, null_text="NULL")
    spec = table_spec(fx.table(spark, sf, "events").schema, null_marker="NULL")
    return load_feed(spark, path, spec).rows


def q_load_replace(spark, sf):
    spec = _lineitem_spec(spark, sf)
    first = _lineitem_export(spark, sf, "lineitem-before", where=F.col("l_shipdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz"))
    second = _lineitem_export(spark, sf, "lineitem-after", where=F.col("l_shipdate") >= F.lit(SPLIT_DATE).cast("timestamp_ntz"))
    staging = scratch_path(spark, "staging", "lineitem")
    write_staging(load_feed(spark, first, spec).rows, staging, truncate=True)
    write_staging(load_feed(spark, second, spec).rows, staging, truncate=True)
    return spark.read.parquet(staging)


def q_split_fields(spark, sf):
    li = _li(spark, sf)
    lines = li.select(F.concat_ws(",", F.col("l_orderkey").cast("string"), "l_returnflag", F.lit(""),
                                  "l_linestatus", F.lit("")).alias("value"))
    f = split_fields("value", ",")
    return lines.select(F.size(f).alias("n_fields"), field(f, 0).alias("f0"), field(f, 1).alias("f1"),
                        field(f, 2).alias("f2"), field(f, 4).alias("f4"), field(f, 7).alias("f7"))


def q_lines_roundtrip(spark, sf):
    path = fx.export_feed(spark, sf, "counter")
    return read_lines(spark, path).select(reshape_line("value", ",").alias("value"))


def _key_parts(spark, sf, overflow=False):
    ev = fx.table(spark, sf, "events")
    if overflow:
        lac = F.when(F.col("event_type") == "error", F.lit(60000) + F.col("user_id") % 7) \
               .otherwise(F.lit(100) + F.col("user_id") % 7).cast("string")
        ci = (F.lit(10000) + F.col("event_id") % 113).cast("string")
    else:
        lac = (F.col("user_id") % 7).cast("string")
        m = (F.col("event_id") % 113).cast("string")
        ci = F.when(F.col("event_type") == "view", F.lpad(m, 3, "0")).otherwise(m)
    return ev.select("event_id", lac.alias("lac_raw"), ci.alias("ci_raw"))


def q_cell_key(spark, sf):
    k = _key_parts(spark, sf)
    return k.select("event_id", "lac_raw", "ci_raw", cell_key("lac_raw", "ci_raw").alias(KEY_COL))


def q_cell_key_overflow(spark, sf):
    k = _key_parts(spark, sf, overflow=True)
    return k.select("event_id", cell_key_text("lac_raw", "ci_raw").alias("key_text"),
                    cell_key("lac_raw", "ci_raw").alias(KEY_COL),
                    cell_key("lac_raw", "ci_raw", wide=True).alias("unique_id_wide"),
                    cell_key("lac_raw", "ci_raw").isNotNull().alias("key_ok"))


def q_cell_key_collisions(spark, sf):
    k = _key_parts(spark, sf)
    cells = k.select(cell_key("lac_raw", "ci_raw").alias(KEY_COL), F.col("lac_raw").cast("int").alias("lac"),
                     F.col("ci_raw").cast("int").alias("ci"))
    return cell_key_collisions(cells)


def _bad_tax():
    return (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")


def _short_line():
    # evaluated on the text columns of the export
    return (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == "7")


def _dirty_lineitem(spark, sf):
    def build():
        li = _li(spark, sf)
        cols = [F.when(_bad_tax(), F.lit("n/a")).otherwise(F.col(c).cast("string")).alias(c) if c == "l_tax"
                else F.col(c).cast("string").alias(c) for c in li.columns]
        text = li.select(*cols)
        full = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in li.columns])
        short = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in li.columns[:-1]])
        return text.select(F.when(_short_line(), short).otherwise(full).alias("value"))
    return fx.cached_export(spark, "lineitem-dirty", sf, build)


def q_typed_cast(spark, sf):
    path = _dirty_lineitem(spark, sf)
    return load_feed(spark, path, _lineitem_spec(spark, sf), on_error="reject").rows


def q_cast_reject(spark, sf):
    path = _dirty_lineitem(spark, sf)
    rej = load_feed(spark, path, _lineitem_spec(spark, sf), on_error="reject").rejects
    f = split_fields("line", ",")
    return rej.select(field(f, 0).cast("bigint").alias("l_orderkey"), field(f, 3).cast("int").alias("l_linenumber"),
                      F.col("reject_reasons").alias("reason"))


# ---------------------------------------------------------------- quality

QUALITY_SPEC = cell_feed_spec(["value"], null_marker="NULL")


def _quality_lines(spark, sf):
    def build():
        ev = fx.table(spark, sf, "events")
        t = F.col("event_type")
        u = F.col("user_id")
        lac = (F.lit(100) + u % 10).cast("string")
        cellname = F.when(t == "signup", F.lit("X" * 101)).otherwise(F.concat(F.lit("CELL"), u.cast("string")))
        mbsc = F.when(t == "error", F.lit("NULL")).otherwise(F.concat(F.lit("MBSC"), (u % 3).cast("string")))
        value = F.when((t == "click") & (F.col("value") < 1), F.lit("bad")).otherwise(F.col("value").cast("string"))
        head = [time_bucket("ts", "1 hour").cast("string"), mbsc, cellname, u.cast("string"), lac, u.cast("string")]
        full = F.concat_ws(",", *head, value)
        short = F.concat_ws(",", *head)
        return ev.select(F.when((t == "purchase") & (F.col("value") >= 400), short).otherwise(full).alias("value"))
    return fx.cached_export(spark, "events-quality", sf, build)


def q_quality_report(spark, sf):
    parsed = parse_lines(read_lines(spark, _quality_lines(spark, sf)), QUALITY_SPEC)
    return quality_report(parsed).withColumnRenamed("check", "check_name")


def q_duplicate_keys(spark, sf):
    return duplicate_keys(_li(spark, sf), LINEITEM_KEY)


# ----------------------------------------------------------- join, rollup

def _feeds(spark, sf, renamed=False, part=None):
    ev = fx.table(spark, sf, "events")
    if part is not None:
        ev = fx.half(ev, part)
    return fx.counter_rows(ev, renamed), fx.qual_rows(ev)


def q_feed_join(spark, sf):
    c, q = _feeds(spark, sf)
    return feed_join(c, q)


def q_feed_join_audit(spark, sf):
    c, q = _feeds(spark, sf)
    return feed_join_audit(c, q)


def q_feed_unmatched(spark, sf):
    c, q = _feeds(spark, sf)
    return unmatched_keys(c, q)


def q_time_bucket_day(spark, sf):
    ev = fx.table(spark, sf, "events")
    return ev.select("event_id", "ts", day_of("ts").alias("date"))


def q_time_bucket_hour(spark, sf):
    ev = fx.table(spark, sf, "events")
    g = ev.groupBy(time_bucket("ts", "1 hour").alias("bucket"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 2).alias("total"))
    return g


def q_time_bucket_week(spark, sf):
    ev = fx.table(spark, sf, "events")
    return ev.groupBy(time_bucket("ts", "7 days").alias("bucket")).agg(F.count(F.lit(1)).alias("n_events"))


def q_daily_rollup(spark, sf):
    c, q = _feeds(spark, sf)
    return round_metrics(daily_rows(feed_join(c, q), list(fx.ALL_METRICS)), fx.ALL_METRICS, 2)


def q_daily_conflict(spark, sf):
    c, q = _feeds(spark, sf, renamed=True)
    return round_metrics(daily_rows(feed_join(c, q), list(fx.ALL_METRICS)), fx.ALL_METRICS, 2)


def q_first_wins(spark, sf):
    return first_wins(_li(spark, sf), LINEITEM_KEY, list(LINEITEM_ORDER))


def q_insert_ignore(spark, sf):
    li = _li(spark, sf)
    cut = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    target = first_wins(li.filter(F.col("l_shipdate") < cut), LINEITEM_KEY, list(LINEITEM_ORDER))
    new = li.filter(F.col("l_shipdate") >= cut)
    return insert_ignore(target, new, LINEITEM_KEY, list(LINEITEM_ORDER))


def q_hourly_latest(spark, sf):
    c, q = _feeds(spark, sf)
    return first_wins(feed_join(c, q), [KEY_COL], [F.col(TIME_COL).desc()])


def q_load_totals(spark, sf):
    path = _lineitem_export(spark, sf, "lineitem-comma")
    return load_totals(read_lines(spark, path), _lineitem_spec(spark, sf))


WIDE_METRICS = metric_names(379)


def _wide_sql_expr(j: int) -> str:
    """Metric j of the wide roll-up; whole numbers, so sums are exact."""
    if j % 3 == 0:
        return f"l_quantity * {float(j + 1)}"
    if j % 3 == 1:
        return f"CAST(l_linenumber AS DOUBLE) * {float(j + 1)}"
    return f"CASE WHEN l_returnflag <> 'R' THEN l_quantity + {float(j)} END"


def q_wide_rollup(spark, sf):
    tune_wide(spark, len(WIDE_METRICS) + 8)
    dims = ["year_start", "l_suppkey", "l_returnflag", "l_linestatus"]
    rows = _li(spark, sf).selectExpr("trunc(l_shipdate, 'year') AS year_start", *dims[1:], "l_quantity", "l_linenumber")
    return sum_metrics(rows, dims, {m: F.expr(_wide_sql_expr(j)) for j, m in enumerate(WIDE_METRICS)})


# ------------------------------------------------------- publish to tables

def _load(spark, sf, hourly, daily, part=None, mode="ignore", **kw):
    c = fx.export_feed(spark, sf, "counter", part)
    q = fx.export_feed(spark, sf, "qual", part)
    return run_load(spark, c, q, counter_spec=fx.COUNTER_SPEC, qual_spec=fx.QUAL_SPEC,
                    hourly_path=hourly, daily_path=daily, mode=mode, **kw)


def _targets(spark):
    base = scratch_path(spark, "tables")
    return f"{base}/hourly", f"{base}/daily"


def _hourly_cols():
    return [*HOURLY_KEYS, *fx.ALL_METRICS]


def _daily(spark, path):
    d = spark.read.parquet(path)
    cols = ["date", KEY_COL, "mbsc", "cellname", "cellindex", "lac", "ci", *fx.ALL_METRICS]
    return round_metrics(d.select(*cols), fx.ALL_METRICS, 2)


def q_full_load_hourly(spark, sf):
    hourly, daily = _targets(spark)
    _load(spark, sf, hourly, daily)
    return spark.read.parquet(hourly).select(*_hourly_cols())


def q_full_load_daily(spark, sf):
    hourly, daily = _targets(spark)
    _load(spark, sf, hourly, daily)
    return _daily(spark, daily)


def q_replay_idempotent(spark, sf):
    hourly, daily = _targets(spark)
    _load(spark, sf, hourly, daily)
    _load(spark, sf, hourly, daily)
    return spark.read.parquet(hourly).select(*_hourly_cols())


def q_replay_daily(spark, sf):
    hourly, daily = _targets(spark)
    _load(spark, sf, hourly, daily)
    _load(spark, sf, hourly, daily)
    return _daily(spark, daily)


def q_recompute_keeps_other_days(spark, sf):
    """Recompute loads rebuild the dates they touch; a frozen earlier day stays as it was published.

    Part 0 is published with mode='ignore' (whole days of hours before noon), then the later hours of all
    dates but the first three are loaded with mode='recompute'.
    """
    hourly, daily = _targets(spark)
    _load(spark, sf, hourly, daily, part=0)
    ev = fx.half(fx.table(spark, sf, "events"), 1)
    first = ev.agg(F.min(F.to_date("ts"))).first()[0]
    late = ev.where(F.to_date("ts") > F.date_add(F.lit(first), 2))
    feeds = []
    for kind, rows, metrics in (("counter", fx.counter_rows(late), fx.COUNTER_METRICS), ("qual", fx.qual_rows(late), fx.QUAL_METRICS)):
        feeds.append(fx.cached_export(spark, f"{kind}-late", sf, lambda r=rows, m=metrics: r.select(*fx.FILE_ORDER, *m), null_text="NULL"))
    # hours of the first three dates after noon reach hourly without a recompute
    early = ev.where(F.to_date("ts") <= F.date_add(F.lit(first), 2))
    old = []
    for kind, rows, metrics in (("counter", fx.counter_rows(early), fx.COUNTER_METRICS), ("qual", fx.qual_rows(early), fx.QUAL_METRICS)):
        old.append(fx.cached_export(spark, f"{kind}-early", sf, lambda r=rows, m=metrics: r.select(*fx.FILE_ORDER, *m), null_text="NULL"))
    kw = dict(counter_spec=fx.COUNTER_SPEC, qual_spec=fx.QUAL_SPEC, hourly_path=hourly, daily_path=daily)
    run_load(spark, *old, mode="ignore", **kw)
    run_load(spark, *feeds, mode="recompute", **kw)
    return _daily(spark, daily)


def q_full_load_empty_qual(spark, sf):
    """An empty quality feed joins with nothing; the feed after it loads as usual."""
    hourly, daily = _targets(spark)
    empty = fx.cached_export(spark, "qual-empty", sf, lambda: fx.qual_rows(fx.table(spark, sf, "events")).select(*fx.FILE_ORDER, *fx.QUAL_METRICS).where(F.lit(False)), null_text="NULL")
    run_load(spark, fx.export_feed(spark, sf, "counter"), empty, counter_spec=fx.COUNTER_SPEC, qual_spec=fx.QUAL_SPEC,
             hourly_path=hourly, daily_path=daily)
    _load(spark, sf, hourly, daily)
    return spark.read.parquet(hourly).select(*_hourly_cols())


def q_time_bucket_odd_widths(spark, sf):
    ev = fx.table(spark, sf, "events")
    return ev.select("event_id", *[time_bucket("ts", w).alias(n) for n, w in ODD_WIDTHS.items()])


ODD_WIDTHS = {"b7m": "7 minutes", "b5h": "5 hours", "b7h": "7 hours", "b36h": "36 hours", "b7d": "7 days"}


def q_time_bucket_nulls(spark, sf):
    ev = fx.table(spark, sf, "events")
    ts = F.when(F.col("event_type") != "error", F.col("ts"))
    return ev.groupBy(time_bucket(ts, "6 hours").alias("bucket")).agg(F.count(F.lit(1)).alias("n_events"))


def q_cast_strict_forms(spark, sf):
    """Numbers with a type letter and dates without a day are refused."""
    def build():
        ev = fx.table(spark, sf, "events")
        value = F.concat(F.col("event_id").cast("string"), F.when(F.col("event_type") == "click", F.lit("d")).when(F.col("event_type") == "view", F.lit(".5")).otherwise(F.lit("")))
        when = F.date_format("ts", "yyyy-MM")
        when = F.when(F.col("event_type") == "error", when).otherwise(F.concat(when, F.lit("-01 00:00:00")))
        return ev.select(F.concat_ws(",", F.col("event_id").cast("string"), when, value).alias("value"))
    path = fx.cached_export(spark, "events-forms", sf, build)
    spec = FeedSpec(columns=(("event_id", "bigint"), ("ts", "timestamp"), ("value", "double")))
    parsed = parse_lines(read_lines(spark, path), spec)
    return parsed.select("event_id", "ts", "value", F.col("reject_reasons").alias("reason"))


def q_load_skip_header_blank(spark, sf):
    """Files whose first line is blank, and blank lines inside: exactly line 1 of each file goes."""
    def build():
        li = _li(spark, sf).select(F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("value"), "l_orderkey", "l_linenumber")
        blank = in_files(li, 3).select(F.posexplode(F.when((F.col("l_orderkey") % 7 == 0) & (F.col("l_linenumber") == 1), F.array("value", F.lit(""))).otherwise(F.array("value"))).alias("pos", "value"))
        return blank.select("value")
    path = fx.cached_export(spark, "lineitem-blank", sf, build)
    # put one line before each file's first: a blank one, by reading the export as lines of new files; a task
    # writes one file, and its rows' ids count from 0 in the lower 33 bits
    files = scratch_path(spark, "blank-first")
    body = in_files(read_lines(spark, path), 3).select("value", ((F.monotonically_increasing_id() % (1 << 33)) == 0).alias("first"))
    body = body.select(F.explode(F.when(F.col("first"), F.array(F.lit(""), "value")).otherwise(F.array("value"))).alias("value"))
    body.write.option("lineSep", "\n").option("maxRecordsPerFile", 0).text(files)
    lines = read_lines(spark, files, header=True)
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def q_daily_late_ignore(spark, sf):
    hourly, daily = _targets(spark)
    _load(spark, sf, hourly, daily, part=0)
    _load(spark, sf, hourly, daily, part=1)
    return _daily(spark, daily)


def q_daily_late_recompute(spark, sf):
    hourly, daily = _targets(spark)
    _load(spark, sf, hourly, daily, part=0, mode="recompute")
    _load(spark, sf, hourly, daily, part=1, mode="recompute")
    return _daily(spark, daily)


def q_daily_late_delta(spark, sf):
    """The rows of ``daily_late_recompute``, each load added to the totals so far; the first one is sent twice."""
    hourly, daily = _targets(spark)
    ledger = scratch_path(spark, "ledger")
    for part in (0, 1, 0):
        _load(spark, sf, hourly, daily, part=part, mode="delta", ledger=ledger)
    return _daily(spark, daily)


def q_incremental_daily(spark, sf):
    """The two half-day loads of ``daily_late_ignore``, driven by a manifest stream."""
    hourly, daily = _targets(spark)
    manifests = scratch_path(spark, "manifests")
    for part in (0, 1):
        pair = (fx.export_feed(spark, sf, "counter", part), fx.export_feed(spark, sf, "qual", part))
        write_manifest(spark, manifests, [pair], part)
    run_incremental(spark, manifests, checkpoint=scratch_path(spark, "stream"), counter_spec=fx.COUNTER_SPEC, qual_spec=fx.QUAL_SPEC,
                    hourly_path=hourly, daily_path=daily)
    return _daily(spark, daily)


# sums of these have no round values; both engines compute the same doubles
EXACT = {"price": "l_extendedprice", "net": "l_extendedprice * (1 - l_discount)", "small": "l_discount * l_tax", "signed": "(l_tax - 0.04) * l_quantity"}


def q_exact_sums(spark, sf):
    """Sums of doubles, every bit of them: no rounding here or in the SQL."""
    rows = _li(spark, sf).selectExpr("l_returnflag", "year(l_shipdate) as year", *[f"{x} as {m}" for m, x in EXACT.items()])
    return exact_sums(rows, ["l_returnflag", "year"], list(EXACT))


def q_daily_rollup_exact(spark, sf):
    ev = fx.table(spark, sf, "events")
    return exact_daily_rollup(feed_join(fx.counter_rows(ev), fx.qual_rows(ev), ("resulttime", KEY_COL), fx.QUAL_METRICS), fx.ALL_METRICS)


def _renamed(spark, sf):
    return fx.counter_rows(fx.table(spark, sf, "events"), renamed=True)


def q_cell_intervals(spark, sf):
    return cell_intervals(_renamed(spark, sf))


def q_daily_conflict_names(spark, sf):
    return conflict_names(_renamed(spark, sf))


def q_cells_as_of(spark, sf):
    """Quality rows with the name their cell had in the counter feed at that hour."""
    rows = fx.qual_rows(fx.table(spark, sf, "events")).select("resulttime", KEY_COL, "q_n")
    return as_of(rows, cell_intervals(_renamed(spark, sf)), ["cellname"])


def q_newest_rows(spark, sf):
    """The three newest hours of every cell in the hourly table."""
    hourly, daily = _targets(spark)
    _load(spark, sf, hourly, daily)
    cells = spark.read.parquet(hourly).select(KEY_COL).distinct()
    return newest_rows(spark, hourly, cells, 3).select(*_hourly_cols())


def _arrivals(spark, sf):
    """Half-day feeds in three steps, partners apart: counter 1st half and qual 2nd half; counter 2nd half;
    qual 1st half with a repeat of counter 1st half.  Returns the hourly and daily targets."""
    hourly, daily = _targets(spark)
    backlog = scratch_path(spark, "arrivals")
    steps = [("counter", 0, "qual", 1), ("counter", 1, None, None), ("counter", 0, "qual", 0)]
    nothing = spark.createDataFrame([], "value string, source_file string")
    for batch, (cf, cp, qf, qp) in enumerate(steps):
        counter, qual = (read_lines(spark, fx.export_feed(spark, sf, f, p)) if f else nothing for f, p in ((cf, cp), (qf, qp)))
        load_arrivals(spark, counter, qual, batch, counter_spec=fx.COUNTER_SPEC, qual_spec=fx.QUAL_SPEC,
                      hourly_path=hourly, daily_path=daily, backlog=backlog)
    return hourly, daily, backlog


def q_backlog_hourly(spark, sf):
    hourly, _, _ = _arrivals(spark, sf)
    return spark.read.parquet(hourly).select(*_hourly_cols())


def q_backlog_daily(spark, sf):
    _, daily, _ = _arrivals(spark, sf)
    return _daily(spark, daily)


def q_backlog_waiting(spark, sf):
    """What never found its partner, by feed and day."""
    _, _, backlog = _arrivals(spark, sf)
    return backlog_report(spark, backlog, fx.COUNTER_SPEC, fx.QUAL_SPEC).select("feed", "date", "rows")


def q_sketched_hourly(spark, sf):
    """History from overlapping loads (early hours, everything, late hours) decided by key sketches."""
    hourly, daily = _targets(spark)
    sketch = scratch_path(spark, "sketch")
    for part in (0, None, 1):
        _load(spark, sf, hourly, daily, part=part, sketch=sketch)
    return spark.read.parquet(hourly).select(*_hourly_cols())


def _mended(spark, sf, cells: str):
    """The whole feeds with every fifth cell's counter lines broken, then the lines of ``cells`` (a pattern) mended."""
    hourly, daily = _targets(spark)
    backlog, rejects = scratch_path(spark, "mend-backlog"), scratch_path(spark, "mend-rejects")
    counter, qual = (read_lines(spark, fx.export_feed(spark, sf, f)) for f in ("counter", "qual"))
    broken = F.when(F.col("value").rlike(r",CELL\d*[05],"), F.concat(F.lit("x"), "value")).otherwise(F.col("value"))
    kw = dict(counter_spec=fx.COUNTER_SPEC, qual_spec=fx.QUAL_SPEC, hourly_path=hourly, daily_path=daily, backlog=backlog,
              on_error="reject", rejects=rejects)
    load_arrivals(spark, counter.withColumn("value", broken), qual, 0, **kw)
    fixes = open_rejects(spark, rejects).where(F.col("line").rlike(cells)).select("line_id", F.expr("substring(line, 2)").alias("line"))
    nothing = spark.createDataFrame([], "value string, source_file string")
    load_arrivals(spark, nothing, nothing, 1, fixes=fixes, **kw)
    return hourly, rejects


def q_mended_hourly(spark, sf):
    """All broken lines mended: history as if none had been broken."""
    hourly, _ = _mended(spark, sf, ",CELL")
    return spark.read.parquet(hourly).select(*_hourly_cols())


def q_mended_report(spark, sf):
    """Half of the cells mended: what was found, what is mended, what is still open."""
    _, rejects = _mended(spark, sf, r",CELL\d*0,")
    return reject_report(spark, rejects)


def q_load_ledger(spark, sf):
    """Half-day loads, one of them sent twice: each file's lines counted once."""
    hourly, daily = _targets(spark)
    loads = scratch_path(spark, "loads")
    for part in (0, 1, 0):
        c, q = fx.export_feed(spark, sf, "counter", part), fx.export_feed(spark, sf, "qual", part)
        run_once(spark, c, q, loads=loads, counter_spec=fx.COUNTER_SPEC, qual_spec=fx.QUAL_SPEC, hourly_path=hourly, daily_path=daily)
    return loaded_files(spark, loads).groupBy("feed").agg(F.count_distinct("load").alias("loads"), F.sum("lines").alias("lines"), F.sum("rejects").alias("rejects"))


QUERIES = {
    "load_lines_comma": q_load_lines_comma,
    "load_lines_tab": q_load_lines_tab,
    "load_skip_header": q_load_skip_header,
    "load_column_list": q_load_column_list,
    "load_null_marker": q_load_null_marker,
    "load_replace": q_load_replace,
    "split_fields": q_split_fields,
    "lines_roundtrip": q_lines_roundtrip,
    "cell_key": q_cell_key,
    "cell_key_overflow": q_cell_key_overflow,
    "cell_key_collisions": q_cell_key_collisions,
    "typed_cast": q_typed_cast,
    "cast_reject": q_cast_reject,
    "quality_report": q_quality_report,
    "duplicate_keys": q_duplicate_keys,
    "feed_join": q_feed_join,
    "feed_join_audit": q_feed_join_audit,
    "feed_unmatched": q_feed_unmatched,
    "time_bucket_day": q_time_bucket_day,
    "time_bucket_hour": q_time_bucket_hour,
    "time_bucket_week": q_time_bucket_week,
    "daily_rollup": q_daily_rollup,
    "daily_conflict": q_daily_conflict,
    "first_wins": q_first_wins,
    "insert_ignore": q_insert_ignore,
    "hourly_latest": q_hourly_latest,
    "load_totals": q_load_totals,
    "wide_rollup": q_wide_rollup,
    "full_load_hourly": q_full_load_hourly,
    "full_load_daily": q_full_load_daily,
    "replay_idempotent": q_replay_idempotent,
    "replay_daily": q_replay_daily,
    "recompute_keeps_other_days": q_recompute_keeps_other_days,
    "full_load_empty_qual": q_full_load_empty_qual,
    "time_bucket_odd_widths": q_time_bucket_odd_widths,
    "time_bucket_nulls": q_time_bucket_nulls,
    "cast_strict_forms": q_cast_strict_forms,
    "load_skip_header_blank": q_load_skip_header_blank,
    "daily_late_ignore": q_daily_late_ignore,
    "daily_late_recompute": q_daily_late_recompute,
    "daily_late_delta": q_daily_late_delta,
    "incremental_daily": q_incremental_daily,
    "cell_intervals": q_cell_intervals,
    "daily_conflict_names": q_daily_conflict_names,
    "cells_as_of": q_cells_as_of,
    "newest_rows": q_newest_rows,
    "exact_sums": q_exact_sums,
    "daily_rollup_exact": q_daily_rollup_exact,
    "backlog_hourly": q_backlog_hourly,
    "backlog_daily": q_backlog_daily,
    "backlog_waiting": q_backlog_waiting,
    "sketched_hourly": q_sketched_hourly,
    "mended_hourly": q_mended_hourly,
    "mended_report": q_mended_report,
    "load_ledger": q_load_ledger,
}


# ------------------------------------------------------------------ oracles

_LI_ORDER_SQL = ", ".join(f"{c} ASC NULLS LAST" for c in LINEITEM_ORDER)
_NULLS = {"l_partkey": "BIGINT", "l_suppkey": "BIGINT", "l_extendedprice": "DOUBLE", "l_discount": "DOUBLE",
          "l_tax": "DOUBLE", "l_linestatus": "VARCHAR"}
_LI_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
_BAD_TAX_SQL = "(l_returnflag = 'R' AND l_linestatus = 'F')"
_SHORT_SQL = "(l_returnflag = 'A' AND l_linestatus = 'F' AND l_linenumber = 7)"
_HOURLY_SQL = ", ".join([*HOURLY_KEYS, *fx.ALL_METRICS])


def _key_parts_sql(overflow=False):
    if overflow:
        lac = ("CAST(CASE WHEN event_type = 'error' THEN 60000 + user_id % 7 ELSE 100 + user_id % 7 END "
               "AS VARCHAR)")
        ci = "CAST(10000 + event_id % 113 AS VARCHAR)"
    else:
        lac = "CAST(user_id % 7 AS VARCHAR)"
        ci = ("CASE WHEN event_type = 'view' THEN lpad(CAST(event_id % 113 AS VARCHAR), 3, '0') "
              "ELSE CAST(event_id % 113 AS VARCHAR) END")
    return f"(SELECT event_id, {lac} AS lac_raw, {ci} AS ci_raw FROM events)"


def _quality_sql():
    reason = ("CASE WHEN event_type = 'purchase' AND value >= 400 THEN 'arity' "
              "WHEN event_type = 'error' THEN 'null:mbsc' "
              "WHEN event_type = 'signup' THEN 'width:cellname' "
              "WHEN event_type = 'click' AND value < 1 THEN 'cast:value' END")
    e = (f"(SELECT time_bucket(INTERVAL '1 hour', ts) AS resulttime, "
         f"CAST(CAST(100 + user_id % 10 AS VARCHAR) || CAST(user_id AS VARCHAR) AS INTEGER) AS unique_id, "
         f"{reason} AS reason FROM events)")
    return (f"WITH e AS {e} "
            "SELECT 'rows' AS check_name, count(*) AS n_rows FROM e "
            "UNION ALL SELECT 'good', count(*) FROM e WHERE reason IS NULL "
            "UNION ALL SELECT reason, count(*) FROM e WHERE reason IS NOT NULL GROUP BY reason "
            "UNION ALL SELECT 'duplicate_key', CAST(COALESCE(sum(n), 0) AS BIGINT) FROM "
            "(SELECT count(*) AS n FROM e WHERE reason IS NULL GROUP BY resulttime, unique_id HAVING count(*) > 1)")


def _wide_sql():
    items = [f"sum({_wide_sql_expr(j)}) AS {m}" for j, m in enumerate(WIDE_METRICS)]
    return ("SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS year_start, l_suppkey, l_returnflag, l_linestatus, "
            + ", ".join(items) + " FROM lineitem GROUP BY ALL")


def _late_ignore_sql():
    d1 = fx.sql_daily(fx.sql_lastday(fx.sql_half(0)))
    d2 = fx.sql_daily(fx.sql_lastday(fx.sql_half(1)))
    return (f"WITH d1 AS {d1}, d2 AS {d2} SELECT * FROM d1 UNION ALL SELECT * FROM d2 "
            "WHERE NOT EXISTS (SELECT 1 FROM d1 WHERE d1.date = d2.date AND d1.unique_id = d2.unique_id)")


def _keeps_sql():
    """First three dates: part 0 and what part 1 adds of keys that part 0 lacks; later dates: both parts."""
    first = "(SELECT min(CAST(ts AS DATE)) FROM events WHERE hour(ts) >= 12) + 2"
    early = f"(SELECT * FROM {fx.sql_daily(fx.sql_lastday(fx.sql_half(0)))})"
    late = f"(SELECT * FROM {fx.sql_daily(fx.sql_lastday(fx.sql_half(1)))} WHERE date <= {first})"
    both = (f"(SELECT * FROM {fx.sql_lastday(fx.sql_half(0))} UNION ALL "
            f"SELECT * FROM {fx.sql_lastday(fx.sql_half(1))})")
    touched = f"(SELECT DISTINCT CAST(resulttime AS DATE) FROM {fx.sql_lastday(fx.sql_half(1))} WHERE CAST(resulttime AS DATE) > {first})"
    return (f"WITH d1 AS {early}, d2 AS {late}, b AS {fx.sql_daily(both)} "
            f"SELECT * FROM b WHERE date IN {touched} "
            f"UNION ALL SELECT * FROM d1 WHERE date NOT IN {touched} "
            "UNION ALL SELECT * FROM d2 WHERE NOT EXISTS (SELECT 1 FROM d1 WHERE d1.date = d2.date AND d1.unique_id = d2.unique_id)")


def _late_recompute_sql():
    both = (f"(SELECT * FROM {fx.sql_lastday(fx.sql_half(0))} UNION ALL "
            f"SELECT * FROM {fx.sql_lastday(fx.sql_half(1))})")
    return f"SELECT * FROM {fx.sql_daily(both)}"


def _intervals_sql():
    return (f"(SELECT *, lead(valid_from) OVER (PARTITION BY unique_id ORDER BY valid_from) AS valid_to FROM ("
            f"SELECT unique_id, {fx.DIMS_SQL}, min(resulttime) AS valid_from, max(resulttime) AS last_seen, count(*) AS hours FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY resulttime) - row_number() OVER (PARTITION BY unique_id, {fx.DIMS_SQL} ORDER BY resulttime) AS run "
            f"FROM {fx.sql_counter(renamed=True)}) GROUP BY unique_id, {fx.DIMS_SQL}, run))")


def _exact(x: str) -> str:
    """The double nearest to a sum of doubles: summed as whole numbers of 2**-70, put back through decimal text."""
    return f"CAST(CAST(sum(CAST({x} * pow(2, 70) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / pow(2, 70)"


def _waiting_sql():
    sides = {"counter": (fx.sql_counter(), fx.sql_qual()), "qual": (fx.sql_qual(), fx.sql_counter())}
    parts = [f"SELECT '{feed}' AS feed, resulttime FROM {own} a WHERE NOT EXISTS (SELECT 1 FROM {other} b "
             "WHERE b.unique_id = a.unique_id AND b.resulttime = a.resulttime)" for feed, (own, other) in sides.items()]
    return f"SELECT feed, CAST(resulttime AS DATE) AS date, count(*) AS rows FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL"


ORACLES = {
    "load_lines_comma": "SELECT * FROM lineitem",
    "load_lines_tab": "SELECT * FROM lineitem",
    "load_skip_header": "SELECT * FROM lineitem",
    "load_column_list": "SELECT " + ", ".join(
        c if c in COLUMN_LIST else f"CAST(NULL AS {_NULLS[c]}) AS {c}" for c in _LI_COLS) + " FROM lineitem",
    "load_null_marker": ("SELECT event_id, ts, user_id, event_type, "
                         "CASE WHEN event_type <> 'error' THEN value END AS value, props FROM events"),
    "load_replace": f"SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SPLIT_DATE}'",
    "split_fields": ("SELECT CAST(len(s) AS INTEGER) AS n_fields, s[1] AS f0, s[2] AS f1, s[3] AS f2, "
                     "s[5] AS f4, s[8] AS f7 FROM (SELECT string_split(CAST(l_orderkey AS VARCHAR) || ',' || "
                     "l_returnflag || ',,' || l_linestatus || ',', ',') AS s FROM lineitem)"),
    "lines_roundtrip": ("SELECT CAST(resulttime AS VARCHAR) || ',' || CAST(unique_id AS VARCHAR) || ',' || mbsc "
                        "|| ',' || cellname || ',' || CAST(cellindex AS VARCHAR) || ',' || CAST(lac AS VARCHAR) "
                        "|| ',' || CAST(ci AS VARCHAR) || ',' || "
                        + " || ',' || ".join(f"COALESCE(CAST({m} AS VARCHAR), 'NULL')" for m in fx.COUNTER_METRICS)
                        + f" AS value FROM {fx.sql_counter()}"),
    "cell_key": (f"SELECT event_id, lac_raw, ci_raw, TRY_CAST(lac_raw || ci_raw AS INTEGER) AS unique_id "
                 f"FROM {_key_parts_sql()}"),
    "cell_key_overflow": (f"SELECT event_id, lac_raw || ci_raw AS key_text, "
                          f"TRY_CAST(lac_raw || ci_raw AS INTEGER) AS unique_id, "
                          f"TRY_CAST(lac_raw || ci_raw AS BIGINT) AS unique_id_wide, "
                          f"TRY_CAST(lac_raw || ci_raw AS INTEGER) IS NOT NULL AS key_ok "
                          f"FROM {_key_parts_sql(True)}"),
    "cell_key_collisions": (f"SELECT unique_id, count(*) AS n_pairs, CAST(sum(n) AS BIGINT) AS n_rows FROM "
                            f"(SELECT TRY_CAST(lac_raw || ci_raw AS INTEGER) AS unique_id, "
                            f"CAST(lac_raw AS INTEGER) AS lac, CAST(ci_raw AS INTEGER) AS ci, count(*) AS n "
                            f"FROM {_key_parts_sql()} GROUP BY ALL) GROUP BY unique_id HAVING count(*) > 1"),
    "typed_cast": f"SELECT * FROM lineitem WHERE NOT {_BAD_TAX_SQL} AND NOT {_SHORT_SQL}",
    "cast_reject": (f"SELECT l_orderkey, l_linenumber, CASE WHEN {_SHORT_SQL} THEN 'arity' ELSE 'cast:l_tax' END "
                    f"AS reason FROM lineitem WHERE {_BAD_TAX_SQL} OR {_SHORT_SQL}"),
    "quality_report": _quality_sql(),
    "duplicate_keys": ("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
                       "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
    "feed_join": f"SELECT * FROM {fx.sql_lastday()}",
    "feed_join_audit": (f"SELECT CAST(count(*) FILTER (WHERE c.unique_id IS NOT NULL AND q.unique_id IS NOT NULL) "
                        f"AS BIGINT) AS matched, "
                        f"CAST(count(*) FILTER (WHERE q.unique_id IS NULL) AS BIGINT) AS counter_only, "
                        f"CAST(count(*) FILTER (WHERE c.unique_id IS NULL) AS BIGINT) AS qual_only "
                        f"FROM {fx.sql_counter()} c FULL OUTER JOIN {fx.sql_qual()} q "
                        f"ON c.unique_id = q.unique_id AND c.resulttime = q.resulttime"),
    "feed_unmatched": (f"WITH c AS {fx.sql_counter()}, q AS {fx.sql_qual()} "
                       "SELECT resulttime, unique_id, 'counter' AS feed FROM c WHERE NOT EXISTS "
                       "(SELECT 1 FROM q WHERE q.unique_id = c.unique_id AND q.resulttime = c.resulttime) "
                       "UNION ALL SELECT resulttime, unique_id, 'qual' AS feed FROM q WHERE NOT EXISTS "
                       "(SELECT 1 FROM c WHERE q.unique_id = c.unique_id AND q.resulttime = c.resulttime)"),
    "time_bucket_day": "SELECT event_id, ts, CAST(time_bucket(INTERVAL '1 day', ts) AS DATE) AS date FROM events",
    "time_bucket_hour": ("SELECT time_bucket(INTERVAL '1 hour', ts) AS bucket, event_type, count(*) AS n_events, "
                         "round(sum(value), 2) AS total FROM events GROUP BY ALL"),
    "time_bucket_week": ("SELECT time_bucket(INTERVAL '7 days', ts) AS bucket, count(*) AS n_events "
                         "FROM events GROUP BY ALL"),
    "daily_rollup": f"SELECT * FROM {fx.sql_daily(fx.sql_lastday())}",
    "daily_conflict": f"SELECT * FROM {fx.sql_daily(fx.sql_lastday(renamed=True))}",
    "first_wins": f"SELECT * FROM {fx.sql_first('lineitem', 'l_orderkey, l_linenumber', _LI_ORDER_SQL)}",
    "insert_ignore": (
        f"WITH t AS {fx.sql_first(f'(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP {SPLIT_DATE!r})', 'l_orderkey, l_linenumber', _LI_ORDER_SQL)}, "
        f"n AS {fx.sql_first(f'(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP {SPLIT_DATE!r})', 'l_orderkey, l_linenumber', _LI_ORDER_SQL)} "
        "SELECT * FROM t UNION ALL SELECT * FROM n WHERE NOT EXISTS "
        "(SELECT 1 FROM t WHERE t.l_orderkey = n.l_orderkey AND t.l_linenumber = n.l_linenumber)"),
    "hourly_latest": f"SELECT * FROM {fx.sql_first(fx.sql_lastday(), 'unique_id', 'resulttime DESC')}",
    "load_totals": "SELECT count(*) AS n_lines, count(*) * 11 AS n_fields FROM lineitem",
    "wide_rollup": _wide_sql(),
    "full_load_hourly": f"SELECT {_HOURLY_SQL} FROM {fx.sql_lastday()}",
    "full_load_daily": f"SELECT * FROM {fx.sql_daily(fx.sql_lastday())}",
    "replay_daily": f"SELECT * FROM {fx.sql_daily(fx.sql_lastday())}",
    "recompute_keeps_other_days": _keeps_sql(),
    "full_load_empty_qual": f"SELECT {_HOURLY_SQL} FROM {fx.sql_lastday()}",
    "time_bucket_odd_widths": "SELECT event_id, " + ", ".join(
        f"time_bucket(INTERVAL '{w}', ts) AS {n}" for n, w in ODD_WIDTHS.items()) + " FROM events",
    "time_bucket_nulls": ("SELECT time_bucket(INTERVAL '6 hours', CASE WHEN event_type <> 'error' THEN ts END) AS bucket, "
                          "count(*) AS n_events FROM events GROUP BY 1"),
    "cast_strict_forms": (
        "SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('month', ts) END AS ts, "
        "CASE event_type WHEN 'click' THEN NULL WHEN 'view' THEN event_id + 0.5::DOUBLE ELSE event_id::DOUBLE END AS value, "
        "CASE event_type WHEN 'error' THEN 'cast:ts' WHEN 'click' THEN 'cast:value' ELSE '' END AS reason FROM events"),
    "load_skip_header_blank": (
        "SELECT l_orderkey || ',' || l_linenumber AS value, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL "
        "SELECT '', count(*) FROM lineitem WHERE l_orderkey % 7 = 0 AND l_linenumber = 1 HAVING count(*) > 0"),
    "replay_idempotent": f"SELECT {_HOURLY_SQL} FROM {fx.sql_lastday()}",
    "daily_late_ignore": _late_ignore_sql(),
    "daily_late_recompute": _late_recompute_sql(),
    "daily_late_delta": _late_recompute_sql(),
    "incremental_daily": _late_ignore_sql(),
    "cell_intervals": f"SELECT unique_id, {fx.DIMS_SQL}, valid_from, valid_to, last_seen, hours FROM {_intervals_sql()}",
    "daily_conflict_names": (f"WITH one AS (SELECT CAST(resulttime AS DATE) AS date, unique_id, {fx.DIMS_SQL}, min(resulttime) AS first_hour, max(resulttime) AS last_hour, count(*) AS hours "
                             f"FROM {fx.sql_counter(renamed=True)} GROUP BY ALL) SELECT * FROM one QUALIFY count(*) OVER (PARTITION BY date, unique_id) > 1"),
    "cells_as_of": (f"SELECT q.resulttime, q.unique_id, q.q_n, i.cellname FROM {fx.sql_qual()} q LEFT JOIN {_intervals_sql()} i "
                    "ON i.unique_id = q.unique_id AND q.resulttime >= i.valid_from AND (i.valid_to IS NULL OR q.resulttime < i.valid_to)"),
    "newest_rows": f"SELECT {_HOURLY_SQL} FROM {fx.sql_lastday()} QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY resulttime DESC) <= 3",
    "exact_sums": "SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year, " + ", ".join(f"{_exact(f'({x})')} AS {m}" for m, x in EXACT.items()) + " FROM lineitem GROUP BY ALL",
    "daily_rollup_exact": (f"SELECT CAST(resulttime AS DATE) AS date, {KEY_COL}, {fx.DIMS_SQL}, "
                           + ", ".join(f"{_exact(m)} AS {m}" for m in fx.ALL_METRICS) + f" FROM {fx.sql_lastday()} GROUP BY ALL"),
    "backlog_hourly": f"SELECT {_HOURLY_SQL} FROM {fx.sql_lastday()}",
    "backlog_daily": _late_recompute_sql(),
    "backlog_waiting": _waiting_sql(),
    "mended_hourly": f"SELECT {_HOURLY_SQL} FROM {fx.sql_lastday()}",
    "mended_report": (f"SELECT 'counter' AS feed, 'cast:resulttime,null:resulttime' AS reasons, count(*) AS found, count(*) FILTER (cellindex % 10 = 0) AS mended, "
                      f"count(*) FILTER (cellindex % 10 <> 0) AS open FROM {fx.sql_counter()} WHERE cellindex % 5 = 0"),
    "load_ledger": " UNION ALL ".join(f"SELECT '{feed}' AS feed, 2 AS loads, CAST((SELECT count(*) FROM {rows(fx.sql_half(0))}) + (SELECT count(*) FROM {rows(fx.sql_half(1))}) AS BIGINT) AS lines, "
                                      "CAST(0 AS BIGINT) AS rejects" for feed, rows in (("counter", fx.sql_counter), ("qual", fx.sql_qual))),
    "sketched_hourly": f"SELECT {_HOURLY_SQL} FROM {fx.sql_lastday()}",
}
