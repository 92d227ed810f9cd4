"""Cell feeds derived from the driver tables, in Spark and as SQL.

The driver tables hold no counter exports, so feeds of the same shape are
derived from ``events``: one row per (hour, user), user as the cell.

    counter feed: click, view and purchase events; metrics m_click, m_view,
                  m_purchase = sum of value of that type (NULL when none)
    qual feed:    error, signup and view events; metrics q_error, q_signup
                  (same rule) and q_n = number of events
    cell:         lac = 100 + user_id % 10, ci = user_id, so unique_id is the
                  text lac || ci; mbsc = 'MBSC' || user_id % 3,
                  cellname = 'CELL' || user_id, cellindex = user_id

Metric sums are rounded to 2 places (the event values have 2), which makes
them equal in both engines whatever the summation order.  Every SQL string
here is DuckDB SQL over the registered views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import join_fields
from ..functions.time import time_bucket
from ..schema import HOURLY_KEYS, cell_feed_spec
from ..session import path_exists, scratch_path
from ..sinks.lines import write_lines

COUNTER_TYPES = ("click", "view", "purchase")
QUAL_TYPES = ("error", "signup", "view")
COUNTER_METRICS = ("m_click", "m_view", "m_purchase")
QUAL_METRICS = ("q_error", "q_signup", "q_n")
ALL_METRICS = COUNTER_METRICS + QUAL_METRICS
# hour of day from which a cell carries its second name (renamed-cell case)
RENAME_HOUR = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _typed_sum(t: str):
    return F.round(F.sum(F.when(F.col("event_type") == t, F.col("value"))), 2)


def _cell_cols(renamed: bool = False):
    u = F.col("user_id")
    lac = (F.lit(100) + u % 10).cast("int")
    cellname = F.concat(F.lit("CELL"), u.cast("string"))
    if renamed:
        cellname = F.when(F.hour("resulttime") >= RENAME_HOUR, F.concat(cellname, F.lit("B"))).otherwise(cellname)
    return [
        F.col("resulttime"),
        F.concat(lac.cast("string"), u.cast("string")).cast("int").alias("unique_id"),
        F.concat(F.lit("MBSC"), (u % 3).cast("string")).alias("mbsc"),
        cellname.alias("cellname"),
        u.cast("int").alias("cellindex"),
        lac.alias("lac"),
        u.cast("int").alias("ci"),
    ]


def counter_rows(events: DataFrame, renamed: bool = False) -> DataFrame:
    g = (events.filter(F.col("event_type").isin(*COUNTER_TYPES))
         .groupBy(time_bucket("ts", "1 hour").alias("resulttime"), "user_id")
         .agg(*[_typed_sum(t).alias(m) for t, m in zip(COUNTER_TYPES, COUNTER_METRICS)]))
    return g.select(*_cell_cols(renamed), *COUNTER_METRICS)


def qual_rows(events: DataFrame) -> DataFrame:
    g = (events.filter(F.col("event_type").isin(*QUAL_TYPES))
         .groupBy(time_bucket("ts", "1 hour").alias("resulttime"), "user_id")
         .agg(_typed_sum("error").alias("q_error"), _typed_sum("signup").alias("q_signup"),
              F.count(F.lit(1)).cast("double").alias("q_n")))
    return g.select(*_cell_cols(), *QUAL_METRICS)


def half(events: DataFrame, which: int) -> DataFrame:
    """Events of the first (0) or second (1) half of each day."""
    h = F.hour("ts")
    return events.filter(h < RENAME_HOUR if which == 0 else h >= RENAME_HOUR)


COUNTER_SPEC = cell_feed_spec(COUNTER_METRICS, null_marker="NULL")
QUAL_SPEC = cell_feed_spec(QUAL_METRICS, null_marker="NULL")
FILE_ORDER = ("resulttime", "mbsc", "cellname", "cellindex", "lac", "ci")


def export_path(spark: SparkSession, name: str, sf_dir: str) -> str:
    tag = sf_dir.rstrip("/").replace("/", "_").replace(".", "_").strip("_")
    return scratch_path(spark, "exports", f"{name}-{tag}", unique=False)


def cached_export(spark: SparkSession, name: str, sf_dir: str, build, **write_kw) -> str:
    """Write ``build()`` once as delimited text under the scratch folder.

    The export is a fixture derived by Spark from the driver tables; it is
    reused by later calls in the same session.
    """
    path = export_path(spark, name, sf_dir)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        write_lines(build(), path, mode="overwrite", **write_kw)
    return path


def export_feed(spark: SparkSession, sf_dir: str, kind: str, part: int | None = None, sep: str = ",") -> str:
    """Text export of the counter or qual feed (whole, or one half-day part)."""
    def build():
        ev = table(spark, sf_dir, "events")
        if part is not None:
            ev = half(ev, part)
        rows = counter_rows(ev) if kind == "counter" else qual_rows(ev)
        metrics = COUNTER_METRICS if kind == "counter" else QUAL_METRICS
        return rows.select(*FILE_ORDER, *metrics)
    name = f"{kind}{'' if part is None else '-part' + str(part)}{'' if sep == ',' else '-tab'}"
    return cached_export(spark, name, sf_dir, build, sep=sep, null_text="NULL")


def feed_lines(rows: DataFrame, metrics, sep: str = ",") -> DataFrame:
    return rows.select(join_fields([*FILE_ORDER, *metrics], sep, "NULL").alias("value"))


# ---------------------------------------------------------------- SQL twins

def _sql_sum(t: str) -> str:
    return f"round(sum(CASE WHEN event_type = '{t}' THEN value END), 2)"


def _sql_cell(renamed: bool = False) -> str:
    cellname = "'CELL' || CAST(user_id AS VARCHAR)"
    if renamed:
        cellname = (f"CASE WHEN hour(resulttime) >= {RENAME_HOUR} THEN {cellname} || 'B' "
                    f"ELSE {cellname} END")
    return (
        "resulttime, "
        "CAST(CAST(100 + user_id % 10 AS VARCHAR) || CAST(user_id AS VARCHAR) AS INTEGER) AS unique_id, "
        "'MBSC' || CAST(user_id % 3 AS VARCHAR) AS mbsc, "
        f"{cellname} AS cellname, "
        "CAST(user_id AS INTEGER) AS cellindex, "
        "CAST(100 + user_id % 10 AS INTEGER) AS lac, "
        "CAST(user_id AS INTEGER) AS ci"
    )


def sql_events(where: str | None = None) -> str:
    return f"(SELECT * FROM events WHERE {where})" if where else "events"


def sql_half(which: int) -> str:
    return sql_events(f"hour(ts) {'<' if which == 0 else '>='} {RENAME_HOUR}")


def sql_counter(src: str = "events", renamed: bool = False) -> str:
    types = ", ".join(f"'{t}'" for t in COUNTER_TYPES)
    sums = ", ".join(f"{_sql_sum(t)} AS {m}" for t, m in zip(COUNTER_TYPES, COUNTER_METRICS))
    return (f"(SELECT {_sql_cell(renamed)}, {', '.join(COUNTER_METRICS)} FROM ("
            f"SELECT time_bucket(INTERVAL '1 hour', ts) AS resulttime, user_id, {sums} "
            f"FROM {src} WHERE event_type IN ({types}) GROUP BY ALL))")


def sql_qual(src: str = "events") -> str:
    types = ", ".join(f"'{t}'" for t in QUAL_TYPES)
    return (f"(SELECT {_sql_cell()}, {', '.join(QUAL_METRICS)} FROM ("
            f"SELECT time_bucket(INTERVAL '1 hour', ts) AS resulttime, user_id, "
            f"{_sql_sum('error')} AS q_error, {_sql_sum('signup')} AS q_signup, "
            f"CAST(count(*) AS DOUBLE) AS q_n "
            f"FROM {src} WHERE event_type IN ({types}) GROUP BY ALL))")


def sql_lastday(src: str = "events", renamed: bool = False) -> str:
    cols = ", ".join(f"c.{k}" for k in HOURLY_KEYS)
    cm = ", ".join(f"c.{m}" for m in COUNTER_METRICS)
    qm = ", ".join(f"q.{m}" for m in QUAL_METRICS)
    return (f"(SELECT {cols}, {cm}, {qm} FROM {sql_counter(src, renamed)} c "
            f"JOIN {sql_qual(src)} q ON c.unique_id = q.unique_id AND c.resulttime = q.resulttime)")


DIMS_SQL = "mbsc, cellname, cellindex, lac, ci"


def sql_rollup(lastday: str, places: int | None = 2) -> str:
    """Daily groups of a lastday relation (all 7 keys; may repeat (date, unique_id))."""
    def agg(m):
        return f"round(sum({m}), {places}) AS {m}" if places is not None else f"sum({m}) AS {m}"
    sums = ", ".join(agg(m) for m in ALL_METRICS)
    return (f"(SELECT CAST(resulttime AS DATE) AS date, unique_id, {DIMS_SQL}, {sums} "
            f"FROM {lastday} GROUP BY ALL)")


def sql_first(rel: str, keys: str, order: str) -> str:
    return (f"(SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {keys} ORDER BY {order}) AS _rn FROM {rel}) WHERE _rn = 1)")


def sql_daily(lastday: str) -> str:
    order = ", ".join(f"{c} ASC NULLS LAST" for c in DIMS_SQL.split(", "))
    return sql_first(sql_rollup(lastday), "date, unique_id", order)
