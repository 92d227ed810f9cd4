"""A ledger of loads: which files, which totals, and whether the load was published to its end.

    begun/load=<id>   written before anything is read: the paths and the mode
    done/load=<id>    written after the last table: one row for each file with
                      its lines and rejects, and the load's totals on each

A load whose id is done is skipped: none of its files is parsed.  A load that
was begun and not finished is run again with the same files; publication
leaves out what is there, so it is made whole and nothing is doubled.  While
one is unfinished no other load begins: with mode='ignore' the first load of
a day decides its daily rows, so the order must hold (``finish_loads`` runs
them in their order).

The id is the fingerprint of the files (path, length, time of change), so a
file with new content is another load.  A load is skipped as a whole only: a
new counter file may hold partners for rows of an old quality file, so
single files of a load are not left out.  One writer at a time.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FeedSpec
from ..session import delete_path, path_exists, scratch_path
from ..sinks.tables import table_exists
from .delta import load_fingerprint
from .full_load import LoadReport, run_load, staged_rows

_BEGUN = "began timestamp, counter_paths string, qual_paths string, mode string, load string"
_DONE = "feed string, file string, lines bigint, rejects bigint, report string, finished timestamp, load string"


class UnfinishedLoad(RuntimeError):
    """Another load was begun and not finished."""


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(folder) if table_exists(spark, folder) else spark.createDataFrame([], schema)


def loaded_files(spark: SparkSession, loads: str) -> DataFrame:
    """load, feed, file, lines, rejects, finished: every file of every finished load that held a line."""
    return _read(spark, f"{loads}/done", _DONE).where(F.col("file").isNotNull()).select("load", "feed", "file", "lines", "rejects", "finished")


def finished_loads(spark: SparkSession, loads: str) -> DataFrame:
    """load, finished, report (JSON of the totals)."""
    return _read(spark, f"{loads}/done", _DONE).where(F.col("file").isNull()).select("load", "finished", "report")


def unfinished_loads(spark: SparkSession, loads: str) -> DataFrame:
    """load, began, counter_paths, qual_paths (JSON), mode of the loads that were begun and not finished."""
    return _read(spark, f"{loads}/begun", _BEGUN).join(finished_loads(spark, loads), "load", "left_anti").select("load", "began", "counter_paths", "qual_paths", "mode")


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _totals_of_files(spark: SparkSession, work: str, specs: dict[str, FeedSpec]) -> DataFrame:
    """feed, file, lines, rejects of the staged feeds."""
    parts = [staged_rows(spark, f"{work}/{feed}", spec).groupBy("source_file").agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("status") == "reject").alias("rejects"))
             .select(F.lit(feed).alias("feed"), F.col("source_file").alias("file"), "lines", "rejects") for feed, spec in specs.items()]
    return parts[0].unionByName(parts[1])


def run_once(spark: SparkSession, counter_paths, qual_paths, *, loads: str, counter_spec: FeedSpec, qual_spec: FeedSpec,
             mode: str = "ignore", load_id: str | None = None, **kw) -> tuple[LoadReport, bool]:
    """``run_load`` unless it is done already; its report, and whether it was skipped.

    ``loads``: the ledger's folder.  Other arguments as for ``run_load``.  A
    load that failed for its lines (on_error='raise') stays unfinished: mend
    the files, which makes it another load, and ``forget_load`` this one.
    """
    loads = loads.rstrip("/")
    load_id = load_id or load_fingerprint(spark, counter_paths, qual_paths)
    if path_exists(spark, f"{loads}/done/load={load_id}/_SUCCESS"):
        said = json.loads(finished_loads(spark, loads).where(F.col("load") == load_id).first()["report"])
        return LoadReport(**said), True
    others = [r["load"] for r in unfinished_loads(spark, loads).where(F.col("load") != load_id).orderBy("began").limit(10).collect()]
    if others:
        raise UnfinishedLoad(f"loads {others} were begun and not finished: finish or forget them first")
    row = (dt.datetime.now(), json.dumps(_paths(counter_paths)), json.dumps(_paths(qual_paths)), mode)
    begun = spark.createDataFrame([row], "began timestamp, counter_paths string, qual_paths string, mode string")
    begun.coalesce(1).write.mode("overwrite").parquet(f"{loads}/begun/load={load_id}")
    work = scratch_path(spark, "load")
    try:
        delta = {"load_id": load_id} if mode == "delta" else {}
        rep = run_load(spark, counter_paths, qual_paths, counter_spec=counter_spec, qual_spec=qual_spec, mode=mode, work=work, cleanup=False, **delta, **kw)
        now = F.lit(dt.datetime.now())
        files = _totals_of_files(spark, work, {"counter": counter_spec, "qual": qual_spec})
        said = {f.name: getattr(rep, f.name) for f in fields(rep) if f.name not in ("work", "recomputed_dates")} | {"work": work}
        # one row with the totals, beside the files
        whole = spark.range(1).select(*[F.lit(None).cast(t).alias(n) for n, t in (("feed", "string"), ("file", "string"), ("lines", "bigint"), ("rejects", "bigint"))],
                                      F.lit(json.dumps(said)).alias("report"), now.alias("finished"))
        done = files.select("*", F.lit(None).cast("string").alias("report"), now.alias("finished")).unionByName(whole)
        done.write.mode("overwrite").parquet(f"{loads}/done/load={load_id}")
        return rep, False
    finally:
        delete_path(spark, work)


def finish_loads(spark: SparkSession, *, loads: str, **kw) -> list[LoadReport]:
    """Run the unfinished loads again, the one begun first before the others, with the paths they were begun with."""
    out = []
    for r in unfinished_loads(spark, loads).orderBy("began").collect():
        out.append(run_once(spark, json.loads(r["counter_paths"]), json.loads(r["qual_paths"]), loads=loads, load_id=r["load"], **kw | {"mode": r["mode"]})[0])
    return out


def forget_load(spark: SparkSession, loads: str, load_id: str) -> None:
    """Take an unfinished load off the ledger; what it published stays."""
    delete_path(spark, f"{loads.rstrip('/')}/begun/load={load_id}")
