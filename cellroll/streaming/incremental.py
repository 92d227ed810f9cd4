"""Incremental loads driven by a stream of manifests.

Exports arrive as pairs of files (counter feed, quality feed) for the same
hours; the two must be loaded together, or the join would drop every row.
So the stream does not watch the feed folders: it watches a folder of
manifest files, one line per pair (``counter_path<TAB>qual_path``), and each
micro-batch runs ``run_load`` on the pairs it brings.

* ``foreachBatch`` is at-least-once; publication is insert-if-absent, so a
  batch replayed after a failure changes nothing.
* ``maxFilesPerTrigger`` bounds how many manifests one load takes; with 1,
  loads happen in the order of file modification times; within one
  micro-batch in the order of file names.  That fixes which load wins a
  daily row in ``mode='ignore'``.
* ``availableNow`` processes what is there and stops (scheduled runs);
  without it the query keeps running and picks up new manifests.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.full_load import run_load
from ..schema import FeedSpec


def write_manifest(spark: SparkSession, folder: str, pairs, seq: int) -> str:
    """Write one manifest file ``<folder>/<seq>.txt`` listing (counter, qual) pairs.

    Written through the Hadoop file system of the folder (any shared store),
    with a modification time that increases with ``seq``.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{seq:010d}.txt")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        for c, q in pairs:
            out.write(bytearray(f"{c}\t{q}\n".encode("utf-8")))
    finally:
        out.close()
    fs.setTimes(path, int(time.time() * 1000) + seq, -1)
    return str(path)


def _pairs(batch: DataFrame):
    """(counter file, qual file) of each line, in the order of the manifests and their lines.

    Lines come to the driver one partition of the sort at a time, however
    many a manifest has.
    """
    parts = F.split(F.col("value"), "\t")
    lines = batch.filter(F.length("value") > 0).select(F.col("file"), F.monotonically_increasing_id().alias("row"), parts[0].alias("c"), parts[1].alias("q"))
    for r in lines.orderBy("file", "row").toLocalIterator():
        yield r.c, r.q


def run_incremental(spark: SparkSession, manifest_dir: str, *, counter_spec: FeedSpec, qual_spec: FeedSpec,
                    hourly_path: str, daily_path: str, mode: str = "ignore", on_error: str = "raise",
                    checkpoint: str, max_files_per_trigger: int = 1,
                    available_now: bool = True, reports: list | None = None, cleanup: bool = True):
    """Start (and with ``available_now``, finish) the incremental load stream.

    ``checkpoint`` is the stream's own folder on shared storage; a restart
    with the same one goes on after the manifests it has loaded.  Each pair
    is a load of its own, in manifest order.
    """

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        for counter_path, qual_path in _pairs(batch):
            rep = run_load(batch.sparkSession, counter_path, qual_path, counter_spec=counter_spec,
                           qual_spec=qual_spec, hourly_path=hourly_path, daily_path=daily_path,
                           mode=mode, on_error=on_error, cleanup=cleanup)
            if reports is not None:
                reports.append((epoch_id, rep))

    stream = (spark.readStream.format("text")
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .load(manifest_dir)
              .select("value", F.col("_metadata.file_path").alias("file")))
    writer = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
