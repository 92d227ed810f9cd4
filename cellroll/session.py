"""Session settings and the shared scratch folder.

Intermediate tables (staged feeds, the joined load) are written under the
folder the cluster names in ``spark.checkpoint.dir``, which must be shared
storage on a cluster.  Only when the session has none (local tests) is a
folder created and set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the wide plans want: a 386-column row must stay inside the
# vectorised Parquet reader (switched off above spark.sql.codegen.maxFields,
# default 100), and no generated method may exceed what the JIT compiles
# (8000 bytes of bytecode): above hugeMethodLimit Spark falls back to
# per-operator code instead of running one huge interpreted method, which
# made a 379-sum roll-up 3-4x slower.
WIDE_CONF = {
    "spark.sql.codegen.maxFields": "1000",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app: str = "cellroll", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(WIDE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, total_cores: int, *, partition_bytes: int = 256 << 20) -> dict:
    """Sizing settings for a load of ``input_bytes`` on ``total_cores`` task slots.

    Scan splits of ``partition_bytes``; enough shuffle partitions that none
    holds more than about ``partition_bytes`` (AQE coalesces small ones and
    splits skewed ones of more than 4x the median).  A 386-column row is about
    3 KB, so a 256 MB partition holds under 100,000 rows and its aggregation
    buffers fit in executor memory.
    """
    parts = max(total_cores * 3, -(-input_bytes // partition_bytes))
    return {
        **WIDE_CONF,
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }


def tune_wide(spark: SparkSession, n_columns: int) -> None:
    """Session settings for a plan that carries ``n_columns`` columns."""
    cur = int(spark.conf.get("spark.sql.codegen.maxFields", "100"))
    need = max(1000, n_columns + 50)
    if cur < need:
        spark.conf.set("spark.sql.codegen.maxFields", str(need))
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535")) > 8000:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def scratch_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder (set here only when unset)."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
    elif not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all machines share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cellroll-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder under the shared scratch root; a fresh one unless unique=False."""
    base = scratch_root(spark).rstrip("/")
    tail = "/".join(parts)
    if unique:
        tail = f"{tail}/{uuid.uuid4().hex}" if tail else uuid.uuid4().hex
    return f"{base}/cellroll/{tail}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a per-run work folder (recursive)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
