"""Spark session and shared-folder helpers.

Jobs never use a machine-local folder on a cluster: every intermediate table
or checkpoint goes under the shared folder named by ``spark.checkpoint.dir``.
Only when that setting is missing (local tests) is a scratch folder chosen.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings for a cluster run; tests override master and partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Static broadcast only below this estimated size (file statistics);
    # explicit broadcasts are count checked; AQE converts at runtime on
    # measured shuffle sizes.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
}


def get_spark(master: str | None = None, app: str = "quire", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Target bytes per shuffle partition when sizing a job for its input.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def size_shuffle_for_input(spark: SparkSession, input_bytes: int, min_partitions: int = 200,
                           max_partitions: int = 200_000) -> int:
    """Size the initial shuffle partition count so each partition holds about
    128 MB of the input (AQE then coalesces small ones and splits skewed
    ones). Returns the number set."""
    n = max(min_partitions, min(max_partitions, -(-int(input_bytes) // TARGET_PARTITION_BYTES)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TARGET_PARTITION_BYTES))
    return n


def ship_package(spark: SparkSession) -> None:
    """Make ``quire`` importable in Python workers (as ``--py-files`` would):
    zip the package once per SparkContext and ``addPyFile`` it. Operators
    that run Python (mapInPandas, pandas UDFs) call this when they build
    their plan."""
    sc = spark.sparkContext
    if getattr(sc, "_quire_shipped", False):
        return
    import zipfile

    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="quire-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._quire_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, choosing a scratch one only if unset."""
    ship_package(spark)
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if base:
        return base
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # Only reached in local mode, where the driver is the executor.
        base = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def path_of(spark: SparkSession, path: str):
    """(file system, path object) of a path in any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
