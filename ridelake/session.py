"""Session construction and the shared scratch area.

All intermediate tables that a job writes (staged loads, landing files
built from the input tables, stream checkpoints) go below the folder the
cluster names in ``spark.checkpoint.dir``.  A machine-local temporary
folder is used only in local mode when none is named (unit tests); on a
cluster its absence is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans shuffles at runtime, merges
# small shuffle partitions, splits skewed join partitions, and all time
# arithmetic is pinned to UTC so results do not depend on the host zone.
# Shuffled rows take about ten times their compressed size when a task sorts
# them, and a join and a window sort in one task: 32 MB a task keeps that low.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# A shuffle starts with this many partitions (or the session's number, if
# larger), so that large inputs are dealt finely; AQE merges small ones up to
# the advisory size.  Up to 200, map tasks write without sorting.
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
LEAST_FIRST_PARTITIONS = 200


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "ridelake",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session and make the
    package importable by its Python workers."""
    for key, value in DEFAULT_CONF.items():
        if key.startswith("spark.ui."):
            continue
        try:
            spark.conf.set(key, value)
        except Exception:  # static conf of a session we did not build
            pass
    if spark.conf.get(FIRST_PARTITIONS, None) is None:
        spark.conf.set(FIRST_PARTITIONS, str(max(
            LEAST_FIRST_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    scratch_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add this package to the executors' Python path, as ``--py-files``
    would: the paged data source and the footer readers run in Python
    workers, which must import their module.  Done once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import os
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix="ridelake-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for base, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)  # Spark copies it to every executor
    _SHIPPED.add(sc.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="ridelake-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the scratch root."""
    return f"{scratch_root(spark)}/ridelake/{name}-{uuid.uuid4().hex[:12]}"
