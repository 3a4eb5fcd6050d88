"""Spark session settings for the log-ingest and reconciliation jobs.

The settings mirror the intent of the original job header (combine small
inputs, merge small outputs, compress with snappy) using Spark's own knobs,
and pin the behaviour the operators rely on (UTC, AQE, ANSI left on).
"""

from __future__ import annotations

import os
import tempfile
import threading

from pyspark.sql import SparkSession

# Defaults that hold for a large cluster. Tests and the bench override the
# shuffle partition count for local[N]; AQE coalesces small partitions anyway.
CLUSTER_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Start wide so no shuffle partition outgrows executor memory at 100 TB;
    # AQE then merges partitions toward the advisory size.
    "spark.sql.shuffle.partitions": "4000",
    # Bin-pack many small (gzip) inputs into splits of about this size.
    "spark.sql.files.maxPartitionBytes": str(200 * 1024 * 1024),
    # Target size for rebalanced outputs (the old merge target was ~1 GB;
    # 256 MB keeps write tasks short and still avoids small files).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.io.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app_name: str = "logtally",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session with the library defaults applied, or reuse the
    active one untouched.

    ``getOrCreate`` would copy the builder's settings onto a running session,
    overriding whatever its owner chose (shuffle partitions, time zone...),
    so the defaults are applied only to a session created here.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CLUSTER_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    sc = spark.sparkContext
    return sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set one only where it is unset.

    On a cluster the setting names a shared folder (HDFS / object store). Only
    a local session (tests, bench) falls back to a fresh scratch folder.
    """
    current = checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for this cluster"
        )
    path = fallback or tempfile.mkdtemp(prefix="logtally-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return path


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``logtally`` importable in executor Python workers of a local session.

    Python UDFs are pickled by reference to this package, so workers must be
    able to import it. On a cluster, ship it the standard way (install it on
    the executors or pass ``--py-files``); for a local session whose workers
    do not see the package (another working directory), a zip of the package
    sources is added with ``addPyFile``, once per application.
    """
    import zipfile

    sc = spark.sparkContext
    if sc.master != "local" and not sc.master.startswith("local["):
        return
    with _SHIP_LOCK:                      # the setup DAG calls this from two threads
        if sc.applicationId in _SHIPPED:
            return
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        out_dir = tempfile.mkdtemp(prefix="logtally-py-")
        archive = os.path.join(out_dir, "logtally.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
            for folder, _dirs, files in os.walk(pkg_dir):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
        sc.addPyFile(archive)
        _SHIPPED.add(sc.applicationId)
