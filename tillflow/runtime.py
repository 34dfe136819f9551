"""Session construction and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, partitions: int | None = None, app: str = "tillflow") -> SparkSession:
    """Session for tests, the bench and local runs, or a cluster (no master).

    ``partitions`` sets ``spark.sql.shuffle.partitions`` (tests: the core count).
    On a cluster leave it to the cluster's settings; size
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` for the data
    (about input bytes / 128 MB) and let AQE merge small partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    elif master and master.startswith("local"):
        builder = builder.config("spark.sql.shuffle.partitions", "8")
    spark = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_OWN_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or given to ``setCheckpointDir``.

    On a cluster it names storage every executor can reach, and it is only read
    here; without one this raises. Only with a ``local`` master (tests) a fresh
    folder is made, once per application, and given to ``SparkContext.setCheckpointDir``
    (the setting itself cannot be changed at run time).
    """
    sc = spark.sparkContext
    root = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if not root and sc.applicationId not in _OWN_ROOTS:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        root = _OWN_ROOTS.get(sc.applicationId)
        if root is None:
            root = tempfile.mkdtemp(prefix="tillflow-ckpt-")
            _OWN_ROOTS[sc.applicationId] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), "tillflow", *parts, uuid.uuid4().hex)


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``tillflow`` importable on the executors (Python workers), once per context.

    The package is zipped and added with ``addPyFile``, the same as
    ``spark-submit --py-files``: Spark uploads the archive from the driver to
    every executor. Only the driver reads the archive, so it is written under the
    checkpoint folder when that is a local path, else in a driver-side folder
    (an ``hdfs://`` or ``s3a://`` root cannot be written with local file calls).
    """
    sc = spark.sparkContext
    app = sc.applicationId
    with _SHIP_LOCK:
        if app in _SHIPPED:
            return
        _ship(spark, sc)
        _SHIPPED.add(app)


def _ship(spark: SparkSession, sc) -> None:
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = checkpoint_root(spark)
    if "://" in root and not root.startswith("file:"):
        target = tempfile.mkdtemp(prefix="tillflow-pyfiles-")
    else:
        target = scratch_path(spark, "pyfiles").removeprefix("file:")
        os.makedirs(target, exist_ok=True)
    archive = os.path.join(target, "tillflow.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in base:
                continue
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(archive)


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def require_rocksdb_state(spark: SparkSession) -> None:
    """Use the RocksDB state store for the stateful session operators started from
    now on: state lives off-heap and on local disk with incremental checkpoints,
    and ``transformWithStateInPandas`` (several state variables per key) needs it."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)
