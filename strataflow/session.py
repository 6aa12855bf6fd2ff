"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SCRATCH_SETTING = "spark.checkpoint.dir"

# Settings this library is tuned for. A cluster's own values win: they are only
# applied by ``build_session``, never from inside an operator.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Where the join key is a group too, the aggregate reuses the join's partitioning:
    # splitting a hot key then costs one more shuffle and is worth it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Running averages keep one state row per group; RocksDB holds them off-heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_scratch: dict[str, str] = {}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with the recommended settings; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in RECOMMENDED.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged data and streaming checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is used
    only for a local master, where driver and executors are one process; ``local-cluster``
    starts others. On a cluster a folder directly in the machine's /tmp is refused.
    """
    configured = spark.conf.get(SCRATCH_SETTING, None)
    one_process = re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", ""))
    if configured:
        if not one_process and re.match(r"(file:/*)?/(tmp|var/tmp)(/[^/]*)?/?$", configured):
            raise RuntimeError(f"{SCRATCH_SETTING} is a machine's own folder: {configured}")
        return configured.rstrip("/")
    if not one_process:
        raise RuntimeError(f"set {SCRATCH_SETTING} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        folder = tempfile.mkdtemp(prefix="strataflow-")
        _local_scratch[app] = folder
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path of its own under the shared folder."""
    return f"{scratch_root(spark)}/strataflow/{label}-{uuid.uuid4().hex}"
