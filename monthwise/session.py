"""Session helpers: a local session for tests / bench, and the shared scratch
folder every write-type step uses.

Scratch space comes from ``spark.checkpoint.dir`` (the cluster's shared
folder).  Only when it is unset -- a local test run -- do we create one.
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # local mode only: listing many month folders as a distributed job buys
    # nothing when every task runs in this one JVM (a cluster session keeps
    # Spark's default and lists in parallel)
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "4096",
    # remove checkpoint files once their frame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "monthwise", **conf) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    merged = dict(DEFAULT_CONF)
    merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update({k: str(v) for k, v in conf.items()})
    for k, v in merged.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    try:
        return spark.conf.get("spark.checkpoint.dir")
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared scratch root: the session's ``spark.checkpoint.dir``.  A session
    without one that runs in this one JVM (local tests) gets a fresh folder.
    On a cluster a folder of the driver's machine would be no use to
    executors, so there the setting is required."""
    d = checkpoint_dir(spark)
    if not d:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master is {master})")
        d = tempfile.mkdtemp(prefix="monthwise-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir() or d
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


_held_lock = threading.Lock()
_held: dict[tuple[str, str], list] = {}  # session and setting -> [its users, the value before them]


@contextmanager
def held_setting(spark: SparkSession, name: str, value: str):
    """A setting of the session for the time of a block: of several blocks at
    once the first sets it and the last puts it back."""
    key = (spark.conf.get("spark.app.id", "") + str(id(spark)), name)
    with _held_lock:
        state = _held.setdefault(key, [0, None])
        if not state[0]:
            state[1] = spark.conf.get(name)
            spark.conf.set(name, value)
        state[0] += 1
    try:
        yield
    finally:
        with _held_lock:
            state[0] -= 1
            if not state[0]:
                spark.conf.set(name, state[1])
                del _held[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared scratch root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/monthwise/{name}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme (for local-only helpers in tests)."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
