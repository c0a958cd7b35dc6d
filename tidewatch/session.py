"""SparkSession factory (T16, T18) and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tidewatch.config import DEFAULTS, Params

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app_name: str = "tidewatch",
    master: str | None = None,
    params: Params = DEFAULTS,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Session with the settings every job relies on.

    * session time zone UTC: windows and epoch conversions are defined in UTC;
    * RocksDB state store with changelog checkpointing: required by
      ``transformWithState``, keeps keyed state off the heap, and each batch
      uploads only the changed keys;
    * AQE on: coalesces the small shuffle outputs of the window aggregates and
      splits skewed partitions at run time;
    * UI off: nothing here needs a web server.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        # commit state as a changelog per batch instead of a full snapshot
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.python.unix.domain.socket.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    width = shuffle_partitions or params.shuffle_partitions
    if width:
        conf["spark.sql.shuffle.partitions"] = str(width)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Windows and epoch casts are defined in UTC; pin it on a caller's session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, written tables and stream state.

    Uses ``spark.checkpoint.dir`` when the cluster names one.  Where it is unset a
    private folder is created for a local master; any other master is an error,
    because its executors would not see a folder of the driver's machine.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        return conf_dir.rstrip("/")
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    return jdir.get().rstrip("/") if jdir.isDefined() else local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared root for one run of ``name``."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(p: str) -> str:
    """Strip a file: scheme for the few helpers that touch the local disk in tests."""
    return p[len("file:"):] if p.startswith("file:") else p


__all__ = ["build_session", "ensure_utc", "shared_root", "scratch_path", "local_path", "require_rocksdb",
           "drained_stream_settings"]


def require_rocksdb(spark: SparkSession) -> None:
    """``transformWithState`` runs only on the RocksDB state store; set it on a
    caller's session when it names another provider.  A restarted query keeps the
    provider recorded in its checkpoint."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


@contextmanager
def drained_stream_settings(spark: SparkSession, state_partitions: int | None = None):
    """Settings for a finite, drained replay on a caller's session, restored after.

    ``state_partitions`` is the shuffle width of the stateful query, fixed at its
    first batch; None keeps the session's.
    """
    keys = ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass",
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        require_rocksdb(spark)
        if state_partitions:
            spark.conf.set(keys[0], str(state_partitions))
        yield
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
