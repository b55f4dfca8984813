"""Session and shared-folder helpers.

Everything that must outlive a task (landed files, written tables, stream
checkpoints) goes under the shared folder named by ``spark.checkpoint.dir``.
Only when the session has none (local tests) do we set one ourselves.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}


def build_session(master: str | None = None, app: str = "blockledger",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings this library expects (AQE on, UTC, no UI)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one only when unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FALLBACK:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        # Unset in a one-process session, as in tests: its temporary folder is shared by all its tasks.
        local = tempfile.mkdtemp(prefix="blockledger-ckpt-")
        spark.sparkContext.setCheckpointDir(local)
        _LOCAL_FALLBACK[app] = spark.sparkContext.getCheckpointDir() or local
    return _LOCAL_FALLBACK[app].rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder under the shared folder."""
    return f"{shared_dir(spark)}/blockledger/{name}-{uuid.uuid4().hex[:12]}"


def fresh_namespace(spark: SparkSession, prefix: str = "ledger") -> str:
    """Create a new namespace whose files live under the shared folder."""
    ns = f"{prefix}_{uuid.uuid4().hex[:10]}"
    loc = fresh_path(spark, ns)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {ns} LOCATION '{loc}'")
    return ns


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote under the shared folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_CONF_LOCK = threading.Lock()
_CONF_USERS: dict[str, list] = {}     # setting -> [callers inside, value before]


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Session settings for the time of a write; concurrent callers share them,
    and the last one out restores what was there before the first."""
    with _CONF_LOCK:
        for k, v in settings.items():
            users = _CONF_USERS.setdefault(k, [0, None])
            if not users[0]:
                users[1] = spark.conf.get(k, None)
                spark.conf.set(k, v)
            users[0] += 1
    try:
        yield
    finally:
        with _CONF_LOCK:
            for k in settings:
                users = _CONF_USERS[k]
                users[0] -= 1
                if not users[0]:
                    spark.conf.unset(k) if users[1] is None else spark.conf.set(k, users[1])


def shuffles_removed(spark: SparkSession):
    """Inside it, a write's shuffle files go when the write has ended, not when the driver's memory is next cleaned."""
    return session_settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})
