"""Session helpers.

Library code never configures the cluster: it takes the caller's session.
`local_session` exists for tests and the benchmark only.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "zonecast",
                  event_log_dir: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on).
    `event_log_dir` turns on Spark's event log (stage and task times) in a
    scratch folder, in place of the UI."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OWN_DIRS: dict[int, str] = {}


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and round-trip writes.

    Reads `spark.checkpoint.dir` (or the context's checkpoint dir) from the
    session. Only when neither is set and the master is local -- tests -- a
    folder of our own is created once per session and registered as the
    context's checkpoint dir, so later calls agree on it. On a cluster an
    unset folder raises: a machine-local one would not be shared.
    (`spark.checkpoint.dir` itself is a core setting and cannot be changed on
    a running session.)
    """
    sc = _context(spark)
    path = spark.conf.get("spark.checkpoint.dir", None) or _OWN_DIRS.get(id(spark))
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = _OWN_DIRS.setdefault(id(spark), tempfile.mkdtemp(prefix="zonecast-ckpt-"))
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


_SCOPES: dict[int, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one write; inside a
    `scratch_scope` one that ends with it."""
    base = os.path.join(shared_dir(spark), "zonecast")
    scopes = _SCOPES.get(id(spark))
    if scopes:
        base = scopes[-1]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """All that is staged inside the scope is deleted at its end, so results
    must be written elsewhere, or collected, before. Yields the scope's
    folder."""
    path = scratch_path(spark, "scope")
    _SCOPES.setdefault(id(spark), []).append(path)
    try:
        yield path
    finally:
        _SCOPES[id(spark)].remove(path)
        sc = spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)
