"""Spark session helpers.

Library code never creates its own session; callers pass one in. These helpers
are for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC dates, ANSI arithmetic, AQE with skew-join
# splitting, and a broadcast threshold that is a real size check (Spark compares
# the plan's size estimate with it before it broadcasts anything on its own).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # CPU-heavy aggregations (decimal sums, max_by structs) over small shuffles
    # should not be squeezed into one task; irrelevant once partitions are large
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "cloudcost", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's base settings."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("CLOUDCOST_DRIVER_MEM", "8g"))
    conf["spark.ui.enabled"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is used as is. Only a
    local-mode session (tests, bench), whose one machine shares its own folders, may
    leave it unset and then gets a private folder; elsewhere that is an error.
    """
    cdir = spark.conf.get("spark.checkpoint.dir", None)
    if not cdir:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name storage that all executors share")
        cdir = tempfile.mkdtemp(prefix="cloudcost-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cdir)
    try:
        spark.sparkContext.setCheckpointDir(cdir)
    except Exception:  # noqa: BLE001 - no SparkContext on a remote (Connect) session
        pass
    return cdir


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (for per-session memos)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def parallelism(spark: SparkSession) -> int:
    """Default parallelism of the session (cores of the cluster)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.default.parallelism", None) or 8)


COMPRESSION = "zstd"  # of tables that a job writes: less disk than Spark's default
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITING: dict[int, list] = {}  # by session: how many writers are inside, and the setting before them
_WRITING_LOCK = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """A table written inside leaves no shuffle files behind: nothing reads the shuffles of a
    write again, and else they stay on disk until the driver collects its garbage. Writers
    of several threads may be inside at once."""
    key = id(spark)
    with _WRITING_LOCK:
        if key not in _WRITING:
            _WRITING[key] = [0, spark.conf.get(_CLEANUP, None)]
            spark.conf.set(_CLEANUP, "true")
        _WRITING[key][0] += 1
    try:
        yield
    finally:
        with _WRITING_LOCK:
            _WRITING[key][0] -= 1
            if not _WRITING[key][0]:
                before = _WRITING.pop(key)[1]
                if before is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
