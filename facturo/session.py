"""Session construction and shared scratch locations.

Scratch data (materialised stages, file round trips) always goes under the
folder the cluster names in ``spark.checkpoint.dir``. A private folder is set
only when that setting is absent in local mode (tests); elsewhere it is an
error, since a machine-local folder cannot be shared by executors.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings every session of ours wants; the cluster may override any of them.
#
# Broadcast policy: the static threshold judges a side by its compressed file
# size, an estimate that can be far below the real in-memory size, so it is
# off. AQE still turns a join into a broadcast join when the *measured*
# shuffle output of one side is under the adaptive threshold. Explicit
# ``broadcast()`` hints are kept for inputs whose size is bounded by
# construction (one row per range partition or per profiled column, a fixed
# 25-row dimension).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.ui.enabled": "false",
}


MB = 1 << 20


def sizing_conf(input_bytes: int, partition_bytes: int = 256 * MB, min_partitions: int = 8) -> dict[str, str]:
    """Scan split and shuffle partition counts for an input of ``input_bytes``.

    Scans cut files into ``partition_bytes`` splits; the initial shuffle
    partition count gives about ``partition_bytes`` of (compressed) input per
    reducer, and AQE coalesces small ones afterwards and splits skewed ones.
    At 100 TB and 256 MB this is ~400,000 partitions before coalescing.
    """
    shuffle = max(min_partitions, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
    }


def build_session(
    master: str | None = None,
    app_name: str = "facturo",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # AQE's local shuffle reader saves network fetches after a join turns
        # into a broadcast join, at the price of keeping the map side's task
        # count. In local mode every fetch is local anyway, so only the price
        # is left (it matters when inputs are few large row groups). On a
        # cluster it stays on.
        conf["spark.sql.adaptive.localShuffleReader.enabled"] = "false"
    if input_bytes:
        conf.update(sizing_conf(input_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "") or ""
    return master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Only a local-mode session (tests, a laptop) without the setting gets a
    private temporary folder; on a cluster a machine-local folder would
    scatter the data over executor disks, so the setting is required there.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        if not _is_local(spark):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        current = tempfile.mkdtemp(prefix="facturo-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    try:  # classic sessions: also the folder of DataFrame.checkpoint()
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        pass
    return current


# Where each written table that is still referenced lies, and the open scopes, innermost last.
_TABLES: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_SCOPES: list[ScratchScope] = []


class ScratchScope:
    """The scratch paths made since it was opened, unless an inner scope owns them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, df: DataFrame) -> DataFrame:
        """Hand a written table to the scope around this one, or, without one, to the session."""
        path = _TABLES.get(df)
        if path in self.paths:
            self.paths.remove(path)
            outer = _SCOPES[: _SCOPES.index(self)] if self in _SCOPES else []
            if outer:
                outer[-1].paths.append(path)
        return df

    def clear(self, unless_read_by: DataFrame | None = None) -> None:
        """Delete the paths, but for those that a plan still reads."""
        read = unless_read_by.inputFiles() if unless_read_by is not None and self.paths else []
        held = [p for p in self.paths if any(f"{p}/" in f for f in read)]
        _delete(self.spark, [p for p in self.paths if p not in held])
        self.paths[:] = held


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[ScratchScope]:
    """Tables written inside are deleted at the end, but for those given to ``keep``; what reads them must be written by then."""
    scope = ScratchScope(spark)
    try:
        with collected_scratch(scope):
            yield scope
    finally:
        scope.clear()


@contextmanager
def collected_scratch(scope: ScratchScope) -> Iterator[ScratchScope]:
    """While open, scratch paths are noted in ``scope``, which is cleared by the caller."""
    _SCOPES.append(scope)
    try:
        yield scope
    finally:
        _SCOPES.remove(scope)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete paths on whatever store they are; remote sessions, which have no JVM here, leave them to the cluster."""
    for path in paths:
        try:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001 - scratch that can't be deleted is no reason to fail
            return


def discard(*frames: DataFrame) -> None:
    """Delete tables that materialize() wrote and that nothing reads any more."""
    for df in frames:
        path = _TABLES.pop(df, None)
        if path:
            _delete(df.sparkSession, [path])
            for scope in _SCOPES:
                if path in scope.paths:
                    scope.paths.remove(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder; it is deleted with its scope, or when the session's process ends."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "facturo", f"{name}-{uuid.uuid4().hex}")
    if _SCOPES:
        _SCOPES[-1].paths.append(path)
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no JVM here
        pass
    return path


def materialize(df, spark: SparkSession, name: str):
    """Write ``df`` as parquet under the shared folder and read it back.

    This cuts lineage the way a cluster job should: the written table survives
    executor loss, unlike a cache, and later scans get column pruning and
    filter pushdown again.
    """
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    # Read with the written schema: no inference job, and empty input reads back empty.
    out = spark.read.schema(df.schema).parquet(path)
    _TABLES[out] = path
    return out
