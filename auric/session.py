"""Session construction and shared-folder helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. UTC keeps cursor and date logic independent of
# the host clock; AQE coalesces small shuffles, turns joins whose runtime side
# is small into broadcasts, and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}

# Whole-stage code generation emits large methods for wide projections (many
# CASE / cast expressions); HotSpot by default never JIT-compiles a method
# over 8000 bytecodes, so such a stage would run interpreted (~15 % on the
# bench). Applied to local sessions only: on a cluster, add the flag to the
# extraJavaOptions given to spark-submit rather than overwrite them here.
JIT_FLAGS = "-XX:-DontCompileHugeMethods"


# Starting points for a large cluster (hundreds of executors, tens of TB per
# job). Shuffles start with many partitions and AQE coalesces them to about
# the advisory size, so a stage neither spills from oversized partitions nor
# drowns in tiny tasks; a partition several times the median and above the
# byte threshold counts as skewed and is split. Scan splits of 256 MB keep the
# task count of a 100 TB scan near 400k rather than 800k.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # joins with large key sets (live keys): a filter of up to 40 MB under the other scan
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "8g",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "10g",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "40000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "320000000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def get_session(master: str | None = None, app: str = "auric",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None,
                cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    On a cluster ``master`` is left to spark-submit and ``cluster=True`` adds
    ``CLUSTER_CONF``; tests pass ``local[N]``. Settings given to spark-submit
    win over these defaults only if passed through ``extra``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf["spark.driver.extraJavaOptions"] = JIT_FLAGS
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS / object store) folder there. Only a local
    master, whose tasks all run on this machine, gets a folder of its own when it
    is unset; any other master without it is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder for {sc.master}")
        d = tempfile.mkdtemp(prefix="auric-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/auric-scratch/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a query go when it ends, not when the driver next
    collects garbage. For jobs that run each frame once: a second run shuffles anew."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, on whatever file system it is on."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def replace_path(spark: SparkSession, staged: str, path: str) -> None:
    """Put the folder ``staged`` in the place of ``path``, on whatever file system they are
    on (the same for both). The old folder is renamed to a hidden name, the new one takes
    its name, then the old one goes. Where the second rename fails, the first is undone."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, to = jvm_path(staged), jvm_path(path)
    old = jvm_path(to.getParent(), f".old-{to.getName()}-{uuid.uuid4().hex[:12]}")
    fs = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(to.getParent())
    had = fs.exists(to)
    if had and not fs.rename(to, old):
        raise OSError(f"cannot rename {path}")
    if not fs.rename(new, to):
        if had:
            fs.rename(old, to)
        raise OSError(f"cannot rename {staged} to {path}")
    if had:
        fs.delete(old, True)


__all__ = ["get_session", "ensure_checkpoint_dir", "scratch_path", "remove_path", "replace_path",
           "short_lived_shuffles", "DEFAULT_CONF", "CLUSTER_CONF"]
