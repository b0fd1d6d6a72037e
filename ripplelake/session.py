"""Session helpers: a tuned local session for tests/bench, UTC pinning and
shared scratch locations.

Scratch data (stream checkpoints, landed files, lineage cuts) always lives
under the folder the cluster names in ``spark.checkpoint.dir``.  Only when that
setting is absent and the master is ``local[...]`` (unit tests, a laptop) do we
pick a temporary folder and register it; on a cluster its absence is an error,
so executors never write to machine-local disk.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def build_session(master: str | None = None, app: str = "ripplelake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local session tuned like the production one (AQE on, UTC, no UI)."""
    master = master or os.environ.get("RIPPLE_MASTER", "local[*]")
    cores = os.cpu_count() or 8
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RIPPLE_DRIVER_MEM", "8g"))
        .config("spark.sql.streaming.schemaInference", "false")
        # Whole-stage codegen of the wide Silver projection yields methods
        # above the JVM's 8 KB JIT limit; let the JIT compile them.
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session clock to UTC: event hours/days are UTC by contract."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def shared_dir(spark: SparkSession) -> str:
    """Base folder for scratch data shared by all executors.

    Read from ``spark.checkpoint.dir`` (the cluster's shared folder).  If it is
    unset, as in tests, create a temporary one and register it as the
    checkpoint dir so ``DataFrame.checkpoint()`` uses the same place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    try:  # classic sessions may have the dir set on the context only
        ctx = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect: no SparkContext
        ctx = None
    if not base and ctx is not None:
        found = ctx._jsc.sc().getCheckpointDir()
        base = found.get() if found.isDefined() else None
    if not base:
        master = (ctx.master if ctx is not None else spark.conf.get("spark.master", "")) or ""
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ripplelake-")
        if ctx is not None:
            ctx.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle/scan settings for a cluster run, sized from the input.

    Shuffle partitions start at ~input / 256 MB (at least 2x the cores) and
    AQE coalesces them down to ``advisoryPartitionSizeInBytes`` at run time
    and splits skewed ones, so one setting serves small and huge days.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": UTC,
        # Streaming state (per user x hour windows) off the JVM heap, with
        # changelog checkpoints so a lost executor restores state quickly.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # JIT-compile the large generated methods of the fused Silver stage.
        "spark.executor.extraJavaOptions": JIT_OPTIONS,
    }
