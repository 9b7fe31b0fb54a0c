"""Session construction and the shared folders jobs may write to."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes
# (broadcast only when the materialised side is measured small), splits
# skewed join partitions and coalesces tiny shuffle partitions.
_SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # checkpoints of tables that nothing refers to any more are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_MB = 1 << 20


def recommended_conf(input_bytes: int, cores: int) -> dict:
    """Partition sizing from the input size and the cluster's task slots.

    * shuffle partitions: one per 256 MB of input, at least two waves of tasks
      (AQE coalesces small ones);
    * file splits: 128 MB, 256 MB above 1 TB of input (fewer, longer scan tasks);
    * AQE target partition size 256 MB, skew threshold 512 MB.
    """
    parts = max(2 * cores, input_bytes // (256 * _MB))
    split = 256 * _MB if input_bytes > (1 << 40) else 128 * _MB
    return {
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * _MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * _MB),
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Read from the running context or from ``spark.checkpoint.dir``; only a
    local-mode session with neither gets a folder of its own (tests).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder shared by "
                "all executors (e.g. on HDFS or an object store)")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set")
    return f"{base}/quarry-tables/{name}-{uuid.uuid4().hex}"


def materialize(df):
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage.

    For derived inputs that feed several branches of a plan (Spark would
    otherwise recompute them per branch) and for the state of iterative
    algorithms. Reliable checkpoint: survives the loss of any executor.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def saved(df, name: str):
    """``df`` computed once, written as Parquet under the shared folder and read back.

    Unlike a checkpoint it is columnar (later reads prune columns) and can be
    dropped with :func:`forget` as soon as nothing reads it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables) -> None:
    """Delete the files behind tables made by :func:`saved` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def short_shuffles(spark: SparkSession):
    """What is computed inside leaves no shuffle files behind; else they stay until the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
