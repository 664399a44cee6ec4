"""Spark session helpers.

The library never creates cluster-specific state on its own: it reads the
session it is handed.  ``local_session`` is only for tests, the bench and the
driver's smoke run; on a cluster the caller builds the session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session used with the library should carry.  UTC pins the
# meaning of the naive timestamps in the test tables; AQE re-plans joins and
# coalesces shuffle partitions at runtime and splits skewed join partitions.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "featurewright",
    driver_memory: str = "8g",
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="fw-wh-"))
    )
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings the operators rely on."""
    for k, v in CORE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged table writes.

    Reads ``spark.checkpoint.dir`` from the session (on a cluster this is a
    shared file system path).  Only when nothing is configured - local tests -
    a fresh folder under the system temp dir is created and registered.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - conf absent
            configured = None
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="fw-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "tables", f"{name}-{os.getpid()}-{_counter()}")


_COUNT = [0]


def _counter() -> int:
    _COUNT[0] += 1
    return _COUNT[0]


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete staged data that no plan reads any longer."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df):
    """Cut lineage: compute ``df`` once into the shared checkpoint folder and read it back.

    Used before steps that read a costly plan several times (statistics, then
    projection; two branches of one plan).  Always a reliable checkpoint, never a
    local one: executors can be lost, and it survives that.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Spill-aware settings for a cluster run, derived from the input size.

    Shuffle partitions start at ~``input / 128 MB`` (at least 2 waves of all
    cores) and AQE coalesces them at runtime to the advisory size; scan splits
    are 256 MB; a partition more than 5x the median and above 512 MB counts as
    skewed and is split by AQE's skew-join handling.  At 100 TB on 1000 x 8
    cores this gives ~800k initial shuffle partitions, coalesced by AQE.
    """
    cores = max(1, executors * cores_per_executor)
    partitions = max(2 * cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
    }
