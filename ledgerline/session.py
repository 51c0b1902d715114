"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for every plan built here: AQE re-plans joins and
# coalesces shuffle partitions at run time, the skew-join split handles a key
# that holds a large share of the rows, and UTC keeps timestamp_ntz arithmetic
# identical to the SQL oracle.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def scale_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Sizing for a run over ``input_bytes`` of input on ``total_cores`` executor cores.

    Shuffles start with enough partitions for ~256 MB each (at least two
    waves of the cores) and AQE coalesces the small ones; scans split files
    at 256 MB, so every task's input and shuffle block fits executor memory
    and spills stay rare.
    """
    parts = max(2 * total_cores, -(-input_bytes // TARGET_PARTITION_BYTES))
    size = f"{TARGET_PARTITION_BYTES // (1024 * 1024)}m"
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, total_cores: int) -> None:
    """Set the runtime SQL options of :func:`scale_conf` on an existing session."""
    for key, value in scale_conf(input_bytes, total_cores).items():
        spark.conf.set(key, value)


def _submitted() -> bool:
    """True if a launcher has chosen the master already (spark-submit, or submit arguments in the environment)."""
    return ("PYSPARK_GATEWAY_PORT" in os.environ or "MASTER" in os.environ
            or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "") or "spark.master" in os.environ.get("PYSPARK_SUBMIT_ARGS", ""))


def get_spark(cores: int | str = "*", shuffle_partitions: int | None = None,
              app: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    """The session of this application.

    Master, memory and partition counts are set only where no launcher has set
    them: under spark-submit the cluster's settings hold.
    """
    builder = SparkSession.builder.appName(app)
    conf = dict(DEFAULT_CONF)
    if not _submitted():
        builder = builder.master(f"local[{cores}]")
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or (8 if cores == "*" else cores))
        conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``; it is read from the
    session.  Only a ``local`` master, whose executors share the driver's disk,
    may do without: a private scratch folder is then created and registered.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root
    current = sc.getCheckpointDir()
    if current:
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def _own_scratch(spark: SparkSession) -> str:
    return os.path.join(checkpoint_root(spark), "ledgerline", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under this application's part of the shared checkpoint folder."""
    return os.path.join(_own_scratch(spark), f"{name}-{uuid.uuid4().hex}")


def release_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application; frames that read them can no longer be used."""
    from pyarrow import fs
    root = _own_scratch(spark)
    store, path = fs.FileSystem.from_uri(root)
    if store.get_file_info(path).type == fs.FileType.Directory:
        store.delete_dir(path)
