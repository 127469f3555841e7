"""Session defaults and the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DIRS: dict[str, str] = {}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites in error messages cost several round trips per column object.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


MIB = 1 << 20


def size_settings(input_bytes: int) -> dict[str, str]:
    """Split and shuffle sizes for an input of this many bytes.

    A shuffle of M map and R reduce tasks has M x R blocks, so at 100 TB neither
    may grow with the data alone: splits go up to 1 GiB and the initial number
    of shuffle partitions stops at 40,000. Adaptive execution merges partitions
    that turn out small and splits skewed ones.
    """
    split = min(max(input_bytes // 100_000, 128 * MIB), 1024 * MIB)
    partitions = min(max(input_bytes // (256 * MIB), 200), 40_000)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MIB if partitions > 200 else 64 * MIB),
    }


def build_session(
    app: str = "meterlake", master: str | None = None, input_bytes: int | None = None, **settings
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = size_settings(input_bytes) if input_bytes else {}
    for key, value in {**SETTINGS, **sized, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediates: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a folder on this machine; on a cluster
    that folder would not be visible to the executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="meterlake-")
    return _LOCAL_DIRS[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
