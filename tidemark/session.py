"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import SparkSession

SETTINGS = {
    # All instants are UTC; dates of instants must not depend on the cluster's zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Payload mappings generate large methods; the JVM never compiles one above 8000 bytes of
    # bytecode, so above that size Spark must split the code instead of fusing it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The default timestamp encoding has no statistics; with this one a scan for rows after a
    # watermark skips every row group that is older.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Splits that a task can sort or aggregate in memory: with larger ones the map side of an
    # aggregation or a window spills as soon as the input is large.
    "spark.sql.files.maxPartitionBytes": "16m",
    # A value that does not fit its column must fail, as a database would.
    "spark.sql.ansi.enabled": "true",
}


def build_session(app_name: str = "tidemark", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the required SQL settings on a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 << 20) -> int:
    """Start shuffles with as many partitions as the input calls for; adaptive execution coalesces small ones.

    Adaptive execution can't split the partitions of an aggregation or a window, so on
    a large input the default number would make each of them too large for a task.
    """
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return wanted


def shared_directory(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder: on a
    cluster a machine-local folder would lose data with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """``DataFrame.checkpoint`` needs a folder; use the shared one where none is set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_directory(spark)}/checkpoints")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_directory(spark)}/tidemark/{label}-{uuid4().hex}"


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder made by :func:`scratch_path`."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ship_package(spark: SparkSession) -> SparkSession:
    """Let Python workers on every machine import this package, once per context."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return spark
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidemark-ship-")) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tidemark_shipped = True
    return spark
