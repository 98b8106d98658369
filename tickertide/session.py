"""Session settings and the two places the library writes short-lived data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tickertide.sources.files import drop

# Settings the operators rely on. All of them can be changed at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Cut ranked groups to their first rows before the exchange, for any number of rows.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Half the size of the default for texts.
    "spark.sql.parquet.compression.codec": "zstd",
    # Exchanged rows go when the execution that wrote them ends, not when the driver collects
    # its garbage: whole texts move in some steps, and a run has many.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Texts can be long: what Python is given at once is bounded in bytes, not only in rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

# Bytes a shuffle task should read; well below what an executor core can hold in memory.
TASK_BYTES = 128 * 1024 * 1024


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Start shuffles with enough partitions for an input of this size.

    Adaptive execution joins the small ones again, so too many cost little.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(current, -(-input_bytes // TASK_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return wanted


def local_session(cores: str | int = "*", app: str = "tickertide", **conf: str) -> SparkSession:
    """One-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tickertide-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors and ends the plan."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Ends the plan like ``cut_lineage``, by a table below the shared folder. Tables are
    compressed, checkpoints are not: for rows with texts."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written = path
    return table


def drop_written(df: DataFrame) -> None:
    """Remove a table that ``written`` made, once nobody reads it any more. Other frames stay."""
    path = getattr(df, "_written", None)
    if path is not None:
        drop(df.sparkSession, path)
