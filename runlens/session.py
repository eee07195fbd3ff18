"""Session defaults and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on: AQE splits skewed join partitions and turns a
# join into a broadcast only after it has measured the side at run time.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", **conf) -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("runlens")
    settings = {**DEFAULTS, "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="runlens-"))
    return spark.sparkContext.getCheckpointDir()


def shared_place(spark: SparkSession, kind: str) -> str:
    """A new folder of its own name in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that a lost executor never replays earlier rounds of a loop."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame) -> DataFrame:
    """Write a result that several branches need to the shared folder and read it from there.

    The expensive part runs once, each branch reads only its columns, and the table
    outlives executors. The folder is the cluster's to clean up, like its checkpoints.
    """
    spark = df.sparkSession
    place = shared_place(spark, "stage")
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)
