"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Adaptive execution sizes the shuffles, turns joins with a side that proves small into broadcast
# joins and splits the hot partitions of the others. Splitting is forced because it is worth an
# extra exchange when one key holds a large part of the rows.
# The JVM does not compile methods above 8000 bytes, so a stage whose generated code is longer would
# run interpreted; below the limit Spark falls back to smaller generated methods instead.
SQL_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# For listings only. The text rules keep a core busy for up to a minute with what a task gets by default (64 MB of
# compressed shuffle), so tasks get a quarter of that and spread evenly over the cores. A join whose smaller
# side stays below the same size in every partition hashes that side instead of sorting both. Tables
# written by a few reasons, sources or periods keep a file open for each instead of sorting all rows.
LISTING_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

_local_scratch: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the operators count on; cluster sizing stays with the cluster."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    # What ``tune_listings`` has set in the same session does not hold for other work.
    for key, value in LISTING_SETTINGS.items():
        if spark.conf.get(key, None) == value:
            spark.conf.unset(key)
    return spark


def tune_listings(spark: SparkSession) -> SparkSession:
    """``tune`` for the listings, whose rows are narrow and take much work each."""
    tune(spark)
    for key, value in LISTING_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", name: str = "loticote", **settings: str) -> SparkSession:
    """A session for tests and measurements on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="loticote-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; their results must be stored by then."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/{context.applicationId}")
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def compiled_apart(df: DataFrame) -> DataFrame:
    """The same rows, with the code for them generated apart from the code for what follows.

    Joins and long text rules in one stage of generated code exceed the size the JVM compiles, and then the
    joins fall back to copying rows as well. Counting the rows in between (``observe``) ends the first stage.
    """
    return df.observe(f"rows-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The result survives the loss of executors, is computed once however often it is used, and
    carries its real size: Spark then broadcasts it in a join only when it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
