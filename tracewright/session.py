"""Session settings the operators are written for, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. Every one of them can be set on a running session.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A table made from one column of a file is many times as large as the planner thinks from the file. Only what
    # is tiny by that estimate is broadcast unseen; of anything else the measured size decides.
    "spark.sql.autoBroadcastJoinThreshold": "256KB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # One key may hold a third of all rows: cut its partition in every shuffled join, also
    # where that costs one more shuffle afterwards.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    # Repeated JSON keys are last-wins, as in Python's json module.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session somebody else made."""
    for key, value in SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: str | int = "*", app: str = "tracewright") -> SparkSession:
    """Local session for tests and the benchmark."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    A machine-local folder is used only when the session names none and runs in
    local mode (tests, benchmark).
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{base.rstrip('/')}/tracewright-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write a table used by several later steps once, and read it back.

    Unlike a cache it survives the loss of executors and cuts the lineage.
    """
    path = scratch_dir(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
