"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = 8, memory: str = "12g", app: str = "plexus") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local session may fall back to a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp" if os.path.isdir("/tmp") else None)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: survives executor loss, cuts lineage."""
    path = shared_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Empty materialised tables that nothing reads any more: all that was made of them is written."""
    for df in frames:
        nothing = df.sparkSession.createDataFrame([], df.schema)
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            nothing.write.mode("overwrite").parquet(path)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Spread a small scan over all cores before heavy work per row.

    Only scans with fewer splits than cores are shuffled, so never more than cores x
    ``spark.sql.files.maxPartitionBytes``; a large scan keeps its splits. Call it on a scan or a
    projection of one (a plan without shuffles).
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)
