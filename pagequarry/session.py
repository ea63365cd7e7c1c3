"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pagequarry")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Only a local master may fall back to a temporary folder of its own: executors on other
    machines could not see it, and would lose its files with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = spark.conf.get("pagequarry.local.work", None) or tempfile.mkdtemp(prefix="pagequarry-")
        spark.conf.set("pagequarry.local.work", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def spread(scan: DataFrame) -> DataFrame:
    """Spread a scan of few splits over all cores before work that is heavy per row.

    Takes a plain scan: counting its partitions runs no job. A large input already has more
    splits than cores and passes through without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that several later steps read, and read it back; it outlives lost executors."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
