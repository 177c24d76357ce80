"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench. A cluster brings its own session and settings."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("daymark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and written tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall
    back to a temporary folder, since there the driver is the only machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder all executors can reach.")
    fallback = os.path.join(tempfile.gettempdir(), f"daymark-{os.getpid()}")
    os.makedirs(fallback, exist_ok=True)
    return fallback


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialize(df, purpose: str):
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs reuse an expensive input: the written table survives lost
    executors and cuts the lineage, which a cache does not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
