"""Running a stream over the files that are there now, with its progress kept in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.session import scratch_path


def stream_parquet(spark: SparkSession, path: str, schema, files_per_batch: int | None = None,
                   name: str | None = None) -> DataFrame:
    """A stream of the Parquet files in the folder ``path``, in arrival order; ``name`` keeps one file name."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name:
        reader = reader.option("pathGlobFilter", name)
    return reader.parquet(path)


def stream_table(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """The table at ``path`` as a stream: one file, or a folder with all folders below it.

    Folders named ``column=value`` are read as partition columns, as in a batch table.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        folder, name = path.rsplit("/", 1)
        return stream_parquet(spark, folder, schema, files_per_batch, name)
    return stream_parquet(spark, path, schema, files_per_batch)


def _run(writer, base: str) -> None:
    writer.option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start().awaitTermination()


# Each call below keeps progress and results under ``base``. A later call with the same ``base`` reads
# only files that came since and returns old and new results; without ``base`` a call starts anew.


def run_append(stream: DataFrame, purpose: str = "stream", base: str | None = None) -> DataFrame:
    """Append to a Parquet table until the input is used up; the file sink commits each batch once."""
    spark = stream.sparkSession
    base = base or scratch_path(spark, purpose)
    _run(stream.writeStream.format("parquet").outputMode("append").option("path", f"{base}/table"), base)
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


def run_complete(stream: DataFrame, purpose: str = "stream", base: str | None = None) -> DataFrame:
    """Complete mode: each batch writes the whole result anew and drops the one before the last; the last is returned."""
    spark = stream.sparkSession
    base = base or scratch_path(spark, purpose)

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/table/batch={batch_id}")
        # A batch may be repeated, the one before it is whole by now; older results are of no use.
        old = batch.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{base}/table/batch={batch_id - 2}")
        old.getFileSystem(batch.sparkSession._jsc.hadoopConfiguration()).delete(old, True)

    # An empty result stands in until the first batch, so that a run without input has one too.
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{base}/table/batch=-1")
    _run(stream.writeStream.outputMode("complete").foreachBatch(save), base)
    written = spark.read.schema(f"batch long, {_ddl(stream)}").parquet(f"{base}/table")
    latest = written.agg(F.max("batch")).first()[0]
    return written.where(F.col("batch") == F.lit(latest)).drop("batch")


def _ddl(frame: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int, str], None], purpose: str = "stream",
                base: str | None = None) -> str:
    """Call ``handle(batch, batch_id, base)`` per micro-batch. A repeated batch id must overwrite
    what it wrote before. Returns the base path."""
    base = base or scratch_path(stream.sparkSession, purpose)
    _run(stream.writeStream.foreachBatch(lambda batch, batch_id: handle(batch, batch_id, base)), base)
    return base
