"""Stream sources and sinks on files. Every job drains what is available and then stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.session import work_path

# State goes to RocksDB on the executors and is checkpointed to the shared folder, so its size is
# not bounded by the heap and it outlives an executor.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Without a limit, draining a backlog would be one batch of everything.
FILES_PER_TRIGGER = 1000


def stream_table(spark: SparkSession, folder: str, name: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """One table of a folder as a stream, be it one file or a directory of files.

    ``files_per_trigger`` bounds a micro-batch, and with it the most rows that one key can bring into
    one task. Files are taken in the order of their times; between batches the watermark moves, so
    the delay given to ``event_time`` must cover the disorder between files.
    """
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def event_time(df: DataFrame, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Event time with a watermark; a timestamp without zone is read in the session zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def _drain(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def run_append(df: DataFrame, label: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Drain a stream into Parquet files (exactly once per checkpoint) and read them back."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    path = path or work_path(spark, label)
    checkpoint = checkpoint or work_path(spark, f"{label}-checkpoint")
    _drain(df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).option("path", path).format("parquet"))
    return spark.read.schema(df.schema).parquet(path)


def run_batches(df: DataFrame, label: str, handle: Callable[[DataFrame, int], None], checkpoint: str | None = None) -> None:
    """Drain a stream through a function per micro-batch. A batch may be repeated after a failure,
    so the function must give the same table when it sees a batch twice. A run with the checkpoint of an earlier one
    goes on with the next batch."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    _drain(df.writeStream.option("checkpointLocation", checkpoint or work_path(spark, f"{label}-checkpoint")).foreachBatch(handle))
