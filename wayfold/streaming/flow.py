"""Structured Streaming forms of the engine's operators: dedupe, windows, sessions, upserts, spatial tiers."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.plans.runtime import ensure_checkpoint_dir


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the Parquet files at a path (a folder, or one file named by its folder and name)."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    reader = spark.readStream.schema(schema)
    if path.endswith(".parquet") and "." in name:
        fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(fs_path).isFile():
            return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def deduplicated(stream: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """Rows with a key seen within the watermark are dropped; state older than it is forgotten."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def window_counts(stream: DataFrame, time: str, late: str, size: str, slide: str | None, *keys: str) -> DataFrame:
    """Counts in tumbling or sliding windows; rows later than the watermark are dropped."""
    win = F.window(time, size, slide) if slide else F.window(time, size)
    return stream.withWatermark(time, late).groupBy(win.alias("w"), *keys).agg(F.count("*").alias("n")).select("w.start", "w.end", *keys, "n")


def sessions(stream: DataFrame, time: str, late: str, gap: str, key: str) -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("s"), key).agg(F.count("*").alias("n")).select(key, "s.start", "s.end", "n")


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over what is there and read back what it wrote, from the shared checkpoint folder."""
    spark = stream.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    q = stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def drain_complete(stream: DataFrame) -> DataFrame:
    """Like drain for aggregates whose last state is wanted: every batch replaces the table."""
    spark = stream.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    last: list[str] = []

    def keep(batch: DataFrame, number: int) -> None:
        path = f"{base}/out-{number}"
        batch.write.mode("overwrite").parquet(path)
        last[:] = [path]

    q = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{base}/state").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(last[0]) if last else spark.createDataFrame([], stream.schema)


def fold(stream: DataFrame, into: Callable[[DataFrame, int], None]) -> None:
    """Hand every micro-batch to a function, once a batch number."""
    base = f"{ensure_checkpoint_dir(stream.sparkSession).rstrip('/')}/stream-{uuid.uuid4().hex}"
    stream.writeStream.foreachBatch(into).option("checkpointLocation", base).trigger(availableNow=True).start().awaitTermination()
