"""Structured streams over event files: the evidence fold and windowed counts (the latter an extension)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import evidence


def event_signals(events: DataFrame) -> DataFrame:
    """Events as signals: one key per user, the event type as value, a confidence from the event's number."""
    confidence = F.round(F.pmod(F.abs(F.col("value")), F.lit(1.0)), 6)
    return events.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("key"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("signal_id"), F.col("event_type").alias("value"), confidence.alias("confidence"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared checkpoint folder, deleted with the session."""
    from factloom.session import checkpoint_folder, forget

    folder = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    forget(spark, folder)
    return folder


def run_available(stream: DataFrame, spark: SparkSession, name: str, mode: str = "update") -> DataFrame:
    """Run a stream over all files there are, and return what it wrote with the number of the micro-batch."""
    out, check = shared_folder(spark, f"{name}-out"), shared_folder(spark, f"{name}-check")

    def write(batch: DataFrame, n: int) -> None:
        batch.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{out}/part={n}")

    query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", check).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(out)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Event files as a stream: those of a folder, or a single file of its folder."""
    schema = spark.read.parquet(path).schema
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
    if found.isDirectory():
        return spark.readStream.schema(schema).parquet(path)
    return spark.readStream.schema(schema).option("pathGlobFilter", place.getName()).parquet(place.getParent().toString())


def folded_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The last state per key after streaming all event files of a folder."""
    rows = run_available(evidence.fold_stream(event_signals(read_events(spark, folder))), spark, "fold")
    return rows.groupBy("key").agg(F.max_by(F.struct("value", "confidence", "n"), "batch").alias("s")).select("key", "s.*")


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per window and type, with a watermark; on a batch the watermark has no effect."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,6)")).alias("total"))
