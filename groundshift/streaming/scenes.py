"""Scenes as they arrive: the batch selection, kept up by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from groundshift.operators.scenes import latest_processing


def arriving(spark, path: str, schema: StructType, delay: str = "2 days", files: int = 100) -> DataFrame:
    """A stream of scenes, each id once within the delay; what comes later than it is dropped by the watermark. files: the most of a micro-batch."""
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    return s.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["scene_id"])


def daily_counts(scenes: DataFrame) -> DataFrame:
    """Scenes of each tile and day and their least cloud."""
    return scenes.groupBy(F.window("ts", "1 day"), "tile").agg(F.count(F.lit(1)).alias("n"), F.min("cloud").alias("best_cloud"))


def keep_selection(scenes: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """For each micro-batch: the latest processing of each acquisition in it, as a folder of the table at target; selection() reads the table. A batch that is run again overwrites its own folder."""

    def put(batch: DataFrame, number: int) -> None:
        latest_processing(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return scenes.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def selection(spark, target: str) -> DataFrame:
    """The latest processing of each acquisition over all batches so far, in whichever they came."""
    return latest_processing(spark.read.parquet(target).drop("batch"))
