"""Manifests that grow: new files of JSON lines in a folder become image rows, each path once within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plexframe.operators.manifest import specs


def image_stream(spark: SparkSession, folder: str, late: str = "1 day", files: int = 100) -> DataFrame:
    """Rows of the lines of new files, with seen: when the file was changed; a path that comes again within `late` is left out.

    A line that isn't a JSON object ends the stream with an error that names its file."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files).load(folder).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("seen"))
    told = lines.withColumn("value", F.regexp_replace("value", r"(?U)^\s+|\s+$", "")).where((F.col("value") != "") & ~F.col("value").startswith("#"))
    rows = specs(told.withColumn("origin", F.struct("file", "seen")), "value", F.col("file"), "origin")
    rows = rows.select(F.col("origin.file").alias("file"), F.col("origin.seen").alias("seen"), *(c for c in rows.columns if c != "origin"))
    return rows.withWatermark("seen", late).dropDuplicatesWithinWatermark(["path"])


def append_images(images: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends all that has come so far to Parquet files, exactly once, and ends."""
    return images.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_dataset(images: DataFrame, span: str = "1 hour") -> DataFrame:
    """(start, dataset, images) for each span of time that the watermark has passed."""
    x = images.groupBy(F.window("seen", span).alias("w"), "dataset").agg(F.count(F.lit(1)).alias("images"))
    return x.select(F.col("w.start").alias("start"), "dataset", "images")
