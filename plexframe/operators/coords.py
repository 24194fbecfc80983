"""The coordinate store: patch coordinates and their attributes as two tables, with channel metadata beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The format's name, the largest chunk, and the attributes of each image.
FORMAT, CHUNK = "sp_trident_coords_v1", 4096
ATTRIBUTES = (
    "patch_size", "overlap", "patch_size_level0", "level0_width", "level0_height", "level0_magnification", "target_magnification", "mpp", "name", "savetodir",
    "reader_type", "min_tissue_fraction", "format", "num_patches", "channel_count", "segmenter",
)
NAMES = ("channel_names", "marker_names", "raw_channel_names", "marker_ids")


def coordinate_rows(coords: DataFrame) -> DataFrame:
    """(image, coord_index, x, y) as 64-bit integers from (image, x, y): y outer, x inner."""
    order = F.array_sort(F.collect_list(F.struct(F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"))))
    return coords.groupBy("image").agg(order.alias("c")).select("image", F.posexplode("c").alias("coord_index", "c")).select("image", "coord_index", F.col("c.x").alias("x"), F.col("c.y").alias("y"))


def attributes(images: DataFrame, coords: DataFrame) -> DataFrame:
    """images with format, num_patches and the length of a chunk; images without coordinates have none."""
    counts = coords.groupBy("image").agg(F.count(F.lit(1)).alias("num_patches"))
    x = images.drop("num_patches", "format", "chunk").join(counts, "image", "left").withColumn("num_patches", F.coalesce("num_patches", F.lit(0)).cast("long"))
    return x.withColumn("format", F.lit(FORMAT)).withColumn("chunk", F.least(F.greatest("num_patches", F.lit(1)), F.lit(CHUNK)))


def write(coords: DataFrame, images: DataFrame, path: str, patch: int, overlap: int) -> None:
    """Writes both tables below a folder for the patch size and overlap; coordinates are partitioned by image."""
    base = f"{path}/patch_{patch}_overlap_{overlap}"
    coordinate_rows(coords).repartition("image").sortWithinPartitions("image", "coord_index").write.mode("overwrite").parquet(f"{base}/patches")
    attributes(images, coords).write.mode("overwrite").parquet(f"{base}/attributes")


def read(spark: SparkSession, path: str, patch: int, overlap: int) -> tuple[DataFrame, DataFrame]:
    """(coordinates, attributes)"""
    base = f"{path}/patch_{patch}_overlap_{overlap}"
    return spark.read.parquet(f"{base}/patches"), spark.read.parquet(f"{base}/attributes")


def with_channels(images: DataFrame, channels: DataFrame) -> DataFrame:
    """images with the channel metadata of channels(image, *NAMES) in place of any that they had; others keep theirs."""
    new = channels.select("image", F.lit(True).alias("_new"), *(F.col(c).alias(f"_{c}") for c in NAMES if c in channels.columns))
    x = images.join(new, "image", "left")
    own = lambda c: F.col(c) if c in images.columns else F.lit(None)
    for c in NAMES:
        if f"_{c}" in new.columns:
            x = x.withColumn(c, F.when(F.col("_new"), F.col(f"_{c}")).otherwise(own(c)))
    return x.drop("_new", *(f"_{c}" for c in NAMES))


def fill_names(entries: DataFrame, stored: DataFrame, image: str = "image") -> DataFrame:
    """entries whose missing names are those stored with the coordinates."""
    names = [c for c in ("channel_names", "marker_names") if c in stored.columns]
    x = entries.join(stored.select(F.col(image).alias("_i"), *(F.col(c).alias(f"_{c}") for c in names)), F.col(image) == F.col("_i"), "left")
    for c in names:
        x = x.withColumn(c, F.coalesce(c, f"_{c}") if c in entries.columns else F.col(f"_{c}"))
    return x.drop("_i", *(f"_{c}" for c in names))


def geojson(runs: DataFrame) -> DataFrame:
    """(image, value): a GeoJSON collection of one rectangle for each run of foreground; images without any have no row."""
    corner = lambda x, y: F.array(F.col(x), F.col(y))
    box = F.array(F.array(corner("x0", "y"), corner("x1", "y"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y")))
    rows = runs.withColumn("y1", F.col("y") + 1).withColumn("f", F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Polygon").alias("type"), box.alias("coordinates")).alias("geometry")))
    found = rows.groupBy("image").agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "x0", "f"))), lambda r: r["f"]).alias("features"))
    return found.select("image", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value"))
