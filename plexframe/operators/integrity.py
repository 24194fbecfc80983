"""Integrity: page pyramids, one issue row for each failing page, reports, gates and release totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexframe.operators.manifest import choose_level

#: Stages at which an image can fail.
DECODE, OPEN = "qptiff_thumbnail_page_full_decode", "reader_open_or_metadata"
ISSUE = ("path", "stage", "channel", "page_index", "error_type", "message")


def page_levels(pages: DataFrame, expected: DataFrame) -> DataFrame:
    """(image, height, width, pages) of page shapes with exactly the expected channels; pages(image, height, width), expected(image, channels)."""
    shapes = pages.where("height > 0 and width > 0").groupBy("image", "height", "width").agg(F.count(F.lit(1)).alias("pages"))
    return shapes.join(expected, "image").where("pages = channels").select("image", "height", "width", "pages")


def level_errors(pages: DataFrame, expected: DataFrame) -> DataFrame:
    """(image, message) of images none of whose page shapes has the expected channels, naming the shapes that there are."""
    shapes = pages.where("height > 0 and width > 0").groupBy("image", "height", "width").agg(F.count(F.lit(1)).alias("pages"))
    found = shapes.groupBy("image").agg(F.array_sort(F.collect_list(F.struct("height", "width", "pages"))).alias("s"), F.collect_set("pages").alias("counts"))
    text = F.array_join(F.transform("s", lambda g: F.concat(g["width"].cast("string"), F.lit("x"), g["height"].cast("string"), F.lit(":"), g["pages"].cast("string"))), ", ")
    bad = expected.join(found, "image", "left").where(F.col("counts").isNull() | ~F.expr("array_contains(counts, channels)"))
    return bad.select("image", F.concat(F.lit("no pyramid level has exactly "), F.col("channels").cast("string"), F.lit(" channel pages; found "), F.coalesce(F.nullif(text, F.lit("")), F.lit("none"))).alias("message"))


def page_issues(pages: DataFrame, expected: DataFrame, target: int, failed: Column, label: Column, error: Column, message: Column) -> DataFrame:
    """An issue for every failing page of the level chosen for each image, and one for each image without a level."""
    level = choose_level(page_levels(pages, expected), target).select("image", "height", "width")
    decoded = pages.join(level, ["image", "height", "width"]).where(failed)
    decoded = decoded.select(F.col("image").alias("path"), F.lit(DECODE).alias("stage"), label.alias("channel"), F.col("page_index").cast("long").alias("page_index"), error.alias("error_type"), message.alias("message"))
    none = F.lit(None)
    unopened = level_errors(pages, expected).select(F.col("image").alias("path"), F.lit(OPEN).alias("stage"), none.cast("string").alias("channel"), none.cast("long").alias("page_index"), F.lit("ValueError").alias("error_type"), "message")
    return decoded.unionByName(unopened)


def report(issues: DataFrame, images: DataFrame) -> DataFrame:
    """One row: total, passed, failed, and the issues as sorted structs; images(path), issues with the columns of ISSUE."""
    by_image = issues.groupBy("path").agg(F.collect_list(F.struct(*ISSUE)).alias("own"))
    x = images.select("path").join(by_image, "path", "left")
    totals = x.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("own").isNull()).alias("passed"), F.count_if(F.col("own").isNotNull()).alias("failed"), F.array_sort(F.flatten(F.collect_list("own"))).alias("issues"))
    return totals


def report_json(found: DataFrame) -> DataFrame:
    """(status, value): the report as JSON, and the exit status, 1 if any image failed."""
    return found.select(F.when(F.col("failed") > 0, 1).otherwise(0).alias("status"), F.to_json(F.struct("total", "passed", "failed", "issues")).alias("value"))


def shape_mismatches(images: DataFrame, raw: tuple[str, str], slide: tuple[str, str]) -> DataFrame:
    """Images whose raw size and size as a slide differ."""
    return images.where((F.col(raw[0]) != F.col(slide[0])) | (F.col(raw[1]) != F.col(slide[1])))


def release_checks(images: DataFrame, outputs: DataFrame) -> DataFrame:
    """(check, stem): stems given twice, passed images without an output, failed ones with one; images(stem, ok), outputs(stem)."""
    out = outputs.select("stem").distinct()
    twice = images.groupBy("stem").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("duplicate_stem").alias("check"), "stem")
    missing = images.where("ok").join(out, "stem", "left_anti").select(F.lit("missing_output").alias("check"), "stem").distinct()
    stray = images.where("not ok").join(out, "stem", "left_semi").select(F.lit("output_of_failed").alias("check"), "stem").distinct()
    return twice.unionByName(missing).unionByName(stray)


def passed_only(coords: DataFrame, issues: DataFrame, image: str) -> DataFrame:
    """Coordinates of images without an issue: a coordinate file counts only if integrity passed first."""
    return coords.join(issues.select(F.col("path").alias(image)).distinct(), image, "left_anti")


def stage_status(images: DataFrame, stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """(image, stage) at which each image stands: the first stage whose table (image) lacks it, or 'done'."""
    x = images.select("image")
    for name, done in stages:
        x = x.join(done.select("image").distinct().withColumn(f"_{name}", F.lit(True)), "image", "left")
    return x.select("image", F.coalesce(*(F.when(F.col(f"_{name}").isNull(), F.lit(name)) for name, _ in stages), F.lit("done")).alias("stage"))


def audit(files: DataFrame, kind: Column, resolved: Column) -> DataFrame:
    """(kind, images, unresolved) of a discovery."""
    return files.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("images"), F.count_if(~resolved).alias("unresolved"))


def release_totals(slides: DataFrame) -> DataFrame:
    """(dataset, slides, patches, channels) from rows (dataset, num_patches, channel_count)."""
    return slides.groupBy("dataset").agg(F.count(F.lit(1)).alias("slides"), F.sum("num_patches").alias("patches"), F.sum("channel_count").alias("channels"))
