"""Images as tables: pages with their tags, and pixels by tiles through a Python data source.

`pages()` reads directories only. `spark.read.format("plane_tiles")` gives a row for each tile of each page, a task for
runs of tiles, and pushes down filters on the page and the tile's place, so only those segments are opened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from plexframe.functions import channels
from plexframe.sources import tiff

PAGES = "path string, page_index int, height int, width int, dtype string, samples int, compression int, tile_height int, tile_width int, description string, x_per_unit double, y_per_unit double, unit string, error_type string, message string"
TILES = "path string, page_index int, sample int, tile_row int, tile_col int, y0 int, x0 int, height int, width int, dtype string, pixels binary, error_type string, message string"
#: Elements of an image that may be read as a whole, and tiles of a task.
FULL_READ, TASK_TILES = 250_000_000, 256


def describe(path: str) -> list[tuple]:
    """A row of PAGES for each page; one with an error if the file can't be read."""
    try:
        found = tiff.pages(path)
    except Exception as e:  # noqa: BLE001  an unreadable file is a row of the report
        return [(path, None, *[None] * 11, type(e).__name__, str(e))]
    out = []
    for i, p in enumerate(found):
        try:
            th, tw = p.segment
            out.append((path, i, int(p.height), int(p.width), p.dtype.newbyteorder("=").name, p.samples_per_pixel, int(p.get("compression", 1)), th, tw, p.get("description"), p.ratio("x_resolution"), p.ratio("y_resolution"), tiff.UNITS.get(p.get("unit")), None, None))
        except (ValueError, AttributeError) as e:
            out.append((path, i, *[None] * 11, type(e).__name__, str(e)))
    return out


def pages(images: DataFrame, path: str = "path") -> DataFrame:
    """The pages of all images of a table, each file's directory read in one task."""
    names = [c.split()[0] for c in PAGES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), *[pa.int32()] * 3, pa.string(), *[pa.int32()] * 4, pa.string(), pa.float64(), pa.float64(), *[pa.string()] * 3]
        for batch in batches:
            rows = [r for p in batch.column(0).to_pylist() for r in describe(p)]
            yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    return images.select(F.col(path).cast("string").alias("path")).distinct().mapInArrow(run, PAGES)


class Tiles(InputPartition):
    """A run of tiles of one page and sample of a file."""

    def __init__(self, path: str, page: int, sample: int, tiles: list[tuple[int, int]]):
        self.path, self.page, self.sample, self.tiles = path, page, sample, tiles


class TileReader(DataSourceReader):
    """Plans tiles from directories and decodes them; filters on integers of a tile's place are taken over."""

    def __init__(self, paths: list[str]):
        self.paths, self.tests = paths, []

    def pushFilters(self, filters):
        for f in filters:
            name = ".".join(f.attribute) if hasattr(f, "attribute") else ""
            kinds = {EqualTo: "==", In: "in", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
            if name in ("page_index", "sample", "tile_row", "tile_col") and type(f) in kinds:
                self.tests.append((name, kinds[type(f)], f.value))
            else:
                yield f

    def wanted(self, **at: int) -> bool:
        good = {"==": lambda a, b: a == b, "in": lambda a, b: a in b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}
        return all(good[op](at[name], value) for name, op, value in self.tests if name in at)

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for path in self.paths:
            for i, p in enumerate(tiff.pages(path)):
                th, tw = p.segment
                places = [(r, c) for r in range(-(-int(p.height) // th)) for c in range(-(-int(p.width) // tw)) if self.wanted(page_index=i, tile_row=r, tile_col=c)]
                for s in range(p.samples_per_pixel):
                    if self.wanted(sample=s):
                        out += [Tiles(path, i, s, places[k : k + TASK_TILES]) for k in range(0, len(places), TASK_TILES)]
        return out

    def read(self, partition: Tiles) -> Iterator[tuple]:
        page = tiff.pages(partition.path)[partition.page]
        th, tw = page.segment
        for r, c in partition.tiles:
            head = (partition.path, partition.page, partition.sample, r, c, r * th, c * tw)
            try:
                got = tiff.region(partition.path, page, r * th, c * tw, th, tw, partition.sample)
                yield (*head, *got.shape, got.dtype.name, got.tobytes(), None, None)
            except Exception as e:  # noqa: BLE001  a tile that can't be decoded is a row with its error
                yield (*head, None, None, None, None, type(e).__name__, str(e))


class PlaneTiles(DataSource):
    """format("plane_tiles").load(path) or option("paths", comma-separated)."""

    @classmethod
    def name(cls) -> str:
        return "plane_tiles"

    def schema(self) -> str:
        return TILES

    def reader(self, schema) -> TileReader:
        paths = self.options.get("paths") or self.options.get("path") or ""
        return TileReader([p for p in paths.split(",") if p])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PlaneTiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def tiles(spark: SparkSession, paths: list[str]) -> DataFrame:
    register(spark)
    return spark.read.format("plane_tiles").option("paths", ",".join(paths)).load()


def pixels(found: DataFrame) -> DataFrame:
    """(path, page_index, sample, y, x, v) of decoded tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.to_pylist():
                v = np.frombuffer(t["pixels"], t["dtype"]).reshape(t["height"], t["width"]).astype(np.float64)
                y, x = np.mgrid[t["y0"] : t["y0"] + t["height"], t["x0"] : t["x0"] + t["width"]].astype(np.int32)
                n = v.size
                yield pa.record_batch([pa.array([t["path"]] * n), pa.array(np.full(n, t["page_index"], np.int32)), pa.array(np.full(n, t["sample"], np.int32)), pa.array(y.ravel()), pa.array(x.ravel()), pa.array(v.ravel())], ["path", "page_index", "sample", "y", "x", "v"])

    return found.where("pixels is not null").mapInArrow(run, "path string, page_index int, sample int, y int, x int, v double")


def region(spark: SparkSession, path: str, y: int, x: int, height: int, width: int, pages_: list[int] | None = None) -> DataFrame:
    """(page_index, sample, y, x, v) of a region with (y, x) from its corner; only the tiles that it meets are opened."""
    found = tiles(spark, [path])
    sizes = {p.segment for p in tiff.pages(path)}
    if pages_ is not None:
        found = found.where(F.col("page_index").isin(pages_))
    if len(sizes) == 1:
        th, tw = sizes.pop()
        found = found.where((F.col("tile_row") >= y // th) & (F.col("tile_row") <= (y + height - 1) // th) & (F.col("tile_col") >= x // tw) & (F.col("tile_col") <= (x + width - 1) // tw))
    inside = (F.col("y") >= y) & (F.col("y") < y + height) & (F.col("x") >= x) & (F.col("x") < x + width)
    return pixels(found).where(inside).select("page_index", "sample", (F.col("y") - y).alias("y"), (F.col("x") - x).alias("x"), "v")


def guard_full_read(elements: int, allow: bool = False) -> None:
    """Refuses to read an image as a whole that has more elements than `FULL_READ`."""
    if elements > FULL_READ and not allow:
        raise ValueError(f"{elements} elements are more than {FULL_READ}; allow a full read to go on")


def open_images(images: DataFrame, root: str | None = None) -> DataFrame:
    """images(path, reader_type) with kind and the path to read; kinds without a reader here are rows for the report, not errors."""
    where = channels.expand_path(F.col("path"), F.lit(root) if root else None)
    kind = channels.reader_kind(F.col("reader_type"), F.col("path"))
    return images.withColumn("kind", kind).withColumn("source", where).withColumn("readable", ~F.col("kind").isin("ims", "openslide"))


def scan(images: DataFrame, target: int = 1600) -> DataFrame:
    """Integrity issues of all readable images: every tile of the pages of the level chosen is decoded; others are only opened."""
    from plexframe.operators import integrity

    found = pages(images)
    none = F.lit(None)
    unopened = found.where("page_index is null").select("path", F.lit(integrity.OPEN).alias("stage"), none.cast("string").alias("channel"), none.cast("long").alias("page_index"), "error_type", "message")
    good = found.where("height is not null").withColumnRenamed("path", "image")
    expected = good.groupBy("image").agg(F.max_by(F.struct("height", "width"), F.col("height").cast("long") * F.col("width")).alias("top"))
    expected = good.join(expected, "image").where("height = top.height and width = top.width").groupBy("image").agg(F.count(F.lit(1)).alias("channels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, text = [], []
            for path, i in zip(batch.column("image").to_pylist(), batch.column("page_index").to_pylist(), strict=True):
                try:
                    p = tiff.pages(path)[i]
                    for s in range(p.samples_per_pixel):
                        tiff.region(path, p, 0, 0, int(p.height), int(p.width), s)
                    kind.append(None), text.append(None)
                except Exception as e:  # noqa: BLE001  a page that can't be decoded is a row of the report
                    kind.append(type(e).__name__), text.append(str(e))
            keep = [batch.column(c) for c in ("image", "height", "width", "page_index", "description")]
            yield pa.record_batch([*keep, pa.array(kind, pa.string()), pa.array(text, pa.string())], ["image", "height", "width", "page_index", "description", "error_type", "message"])

    level = integrity.choose_level(integrity.page_levels(good, expected), target).select("image", "height", "width")
    chosen = good.join(level, ["image", "height", "width"]).select("image", "height", "width", "page_index", "description").repartition("image", "page_index")
    decoded = chosen.mapInArrow(run, "image string, height int, width int, page_index int, description string, error_type string, message string")
    label = channels.page_label(F.col("description"), F.col("page_index"))
    bad = decoded.where("error_type is not null").select(F.col("image").alias("path"), F.lit(integrity.DECODE).alias("stage"), label.alias("channel"), F.col("page_index").cast("long").alias("page_index"), "error_type", "message")
    return unopened.unionByName(bad)
