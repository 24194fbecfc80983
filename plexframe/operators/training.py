"""Training samples: channel order and limits, offsets, normalisation, padding, hash sampling, masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Sample numbers that locate() joins by one key.
STRETCH = 64


def order_channels(df: DataFrame, image: str, unknown: int = 0) -> DataFrame:
    """Adds rank: by marker id, unknown last, ties by original position."""
    last = F.when(F.col("marker_id") == unknown, F.lit((1 << 62))).otherwise(F.col("marker_id"))
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(image).orderBy(last, "channel")))


def drop_guarded(df: DataFrame, image: str, keep: Column) -> DataFrame:
    """Channels to keep, or all of an image's if none were left."""
    return df.withColumn("_k", keep.cast("int")).withColumn("_any", F.max("_k").over(Window.partitionBy(image))).where("_k = 1 or _any = 0").drop("_k", "_any")


def sample_counts(entries: DataFrame, counts: DataFrame, has_coords: Column, entry: str = "image") -> DataFrame:
    """Adds n: the coordinates of an entry, or 1 if it has no coordinate file; counts(entry, c)."""
    c = counts.select(F.col(entry).alias("_e"), F.col("c").alias("_c"))
    return entries.join(c, F.col(entry) == F.col("_e"), "left").withColumn("n", F.when(has_coords, F.coalesce("_c", F.lit(0))).otherwise(1).cast("long")).drop("_e", "_c")


def offsets(entries: DataFrame, ord_: str, count: str, bucket: int = 1 << 16) -> DataFrame:
    """Adds lo and hi: the half-open range of global sample numbers of each entry; entries without samples go.

    ord_ is a whole number. Counts are summed by buckets of it first, so a window over all rows holds buckets only."""
    x = entries.where(F.col(count) > 0).withColumn("_b", F.floor(F.col(ord_) / bucket))
    sums = x.groupBy("_b").agg(F.sum(count).alias("_t"))
    before = F.coalesce(F.sum("_t").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    x = x.join(sums.select("_b", before.alias("_before")), "_b")
    inside = Window.partitionBy("_b").orderBy(ord_).rowsBetween(Window.unboundedPreceding, 0)
    return x.withColumn("hi", F.col("_before") + F.sum(count).over(inside)).withColumn("lo", F.col("hi") - F.col(count)).drop("_b", "_before")


def length(entries: DataFrame, count: str | None, per_epoch: int = 0) -> DataFrame:
    """One row n: samples of an epoch if given, else the entries' samples, else the entries."""
    if per_epoch:
        return entries.sparkSession.range(1).select(F.lit(per_epoch).cast("long").alias("n"))
    return entries.agg((F.coalesce(F.sum(count), F.lit(0)) if count else F.count(F.lit(1))).cast("long").alias("n"))


def locate(samples: DataFrame, ranges: DataFrame) -> DataFrame:
    """Entry and local number of global numbers (idx), joined by the stretch of `STRETCH` numbers that they lie in."""
    stretch = lambda c: F.floor(c / STRETCH).cast("long")
    by_stretch = ranges.where("lo < hi").withColumn("_s", F.explode(F.sequence(stretch(F.col("lo")), stretch(F.col("hi") - 1))))
    inside = (F.col("idx") >= F.col("lo")) & (F.col("idx") < F.col("hi"))
    return samples.withColumn("_s", stretch(F.col("idx"))).join(by_stretch, "_s").where(inside).drop("_s").withColumn("local", F.col("idx") - F.col("lo"))


def normalize_plane(pixels: DataFrame, by: list[str], mode: str = "percentile") -> DataFrame:
    """Adds norm by `mode`: none, uint (by the plane's maximum), percentile or log_percentile (1 and 99.5, clipped to 0..1)."""
    if mode not in ("none", "uint", "percentile", "log_percentile"):
        raise ValueError(f"unknown normalization {mode!r}")
    if mode == "none":
        return pixels.withColumn("norm", F.col("v"))
    if mode == "uint":
        top = pixels.groupBy(*by).agg(F.max("v").alias("top"))
        return pixels.join(top, by).withColumn("norm", F.col("v") / F.when(F.col("top") == 0, 1.0).otherwise(F.col("top")))
    x = pixels.withColumn("t", F.log1p(F.greatest("v", F.lit(0.0))) if mode == "log_percentile" else F.col("v"))
    limits = x.groupBy(*by).agg(F.expr("percentile(t, 0.01)").alias("lo"), F.expr("percentile(t, 0.995)").alias("hi"))
    scaled = F.when(F.col("hi") <= F.col("lo"), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("t") - F.col("lo")) / (F.col("hi") - F.col("lo")))))
    return x.join(limits, by).withColumn("norm", scaled)


def pad(values: Column, size: int, fill) -> Column:
    """An array cut or filled to `size`."""
    return F.slice(F.concat(values, F.array_repeat(F.lit(fill), size)), 1, size)


def hash_int(*parts: Column) -> Column:
    """A non-negative integer below 2**28 from the md5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", *parts)), 1, 7), 16, 10).cast("long")


# ---------------------------------------------------------------- random samples


def below(limit: Column, *parts: Column) -> Column:
    """A number from 0 to limit - 1 that the parts decide; 0 if the limit is 1 or less."""
    return F.when(limit > 1, hash_int(*parts) % limit).otherwise(F.lit(0)).cast("long")


def _text(*parts) -> list[Column]:
    return [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]


def draw(samples: DataFrame, entries: DataFrame, seed: int, block: int = 1) -> DataFrame:
    """samples(idx) with an entry each, the same for a block of samples, and a coordinate of it (-1 if it has none).

    entries(nth, ..., n): numbered from 0, with their coordinates. The hash of the seed and the index decides."""
    total = entries.agg(F.count(F.lit(1)).alias("_total"))
    x = samples.join(F.broadcast(total))  # one row
    x = x.withColumn("nth", below(F.col("_total"), *_text(str(seed), "entry", F.floor(F.col("idx") / block))))
    x = x.join(entries, "nth").drop("_total")
    return x.withColumn("coord_index", F.when(F.col("n") > 0, below(F.col("n"), *_text(str(seed), "coord", F.col("idx")))).otherwise(F.lit(-1)).cast("long"))


def origins(samples: DataFrame, patch: int, seed: int) -> DataFrame:
    """Adds x and y: a random corner at which the patch fits, 0 where the image is no larger; samples(idx, width, height)."""
    place = lambda side, name: below(F.col(side) - patch + 1, *_text(str(seed), name, F.col("idx")))
    return samples.withColumn("y", place("height", "y")).withColumn("x", place("width", "x"))


def readable(samples: DataFrame, bad: DataFrame, total: int, seed: int, attempts: int = 9) -> DataFrame:
    """samples(idx) with used: the first of up to `attempts` sample numbers that is not in bad(idx), null if all are.

    The first is the sample itself, the others follow from the hash of the seed, the sample and the attempt."""
    tries = F.array(F.col("idx"), *(below(F.lit(total), *_text(str(seed), "retry", F.col("idx"), F.lit(k))) for k in range(1, attempts)))
    x = samples.select("idx", F.posexplode(tries).alias("attempt", "used"))
    good = x.join(bad.select(F.col("idx").alias("used")).distinct(), "used", "left_anti").groupBy("idx").agg(F.min_by("used", "attempt").alias("used"))
    return samples.join(good, "idx", "left")


def keep_channels(df: DataFrame, image: str, blank: int | None = 1, unknown: int | None = 0) -> DataFrame:
    """Channels without blank and unknown ones, where these ids are given; all of an image's if none would be left."""
    keep = F.lit(True)
    for marker in (blank, unknown):
        keep = keep & (F.col("marker_id") != marker) if marker is not None else keep
    return drop_guarded(df, image, keep)


def assemble(channels: DataFrame, sample: list[str], most: int | None = None, unknown: int = 0) -> DataFrame:
    """A row for each sample with its channels as arrays, by marker id and position; channels(*sample, channel, marker_id, marker, raw)."""
    last = F.when(F.col("marker_id") == unknown, F.lit(1 << 62)).otherwise(F.col("marker_id"))
    rows = F.array_sort(F.collect_list(F.struct(last.alias("o"), F.col("channel").cast("long").alias("channel"), "marker_id", "marker", "raw")))
    x = channels.groupBy(*sample).agg((F.slice(rows, 1, most) if most else rows).alias("r"))
    part = lambda f, n: F.transform("r", lambda c: c[f]).alias(n)
    return x.select(*sample, part("channel", "channels"), part("marker_id", "marker_ids"), part("marker", "marker_names"), part("raw", "raw_channel_names"), F.size("r").alias("c"))


def collate(samples: DataFrame, batch: str, patch: int, token: int) -> DataFrame:
    """samples(batch, sample, marker_ids, c) padded to the widest of their batch: marker_ids (-1), valid_channels, grid, tokens."""
    widest = F.max("c").over(Window.partitionBy(batch))
    x = samples.withColumn("_w", widest)
    valid = F.transform(F.sequence(F.lit(1), F.col("_w")), lambda i: i <= F.col("c"))
    padded = F.concat("marker_ids", F.array_repeat(F.lit(-1).cast(samples.schema["marker_ids"].dataType.elementType), F.col("_w") - F.col("c")))
    return x.withColumn("marker_ids", padded).withColumn("valid_channels", valid).withColumn("patch_grid", F.array(F.lit(patch // token), F.lit(patch // token))).withColumn("tokens", F.lit((patch // token) ** 2)).drop("_w")


def training_masks(collated: DataFrame, sample: str, seed: int, patch_ratio: float = 0.0, channel_ratio: float = 0.0) -> DataFrame:
    """(sample, channel, token, patch_mask, channel_mask, loss_mask) of valid and padded channels; padded ones are never masked."""
    draw_ = lambda *parts: hash_int(*_text(str(seed), *parts)) / F.lit(float(1 << 28))
    x = collated.select(sample, F.posexplode("valid_channels").alias("channel", "valid"), "tokens").withColumn("token", F.explode(F.sequence(F.lit(0), F.col("tokens") - 1)))
    patch = F.col("valid") & (draw_("patch", F.col(sample), F.col("channel"), F.col("token")) < patch_ratio)
    channel = F.col("valid") & (draw_("channel", F.col(sample), F.col("channel")) < channel_ratio)
    return x.select(sample, "channel", "token", patch.alias("patch_mask"), channel.alias("channel_mask"), (patch | channel).alias("loss_mask"))


def collator(patch: int = 224, token: int = 16, patch_ratio: float = 0.0, channel_ratio: float = 0.0, seed: int = 0):
    """A function from samples to (collated rows, masks) with these settings."""

    def run(samples: DataFrame, batch: str = "batch", sample: str = "sample") -> tuple[DataFrame, DataFrame]:
        rows = collate(samples, batch, patch, token)
        return rows, training_masks(rows, sample, seed, patch_ratio, channel_ratio)

    return run


def pad_patch(pixels: DataFrame, by: list[str], patch: int) -> DataFrame:
    """Pixels (y, x, v) of each plane cut or filled with zeros to patch x patch."""
    grid = pixels.select(*by).distinct().withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(patch - 1)))).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(patch - 1))))
    return grid.join(pixels, [*by, "y", "x"], "left").select(*by, "y", "x", F.coalesce("v", F.lit(0.0)).alias("v"))


def scale_integers(pixels: DataFrame, largest: Column) -> DataFrame:
    """Adds norm: v by the largest value of the plane's integer type."""
    return pixels.withColumn("norm", F.col("v") / F.coalesce(F.nullif(largest.cast("double"), F.lit(0.0)), F.lit(1.0)))
