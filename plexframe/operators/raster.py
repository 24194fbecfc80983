"""Raster operators on long-form pixels (image, y, x, ...): scaling, fusion, masks, morphology, components, patches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexframe.operators.cut import cut


def robust_u8(pixels: DataFrame, by: list[str], low: float = 0.01, high: float = 0.995) -> DataFrame:
    """Adds u8: v between two percentiles of the positive values of its plane, scaled to 0..255 and truncated."""
    positive = F.when(F.col("v") > 0, F.col("v"))
    limits = pixels.groupBy(*by).agg(F.coalesce(F.expr(f"percentile(v, {low}) filter (where v > 0)"), F.min("v")).alias("lo"), F.coalesce(F.expr(f"percentile(v, {high}) filter (where v > 0)"), F.max("v")).alias("hi"), F.count(positive).alias("n_pos"))
    limits = limits.withColumn("hi", F.when(F.col("hi") <= F.col("lo"), F.col("lo") + 1).otherwise(F.col("hi")))
    scaled = (F.col("v") - F.col("lo")) * (F.lit(255.0) / (F.col("hi") - F.col("lo")))
    return pixels.join(limits.drop("n_pos"), by).withColumn("u8", F.greatest(F.lit(0.0), F.least(F.lit(255.0), scaled)).cast("int"))


def fuse(planes: DataFrame, how: str = "max", percentile: float = 75.0) -> DataFrame:
    """(image, y, x, fused) over channels; a single channel passes as it is."""
    if how not in ("max", "median", "percentile"):
        raise ValueError(f"unknown fusion {how!r}")
    if not 0 <= percentile <= 100:
        raise ValueError("percentile must be in [0, 100]")
    value = {"max": F.max("u8"), "median": F.median("u8"), "percentile": F.expr(f"percentile(u8, {percentile / 100})")}[how]
    return planes.groupBy("image", "y", "x").agg(value.cast("int").alias("fused"), F.count(F.lit(1)).alias("channels"))


def threshold(scores: DataFrame, percentile: float = 50.0, min_signal: float = 8.0) -> DataFrame:
    """(image, threshold): the percentile of positive scores, at least min_signal."""
    value = F.coalesce(F.expr(f"percentile(fused, {percentile / 100}) filter (where fused > 0)"), F.lit(min_signal))
    return scores.groupBy("image").agg(F.greatest(F.lit(float(min_signal)), value).alias("threshold"))


def foreground(scores: DataFrame, percentile: float = 50.0, min_signal: float = 8.0) -> DataFrame:
    """(image, y, x, m) with m = 1 where the score is above the image's threshold."""
    return scores.join(threshold(scores, percentile, min_signal), "image").select("image", "y", "x", (F.col("fused") > F.col("threshold")).cast("int").alias("m"))


def integral(mask: DataFrame) -> DataFrame:
    """(image, y, x, s): the sum of m over all pixels up to and including (y, x)."""
    across = Window.partitionBy("image", "y").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("image", "x").orderBy("y").rowsBetween(Window.unboundedPreceding, 0)
    return mask.withColumn("r", F.sum("m").over(across)).withColumn("s", F.sum("r").over(down)).select("image", "y", "x", "s")


def patch_grid(images: DataFrame, patch: int, overlap: int = 0) -> DataFrame:
    """(image, x, y) of patch corners from (image, width, height); rests at the right and bottom are not covered."""
    if patch <= 0 or not 0 <= overlap < patch:
        raise ValueError("patch must be positive and overlap in [0, patch)")
    starts = lambda size: F.sequence(F.lit(0), F.greatest(F.lit(0), F.col(size) - patch), F.lit(patch - overlap))
    return images.withColumn("y", F.explode(starts("height"))).withColumn("x", F.explode(starts("width")))


def rect_fraction(sums: DataFrame, rects: DataFrame, patch: int) -> DataFrame:
    """Adds fraction of foreground in [x, x + patch) x [y, y + patch) from the integral image, by four equi-joins."""
    out = rects.withColumn("x1", F.least(F.col("x") + patch, "width")).withColumn("y1", F.least(F.col("y") + patch, "height"))
    total = F.lit(0)
    for i, (cx, cy, sign) in enumerate((("x1", "y1", 1), ("x", "y1", -1), ("x1", "y", -1), ("x", "y", 1))):
        s = sums.select(F.col("image").alias(f"i{i}"), F.col("x").alias(f"sx{i}"), F.col("y").alias(f"sy{i}"), F.col("s").alias(f"s{i}"))
        out = out.join(s, (F.col("image") == F.col(f"i{i}")) & (F.col(cx) - 1 == F.col(f"sx{i}")) & (F.col(cy) - 1 == F.col(f"sy{i}")), "left")
        total = total + sign * F.coalesce(f"s{i}", F.lit(0))
    return out.withColumn("fraction", total / ((F.col("x1") - F.col("x")) * (F.col("y1") - F.col("y")))).drop("x1", "y1", *(f"{c}{i}" for c in ("i", "sx", "sy", "s") for i in range(4)))


def patch_coords(mask: DataFrame, patch: int, overlap: int = 0, min_fraction: float = 0.1) -> DataFrame:
    """(image, coord_index, x, y) of patches with enough foreground, y outer and x inner."""
    images = mask.groupBy("image").agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"))
    found = rect_fraction(integral(mask), patch_grid(images, patch, overlap), patch).where(F.col("fraction") >= min_fraction)
    return found.select("image", (F.row_number().over(Window.partitionBy("image").orderBy("y", "x")) - 1).alias("coord_index"), "x", "y")


def runs(mask: DataFrame) -> DataFrame:
    """(image, y, x0, x1) of runs of foreground, half open."""
    order = Window.partitionBy("image", "y").orderBy("x")
    island = mask.where("m = 1").withColumn("g", F.col("x") - F.row_number().over(order))
    return island.groupBy("image", "y", "g").agg(F.min("x").alias("x0"), (F.max("x") + 1).alias("x1")).drop("g")


def disc(radius: int) -> list[tuple[int, int]]:
    """(dy, half width) of an elliptical structuring element of 2r + 1 rows."""
    return [(dy, int(np.rint(radius * np.sqrt(max(0.0, 1 - (dy / radius) ** 2))))) for dy in range(-radius, radius + 1)] if radius > 0 else [(0, 0)]


def dilate(mask: DataFrame, radius: int) -> DataFrame:
    """m = 1 where foreground lies under the disc: runs are widened for each row of the disc and merged, then cover pixels."""
    shape = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(w).alias("w")) for dy, w in disc(radius)))
    wide = runs(mask).withColumn("o", F.explode(shape)).select("image", (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x0") - F.col("o.w")).alias("x0"), (F.col("x1") + F.col("o.w")).alias("x1"))
    order = Window.partitionBy("image", "y").orderBy("x0", "x1")
    new = F.coalesce(F.col("x0") > F.max("x1").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    island = wide.withColumn("new", new.cast("int")).withColumn("g", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = island.groupBy("image", "y", "g").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"))
    hit = merged.select("image", "y", F.explode(F.sequence(F.col("x0"), F.col("x1") - 1)).alias("x"), F.lit(1).alias("hit"))
    return mask.select("image", "y", "x").join(hit, ["image", "y", "x"], "left").select("image", "y", "x", F.coalesce("hit", F.lit(0)).alias("m"))


def invert(mask: DataFrame) -> DataFrame:
    return mask.withColumn("m", 1 - F.col("m"))


def erode(mask: DataFrame, radius: int) -> DataFrame:
    return invert(dilate(invert(mask), radius))


def close(mask: DataFrame, radius: int) -> DataFrame:
    return erode(dilate(mask, radius), radius) if radius > 0 else mask


def open_(mask: DataFrame, radius: int) -> DataFrame:
    return dilate(erode(mask, radius), radius) if radius > 0 else mask


def label_plane(m: np.ndarray) -> np.ndarray:
    """8-connected components of a 0/1 plane: 1 + the smallest flat position of each, 0 for background."""
    h, w = m.shape
    lab = np.where(m > 0, np.arange(1, h * w + 1).reshape(h, w), 0)
    big = h * w + 1
    while True:
        pad = np.pad(np.where(lab > 0, lab, big), 1, constant_values=big)
        least = np.min([pad[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w] for dy in (-1, 0, 1) for dx in (-1, 0, 1)], axis=0)
        new = np.where(lab > 0, least, 0)
        flat = np.concatenate([[0], new.ravel()])
        new = np.where(new > 0, flat[new], 0)  # pointer jumping
        if (new == lab).all():
            return lab
        lab = new


def components(mask: DataFrame) -> DataFrame:
    """(image, y, x, label) of foreground pixels; each image is one group, a raster of bounded size."""

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        m = np.zeros((int(pdf.y.max()) + 1, int(pdf.x.max()) + 1), np.int8)
        m[pdf.y, pdf.x] = pdf.m
        lab = label_plane(m)
        y, x = np.nonzero(lab)
        return pd.DataFrame({"image": np.full(len(y), pdf.image.iloc[0]), "y": y, "x": x, "label": lab[y, x]})

    return mask.select(F.col("image").cast("long").alias("image"), "y", "x", "m").groupBy("image").applyInPandas(kernel, "image long, y int, x int, label long")


def component_stats(mask: DataFrame) -> DataFrame:
    """(image, label, x0, y0, w, h, area) and the raster's width and height."""
    size = sizes(mask)
    stats = components(mask).groupBy("image", "label").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") - F.min("x") + 1).alias("w"), (F.max("y") - F.min("y") + 1).alias("h"), F.count(F.lit(1)).alias("area"))
    return stats.join(size, "image")


def area_limit(fraction: float) -> Column:
    return F.greatest(F.lit(1), F.bround(F.col("width") * F.col("height") * F.lit(fraction)).cast("int"))


def _margin(side: str, fraction: float) -> Column:
    return F.greatest(F.lit(1), F.bround(F.col(side) * F.lit(fraction)).cast("int"))


def _reaches(start: str, span: str, side: str, margin: Column, touching: bool) -> Column:
    """Whether a box comes within the margin of either end of a side; touching: lying at the margin counts."""
    ahead, behind = F.col(start), F.col(side) - F.col(start) - F.col(span)
    return (ahead <= margin) | (behind <= margin) if touching else (ahead < margin) | (behind < margin)


def near_edge(fraction: float) -> Column:
    """Whether a component's box reaches into the margin on any side."""
    return _reaches("x0", "w", "width", _margin("width", fraction), False) | _reaches("y0", "h", "height", _margin("height", fraction), False)


def density() -> Column:
    return F.col("area") / (F.col("w") * F.col("h"))


def frame(span: float = 0.65, sparse: float = 0.30, margin: int = 2) -> Column:
    """A sparse component that spans the image and comes within `margin` pixels of an edge."""
    spans = F.greatest(F.col("w") / F.col("width"), F.col("h") / F.col("height")) >= span
    touches = _reaches("x0", "w", "width", F.lit(margin), True) | _reaches("y0", "h", "height", F.lit(margin), True)
    return spans & touches & (density() <= sparse)


def strip(margin: float = 0.15, thickness: float = 0.16, span: float = 0.25) -> Column:
    """A thin component along the nearby edge: flat ones at the top or bottom, upright ones at the left or right."""
    flat = _reaches("y0", "h", "height", _margin("height", margin), True) & (F.col("h") / F.col("height") <= thickness) & (F.col("w") / F.col("width") >= span)
    upright = _reaches("x0", "w", "width", _margin("width", margin), True) & (F.col("w") / F.col("width") <= thickness) & (F.col("h") / F.col("height") >= span)
    return flat | upright


def small_edge(fraction: float = 0.005, margin: float = 0.15) -> Column:
    """A component below an area limit near an edge; a fraction of 0 or less finds none."""
    return (F.col("area") < area_limit(fraction)) & near_edge(margin) if fraction > 0 else F.lit(False)


def sparse_edge(fraction: float = 0.15, sparse: float = 0.35, margin: float = 0.15) -> Column:
    return near_edge(margin) & (F.col("area") <= area_limit(fraction)) & (density() <= sparse)


def thin(aspect: float = 5.0, thickness: float = 0.025, fraction: float = 0.008) -> Column:
    """An isolated bar: thin against the image, long against its own thickness, and small."""
    short, long_ = F.least("w", "h"), F.greatest("w", "h")
    return (short <= F.greatest(F.lit(1.0), F.least("width", "height") * F.lit(thickness))) & (long_ / short >= aspect) & (F.col("area") <= area_limit(fraction))


#: Which components each filter keeps, by its name.
FILTERS = {
    "min_area": lambda f: F.col("area") >= area_limit(f),
    "frame": lambda: ~frame(),
    "strip": lambda: ~strip(),
    "small_edge": lambda f=0.005: ~small_edge(f),
    "sparse": lambda: ~sparse_edge(),
    "thin": lambda: ~thin(),
}


def keep_components(mask: DataFrame, keep: Column) -> DataFrame:
    """The mask with those of its components only whose statistics meet `keep`."""
    labelled = components(mask)
    stats = labelled.groupBy("image", "label").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") - F.min("x") + 1).alias("w"), (F.max("y") - F.min("y") + 1).alias("h"), F.count(F.lit(1)).alias("area"))
    good = stats.join(sizes(mask), "image").where(keep).select("image", "label", F.lit(1).alias("f"))
    kept = labelled.join(good, ["image", "label"]).select("image", "y", "x", "f")
    return mask.withColumn("image", F.col("image").cast("long")).join(kept, ["image", "y", "x"], "left").select("image", "y", "x", F.coalesce("f", F.lit(0)).alias("m"))


def sizes(mask: DataFrame) -> DataFrame:
    return mask.groupBy(F.col("image").cast("long").alias("image")).agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"))


def fill_holes(mask: DataFrame, fraction: float = 0.02) -> DataFrame:
    """Fills background components that touch no border and are no larger than the limit; the background is labelled once."""
    inside = (F.col("x0") > 0) & (F.col("y0") > 0) & (F.col("x0") + F.col("w") < F.col("width")) & (F.col("y0") + F.col("h") < F.col("height"))
    return invert(keep_components(invert(mask), ~(inside & (F.col("area") <= area_limit(fraction)))))


def in_rect(x0: float, y0: float, x1: float, y1: float, width: Column, height: Column) -> Column:
    """Whether (x, y) lies in a region of normalised corners: bounds are rounded half to even, clamped and half open."""
    edge = lambda f, size: F.least(size, F.greatest(F.lit(0), F.bround(F.lit(float(f)) * size).cast("int")))
    return (F.col("x") >= edge(x0, width)) & (F.col("x") < edge(x1, width)) & (F.col("y") >= edge(y0, height)) & (F.col("y") < edge(y1, height))


def in_polygon(points: list[tuple[float, float]], width: Column, height: Column) -> Column:
    """Whether (x, y) lies in a polygon of normalised corners or on its edge, by the even-odd rule.

    Corners are rounded half to even and clamped to the last pixel; a polygon of fewer than three corners is an error."""
    if len(points) < 3:
        raise ValueError("a polygon needs three points")
    pixel = lambda f, size: F.least(size - 1, F.greatest(F.lit(0), F.bround(F.lit(float(f)) * size).cast("int"))).cast("double")
    corners = [(pixel(px, width), pixel(py, height)) for px, py in points]
    x, y, crossings, on_edge = F.col("x"), F.col("y"), F.lit(0), F.lit(False)
    for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1], strict=True):
        side = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        between = x.between(F.least(ax, bx), F.greatest(ax, bx)) & y.between(F.least(ay, by), F.greatest(ay, by))
        on_edge = on_edge | ((side == 0) & between)
        crossings = crossings + (((ay > y) != (by > y)) & ((side > 0) == (by > ay)) & (side != 0)).cast("int")
    return on_edge | (crossings % 2 == 1)


def replace_within(mask: DataFrame, other: DataFrame, inside: Column, both: bool = False) -> DataFrame:
    """The mask with the other mask's pixels inside a region: instead of its own, or (both) beside its own. Pixels that other lacks are 0 there."""
    k = F.coalesce("k", F.lit(0))
    out = mask.join(other.select("image", "y", "x", F.col("m").alias("k")), ["image", "y", "x"], "left")
    return out.select("image", "y", "x", F.when(inside, F.greatest("m", k) if both else k).otherwise(F.col("m")).alias("m"))


def near(mask: DataFrame, anchor: DataFrame, radius: int) -> DataFrame:
    """The mask's foreground that lies within the disc around foreground of the anchor; a gate."""
    wide = dilate(anchor, radius).select("image", "y", "x", F.col("m").alias("k"))
    return mask.join(wide, ["image", "y", "x"], "left").select("image", "y", "x", (F.col("m") * F.coalesce("k", F.lit(0))).alias("m"))


def recover_support(mask: DataFrame, high: DataFrame, anchor: DataFrame, radius: int) -> DataFrame:
    """The mask, and with it the high mask's foreground near the anchor's."""
    return replace_within(mask, near(high, anchor, radius), F.lit(True), both=True)


# ---------------------------------------------------------------- smoothing and scaling


def gaussian(sigma: float, radius: int | None = None) -> list[float]:
    """Weights of a normalised Gaussian from -radius to radius; radius: three sigmas, rounded up, if not given."""
    radius = int(np.ceil(3 * sigma)) if radius is None else radius
    w = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return (w / w.sum()).tolist()


def mirrored(at: Column, size: Column) -> Column:
    """A place outside of 0 .. size - 1 mirrored at the border pixel, which isn't repeated."""
    span = F.greatest(2 * (size - 1), F.lit(1))
    back = F.pmod(at, span)
    return F.when(size == 1, F.lit(0)).otherwise(F.least(back, span - back)).cast("int")


def convolve(pixels: DataFrame, weights: list[float], axis: str, value: str = "v") -> DataFrame:
    """(image, y, x, value) weighted along an axis; places beyond the border are mirrored. A row or column is one array, so there is one shuffle."""
    r, other = len(weights) // 2, "y" if axis == "x" else "x"
    taps = F.array(*(F.struct(F.lit(k - r).alias("d"), F.lit(w).alias("w")) for k, w in enumerate(weights)))
    line = F.transform(F.array_sort(F.collect_list(F.struct(axis, value))), lambda p: p[value].cast("double"))
    rows = pixels.groupBy("image", other).agg(line.alias("_a"), F.min(axis).alias("_first")).withColumn("_n", F.size("_a"))
    at = lambda q: F.aggregate(taps, F.lit(0.0), lambda sum_, t: sum_ + t["w"] * F.get(F.col("_a"), mirrored(q + t["d"], F.col("_n"))))
    out = rows.select("image", other, "_first", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("_n") - 1), at)).alias("_q", value))
    return out.withColumn(axis, F.col("_first") + F.col("_q")).select("image", "y", "x", value)


def blur(pixels: DataFrame, sigma: float, value: str = "v") -> DataFrame:
    """Gaussian blur, along x and then along y; a sigma of 0 or less changes nothing."""
    if sigma <= 0:
        return pixels.select("image", "y", "x", value)
    w = gaussian(sigma)
    return convolve(convolve(pixels, w, "x", value), w, "y", value)


def box_mean(pixels: DataFrame, radius: int, value: str = "m") -> DataFrame:
    """Adds mean: that of the pixels within `radius` rows and columns that the image has."""
    across = Window.partitionBy("image", "y").orderBy("x").rangeBetween(-radius, radius)
    down = Window.partitionBy("image", "x").orderBy("y").rangeBetween(-radius, radius)
    x = pixels.withColumn("_s", F.sum(value).over(across)).withColumn("_n", F.count(value).over(across))
    return x.withColumn("mean", F.sum("_s").over(down) / F.sum("_n").over(down)).drop("_s", "_n")


def thumbnail_size(width: Column, height: Column, target: int) -> tuple[Column, Column]:
    """(width, height) that fit a long edge of `target` with the same shape; smaller images stay."""
    scale = F.least(F.lit(1.0), F.lit(float(target)) / F.greatest(width, height))
    fit = lambda side: F.greatest(F.lit(1), F.bround(side * scale).cast("int"))
    return fit(width), fit(height)


def area_downsample(pixels: DataFrame, width: int, height: int, new_width: int, new_height: int, value: str = "v") -> DataFrame:
    """(image, y, x, value) averaged over the exact area that each new pixel covers."""

    def parts(at: str, old: int, new: int) -> Column:
        # in units of 1 / (old * new) a pixel spans `new`, a new pixel `old`
        first, last = F.floor(F.col(at) * new / old).cast("int"), F.floor(((F.col(at) + 1) * new - 1) / old).cast("int")
        cover = lambda t: F.least((t + 1) * old, (F.col(at) + 1) * new) - F.greatest(t * old, F.col(at) * new)
        return F.transform(F.sequence(first, last), lambda t: F.struct(t.alias("t"), cover(t).alias("w")))

    x = pixels.withColumn("_a", F.explode(parts("x", width, new_width))).withColumn("_b", F.explode(parts("y", height, new_height)))
    weight = F.col("_a.w") * F.col("_b.w")
    return x.groupBy("image", F.col("_b.t").alias("y"), F.col("_a.t").alias("x")).agg((F.sum(weight * F.col(value)) / F.sum(weight)).alias(value))


def strided(pixels: DataFrame, long_edge: int, target: int) -> DataFrame:
    """Every step-th pixel of both axes, renumbered; the step is the least that brings the long edge to the target."""
    step = max(1, -(-long_edge // target))
    return pixels.where((F.col("y") % step == 0) & (F.col("x") % step == 0)).withColumn("y", F.expr(f"y div {step}").cast("int")).withColumn("x", F.expr(f"x div {step}").cast("int"))


def mask_span(start: Column, size: int, scale: Column, limit: Column) -> tuple[Column, Column]:
    """Half-open mask bounds of [start, start + size) at full resolution: rounded outward, one pixel at least, within the mask."""
    lo = F.least(limit - 1, F.floor(start * scale).cast("int"))
    return lo, F.greatest(lo + 1, F.least(limit, F.ceil((start + size) * scale).cast("int")))


# ---------------------------------------------------------------- masks of masks


def fractions(mask: DataFrame, inside: Column | None = None) -> DataFrame:
    """(image, pixels, foreground, fraction) of the mask, or of the part of it inside a region."""
    x = mask if inside is None else mask.where(inside)
    return x.groupBy("image").agg(F.count(F.lit(1)).alias("pixels"), F.sum("m").cast("long").alias("foreground"), F.avg("m").alias("fraction"))


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(image, added, removed): pixels that two masks differ in."""
    x = before.join(after.select("image", "y", "x", F.col("m").alias("k")), ["image", "y", "x"])
    return x.groupBy("image").agg(F.count_if((F.col("m") == 0) & (F.col("k") == 1)).alias("added"), F.count_if((F.col("m") == 1) & (F.col("k") == 0)).alias("removed"))


def dense_rescue(mask: DataFrame, full: DataFrame, radius: int, least: float) -> DataFrame:
    """The mask, and with it foreground of the full mask where the full mask fills its neighbourhood by `least` or more."""
    dense = box_mean(full, radius).select("image", "y", "x", (F.col("m") * (F.col("mean") >= least).cast("int")).alias("m"))
    return replace_within(mask, dense, F.lit(True), both=True)


def edge_band(width: Column, height: Column, fraction: float) -> Column:
    """Whether (x, y) lies in the band along the border that is `fraction` of each side wide, a pixel at least."""
    mx, my = (F.greatest(F.lit(1), F.bround(side * F.lit(fraction)).cast("int")) for side in (width, height))
    return (F.col("x") < mx) | (F.col("x") >= width - mx) | (F.col("y") < my) | (F.col("y") >= height - my)


def edge_cleanup(mask: DataFrame, strict: DataFrame, band: Column) -> DataFrame:
    """In the band only what a stricter mask has as well stays."""
    k = F.coalesce("k", F.lit(0))
    out = mask.join(strict.select("image", "y", "x", F.col("m").alias("k")), ["image", "y", "x"], "left")
    return out.select("image", "y", "x", F.when(band, F.col("m") * k).otherwise(F.col("m")).alias("m"))


def hull_rows(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(y, x) of the pixels whose centres lie in or on the convex hull of the given pixels' centres."""
    points = np.unique(np.stack([x, y], 1), axis=0)
    chains = []
    for run in (points, points[::-1]):
        chain: list[np.ndarray] = []
        for p in run:
            while len(chain) > 1 and (chain[-1][0] - chain[-2][0]) * (p[1] - chain[-2][1]) - (chain[-1][1] - chain[-2][1]) * (p[0] - chain[-2][0]) <= 0:
                chain.pop()
            chain.append(p)
        chains.append(chain)
    corner = np.array(chains[0][:-1] + chains[1][:-1] if len(points) > 1 else chains[0])
    gy, gx = np.mgrid[y.min() : y.max() + 1, x.min() : x.max() + 1]
    inside = np.ones(gy.shape, bool)
    if len(corner) > 1:
        for a, b in zip(corner, np.roll(corner, -1, 0), strict=True):
            inside &= (b[0] - a[0]) * (gy - a[1]) - (b[1] - a[1]) * (gx - a[0]) >= 0
    return gy[inside], gx[inside]


def fill_concavities(mask: DataFrame, fraction: float = 0.01) -> DataFrame:
    """Each component of that part of the image or more is filled to its convex hull; an image's components are one group."""
    labelled = components(mask)
    big = labelled.groupBy("image", "label").agg(F.count(F.lit(1)).alias("area")).join(sizes(mask), "image").where(F.col("area") >= area_limit(fraction)).select("image", "label")

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        y, x = hull_rows(pdf.y.to_numpy(), pdf.x.to_numpy())
        return pd.DataFrame({"image": np.full(len(y), pdf.image.iloc[0]), "y": y, "x": x})

    hull = labelled.join(big, ["image", "label"]).groupBy("image", "label").applyInPandas(kernel, "image long, y int, x int").distinct().withColumn("m", F.lit(1))
    return replace_within(mask.withColumn("image", F.col("image").cast("long")), hull, F.lit(True), both=True)


# ---------------------------------------------------------------- the composed foreground


def segment(scores: DataFrame, profile: dict, edges: bool = False, excluded: Column | None = None, forced: Column | None = None) -> DataFrame:
    """(image, y, x, m) from fused scores (image, y, x, fused): blur, threshold, morphology, component filters, regions.

    profile: threshold_percentile, min_signal, blur_sigma, close_radius, open_radius, dilate_radius,
    min_component_area_fraction and hole_fraction; edges adds the filters for frames and strips at the image's edges.
    """
    smooth = cut(blur(scores.withColumn("fused", F.col("fused").cast("double")), profile["blur_sigma"], "fused"))
    m = cut(foreground(smooth, profile["threshold_percentile"], profile["min_signal"]))
    m = cut(keep_components(m, ~frame())) if edges else m
    m = cut(open_(cut(close(m, profile["close_radius"])), profile["open_radius"]))
    m = cut(keep_components(m, ~strip() & ~sparse_edge())) if edges else m
    m = cut(fill_holes(m, profile["hole_fraction"]))
    m = cut(dilate(m, profile["dilate_radius"])) if profile["dilate_radius"] > 0 else m
    m = cut(keep_components(m, ~small_edge())) if edges else m
    if excluded is not None:
        m = m.withColumn("m", F.when(excluded, 0).otherwise(F.col("m")))
    if forced is not None:
        m = m.withColumn("m", F.when(forced, 1).otherwise(F.col("m")))
    return keep_components(m, F.col("area") >= area_limit(profile["min_component_area_fraction"]))


def within_regions(mask: DataFrame, other: DataFrame, regions: list[tuple[float, float, float, float]], width: Column, height: Column, replace: bool = False) -> DataFrame:
    """A second segmentation joined to the mask, or put in its place, inside normalised regions."""
    inside = F.lit(False)
    for r in regions:
        inside = inside | in_rect(*r, width, height)
    return replace_within(mask, other, inside, both=not replace)


def strict_regions(mask: DataFrame, scores: DataFrame, regions: list[tuple[float, float, float, float]], percentile: float, min_signal: float, width: Column, height: Column) -> DataFrame:
    """Inside regions the mask is what lies above a stricter threshold of the image's scores."""
    return within_regions(mask, foreground(scores, percentile, min_signal), regions, width, height, replace=True)


def local_segmentation(mask: DataFrame, scores: DataFrame, region: tuple[float, float, float, float], percentile: float, min_signal: float, width: Column, height: Column) -> DataFrame:
    """Inside a region the mask is what lies above a threshold of the region's own scores."""
    inside = in_rect(*region, width, height)
    return replace_within(mask, foreground(scores.where(inside), percentile, min_signal), inside)


#: Stages of the composed mask in their order; each takes (mask, context) and returns a mask. Stages without settings are left out.
STAGES = (
    "nucleus_gate", "roi_fusion", "support_recovery", "strict_regions", "concavities", "local_segmentation", "forced_polygons", "excluded_regions", "excluded_polygons",
    "edge_cleanup", "small_edge", "sparse", "thin", "final_polygons",
)


def compose(mask: DataFrame, scores: DataFrame, width: Column, height: Column, steps: dict) -> DataFrame:
    """The mask after the stages that `steps` gives settings for, in the order of STAGES, whatever the order of the settings."""
    unknown = set(steps) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}")

    def polygons(m: DataFrame, shapes: list, value: int) -> DataFrame:
        for points in shapes:
            m = m.withColumn("m", F.when(in_polygon(points, width, height), value).otherwise(F.col("m")))
        return m

    def excluded(m: DataFrame, regions: list) -> DataFrame:
        for r in regions:
            m = m.withColumn("m", F.when(in_rect(*r, width, height), 0).otherwise(F.col("m")))
        return m

    run = {
        "nucleus_gate": lambda m, o: near(m, o["nuclei"], o["radius"]),
        "roi_fusion": lambda m, o: within_regions(m, o["mask"], o["regions"], width, height, o.get("replace", False)),
        "support_recovery": lambda m, o: recover_support(m, o["high"], m, o["radius"]),
        "strict_regions": lambda m, o: strict_regions(m, scores, o["regions"], o["percentile"], o["min_signal"], width, height),
        "concavities": lambda m, o: fill_concavities(m, o["fraction"]),
        "local_segmentation": lambda m, o: local_segmentation(m, scores, o["region"], o["percentile"], o["min_signal"], width, height),
        "forced_polygons": lambda m, o: polygons(m, o, 1),
        "excluded_regions": excluded,
        "excluded_polygons": lambda m, o: polygons(m, o, 0),
        "edge_cleanup": lambda m, o: edge_cleanup(m, o["strict"], edge_band(width, height, o["fraction"])),
        "small_edge": lambda m, o: keep_components(m, ~small_edge(**o)),
        "sparse": lambda m, o: keep_components(m, ~sparse_edge(**o)),
        "thin": lambda m, o: keep_components(m, ~thin(**o)),
        "final_polygons": lambda m, o: polygons(m, o, 1),
    }
    for name in STAGES:
        if name in steps:
            mask = cut(run[name](mask, steps[name]))
    return mask


def otsu(scores: DataFrame) -> DataFrame:
    """(image, threshold): the value from 0 to 255 that parts an image's scores into classes furthest apart."""
    h = scores.groupBy("image", F.col("fused").cast("int").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy("image").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("image")
    x = h.withColumn("w", F.sum("c").over(upto)).withColumn("s", F.sum(F.col("c") * F.col("v")).over(upto)).withColumn("n", F.sum("c").over(whole)).withColumn("t", F.sum(F.col("c") * F.col("v")).over(whole))
    apart = F.when(F.col("w") < F.col("n"), F.col("w") * (F.col("n") - F.col("w")) * F.pow(F.col("s") / F.col("w") - (F.col("t") - F.col("s")) / (F.col("n") - F.col("w")), F.lit(2.0))).otherwise(F.lit(0.0))
    return x.withColumn("apart", apart).groupBy("image").agg(F.max_by("v", F.struct("apart", -F.col("v"))).alias("threshold"))


def route(path: Column, kind: Column) -> Column:
    """The branch that handles an image: ims, ome (OME-TIFF and hyperstacks) or slide (all others)."""
    low = F.lower(path)
    return F.when(low.endswith(".ims") | (kind == "ims"), "ims").when(low.rlike(r"\.ome\.tiff?$") | (kind == "tiff_hyperstack"), "ome").otherwise("slide")
