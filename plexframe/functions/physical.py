"""Physical pixel size: evidence in order, its source, and the magnification it snaps to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Microns of a unit of length, by its spellings in descriptions and in resolution tags.
UNIT_TEXT = {"mm": 1000.0, "millimeter": 1000.0, "millimetre": 1000.0, "um": 1.0, "µm": 1.0, "micron": 1.0, "microns": 1.0, "micrometer": 1.0, "micrometre": 1.0}
UNIT_TAG = {"centimeter": 10000.0, "centimetre": 10000.0, "inch": 25400.0}
NUMBER = r"[-+]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][-+]?\d+)?"
#: Sizes along x and y may differ by this share of the larger.
TOLERANCE = 0.05


def number(text: Column) -> Column:
    """A number, or the first one in a text; null if there is none."""
    plain = F.trim(text)
    return F.coalesce(plain.try_cast("double"), F.nullif(F.regexp_extract(plain, NUMBER, 0), F.lit("")).try_cast("double"))


def agreed(x: Column, y: Column) -> Column:
    """The mean of two sizes that are positive and close; else null."""
    fine = (x > 0) & (y > 0) & (F.abs(x - y) <= TOLERANCE * F.greatest(x, y))
    return F.when(fine, (x + y) / 2)


def from_extents(x_pixels: Column, y_pixels: Column, x_min: Column, x_max: Column, y_min: Column, y_max: Column) -> Column:
    """Extents by pixels; a missing least extent is 0."""
    side = lambda n, lo, hi: F.when(n > 0, (hi - F.coalesce(lo, F.lit(0.0))) / n)
    return agreed(side(x_pixels, x_min, x_max), side(y_pixels, y_min, y_max))


def from_text(text: Column) -> Column:
    """The first positive size that a description names."""
    found = [F.nullif(F.regexp_extract(text, p, 1), F.lit("")).try_cast("double") for p in (r"<PixelSizeMicrons>([0-9.]+)</PixelSizeMicrons>", r'PhysicalSizeX="([0-9.]+)"')]
    return F.coalesce(*(F.when(v > 0, v) for v in found))


def from_resolution(x_per_unit: Column, y_per_unit: Column, text: Column, tag: Column) -> Column:
    """Resolution tags, by the unit in the description or else by that of the tag."""
    named = F.lower(F.trim(F.regexp_extract(text, r"(?i)(?:^|\n)unit=([^\n\r]+)", 1)))
    microns = F.coalesce(*(F.when(named == k, F.lit(v)) for k, v in UNIT_TEXT.items()), *(F.when(F.lower(tag).contains(k), F.lit(v)) for k, v in UNIT_TAG.items()))
    size = lambda per: F.when(per > 0, microns / per)
    return agreed(size(x_per_unit), size(y_per_unit))


def resolve(evidence: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """(mpp, source) of the first evidence that is not null."""
    return F.coalesce(*(v for _, v in evidence)), F.coalesce(*(F.when(v.isNotNull(), F.lit(s)) for s, v in evidence))
