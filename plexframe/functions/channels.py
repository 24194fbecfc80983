"""What an image's axes, pages and metadata say of its channels, planes and paths."""

from __future__ import annotations

import xml.etree.ElementTree as ElementTree

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from plexframe.functions.labels import safe_stem

#: File suffixes of images that are recognised.
IMAGE_SUFFIX = r"(?i)\.(ome\.)?tiff?$|\.qptiff$|\.ims$"
#: Kinds of readers by name.
READERS = {"ims": "ims", "tiff": "tiff", "ome-tiff": "tiff", "qptiff": "tiff", "tiff_z_as_channels": "tiff_z_as_channels", "tiff_hyperstack": "tiff_hyperstack", "openslide": "openslide", "openslide_rgb": "openslide"}


# ---------------------------------------------------------------- paths


def is_image(path: Column) -> Column:
    return path.rlike(IMAGE_SUFFIX)


def expand_path(path: Column, root: Column | None = None, home: str = "") -> Column:
    """Slashes for backslashes, home for a leading ~, and below the root if the path is relative."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    p = F.when(p.rlike(r"^~(/|$)"), F.concat(F.lit(home), F.substring(p, 2, 1 << 30))).otherwise(p) if home else p
    if root is None:
        return p
    return F.when(p.startswith("/") | root.isNull(), p).otherwise(F.concat(F.regexp_replace(root, "/+$", ""), F.lit("/"), p))


def artifact_stem(path: Column, output_stem: Column) -> Column:
    """A safe stem of the given output stem, or of the path where that is empty."""
    return safe_stem(F.coalesce(F.nullif(output_stem, F.lit("")), path))


def reader_kind(reader_type: Column, path: Column) -> Column:
    """The reader for an explicit type, else by suffix; an unknown type is an error."""
    low = F.lower(reader_type)
    known = F.coalesce(*(F.when(low == k, F.lit(v)) for k, v in READERS.items()))
    by_suffix = F.when(F.lower(path).endswith(".ims"), "ims").otherwise("tiff")
    return F.when(F.coalesce(low, F.lit("")) == "", by_suffix).otherwise(F.coalesce(known, F.raise_error(F.concat(F.lit("unsupported reader_type "), low)).cast("string")))


def contour_file(stem: Column) -> Column:
    """The names under which a contour image of a stem may stand."""
    return F.array(*(F.concat(stem, F.lit(s)) for s in (".jpg", ".jpeg", ".png")))


# ---------------------------------------------------------------- axes


def extent(axes: Column, shape: Column, axis: str) -> Column:
    """The length of an axis; null if there is none."""
    return F.try_element_at(shape, F.nullif(F.instr(axes, axis), F.lit(0)))


def channel_count(axes: Column, shape: Column, z_as_channels: Column | bool = False) -> Column:
    """The product of all axes but Y, X and Z; of the Z axis if Z stands for channels and is the only other one."""
    dims = F.transform(F.sequence(F.lit(1), F.length(axes)), lambda i: F.struct(F.substring(axes, i, F.lit(1)).alias("a"), F.element_at(shape, i).alias("n")))
    others = F.filter(dims, lambda d: ~d["a"].isin("Y", "X", "Z"))
    product = F.aggregate(others, F.lit(1).cast("long"), lambda p, d: p * d["n"])
    z = z_as_channels if isinstance(z_as_channels, Column) else F.lit(z_as_channels)
    return F.when(z & (axes == "ZYX"), extent(axes, shape, "Z").cast("long")).otherwise(product)


def z_count(axes: Column, shape: Column) -> Column:
    return F.coalesce(extent(axes, shape, "Z"), F.lit(1))


def z_planes(count: Column, index: Column, strategy: Column) -> Column:
    """The planes that are read: the only one, the one asked for, the middle one, or all that are projected."""
    bad_index = F.raise_error(F.format_string("z index %d is out of range", index)).cast("array<int>")
    bad_name = F.raise_error(F.concat(F.lit("unknown z strategy "), F.coalesce(strategy, F.lit("null")))).cast("array<int>")
    return (
        F.when(count <= 1, F.array(F.lit(0)))
        .when(index.isNotNull(), F.when((index >= 0) & (index < count), F.array(index.cast("int"))).otherwise(bad_index))
        .when(strategy == "middle", F.array(F.floor(count / 2).cast("int")))
        .when(strategy.isin("max", "mean"), F.sequence(F.lit(0), count - 1))
        .otherwise(bad_name)
    )


def plane_page(axes: Column, shape: Column, channel: Column, pages: Column, planes: Column, z_as_channels: Column | bool = False) -> Column:
    """The page that holds a channel's plane, or null if it is not one page."""
    z_channels = z_as_channels if isinstance(z_as_channels, Column) else F.lit(z_as_channels)
    z, c = z_count(axes, shape), channel_count(axes, shape, z_channels)
    one, plane = F.size(planes) == 1, F.element_at(planes, 1)
    number = (
        F.when(z_channels & (axes == "ZYX"), channel)
        .when(~axes.contains("Z") & axes.contains("Y") & axes.contains("X"), F.when(pages >= c, channel))
        .when(one & (axes == "CZYX"), channel * z + plane)
        .when(one & (axes == "ZCYX"), plane * c + channel)
    )
    flat = ~axes.contains("Z")
    return F.when(flat | (number < pages), number).cast("int")


# ---------------------------------------------------------------- channel names


def numbered(count: Column, first: Column | int = 1) -> Column:
    """C<first> .. C<count>; none if the count is smaller."""
    first = F.lit(first) if isinstance(first, int) else first
    names = F.transform(F.sequence(first, F.greatest(first, count)), lambda i: F.concat(F.lit("C"), i.cast("string")))
    return F.when(first <= count, names).otherwise(F.array().cast("array<string>"))


def fit_names(names: Column, count: Column) -> Column:
    """Names cut or filled up to the number of channels."""
    return F.concat(F.slice(names, F.lit(1), count.cast("int")), numbered(count.cast("int"), F.size(names) + 1))


def page_name(description: Column) -> Column:
    """The first <Name> of a page's description, or ''."""
    return F.trim(F.coalesce(F.regexp_extract(description, "<Name>([^<]+)</Name>", 1), F.lit("")))


def page_label(description: Column, index: Column) -> Column:
    return F.coalesce(F.nullif(page_name(description), F.lit("")), F.concat(F.lit("page_"), index.cast("string")))


def sidecar_names(content: Column) -> Column:
    """Channel names of a JSON sidecar; anything that can't be read as one gives none."""
    row = F.from_json(content, "hpac_conf struct<channel_imgs: array<struct<name: string>>>")
    names = F.transform(row["hpac_conf"]["channel_imgs"], lambda c: c["name"])
    return F.coalesce(F.filter(names, lambda n: n.isNotNull() & (n != "")), F.array().cast("array<string>"))


def listed_names(content: Column) -> Column:
    """The lines of a names file that say something."""
    lines = F.transform(F.split(content, r"\r\n|\n|\r"), lambda t: F.trim(t))
    return F.coalesce(F.filter(lines, lambda t: t != ""), F.array().cast("array<string>"))


@F.arrow_udf(ArrayType(StringType()))
def ome_names(documents: pa.Array) -> pa.Array:
    """Name, else Fluor, of every Channel in any namespace; a document that isn't XML gives none."""
    out = []
    for text in documents.to_pylist():
        try:
            nodes = ElementTree.fromstring(text).iter() if text else ()
            named = (n.get("Name") or n.get("Fluor") for n in nodes if n.tag.rpartition("}")[2] == "Channel")
            out.append([x for x in named if x])
        except ElementTree.ParseError:
            out.append([])
    return pa.array(out, pa.list_(pa.string()))


def synthetic_names(cycles: Column, channels: Column) -> Column:
    """cycle_<two digits>_channel_<number> in the order of the planes."""
    one = lambda t: F.transform(F.sequence(F.lit(1), channels), lambda c: F.format_string("cycle_%02d_channel_%d", t, c))
    return F.flatten(F.transform(F.sequence(F.lit(1), cycles), one))


def resolve_names(evidence: list[tuple[str, Column]], count: Column) -> tuple[Column, Column]:
    """(names fitted to the count, source) of the first evidence that has a name; else C1, C2, ... from 'default'."""
    some = lambda names: F.size(F.filter(names, lambda n: n != "")) > 0
    filled = lambda names: F.transform(names, lambda n, i: F.coalesce(F.nullif(n, F.lit("")), F.concat(F.lit("C"), (i + 1).cast("string"))))
    names = F.coalesce(*(F.when(some(n), fit_names(filled(n), count)) for _, n in evidence), numbered(count.cast("int")))
    source = F.coalesce(*(F.when(some(n), F.lit(s)) for s, n in evidence), F.lit("default"))
    return names, source


def sample_names(raw: Column, markers: Column, count: Column) -> tuple[Column, Column]:
    """(raw names, marker names) of a sample's channels: missing raw ones are numbered, missing marker ones are the raw ones."""
    raw = fit_names(F.coalesce(raw, F.array().cast("array<string>")), count)
    given = F.coalesce(F.when(F.size(markers) > 0, markers), raw)
    rest = F.filter(raw, lambda _, i: i >= F.size(given))
    return raw, F.slice(F.concat(given, rest), F.lit(1), count.cast("int"))


# ---------------------------------------------------------------- choice of channels

#: What a technical channel's name holds; `control` is left out where channels are sampled before.
TECHNICAL_AF = r"(^|[_\s-])af\d*($|[_\s-])"
TECHNICAL_WORDS = ("autofluorescence", "blank", "control")


def technical(name: Column, control: bool = True) -> Column:
    low = F.lower(name)
    out = low.rlike(TECHNICAL_AF)
    for word in TECHNICAL_WORDS if control else TECHNICAL_WORDS[:-1]:
        out = out | low.contains(word)
    return out


def evenly(count: Column, most: int) -> Column:
    """At most `most` of 0 .. count - 1 at even steps, each once and in order; all if most is 0 or less."""
    every = F.sequence(F.lit(0), count - 1)
    if most <= 0:
        return every
    if most == 1:
        return F.array(F.lit(0))
    steps = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.bround(i * (count - 1) / F.lit(most - 1)).cast("int"))
    return F.when(count <= most, every).otherwise(F.array_sort(F.array_distinct(steps)))


def trailing_number(name: Column) -> Column:
    """The integer at the end of a name; names without one come last."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(name, r"(\d+)$", 1), F.lit("")), F.lit("999999999")).cast("long"), F.lit(10**9))


