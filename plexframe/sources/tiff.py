"""TIFF files by their own directory: pages with their tags, and the tiles or strips of a region, each read on its own.

Classic and big files of either byte order, with tiles or strips, uncompressed, deflate or LZW, with or without the
horizontal predictor. What can't be decoded raises; a segment of no bytes stays 0.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

import numpy as np

#: Numbers of the tags that are read, and struct codes and sizes of the field types.
TAGS = {256: "width", 257: "height", 258: "bits", 259: "compression", 270: "description", 273: "offsets", 277: "samples", 278: "rows", 279: "counts", 282: "x_resolution", 283: "y_resolution", 284: "planar", 296: "unit", 317: "predictor", 322: "tile_width", 323: "tile_height", 324: "offsets", 325: "counts", 339: "format"}
TYPES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 6: ("b", 1), 7: ("B", 1), 8: ("h", 2), 9: ("i", 4), 10: ("ii", 8), 11: ("f", 4), 12: ("d", 8), 13: ("I", 4), 16: ("Q", 8), 17: ("q", 8), 18: ("Q", 8)}
UNITS = {2: "inch", 3: "centimeter"}


def opened(path: str):
    """A file to read at places: local paths, file: URLs, and whatever URIs pyarrow's file systems know."""
    if "://" in path and not path.startswith("file://"):
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        return system.open_input_file(inner)
    return open(path.removeprefix("file://").removeprefix("file:"), "rb")


@dataclass
class Page:
    """A page's tags and the byte order of its file."""

    order: str
    tags: dict = field(default_factory=dict)

    def __getattr__(self, name: str):
        try:
            return self.__dict__["tags"][name]
        except KeyError:
            raise AttributeError(name) from None

    def get(self, name: str, default=None):
        return self.tags.get(name, default)

    @property
    def samples_per_pixel(self) -> int:
        return int(self.get("samples", 1))

    @property
    def dtype(self) -> np.dtype:
        bits, kind = self.get("bits", 1), self.get("format", 1)
        bits, kind = (int(x[0] if isinstance(x, tuple) else x) for x in (bits, kind))
        code = {1: "u", 2: "i", 3: "f"}.get(kind)
        if code is None or bits not in (8, 16, 32, 64):
            raise ValueError(f"samples of {bits} bits and format {kind} are not supported")
        return np.dtype(f"{self.order}{code}{bits // 8}")

    @property
    def segment(self) -> tuple[int, int]:
        """(height, width) of a tile, or of a strip."""
        if "tile_width" in self.tags:
            return int(self.tile_height), int(self.tile_width)
        return min(int(self.get("rows", self.height)), int(self.height)), int(self.width)

    def ratio(self, name: str) -> float | None:
        x = self.get(name)
        return x[0] / x[1] if isinstance(x, tuple) and len(x) == 2 and x[1] else None


def _values(file, order: str, kind: int, count: int, raw: bytes, wide: bool):
    code, size = TYPES.get(kind, ("B", 1))
    n = size * count
    if n > len(raw):
        place = struct.unpack(order + ("Q" if wide else "I"), raw)[0]
        file.seek(place)
        raw = file.read(n)
    if code == "s":
        return raw[:n].split(b"\0")[0].decode("utf-8", "replace")
    out = struct.unpack(order + code * count, raw[:n])
    return out[0] if len(out) == 1 else out


def pages(path: str) -> list[Page]:
    """All pages in the order of the file; only directories are read."""
    with opened(path) as file:
        head = file.read(16)
        order = {b"II": "<", b"MM": ">"}.get(head[:2])
        if order is None or struct.unpack(order + "H", head[2:4])[0] not in (42, 43):
            raise ValueError(f"{path}: not a TIFF file")
        wide = struct.unpack(order + "H", head[2:4])[0] == 43
        at = struct.unpack(order + ("Q" if wide else "I"), head[8:16] if wide else head[4:8])[0]
        out, seen = [], set()
        while at and at not in seen:
            seen.add(at)
            file.seek(at)
            n = struct.unpack(order + ("Q" if wide else "H"), file.read(8 if wide else 2))[0]
            size = 20 if wide else 12
            table = file.read(n * size)
            at = struct.unpack(order + ("Q" if wide else "I"), file.read(8 if wide else 4))[0]
            page = Page(order)
            for i in range(n):
                row = table[i * size : (i + 1) * size]
                tag, kind, count = struct.unpack(order + ("HHQ" if wide else "HHI"), row[: 12 if wide else 8])
                if tag in TAGS:
                    page.tags[TAGS[tag]] = _values(file, order, kind, count, row[12:] if wide else row[8:], wide)
            out.append(page)
        return out


def unpack_lzw(data: bytes) -> bytes:
    """Variable-width codes of 9 to 12 bits, most significant bit first; 256 clears the table and 257 ends."""
    out, table, width, bits, have, last = bytearray(), [], 9, 0, 0, b""
    plain = [bytes([i]) for i in range(256)] + [b"", b""]
    for byte in data:
        bits, have = bits << 8 | byte, have + 8
        while have >= width:
            code, have = bits >> have - width & (1 << width) - 1, have - width
            bits &= (1 << have) - 1
            if code == 257:
                return bytes(out)
            if code == 256:
                table, width, last = list(plain), 9, b""
                continue
            if not table:
                raise ValueError("codes begin without a clear code")
            if code < len(table):
                entry = table[code]
            elif code == len(table) and last:
                entry = last + last[:1]
            else:
                raise ValueError("a code is beyond the table")
            if last:
                table.append(last + entry[:1])
            out += entry
            last, width = entry, min(12, max(9, (len(table) + 1).bit_length()))
    return bytes(out)


def decode(page: Page, data: bytes, rows: int) -> np.ndarray:
    """(rows, width, samples) of one segment."""
    how = int(page.get("compression", 1))
    if how in (8, 32946):
        data = zlib.decompress(data)
    elif how == 5:
        data = unpack_lzw(data)
    elif how != 1:
        raise ValueError(f"compression {how} is not supported")
    width = page.segment[1]
    samples = 1 if int(page.get("planar", 1)) == 2 else page.samples_per_pixel
    need = rows * width * samples * page.dtype.itemsize
    if len(data) < need:
        raise ValueError(f"a segment has {len(data)} bytes instead of {need}")
    out = np.frombuffer(data[:need], page.dtype).reshape(rows, width, samples)
    if int(page.get("predictor", 1)) == 2:
        out = np.cumsum(out, axis=1, dtype=page.dtype.newbyteorder("="))
    return out


def region(path: str, page: Page, y: int, x: int, height: int, width: int, sample: int = 0) -> np.ndarray:
    """A region of one sample, cut at the page's borders; only the segments that it meets are read."""
    y0, x0 = max(0, y), max(0, x)
    y1, x1 = min(int(page.height), y + height), min(int(page.width), x + width)
    if y1 <= y0 or x1 <= x0:
        return np.zeros((0, 0), page.dtype.newbyteorder("="))
    out = np.zeros((y1 - y0, x1 - x0), page.dtype.newbyteorder("="))
    th, tw = page.segment
    across, down = -(-int(page.width) // tw), -(-int(page.height) // th)
    planar = int(page.get("planar", 1)) == 2
    offsets, counts = (v if isinstance(v, tuple) else (v,) for v in (page.offsets, page.counts))
    with opened(path) as file:
        for r in range(y0 // th, (y1 - 1) // th + 1):
            for c in range(x0 // tw, (x1 - 1) // tw + 1):
                i = r * across + c + (sample * across * down if planar else 0)
                if i >= len(offsets) or not counts[i]:
                    continue
                file.seek(offsets[i])
                rows = th if "tile_width" in page.tags else min(th, int(page.height) - r * th)
                got = decode(page, file.read(counts[i]), rows)[:, :, 0 if planar else sample]
                a, b = max(y0, r * th), min(y1, r * th + rows)
                p, q = max(x0, c * tw), min(x1, (c + 1) * tw)
                out[a - y0 : b - y0, p - x0 : q - x0] = got[a - r * th : b - r * th, p - c * tw : q - c * tw]
    return out


def write(path: str, planes: list[np.ndarray], tile: int | None = None, compress: bool = False, descriptions: list[str] | None = None, resolution: tuple[int, int, int] | None = None) -> None:
    """Writes grey planes as pages of a classic little-endian file: for fixtures and exports."""
    body, directories = bytearray(b"II*\0\0\0\0\0"), []
    for n, plane in enumerate(planes):
        plane = np.ascontiguousarray(plane, plane.dtype.newbyteorder("<"))
        h, w = plane.shape
        th, tw = (tile, tile) if tile else (min(h, 16), w)
        places, sizes = [], []
        for r in range(0, h, th):
            for c in range(0, w, tw):
                part = plane[r : r + th, c : c + tw]
                if tile:
                    part = np.pad(part, ((0, th - part.shape[0]), (0, tw - part.shape[1])))
                data = part.tobytes()
                data = zlib.compress(data) if compress else data
                places.append(len(body)), sizes.append(len(data))
                body += data + b"\0" * (len(data) % 2)
        kind = {"u": 1, "i": 2, "f": 3}[plane.dtype.kind]
        tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [8 * plane.dtype.itemsize]), (259, 3, [8 if compress else 1]), (262, 3, [1]), (277, 3, [1]), (339, 3, [kind])]
        if descriptions and descriptions[n]:
            tags.append((270, 2, descriptions[n].encode() + b"\0"))
        tags += [(322, 4, [tw]), (323, 4, [th]), (324, 4, places), (325, 4, sizes)] if tile else [(273, 4, places), (278, 4, [th]), (279, 4, sizes)]
        if resolution:
            tags += [(282, 5, [resolution[0], resolution[1]]), (283, 5, [resolution[0], resolution[1]]), (296, 3, [resolution[2]])]
        directories.append(sorted(tags, key=lambda t: t[0]))
    link = 4
    for tags in directories:
        rows = []
        for tag, kind, values in tags:
            data = values if isinstance(values, bytes) else struct.pack(f"<{len(values)}{TYPES[kind][0][0]}", *values)
            count = len(data) // TYPES[kind][1]
            if len(data) > 4:
                place = len(body)
                body += data + b"\0" * (len(data) % 2)
                data = struct.pack("<I", place)
            rows.append(struct.pack("<HHI", tag, kind, count) + data.ljust(4, b"\0"))
        struct.pack_into("<I", body, link, len(body))
        body += struct.pack("<H", len(rows)) + b"".join(rows)
        link = len(body)
        body += b"\0\0\0\0"
    with open(path, "wb") as file:
        file.write(body)
