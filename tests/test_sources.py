"""Images that the tests write themselves: directories, tiles, pushed filters, regions, integrity."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plexframe.functions import channels
from plexframe.sources import images, tiff


def planes(n=3, h=40, w=50, kind="u2"):
    rng = np.random.default_rng(1)
    return [rng.integers(0, 200, (h, w)).astype(kind) for _ in range(n)]


@pytest.mark.parametrize(("tile", "compress", "kind"), [(None, False, "u1"), (16, False, "u2"), (16, True, "f4"), (None, True, "u2")])
def test_regions_of_pages(tmp_path, tile, compress, kind):
    path, p = str(tmp_path / "a.tif"), planes(kind=kind)
    tiff.write(path, p, tile, compress, ["one", "<Name> CD3 </Name>", ""], (20000, 1, 3))
    found = tiff.pages(path)
    assert [(int(x.height), int(x.width), x.get("description")) for x in found] == [(40, 50, "one"), (40, 50, "<Name> CD3 </Name>"), (40, 50, None)]
    assert found[0].ratio("x_resolution") == 20000
    for y, x, h, w in ((0, 0, 40, 50), (10, 13, 20, 9), (-5, 30, 20, 100), (38, 48, 10, 10)):
        want = p[1][max(0, y) : y + h, max(0, x) : x + w]
        assert (tiff.region(path, found[1], y, x, h, w) == want).all()
    assert tiff.region(path, found[0], 60, 0, 5, 5).size == 0


def test_lzw_and_predictor():
    codes, bits, out = [256, 65, 66, 258, 260, 257], "", []
    for c in codes:
        bits += format(c, "09b")
    data = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    assert tiff.unpack_lzw(data) == b"ABABABA"
    page = tiff.Page("<", {"width": 4, "height": 1, "bits": 8, "format": 1, "compression": 8, "predictor": 2})
    assert tiff.decode(page, zlib.compress(bytes([5, 1, 1, 255])), 1).ravel().tolist() == [5, 6, 7, 6] and not out
    with pytest.raises(ValueError, match="compression 7"):
        tiff.decode(tiff.Page("<", {"width": 4, "height": 1, "bits": 8, "compression": 7}), b"", 1)


def test_tiles_push_filters_down(spark, tmp_path):
    path, p = str(tmp_path / "a.tif"), planes()
    tiff.write(path, p, 16)
    x = images.tiles(spark, [path])
    assert x.count() == 3 * 3 * 4
    some = x.where("page_index = 1 and tile_row >= 1 and tile_col in (0, 3)")
    assert "PushedFilters" in (plan := some._jdf.queryExecution().executedPlan().toString()) or "plane_tiles" in plan
    assert {(r.page_index, r.tile_row, r.tile_col) for r in some.collect()} == {(1, r, c) for r in (1, 2) for c in (0, 3)}
    reader = images.TileReader([path])
    reader.tests = [("page_index", "==", 1), ("tile_row", ">=", 1)]
    assert [len(t.tiles) for t in reader.partitions()] == [8]
    got = np.zeros((12, 20))
    for r in images.region(spark, path, 10, 15, 12, 20, [2]).collect():
        got[r.y, r.x] = r.v
    assert (got == p[2][10:22, 15:35]).all()


def test_integrity_of_files(spark, tmp_path):
    good, broken, other = (str(tmp_path / f"{n}.qptiff") for n in ("good", "broken", "other"))
    tiff.write(good, planes(2), 16, True)
    tiff.write(broken, planes(3), 16, True, ["<Name>DAPI</Name>", "<Name>CD3</Name>", ""])
    page = tiff.pages(broken)[1]
    with open(broken, "r+b") as f:
        f.seek(page.offsets[0])
        f.write(b"\xff" * 20)
    (tmp_path / "other.qptiff").write_bytes(b"no image")
    df = spark.createDataFrame([(good,), (broken,), (other,)], "path string")
    rows = {(r.path, r.stage, r.channel, r.page_index, r.error_type) for r in images.scan(df).collect()}
    assert rows == {(broken, "qptiff_thumbnail_page_full_decode", "CD3", 1, "error"), (other, "reader_open_or_metadata", None, None, "ValueError")}
    pages = images.pages(df)
    assert pages.where("path like '%good%'").agg(F.countDistinct("height", "width")).first()[0] == 1 and pages.where("error_type is not null").count() == 1
    with pytest.raises(ValueError, match="allow a full read"):
        images.guard_full_read(250_000_001)
    images.guard_full_read(250_000_001, allow=True)


def test_reader_kinds(spark):
    df = spark.createDataFrame([("a.ims", None), ("b.tif", "qptiff"), ("sub\\c.tif", "openslide_rgb")], "path string, reader_type string")
    assert [(r.kind, r.source, r.readable) for r in images.open_images(df, "/data").collect()] == [("ims", "/data/a.ims", False), ("tiff", "/data/b.tif", True), ("openslide", "/data/sub/c.tif", False)]
    with pytest.raises(Exception, match="unsupported reader_type xyz"):
        df.select(channels.reader_kind(F.lit("xyz"), F.col("path"))).collect()
    with pytest.raises(Exception, match="out of range"):
        df.select(channels.z_planes(F.lit(3), F.lit(3), F.lit("max"))).collect()


def test_big_files(tmp_path):
    body = struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16)
    rows = [(256, 4, 1, 3), (257, 4, 1, 2), (258, 3, 1, 8), (273, 16, 1, 200), (279, 16, 1, 6), (278, 4, 1, 2)]
    body += struct.pack("<Q", len(rows)) + b"".join(struct.pack("<HHQQ", *r) for r in sorted(rows)) + struct.pack("<Q", 0)
    path = tmp_path / "big.tif"
    path.write_bytes(body.ljust(200, b"\0") + bytes(range(6)))
    assert tiff.region(str(path), tiff.pages(str(path))[0], 0, 0, 2, 3).tolist() == [[0, 1, 2], [3, 4, 5]]
