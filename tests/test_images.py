"""Rasters, manifests, registry, coordinates and samples on small hand-checked cases."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from plexframe.functions import labels
from plexframe.operators import coords, integrity, manifest, raster, training


def mask(spark, *planes):
    rows = [(i, y, x, int(v)) for i, p in enumerate(planes) for y, line in enumerate(p) for x, v in enumerate(line)]
    return spark.createDataFrame(rows, "image long, y int, x int, m int")


def plane(df, h, w, image=0, value="m"):
    out = np.zeros((h, w))
    for r in df.where(F.col("image") == image).collect():
        out[r.y, r.x] = r[value]
    return out


def kept(spark, keep, p):
    return plane(raster.keep_components(mask(spark, p), keep), *p.shape).astype(int)


def test_frames_strips_and_bars(spark):
    p = np.zeros((40, 40), int)
    p[2, 2:36] = p[2:36, 2] = 1  # sparse, spans the image, 2 px from the edge
    p[20:26, 20:26] = 1
    got = kept(spark, ~raster.frame(), p)
    assert got[20:26, 20:26].all() and got.sum() == 36
    moved = np.roll(p, (1, 1), (0, 1))  # 3 px from the edge: stays
    assert (kept(spark, ~raster.frame(), moved) == moved).all()
    p = np.zeros((40, 40), int)
    p[6:12, 5:25] = 1  # flat, at the margin of 6 rows
    p[10:30, 20 + 6 : 20 + 9] = 1
    p[18:24, 2:16] = 1  # flat at the left edge: no strip
    got = kept(spark, ~raster.strip(), p)
    assert not got[6:9, 5:20].any() and got[18:24, 2:16].all()
    p = np.zeros((40, 60), int)
    p[1:3, 50:52] = 1  # 4 pixels near an edge, below round(2400 * .005) = 12
    p[20:22, 30:32] = 1
    got = kept(spark, ~raster.small_edge(), p)
    assert got.sum() == 4 and got[20, 30] and (kept(spark, ~raster.small_edge(0.0), p) == p).all()
    p = np.zeros((40, 40), int)
    p[20, 5:15] = 1  # 1 px thick, 10 long, area 10 of at most round(1600 * .008) = 13
    p[30, 5:20] = 1
    got = kept(spark, ~raster.thin(), p)
    assert not got[20].any() and got[30].sum() == 15
    p = np.zeros((40, 40), int)
    for i in range(20):
        p[i, 3 + i] = 1  # an arc from the edge, density 20 / 400
    p[25:35, 15:25] = 1
    assert kept(spark, ~raster.sparse_edge(), p).sum() == 100


def test_blur_and_means_against_numpy(spark):
    rng = np.random.default_rng(2)
    v = rng.random((9, 7))
    df = spark.createDataFrame([(0, y, x, float(v[y, x])) for y in range(9) for x in range(7)], "image long, y int, x int, v double")
    w = np.array(raster.gaussian(1.2))
    r = len(w) // 2
    pad = np.pad(v, r, "reflect")
    want = sum(w[a] * w[b] * pad[a : a + 9, b : b + 7] for a in range(len(w)) for b in range(len(w)))
    assert np.allclose(plane(raster.blur(df, 1.2), 9, 7, value="v"), want)
    assert np.allclose(plane(raster.blur(df, 0), 9, 7, value="v"), v)
    got = plane(raster.area_downsample(df, 7, 9, 2, 3), 3, 2, value="v")
    big = np.kron(v, np.ones((3, 2)))  # 27 x 14 in blocks of 9 x 7
    assert np.allclose(got, big.reshape(3, 9, 2, 7).mean((1, 3)))


def test_concavities_and_holes(spark):
    p = np.zeros((10, 10), int)
    p[2:8, 2:8] = 1
    p[2:6, 4:6] = 0  # a gap open at the top
    got = plane(raster.fill_concavities(mask(spark, p), 0.01), 10, 10)
    assert got[2:8, 2:8].all() and got.sum() == 36
    q = np.ones((10, 10), int)
    q[4:6, 4:6] = q[0, 0] = 0
    assert plane(raster.fill_holes(mask(spark, q), 0.04), 10, 10).sum() == 99 and plane(raster.fill_holes(mask(spark, q), 0.02), 10, 10).sum() == 95


def test_composed_foreground(spark):
    v = np.zeros((40, 40))
    v[10:30, 10:30] = 200
    v[1, 1:39] = v[1:39, 1] = 180
    df = spark.createDataFrame([(0, y, x, int(v[y, x])) for y in range(40) for x in range(40)], "image long, y int, x int, fused int")
    how = {**manifest.DEFAULT, "threshold_percentile": 10.0, "blur_sigma": 0.0, "close_radius": 1, "open_radius": 0, "dilate_radius": 1, "hole_fraction": 0.02}
    got = plane(raster.segment(df, how, edges=True), 40, 40)
    assert got[10:30, 10:30].all() and not got[:8].any()


def test_manifest_lines(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text('# note\n\n{"path": "b/ü.tif", "mpp": 0.5, "stain": "x", "extras": {"stain": "old", "k": "v"}}\n  \n{"path": "a.ims", "error": null}\n{"path": "c.tif"}\n', encoding="utf-8")
    rows = manifest.read_manifest(spark, str(path)).orderBy("ord").collect()
    assert [(r.path, r.dataset, r.reader_type, r.mpp) for r in rows] == [("b/ü.tif", "", "tiff", 0.5), ("c.tif", "", "tiff", None)]
    assert rows[0].extras == {"stain": "x", "k": "v"}
    out = str(tmp_path / "out")
    manifest.write_manifest(manifest.read_manifest(spark, str(path)), out)
    text = [r.value for r in spark.read.text(out).collect()]
    assert any("ü" in t for t in text) and all(list(json.loads(t)) == sorted(json.loads(t)) for t in text)
    path.write_text('{"path": "a"}\n\n{broken\n')
    with pytest.raises(Exception, match="m.jsonl:3"):
        manifest.read_manifest(spark, str(path)).collect()
    array = tmp_path / "m.json"
    array.write_text('{"images": [{"path": "a"}, {"path": "b"}]}')
    assert [json.loads(r.value)["path"] for r in manifest.read_entries(spark, str(array)).orderBy("ord").collect()] == ["a", "b"]
    assert manifest.single_image(spark, "/data/x/a.tif", "/data").first().path == "x/a.tif"


def test_profiles_and_settings(spark):
    assert [r.profile for r in manifest.profile_flags(spark).collect()] == sorted(manifest.PROFILES) and len(manifest.PROFILES) == 5
    flags = {r.profile: r.flags for r in manifest.profile_flags(spark).collect()}
    assert flags["fluorescence-default"][:4] == ["--sp-threshold-percentile", "50.0", "--sp-min-signal", "8.0"]
    got = manifest.settings("fluorescence-recall", ["--sp-close-radius=7", "--sp-min-signal", "3"], "qptiff")
    assert (got["close_radius"], got["min_signal"], got["threshold_percentile"], got["hole_fraction"], got["edges"]) == (7, 3.0, 35.0, 0.05, True)
    assert manifest.parse_regions(["0.1,0.2,0.5,0.9"]) == [(0.1, 0.2, 0.5, 0.9)]
    for bad in ("0.5,0,0.1,1", "1,2", "a,b,c,d"):
        with pytest.raises(ValueError, match="not a region"):
            manifest.parse_regions([bad])
    with pytest.raises(ValueError, match="unknown profile"):
        manifest.profile("none")


def test_registry(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps({"unknown_marker_id": 0, "markers": [{"id": 0, "name": "Unknown"}, {"id": 2, "name": "CD3", "aliases": ["T3"]}, {"id": 5, "name": "T-3"}], "auto_markers": ["CD 3", "CD45", {"name": "AGR2", "aliases": ["LCA", "CD45"]}, "LCA", "--"]}))
    markers, auto, unknown, blank = labels.read_registry(spark, str(path))
    whole = labels.append_auto(markers, auto)
    assert [(r.marker_id, r.name) for r in whole.orderBy("ord").collect()] == [(0, "Unknown"), (2, "CD3"), (5, "T-3"), (6, "CD45"), (7, "AGR2")] and (unknown, blank) == (0, 1)
    keys = {r.key: r.marker_id for r in labels.registry_keys(whole).collect()}
    assert keys["t3"] == 5 and keys["cd45"] == 7
    df = spark.createDataFrame([("T3",), ("nothing",), (None,), ("C.D.3",)], "raw string")
    got = {r.raw: r.marker_id for r in labels.lookup_markers(df, "raw", labels.registry_keys(whole)).collect()}
    assert got == {"T3": 5, "nothing": 0, None: 0, "C.D.3": 2}
    assert {r.marker_name for r in labels.marker_names(spark.createDataFrame([(5,), (99,)], "marker_id int"), whole).collect()} == {"T-3", "Unknown"}


def test_coordinate_store(spark, tmp_path):
    points = spark.createDataFrame([("a", 5, 1), ("a", 0, 2), ("a", 9, 1)], "image string, x int, y int")
    images = spark.createDataFrame([("a", 224), ("b", 224)], "image string, patch_size int")
    coords.write(points, images, str(tmp_path), 224, 0)
    rows, attrs = coords.read(spark, str(tmp_path), 224, 0)
    assert [(r.coord_index, r.x, r.y) for r in rows.orderBy("coord_index").collect()] == [(0, 5, 1), (1, 9, 1), (2, 0, 2)]
    assert dict(rows.dtypes)["x"] == "bigint"
    assert {(r.image, r.num_patches, r.chunk, r.format) for r in attrs.collect()} == {("a", 3, 3, "sp_trident_coords_v1"), ("b", 0, 1, "sp_trident_coords_v1")}
    named = spark.createDataFrame([("a", ["x"])], "image string, channel_names array<string>")
    once = coords.with_channels(attrs, named)
    assert {r.image: r.channel_names for r in coords.with_channels(once, named).collect()} == {"a": ["x"], "b": None}
    assert len(coords.ATTRIBUTES) == 16


def test_samples(spark):
    e = spark.createDataFrame([(0, "a", 0), (1, "b", 3), (2, "c", 1)], "ord long, image string, n long")
    assert [(r.image, r.lo, r.hi) for r in training.offsets(e, "ord", "n", 2).orderBy("lo").collect()] == [("b", 0, 3), ("c", 3, 4)]
    assert training.length(e, "n").first().n == 4 and training.length(e, None).first().n == 3 and training.length(e, "n", 100).first().n == 100
    draws = training.draw(spark.range(400).toDF("idx"), e.withColumnRenamed("ord", "nth"), 3, 4).collect()
    assert all(r.coord_index == -1 if r.n == 0 else 0 <= r.coord_index < r.n for r in draws) and len({r.nth for r in draws}) == 3
    assert all(len({r.nth for r in draws if r.idx // 4 == k}) == 1 for k in range(100))
    used = training.readable(spark.range(50).toDF("idx"), spark.range(10).toDF("idx"), 50, 1).collect()
    assert all(r.used >= 10 if r.used is not None else True for r in used) and all(r.used == r.idx for r in used if r.idx >= 10)
    rows, masks = training.collator(32, 16, 0.5, 0.2)(spark.createDataFrame([(0, 0, [4, 2], 2), (0, 1, [7], 1)], "batch int, sample int, marker_ids array<int>, c int"))
    assert {r.sample: (r.marker_ids, r.valid_channels) for r in rows.collect()} == {0: ([4, 2], [True, True]), 1: ([7, -1], [True, False])}
    m = masks.collect()
    assert len(m) == 2 * 2 * 4 and not any(r.loss_mask for r in m if r.sample == 1 and r.channel == 1) and all(r.loss_mask == (r.patch_mask or r.channel_mask) for r in m)


def test_report(spark):
    none = (None, None, "E", "m")
    issues = spark.createDataFrame([("a", "s", *none), ("a", "t", *none)], "path string, stage string, channel string, page_index long, error_type string, message string")
    row = integrity.report(issues, spark.createDataFrame([("a",), ("b",)], "path string"))
    assert row.select("total", "passed", "failed", F.size("issues")).first() == (2, 1, 1, 2)
    status = integrity.report_json(row).first()
    assert status.status == 1 and len(json.loads(status.value)["issues"]) == 2
