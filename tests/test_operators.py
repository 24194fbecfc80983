"""Operators on small hand-checked inputs, and a few queries against DuckDB."""

import numpy as np
import pytest

import __spark_entry__
from plexframe.functions import labels as L
from plexframe.operators import manifest as M
from plexframe.operators import raster as R
from plexframe.operators import training as T
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def mask(spark, rows):
    return spark.createDataFrame([(1, y, x, int(v)) for y, r in enumerate(rows) for x, v in enumerate(r)], "image long, y int, x int, m int")


def picture(df, h, w):
    out = [["0"] * w for _ in range(h)]
    for r in df.where("m = 1").collect():
        out[r.y][r.x] = "1"
    return ["".join(r) for r in out]


def test_labels(spark):
    raw = {"DAPI_04": "DAPI", "empty 3": "blank", "CD20/MS4A1": "CD20", "Dye 570": "Dye 570", None: "", "Panel 3: CD3D": "CD3", "AGR2/016": "AGR2", "cycle_01_channel_2": "unmapped", "HEM": "Nuclei"}
    df = spark.createDataFrame([(k,) for k in raw], "raw string")
    got = {r.raw: r.m for r in L.normalize_labels(df, "raw", "m").collect()}
    assert got == raw


def test_stems(spark):
    df = spark.createDataFrame([("../outside",), ("case/slide with spaces.ome.tiff",), ("x/__.tif",)], "p string")
    assert [r[0] for r in df.select(L.safe_stem(F.col("p"))).collect()] == ["outside", "slide_with_spaces", "sample"]


def test_diagonal_pixels_are_one_component():
    assert len(np.unique(R.label_plane(np.array([[1, 0], [0, 1]])))) == 2


def test_holes(spark):
    ring = ["11111", "10101", "11111"]
    assert picture(R.fill_holes(mask(spark, ring), 0.02), 3, 5) == ["11111"] * 3


def test_morphology_order(spark):
    rows = ["00000", "01100", "01110", "00000"]
    m = mask(spark, rows)
    n = lambda d: d.agg(F.sum("m")).first()[0]
    assert n(R.open_(m, 1)) <= n(m) <= n(R.close(m, 1)) <= n(R.dilate(m, 1))


def test_patch_grid_leaves_rests(spark):
    df = spark.createDataFrame([(1, 10, 4), (2, 3, 3)], "image long, width int, height int")
    got = {(r.image, r.x, r.y) for r in R.patch_grid(df, 4).collect()}
    assert got == {(1, 0, 0), (1, 4, 0), (2, 0, 0)}
    with pytest.raises(ValueError):
        R.patch_grid(df, 4, 4)


def test_manifest_merge_takes_last_update(spark):
    base = spark.createDataFrame([("a", 0, 1), ("b", 1, 1)], "path string, ord int, n int")
    up = spark.createDataFrame([("b", 0, 5), ("b", 1, 6), ("c", 2, 7)], "path string, ord int, n int")
    got = {(r.path, r.new, r.n) for r in M.merge_manifest(base, up, "path", "ord").collect()}
    assert got == {("a", False, 1), ("b", False, 6), ("c", True, 7)}


def test_manifest_round_trip(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('# note\n\n{"path": "a.qptiff", "dataset": "demo", "reader_type": "qptiff", "panel": "P1"}\n{"path": "b", "error": "x"}\n')
    rows = M.read_manifest(spark, str(tmp_path / "m.jsonl")).collect()
    assert [(r.path, r.reader_type, r.extras) for r in rows] == [("a.qptiff", "qptiff", {"panel": "P1"})]


def test_profile_fills_only_what_is_not_given(spark):
    prof = spark.createDataFrame([("s", 70.0, 12.0)], "profile string, threshold_percentile double, min_signal double")
    given = spark.createDataFrame([("s", 55.0, None)], "profile string, threshold_percentile double, min_signal double")
    assert tuple(M.apply_profile(given, prof).first()) == ("s", 55.0, 12.0)


def test_offsets_skip_empty_entries(spark):
    df = spark.createDataFrame([(0, 2), (1, 0), (2, 3)], "ord int, n int")
    assert {(r.ord, r.lo, r.hi) for r in T.offsets(df, "ord", "n").collect()} == {(0, 0, 2), (2, 2, 5)}


@pytest.mark.parametrize("name", ["flagship_patch_coords", "marker_lookup", "manifest_merge", "mask_runs", "polygon_fill", "support_recovery", "region_replace"])
def test_against_duckdb(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = __spark_entry__.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rel = con.sql(__spark_entry__.oracle_sql()[name])
    place = [rel.columns.index(c) for c in cols]
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == sorted((tuple(r[i] for i in place) for r in rel.fetchall()), key=repr)


def test_whole_tables(spark):
    """The queries over all of lineitem, all failing events and all sample numbers, against plain loops."""
    rows = lambda name, *cols: [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*cols).collect()]
    queries = __spark_entry__.queries()
    last = {}
    for order, number, part in rows("lineitem", "l_orderkey", "l_linenumber", "l_partkey"):
        path, ord_ = order + (100000000 if order % 9 == 0 else 0), order * 10 + number
        last.setdefault(path, {})
        last[path][ord_] = max(part, last[path].get(ord_, part))
    base = {k for (k,) in rows("orders", "o_orderkey")}
    want = {(k, k if k in base else min(last[k]), k not in base, last[k][max(last[k])] if k in last else 0) for k in base | set(last)}
    assert {tuple(r) for r in queries["manifest_merge_all"](spark, SF).collect()} == want
    events = rows("events", "user_id", "event_type")
    images, bad = {u % 50 for u, _ in events}, {u % 50 for u, t in events if t == "purchase"}
    assert tuple(queries["integrity_report_all"](spark, SF).first()) == (len(images), len(images - bad), len(bad))
    want = [(key, i) for key, size in sorted(rows("part", "p_partkey", "p_size")) for i in range(size % 4)]
    found = queries["index_to_entry_all"](spark, SF)
    assert sorted(tuple(r) for r in found.collect()) == [(n, *x) for n, x in enumerate(want)]
    assert "NestedLoop" not in found._jdf.queryExecution().toString()


def test_locate_over_long_and_empty_entries(spark):
    ranges = spark.createDataFrame([("a", 0, 200), ("b", 200, 200), ("c", 200, 201), ("d", 201, 300)], "image string, lo long, hi long")
    got = {r.idx: (r.image, r.local) for r in T.locate(spark.range(310).withColumnRenamed("id", "idx"), ranges).collect()}
    assert got == {i: ("a", i) if i < 200 else ("c", 0) if i == 200 else ("d", i - 201) for i in range(300)}
