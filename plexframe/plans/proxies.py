"""The operators as queries over the provided tables, which stand in for images: each vector is an 8 x 8 plane."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plexframe.functions import labels as L
from plexframe.operators import manifest as M
from plexframe.operators import raster as R
from plexframe.operators import training as T


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def planes(spark, sf) -> DataFrame:
    e = table(spark, sf, "embeddings").select(F.col("label").alias("image"), F.row_number().over(Window.partitionBy("label").orderBy("vec_id")).alias("channel"), "embedding")
    return e.select("image", "channel", F.posexplode("embedding").alias("pos", "e")).select("image", "channel", F.expr("pos div 8").cast("int").alias("y"), (F.col("pos") % 8).alias("x"), F.col("e").cast("double").alias("v"))


def fused(spark, sf, how="percentile") -> DataFrame:
    return R.fuse(R.robust_u8(planes(spark, sf), ["image", "channel"]), how)


def masks(spark, sf) -> DataFrame:
    return R.foreground(fused(spark, sf), 55.0, 8.0)


def plane_masks(spark, sf) -> DataFrame:
    """A mask of each vector: image = vec_id, m = value above 0.1."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("image"), F.posexplode("embedding").alias("pos", "e"))
    return e.select("image", F.expr("pos div 8").cast("int").alias("y"), (F.col("pos") % 8).alias("x"), (F.col("e").cast("double") > 0.1).cast("int").alias("m"))


def raw_labels(spark, sf) -> DataFrame:
    """A label for each part that reaches every step of the normalisation."""
    forms = ["'DAPI_0' || n", "'empty ' || n", "'CD20/MS4A1'", "'Panel ' || n || ': CD3D'", "'Cycle ' || n || '_CD8R_AF488'", "'Hoechst ' || n", "n || '_mKi67'", "'AGR2/016'", "'vimentine (clone ' || n || ')'", "'HEM'", "'control-488nm'", "'C' || n", "'AF' || n || 'x'", "'PanCytoKRT_ArgoFluor' || n || 'L'", "'ECAD-FITC'", "'Dye ' || n", "'CD45 - leucocytes'", "'Sample AF'", "'nucleus_' || n", "'cycle_01_channel_' || n"]
    n = "cast(p_size as string)"
    case = "CASE p_partkey % 20 " + " ".join(f"WHEN {i} THEN {f.replace(' n ', f' {n} ').replace('|| n', '|| ' + n)}" if not f.startswith("n ") else f"WHEN {i} THEN {n}{f[1:].replace('|| n', '|| ' + n)}" for i, f in enumerate(forms)) + " END"
    return table(spark, sf, "part").select("p_partkey", F.expr("p_partkey % 50").alias("image"), F.expr(case).alias("raw"))


def registry(spark) -> DataFrame:
    rows = [(0, "Unknown", ["unmapped"], 0), (1, "Blank", ["blank", "Sample AF"], 1), (2, "Nuclear stain", ["DAPI", "Hoechst", "Nuclei"], 2), (3, "CD20", [], 3), (4, "Vimentin", [], 4), (5, "CD3", [], 5), (6, "CD8", [], 6), (7, "Ki67", [], 7), (8, "E-Cadherin", [], 8)]
    return spark.createDataFrame(rows, "marker_id int, name string, aliases array<string>, ord int")


def looked_up(spark, sf) -> DataFrame:
    return L.lookup_markers(raw_labels(spark, sf), "raw", L.registry_keys(registry(spark)))


def with_stats(name, arg=None):
    return lambda spark, sf: R.component_stats(plane_masks(spark, sf)).where(R.FILTERS[name](arg) if arg is not None else R.FILTERS[name]()).select("image", "label", "area")


def counted(df: DataFrame) -> DataFrame:
    return df.groupBy("image").agg(F.sum("m").cast("long").alias("n"), F.count(F.lit(1)).alias("pixels"))


def page_rows(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(F.expr("user_id % 50").alias("image"), F.expr("256 * (1 + event_id % 5)").alias("height"), F.expr("256 * (1 + event_id % 3)").alias("width"), "event_id", "event_type")


def slides(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("image"), F.expr("cast(100 + p_size * 7 as int)").alias("width"), F.expr("cast(80 + p_size * 5 as int)").alias("height"), F.expr("0.1 + p_size * 0.01").alias("mpp"), F.expr("p_size % 4").alias("n"))


def images_of(spark, sf) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.concat("url", F.expr("CASE page_id % 4 WHEN 0 THEN '.ome.tif' WHEN 1 THEN '.ims' WHEN 2 THEN ' A.QPTIFF' ELSE '_ROI01.tiff' END")).alias("path"))


def manifest_merge(spark, sf, which="l_linenumber <= 2 and l_orderkey % 3 = 0"):
    """Updates are a part of lineitem, as its SQL has it; manifest_merge_all takes the whole table."""
    base = table(spark, sf, "orders").select(F.col("o_orderkey").alias("path"), F.col("o_orderkey").alias("ord"), F.lit(0).cast("long").alias("n"))
    up = table(spark, sf, "lineitem").where(which).select((F.col("l_orderkey") + F.expr("CASE WHEN l_orderkey % 9 = 0 THEN 100000000 ELSE 0 END")).alias("path"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.col("l_partkey").alias("n"))
    up = up.groupBy("path", "ord").agg(F.max("n").alias("n"))
    return M.merge_manifest(base, up, "path", "ord").select("path", "ord", "new", "n")


def profile_overlay(spark, sf):
    prof = M.profile_table(spark)
    given = table(spark, sf, "part").select("p_partkey", F.expr("CASE p_partkey % 3 WHEN 0 THEN 'fluorescence-artifact-strict' WHEN 1 THEN 'fluorescence-recall' ELSE 'none' END").alias("profile"), F.expr("CASE WHEN p_size > 25 THEN 55.0D END").alias("threshold_percentile"), F.expr("CAST(NULL AS DOUBLE)").alias("min_signal"))
    return M.apply_profile(given, prof.select("profile", "threshold_percentile", "min_signal"))


def integrity_report(spark, sf, which="event_id % 40 = 0"):
    """Issues are a part of the purchases, as its SQL has it; integrity_report_all takes all."""
    p = page_rows(spark, sf)
    return M.integrity(p.where("event_type = 'purchase'").where(which), p.select("image").distinct())


def sample_entries(spark, sf):
    r = T.offsets(slides(spark, sf), "image", "n").select("image", "lo", "hi")
    return T.locate(slides(spark, sf).select((F.col("image") * 3 % 500).alias("idx")).distinct(), r).select("idx", "image", "local")


def all_entries(spark, sf):
    """Every global sample number of the table."""
    r = T.offsets(slides(spark, sf), "image", "n").select("image", "lo", "hi")
    return T.locate(spark.range(r.agg(F.max("hi")).first()[0] or 0).select(F.col("id").alias("idx")), r).select("idx", "image", "local")


def z_projection(spark, sf):
    p = planes(spark, sf).withColumn("z", F.col("channel") % 3)
    return p.groupBy("image", "z", "y", "x").agg(F.max("v").alias("v_max"), F.round(F.avg("v"), 9).alias("v_mean"))


def exclude_force(spark, sf):
    inside = lambda *r: R.in_rect(*r, F.lit(8), F.lit(8))
    return masks(spark, sf).withColumn("m", F.when(inside(0.5, 0.0, 1.0, 0.3125), 1).when(inside(0.0, 0.0, 0.4375, 0.5), 0).otherwise(F.col("m")))


def mask_set_ops(spark, sf):
    a, b = masks(spark, sf), R.foreground(fused(spark, sf, "max"), 70.0)
    j = a.join(b.withColumnRenamed("m", "k"), ["image", "y", "x"])
    return j.groupBy("image").agg(F.sum(F.greatest("m", "k")).alias("either"), F.sum(F.col("m") * F.col("k")).alias("both"), F.sum(F.col("m") * (1 - F.col("k"))).alias("only_a"))


#: Corners of the test polygon, clockwise with a notch.
POLYGON = [(0.125, 0.125), (0.875, 0.25), (0.5, 0.5), (0.75, 0.875), (0.25, 0.75)]


def polygon_fill(spark, sf):
    inside = R.in_polygon(POLYGON, F.lit(8), F.lit(8))
    return masks(spark, sf).withColumn("m", F.when(inside, 1).otherwise(F.col("m")))


def support_recovery(spark, sf):
    a, b = masks(spark, sf), R.foreground(fused(spark, sf, "max"), 70.0)
    return R.recover_support(a, b, a, 1)


def region_replace(spark, sf):
    a, b = masks(spark, sf), R.foreground(fused(spark, sf, "max"), 70.0)
    return R.replace_within(a, b, R.in_rect(0.25, 0.125, 0.75, 1.0, F.lit(8), F.lit(8)))


def token_masks(spark, sf):
    h = T.hash_int(F.lit("7"), F.col("image").cast("string"), F.col("token").cast("string"))
    t = slides(spark, sf).withColumn("token", F.explode(F.sequence(F.lit(0), F.lit(3))))
    return t.select("image", "token", (h < F.lit(int(0.5 * (1 << 28)))).alias("masked"))


def channel_pad(spark, sf):
    x = looked_up(spark, sf).groupBy("image").agg(F.sort_array(F.collect_list("marker_id")).alias("ids"))
    return x.select("image", F.array_join(T.pad(F.col("ids"), 12, -1), ",").alias("padded"), F.least(F.size("ids"), F.lit(12)).cast("long").alias("valid"))


stem = lambda spark, sf: images_of(spark, sf).select("page_id", L.safe_stem(F.col("path")).alias("stem"))

QUERIES = {
    "flagship_patch_coords": lambda s, d: R.patch_coords(masks(s, d), 4, 2, 0.1),
    "plane_robust_u8": lambda s, d: R.robust_u8(planes(s, d), ["image", "channel"]).select("image", "channel", "y", "x", "u8"),
    **{f"fuse_{h}": (lambda h: lambda s, d: fused(s, d, h).select("image", "y", "x", "fused"))(h) for h in ("max", "median", "percentile")},
    "foreground_threshold": lambda s, d: R.threshold(fused(s, d), 55.0, 8.0),
    "foreground_mask": masks,
    "integral_image": lambda s, d: R.integral(masks(s, d)),
    "patch_grid": lambda s, d: R.patch_grid(slides(s, d), 64, 16).select("image", "x", "y"),
    "mask_runs": lambda s, d: R.runs(plane_masks(s, d)),
    "dilate_disc": lambda s, d: counted(R.dilate(plane_masks(s, d), 2)),
    "erode_disc": lambda s, d: counted(R.erode(plane_masks(s, d), 1)),
    "close_open": lambda s, d: counted(R.open_(R.close(plane_masks(s, d), 1), 1)),
    "component_stats": lambda s, d: R.component_stats(plane_masks(s, d)).select("image", "label", "x0", "y0", "w", "h", "area"),
    "min_area_filter": with_stats("min_area", 0.05), "frame_filter": with_stats("frame"), "strip_filter": with_stats("strip"),
    "small_edge_filter": with_stats("small_edge", 0.05), "sparse_filter": with_stats("sparse"), "thin_filter": with_stats("thin"),
    "bounded_hole_fill": lambda s, d: counted(R.fill_holes(plane_masks(s, d), 0.02)),
    "exclude_force_rect": exclude_force, "polygon_fill": polygon_fill, "support_recovery": support_recovery, "region_replace": region_replace, "mask_set_ops": mask_set_ops, "z_projection": z_projection,
    "marker_normalize": lambda s, d: L.normalize_labels(raw_labels(s, d), "raw", "marker").select("p_partkey", "marker"),
    "marker_lookup": lambda s, d: looked_up(s, d).select("p_partkey", "marker_id"),
    "marker_counts": lambda s, d: looked_up(s, d).groupBy("marker_id").agg(F.count(F.lit(1)).alias("n")),
    "technical_channels": lambda s, d: T.drop_guarded(raw_labels(s, d), "image", ~F.lower("raw").rlike(L.TECHNICAL)).select("p_partkey"),
    "nucleus_channels": lambda s, d: raw_labels(s, d).where(F.lower("raw").rlike(L.NUCLEUS)).select("p_partkey"),
    "artifact_stem": stem, "reader_type": lambda s, d: images_of(s, d).select("page_id", L.reader_type(F.col("path")).alias("kind")),
    "name_filters": lambda s, d: M.name_filters(images_of(s, d), "path", exclude="A\\.QPTIFF$", skip_roi=True).select("page_id"),
    "duplicate_stems": lambda s, d: stem(s, d).groupBy("stem").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
    "qc_semi": lambda s, d: table(s, d, "customer").join(table(s, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey"),
    "qc_anti": lambda s, d: table(s, d, "customer").join(table(s, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey"),
    "manifest_merge": manifest_merge, "profile_overlay": profile_overlay, "integrity_report": integrity_report,
    # these and index_to_entry take parts of the tables, as their SQL does; these take all
    "manifest_merge_all": lambda s, d: manifest_merge(s, d, "true"), "integrity_report_all": lambda s, d: integrity_report(s, d, "true"), "index_to_entry_all": all_entries,
    "page_groups": lambda s, d: M.page_groups(page_rows(s, d), F.count_if(F.col("event_id") >= 0)),
    "level_choice": lambda s, d: M.choose_level(page_rows(s, d).select("image", "height", "width").distinct(), 700),
    "mag_mpp": lambda s, d: slides(s, d).select("image", M.magnification(F.col("mpp"))[0].alias("mag"), F.round(M.magnification(F.col("mpp"))[1], 9).alias("mpp")),
    "channel_order": lambda s, d: T.order_channels(looked_up(s, d).withColumnRenamed("p_partkey", "channel"), "image").select("image", "channel", "rank"),
    "top_channels": lambda s, d: T.order_channels(looked_up(s, d).withColumnRenamed("p_partkey", "channel"), "image").where("rank <= 3").select("image", "channel"),
    "coord_offsets": lambda s, d: T.offsets(slides(s, d), "image", "n").select("image", "lo", "hi"),
    "index_to_entry": sample_entries, "token_masks": token_masks, "collate_pad": channel_pad,
    **{f"patch_normalize_{m}": (lambda m: lambda s, d: T.normalize_plane(planes(s, d), ["image", "channel"], m).select("image", "channel", "y", "x", F.round("norm", 6).alias("norm")))(m) for m in ("uint", "percentile", "log_percentile")},
}
