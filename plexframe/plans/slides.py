"""More operators as queries over the provided tables, each beside SQL that gives the same rows.

The tables stand in for manifests, pages and samples: a part is an image or an entry of a training manifest, an event
a page. Values that the tables lack are made from their numbers, the same way in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexframe.functions import channels as C
from plexframe.functions import labels as L
from plexframe.functions import physical as P
from plexframe.operators import coords as S
from plexframe.operators import integrity as I
from plexframe.operators import manifest as M
from plexframe.operators import raster as R
from plexframe.operators import training as T
from plexframe.plans import oracle as O
from plexframe.plans import proxies as Q

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) under its own name, with its SQL."""

    def register(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLE_SQL[run.__name__] = sql
        return run

    return register


def part(spark, sf) -> DataFrame:
    return Q.table(spark, sf, "part")


# ---------------------------------------------------------------- axes, planes, names

#: Axes and shapes by part: every layout, with 1 to 5 channels, 1 to 4 planes and 1 to 3 cycles.
_AXES = {0: ("YX", "100+p_size, 80+p_size"), 1: ("CYX", "1+p_size%5, 100, 80"), 2: ("ZYX", "1+p_size%4, 100, 80"), 3: ("CZYX", "1+p_size%5, 1+p_size%4, 100, 80"), 4: ("ZCYX", "1+p_size%4, 1+p_size%5, 100, 80"), 5: ("TCYX", "1+p_size%3, 1+p_size%5, 100, 80"), 6: ("YXS", "100, 80, 3")}
_CASE = "CASE p_partkey % 7 " + " ".join(f"WHEN {k} THEN '{a}'" for k, (a, _) in _AXES.items()) + " END"


def layouts(spark, sf) -> DataFrame:
    shape = "CASE p_partkey % 7 " + " ".join(f"WHEN {k} THEN array({s})" for k, (_, s) in _AXES.items()) + " END"
    return part(spark, sf).select("p_partkey", F.expr(_CASE).alias("axes"), F.expr(shape).alias("shape"), F.expr("p_partkey % 14 = 2").alias("zc"), "p_size")


_LAYOUT = f"ly AS (SELECT p_partkey, {_CASE} AS axes, CASE p_partkey % 7 " + " ".join(f"WHEN {k} THEN [{s}]" for k, (_, s) in _AXES.items()) + " END AS shape, p_partkey % 14 = 2 AS zc, p_size FROM part)"
_DIMS = "dm AS (SELECT p_partkey, axes, shape, zc, p_size, CASE WHEN strpos(axes,'Z')>0 THEN shape[strpos(axes,'Z')] ELSE 1 END AS z, CASE WHEN zc AND axes='ZYX' THEN shape[1] ELSE CAST(list_product(list_transform(list_filter(generate_series(1,len(axes)), lambda i: substr(axes, i, 1) NOT IN ('Y','X','Z')), lambda i: shape[i])) AS BIGINT) END AS c0 FROM ly), dn AS (SELECT *, coalesce(c0, 1) AS c FROM dm)"


@query(f"WITH {_LAYOUT}, {_DIMS} SELECT p_partkey, shape[strpos(axes,'Y')] AS height, shape[strpos(axes,'X')] AS width, z, c AS channels FROM dn")
def channel_layout(spark, sf):
    axes, shape = F.col("axes"), F.col("shape")
    return layouts(spark, sf).select("p_partkey", C.extent(axes, shape, "Y").alias("height"), C.extent(axes, shape, "X").alias("width"), C.z_count(axes, shape).alias("z"), C.channel_count(axes, shape, F.col("zc")).alias("channels"))


_PLANES = "pl AS (SELECT *, CASE WHEN z <= 1 THEN [0] WHEN p_size % 3 = 0 THEN [CAST(p_size % z AS INT)] WHEN p_size % 3 = 1 THEN [CAST(z // 2 AS INT)] ELSE list_transform(generate_series(0, z-1), lambda i: CAST(i AS INT)) END AS planes, c * z AS pages FROM dn)"


def planes_of(spark, sf) -> DataFrame:
    axes, shape = F.col("axes"), F.col("shape")
    x = layouts(spark, sf).withColumn("z", C.z_count(axes, shape)).withColumn("c", C.channel_count(axes, shape, F.col("zc")))
    index = F.when(F.col("p_size") % 3 == 0, F.col("p_size") % F.col("z"))
    return x.withColumn("planes", C.z_planes(F.col("z"), index, F.when(F.col("p_size") % 3 == 1, "middle").otherwise("max"))).withColumn("pages", F.col("c") * F.when(F.col("zc") & (F.col("axes") == "ZYX"), 1).otherwise(F.col("z")))


@query(f"WITH {_LAYOUT}, {_DIMS}, {_PLANES} SELECT p_partkey, unnest(planes) AS plane FROM pl")
def z_selection(spark, sf):
    return planes_of(spark, sf).select("p_partkey", F.explode("planes").alias("plane"))


@query(
    f"""WITH {_LAYOUT}, {_DIMS}, {_PLANES}, ch AS (SELECT *, unnest(generate_series(0, CAST(c AS BIGINT)-1)) AS channel FROM pl)
 SELECT p_partkey, channel, CAST(CASE WHEN zc AND axes='ZYX' THEN channel WHEN strpos(axes,'Z')=0 THEN channel WHEN len(planes)=1 AND axes='CZYX' THEN channel*z+planes[1] WHEN len(planes)=1 AND axes='ZCYX' THEN planes[1]*c+channel END AS INT) AS page FROM ch"""
)
def plane_pages(spark, sf):
    x = planes_of(spark, sf).withColumn("channel", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)))
    return x.select("p_partkey", "channel", C.plane_page(F.col("axes"), F.col("shape"), F.col("channel"), F.col("pages"), F.col("planes"), F.col("zc")).alias("page"))


@query(
    """WITH e AS (SELECT p_partkey, 1+p_size%4 AS n, p_partkey%6 AS k, p_size AS s FROM part), w AS (SELECT p_partkey, n,
 CASE WHEN k=0 THEN list_transform(generate_series(1,s%6), lambda i: 'A'||i) WHEN k=1 AND s%2=0 THEN ['Side'||s, 'Other'] WHEN k=2 THEN ['Ome'||s, 'Flu'] WHEN k=3 THEN ['Pk'||s, ''] WHEN k=4 THEN ['RGB_R','RGB_G','RGB_B'] ELSE [] END AS raw,
 CASE WHEN k=0 AND s%6>0 THEN 'file' WHEN k=1 AND s%2=0 THEN 'sidecar' WHEN k=2 THEN 'ome' WHEN k=3 THEN 'pages' WHEN k=4 THEN 'rgb' ELSE 'default' END AS source FROM e)
 SELECT p_partkey, source, array_to_string(list_transform(generate_series(1,n), lambda i: CASE WHEN i<=len(raw) AND raw[i]<>'' THEN raw[i] ELSE 'C'||i END), '|') AS names FROM w"""
)
def channel_names(spark, sf):
    """The chain of evidence for channel names: a names file, a sidecar, OME XML, page descriptions, RGB samples, numbers."""
    s, k = F.col("p_size").cast("string"), F.col("p_partkey") % 6
    lines = F.when(F.col("p_size") % 6 > 0, F.concat_ws("\n", F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("p_size") % 6)), lambda i: F.concat(F.lit(" A"), i.cast("string"))))).otherwise("\n \n")
    sidecar = F.when(F.col("p_size") % 2 == 0, F.format_string('{"hpac_conf": {"channel_imgs": [{"name": "Side%s"}, {"name": ""}, {"name": "Other"}]}}', s)).otherwise("{broken")
    ome = F.format_string('<o:OME xmlns:o="u"><o:Image><o:Channel Name="Ome%s" Fluor="no"/><o:Channel Name="" Fluor="Flu"/><o:Channel/></o:Image></o:OME>', s)
    x = part(spark, sf).select("p_partkey", (1 + F.col("p_size") % 4).alias("n"), F.when(k == 0, lines).alias("file"), F.when(k == 1, sidecar).alias("side"), C.ome_names(F.when(k == 2, ome).when(k == 5, "<not closed")).alias("ome"), F.when(k == 3, F.array(F.format_string("<a><Name> Pk%s </Name><Name>x</Name></a>", s), F.lit("none"))).alias("pages"), (k == 4).alias("rgb"))
    empty = F.array().cast("array<string>")
    page_names = F.coalesce(F.transform("pages", C.page_name), empty)
    rgb = F.when(F.col("rgb"), F.array(*map(F.lit, ("RGB_R", "RGB_G", "RGB_B")))).otherwise(empty)
    names, source = C.resolve_names([("file", C.listed_names(F.col("file"))), ("sidecar", C.sidecar_names(F.col("side"))), ("ome", F.col("ome")), ("pages", page_names), ("rgb", rgb)], F.col("n"))
    return x.select("p_partkey", source.alias("source"), F.array_join(names, "|").alias("names"))


@query("SELECT p_partkey, array_to_string([format('cycle_{:02d}_channel_{}', t, c) FOR t IN [1]] , '|') AS names FROM part, (SELECT 1 AS c) WHERE false")
def synthetic_names(spark, sf):
    return part(spark, sf).select("p_partkey", F.array_join(C.synthetic_names(1 + F.col("p_size") % 12, 1 + F.col("p_partkey") % 3), "|").alias("names"))


ORACLE_SQL["synthetic_names"] = """SELECT p_partkey, string_agg('cycle_' || lpad(CAST(t AS VARCHAR), 2, '0') || '_channel_' || c, '|' ORDER BY t, c) AS names
 FROM (SELECT p_partkey, p_size, unnest(generate_series(1, 1+p_size%12)) AS t FROM part) a, LATERAL (SELECT unnest(generate_series(1, 1+a.p_partkey%3)) AS c) b GROUP BY p_partkey"""


@query(
    """SELECT p_partkey, CASE WHEN p_partkey%3=0 THEN '/abs/'||p_size||'.tif' ELSE '/data/root/sub/'||p_size||'.ims' END AS path, p_partkey%4<>3 AS image,
 CASE WHEN p_partkey%5=0 THEN 'a_b_'||p_size ELSE 'x_'||p_size END AS stem FROM part"""
)
def paths(spark, sf):
    s = F.col("p_size").cast("string")
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("\\abs\\"), s, F.lit(".tif"))).otherwise(F.concat(F.lit("sub\\"), s, F.lit(".ims")))
    name = F.element_at(F.array(*map(F.lit, ("a.TIF", "b.ome.tiff", "c.qptiff", "d.png"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    given = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("../a b:"), s)).when(F.col("p_partkey") % 5 == 1, F.lit(""))
    return part(spark, sf).select("p_partkey", C.expand_path(raw, F.lit("/data/root/")).alias("path"), C.is_image(name).alias("image"), F.regexp_replace(C.artifact_stem(F.concat(F.lit("y/x "), s, F.lit(".tif")), given), "^_", "").alias("stem"))


@query(
    """SELECT p_partkey, CASE p_partkey%5 WHEN 0 THEN 'tiff' WHEN 1 THEN 'ims' WHEN 2 THEN 'tiff' WHEN 3 THEN 'openslide' ELSE 'tiff_hyperstack' END AS kind FROM part"""
)
def reader_kinds(spark, sf):
    kind = F.element_at(F.array(F.lit(None).cast("string"), F.lit(""), F.lit("OME-TIFF"), F.lit("openslide_rgb"), F.lit("tiff_hyperstack")), (F.col("p_partkey") % 5 + 1).cast("int"))
    return part(spark, sf).select("p_partkey", C.reader_kind(kind, F.when(F.col("p_partkey") % 5 == 1, "x.IMS").otherwise("x.tif")).alias("kind"))


# ---------------------------------------------------------------- physical size


@query(
    """WITH v AS (SELECT p_partkey, p_partkey%6 AS k, 0.25+p_size*CAST(0.01 AS DOUBLE) AS m, p_size AS s FROM part), r AS (SELECT p_partkey, k, m, s,
 CASE WHEN k=0 THEN CASE WHEN s%10=0 THEN NULL ELSE (m*1000)/1000 END WHEN k=1 THEN m WHEN k=2 THEN m WHEN k=3 THEN 1000.0/(1000.0/m) WHEN k=4 THEN 25400.0/(25400.0/m) END AS mpp FROM v)
 SELECT p_partkey, round(mpp, 9) AS mpp, CASE WHEN mpp IS NULL THEN NULL WHEN k=0 THEN 'extents' WHEN k=1 THEN 'properties' WHEN k=2 THEN 'text' ELSE 'resolution' END AS mpp_source FROM r"""
)
def mpp_cascade(spark, sf):
    k, m = F.col("p_partkey") % 6, F.lit(0.25) + F.col("p_size") * F.lit(0.01)
    x = part(spark, sf).select("p_partkey", k.alias("k"), m.alias("m"), "p_size")
    extents = P.from_extents(F.when(k == 0, F.lit(1000.0)), P.number(F.lit("about 1000 px")), F.lit(None).cast("double"), m * 1000, F.lit(0.0), m * 1000 * F.when(F.col("p_size") % 10 == 0, 1.2).otherwise(1.0))
    text = F.when(k == 2, F.format_string('<Pixels PhysicalSizeX="%s"/>', m.cast("string"))).when(k == 3, F.lit("ImageJ\nUnit= mm\nx"))
    unit = F.when(k == 3, F.lit(1000.0)).when(k == 4, F.lit(25400.0))
    resolution = P.from_resolution(unit / m, unit / m, F.coalesce(text, F.lit("")), F.when(k == 4, "RESUNIT.INCH").otherwise("NONE"))
    mpp, source = P.resolve([("extents", extents), ("properties", F.when(k == 1, m)), ("text", P.from_text(text)), ("resolution", resolution)])
    return x.select("p_partkey", F.round(mpp, 9).alias("mpp"), source.alias("mpp_source"))


# ---------------------------------------------------------------- channels

_TECH = "regexp_matches(lower(raw), '(^|[_\\s-])af\\d*($|[_\\s-])') OR contains(lower(raw),'autofluorescence') OR contains(lower(raw),'blank')"


@query(f"WITH {O._RAW} SELECT p_partkey, {_TECH} OR contains(lower(raw),'control') AS technical, {_TECH} AS before_sampling FROM raw")
def technical_predicates(spark, sf):
    return Q.raw_labels(spark, sf).select("p_partkey", C.technical(F.col("raw")).alias("technical"), C.technical(F.col("raw"), control=False).alias("before_sampling"))


@query("""SELECT DISTINCT p_partkey, CAST(CASE WHEN p_size <= 7 THEN i ELSE round_even(i*(p_size-1)/6.0, 0) END AS INT) AS channel FROM part, (SELECT unnest(generate_series(0,60)) AS i) g WHERE i < CASE WHEN p_size <= 7 THEN p_size ELSE 7 END""")
def even_channels(spark, sf):
    return part(spark, sf).select("p_partkey", F.explode(C.evenly(F.col("p_size"), 7)).alias("channel"))


@query("""SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_partkey%50 ORDER BY CASE WHEN p_partkey%3=0 THEN 1000000000 ELSE p_size END, p_partkey) AS INT) AS place FROM part""")
def numbered_channels(spark, sf):
    name = F.when(F.col("p_partkey") % 3 == 0, "Other").otherwise(F.concat(F.lit("Channel "), F.col("p_size").cast("string")))
    x = part(spark, sf).select("p_partkey", C.trailing_number(name).alias("t"))
    return x.select("p_partkey", F.row_number().over(Window.partitionBy(F.col("p_partkey") % 50).orderBy("t", "p_partkey")).alias("place"))


def automatic(spark) -> DataFrame:
    rows = [(0, "AGR2", ["AGR-2"]), (1, "CD20", []), (2, "Sample AF", []), (3, "agr 2", []), (4, "CD45", ["LCA"]), (5, "LCA", []), (6, "---", ["zz"])]
    return spark.createDataFrame(rows, "ord int, name string, aliases array<string>")


@query("SELECT * FROM (VALUES (0,'Unknown'),(1,'Blank'),(2,'Nuclear stain'),(3,'CD20'),(4,'Vimentin'),(5,'CD3'),(6,'CD8'),(7,'Ki67'),(8,'E-Cadherin'),(9,'AGR2'),(10,'CD45')) t(marker_id, name)")
def registry_ids(spark, sf):
    return L.append_auto(Q.registry(spark), automatic(spark)).select("marker_id", "name")


@query(O._L + ", nm(id, name) AS (VALUES (0,'Unknown'),(1,'Blank'),(2,'Nuclear stain'),(3,'CD20'),(4,'Vimentin'),(5,'CD3'),(6,'CD8'),(7,'Ki67'),(8,'E-Cadherin')) SELECT p_partkey, coalesce(name, 'Unknown') AS marker_name FROM (SELECT p_partkey, marker_id + 7*(p_partkey%2) AS id FROM lk) x LEFT JOIN nm ON nm.id = x.id")
def marker_names(spark, sf):
    x = Q.looked_up(spark, sf).withColumn("marker_id", F.col("marker_id") + 7 * (F.col("p_partkey") % 2))
    return L.marker_names(x, Q.registry(spark)).select("p_partkey", "marker_name")


@query("SELECT p_partkey, CASE p_partkey%4 WHEN 0 THEN 3 WHEN 1 THEN 5 WHEN 2 THEN 0 ELSE 7 END AS marker_id FROM part")
def second_chance(spark, sf):
    """Labels that match at once, only without their signs, never, and by an alias."""
    raw = F.element_at(F.array(*map(F.lit, ("CD20/MS4A1 (x)", "C.D.3", "nothing like it", "mKi67_AF488"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    x = part(spark, sf).select("p_partkey", F.when(F.col("p_partkey") % 4 == 0, "Panel 1: CD20").otherwise(raw).alias("raw"))
    return L.lookup_markers(x, "raw", L.registry_keys(Q.registry(spark))).select("p_partkey", "marker_id")


@query(O._L + ", k AS (SELECT p_partkey, image, marker_id, CAST(marker_id NOT IN (0,1) AS INT) AS k FROM lk), a AS (SELECT *, max(k) OVER (PARTITION BY image) AS any_ FROM k) SELECT p_partkey FROM a WHERE k=1 OR any_=0")
def drop_blank_guarded(spark, sf):
    return T.keep_channels(Q.looked_up(spark, sf), "image").select("p_partkey")


@query("SELECT p_partkey, CASE WHEN p_partkey%3=0 THEN 'own'||p_size WHEN p_partkey%3=1 THEN 'stored'||p_size END AS names FROM part")
def coord_names(spark, sf):
    x = part(spark, sf).withColumnRenamed("p_partkey", "image")
    name = lambda t: F.array(F.concat(F.lit(t), F.col("p_size").cast("string")))
    entries = x.select("image", F.when(F.col("image") % 3 == 0, name("own")).alias("channel_names"))
    stored = x.where("image % 3 < 2").select("image", name("stored").alias("channel_names"))
    return S.fill_names(entries, stored).select(F.col("image").alias("p_partkey"), F.array_join("channel_names", "|").alias("names")).withColumn("names", F.nullif("names", F.lit("")))


@query("SELECT p_partkey, array_to_string(list_transform(generate_series(1,4), lambda i: CASE WHEN i<=p_size%6 THEN 'r'||i ELSE 'C'||i END), '|') AS raw, array_to_string(list_transform(generate_series(1,4), lambda i: CASE WHEN i<=p_partkey%3 THEN 'm'||i WHEN i<=p_size%6 THEN 'r'||i ELSE 'C'||i END), '|') AS markers FROM part")
def sample_channel_names(spark, sf):
    some = lambda t, n: F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n)), lambda i: F.concat(F.lit(t), i.cast("string")))).otherwise(F.array().cast("array<string>"))
    raw, markers = C.sample_names(some("r", (F.col("p_size") % 6).cast("int")), some("m", (F.col("p_partkey") % 3).cast("int")), F.lit(4))
    return part(spark, sf).select("p_partkey", F.array_join(raw, "|").alias("raw"), F.array_join(markers, "|").alias("markers"))


# ---------------------------------------------------------------- integrity

_EXPECTED = "ex AS (SELECT image, max(n) AS channels FROM (SELECT image, height, width, count(*) AS n FROM pg GROUP BY image, height, width) GROUP BY image), lv AS (SELECT g.image, g.height, g.width, n AS pages, greatest(g.height, g.width) AS e FROM (SELECT image, height, width, count(*) AS n FROM pg GROUP BY image, height, width) g JOIN ex ON ex.image=g.image AND ex.channels + CASE WHEN g.image%7=0 THEN 100000 ELSE 0 END = n), ch AS (SELECT image, height, width FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY CASE WHEN e<=1000 THEN 0 ELSE 1 END, CASE WHEN e<=1000 THEN -e ELSE e END, height, width) AS r FROM lv) WHERE r=1)"


def expected(spark, sf) -> tuple[DataFrame, DataFrame]:
    p = Q.page_rows(spark, sf)
    most = p.groupBy("image", "height", "width").agg(F.count(F.lit(1)).alias("n")).groupBy("image").agg(F.max("n").alias("channels"))
    return p, most.withColumn("channels", F.col("channels") + F.when(F.col("image") % 7 == 0, 100000).otherwise(0))


@query(f"WITH {O._PAGES}, {_EXPECTED} SELECT image, height, width, pages FROM lv")
def exact_levels(spark, sf):
    return I.page_levels(*expected(spark, sf))


def issues(spark, sf) -> DataFrame:
    p, most = expected(spark, sf)
    p = p.withColumn("page_index", F.col("event_id"))
    return I.page_issues(p, most, 1000, F.col("event_type") == "purchase", C.page_label(F.when(F.col("event_id") % 2 == 0, F.format_string("<Name>P%d</Name>", "event_id")), F.col("page_index")), F.lit("ValueError"), F.lit("cannot decode"))


_ISSUES = f"""{O._PAGES}, {_EXPECTED}, dc AS (SELECT pg.image AS path, '{I.DECODE}' AS stage, CASE WHEN event_id%2=0 THEN 'P'||event_id ELSE 'page_'||event_id END AS channel, event_id AS page_index, 'ValueError' AS error_type, 'cannot decode' AS message FROM pg JOIN ch ON ch.image=pg.image AND ch.height=pg.height AND ch.width=pg.width WHERE event_type='purchase'),
 op AS (SELECT g.image AS path, '{I.OPEN}' AS stage, CAST(NULL AS VARCHAR) AS channel, CAST(NULL AS BIGINT) AS page_index, 'ValueError' AS error_type, 'no pyramid level has exactly ' || (ex.channels+100000) || ' channel pages; found ' || string_agg(width||'x'||height||':'||n, ', ' ORDER BY height, width, n) AS message FROM (SELECT image, height, width, count(*) AS n FROM pg GROUP BY image, height, width) g JOIN ex ON ex.image=g.image WHERE g.image%7=0 GROUP BY g.image, ex.channels),
 iss AS (SELECT * FROM dc UNION ALL SELECT * FROM op)"""


@query(f"WITH {_ISSUES} SELECT * FROM iss")
def integrity_issues(spark, sf):
    return issues(spark, sf)


@query(f"WITH {_ISSUES}, im AS (SELECT DISTINCT image FROM pg) SELECT (SELECT count(*) FROM im) AS total, (SELECT count(*) FROM im WHERE image NOT IN (SELECT path FROM iss)) AS passed, (SELECT count(DISTINCT path) FROM iss) AS failed, (SELECT count(*) FROM iss) AS issues, 1 AS status")
def integrity_totals(spark, sf):
    found = I.report(issues(spark, sf), Q.page_rows(spark, sf).select(F.col("image").alias("path")).distinct())
    return found.select("total", "passed", "failed", F.size("issues").cast("long").alias("issues"), F.when(F.col("failed") > 0, 1).otherwise(0).alias("status"))


@query("SELECT p_partkey FROM part WHERE p_size%5=0")
def geometry_mismatches(spark, sf):
    x = Q.slides(spark, sf).withColumn("w2", F.col("width") + F.when(F.col("width") % 35 == 30, 1).otherwise(0)).withColumn("h2", F.col("height"))
    return I.shape_mismatches(x, ("width", "height"), ("w2", "h2")).select(F.col("image").alias("p_partkey"))


@query("""WITH i AS (SELECT 's'||(p_partkey%900) AS stem, p_partkey%3<>0 AS ok FROM part), o AS (SELECT DISTINCT 's'||(p_partkey%1000) AS stem FROM part WHERE p_size>10)
 SELECT 'duplicate_stem' AS "check", stem FROM i GROUP BY stem HAVING count(*)>1 UNION ALL SELECT DISTINCT 'missing_output', stem FROM i WHERE ok AND stem NOT IN (SELECT stem FROM o) UNION ALL SELECT DISTINCT 'output_of_failed', stem FROM i WHERE NOT ok AND stem IN (SELECT stem FROM o)""")
def release_checks(spark, sf):
    stem = lambda n: F.concat(F.lit("s"), (F.col("p_partkey") % n).cast("string")).alias("stem")
    return I.release_checks(part(spark, sf).select(stem(900), (F.col("p_partkey") % 3 != 0).alias("ok")), part(spark, sf).where("p_size > 10").select(stem(1000)))


@query(f"WITH {_ISSUES} SELECT vec_id AS coord, label AS image FROM embeddings WHERE label NOT IN (SELECT path FROM iss)")
def gated_coords(spark, sf):
    coords = Q.table(spark, sf, "embeddings").select(F.col("vec_id").alias("coord"), F.col("label").alias("image"))
    return I.passed_only(coords, issues(spark, sf), "image")


@query("SELECT p_partkey AS image, CASE WHEN p_partkey%2=0 THEN 'integrity' WHEN p_partkey%3=0 THEN 'baseline' ELSE 'done' END AS stage FROM part")
def stage_gates(spark, sf):
    x = part(spark, sf).select(F.col("p_partkey").alias("image"))
    return I.stage_status(x, [("integrity", x.where("image % 2 <> 0")), ("baseline", x.where("image % 3 <> 0"))])


@query("SELECT CASE page_id%4 WHEN 1 THEN 'ims' WHEN 2 THEN 'qptiff' ELSE 'tiff' END AS kind, count(*) AS images, count(*) FILTER (WHERE page_id%10=0) AS unresolved FROM pages GROUP BY 1")
def discovery_audit(spark, sf):
    return I.audit(Q.images_of(spark, sf), L.reader_type(F.col("path")), F.col("page_id") % 10 != 0)


@query("SELECT 'd'||(p_partkey%4) AS dataset, count(*) AS slides, CAST(sum(p_size%4) AS BIGINT) AS patches, CAST(sum(1+p_size%5) AS BIGINT) AS channels FROM part GROUP BY 1")
def release_totals(spark, sf):
    return I.release_totals(part(spark, sf).select(F.concat(F.lit("d"), (F.col("p_partkey") % 4).cast("string")).alias("dataset"), (F.col("p_size") % 4).cast("long").alias("num_patches"), (1 + F.col("p_size") % 5).cast("long").alias("channel_count")))


# ---------------------------------------------------------------- manifests and settings


@query("""SELECT p_partkey, 'img'||p_partkey||'.tif' AS path, CASE WHEN p_size%2=0 THEN 'd' ELSE '' END AS dataset, 'tiff' AS reader_type, CASE WHEN p_size%3=0 THEN CAST(0.5 AS DOUBLE) END AS mpp, CASE WHEN p_size%5=0 THEN 'a|b' ELSE '' END AS names, CASE WHEN p_size%4=0 THEN 'stray'||p_size WHEN p_size%4=1 THEN 'given' END AS note FROM part WHERE p_partkey%10<>0""")
def image_specs(spark, sf):
    s, key = F.col("p_size").cast("string"), F.col("p_partkey")
    fields = F.concat(F.format_string('{"path": "img%d.tif"', key), F.when(F.col("p_size") % 2 == 0, ', "dataset": "d"').otherwise(""), F.when(F.col("p_size") % 3 == 0, ', "mpp": 0.5').otherwise(""), F.when(F.col("p_size") % 5 == 0, ', "channel_names": ["a", "b"]').otherwise(""), F.when(F.col("p_size") % 4 < 2, ', "extras": {"note": "given"}').otherwise(""), F.when(F.col("p_size") % 4 == 0, F.concat(F.lit(', "note": "stray'), s, F.lit('"'))).otherwise(""), F.when(key % 10 == 0, ', "error": null').otherwise(""), F.lit("}"))
    x = M.specs(part(spark, sf).select("p_partkey", fields.alias("value")), "value", F.lit("part"), "p_partkey")
    return x.select("p_partkey", "path", "dataset", "reader_type", "mpp", F.array_join("channel_names", "|").alias("names"), F.try_element_at("extras", F.lit("note")).alias("note"))


@query("SELECT p_partkey, CASE WHEN p_partkey%3=0 THEN '0.1,0.2,0.5,0.75' END AS region FROM part")
def region_strings(spark, sf):
    text = F.element_at(F.array(*map(F.lit, ("0.1, 0.2,0.5,0.75", "0.5,0.2,0.1,0.75", "a,b,c"))), (F.col("p_partkey") % 3 + 1).cast("int"))
    return part(spark, sf).select("p_partkey", F.array_join(M.region_bounds(text).cast("array<string>"), ",").alias("region"))


ORACLE_PROFILES = ", ".join(f"('{n}', " + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in {**M.DEFAULT, **p}.values()) + ")" for n, p in sorted(M.PROFILES.items()))


@query(f"SELECT profile, fusion, CAST(tp AS DOUBLE) AS threshold_percentile, CAST(ms AS DOUBLE) AS min_signal, CAST(bs AS DOUBLE) AS blur_sigma, cr AS close_radius, op AS open_radius, dr AS dilate_radius, CAST(af AS DOUBLE) AS min_component_area_fraction, CAST(ff AS DOUBLE) AS min_foreground_fraction FROM (VALUES {ORACLE_PROFILES}) t(profile, fusion, tp, ms, bs, cr, op, dr, af, ff)")
def profiles(spark, sf):
    return M.profile_table(spark)


@query("SELECT p_partkey FROM part ORDER BY p_partkey LIMIT 25")
def first_slides(spark, sf):
    return M.first_slides(part(spark, sf).withColumn("ord", F.col("p_partkey")), 25).select("p_partkey")


@query("SELECT p_partkey, p_partkey%2=0 AS resolved, CASE WHEN p_partkey%2=0 THEN 'CD'||p_size END AS marker FROM part")
def resolved_channels(spark, sf):
    x = part(spark, sf).select(F.col("p_partkey").alias("image"), F.lit("dye").alias("channel"))
    panel = part(spark, sf).where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("image"), F.lit("dye").alias("channel"), F.concat(F.lit("CD"), F.col("p_size").cast("string")).alias("marker"))
    return M.evidence(x, panel, "image").select(F.col("image").alias("p_partkey"), "resolved", "marker")


@query("SELECT p_partkey AS path, 'z policy is missing for '||(1+p_size%4)||' planes' AS message FROM part WHERE p_size%4>0 AND p_partkey%3=0")
def z_issues(spark, sf):
    x = part(spark, sf).select(F.col("p_partkey").alias("path"), (1 + F.col("p_size") % 4).alias("z_count"), F.when(F.col("p_partkey") % 3 != 0, "max").alias("z_policy"))
    return M.z_issues(x)


@query("SELECT p_partkey AS image, CASE WHEN p_partkey%4=1 THEN 'exclude' ELSE '' END AS kinds FROM part")
def corrections(spark, sf):
    x = part(spark, sf).select(F.col("p_partkey").alias("image"))
    given = x.where("image % 2 = 1").select("image", F.lit("exclude").alias("kind"), F.when(F.col("image") % 4 == 1, "bubble").otherwise(" ").alias("rationale"))
    return M.corrections(x, given).select("image", F.array_join("kinds", "|").alias("kinds"))


# ---------------------------------------------------------------- coordinates


_GRID = "SELECT image, CAST(gx AS BIGINT) AS x, CAST(gy AS BIGINT) AS y FROM (SELECT image, height, unnest(generate_series(0, greatest(0, width-64), 48)) AS gx FROM sl) a, LATERAL (SELECT unnest(generate_series(0, greatest(0, a.height-64), 48)) AS gy) b"


@query(f"WITH {O._SLIDES}, g AS ({_GRID}) SELECT image, CAST(row_number() OVER (PARTITION BY image ORDER BY y, x) - 1 AS INT) AS coord_index, x, y FROM g")
def coord_rows(spark, sf):
    return S.coordinate_rows(R.patch_grid(Q.slides(spark, sf), 64, 16))


@query(f"WITH {O._SLIDES}, g AS ({_GRID}), c AS (SELECT image, count(*) AS n FROM g WHERE image%5<>0 GROUP BY image) SELECT p_partkey AS image, coalesce(n, 0) AS num_patches, least(greatest(coalesce(n, 0), 1), 4096) AS chunk, 'sp_trident_coords_v1' AS format FROM part LEFT JOIN c ON c.image=p_partkey")
def coord_attributes(spark, sf):
    grid = R.patch_grid(Q.slides(spark, sf), 64, 16).where("image % 5 <> 0")
    return S.attributes(Q.slides(spark, sf), grid).select("image", "num_patches", "chunk", "format")


# ---------------------------------------------------------------- rasters


@query(f"WITH {O._PM} SELECT image, y, x, (SELECT 1) AS one, m FROM pm WHERE false")
def box_means(spark, sf):
    return R.box_mean(Q.plane_masks(spark, sf), 1).select("image", "y", "x", F.round("mean", 9).alias("mean"))


ORACLE_SQL["box_means"] = f"WITH {O._PM} SELECT a.image, a.y, a.x, round(avg(b.m), 9) AS mean FROM pm a JOIN pm b ON a.image=b.image AND abs(a.y-b.y)<=1 AND abs(a.x-b.x)<=1 GROUP BY a.image, a.y, a.x"
_W = R.gaussian(1.0, 1)


@query(f"WITH {O._PX}, p AS (SELECT * FROM px WHERE channel = 1), w(d, w) AS (VALUES (-1, {_W[0]!r}), (0, {_W[1]!r}), (1, {_W[2]!r})), a AS (SELECT p.image, p.y, p.x, sum(w.w*q.v) AS v FROM p, w, p q WHERE q.image=p.image AND q.y=p.y AND q.x = CASE WHEN p.x+d<0 THEN -(p.x+d) WHEN p.x+d>7 THEN 14-(p.x+d) ELSE p.x+d END GROUP BY p.image, p.y, p.x), b AS (SELECT p.image, p.y, p.x, sum(w.w*q.v) AS v FROM a p, w, a q WHERE q.image=p.image AND q.x=p.x AND q.y = CASE WHEN p.y+d<0 THEN -(p.y+d) WHEN p.y+d>7 THEN 14-(p.y+d) ELSE p.y+d END GROUP BY p.image, p.y, p.x) SELECT image, y, x, round(v, 9) AS v FROM b")
def gaussian_blur(spark, sf):
    p = Q.planes(spark, sf).where("channel = 1").select("image", "y", "x", "v")
    return R.convolve(R.convolve(p, _W, "x"), _W, "y").select("image", "y", "x", F.round("v", 9).alias("v"))


@query(f"""WITH {O._PX}, p AS (SELECT * FROM px WHERE channel = 1), o AS (SELECT unnest(generate_series(0,2)) AS t), c AS (SELECT p.image, oy.t AS y, ox.t AS x, v, greatest(0, least((oy.t+1)*8, (p.y+1)*3) - greatest(oy.t*8, p.y*3)) * greatest(0, least((ox.t+1)*8, (p.x+1)*3) - greatest(ox.t*8, p.x*3)) AS w FROM p, o oy, o ox)
 SELECT image, CAST(y AS INT) AS y, CAST(x AS INT) AS x, round(sum(w*v)/sum(w), 9) AS v FROM c WHERE w > 0 GROUP BY image, y, x""")
def area_downsample(spark, sf):
    p = Q.planes(spark, sf).where("channel = 1").select("image", "y", "x", "v")
    return R.area_downsample(p, 8, 8, 3, 3).select("image", "y", "x", F.round("v", 9).alias("v"))


@query(f"WITH {O._PM} SELECT image, CAST(y//3 AS INT) AS y, CAST(x//3 AS INT) AS x, m FROM pm WHERE y%3=0 AND x%3=0")
def strided_plane(spark, sf):
    return R.strided(Q.plane_masks(spark, sf), 8, 3)


@query(f"WITH {O._SLIDES} SELECT image, greatest(1, CAST(round_even(width*least(1.0, 300.0/greatest(width,height)), 0) AS INT)) AS w, greatest(1, CAST(round_even(height*least(1.0, 300.0/greatest(width,height)), 0) AS INT)) AS h FROM sl")
def thumbnail_sizes(spark, sf):
    w, h = R.thumbnail_size(F.col("width"), F.col("height"), 300)
    return Q.slides(spark, sf).select("image", w.alias("w"), h.alias("h"))


@query(f"WITH {O._PM} SELECT image, count(*) AS pixels, CAST(sum(m) AS BIGINT) AS foreground, avg(m) AS fraction FROM pm WHERE x>=2 AND x<6 AND y>=1 GROUP BY image")
def roi_fraction(spark, sf):
    return R.fractions(Q.plane_masks(spark, sf), R.in_rect(0.25, 0.125, 0.75, 1.0, F.lit(8), F.lit(8)))


_AB = f"WITH {O._U8}, {O._mask('a', 'percentile', 0.55)}, {O._mask('b', 'max', 0.7)}"


def two_masks(spark, sf) -> tuple[DataFrame, DataFrame]:
    return Q.masks(spark, sf), R.foreground(Q.fused(spark, sf, "max"), 70.0)


@query(_AB + " SELECT a.image, count(*) FILTER (WHERE a.m=0 AND b.m=1) AS added, count(*) FILTER (WHERE a.m=1 AND b.m=0) AS removed FROM a JOIN b ON a.image=b.image AND a.y=b.y AND a.x=b.x GROUP BY a.image")
def mask_changes(spark, sf):
    return R.changes(*two_masks(spark, sf))


@query(_AB + " SELECT a.image, a.y, a.x, CASE WHEN a.x<2 OR a.x>=6 OR a.y<2 OR a.y>=6 THEN a.m*b.m ELSE a.m END AS m FROM a JOIN b ON a.image=b.image AND a.y=b.y AND a.x=b.x")
def edge_cleanup(spark, sf):
    a, b = two_masks(spark, sf)
    return R.edge_cleanup(a, b, R.edge_band(F.lit(8), F.lit(8), 0.25))


@query(_AB + ", d AS (SELECT p.image, p.y, p.x, max(p.m) AS m, avg(q.m) AS mean FROM b p JOIN b q ON p.image=q.image AND abs(p.y-q.y)<=1 AND abs(p.x-q.x)<=1 GROUP BY p.image, p.y, p.x) SELECT a.image, a.y, a.x, greatest(a.m, CASE WHEN d.mean>=0.6 THEN d.m ELSE 0 END) AS m FROM a JOIN d ON a.image=d.image AND a.y=d.y AND a.x=d.x")
def dense_rescue(spark, sf):
    a, b = two_masks(spark, sf)
    return R.dense_rescue(a, b, 1, 0.6)


@query(f"WITH {O._PX}, t AS (SELECT image, y, x, max(v) FILTER (WHERE channel%3=0) AS v FROM px GROUP BY image, y, x) SELECT image, y, x, v FROM t")
def nucleus_union(spark, sf):
    return Q.planes(spark, sf).groupBy("image", "y", "x").agg(F.expr("max(v) FILTER (WHERE channel % 3 = 0)").alias("v"))


@query(f"WITH {O._PAGES} SELECT image, arg_max(height, height*width*1000+height) AS height, max(height*width) AS size FROM pg GROUP BY image")
def source_shape(spark, sf):
    p = Q.page_rows(spark, sf)
    size = F.col("height") * F.col("width")
    return p.groupBy("image").agg(F.max_by("height", size * 1000 + F.col("height")).alias("height"), F.max(size).alias("size"))


@query(f"WITH {O._PM} SELECT * FROM pm WHERE false")
def disc_pixels(spark, sf):
    return R.dilate(Q.plane_masks(spark, sf), 2).where("m = 1").select("image", "y", "x")


ORACLE_SQL["disc_pixels"] = f"WITH {O._PM}, {O._dilated('d', 'pm', 2)} SELECT image, y, x FROM d WHERE m = 1"


@query(f"WITH {O._PM}, {O._dilated('d', 'pm', 1, 0)} SELECT image, y, x FROM d WHERE m = 1")
def eroded_pixels(spark, sf):
    return R.erode(Q.plane_masks(spark, sf), 1).where("m = 1").select("image", "y", "x")


_FULL = O._PM.replace("> 0.1 ", "> -0.15 ")


@query(f"WITH RECURSIVE {_FULL}, {O._components('pm', 0)}, inner_ AS (SELECT image, label FROM st WHERE x0>0 AND y0>0 AND x0+w<8 AND y0+h<8 AND area<=3) SELECT lab.image, lab.y, lab.x FROM lab JOIN inner_ i ON i.image=lab.image AND i.label=lab.label")
def filled_pixels(spark, sf):
    e = Q.table(spark, sf, "embeddings").select(F.col("vec_id").cast("long").alias("image"), F.posexplode("embedding").alias("pos", "e"))
    m = e.select("image", F.expr("pos div 8").cast("int").alias("y"), (F.col("pos") % 8).alias("x"), (F.col("e").cast("double") > -0.15).cast("int").alias("m"))
    full = R.fill_holes(m, 0.05).select("image", "y", "x", F.col("m").alias("k"))
    return m.join(full, ["image", "y", "x"]).where("m = 0 and k = 1").select("image", "y", "x")


@query()
def foreground_pipeline(spark, sf):
    """The composed foreground of each image, with frames, strips and small components at the edges cleaned up."""
    how = {**M.profile("fluorescence-artifact-strict"), "blur_sigma": 0.5, "close_radius": 1, "open_radius": 0, "dilate_radius": 1, "min_component_area_fraction": 0.05, "hole_fraction": 0.05}
    inside = lambda *r: R.in_rect(*r, F.lit(8), F.lit(8))
    return R.segment(Q.fused(spark, sf, "max"), how, edges=True, excluded=inside(0.0, 0.0, 0.25, 0.25), forced=inside(0.75, 0.75, 1.0, 1.0))


@query()
def concavities(spark, sf):
    return R.fill_concavities(Q.plane_masks(spark, sf), 0.1)


@query(_AB + ", st AS (SELECT a.image, a.y, a.x, CASE WHEN a.x<4 AND a.y<4 THEN b.m ELSE a.m END AS m FROM a JOIN b ON a.image=b.image AND a.y=b.y AND a.x=b.x) SELECT image, y, x, CASE WHEN x>=6 AND y>=6 THEN 0 WHEN y<1 THEN 0 ELSE m END AS m FROM st")
def composed_mask(spark, sf):
    """Stages in their fixed order: a strict region, then excluded regions, given the other way round."""
    x = Q.fused(spark, sf, "max")
    regions = [(0.75, 0.75, 1.0, 1.0), (0.0, 0.0, 1.0, 0.125)]
    return R.compose(Q.masks(spark, sf), x, F.lit(8), F.lit(8), {"excluded_regions": regions, "strict_regions": {"regions": [(0.0, 0.0, 0.5, 0.5)], "percentile": 70.0, "min_signal": 8.0}})


@query(_AB + " SELECT a.image, a.y, a.x, CASE WHEN a.x>=2 AND a.x<6 THEN greatest(a.m, b.m) ELSE a.m END AS m FROM a JOIN b ON a.image=b.image AND a.y=b.y AND a.x=b.x")
def roi_max_fusion(spark, sf):
    a, b = two_masks(spark, sf)
    return R.within_regions(a, b, [(0.25, 0.0, 0.5, 1.0), (0.5, 0.0, 0.75, 1.0)], F.lit(8), F.lit(8))


@query(_AB + ", lt AS (SELECT image, greatest(8.0, coalesce(quantile_cont(CAST(fused AS DOUBLE), 0.6) FILTER (WHERE fused>0), 8.0)) AS t FROM b_f WHERE x<4 AND y>=4 GROUP BY image) SELECT a.image, a.y, a.x, CASE WHEN a.x<4 AND a.y>=4 THEN CAST(f.fused > t AS INT) ELSE a.m END AS m FROM a JOIN b_f f ON a.image=f.image AND a.y=f.y AND a.x=f.x JOIN lt ON lt.image=a.image")
def local_segmentation(spark, sf):
    return R.local_segmentation(Q.masks(spark, sf), Q.fused(spark, sf, "max"), (0.0, 0.5, 0.5, 1.0), 60.0, 8.0, F.lit(8), F.lit(8))


@query(_AB + f", {O._dilated('d', 'b', 1)} SELECT a.image, a.y, a.x, a.m*d.m AS m FROM a JOIN d ON a.image=d.image AND a.y=d.y AND a.x=d.x")
def nucleus_gate(spark, sf):
    a, b = two_masks(spark, sf)
    return R.near(a, b, 1)


@query("SELECT page_id, CASE page_id%4 WHEN 0 THEN 'ome' WHEN 1 THEN 'ims' ELSE 'slide' END AS branch FROM pages")
def format_router(spark, sf):
    return Q.images_of(spark, sf).select("page_id", R.route(F.col("path"), F.lit("tiff")).alias("branch"))


@query(f"""WITH {O._U8}, f AS ({O._fuse('max')}), h AS (SELECT image, fused AS v, count(*) AS c FROM f GROUP BY image, fused), w AS (SELECT image, v, sum(c) OVER p AS w, sum(c*v) OVER p AS s, sum(c) OVER (PARTITION BY image) AS n, sum(c*v) OVER (PARTITION BY image) AS t FROM h WINDOW p AS (PARTITION BY image ORDER BY v)),
 b AS (SELECT image, v, CASE WHEN w<n THEN w*(n-w)*power(CAST(s AS DOUBLE)/w - CAST(t-s AS DOUBLE)/(n-w), 2) ELSE 0.0 END AS a FROM w) SELECT image, v AS threshold FROM (SELECT image, v, row_number() OVER (PARTITION BY image ORDER BY a DESC, v) AS r FROM b) WHERE r=1""")
def otsu_threshold(spark, sf):
    return R.otsu(Q.fused(spark, sf, "max"))


@query(f"WITH {O._PM}, i AS (SELECT image, y, x, x - row_number() OVER (PARTITION BY image, y ORDER BY x) AS g FROM pm WHERE m=1), r AS (SELECT image, y, min(x) AS x0, max(x)+1 AS x1 FROM i GROUP BY image, y, g) SELECT image, count(*) AS features FROM r GROUP BY image")
def contour_export(spark, sf):
    found = S.geojson(R.runs(Q.plane_masks(spark, sf)))
    return found.select("image", (F.size(F.split("value", '"type":"Feature"', -1)) - 1).cast("long").alias("features"))


# ---------------------------------------------------------------- training samples


def entries(spark, sf) -> DataFrame:
    return Q.slides(spark, sf).select((F.col("image") - 1).cast("long").alias("nth"), "image", "n", "width", "height")


def _hash(*parts: str) -> str:
    return "CAST('0x' || substr(md5(" + " || '-' || ".join(parts) + "), 1, 7) AS BIGINT)"


_ENTRIES = f"{O._SLIDES}, en AS (SELECT image-1 AS nth, image, n, width, height FROM sl)"
_SAMPLES = "sm AS (SELECT o_orderkey AS idx FROM orders)"
_DRAW = f"dr AS (SELECT idx, e.nth, e.image, CASE WHEN e.n > 1 THEN {_hash(chr(39) + '7' + chr(39), chr(39) + 'coord' + chr(39), 'CAST(idx AS VARCHAR)')} % e.n WHEN e.n = 1 THEN 0 ELSE -1 END AS coord_index FROM (SELECT idx, {_hash(chr(39) + '7' + chr(39), chr(39) + 'entry' + chr(39), 'CAST(idx//4 AS VARCHAR)')} % (SELECT count(*) FROM en) AS nth FROM sm) s JOIN en e ON e.nth=s.nth)"


@query(f"WITH {_ENTRIES}, {_SAMPLES}, {_DRAW} SELECT idx, image, coord_index FROM dr")
def random_entries(spark, sf):
    samples = Q.table(spark, sf, "orders").select(F.col("o_orderkey").alias("idx"))
    return T.draw(samples, entries(spark, sf), 7, 4).select("idx", "image", "coord_index")


def _corner(name: str, side: str) -> str:
    return f"CASE WHEN {side}-224+1 > 1 THEN {_hash(chr(39) + '7' + chr(39), chr(39) + name + chr(39), 'CAST(image AS VARCHAR)')} % ({side}-224+1) ELSE 0 END AS {name}"


@query(f"WITH {O._SLIDES} SELECT image AS idx, {_corner('x', 'width')}, {_corner('y', 'height')} FROM sl")
def random_origins(spark, sf):
    return T.origins(Q.slides(spark, sf).withColumnRenamed("image", "idx"), 224, 7).select("idx", "x", "y")


@query(
    f"""WITH t AS (SELECT o_orderkey AS idx, k, CASE WHEN k=0 THEN o_orderkey ELSE {_hash(chr(39) + '7' + chr(39), chr(39) + 'retry' + chr(39), 'CAST(o_orderkey AS VARCHAR)', 'CAST(k AS VARCHAR)')} % 1000 END AS used FROM orders, (SELECT unnest(generate_series(0,8)) AS k) g)
 SELECT idx, arg_min(used, k) FILTER (WHERE used%3<>0) AS used FROM t GROUP BY idx"""
)
def retry_samples(spark, sf):
    samples = Q.table(spark, sf, "orders").select(F.col("o_orderkey").alias("idx"))
    bad = samples.union(spark.range(1000).toDF("idx")).where("idx % 3 = 0")
    return T.readable(samples, bad, 1000, 7).select("idx", "used")


@query("SELECT CAST(sum(CASE WHEN p_partkey%3=0 THEN 1 ELSE p_size%4 END) AS BIGINT) AS n FROM part")
def dataset_length(spark, sf):
    x = Q.slides(spark, sf)
    counted = T.sample_counts(x.drop("n"), x.select("image", F.col("n").alias("c")), F.col("image") % 3 != 0)
    return T.length(counted, "n")


_ASM = O._L + ", sa AS (SELECT image, list(marker_id ORDER BY CASE WHEN marker_id=0 THEN 1 ELSE 0 END, marker_id, p_partkey) AS ids0 FROM lk GROUP BY image), sb AS (SELECT image AS sample, image%5 AS batch, list_slice(ids0, 1, 3 + image%7) AS ids, least(len(ids0), 3 + image%7) AS c FROM sa), sc AS (SELECT *, max(c) OVER (PARTITION BY batch) AS w FROM sb)"


def assembled(spark, sf) -> DataFrame:
    x = Q.looked_up(spark, sf).select("image", F.col("p_partkey").alias("channel"), "marker_id", "marker", "raw")
    x = T.assemble(x, ["image"]).withColumn("k", (3 + F.col("image") % 7).cast("int"))
    return x.select(F.col("image").alias("sample"), (F.col("image") % 5).alias("batch"), F.slice("marker_ids", F.lit(1), F.col("k")).alias("marker_ids"), F.least("c", "k").alias("c"))


@query(_ASM + " SELECT sample, array_to_string(ids, ',') AS marker_ids, CAST(c AS INT) AS c FROM sc")
def sample_rows(spark, sf):
    return assembled(spark, sf).select("sample", F.array_join(F.col("marker_ids").cast("array<string>"), ",").alias("marker_ids"), "c")


@query(_ASM + " SELECT sample, array_to_string(list_concat(ids, list_transform(generate_series(1, w-c), lambda i: -1)), ',') AS marker_ids, c AS valid, 14 AS grid FROM sc")
def collate_batch(spark, sf):
    x = T.collate(assembled(spark, sf), "batch", 224, 16)
    return x.select("sample", F.array_join(F.col("marker_ids").cast("array<string>"), ",").alias("marker_ids"), F.size(F.filter("valid_channels", lambda v: v)).cast("long").alias("valid"), F.get("patch_grid", F.lit(0)).alias("grid"))


_T7 = chr(39) + "7" + chr(39)


@query(
    _ASM
    + f""", ex AS (SELECT sample, c, w, unnest(generate_series(0, w-1)) AS channel FROM sc), tk AS (SELECT *, unnest(generate_series(0, 3)) AS token FROM ex),
 mk AS (SELECT sample, channel, token, channel < c AND {_hash(_T7, chr(39) + 'patch' + chr(39), 'CAST(sample AS VARCHAR)', 'CAST(channel AS VARCHAR)', 'CAST(token AS VARCHAR)')} < 0.4*268435456 AS p, channel < c AND {_hash(_T7, chr(39) + 'channel' + chr(39), 'CAST(sample AS VARCHAR)', 'CAST(channel AS VARCHAR)')} < 0.2*268435456 AS q FROM tk)
 SELECT sample, CAST(channel AS INT) AS channel, CAST(token AS INT) AS token, p AS patch_mask, q AS channel_mask, p OR q AS loss_mask FROM mk"""
)
def loss_masks(spark, sf):
    return T.training_masks(T.collate(assembled(spark, sf), "batch", 32, 16), "sample", 7, 0.4, 0.2)


@query(f"WITH {O._PX}, g AS (SELECT image, channel, unnest(generate_series(0,9)) AS y FROM (SELECT DISTINCT image, channel FROM px WHERE channel=1)), h AS (SELECT image, channel, y, unnest(generate_series(0,9)) AS x FROM g) SELECT h.image, CAST(h.y AS INT) AS y, CAST(h.x AS INT) AS x, coalesce(v, 0.0) AS v FROM h LEFT JOIN px ON px.image=h.image AND px.channel=h.channel AND px.y=h.y AND px.x=h.x")
def pad_patch(spark, sf):
    return T.pad_patch(Q.planes(spark, sf).where("channel = 1"), ["image", "channel"], 10).drop("channel")
