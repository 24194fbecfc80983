"""DuckDB SQL that gives the same rows as the queries of proxies.py, written from the operators' definitions."""

from __future__ import annotations

from plexframe.functions.labels import ALIASES, NUCLEUS, SPELLED, STEPS, TECHNICAL

_PX = """px AS (SELECT label AS image, channel, CAST((i-1)//8 AS INT) AS y, CAST((i-1)%8 AS INT) AS x, CAST(embedding[i] AS DOUBLE) AS v
 FROM (SELECT label, embedding, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) AS INT) AS channel FROM embeddings) e, (SELECT unnest(generate_series(1,64)) AS i) g)"""
_U8 = (
    _PX
    + """, lim AS (SELECT image, channel, coalesce(quantile_cont(v,0.01) FILTER (WHERE v>0), min(v)) AS lo, coalesce(quantile_cont(v,0.995) FILTER (WHERE v>0), max(v)) AS hi FROM px GROUP BY image, channel),
u AS (SELECT px.image, px.channel, y, x, CAST(trunc(greatest(0.0, least(255.0, (v-lo)*(255.0/((CASE WHEN hi<=lo THEN lo+1 ELSE hi END)-lo))))) AS INT) AS u8 FROM px JOIN lim ON px.image=lim.image AND px.channel=lim.channel)"""
)


def _fuse(how: str) -> str:
    value = {"max": "max(u8)", "median": "median(CAST(u8 AS DOUBLE))", "percentile": "quantile_cont(CAST(u8 AS DOUBLE),0.75)"}[how]
    return f"SELECT image, y, x, CAST(trunc({value}) AS INT) AS fused FROM u GROUP BY image, y, x"


def _mask(name: str, how: str, p: float) -> str:
    return f"""{name}_f AS ({_fuse(how)}), {name}_t AS (SELECT image, greatest(8.0, coalesce(quantile_cont(CAST(fused AS DOUBLE),{p}) FILTER (WHERE fused>0), 8.0)) AS threshold FROM {name}_f GROUP BY image),
{name} AS (SELECT f.image, y, x, CAST(fused > threshold AS INT) AS m FROM {name}_f f JOIN {name}_t t ON f.image=t.image)"""


_M = f"WITH {_U8}, {_mask('mk', 'percentile', 0.55)}"
_INT = ", s1 AS (SELECT image, y, x, sum(m) OVER (PARTITION BY image, y ORDER BY x) AS r FROM mk), ii AS (SELECT image, y, x, CAST(sum(r) OVER (PARTITION BY image, x ORDER BY y) AS BIGINT) AS s FROM s1)"
_PM = "pm AS (SELECT vec_id AS image, CAST((i-1)//8 AS INT) AS y, CAST((i-1)%8 AS INT) AS x, CAST(CAST(embedding[i] AS DOUBLE) > 0.1 AS INT) AS m FROM embeddings, (SELECT unnest(generate_series(1,64)) AS i) g)"


def _dilated(name: str, source: str, radius: int, of: int = 1) -> str:
    """Pixels under the disc around a pixel whose m is `of`, as name(image, y, x, m) with m = of there."""
    rows = [(dy, round(radius * max(0.0, 1 - (dy / radius) ** 2) ** 0.5)) for dy in range(-radius, radius + 1)]
    offsets = ", ".join(f"({dy},{dx})" for dy, w in rows for dx in range(-w, w + 1))
    return f"""{name} AS (SELECT p.image, p.y, p.x, CASE WHEN h.image IS NULL THEN {1 - of} ELSE {of} END AS m FROM {source} p LEFT JOIN
 (SELECT DISTINCT s.image, s.y + o.dy AS y, s.x + o.dx AS x FROM {source} s, (VALUES {offsets}) o(dy, dx) WHERE s.m = {of}) h ON p.image=h.image AND p.y=h.y AND p.x=h.x)"""


_COUNT = "SELECT image, CAST(sum(m) AS BIGINT) AS n, count(*) AS pixels FROM {0} GROUP BY image"


def _components(source: str, of: int = 1) -> str:
    return f"""on_ AS (SELECT image, y, x FROM {source} WHERE m = {of}),
reach AS (SELECT image, y, x, y*8+x+1 AS label FROM on_ UNION SELECT o.image, o.y, o.x, r.label FROM reach r JOIN on_ o ON o.image=r.image AND abs(o.y-r.y)<=1 AND abs(o.x-r.x)<=1),
lab AS (SELECT image, y, x, CAST(min(label) AS BIGINT) AS label FROM reach GROUP BY image, y, x),
st AS (SELECT image, label, min(x) AS x0, min(y) AS y0, max(x)-min(x)+1 AS w, max(y)-min(y)+1 AS h, count(*) AS area FROM lab GROUP BY image, label)"""


# a margin of 15 % of 8 pixels is 1 pixel, area limits are rounded half to even and 1 at least
_NEAR = "(x0 < 1 OR y0 < 1 OR 8-x0-w < 1 OR 8-y0-h < 1)"
_KEEP = {
    "min_area": "area >= 3",
    "frame": "NOT ((w/8.0 >= 0.65 OR h/8.0 >= 0.65) AND (x0 <= 2 OR y0 <= 2 OR x0+w >= 6 OR y0+h >= 6) AND CAST(area AS DOUBLE)/(w*h) <= 0.30)",
    "strip": "NOT (((y0 <= 1 OR y0+h >= 7) AND h/8.0 <= 0.16 AND w/8.0 >= 0.25) OR ((x0 <= 1 OR x0+w >= 7) AND w/8.0 <= 0.16 AND h/8.0 >= 0.25))",
    "small_edge": f"NOT (area < 3 AND {_NEAR})",
    "sparse": f"NOT ({_NEAR} AND area <= 10 AND CAST(area AS DOUBLE)/(w*h) <= 0.35)",
    "thin": "NOT (least(w,h) <= 1 AND greatest(w,h) >= 5*least(w,h) AND area <= 1)",
}

_N = "CAST(p_size AS VARCHAR)"
_FORMS = [f"'DAPI_0'||{_N}", f"'empty '||{_N}", "'CD20/MS4A1'", f"'Panel '||{_N}||': CD3D'", f"'Cycle '||{_N}||'_CD8R_AF488'", f"'Hoechst '||{_N}", f"{_N}||'_mKi67'", "'AGR2/016'", f"'vimentine (clone '||{_N}||')'", "'HEM'", "'control-488nm'", f"'C'||{_N}", f"'AF'||{_N}||'x'", f"'PanCytoKRT_ArgoFluor'||{_N}||'L'", "'ECAD-FITC'", f"'Dye '||{_N}", "'CD45 - leucocytes'", "'Sample AF'", f"'nucleus_'||{_N}", f"'cycle_01_channel_'||{_N}"]
_RAW = "raw AS (SELECT p_partkey, p_partkey % 50 AS image, CASE p_partkey % 20 " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(_FORMS)) + " END AS raw FROM part)"


def _normalize() -> str:
    spelled = "raw"
    for a, b in SPELLED.items():
        spelled = f"replace({spelled}, '{a}', '{b}')"
    out = [_RAW, f"n0 AS (SELECT p_partkey, image, raw, regexp_replace(trim({spelled}), '\\s+', ' ', 'g') AS t, CAST(NULL AS VARCHAR) AS r FROM raw)"]
    for i, (kind, pattern, value) in enumerate(STEPS):
        t, r = "t", "r"
        if kind == "end":
            r = f"CASE WHEN r IS NULL AND regexp_matches(t, '{pattern}') THEN '{value}' ELSE r END"
        elif kind == "sub":
            t = f"regexp_replace(t, '{pattern}', '{value}', 'g')"
        elif kind == "last":
            t = "trim(list_extract(string_split(t, ':'), -1))"
        else:
            t = "CASE WHEN contains(t, ' - ') AND regexp_matches(split_part(t, ' - ', 1), '[A-Za-z0-9]') THEN trim(split_part(t, ' - ', 1)) ELSE t END"
        out.append(f"n{i + 1} AS (SELECT p_partkey, image, raw, {t} AS t, {r} AS r FROM n{i})")
    names = ", ".join(f"('{a}','{b}')" for a, b in ALIASES.items())
    out.append(f"nz AS (SELECT p_partkey, image, raw, coalesce(r, al.v, t) AS marker FROM n{len(STEPS)} LEFT JOIN (VALUES {names}) al(k, v) ON al.k = regexp_replace(lower(t), '[^a-z0-9]+', '', 'g'))")
    out.append("reg(key, id) AS (VALUES ('unknown',0),('unmapped',0),('blank',1),('sampleaf',1),('sample',1),('dapi',2),('hoechst',2),('nuclei',2),('nuclearstain',2),('cd20',3),('vimentin',4),('cd3',5),('cd8',6),('ki67',7),('ecadherin',8))")
    out.append("lk AS (SELECT p_partkey, image, coalesce(id, 0) AS marker_id FROM nz LEFT JOIN reg ON reg.key = regexp_replace(lower(marker), '[^a-z0-9]+', '', 'g'))")
    return "WITH " + ",\n".join(out)


_L = _normalize()
_RANK = ", rk AS (SELECT image, p_partkey AS channel, CAST(row_number() OVER (PARTITION BY image ORDER BY CASE WHEN marker_id=0 THEN 1 ELSE 0 END, marker_id, p_partkey) AS INT) AS rank FROM lk) "
_PATHS = "p AS (SELECT page_id, url || CASE page_id % 4 WHEN 0 THEN '.ome.tif' WHEN 1 THEN '.ims' WHEN 2 THEN ' A.QPTIFF' ELSE '_ROI01.tiff' END AS path FROM pages), f AS (SELECT page_id, path, list_extract(string_split(path, '/'), -1) AS name FROM p)"
_STEM = f"WITH {_PATHS}, st AS (SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(name, '(?i)\\.(ome\\.)?(tif|tiff|qptiff|ims)$', ''), '[^A-Za-z0-9_.-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'sample') AS stem FROM f)"
_PAGES = "pg AS (SELECT user_id % 50 AS image, 256*(1+event_id%5) AS height, 256*(1+event_id%3) AS width, event_id, event_type FROM events)"
_SLIDES = "sl AS (SELECT p_partkey AS image, 100+p_size*7 AS width, 80+p_size*5 AS height, 0.1+p_size*CAST(0.01 AS DOUBLE) AS mpp, p_size%4 AS n FROM part)"
_OFFSETS = f"{_SLIDES}, o AS (SELECT image, CAST(sum(n) OVER (ORDER BY image) - n AS BIGINT) AS lo, CAST(sum(n) OVER (ORDER BY image) AS BIGINT) AS hi FROM sl WHERE n > 0)"
_LOG = {"percentile": "v", "log_percentile": "ln(1+greatest(v,0.0))"}

ORACLE_SQL: dict[str, str] = {
    "flagship_patch_coords": _M + _INT + """, g AS (SELECT image, y, x FROM (SELECT DISTINCT image FROM mk), (SELECT unnest(generate_series(0,4,2)) AS y), (SELECT unnest(generate_series(0,4,2)) AS x)),
 fr AS (SELECT g.image, g.y, g.x, (a.s - coalesce(b.s,0) - coalesce(c.s,0) + coalesce(d.s,0))/16.0 AS f FROM g JOIN ii a ON a.image=g.image AND a.y=g.y+3 AND a.x=g.x+3 LEFT JOIN ii b ON b.image=g.image AND b.y=g.y+3 AND b.x=g.x-1 LEFT JOIN ii c ON c.image=g.image AND c.y=g.y-1 AND c.x=g.x+3 LEFT JOIN ii d ON d.image=g.image AND d.y=g.y-1 AND d.x=g.x-1)
 SELECT image, CAST(row_number() OVER (PARTITION BY image ORDER BY y, x) - 1 AS INT) AS coord_index, CAST(x AS INT) AS x, CAST(y AS INT) AS y FROM fr WHERE f >= 0.1""",
    "plane_robust_u8": f"WITH {_U8} SELECT image, channel, y, x, u8 FROM u",
    **{f"fuse_{h}": f"WITH {_U8} {_fuse(h)}" for h in ("max", "median", "percentile")},
    "foreground_threshold": _M + " SELECT image, threshold FROM mk_t",
    "foreground_mask": _M + " SELECT image, y, x, m FROM mk",
    "integral_image": _M + _INT + " SELECT image, y, x, s FROM ii",
    "patch_grid": f"WITH {_SLIDES} SELECT image, CAST(gx AS INT) AS x, CAST(gy AS INT) AS y FROM (SELECT image, height, unnest(generate_series(0, greatest(0, width-64), 48)) AS gx FROM sl) a, LATERAL (SELECT unnest(generate_series(0, greatest(0, a.height-64), 48)) AS gy) b",
    "mask_runs": f"WITH {_PM}, i AS (SELECT image, y, x, x - row_number() OVER (PARTITION BY image, y ORDER BY x) AS g FROM pm WHERE m=1) SELECT image, y, min(x) AS x0, max(x)+1 AS x1 FROM i GROUP BY image, y, g",
    "dilate_disc": f"WITH {_PM}, {_dilated('d', 'pm', 2)} " + _COUNT.format("d"),
    "erode_disc": f"WITH {_PM}, {_dilated('d', 'pm', 1, 0)} " + _COUNT.format("d"),
    "close_open": f"WITH {_PM}, {_dilated('a', 'pm', 1)}, {_dilated('b', 'a', 1, 0)}, {_dilated('c', 'b', 1, 0)}, {_dilated('d', 'c', 1)} " + _COUNT.format("d"),
    "component_stats": f"WITH RECURSIVE {_PM}, {_components('pm')} SELECT * FROM st",
    **{f"{k}_filter": f"WITH RECURSIVE {_PM}, {_components('pm')} SELECT image, label, area FROM st WHERE {w}" for k, w in _KEEP.items()},
    "bounded_hole_fill": f"WITH RECURSIVE {_PM}, {_components('pm', 0)}, inner_ AS (SELECT image, label FROM st WHERE x0>0 AND y0>0 AND x0+w<8 AND y0+h<8 AND area<=1), d AS (SELECT pm.image, pm.y, pm.x, CASE WHEN i.label IS NOT NULL THEN 1 ELSE m END AS m FROM pm LEFT JOIN lab ON lab.image=pm.image AND lab.y=pm.y AND lab.x=pm.x LEFT JOIN inner_ i ON i.image=lab.image AND i.label=lab.label) " + _COUNT.format("d"),
    "exclude_force_rect": _M + " SELECT image, y, x, CASE WHEN x>=4 AND y<2 THEN 1 WHEN x<4 AND y<4 THEN 0 ELSE m END AS m FROM mk",
    "polygon_fill": _M
    + """, e(ax, ay, cx, cy) AS (VALUES (1,1,7,2), (7,2,4,4), (4,4,6,7), (6,7,2,6), (2,6,1,1)),
 w AS (SELECT image, y, x, m, sum(CAST((ay > y) <> (cy > y) AND x < ax + (cx-ax)*(y-ay)/CAST(cy-ay AS DOUBLE) AS INT)) AS crossings, bool_or((cx-ax)*(y-ay) = (cy-ay)*(x-ax) AND x BETWEEN least(ax,cx) AND greatest(ax,cx) AND y BETWEEN least(ay,cy) AND greatest(ay,cy)) AS on_edge FROM mk, e GROUP BY image, y, x, m)
 SELECT image, y, x, CASE WHEN on_edge OR crossings % 2 = 1 THEN 1 ELSE m END AS m FROM w""",
    "support_recovery": f"WITH {_U8}, {_mask('a', 'percentile', 0.55)}, {_mask('b', 'max', 0.7)}, {_dilated('d', 'a', 1)} SELECT a.image, a.y, a.x, greatest(a.m, b.m*d.m) AS m FROM a JOIN b ON a.image=b.image AND a.y=b.y AND a.x=b.x JOIN d ON a.image=d.image AND a.y=d.y AND a.x=d.x",
    "region_replace": f"WITH {_U8}, {_mask('a', 'percentile', 0.55)}, {_mask('b', 'max', 0.7)} SELECT a.image, a.y, a.x, CASE WHEN a.x>=2 AND a.x<6 AND a.y>=1 THEN b.m ELSE a.m END AS m FROM a JOIN b ON a.image=b.image AND a.y=b.y AND a.x=b.x",
    "mask_set_ops": f"WITH {_U8}, {_mask('a', 'percentile', 0.55)}, {_mask('b', 'max', 0.7)} SELECT a.image, CAST(sum(greatest(a.m,b.m)) AS BIGINT) AS either, CAST(sum(a.m*b.m) AS BIGINT) AS both, CAST(sum(a.m*(1-b.m)) AS BIGINT) AS only_a FROM a JOIN b ON a.image=b.image AND a.y=b.y AND a.x=b.x GROUP BY a.image",
    "z_projection": f"WITH {_PX} SELECT image, channel % 3 AS z, y, x, max(v) AS v_max, round(avg(v), 9) AS v_mean FROM px GROUP BY image, channel % 3, y, x",
    "marker_normalize": _L + " SELECT p_partkey, marker FROM nz",
    "marker_lookup": _L + " SELECT p_partkey, marker_id FROM lk",
    "marker_counts": _L + " SELECT marker_id, count(*) AS n FROM lk GROUP BY marker_id",
    "technical_channels": f"WITH {_RAW}, k AS (SELECT p_partkey, image, CAST(NOT regexp_matches(lower(raw), '{TECHNICAL}') AS INT) AS k FROM raw), a AS (SELECT p_partkey, k, max(k) OVER (PARTITION BY image) AS any_ FROM k) SELECT p_partkey FROM a WHERE k=1 OR any_=0",
    "nucleus_channels": f"WITH {_RAW} SELECT p_partkey FROM raw WHERE regexp_matches(lower(raw), '{NUCLEUS}')",
    "artifact_stem": _STEM + " SELECT page_id, stem FROM st",
    "reader_type": f"WITH {_PATHS} SELECT page_id, CASE WHEN lower(path) LIKE '%.ims' THEN 'ims' WHEN lower(path) LIKE '%.qptiff' THEN 'qptiff' ELSE 'tiff' END AS kind FROM p",
    "name_filters": f"WITH {_PATHS} SELECT page_id FROM f WHERE NOT regexp_matches(name, 'A\\.QPTIFF$') AND NOT regexp_matches(name, '(?i)(^|[_-])ROI\\d+')",
    "duplicate_stems": _STEM + " SELECT stem, count(*) AS n FROM st GROUP BY stem HAVING count(*) > 1",
    "qc_semi": "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
    "qc_anti": "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
    "manifest_merge": """WITH up AS (SELECT l_orderkey + CASE WHEN l_orderkey%9=0 THEN 100000000 ELSE 0 END AS path, l_orderkey*10+l_linenumber AS ord, max(l_partkey) AS n FROM lineitem WHERE l_linenumber<=2 AND l_orderkey%3=0 GROUP BY 1, 2),
 last_ AS (SELECT path, arg_max(n, ord) AS n, min(ord) AS ord FROM up GROUP BY path) SELECT coalesce(b.o_orderkey, u.path) AS path, coalesce(b.o_orderkey, u.ord) AS ord, b.o_orderkey IS NULL AS new, coalesce(u.n, 0) AS n FROM orders b FULL JOIN last_ u ON b.o_orderkey = u.path""",
    "profile_overlay": """SELECT p_partkey, CASE p_partkey%3 WHEN 0 THEN 'fluorescence-artifact-strict' WHEN 1 THEN 'fluorescence-recall' ELSE 'none' END AS profile,
 CAST(CASE WHEN p_size>25 THEN 55.0 WHEN p_partkey%3=0 THEN 70.0 WHEN p_partkey%3=1 THEN 35.0 END AS DOUBLE) AS threshold_percentile, CAST(CASE p_partkey%3 WHEN 0 THEN 12.0 WHEN 1 THEN 5.0 END AS DOUBLE) AS min_signal FROM part""",
    "integrity_report": f"WITH {_PAGES}, i AS (SELECT image, max(CAST(event_type='purchase' AND event_id%40=0 AS INT)) AS bad FROM pg GROUP BY image) SELECT count(*) AS total, count(*) FILTER (WHERE bad=0) AS passed, count(*) FILTER (WHERE bad=1) AS failed FROM i",
    "page_groups": f"WITH {_PAGES} SELECT image, height, width, count(*) AS pages FROM pg GROUP BY image, height, width",
    "level_choice": f"WITH {_PAGES}, l AS (SELECT DISTINCT image, height, width, greatest(height,width) AS e FROM pg), r AS (SELECT image, height, width, row_number() OVER (PARTITION BY image ORDER BY CASE WHEN e<=700 THEN 0 ELSE 1 END, CASE WHEN e<=700 THEN -e ELSE e END, height, width) AS n FROM l) SELECT image, height, width FROM r WHERE n=1",
    "mag_mpp": f"WITH {_SLIDES}, m AS (SELECT image, CAST(round_even(10.0/mpp, 0) AS INT) AS mag FROM sl) SELECT image, mag, round(CAST(10.0 AS DOUBLE)/mag, 9) AS mpp FROM m",
    "channel_order": _L + _RANK + "SELECT image, channel, rank FROM rk",
    "top_channels": _L + _RANK + "SELECT image, channel FROM rk WHERE rank <= 3",
    "coord_offsets": f"WITH {_OFFSETS} SELECT image, lo, hi FROM o",
    "index_to_entry": f"WITH {_OFFSETS}, q AS (SELECT DISTINCT image*3%500 AS idx FROM sl) SELECT idx, image, idx - lo AS local FROM q JOIN o ON idx >= lo AND idx < hi",
    "token_masks": "SELECT p_partkey AS image, CAST(token AS INT) AS token, CAST('0x' || substr(md5('7-' || CAST(p_partkey AS VARCHAR) || '-' || CAST(token AS VARCHAR)), 1, 7) AS BIGINT) < 134217728 AS masked FROM part, (SELECT unnest(generate_series(0,3)) AS token) t",
    "collate_pad": _L + ", s AS (SELECT image, list_sort(list(marker_id)) AS ids FROM lk GROUP BY image) SELECT image, array_to_string(list_slice(list_concat(ids, [-1,-1,-1,-1,-1,-1,-1,-1,-1,-1,-1,-1]), 1, 12), ',') AS padded, least(len(ids), 12) AS valid FROM s",
    "patch_normalize_uint": f"WITH {_PX}, t AS (SELECT image, channel, max(v) AS top FROM px GROUP BY image, channel) SELECT px.image, px.channel, y, x, round(v/CASE WHEN top=0 THEN 1.0 ELSE top END, 6) AS norm FROM px JOIN t ON px.image=t.image AND px.channel=t.channel",
    **{f"patch_normalize_{m}": f"WITH {_PX}, w AS (SELECT image, channel, y, x, {e} AS t FROM px), l AS (SELECT image, channel, quantile_cont(t,0.01) AS lo, quantile_cont(t,0.995) AS hi FROM w GROUP BY image, channel) SELECT w.image, w.channel, y, x, round(CASE WHEN hi<=lo THEN 0.0 ELSE greatest(0.0, least(1.0, (t-lo)/(hi-lo))) END, 6) AS norm FROM w JOIN l ON w.image=l.image AND w.channel=l.channel" for m, e in _LOG.items()},
}
