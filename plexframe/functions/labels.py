"""Channel labels to markers: normalisation, keys, registry lookup, channel predicates, file stems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that are spelled out first.
SPELLED = {"α": "a", "β": "beta", "γ": "gamma", "δ": "delta", "：": ":", "‑": "-", "–": "-", "—": "-"}

#: Steps in their order. "sub": replace what matches; "end": a label that matches is final with this value;
#: "last": keep what follows the last colon; "head": keep what stands before the first " - " if it has a letter or digit.
STEPS = [
    ("end", r"(?i)^(empty|blank|background)\b", "blank"),
    ("sub", r"(?i)^Panel\s*\d+\s*:?\s*", ""),
    ("sub", r"(?i)^Panel\s*:?\s*", ""),
    ("last", ":", ""),
    ("sub", r"(?i)^Hoechst\s*\d+$", "Hoechst"),
    ("head", " - ", ""),
    ("sub", r"(?i)^Cycle\s*\d+[_\s-]*", ""),
    ("sub", r"^\d+\s*[_-]\s*", ""),
    ("sub", r"/\d{3}$", ""),
    ("sub", r"-+$", ""),
    ("sub", r"^\s+|\s+$", ""),
    ("end", r"(?i)^(DAPI|DNA)[\s_-]*\d+$", "DAPI"),
    ("end", r"(?i)^Hoech(st|est)[\s_-]*\d+$", "Hoechst"),
    ("end", r"(?i)^HEM$", "Nuclei"),
    ("end", r"(?i)^(blank|empty)\s*\d*[A-Za-z]*$", "blank"),
    ("end", r"(?i)^(control[-\s]*\d+nm|A(488|555|647)|anti[-\s]*(goat|mouse|rabbit))$", "blank"),
    ("end", r"(?i)^(C\d+|cycle[_\s]*\d+[_\s]*channel[_\s]*\d+)$", "unmapped"),
    ("end", r"(?i)^AF\d+[A-Za-z]*$", "blank"),
    ("sub", r"(?i)[_\s-]*Argo(Fluor)?\d+[A-Za-z]*$", ""),
    ("sub", r"(?i)[_\s-]*(AF|DL|BL)\d+[A-Za-z]*$", ""),
    ("sub", r"(?i)[_\s-]*(FITC|PE|APC|Cy\d+)$", ""),
    ("sub", r"\s*\([^)]*\)\s*$", ""),
    ("sub", r"_", " "),
    ("sub", r"^\s+|\s+$", ""),
    ("sub", r"-+$", ""),
    ("sub", r"^\s+|\s+$", ""),
    ("sub", r"\s+", " "),
]

#: Spellings of one marker, by lower-case letters and digits.
ALIASES = {
    "androgenreceptor": "AR", "antigenki67": "Ki67", "aorticsmoothmuscleactin": "aSMA", "alphasma": "aSMA", "cd20ms4a1": "CD20", "ms4a1": "CD20", "cd279": "PD-1", "cd3d": "CD3", "cd8r": "CD8",
    "cdh1": "E-Cadherin", "ecad": "E-Cadherin", "ck14": "Keratin14", "ck5": "Keratin5", "ck17": "Keratin 17", "ck19": "Keratin 19", "ck8": "Keratin8", "krt18": "Keratin 18", "ck18": "Keratin 18",
    "coliv": "Collagen IV", "cox2ptgs2": "COX2", "epidermalgrowthfactorreceptor": "EGFR", "grnzb": "GZMB", "grzb": "GZMB", "grzb001": "GZMB", "granb": "GZMB", "h2ax": "H2AX", "gh2ax": "H2AX",
    "histoneh2ax": "H2AX", "hif1a": "HIF1A", "her2": "HER2", "ido": "IDO1", "krt": "Cytokeratin", "lamac": "LaminA", "laminac": "LaminA", "laminabc": "LaminA", "mki67": "Ki67", "mlna": "Melan A",
    "nestin": "Nestin", "olig1": "OLIG1", "p16": "P16", "p21": "P21", "pdpn": "Podoplanin", "pancytokrt": "Cytokeratin", "pankrt": "Cytokeratin", "synaphysin": "Synaptophysin", "tmem173": "STING",
    "vim": "Vimentin", "vimentine": "Vimentin", "ckit": "CD117", "pstat3": "pSTAT3", "prnapoliictd": "RNA polymerase II CTD",
}

TECHNICAL = r"(^|[_\s-])af\d*($|[_\s-])|autofluorescence|blank|control"
NUCLEUS = r"nucleus|hoechst|dapi|dna"


def normalize_labels(df: DataFrame, raw: str, out: str) -> DataFrame:
    """Adds the normalised label; Python's Unicode white space and digits are matched, null gives ''."""
    text = F.coalesce(F.col(raw).cast("string"), F.lit(""))
    for a, b in SPELLED.items():
        text = F.replace(text, F.lit(a), F.lit(b))
    clean = F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " ")
    # each step reads its text through a lambda variable, so the expression grows by a step, not by a factor
    state = F.array(F.struct(clean.alias("t"), F.lit(None).cast("string").alias("r")))
    for kind, pattern, value in STEPS:
        state = F.transform(state, _then(kind, pattern, value))
    known = F.create_map(*(F.lit(x) for pair in ALIASES.items() for x in pair))
    last = F.transform(state, lambda s: F.coalesce(s["r"], F.try_element_at(known, key_of(s["t"])), s["t"]))
    return df.withColumn(out, F.get(last, F.lit(0)))


def _then(kind: str, pattern: str, value: str):
    return lambda s: _step(s, kind, pattern, value)


def _step(s: Column, kind: str, pattern: str, value: str) -> Column:
    """One of STEPS on the struct (t: text so far, r: final value or null)."""
    t, r = s["t"], s["r"]
    wide = pattern.replace("(?i)", "(?iU)") if pattern.startswith("(?i)") else f"(?U){pattern}"
    if kind == "end":
        r = F.when(r.isNull() & t.rlike(wide), value).otherwise(r)
    elif kind == "sub":
        t = F.regexp_replace(t, wide, value)
    elif kind == "last":
        t = F.trim(F.element_at(F.split(t, pattern, -1), -1))
    else:
        head = F.trim(F.split_part(t, F.lit(pattern), F.lit(1)))
        t = F.when(F.contains(t, F.lit(pattern)) & head.rlike("[A-Za-z0-9]"), head).otherwise(t)
    return F.struct(t.alias("t"), r.alias("r"))


def key_of(label: Column) -> Column:
    return F.regexp_replace(F.lower(label), "[^a-z0-9]+", "")


def registry_keys(markers: DataFrame) -> DataFrame:
    """(key, marker_id) of a registry given as (marker_id, name, aliases array, ord); of equal keys the last wins."""
    # a registry has a few hundred rows; the exchange keeps the steps from being folded into one literal expression
    names = markers.repartition(1).select("marker_id", "ord", F.posexplode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("pos", "label"))
    keyed = normalize_labels(names, "label", "label").withColumn("key", key_of(F.col("label"))).where("key <> ''")
    return keyed.groupBy("key").agg(F.max_by("marker_id", F.struct("ord", "pos")).alias("marker_id"))


def append_auto(markers: DataFrame, auto: DataFrame) -> DataFrame:
    """The registry (marker_id, name, aliases, ord) with automatic entries (ord, name, aliases array) whose key is new: ids go on from the largest one.

    An entry is left out if its key is known, from the registry or from the name or an alias of an earlier entry that is kept.
    A registry has a few hundred entries, so they are walked in order on the driver."""
    rows = normalize_labels(auto.select("ord", "name", F.posexplode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("pos", "label"), "aliases"), "label", "label")
    rows = rows.withColumn("key", key_of(F.col("label"))).orderBy("ord", "pos").collect()
    known, top = {r.key for r in registry_keys(markers).collect()}, markers.agg(F.max("marker_id")).first()[0]
    fresh, next_id, taken = [], (-1 if top is None else top) + 1, False
    for r in rows:
        if r.pos == 0:
            taken = bool(r.key) and r.key not in known
            if taken:
                fresh.append((next_id, r.name, list(r.aliases or []), (1 << 30) + r.ord))
                next_id += 1
        if taken and r.key:
            known.add(r.key)
    new = markers.sparkSession.createDataFrame(fresh, "marker_id int, name string, aliases array<string>, ord int")
    return markers.select("marker_id", "name", "aliases", "ord").unionByName(new)


def lookup_markers(df: DataFrame, raw: str, keys: DataFrame, unknown: int = 0) -> DataFrame:
    """Adds marker and marker_id; keys is a registry's table of at most a few hundred rows.

    Distinct labels are normalised once and joined back. A label that isn't found is looked up again without signs but - and /."""
    names = df.select(F.col(raw).alias("_raw")).distinct()
    names = normalize_labels(names, "_raw", "marker").withColumn("_key", key_of(F.col("marker")))
    again = normalize_labels(names.withColumn("_c", F.regexp_replace("marker", "[^A-Za-z0-9/-]+", "")), "_c", "_again").withColumn("_key2", key_of(F.col("_again")))
    ids = lambda key, name: F.broadcast(keys.select(F.col("key").alias(key), F.col("marker_id").alias(name)))
    found = again.join(ids("_k1", "_id1"), (F.col("_key") == F.col("_k1")) & (F.col("_key") != ""), "left").join(ids("_k2", "_id2"), (F.col("_key2") == F.col("_k2")) & (F.col("_key") != ""), "left")
    found = found.select("_raw", "marker", F.coalesce("_id1", "_id2", F.lit(unknown)).alias("marker_id"))
    return df.join(found, F.col(raw).eqNullSafe(F.col("_raw"))).drop("_raw")


def marker_names(df: DataFrame, registry: DataFrame, id_: str = "marker_id", out: str = "marker_name") -> DataFrame:
    """Adds the name of each id, Unknown for ids that the registry doesn't have; of entries with one id the last is right."""
    names = registry.groupBy("marker_id").agg(F.max_by("name", "ord").alias("_name")).withColumnRenamed("marker_id", "_id")
    return df.join(F.broadcast(names), F.col(id_) == F.col("_id"), "left").withColumn(out, F.coalesce("_name", F.lit("Unknown"))).drop("_id", "_name")


def read_registry(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, int, int]:
    """(markers, automatic entries, unknown id, blank id) of a registry file; automatic entries are names or objects."""
    schema = "unknown_marker_id int, blank_marker_id int, markers array<struct<id: int, name: string, aliases: array<string>>>, auto_markers array<string>"
    x = spark.read.option("multiLine", True).schema(schema).json(path)
    ids = x.select(F.coalesce("unknown_marker_id", F.lit(0)), F.coalesce("blank_marker_id", F.lit(1))).first()
    none = F.array().cast("array<string>")
    markers = x.select(F.posexplode("markers").alias("ord", "m")).select(F.col("m.id").alias("marker_id"), F.col("m.name").alias("name"), F.coalesce("m.aliases", none).alias("aliases"), "ord")
    row = F.from_json("a", "name string, aliases array<string>")
    auto = x.select(F.posexplode("auto_markers").alias("ord", "a")).select("ord", F.coalesce(F.when(F.col("a").startswith("{"), row["name"]), F.col("a")).alias("name"), F.coalesce(F.when(F.col("a").startswith("{"), row["aliases"]), none).alias("aliases"))
    return markers, auto, ids[0], ids[1]


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def safe_stem(path: Column) -> Column:
    stem = F.regexp_replace(file_name(path), r"(?i)\.(ome\.)?(tif|tiff|qptiff|ims)$", "")
    stem = F.regexp_replace(F.regexp_replace(stem, r"[^A-Za-z0-9_.-]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(stem, F.lit("")), F.lit("sample"))


def reader_type(path: Column) -> Column:
    low = F.lower(path)
    return F.when(low.endswith(".ims"), "ims").when(low.endswith(".qptiff"), "qptiff").otherwise("tiff")
