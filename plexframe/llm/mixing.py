"""Mixing sources to target weights.

Every row gets a hash-random key. The key's range is cut into buckets of about `BUCKET_ROWS` rows for
each source (a source with a third of all rows has a third of the buckets), rows are sorted within
buckets, and running sums of sizes come from prefix sums over bucket totals plus a running sum inside
each bucket. A source whose target is e times its size is taken whole floor(e) times; the next epoch is
cut at exactly the words that are left, inside the row on which the budget falls.

Defined results: a null or empty text has size 0 and is taken 0 words; a null source is a source of its
own, last; rows equal in key and id are ordered by size and then share alike; a source without words
has target 0; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexframe.llm import kit

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating, and the most epochs of a source.
WEIGHTS = (1.0, 2.0, 3.0)
MOST_EPOCHS = 3
BUCKET_ROWS = 50_000
#: Rows of a bucket when texts are mixed: the texts of one bucket of each source are shuffled.
EDGE_ROWS = 512
SEED = 11


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """source, rows, source_size, target from one row for each source (source, rows, source_size).

    Resharing the excess until no target is above its limit ends where every source has
    min(weight * level, limit) for one level. With sources in the order of limit / weight, the level is
    (total - limits of those before) / (weights of the others) at the first source whose limit reaches it.
    """
    one = Window.partitionBy(F.lit(0))
    order = one.orderBy(F.col("source").isNull(), F.col("source"))
    x = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    x = x.withColumn("cap", (most * F.col("source_size")).cast("double")).withColumn("total", F.sum("source_size").over(one).cast("double"))
    by_ratio = one.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    x = x.withColumn("level", (F.col("total") - before) / rest)
    x = x.withColumn("open", F.col("cap") >= F.col("w") * F.col("level"))
    x = x.withColumn("at", F.min(F.when(F.col("open"), F.col("cap") / F.col("w"))).over(one))
    x = x.withColumn("final", F.max(F.when(F.col("open") & (F.col("cap") / F.col("w") == F.col("at")), F.col("level"))).over(one))
    return x.select("source", "rows", "source_size", F.least("cap", F.col("w") * F.coalesce("final", F.lit(0.0))).alias("target"))


def _bucket(key: Column, parts: Column) -> Column:
    """The key's range in equal parts: key / 2**64 + 1/2 is uniform on [0, 1)."""
    return F.least(F.floor((key / F.lit(float(1 << 64)) + 0.5) * parts), parts - 1).cast("long")


def _parts(bucket_rows: int) -> Column:
    return F.greatest(F.ceil(F.col("_rows") / F.lit(bucket_rows)), F.lit(1))


def _epochs() -> tuple[Column, Column]:
    """(whole copies, words left of the budget) of a source; the budget is in whole words."""
    budget = F.rint("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    return full, budget - full * F.col("source_size")


def mix(rows: DataFrame, key: str, source: str, size: str, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """rows with source_size, target, epochs (whole copies), cut (words of one more, partial or whole copy) and taken."""
    x = rows.drop("source_size", "target", "epochs", "cut", "taken").withColumn("_s", F.col(f"`{source}`")).withColumn("_z", F.col(f"`{size}`").cast("long"))
    x = x.withColumn("_k", F.xxhash64(F.lit(seed), F.col(f"`{key}`").cast("string")))
    sizes = x.groupBy(F.col("_s").alias("source")).agg(F.count(F.lit(1)).alias("rows"), F.sum("_z").alias("source_size"))
    goal = targets(sizes, weights, most).withColumnsRenamed({"source": "_g", "rows": "_rows"})
    x = x.join(goal, F.col("_s").eqNullSafe(F.col("_g"))).drop("_g")
    x = x.withColumn("_b", _bucket(F.col("_k"), _parts(bucket_rows)))
    sums = x.groupBy("_s", "_b").agg(F.sum("_z").alias("_t"))
    through = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_s").alias("_s2"), F.col("_b").alias("_b2"), F.coalesce(F.sum("_t").over(through), F.lit(0)).alias("_before"))
    x = x.join(sums, F.col("_s").eqNullSafe(F.col("_s2")) & (F.col("_b") == F.col("_b2"))).drop("_s2", "_b2")
    inside = Window.partitionBy("_s", "_b").orderBy("_k", F.col(f"`{key}`"), "_z").rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_z").over(inside), F.lit(0)))
    full, left = _epochs()
    x = x.withColumn("epochs", full)
    x = x.withColumn("cut", F.greatest(F.lit(0), F.least(F.col("_z"), left - F.col("_before"))).cast("long"))
    return x.withColumn("taken", F.col("epochs") * F.col("_z") + F.col("cut")).drop("_s", "_z", "_k", "_b", "_before", "_rows")


def sized(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def mix_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: int = SEED, bucket_rows: int = EDGE_ROWS) -> DataFrame:
    """The mix itself: a row with its columns for each copy taken; the row on which a budget falls keeps its first words.

    Of each source one bucket holds the key at which the budget ends: rows of buckets before it are taken whole, rows of
    those after it are not, as their keys alone say, and only rows of that bucket are ranked and joined. Rows equal in
    key, source and text share what that bucket gives them evenly, rounded up.
    """
    place = F.xxhash64(F.lit(seed), F.col(f"`{key}`").cast("string"), F.xxhash64(F.col(f"`{text}`").cast("string")))
    src = F.col(f"`{source}`")
    narrow, narrow_path = kit.keep(docs.select(src.alias("_s"), place.alias("_k"), sized(text).alias("_z")), "sizes")
    sizes = narrow.groupBy(F.col("_s").alias("source")).agg(F.count(F.lit(1)).alias("rows"), F.sum("_z").alias("source_size"))
    full, left = _epochs()
    goal = targets(sizes, weights, most).withColumnRenamed("rows", "_rows")
    goal, goal_path = kit.keep(goal.select(F.col("source").alias("_g"), _parts(bucket_rows).alias("_parts"), full.cast("int").alias("_e"), left.alias("_left")), "goals")
    bucketed = narrow.join(goal, F.col("_s").eqNullSafe(F.col("_g"))).withColumn("_b", _bucket(F.col("_k"), F.col("_parts")))
    sums = bucketed.groupBy("_g", "_left", "_b").agg(F.sum("_z").alias("_t"))
    before = F.coalesce(F.sum("_t").over(Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edges = sums.withColumn("_before", before).where("_before <= _left and _left < _before + _t").select(F.col("_g").alias("_g2"), F.col("_b").alias("_edge"), "_before")
    edges, edges_path = kit.keep(edges, "edges")
    goal = goal.join(edges, F.col("_g").eqNullSafe(F.col("_g2")), "left").select("_g", "_parts", "_e", "_left", F.coalesce("_edge", F.col("_parts") + 1).alias("_edge"), F.coalesce("_before", F.lit(0)).alias("_before"))
    goal, _ = kit.keep(goal, "plan")

    ranked = narrow.join(goal, F.col("_s").eqNullSafe(F.col("_g"))).where(_bucket(F.col("_k"), F.col("_parts")) == F.col("_edge"))
    ranked = ranked.groupBy("_g", "_k", "_z", "_left", "_before").agg(F.count(F.lit(1)).alias("_m"))
    earlier = F.coalesce(F.sum(F.col("_z") * F.col("_m")).over(Window.partitionBy("_g").orderBy("_k", "_z").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    given = F.greatest(F.lit(0), F.least(F.col("_z") * F.col("_m"), F.col("_left") - F.col("_before") - earlier))
    ranked = ranked.withColumn("_c", F.ceil(given / F.col("_m")).cast("int")).select(F.col("_g").alias("_g2"), F.col("_k").alias("_k2"), F.col("_z").alias("_n"), "_c").where("_c > 0")
    ranked, _ = kit.keep(ranked, "cuts")
    for path in (narrow_path, goal_path, edges_path):
        kit.remove(docs.sparkSession, path)

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), src.alias("_s"), place.alias("_k"))
    rows = rows.join(goal, F.col("_s").eqNullSafe(F.col("_g"))).withColumn("_b", _bucket(F.col("_k"), F.col("_parts")))
    none = F.lit(None).cast("int")
    inner = rows.where("_b <> _edge").select("_row", none.alias("_n"), none.alias("_c"), F.array_repeat(F.lit(True), F.col("_e") + (F.col("_b") < F.col("_edge")).cast("int")).alias("_copies"))
    cut = rows.where("_b = _edge").join(ranked, F.col("_s").eqNullSafe(F.col("_g2")) & (F.col("_k") == F.col("_k2")), "left")
    cut = cut.select("_row", F.col("_n").cast("int").alias("_n"), "_c", F.concat(F.array_repeat(F.lit(True), F.col("_e")), F.when(F.col("_c") > 0, F.array(F.lit(False))).otherwise(F.array().cast("array<boolean>"))).alias("_copies"))
    x = inner.unionByName(cut).select("_row", "_n", "_c", F.explode("_copies").alias("_whole"))
    whole = F.col("_whole") | (F.col("_c") >= F.col("_n"))
    out = {c: F.col("_row").getField(c) for c in docs.columns}
    out[text] = F.when(whole, out[text]).otherwise(_first_words(out[text], F.col("_c")))
    if "n_chars" in out and docs.schema["n_chars"].dataType.simpleString() == "bigint":
        out["n_chars"] = F.when(whole, out["n_chars"]).otherwise(F.char_length(out[text]).cast("long"))
    return x.select(*(c.alias(n) for n, c in out.items()))


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    pieces = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    return F.array_join(F.slice(pieces, F.lit(1), n), "")
