"""Connected components of a table of links, by contraction.

In each round every node looks at its neighbours' numbers and points to the least; links are redrawn
between what their ends point to, and links from a node to itself are dropped. With numbers that are
hashes, a round leaves a fraction of the nodes, so rounds grow with the logarithm of the input. A node
with very many links is no hot spot: minima are taken before the shuffle, and the joins that redraw
links have plain exchanges on the side of the links, which Spark splits when they are skewed. When no more
than `SMALL` links are left, the driver joins them at once, whatever the input's size was.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexframe.llm import kit

#: Links that the driver joins itself: 1 MB.
SMALL = 1 << 16


def _joined(edges: DataFrame) -> DataFrame:
    """components() of a few links."""
    links = edges.toArrow()
    ids, at = np.unique(np.concatenate([links["a"].to_numpy(), links["b"].to_numpy()]), return_inverse=True)
    up = list(range(len(ids)))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for x, y in at.reshape(2, -1).T.tolist():
        x, y = top(x), top(y)
        up[max(x, y)] = min(x, y)
    roots = ids[[top(x) for x in range(len(ids))]] if len(ids) else ids
    return edges.sparkSession.createDataFrame(pa.table({"id": pa.array(ids, pa.int64()), "root": pa.array(roots, pa.int64())}))


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every id that stands in links(a, b); root is the same for all of a component and one of its ids."""
    spark = links.sparkSession
    edges, old = kit.keep(links.where("a <> b").select("a", "b").distinct(), "links")
    if edges.count() <= SMALL:
        labels = _joined(edges)
        kit.remove(spark, old)
        return labels
    labels, old_labels = kit.keep(edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().withColumn("root", F.col("id")), "labels")
    while edges.count() > SMALL:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hop = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        hop, old_hop = kit.keep(hop, "hop")
        labels, new_labels = kit.keep(labels.join(hop, F.col("root") == F.col("n"), "left").select("id", F.coalesce("m", "root").alias("root")), "labels")
        redrawn = edges.join(hop, F.col("a") == F.col("n")).select(F.col("m").alias("a"), "b")
        redrawn = redrawn.join(hop, F.col("b") == F.col("n")).select("a", F.col("m").alias("b"))
        edges, new = kit.keep(redrawn.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        for path in (old, old_labels, old_hop):
            kit.remove(spark, path)
        old, old_labels = new, new_labels
    rest = _joined(edges).select(F.col("id").alias("n"), F.col("root").alias("m"))
    out, _ = kit.keep(labels.join(F.broadcast(rest), F.col("root") == F.col("n"), "left").select("id", F.coalesce("m", "root").alias("root")), "labels")
    kit.remove(spark, old), kit.remove(spark, old_labels)
    return out


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (id, root) with more links (a, b): what those join is contracted, the rest stays."""
    known = labels.select(F.col("id").alias("l"), "root")
    ends = links.select("a", "b").join(known, F.col("a") == F.col("l"), "left").select("a", "b", F.coalesce("root", "a").alias("x"))
    ends = ends.join(known, F.col("b") == F.col("l"), "left").select("a", "b", "x", F.coalesce("root", "b").alias("y"))
    ends, path = kit.keep(ends, "ends")
    joined = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b"))).select(F.col("id").alias("r"), F.col("root").alias("to"))
    fresh = ends.select(F.col("a").alias("id")).union(ends.select("b")).distinct().join(labels, "id", "left_anti").select("id", F.col("id").alias("root"))
    out, _ = kit.keep(labels.union(fresh).join(joined, F.col("root") == F.col("r"), "left").select("id", F.coalesce("to", "root").alias("root")), "labels")
    kit.remove(labels.sparkSession, path)
    return out
