"""From keys that several items share to groups of linked items.

Items that share a key are candidates. Up to `ALL_PAIRS` items under a key are paired with each other.
More are each paired with the first of them, which joins large groups of copies without writing their
pairs. Then, of keys whose items are still in several components, the items meet in tasks, in tiles of
`TILE` by `TILE` items, and all pairs between different components are looked at there; only what passes
an exact bound, or is a link, is written. So no link between two items is lost, and components are exact.

Pairs that pass a bound but are no links may be as many as the square of a group. If links can't be told in the
task, its last look hence writes a forest of what passes, which has the same components, and the items of each of these
families meet once more, with their whole bodies, in smaller tiles; a forest of their links is written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexframe.llm import kit
from plexframe.llm.components import components, merged

ALL_PAIRS = 4
#: Items on a side of a tile.
TILE = 1024
#: The same where whole bodies meet.
FAMILY_TILE = 256
#: Entries that pair_up() takes, if it isn't told other types: key within the part, item, size.
ENTRY = ["u4", "u8", "u4"]
#: A size of one byte counts powers of this.
STEP = 1.05

#: What apart() gets: items of a key with their components and payloads, tile by tile.
MET = "key long, i int, j int, chunk int, id long, n long, root long, body binary"
#: Looks at the items of one tile (n, root, chunk, bodies): places (a, b) of pairs to hand on.
Then = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
Look = Callable[[np.ndarray, np.ndarray, np.ndarray, list], tuple[np.ndarray, np.ndarray]]


def pair_up(table: pa.Table, percent: int, entry: list[str] = ENTRY, most: int = ALL_PAIRS) -> pa.Table:
    """Candidate pairs of one part of the blocks of ENTRY; kind 1: entries of keys with more than `most` items.

    Items whose sizes differ too much for the similarity are not paired. Of hot keys that the same items share, one is enough."""
    x = kit.unblock(table, entry)
    part = int(table.column("part")[0].as_py()) if len(table) else 0
    order = np.argsort(x["f0"].astype(np.uint64) << np.uint64(32) | x["f1"] >> np.uint64(32))
    key = x["f0"][order]
    again = np.zeros(len(key), bool)
    again[1:] = key[1:] == key[:-1]
    again[:-1] |= again[1:]  # keys of one entry pair nothing
    order, key = order[again], key[again]
    sid, n = x["f1"][order], x["f2"][order]
    n = n.astype(np.int64) if entry[2] != "u1" else np.rint(STEP**n.astype(np.float64)).astype(np.int64)
    order = np.lexsort((sid, key))
    key, sid, n = key[order], sid[order], n[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])
    key, sid, n = key[new], sid[new], n[new]
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(cut, len(key)))
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]

    def add(i: np.ndarray, j: np.ndarray) -> None:
        fine = (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (sid[i] != sid[j])
        a.append(sid[i[fine]]), b.append(sid[j[fine]])

    for k in range(2, most + 1):
        at = cut[size == k]
        for i in range(k - 1):
            for j in range(i + 1, k):
                if len(at):
                    add(at + i, at + j)
    at, k = cut[size > most], size[size > most]
    if len(at):
        sums = np.zeros(len(sid) + 1, np.uint64)
        np.cumsum(kit.mix(sid), out=sums[1:])
        _, first = np.unique(np.stack([sums[at + k] - sums[at], k.astype(np.uint64)], 1), axis=0, return_index=True)
        at, k = at[first], k[first]
    hot = np.repeat(at - (np.cumsum(k) - k), k) + np.arange(k.sum())
    add(np.repeat(at, k), hot)
    pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0) if sum(map(len, a)) else np.zeros((0, 2), np.uint64)
    none = np.zeros(len(pairs), np.int64)
    return pa.table({
        "kind": pa.array(np.concatenate([none, np.ones(len(hot), np.int64)])),
        "a": pa.array(np.concatenate([pairs[:, 0].view(np.int64), (part << 32) + key[hot].astype(np.int64)])),
        "b": pa.array(np.concatenate([pairs[:, 1], sid[hot]]).view(np.int64)),
        "n": pa.array(np.concatenate([none, n[hot]])),
    })


PAIRED = "kind long, a long, b long, n long"


def entries(key: np.ndarray, item: np.ndarray, n: np.ndarray, parts: int, entry: list[str] = ENTRY) -> pa.RecordBatch:
    """Blocks for pair_up(): a key's upper bits choose its part, its lower ones stay."""
    part = ((key >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    return kit.block_batch(list(kit.blocks(part, [(key & np.uint64(0xFFFFFFFF)).astype(np.uint32), item, n.astype(entry[2])], parts)))


def _still_apart(hot: DataFrame, labels: DataFrame) -> tuple[DataFrame, str]:
    """(key, id, n, root, m: items of the key) of keys whose items are in several components; of keys that the same items share, one is enough."""
    label = labels.select(F.col("id").alias("l"), "root")
    named = hot.join(label, F.col("id") == F.col("l"), "left").select("key", "id", "n", F.coalesce("root", "id").alias("root"))
    named, path = kit.keep(named, "named")
    sums = named.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("sum"), F.count("*").alias("m"), F.min("id").alias("least"))
    one = sums.where("x <> y").groupBy("sum", "m", "least").agg(F.min("key").alias("k")).select("k", "m")
    return named.join(one, F.col("key") == F.col("k")).select("key", "id", "n", "root", "m"), path


def _largest(still: DataFrame) -> DataFrame:
    """Of what is still apart, the keys that are the largest of some component: what meets under one of a group's keys needn't meet under all."""
    keys = still.groupBy("root").agg(F.max(F.struct("m", "key")).alias("x")).select(F.col("x.key").alias("k")).distinct()
    return still.join(keys, F.col("key") == F.col("k"), "left_semi")


def _meet(still: DataFrame, bodies: DataFrame, look: Look, then: Then | None, tile: int = 0) -> DataFrame:
    """Pairs (a, b) that look() hands on, or those of them that then() makes of (a, b, t_a, t_b); bodies: (id, body) of all items."""
    body = bodies.select(F.col("id").alias("l"), F.col("body").cast("binary").alias("body"))
    chunks = F.ceil(F.col("m") / F.lit(tile or TILE)).cast("int")
    rows = still.withColumn("c", chunks).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("c")).cast("int"))
    rows = rows.join(body, F.col("id") == F.col("l")).withColumn("t", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
    rows = rows.select("key", F.least("chunk", "t").alias("i"), F.greatest("chunk", "t").alias("j"), "chunk", "id", "n", "root", "body")

    seen: set[tuple[int, int]] = set()  # a task's own

    def run(table: pa.Table) -> pa.Table:
        ids, n, root, chunk = (table.column(c).to_numpy() for c in ("id", "n", "root", "chunk"))
        a, b = look(n, root, chunk, table.column("body").to_pylist())
        a, b = np.where(ids[a] < ids[b], a, b), np.where(ids[a] < ids[b], b, a)
        pairs = list(zip(ids[a].tolist(), ids[b].tolist(), strict=True))
        new = np.array([p not in seen for p in pairs], bool)  # two items may meet under many keys
        seen.update(pairs)
        a, b = a[new], b[new]
        out = {"a": pa.array(ids[a], pa.int64()), "b": pa.array(ids[b], pa.int64())}
        if then:
            out |= {"t_a": table.column("body").take(pa.array(a, pa.int64())), "t_b": table.column("body").take(pa.array(b, pa.int64()))}
        return pa.table(out)

    return kit.by_group(rows, ["key", "i", "j"], run, "a long, b long", then)


def groups(found: DataFrame, verify: Callable[[DataFrame], DataFrame], bodies: Callable[[DataFrame], DataFrame], rounds: list[tuple[Look, Then | None]], last: tuple[Look, Callable[[DataFrame], DataFrame], Look] | None = None) -> DataFrame:
    """(id, root) of all items that pair_up()'s rows link to another.

    verify(pairs) gives the links among pairs (a, b), bodies(ids) a table (id, body) of items; rounds has looks at what is
    still apart, under the largest key of each component or, in one after which nothing comes, under all keys, each with what makes links of its pairs in the task, or with None if verify() does. last, if given: a look that
    hands on a forest() of all pairs that may be links, the whole bodies of ids, and a look that hands on a forest of links."""
    spark = found.sparkSession
    pairs, pairs_path = kit.keep(found.where("kind = 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    labels = components(verify(pairs))
    hot = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("id"), "n")
    seen, paths, body = pairs, [pairs_path], None
    for k, (look, then) in enumerate(() if hot.isEmpty() else rounds):
        still, path = _still_apart(hot, labels)
        still, still_path = kit.keep(still, "apart")
        kit.remove(spark, path)
        if still.isEmpty():
            kit.remove(spark, still_path)
            break
        body = body or bodies(still.select("id"))
        more = _meet(_largest(still) if last or k < len(rounds) - 1 else still, body, look, then).distinct()
        more, path = kit.keep(more if then else more.join(seen, ["a", "b"], "left_anti"), "more")
        kit.remove(spark, still_path)
        paths.append(path)
        seen = seen if then else seen.union(more)
        if not more.isEmpty():
            labels = merged(labels, more if then else verify(more))
    else:
        if last and not hot.isEmpty():
            still, path = _still_apart(hot, labels)
            still, still_path = kit.keep(still, "apart")
            kit.remove(spark, path)
            paths.append(still_path)
            if not still.isEmpty():
                labels = _families(still, body or bodies(still.select("id")), labels, *last)
    for path in paths:
        kit.remove(spark, path)
    return labels


def _families(still: DataFrame, body: DataFrame, labels: DataFrame, may: Look, whole: Callable[[DataFrame], DataFrame], links: Look) -> DataFrame:
    """labels with all links between items that are still apart."""
    spark = still.sparkSession
    pairs, path = kit.keep(_meet(still, body, may, None).distinct(), "may")
    if not pairs.isEmpty():
        family, family_path = kit.keep(components(pairs).select(F.col("id").alias("l"), F.col("root").alias("key")), "families")
        size = family.groupBy("key").agg(F.count("*").alias("m"))
        named = still.select("id", "n", "root").distinct().join(family, F.col("id") == F.col("l")).join(size, "key").select("key", "id", "n", "root", "m")
        more, more_path = kit.keep(_meet(named, whole(family.select(F.col("l").alias("id"))), links, None, FAMILY_TILE).distinct(), "more")
        if not more.isEmpty():
            labels = merged(labels, more)
        kit.remove(spark, family_path), kit.remove(spark, more_path)
    kit.remove(spark, path)
    return labels


def forest(a: np.ndarray, b: np.ndarray, group: np.ndarray, linked: Callable[[int, int], bool] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs (a, b) of items, as many as join what they join; group: items with the same number are joined already.

    linked, if given, says of a pair whether it counts; it is asked only where the answer changes what is joined."""
    up = list(range(int(group.max()) + 1 if len(group) else 0))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(group[a].tolist(), group[b].tolist(), strict=True)):
        x, y = top(x), top(y)
        if x != y and (linked is None or linked(int(a[k]), int(b[k]))):
            up[x] = y
            kept.append(k)
    return a[kept], b[kept]


def apart(n: np.ndarray, root: np.ndarray, chunk: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(a, places b) of pairs in a tile of near enough size and different components; items are given by ascending n."""
    two = len(chunk) > 0 and chunk.min() != chunk.max()
    high = np.searchsorted(n, n * 100 // percent, "right")
    for a in range(len(n)):
        b = np.arange(a + 1, high[a])
        b = b[root[b] != root[a]]
        if two:
            b = b[chunk[b] != chunk[a]]
        if len(b):
            yield a, b


def near(n: np.ndarray, root: np.ndarray, chunk: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of apart(), many items at a time."""
    if not len(n):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    two = chunk.min() != chunk.max()
    count = np.searchsorted(n, n * 100 // percent, "right") - np.arange(len(n)) - 1
    ends, found = np.cumsum(count), []
    i = 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - count[i] + (1 << 18), "right")))
        a = np.repeat(np.arange(i, j), count[i:j])
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(count[i:j]) - count[i:j], count[i:j])
        fine = root[a] != root[b]
        if two:
            fine &= chunk[a] != chunk[b]
        found.append((a[fine], b[fine]))
        i = j
    a, b = zip(*found, strict=True)
    return np.concatenate(a), np.concatenate(b)


def nearest(a: np.ndarray, b: np.ndarray, far: np.ndarray, root: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs (a, b) the `first` nearest of each component."""
    own, pair = np.concatenate([root[a], root[b]]), np.tile(np.arange(len(a)), 2)
    by = np.lexsort((far[pair], own))
    new = np.ones(len(by), bool)
    new[1:] = own[by][1:] != own[by][:-1]
    rank = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    kept = np.unique(pair[by[rank < first]])
    return a[kept], b[kept]
