"""Set similarity join on word shingles with token-combination prefixes.

A document's tokens are its distinct five-word shingles. All tokens have one order: those of the rare
class by hash, then those of the frequent class by hash. Two sets of Jaccard similarity s or more differ
in at most t = n - ceil(s * n) tokens of the one that has n. A prefix of a set is extended until single
tokens of the rare class, and pairs of tokens of one frequent group, can't all be missed with t differences:
rare tokens count one each, and g tokens of a frequent group count g - 1, as sharing no pair in it means
missing all of them but one. Prefixes that count t + 1 hence have a key in common whenever two sets are
that similar, and the keys are: each rare token, each pair of prefix tokens of the same frequent group.
The frequent class is split by hash into groups that grow with the set's size band, so that pairs stay
about as many as tokens; a set near a band's edge writes the keys of both bands.

The class of a token changes the work, never the result. Frequent tokens are those that a lossy count
over all documents finds in `FREQUENT` different sets or more, the `CLASS_SIZE` most frequent of them.

Equal sets are one node, however many documents have them. Sets that share a key are candidates: all pairs
for a few sets, and for more, each with the first; whatever those leave apart meets in tiles of a key's sets
(see candidates.py). Candidates pass by parity sketches first: a set's tokens are hashed to eight times as many bits or more,
each bit the parity of its tokens, so two sketches never differ in more bits than their sets in tokens, and seldom in
many fewer. What the sketches leave is verified on whole sets, which a further scan fetches through a filter of bounded size.

Defined results: a null or empty text, or one without words, has no tokens and is linked with nothing; a
text of fewer than five words has the whole sequence as its one token; repeated rows are linked with each
other; other columns are not looked at; an empty table gives an empty table. A null id stays null and is
passed over when the smallest id of a component is looked for, unless there is no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexframe.llm import kit
from plexframe.llm.candidates import PAIRED, apart, entries, forest, groups, nearest, pair_up

WORDS = 5
#: Similarity as a whole percentage.
PERCENT = 80
FREQUENT = 8
CLASS_SIZE = 1 << 17
#: Tokens of one task that its lossy count holds before it forgets those seen once.
LOSSY = 4_000_000
#: Nearest pairs of each component under a key that are verified, in each of `ROUNDS` rounds, before all others meet.
FIRST, ROUNDS = 2, 1
#: Bits of a sketch for each token at least.
DRAWN = 8


# ---------------------------------------------------------------- sets


def sets(array: pa.Array, k: int = WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, tokens sorted within rows, offsets of the rows in them) for slices of a column."""
    data, off = kit.texts(array)
    for i, j in kit.slices(off):
        s = kit.Spans(data, off, i, j)
        start, end, row = s.words()
        h = s.hashes(start, end, lower=True)
        token, first = kit.windows(h, row, k)
        of = row[first]
        n = np.bincount(row, minlength=j - i)
        short = np.flatnonzero((n > 0) & (n < k))
        if len(short):
            begin = np.concatenate([[0], np.cumsum(n)])
            extra = np.array([int(kit.windows(h[begin[r] : begin[r + 1]], row[begin[r] : begin[r + 1]], int(n[r]))[0][0]) ^ (0xABCD << int(n[r])) for r in short], np.uint64)
            token, of = np.concatenate([token, extra]), np.concatenate([of, short])
        order = np.lexsort((token, of))
        token, of = token[order], of[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (of[1:] != of[:-1])
        token, of = token[new], of[new]
        yield i, j, token, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=j - i))])


def set_ids(token: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set; 0 for the empty set."""
    sums = np.zeros(len(token) + 1, np.uint64)
    np.cumsum(kit.mix(token), out=sums[1:])
    n = np.diff(off).astype(np.uint64)
    return np.where(n > 0, kit.mix(sums[off[1:]] - sums[off[:-1]] + n * kit.BASE) | np.uint64(1), np.uint64(0))


def sketches(token: np.ndarray, off: np.ndarray, rows: list[int]) -> list[bytes]:
    """Parity sketches of some sets: the power of two of 64-bit words that has `DRAWN` bits for each token or more."""
    out = []
    for r in rows:
        h = kit.mix(token[off[r] : off[r + 1]] ^ np.uint64(0x2545F4914F6CDD1D))
        bits = 64 << max(0, (DRAWN * len(h) - 1).bit_length() - 6)
        count = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
        out.append(np.packbits((count & 1).astype(np.uint8), bitorder="little").tobytes())
    return out


def may_differ(n: np.ndarray | int, m: np.ndarray | int, percent: int):
    """Tokens that only one of two sets of n and m tokens has, at most, if they are similar enough."""
    return (n + m) * (100 - percent) // (100 + percent)


def folded(x: np.ndarray) -> np.ndarray:
    """Sketches of half the width of the same sets."""
    half = x.shape[-1] // 2
    return x[..., :half] ^ x[..., half:]


# ---------------------------------------------------------------- keys


def bands(n: int, percent: int) -> list[int]:
    """Numbers of frequent groups under which a set of n tokens writes keys: those of all sizes it may be linked to."""
    low, high = max(1, -(-n * percent // 100)), n * 100 // percent
    return sorted({max(1, (1 << b) // 16) for b in range(low.bit_length() - 1, high.bit_length())})


def keys(token: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of one set, given as sorted tokens; frequent: the sorted frequent class."""
    n = len(token)
    need = n - -(-n * percent // 100) + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, token), len(frequent) - 1)
        common = frequent[at] == token
        rare, often = token[~common], token[common]
    else:
        rare, often = token, token[:0]
    if len(rare) >= need:
        return kit.mix(rare[:need])
    out = [kit.mix(rare)]
    need -= len(rare)
    for groups in bands(n, percent):
        g = (kit.mix(often) % np.uint64(groups)).astype(np.int64)
        again = np.ones(len(g), bool)
        again[np.unique(g, return_index=True)[1]] = False
        counted = np.cumsum(again)
        if not len(g) or counted[-1] < need:
            m = len(g)  # a set of one token: only its equals are that similar
        else:
            m = int(np.searchsorted(counted, need)) + 1
        order = np.argsort(g[:m], kind="stable")
        gs, ts = g[order], often[order]
        for d in range(1, m):
            same = gs[d:] == gs[:-d]
            if not same.any():
                break
            a, b = ts[:-d][same], ts[d:][same]
            out.append(kit.digest(np.full(len(a), groups, np.uint64), np.minimum(a, b), np.maximum(a, b)))
    return np.unique(np.concatenate(out))


# ---------------------------------------------------------------- passes over the texts


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return kit.split_rows(docs).select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


class _Fresh:
    """Which sets a task sees for the first time."""

    def __init__(self) -> None:
        self.seen: set[int] = set()

    def __call__(self, ids: np.ndarray) -> list[int]:
        out = []
        for r, x in enumerate(ids.tolist()):
            if x and x not in self.seen:
                self.seen.add(x)
                out.append(r)
        return out


def survey(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """Rows (id, n, set, sketch: where a task sees the set first) of documents, and rows (token, count) of tokens that a task found in several sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, held, count = _Fresh(), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

        def merge(floor: int) -> None:
            t, c = np.concatenate(held), np.concatenate(count)
            order = np.argsort(t, kind="stable")
            t, c = t[order], c[order]
            cut = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64)
            c = np.add.reduceat(c, cut) if len(t) else c
            good = c >= floor
            held[:], count[:] = [t[cut][good]], [c[good]]

        schema = ["id", "n", "set", "token", "count", "sketch"]
        for batch in batches:
            n, name = [], []
            drawn: list[bytes | None] = [None] * batch.num_rows
            for i, _, token, off in sets(batch.column(1), words):
                ids = set_ids(token, off)
                n.append(np.diff(off)), name.append(ids)
                own = fresh(ids)
                for r, x in zip(own, sketches(token, off, own), strict=True):
                    drawn[i + r] = x
                if own:
                    part = np.concatenate([token[off[r] : off[r + 1]] for r in own])
                    held.append(part), count.append(np.ones(len(part), np.int64))
            if sum(map(len, held)) > LOSSY:
                merge(2)
            size = batch.num_rows
            none = pa.nulls(size, pa.int64())
            if size:
                yield pa.record_batch([batch.column(0), pa.array(np.concatenate(n)), _signed(np.concatenate(name)), none, none, pa.array(drawn, pa.binary())], schema)
        merge(3)
        t, c = held[0], count[0]
        if len(t) > CLASS_SIZE:
            top = np.argpartition(-c, CLASS_SIZE)[:CLASS_SIZE]
            t, c = t[top], c[top]
        none = pa.nulls(len(t), pa.int64())
        yield pa.record_batch([none, none, none, _signed(t), pa.array(c), pa.nulls(len(t), pa.binary())], schema)

    return _rows(docs, key, text).mapInArrow(run, "id long, n long, set long, token long, count long, sketch binary")


def index(docs: DataFrame, key: str, text: str, words: int, percent: int, frequent, parts: int) -> DataFrame:
    """Blocks of entries (key, set, n), one of each set and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, common = _Fresh(), frequent.value
        for batch in batches:
            k, s, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
            for _, _, token, off in sets(batch.column(1), words):
                ids = set_ids(token, off)
                for r in fresh(ids):
                    own = keys(token[off[r] : off[r + 1]], common, percent)
                    k.append(own), s.append(np.full(len(own), ids[r])), n.append(np.full(len(own), off[r + 1] - off[r], np.uint32))
            yield entries(np.concatenate(k), np.concatenate(s), np.concatenate(n), parts)

    return _rows(docs, key, text).mapInArrow(run, kit.BLOCK)


def fetch(docs: DataFrame, key: str, text: str, words: int, wanted) -> DataFrame:
    """(id, n, tokens) of sets that the filter lets through, one of each set and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, some = _Fresh(), wanted.value
        for batch in batches:
            name, size, body = [], [], []
            for _, _, token, off in sets(batch.column(1), words):
                ids = set_ids(token, off)
                ids = np.where(some.may_hold(ids), ids, np.uint64(0))
                for r in fresh(ids):
                    name.append(ids[r]), size.append(int(off[r + 1] - off[r])), body.append(token[off[r] : off[r + 1]].tobytes())
            yield pa.record_batch([_signed(np.array(name, np.uint64)), pa.array(size, pa.int64()), pa.array(body, pa.binary())], ["id", "n", "tokens"])

    return _rows(docs, key, text).mapInArrow(run, "id long, n long, tokens binary")


# ---------------------------------------------------------------- verification


def similar(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two sets, given as sorted tokens, are similar enough."""
    if len(p) > len(q):
        p, q = q, p
    both = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum()) if len(p) else 0
    return bool(len(p)) and (100 + percent) * both >= percent * (len(p) + len(q))


def close(n: int, x: bytes, m: int, y: bytes, percent: int) -> bool:
    """Whether the sketches of two sets allow that they are similar enough."""
    p, q = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    while len(q) > len(p):
        q = folded(q)
    return int(np.bitwise_count(p ^ q).sum()) <= may_differ(n, m, percent)


def look(percent: int, first: int | None):
    """For candidates.groups(): pairs that the sketches let pass; of each component the `first` nearest pairs only, if given."""

    def run(n: np.ndarray, root: np.ndarray, chunk: np.ndarray, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(n, kind="stable")
        n, root, chunk = n[order], root[order], chunk[order]
        width = np.array([len(bodies[i]) // 8 for i in order.tolist()], np.int64)
        drawn, begin, narrow = {}, {}, {}
        for w in np.unique(width).tolist():  # wider sketches are those of larger sets
            begin[w] = int(np.searchsorted(width, w))
            drawn[w] = np.frombuffer(b"".join(bodies[i] for i in order[width == w].tolist()), np.uint64).reshape(-1, w)
            narrow[w] = folded(drawn[w]) if w > 1 else drawn[w]
        a, b, far = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, others in apart(n, root, chunk, percent):
            w = int(width[i])
            own = drawn[w][i - begin[w]]
            same = width[others] == w
            d = np.zeros(len(others), np.int64)
            d[same] = np.bitwise_count(drawn[w][others[same] - begin[w]] ^ own).sum(1)
            if not same.all():
                d[~same] = np.bitwise_count(narrow[2 * w][others[~same] - begin[2 * w]] ^ own).sum(1)
            fine = d <= may_differ(n[i], n[others], percent)
            a.append(np.full(int(fine.sum()), i)), b.append(others[fine]), far.append(d[fine])
        a, b, far = map(np.concatenate, (a, b, far))
        if first:
            a, b = nearest(a, b, far, root, first)
        return order[a], order[b]

    return run


def may(percent: int):
    """For candidates.groups(): a forest of the pairs that the sketches let pass."""

    def run(n: np.ndarray, root: np.ndarray, chunk: np.ndarray, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return forest(*look(percent, None)(n, root, chunk, bodies), np.arange(len(n)))

    return run


def link(percent: int):
    """For candidates.groups(): a forest of the pairs whose whole sets are similar enough."""

    def run(n: np.ndarray, root: np.ndarray, chunk: np.ndarray, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        own = [np.frombuffer(x, np.uint64) for x in bodies]
        drawn = sketches(np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])]), list(range(len(own))))
        joined = np.unique(root, return_inverse=True)[1]
        return forest(*look(percent, None)(n, root, chunk, drawn), joined, lambda i, j: similar(own[i], own[j], percent))

    return run


def screen(pairs: DataFrame, drawn: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that the sketches let pass; drawn: (id, n, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(2, 6)]
            good = [close(*x, percent) for x in zip(*cols, strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    left, right = (drawn.select(F.col("id").alias(f"id_{x}"), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"t_{x}")) for x in "ab")
    joined = pairs.select("a", "b").join(left, F.col("a") == F.col("id_a")).join(right, F.col("b") == F.col("id_b"))
    return joined.select("a", "b", "n_a", "t_a", "n_b", "t_b").mapInArrow(run, "a long, b long")


def sets_of(ids: DataFrame, docs: DataFrame, key: str, text: str, words: int) -> tuple[DataFrame, str]:
    """A scratch table (id, n, tokens) of the sets with these ids."""
    spark = docs.sparkSession
    ids, path = kit.keep(ids.distinct(), "ids")
    wanted = spark.sparkContext.broadcast(kit.build_filter(ids, "id", ids.count()))
    found = kit.keep(fetch(docs, key, text, words, wanted).join(ids, "id", "left_semi").dropDuplicates(["id"]), "sets")
    kit.remove(spark, path)
    return found


def verify(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose whole sets are similar enough; found: sets_of() all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    left, right = (found.select(F.col("id").alias(f"id_{x}"), F.col("tokens").alias(f"t_{x}")) for x in "ab")
    joined = pairs.select("a", "b").join(left, F.col("a") == F.col("id_a")).join(right, F.col("b") == F.col("id_b"))
    return kit.keep(joined.select("a", "b", "t_a", "t_b").mapInArrow(run, "a long, b long"), "good")[0]


# ---------------------------------------------------------------- the join


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, set_id (equal for equal sets) and component_id (smallest key reachable by links) of every row."""
    spark = docs.sparkSession
    parts = 2 * kit.partitions(docs)
    seen, seen_path = kit.keep(survey(docs, key, text, words), "survey")
    heavy = seen.where("token is not null").groupBy("token").agg(F.sum("count").alias("c")).where(F.col("c") >= FREQUENT)
    top = heavy.orderBy(F.desc("c"), "token").limit(CLASS_SIZE).select("token").toArrow()["token"].to_numpy()
    frequent = spark.sparkContext.broadcast(np.sort(top.view(np.uint64)))

    drawn = seen.where("sketch is not null").select(F.col("set").alias("id"), "n", "sketch")
    found = kit.block_reduce(index(docs, key, text, words, percent, frequent, parts), lambda t: pair_up(t, percent), PAIRED)
    found, found_path = kit.keep(found, "candidates")

    def chosen(ids: DataFrame) -> tuple[DataFrame, str]:
        """(id, n, sketch) of some sets, each once."""
        return kit.keep(drawn.join(ids.distinct(), "id", "left_semi").dropDuplicates(["id"]), "sketches")

    def checked(pairs: DataFrame) -> DataFrame:
        """Links among pairs: the sketches leave few, so a scan that fetches just their sets costs less than keeping all that may be asked for."""
        ends = lambda p: p.select(F.col("a").alias("id")).union(p.select("b"))
        some = chosen(ends(pairs))
        left, path = kit.keep(screen(pairs, some[0], percent), "screened")
        bodies, bodies_path = sets_of(ends(left), docs, key, text, words)
        good = verify(left, bodies, percent)
        for p in (path, bodies_path, some[1]):
            kit.remove(spark, p)
        return good

    def drawn_of(ids: DataFrame) -> DataFrame:
        return chosen(ids)[0].select("id", F.col("sketch").alias("body"))

    def sets_and_ids(ids: DataFrame) -> DataFrame:
        return sets_of(ids, docs, key, text, words)[0].select("id", F.col("tokens").alias("body"))

    labels = groups(found, checked, drawn_of, [(look(percent, FIRST), None)] * ROUNDS, (may(percent), sets_and_ids, link(percent)))
    kit.remove(spark, found_path)

    rows = seen.where("set is not null").select("id", "n", "set")
    label = labels.select(F.col("id").alias("l"), "root")
    least = rows.where("set <> 0").groupBy("set").agg(F.min("id").alias("first")).join(label, F.col("set") == F.col("l"), "left")
    least = least.select("set", "first", F.coalesce("root", "set").alias("root"))
    group = least.groupBy("root").agg(F.min("first").alias("component_id"))
    least = least.join(group, "root").select(F.col("set").alias("s"), "component_id")
    out = rows.join(least, F.col("set") == F.col("s"), "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"), F.col("set").alias("set_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Rows of one document of each group: all rows of the smallest key. Rows linked with nothing stay.

    Rows whose key a filter of bounded size knows not to go stay where they are; the others are joined."""
    spark = docs.sparkSession
    found = similar_groups(docs, key, text, **how).select(F.col(key).alias("k"), "component_id")
    goes = found.groupBy("k").agg(F.max(F.col("k").eqNullSafe(F.col("component_id"))).alias("stays")).where("not stays").select(F.xxhash64("k").alias("h"), "k")
    goes, _ = kit.keep(goes, "goes")
    asked = kit.may_hold(spark.sparkContext.broadcast(kit.build_filter(goes, "h", goes.count())))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(f"`{key}`").cast("long").alias("_k"))
    rows = rows.withColumn("_may", asked(F.xxhash64("_k")))
    kept = rows.where("_may").join(goes.select(F.col("k").alias("_k2")), F.col("_k").eqNullSafe(F.col("_k2")), "left_anti")
    return rows.where("not _may").select("_row").union(kept.select("_row")).select("_row.*")
