"""Language-model scoring with a probabilistic suffix tree over words.

Tokens are lower-cased words and one end for each text. Training counts every token of every training text.
The root of the tree is the smoothed unigram distribution (c + 1) / (N + V + 1). Contexts are the one
or two words before a token. Following the usual construction, a context and its next symbol enter the tree
if training has them `FLOOR` times or more, and a context is retained only if its
next-symbol distribution diverges from that of its longest retained suffix by `DIVERGENCE` bits or more.
Next-symbol counts are discounted by `DISCOUNT`; what that frees, and what goes to symbols too rare to be
listed, is spread over all other symbols as the suffix has them. A token is scored in the longest retained
state that ends before it.

The tree grows with the input and is nowhere whole. A run of words has a 64-bit id, made of the ids of the run without its
last word (its context) and of the run without its first (its suffix). Runs are counted in blocks by id, and the
statistics of contexts are aggregates and joins on ids. A token's score is a sum: what the root gives the word, what its
context of one word changes in that, and what its context of two words changes in that. Hence each word, pair and triple
has one number that it adds to the score of a text; texts send the ids of what they hold to the blocks that have
these numbers, and get sums back. The most frequent (bounded by `LEAST`) are broadcast instead, and filters of bounded
size keep back most of what adds nothing; both change the work, never the result.

Defined results: a null or empty text has the end alone; a null id counts as training; rows of equal id
and text get equal scores; other columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexframe.llm import kit

#: Occurrences in training from which a context with its next symbol is listed, whatever the size of the corpus.
FLOOR = 2
DIVERGENCE = 0.02
DISCOUNT = 0.6
#: Share of all tokens from which a word is broadcast, and how many times that a pair or triple needs.
LEAST, RUNS = 1e-6, 10
FOLDS, HELD_OUT = 7, 2
#: Distinct runs that a task counts before it hands them on; ids and texts that it collects before it sends them.
HELD = 1_500_000
ASKED, TEXTS = 1_000_000, 1 << 15

END = np.uint64(0x0E4D0E4D0E4D0E4D)


def held_out(ids: pa.Array) -> np.ndarray:
    return np.array([x is not None and zlib.crc32(str(x).encode()) % FOLDS == HELD_OUT for x in ids.to_pylist()], bool)


def tokens(data: np.ndarray, off: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the tokens of rows i to j, an end after each row's words."""
    s = kit.Spans(data, off, i, j)
    start, end, row = s.words()
    h = np.concatenate([s.hashes(start, end, lower=True), np.full(j - i, END)])
    row = np.concatenate([row, np.arange(j - i)])
    order = np.argsort(row, kind="stable")
    return h[order], row[order]


def longer(run: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(id, context, suffix, row) of the runs that are one token longer than these, which are all of a length in their order."""
    at = np.flatnonzero(row[1:] == row[:-1])
    context, suffix = run[at], run[at + 1]
    return kit.digest(context, suffix), context, suffix, row[at]


def part_of(ids: np.ndarray, parts: int) -> np.ndarray:
    return ((ids >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


# ---------------------------------------------------------------- counting


class Tally:
    """Counts of runs in a task, handed on in blocks when there are many."""

    def __init__(self, kind: int, parts: int):
        self.kind, self.parts, self.held, self.n = kind, parts, [], 0

    def add(self, *run: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, first, c = np.unique(run[0], return_index=True, return_counts=True)
        self.held.append([*(x[first] for x in run), c])
        self.n += len(first)
        if self.n > HELD:
            self._merge()
            if self.n > HELD // 2:
                yield self.flush()

    def _merge(self) -> None:
        if self.held:
            self.held = [summed([np.concatenate(x) for x in zip(*self.held, strict=True)])]
            self.n = len(self.held[0][0])

    def flush(self) -> pa.RecordBatch:
        self._merge()
        found = []
        if self.held:
            run, c = self.held[0][:-1], self.held[0][-1]
            sent = run if len(run) == 1 else run[1:]  # a longer run's id follows from the others
            found = list(kit.blocks(part_of(run[0], self.parts), [*sent, c.astype(np.uint32)], self.parts))
        self.held, self.n = [], 0
        return pa.record_batch([pa.array([self.kind] * len(found), pa.int32()), pa.array([p for p, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["kind", "part", "payload"])


def summed(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Of equal ids, the first column, one row with the sum of the last column."""
    if not len(columns[0]):
        return columns
    order = np.argsort(columns[0], kind="stable")
    k = columns[0][order]
    cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return [*(x[order[cut]] for x in columns[:-1]), np.add.reduceat(columns[-1][order], cut)]


COUNTED = "kind int, id long, context long, suffix long, k long"


def count(rows: DataFrame, parts: int, listed=None) -> DataFrame:
    """Counts over all training rows (i, t): of words (kind 0) and pairs (kind 1), or, with a broadcast filter of the pairs
    listed, of triples (kind 2). Pairs and triples below the floor are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = [Tally(k, parts) for k in range(3)]
        for batch in batches:
            batch = batch.filter(pa.array(~held_out(batch.column(0))))
            data, off = kit.texts(batch.column(1))
            for i, j in kit.slices(off):
                h, row = tokens(data, off, i, j)
                pair, *ends, row_of = longer(h, row)
                if listed is None:
                    yield from tally[0].add(h)
                    yield from tally[1].add(pair, *ends)
                else:
                    may = listed.value.may_hold(pair)
                    at = np.flatnonzero((row_of[1:] == row_of[:-1]) & may[1:] & may[:-1])
                    yield from tally[2].add(kit.digest(pair[at], pair[at + 1]), pair[at], pair[at + 1])
        for t in tally:
            yield t.flush()

    def add_up(table: pa.Table) -> pa.Table:
        kind = int(table.column("kind")[0].as_py())
        x = kit.unblock(table, ["u8", "u8", "u4"] if kind else ["u8", "u4"])
        ends = [np.ascontiguousarray(x[f]) for f in x.dtype.names[:-1]]
        found = summed([*([kit.digest(*ends), *ends] if kind else ends * 3), x[x.dtype.names[-1]].astype(np.int64)])
        kept = found[-1] >= (FLOOR if kind else 1)
        cols = [pa.array(c[kept].view(np.int64)) for c in found]
        return pa.table([pa.array(np.full(int(kept.sum()), kind), pa.int32()), *cols], ["kind", "id", "context", "suffix", "k"])

    return rows.mapInArrow(run, "kind int, part int, payload binary").groupBy("kind", "part").applyInArrow(add_up, COUNTED)


# ---------------------------------------------------------------- the tree


def retained(items: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """One depth of the tree, from items (id, times, value: log10 probability of the last word in the longest retained state)
    and the listed runs (id, context, suffix, k) that are one longer.

    Gives states (id, weight: log10 weight of the suffix) of the retained contexts, the runs as items with their `gain` (what
    the state changes for a listed symbol, beyond the weight; null where it is not retained), and scratch paths."""
    lower = items.select(F.col("id").alias("suffix"), "value")
    named, named_path = kit.keep(runs.join(lower, "suffix").select("id", "context", "k", "value"), "named")
    k, n, times = F.col("k"), F.col("n"), F.col("times")
    bits = F.sum(k * (F.log2(k) - F.col("value") * float(np.log2(10))))
    sums = named.groupBy("context").agg(F.sum("k").alias("n"), F.count("*").alias("kinds"), F.sum(F.pow(F.lit(10.0), "value")).alias("under"), bits.alias("bits"))
    sums = sums.join(items.select(F.col("id").alias("context"), "times"), "context")
    gone, below, rest = (F.greatest(1 - x, F.lit(1e-9)) for x in (n / times, F.col("under"), (n - DISCOUNT * F.col("kinds")) / times))
    good = (F.col("bits") - n * F.log2(times)) / times + gone * F.log2(gone / below) >= DIVERGENCE
    states, states_path = kit.keep(sums.where(good).select("context", "times", F.log10(rest / below).alias("weight")), "states")
    p = F.log10((k - DISCOUNT) / times)
    grown = named.join(states, "context", "left").select("id", k.alias("times"), F.coalesce(p, "value").alias("value"), (p - F.col("value") - F.col("weight")).alias("gain"))
    grown, grown_path = kit.keep(grown, "runs")
    kit.remove(items.sparkSession, named_path)
    return states.select(F.col("context").alias("id"), "weight"), grown, [states_path, grown_path]


def grow(rows: DataFrame, parts: int) -> tuple[int, int, DataFrame, DataFrame, DataFrame, list[str]]:
    """(training tokens, distinct ones, words, pairs, triples, scratch paths).

    Words: (id, times, base: log10 probability at the root, gain: base and the weight of the word as a context).
    Pairs and triples: (id, times, gain) of those that change a score; a pair's gain has its weight as a context in it."""
    spark = rows.sparkSession
    counted, counted_path = kit.keep(count(rows, parts), "counts")
    words = counted.where("kind = 0").select("id", F.col("k").alias("times"))
    sums = words.agg(F.sum("times").alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums.n or 0, sums.v or 0
    words = words.withColumn("value", F.log10((F.col("times") + 1.0) / (total + distinct + 1.0)))
    listed = counted.where("kind = 1")
    states, pairs, paths = retained(words, listed)
    words, path = kit.keep(words.join(states, "id", "left").select("id", "times", F.col("value").alias("base"), (F.col("value") + F.coalesce("weight", F.lit(0.0))).alias("gain")), "words")
    kit.remove(spark, paths[0]), kit.remove(spark, counted_path)
    some = spark.sparkContext.broadcast(kit.build_filter(pairs, "id", pairs.count()))
    triples, triples_path = kit.keep(count(rows, parts, some), "triples")
    states, triples, more = retained(pairs, triples)
    kit.remove(spark, triples_path)
    weighed = F.coalesce("gain", F.lit(0.0)) + F.coalesce("weight", F.lit(0.0))
    pairs, pairs_path = kit.keep(pairs.join(states, "id", "left").select("id", "times", weighed.alias("gain")).where("gain <> 0"), "pairs")
    kit.remove(spark, paths[1]), kit.remove(spark, more[0])
    return total, distinct, words, pairs, triples.where("gain is not null").select("id", "times", "gain"), [path, pairs_path, more[1]]


# ---------------------------------------------------------------- scoring


class Known:
    """Sorted ids of the most frequent runs, and what they add."""

    def __init__(self, table: DataFrame, floor: float):
        found = table.where(F.col("times") >= floor).toArrow()
        ids = found["id"].to_numpy().view(np.uint64)
        order = np.argsort(ids)
        self.ids = ids[order]
        self.values = {c: found[c].to_numpy()[order] for c in found.column_names if c not in ("id", "times")}

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Their places, -1 for others."""
        return find(self.ids, ids)

    def sums(self, value: str, place: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        hit = place >= 0
        return np.bincount(row[hit], weights=self.values[value][place[hit]], minlength=n)


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of wanted keys in sorted keys, -1 for those that aren't there."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


#: Of a text: name, id, whether it is null, held out, tokens, known ones, base, score.
_DOC = [("name", "u8"), ("id", "i8"), ("null", "u1"), ("held", "u1"), ("n", "i8"), ("known", "i8"), ("base", "f8"), ("score", "f8")]
#: What texts ask for: an id, and the text's place in the unit; what they get: place, known words, base and score to add.
_ASK, _GET = [("h", "u8"), ("r", "u2")], [("r", "u2"), ("known", "u4"), ("base", "f8"), ("score", "f8")]
SENT = "kind int, part int, unit long, payload binary"
SCORED = "name long, k long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def gather(rows: DataFrame, parts: int, look, table: DataFrame, unknown: float) -> DataFrame:
    """SCORED of every row (i, t), from what look(hash, row, n) finds at once and what the blocks of table (id, base, gain) have.

    look gives three sums for each of n rows (known words, base, score), and two lists (id, row) of words and of longer runs to
    ask for. A word that the table doesn't have gets `unknown`, a longer run nothing."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        unit = (task.partitionId() if task else 0) << 32
        docs, asks, size, n_docs = [], ([], []), 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal unit, size, n_docs
            found = [(0, (unit >> 32) % parts, np.concatenate(docs).tobytes())] if docs else []
            for kind in (0, 1):
                if asks[kind]:
                    h, r = (np.concatenate(x) for x in zip(*asks[kind], strict=True))
                    found += [(kind + 1, p, b) for p, b in kit.blocks(part_of(h, parts), [h, r.astype(np.uint16)], parts)]
                asks[kind].clear()
            docs.clear()
            kind, part, body = zip(*found, strict=True) if found else ((), (), ())
            out = pa.record_batch([pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array([unit] * len(kind), pa.int64()), pa.array(body, pa.binary())], ["kind", "part", "unit", "payload"])
            unit, size, n_docs = unit + 1, 0, 0
            return out

        for batch in batches:
            name, held, null = kit.row_keys(batch.column(0), batch.column(1)), held_out(batch.column(0)), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            number = batch.column(0).fill_null(0).to_numpy()
            data, off = kit.texts(batch.column(1))
            for i, j in kit.slices(off):
                h, row = tokens(data, off, i, j)
                known, base, score, words, runs = look(h, row, j - i)
                doc = np.zeros(j - i, _DOC)
                for f, v in (("name", name[i:j]), ("id", number[i:j]), ("null", null[i:j]), ("held", held[i:j]), ("n", np.bincount(row, minlength=j - i)), ("known", known), ("base", base), ("score", score)):
                    doc[f] = v
                docs.append(doc)
                for kind, (ids, of) in enumerate((words, runs)):
                    if len(ids):
                        asks[kind].append((ids, of + n_docs))
                        size += len(ids)
                n_docs += j - i
                if size > ASKED or n_docs > TEXTS - 4096:
                    yield flush()
        yield flush()

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        ids = known.column("id").to_numpy().view(np.uint64) if len(known) else np.zeros(0, np.uint64)
        order = np.argsort(ids)
        ids = ids[order]
        base, gain = (known.column(c).to_numpy()[order] if len(known) else np.zeros(0) for c in ("base", "gain"))
        kinds, units, bodies = (asked.column(c).to_pylist() for c in ("kind", "unit", "payload")) if len(asked) else ([], [], [])
        out = [(u, 0, b) for k, u, b in zip(kinds, units, bodies, strict=True) if not k]
        for kind, unit, body in zip(kinds, units, bodies, strict=True):
            if not kind:
                continue
            x = np.frombuffer(body, _ASK)
            at = find(ids, np.ascontiguousarray(x["h"]))
            hit, r = at >= 0, x["r"].astype(np.int64)
            n = int(r.max()) + 1
            if kind == 1:
                some = np.bincount(r, minlength=n) > 0
                sums = [np.bincount(r, weights=w, minlength=n) for w in (hit, np.where(hit, base[at] if len(base) else 0.0, unknown), np.where(hit, gain[at] if len(gain) else 0.0, unknown))]
            else:
                r, at = r[hit], at[hit]
                some = np.bincount(r, minlength=n) > 0
                sums = [np.zeros(n), np.zeros(n), np.bincount(r, weights=gain[at] if len(gain) else None, minlength=n)]
            got = np.zeros(int(some.sum()), _GET)
            got["r"] = np.flatnonzero(some)
            for f, v in zip(("known", "base", "score"), sums, strict=True):
                got[f] = v[some]
            if len(got):
                out.append((unit, 1, got.tobytes()))
        unit, kind, body = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"unit": pa.array(unit, pa.int64()), "kind": pa.array(kind, pa.int32()), "payload": pa.array(body, pa.binary())})

    def finish(table: pa.Table) -> pa.Table:
        kinds = np.array(table.column("kind").to_pylist())
        bodies = table.column("payload").to_pylist()
        d = np.concatenate([np.frombuffer(b, _DOC) for k, b in zip(kinds, bodies, strict=True) if not k] or [np.zeros(0, _DOC)]).copy()
        for k, b in zip(kinds, bodies, strict=True):
            if k:
                x = np.frombuffer(b, _GET)  # a place once
                for f in ("known", "base", "score"):
                    d[f][x["r"]] += x[f].astype(d[f].dtype)
        col = {f: np.ascontiguousarray(d[f]) for f in d.dtype.names}
        return pa.table({
            "name": pa.array(col["name"].view(np.int64)), "k": pa.array(col["id"], pa.int64(), mask=col["null"].astype(bool)), "held_out": pa.array(col["held"].astype(bool)), "n_tokens": pa.array(col["n"]),
            "n_known": pa.array(col["known"]), "base_score": pa.array(col["base"]), "score": pa.array(col["score"]),
        })

    table = table.select(F.pmod(F.shiftrightunsigned("id", 33), F.lit(parts)).cast("int").alias("part"), "id", "base", "gain")
    answered = rows.mapInArrow(send, SENT).groupBy("part").cogroup(table.groupBy("part")).applyInArrow(answer, "unit long, kind int, payload binary")
    return answered.groupBy("unit").applyInArrow(finish, SCORED)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    parts = 2 * kit.partitions(docs)
    rows = kit.split_rows(docs).select(F.col(key).cast("long").alias("i"), F.col(text).cast("string").alias("t"))
    total, distinct, words, pairs, triples, paths = grow(rows, parts)
    unknown = -float(np.log10(total + distinct + 1.0))
    floor = max(FLOOR, least * total)
    send = spark.sparkContext.broadcast
    common = send([Known(words, floor), Known(pairs, RUNS * floor), Known(triples, RUNS * floor)])
    may_pair, may_triple = (send(kit.build_filter(x, "id", x.count())) for x in (pairs, triples))

    def asked(known: Known, some: kit.Filter, ids: np.ndarray, row: np.ndarray, n: int):
        place = known.places(ids)
        left = np.flatnonzero(place < 0)
        left = left[some.may_hold(ids[left])]
        return known.sums("gain", place, row, n), (ids[left], row[left])

    def short(h: np.ndarray, row: np.ndarray, n: int):
        word, pair, _ = common.value
        place = word.places(h)
        rare = place < 0
        ids, _, _, of = longer(h, row)
        more, runs = asked(pair, may_pair.value, ids, of, n)
        return np.bincount(row[~rare], minlength=n), word.sums("base", place, row, n), word.sums("gain", place, row, n) + more, (h[rare], row[rare]), runs

    def long(h: np.ndarray, row: np.ndarray, n: int):
        ids, _, _, of = longer(h, row)
        ids, _, _, of = longer(ids, of)
        more, runs = asked(common.value[2], may_triple.value, ids, of, n)
        return np.zeros(n), np.zeros(n), more, (h[:0], row[:0]), runs

    none = F.lit(0.0).alias("base")
    first, first_path = kit.keep(gather(rows, parts, short, words.select("id", "base", "gain").union(pairs.select("id", none, "gain")), unknown), "scores")
    for path in paths[:2]:  # words and pairs; the second look-up, which takes most disk, asks for triples only
        kit.remove(spark, path)
    second, second_path = kit.keep(gather(rows, parts, long, triples.select("id", none, "gain"), unknown).dropDuplicates(["name"]).select("name", F.col("score").alias("more")), "scores")
    out = first.join(second, "name").select("k", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", (F.col("score") + F.col("more")).alias("score"))
    out, _ = kit.keep(out, "scores")
    for path in (paths[2], first_path, second_path):
        kit.remove(spark, path)
    return out.withColumnRenamed("k", key)
