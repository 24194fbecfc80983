"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors become integers, and rows are indexed in blocks. A block posts its components in segments: those of one
dimension and one quantised impact, where impact b holds components with 2**b <= |component| < 2**(b+1). Segments are
processed by descending impact, whole impacts at a time, and each posting adds its product with the query's component
to the score of its row. After each impact, what the postings still to come can add to a row's score, up or down, is at
most the norm of the row's unprocessed components times the norm of the query (Cauchy-Schwarz). A row may be a member
of the top k only if its score plus that bound reaches the k-th best score minus its bound. Processing stops when this
proof leaves few possible members, or when nothing is left; possible members are rescored exactly from their integers.

Every row is indexed; nothing is sampled. Blocks of queries meet blocks of rows by an equi-join on a bucket of query
blocks, and each meeting hands on at most k rows for each query.

Defined results: vectors that are null, empty, or hold null or non-finite components, and rows without an
id, take no part; shorter vectors count as if they went on with zeros; rows of equal id are rows of their
own, and only the query's own row is left out; components and scores that 64 bits can't hold are an error, never a
wrong number; other columns are not looked at; no queries or no rows give an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexframe.llm import kit

SCALE = 256
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
#: Queries that are worked on together, and possible members for each at which processing may stop.
TOGETHER, FEW = 256, 64


def integers(batch: pa.RecordBatch, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(ids, integer vectors) of the rows (id, vector) that take part."""
    ids, vectors = batch.column(0), batch.column(1)
    where = vectors.offsets.to_numpy().astype(np.int64)
    flat = vectors.values.cast(pa.float64())
    value = flat.fill_null(np.nan).to_numpy()
    size = np.diff(where)
    bad = np.zeros(len(value) + 1, np.int64)
    np.cumsum(~np.isfinite(value), out=bad[1:])
    valid = ~(ids.is_null().to_numpy(zero_copy_only=False) | vectors.is_null().to_numpy(zero_copy_only=False))
    good = np.flatnonzero(valid & (size > 0) & (bad[where[1:]] == bad[where[:-1]]))
    width = int(size[good].max()) if len(good) else 0
    out = np.zeros((len(good), width), np.int64)
    row = np.repeat(np.arange(len(good)), size[good])
    col = np.arange(len(row)) - np.repeat(np.cumsum(size[good]) - size[good], size[good])
    whole = np.floor(scale * value[np.repeat(where[good], size[good]) + col])
    if len(whole) and np.abs(whole).max() >= 2.0**62:
        raise OverflowError("a component times the scale is beyond 64 bits")
    out[row, col] = whole.astype(np.int64)
    return ids.take(pa.array(good)).cast(pa.int64()).to_numpy(), out


def impact(x: np.ndarray) -> np.ndarray:
    """-1 for 0, else b with 2**b <= |x| < 2**(b+1)."""
    a = np.abs(x)
    b = np.frexp(a.astype(np.float64))[1] - 1
    b -= (a < np.left_shift(np.int64(1), np.minimum(np.maximum(b, 0), 62))) & (a > 0)  # rounded up to the next power
    return np.where(a > 0, b, -1)


class Index:
    """Posting segments of a block by descending impact, and what is left of the rows' norms after each impact."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, of = vectors, impact(vectors)
        self.top = int(np.abs(vectors).max(initial=0))
        self.impacts = [int(b) for b in np.unique(of[of >= 0])][::-1]
        #: Of each impact its segments (dimension, rows, components).
        self.segments: list[list[tuple[int, np.ndarray, np.ndarray]]] = []
        self.rest: list[np.ndarray] = []
        for b in self.impacts:
            dim, row = np.nonzero((of == b).T)
            cut = np.flatnonzero(np.diff(dim)) + 1
            self.segments.append([(int(dim[i]), row[i:j], vectors[row[i:j], dim[i]].astype(np.float64)) for i, j in zip([0, *cut], [*cut, len(dim)], strict=True)])
            self.rest.append(np.sqrt((np.where(of < b, vectors, 0).astype(np.float64) ** 2).sum(1)))


def search(index: Index, ids: np.ndarray, own: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, row, score) of the top k rows of each query, ties to the smaller id, and the postings processed for each query.

    own: the row of the block that is the query itself, or -1.
    """
    nq, nx = len(queries), len(index.vectors)
    width = max(queries.shape[1], index.vectors.shape[1])
    grow = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m
    whole, vectors = grow(queries), grow(index.vectors)
    parts, top = whole.astype(np.float64).T.copy(), int(np.abs(queries).max(initial=0))
    norm = np.sqrt((parts**2).sum(0)) * (1 + 1e-9)
    largest = width * max(index.top, 1) * max(top, 1)
    blur = 0.0 if largest < 1 << 53 else largest * width * 2.0**-50  # sums of whole numbers below 2**53 are exact
    score = np.zeros((nx, nq))
    mine = np.flatnonzero(own >= 0)
    best, done = min(k, nx), 0
    possible = np.ones((nx, nq), bool)
    possible[own[mine], mine] = False
    for segments, rest in zip(index.segments, index.rest, strict=True):
        for dim, row, value in segments:
            score[row] += value[:, None] * parts[dim]
            done += len(row)
        bound = np.outer(rest * (1 + 1e-9), norm) + blur
        low = score - bound
        low[own[mine], mine] = -np.inf
        floor = np.partition(low, nx - best, axis=0)[nx - best]
        possible = score + bound >= floor
        possible[own[mine], mine] = False
        if possible.sum() <= FEW * nq:
            break
    q, x = np.nonzero(possible.T)
    exact = np.zeros(len(q), np.int64)
    for i in range(0, len(q), 1 << 16):
        j = slice(i, i + (1 << 16))
        if largest < 1 << 63:
            exact[j] = (whole[q[j]] * vectors[x[j]]).sum(1)
        else:
            sums = (whole[q[j]].astype(object) * vectors[x[j]].astype(object)).sum(1)
            if any(not -(1 << 63) <= v < 1 << 63 for v in sums):
                raise OverflowError("a score is beyond 64 bits")
            exact[j] = sums.astype(np.int64)
    order = np.lexsort((ids[x], ~exact, q))
    q, x, exact = q[order], x[order], exact[order]
    first = np.searchsorted(q, np.arange(nq))
    rank = np.arange(len(q)) - first[q]
    keep = rank < k
    return q[keep], x[keep], exact[keep], done


BLOCK_SCHEMA = "block long, width int, ids binary, vectors binary"


def blocks(rows: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """Rows that take part, as integers, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, x = integers(batch, scale)
            if not len(ids):
                continue
            yield pa.record_batch([pa.array([(part << 32) + n]), pa.array([x.shape[1]], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([_packed(x)], pa.binary())], ["block", "width", "ids", "vectors"])
            n += 1

    kit.split_rows(rows, BLOCK_ROWS)
    found, _ = kit.keep(rows.select(F.col(key).cast("long"), F.col(vector)).mapInArrow(run, BLOCK_SCHEMA), "blocks")
    return found


def _packed(x: np.ndarray) -> bytes:
    """32-bit integers where all fit, else 64-bit ones."""
    return x.astype("<i4" if np.abs(x).max(initial=0) < 1 << 31 else "<i8").tobytes()


def _matrix(raw: bytes, width: int, rows: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4" if len(raw) == 4 * width * rows else "<i8").reshape(rows, width).astype(np.int64)


def top_k(rows: DataFrame, k: int, every: int, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score for the queries, which are the rows whose id `every` divides."""
    index = blocks(rows, key, vector, scale)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                x = _matrix(r["vectors"], r["width"], len(ids))
                at = np.flatnonzero(ids % every == 0)
                for a in range(0, len(at), QUERY_ROWS):
                    own = at[a : a + QUERY_ROWS]
                    yield pa.record_batch([pa.array([r["block"]]), pa.array([r["width"]], pa.int32()), pa.array([ids[own].tobytes()], pa.binary()), pa.array([_packed(x[own])], pa.binary()), pa.array([own.astype(np.int64).tobytes()], pa.binary())], ["q_block", "q_width", "q_ids", "q_vectors", "q_rows"])

    chosen, _ = kit.keep(index.mapInArrow(choose, "q_block long, q_width int, q_ids binary, q_vectors binary, q_rows binary"), "queries")
    # every block of queries meets every block of rows: a stated query set against all rows, in blocks
    n = max(1, min(chosen.count(), kit.partitions(rows)))
    spread = max(1, min(16, kit.partitions(rows) // n))
    left = chosen.withColumn("q", F.pmod(F.xxhash64("q_block", F.crc32("q_rows")), F.lit(n)).cast("int")).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    right = index.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("s", F.pmod(F.xxhash64("block"), F.lit(spread)).cast("int"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, Index, np.ndarray] | None = None
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if held is None or held[0] != r["block"]:
                    ids = np.frombuffer(r["ids"], np.int64)
                    held = r["block"], Index(_matrix(r["vectors"], r["width"], len(ids))), ids
                _, own_index, ids = held
                q_ids, at = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["q_rows"], np.int64)
                q = _matrix(r["q_vectors"], r["q_width"], len(q_ids))
                for a in range(0, len(q_ids), TOGETHER):
                    b = slice(a, a + TOGETHER)
                    own = at[b] if r["q_block"] == r["block"] else np.full(len(q_ids[b]), -1)
                    who, row, score, _ = search(own_index, ids, own, q[b], k)
                    yield pa.record_batch([pa.array(np.full(len(who), r["q_block"])), pa.array(at[b][who]), pa.array(q_ids[b][who]), pa.array(ids[row]), pa.array(score)], ["q_block", "q_row", "query_id", "vec_id", "score"])

    joined = right.join(left, ["q", "s"]).select("block", "width", "ids", "vectors", "q_block", "q_width", "q_ids", "q_vectors", "q_rows")
    found = joined.mapInArrow(meet, "q_block long, q_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("q_block", "q_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
