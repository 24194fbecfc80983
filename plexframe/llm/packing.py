"""Vector best-fit packing of token sequences.

A row's ids (with an end id) make one piece, or, if they are more than the capacity, pieces of just that
size and a rest. Pieces are dealt to groups of about `GROUP` by a hash and packed group by group, from
the longest down. An open sequence has residual tokens, residual documents and residual attention cost
(the sum of squared piece lengths); a piece goes to the sequence which can take it under all three and
whose weighted residual norm is then least, else it opens one. Only the last sequences of a group are
left unfilled for want of pieces, so groups cost about one sequence in a thousand.

Defined results: a null or empty text is a piece of the end id alone; repeated rows are packed each; other
columns are not looked at; an empty table gives an empty table. A piece that alone breaks a limit on
attention cost gets a sequence to itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexframe.llm import kit
from plexframe.llm.encode import encoder

CAPACITY = 4096
GROUP = 16_384
#: Weights of tokens, documents and attention cost in the residual norm.
WEIGHTS = (1.0, 0.02, 0.02)


def best_fit(length: np.ndarray, capacity: int = CAPACITY, documents: int | None = None, attention: float | None = None, weights: tuple[float, float, float] = WEIGHTS) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece."""
    documents, attention = documents or capacity, attention or float(capacity) ** 2
    n = len(length)
    where, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-length, kind="stable")
    full = int(np.searchsorted(-length[order], -capacity, "right"))
    where[order[:full]] = np.arange(full)
    tokens, docs, cost = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    name = np.zeros(n, np.int64)
    open_, opened = 0, full  # sequences that may take more stand in the first `open_` places
    least = int(length.min()) if n else 0
    wt, wd, wa = weights[0] / capacity**2, weights[1] / documents**2, weights[2] / attention**2
    for i in order[full:].tolist():
        size = int(length[i])
        t = tokens[:open_] - size
        fit = np.flatnonzero((t >= 0) & (docs[:open_] >= 1) & (cost[:open_] >= float(size) ** 2))
        if len(fit):
            rest = wt * t[fit].astype(float) ** 2 + wd * (docs[fit] - 1.0) ** 2 + wa * (cost[fit] - float(size) ** 2) ** 2
            b = int(fit[np.argmin(rest)])
        else:
            b, open_ = open_, open_ + 1
            tokens[b], docs[b], cost[b], name[b] = capacity, documents, attention, opened
            opened += 1
        where[i], offset[i] = name[b], capacity - tokens[b]
        tokens[b], docs[b], cost[b] = tokens[b] - size, docs[b] - 1, cost[b] - float(size) ** 2
        if tokens[b] < least or docs[b] < 1 or cost[b] < float(least) ** 2:  # closed: the last open one takes its place
            open_ -= 1
            for a in (tokens, docs, cost, name):
                a[b] = a[open_]
    return where, offset


def pieces(docs: DataFrame, vocabulary: str, end: int = 1, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, piece, start, length, ids_crc32 of every piece of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, last = encoder(vocabulary), np.array([end], "<u4").tobytes()
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, j, ids, off in enc.rows(batch.column(1)):
                raw, at = ids.astype("<u4").tobytes(), off.tolist()
                for r in range(j - i):
                    body = raw[4 * at[r] : 4 * at[r + 1]] + last
                    for p, a in enumerate(range(0, len(body), 4 * capacity)):
                        part = body[a : a + 4 * capacity]
                        row.append(i + r), piece.append(p), start.append(a // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
            out = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.record_batch(out, ["k", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[key].dataType.simpleString()
    rows = kit.split_rows(docs).select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, f"k {kind}, piece int, start long, length long, ids_crc32 long").withColumnRenamed("k", key)


def pack(found: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, documents: int | None = None, attention: float | None = None, group: int = GROUP) -> DataFrame:
    """The pieces with sequence_id and offset."""
    found, _ = kit.keep(found, "pieces")
    n = max(1, -(-found.count() // group))

    def run(table: pa.Table) -> pa.Table:
        x = table.combine_chunks().sort_by([("length", "descending"), (key, "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        where, offset = best_fit(x.column("length").to_numpy(), capacity, documents, attention)
        first = x.column("_group")[0].as_py() << 40
        return x.drop_columns(["_group"]).append_column("sequence_id", pa.array(first + where)).append_column("offset", pa.array(offset))

    grouped = found.withColumn("_group", F.pmod(F.xxhash64(F.lit(5), key, "piece", "ids_crc32"), F.lit(n)).cast("long"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    return grouped.groupBy("_group").applyInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, end: int = 1, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    return pack(pieces(docs, vocabulary, end, limits.get("capacity", CAPACITY), key, text), key, **limits)
