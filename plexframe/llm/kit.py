"""Shared ground of the text operators: scratch tables, block shuffles and a vectorised tokenizer.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``. UTF-8 never uses those bytes inside a
longer character, so words, lines and code points can all be found on the raw Arrow buffer with numpy,
without making a Python string for each of them. Equality of words, lines and shingles is equality of
64-bit hashes; among 10**9 distinct values the chance that any two collide is about 3 %, and one collision
changes one word count by one.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at a time; temporary arrays take about 40 times as much.
SLICE_BYTES = 1 << 20


# ---------------------------------------------------------------- scratch tables


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share; removed at exit."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        base = tempfile.mkdtemp(prefix="plexframe-")  # driver and executors are one process
        spark.sparkContext.setCheckpointDir(base)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/plexframe-{name}-{uuid.uuid4().hex[:12]}")
    # with its scheme, so that Spark's writers and files written from Python go to the same place
    path = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
    atexit.register(remove, spark, path)
    if _open:
        _open[-1].append(path)
    return path


_open: list[list[str]] = []


@contextlib.contextmanager
def scratch_of_a_step(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch folders made inside when it ends, but those given to release()."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            remove(spark, path)


def release(path: str) -> None:
    """Keeps a scratch folder beyond the step in which it was made."""
    for made in _open:
        if path in made:
            made.remove(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder; one that is gone, or a session that has ended, is no error."""
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may have ended before
        return


#: Shuffle files of a table that is written go when it is there, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes df to a scratch table and reads it back: lineage ends there, and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def records(table: pa.Table | pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    yield from table.to_batches() if isinstance(table, pa.Table) else (table,)


# ---------------------------------------------------------------- text buffers


#: Multiplier of combined hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that are hashed as one piece; masks of the last, partial word of a piece; second lane's constant.
_PIECE = 128
_MASK = np.array([0, *((1 << 8 * k) - 1 for k in range(1, 8)), (1 << 64) - 1], np.uint64)
_LANE = np.uint64(0xD6E8FEB86659FD93)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is the empty text."""
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, where, data = array.buffers()
    off = np.frombuffer(where, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1] if where else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), off.astype(np.int64)


def slices(off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `most` bytes; a longer row stands alone, whole."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


class Spans:
    """Byte ranges of some kind (words, lines) in a run of rows, with hashes of their bytes on demand."""

    def __init__(self, data: np.ndarray, off: np.ndarray, i: int, j: int):
        self.data, self.off, self.rows = data[off[i] : off[j]], off[i : j + 1] - off[i], j - i
        self._padded: tuple[bool, np.ndarray] | None = None

    def row_of(self, start: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, start, "right") - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and rows of all words."""
        inside = ~SPACE[self.data]
        before, after = np.empty_like(inside), np.empty_like(inside)
        if not len(inside):
            none = np.zeros(0, np.int64)
            return none, none, none
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        edge = self.off[(self.off > 0) & (self.off < len(inside))]
        before[edge], after[edge - 1] = False, False
        start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        return start, end, self.row_of(start)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and rows of the pieces between line feeds; a row has one line at least."""
        feed = np.flatnonzero(self.data == 10)
        start = np.concatenate([self.off[:-1], feed + 1])
        row = np.concatenate([np.arange(self.rows), self.row_of(feed)])
        order = np.lexsort((start, row))
        start, row = start[order], row[order]
        end = np.empty_like(start)
        end[:-1] = start[1:] - 1
        last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
        end[last] = self.off[1:]
        return start, end, row

    def hashes(self, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
        """64-bit hashes of the bytes of each range; lower: as if A-Z were a-z.

        Ranges are cut into pieces of 128 bytes. A piece is read eight bytes at a time into two lanes that are mixed at
        each step, so strings of a regular build, which collide under polynomials modulo 2**64, don't collide here."""
        if self._padded is None or self._padded[0] != lower:
            padded = np.zeros(len(self.data) + 8, np.uint8)
            padded[: len(self.data)] = LOWER[self.data] if lower else self.data
            self._padded = lower, np.ndarray((len(self.data) + 1,), "<u8", padded.data, strides=(1,))
        words, size = self._padded[1], end - start
        if not len(size):
            return np.zeros(0, np.uint64)
        if int(size.max()) <= _PIECE:
            out = self._pieces(words, start, size)
        else:
            pieces = np.maximum(1, -(-size // _PIECE))
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            at = np.repeat(start, pieces) + _PIECE * nth
            h = self._pieces(words, at, np.minimum(_PIECE, np.repeat(end, pieces) - at))
            out = np.add.reduceat(mix(h ^ mix(nth.astype(np.uint64)) if len(h) else h), np.cumsum(pieces) - pieces)
            out = np.where(pieces == 1, h[np.cumsum(pieces) - pieces], out)
        return mix(out ^ mix(size.astype(np.uint64)))

    @staticmethod
    def _pieces(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        one, two = np.zeros(len(size), np.uint64), np.full(len(size), _LANE)
        live, k = np.arange(len(size)), 0
        while len(live):
            left = size[live] - k
            if k:
                live, left = live[left > 0], left[left > 0]
                if not len(live):
                    break
            x = words[start[live] + np.where(left > 0, k, 0)] & _MASK[np.clip(left, 0, 8)]
            one[live] = mix(one[live] ^ x)
            two[live] = (two[live] + x) * BASE ^ (two[live] >> np.uint64(29))
            k += 8
        return one + mix(two)


def windows(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of each run of k words within a row."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mix(out * BASE + h[i : i + n])
    first = np.flatnonzero(row[:n] == row[k - 1 :])
    return out[first], first


def digest(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit hash of several 64-bit columns."""
    out = np.zeros(len(parts[0]), np.uint64)
    for x in parts:
        out = mix(out * BASE + x.astype(np.uint64))
    return out


def row_keys(ids: pa.Array, array: pa.Array) -> np.ndarray:
    """A 64-bit key of each row from its id and its whole text; equal rows get equal keys. A null id has a key of its own."""
    data, off = texts(array)
    out = np.zeros(len(array), np.uint64)
    for i, j in slices(off):
        s = Spans(data, off, i, j)
        out[i:j] = s.hashes(s.off[:-1], s.off[1:])
    null = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), bool)
    number = ids.cast(pa.int64()).fill_null(0).to_numpy().astype(np.uint64)
    return digest(out, number, null)


# ---------------------------------------------------------------- block shuffle

#: What block_shuffle() moves: arrays packed into one value for each target part and task slice.
BLOCK = "part int, payload binary"


def blocks(part: np.ndarray, columns: list[np.ndarray], parts: int) -> Iterator[tuple[int, bytes]]:
    """Splits parallel arrays by part (0 .. parts-1): (part, bytes) of each part that has rows."""
    if not len(part):
        return
    table = np.empty(len(part), np.dtype([(f"f{i}", c.dtype) for i, c in enumerate(columns)]))
    for i, c in enumerate(columns):
        table[f"f{i}"] = c
    order = np.argsort(part, kind="stable")
    table, part = table[order], part[order]
    cut = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cut], [*cut, len(part)], strict=True):
        yield int(part[a]), table[a:b].tobytes()


def block_batch(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([p for p, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["part", "payload"])


def unblock(table: pa.Table, dtypes: list[str]) -> np.ndarray:
    """The rows of all payloads of a group as one structured array with fields f0, f1, ..."""
    kind = np.dtype([(f"f{i}", d) for i, d in enumerate(dtypes)])
    found = [np.frombuffer(x, kind) for x in table.column("payload").to_pylist()]
    return np.concatenate(found) if found else np.zeros(0, kind)


def block_reduce(df: DataFrame, reduce: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Brings the blocks of each part together in one task and hands them to `reduce`."""
    return df.groupBy("part").applyInArrow(reduce, schema)


def by_group(df: DataFrame, by: list[str], work: Callable[[pa.Table], pa.Table], schema: str, then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None) -> DataFrame:
    """work() on the rows of each group, many small groups to a task; rows come sorted by `by`. then() goes over what work() gives in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from then(groups(batches)) if then else groups(batches)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            keys = [t.column(c).to_numpy() for c in by]
            new = np.zeros(len(t), bool)
            for c, k in zip(by, keys, strict=True):
                new[1:] |= k[1:] != k[:-1]
                new[0] |= bool(held) and held[-1].column(c)[-1].as_py() != k[0]
            cut = np.flatnonzero(new)
            for a, b in zip([0, *cut], [*cut, len(t)], strict=True):
                if new[a] and held:
                    yield from records(work(pa.concat_tables(held)))
                    held = []
                if b > a:
                    held.append(t.slice(a, b - a))
        if held:
            yield from records(work(pa.concat_tables(held)))

    return df.repartition(partitions(df), *by).sortWithinPartitions(*by).mapInArrow(run, schema)


# ---------------------------------------------------------------- documents


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def split_rows(df: DataFrame, most: int = 1024) -> DataFrame:
    """Asks for small Arrow batches, so that a batch of long texts fits a Python worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(most))
    return df


def long_or(name: str) -> F.Column:
    return F.col(name).cast("long")


def share(base: str) -> str:
    """A local path of a shared folder given as file:// URL or as a plain path."""
    return base[7:] if base.startswith("file://") else base[5:] if base.startswith("file:") else base


def filesystem(path: str):
    """(pyarrow file system, path in it) of a scratch folder; local paths and file: URLs, else whatever pyarrow knows."""
    from pyarrow import fs

    local = share(path)
    if local != path or path.startswith("/"):
        return fs.LocalFileSystem(), os.path.normpath(local)
    return fs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- a bounded filter for second scans

#: Bits of a filter at least and at most: 8 KB and 16 MB, whatever the input's size.
FILTER_BITS = (1 << 16, 1 << 27)
_CHUNK_BITS = 1 << 16


class Filter:
    """Says of a 64-bit hash whether it may be in a set: no false no; a false yes costs a later join a row."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.size = bits, np.uint64(8 * len(bits))

    @staticmethod
    def places(h: np.ndarray, size: np.uint64) -> list[np.ndarray]:
        return [(mix(h ^ np.uint64(seed)) % size).astype(np.int64) for seed in (0x51ED270B, 0xB492B66F)]

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for p in self.places(h, self.size):
            out &= (self.bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        return out


def may_hold(some) -> Callable[[F.Column], F.Column]:
    """A column function that asks a broadcast Filter about a column of 64-bit hashes; other columns stay out of Python."""

    @F.arrow_udf("boolean")
    def ask(h: pa.Array) -> pa.Array:
        return pa.array(some.value.may_hold(h.to_numpy(zero_copy_only=False).view(np.uint64)))

    return ask


def build_filter(ids: DataFrame, name: str, count: int) -> Filter:
    """A Filter of a column of hashes; partial filters are united on the executors, chunk by chunk."""
    size = min(max(1 << int(np.ceil(np.log2(12 * max(count, 1)))), FILTER_BITS[0]), FILTER_BITS[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size // 8, np.uint8)
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            for p in Filter.places(h, np.uint64(size)):
                np.bitwise_or.at(bits, p >> 3, np.uint8(1) << (p & 7).astype(np.uint8))
        rows = bits.reshape(-1, _CHUNK_BITS // 8)
        used = np.flatnonzero(rows.any(1))
        yield block_batch([(int(i), rows[i].tobytes()) for i in used])

    def unite(table: pa.Table) -> pa.Table:
        chunks = [np.frombuffer(x, np.uint8) for x in table.column("payload").to_pylist()]
        whole = np.bitwise_or.reduce(chunks)
        return pa.table({"part": table.column("part").slice(0, 1), "payload": pa.array([whole.tobytes()], pa.binary())})

    bits = np.zeros(size // 8, np.uint8)
    found = block_reduce(ids.select(F.col(name).cast("long")).mapInArrow(run, BLOCK), unite, BLOCK)
    found = found.toArrow()  # 16 MB at most; an iterator would run a job for each partition
    for part, payload in zip(found["part"].to_pylist(), found["payload"].to_pylist(), strict=True):
        bits[part * (_CHUNK_BITS // 8) : (part + 1) * (_CHUNK_BITS // 8)] = np.frombuffer(payload, np.uint8)
    return Filter(bits)
