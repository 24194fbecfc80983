"""Token ids in binary shards with a minimal perfect hash index.

Rows are encoded where they are read; the ids go to the shard that holds their range of keys, packed in
blocks, and each shard is written in ascending order of keys as two files:

* ``shard-NNNNNN.ids``: the ids of all its rows, one after the other, as little-endian unsigned 16-bit
  integers if every id of the vocabulary fits, else 32-bit ones, and nothing else;
* ``shard-NNNNNN.mph``: a header, the displacements of a minimal perfect hash over the keys, and for each
  slot a 32-bit fingerprint of its key, the key, its place and its number of ids.

A lookup hashes the key to a bucket, reads the bucket's displacement, hashes to a slot, compares the
fingerprint (and, as it is stored, the key) and reads that many ids at that place: three reads, whatever
the size. Files are written under a name of their own and then renamed, so a task that runs again leaves
the same files.

Defined results: a null or empty text has the end id only; a null key sorts first; rows of equal key are
told apart by their number (0, 1, ...) in order of their ids; other columns are not looked at; an empty
table gives no shard and no row. Rows of one key share a shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexframe.llm import kit
from plexframe.llm.encode import encoder

MAGIC = b"PFSHARD1"
#: Header of an index: magic, rows, buckets, bytes of an id, seed.
HEADER = struct.Struct("<8sqqqq")
SLOT = np.dtype([("mark", "<u4"), ("null", "u1"), ("key", "<i8"), ("nth", "<u4"), ("at", "<i8"), ("size", "<i8")])
PER_BUCKET = 4


# ---------------------------------------------------------------- minimal perfect hash


def _hash(key: np.ndarray, null: np.ndarray, nth: np.ndarray, seed: int) -> np.ndarray:
    return kit.digest(np.full(len(key), seed, np.uint64), key.astype(np.int64).view(np.uint64), null, nth)


def _slot(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    return (kit.mix(h ^ kit.mix(d.astype(np.uint64) + np.uint64(1))) % np.uint64(n)).astype(np.int64)


def perfect(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacement of each bucket, slot of each hash): n distinct hashes fill n slots.

    Buckets are placed from the largest down, each with the first displacement that hits free slots only;
    buckets of one key take the free slots that remain, stored as -1 - slot.
    """
    n = len(h)
    m = max(1, n // PER_BUCKET)
    bucket = (h % np.uint64(m)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    size = np.bincount(bucket, minlength=m)
    first = np.concatenate([[0], np.cumsum(size)])
    shift, slot, taken = np.zeros(m, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    for b in np.argsort(-size, kind="stable"):
        k = int(size[b])
        if k <= 1:
            break
        own = order[first[b] : first[b + 1]]
        d = 0
        while True:
            tries = np.arange(d, d + 64)
            at = _slot(np.tile(h[own], 64), np.repeat(tries, k), n).reshape(64, k)
            fine = ~taken[at].any(1)
            if fine.any():
                s = np.sort(at[fine], 1)
                good = (s[:, 1:] != s[:, :-1]).all(1)
                if good.any():
                    i = np.flatnonzero(fine)[np.argmax(good)]
                    shift[b], slot[own] = tries[i], at[i]
                    taken[at[i]] = True
                    break
            d += 64
    single, free = np.flatnonzero(size == 1), np.flatnonzero(~taken)
    shift[single] = -1 - free[: len(single)]
    slot[order[first[single]]] = free[: len(single)]
    return shift, slot


def place(h: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    """Slots of hashes; a hash that was not among those indexed gets some slot."""
    d = shift[(h % np.uint64(len(shift))).astype(np.int64)]
    return np.where(d < 0, -1 - d, _slot(h, np.maximum(d, 0), n))


# ---------------------------------------------------------------- files


def _write(path: str, name: str, content: bytes) -> None:
    fs, base = kit.filesystem(path)
    fs.create_dir(base, recursive=True)
    own = f"{base}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as out:
        out.write(content)
    fs.move(own, f"{base}/{name}")


def _read(path: str, name: str) -> bytes:
    fs, base = kit.filesystem(path)
    with fs.open_input_stream(f"{base}/{name}") as f:
        return f.read()


def write_shard(path: str, part: int, null: np.ndarray, key: np.ndarray, rows: list[bytes], width: int) -> int:
    """Writes one shard from rows in any order (ids of each as packed integers); returns its number of ids."""
    order = sorted(range(len(rows)), key=lambda i: (not null[i], int(key[i]), rows[i]))
    null, key = null[order].astype(np.uint8), key[order].astype(np.int64)
    size = np.array([len(rows[i]) // width for i in order], np.int64)
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (null[1:] != null[:-1])
    nth = np.arange(len(key)) - np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    seed = 0
    while len(np.unique(h := _hash(key, null, nth, seed))) < len(h):
        seed += 1
    shift, slot = perfect(h)
    table = np.zeros(len(key), SLOT)
    for f, x in (("mark", _mark(h)), ("null", null), ("key", key), ("nth", nth), ("at", np.cumsum(size) - size), ("size", size)):
        table[f][slot] = x
    _write(path, f"shard-{part:06d}.ids", b"".join([rows[i] for i in order]))
    _write(path, f"shard-{part:06d}.mph", HEADER.pack(MAGIC, len(key), len(shift), width, seed) + shift.astype("<i8").tobytes() + table.tobytes())
    return int(size.sum())


def _mark(h: np.ndarray) -> np.ndarray:
    return (kit.mix(h ^ np.uint64(0x5BD1E995)) >> np.uint64(32)).astype(np.uint32)


class Shard:
    """An index in memory, with keyed reads of its ids."""

    def __init__(self, path: str, part: int):
        raw = _read(path, f"shard-{part:06d}.mph")
        magic, self.n, m, self.width, self.seed = HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError(f"{path}: not a shard index")
        self.shift = np.frombuffer(raw, "<i8", m, HEADER.size)
        self.table = np.frombuffer(raw, SLOT, self.n, HEADER.size + 8 * m)
        fs, base = kit.filesystem(path)
        self.file = fs.open_input_file(f"{base}/shard-{part:06d}.ids")

    def find(self, key: np.ndarray, null: np.ndarray | None = None, nth: np.ndarray | None = None) -> np.ndarray:
        """Slots of keys, -1 for keys that the shard doesn't hold."""
        null = np.zeros(len(key), np.uint8) if null is None else null
        nth = np.zeros(len(key), np.int64) if nth is None else nth
        h = _hash(key, null, nth, self.seed)
        slot = place(h, self.shift, self.n)
        t = self.table[slot]
        held = (t["mark"] == _mark(h)) & (t["key"] == key) & (t["null"] == null) & (t["nth"] == nth)
        return np.where(held, slot, -1)

    def ids(self, slot: int) -> np.ndarray:
        t = self.table[slot]
        raw = self.file.read_at(int(t["size"]) * self.width, int(t["at"]) * self.width)
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4")

    def keys(self) -> np.ndarray:
        """All entries in the order of the payload."""
        return self.table[np.lexsort((self.table["nth"], self.table["at"]))]

    def close(self) -> None:
        self.file.close()


# ---------------------------------------------------------------- jobs


def write_ids(docs: DataFrame, vocabulary: str, end: int = 0, key: str = "doc_id", text: str = "text", path: str | None = None, shards: int | None = None) -> DataFrame:
    """Encodes and writes all rows; one row for each shard: path, part, n_rows, n_ids, start (ids in all shards before)."""
    spark = docs.sparkSession
    n = shards or 2 * kit.partitions(docs)
    path = path or kit.scratch(spark, "ids")
    keys = docs.select(F.col(key).cast("long").alias("k"))
    cuts = keys.agg(F.percentile_approx("k", [i / n for i in range(1, n)], max(10_000, 20 * n)).alias("q")).first().q if n > 1 else None
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        kind = "<u2" if max(enc.top, end + 1) <= 1 << 16 else "<u4"
        for batch in batches:
            k, t = batch.column(0), batch.column(1)
            null = k.is_null().to_numpy(zero_copy_only=False)
            number = k.fill_null(0).to_numpy()
            part = np.where(null, 0, np.searchsorted(cuts, number, "left"))
            found: dict[int, list[bytes]] = {}
            for i, j, ids, off in enc.rows(t):
                raw, w = ids.astype(kind).tobytes(), np.dtype(kind).itemsize
                last = np.array([end], kind).tobytes()
                for r in range(j - i):
                    body = raw[w * off[r] : w * off[r + 1]] + last
                    found.setdefault(int(part[i + r]), []).append(struct.pack("<?qq", null[i + r], number[i + r], len(body)) + body)
            yield kit.block_batch([(p, b"".join(x)) for p, x in found.items()])

    def finish(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        null, number, rows = [], [], []
        for raw in table.column("payload").to_pylist():
            at = 0
            while at < len(raw):
                x, k, size = struct.unpack_from("<?qq", raw, at)
                at += 17
                null.append(x), number.append(k), rows.append(raw[at : at + size])
                at += size
        width = 2 if max(encoder(vocabulary).top, end + 1) <= 1 << 16 else 4
        total = write_shard(path, part, np.array(null), np.array(number, np.int64), rows, width)
        return pa.table({"path": [path], "part": pa.array([part], pa.int32()), "n_rows": [len(rows)], "n_ids": [total]})

    rows = kit.split_rows(docs).select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    done = kit.block_reduce(rows.mapInArrow(run, kit.BLOCK), finish, "path string, part int, n_rows long, n_ids long")
    done, _ = kit.keep(done, "shards")  # one short row for each shard
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return done.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_ids(shards: DataFrame) -> DataFrame:
    """key, nth, start, n_ids, ids_crc32 of every row, each read from its shard by its key through the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = Shard(row["path"], row["part"])
                t = s.keys()
                slot = s.find(t["key"], t["null"], t["nth"])
                if (slot < 0).any():
                    raise ValueError(f"{row['path']}: shard {row['part']} lacks a key that it lists")
                crc = [zlib.crc32(s.ids(int(i)).astype("<u4").tobytes()) for i in slot]
                yield pa.record_batch([pa.array(t["key"], pa.int64(), mask=t["null"].astype(bool)), pa.array(t["nth"].astype(np.int64)), pa.array(row["start"] + s.table["at"][slot]), pa.array(s.table["size"][slot].astype(np.int64)), pa.array(crc, pa.int64())], ["key", "nth", "start", "n_ids", "ids_crc32"])
                s.close()

    return shards.repartition(kit.partitions(shards), "part").mapInArrow(run, "key long, nth long, start long, n_ids long, ids_crc32 long")


def lookup(shards: DataFrame, part: int, keys: list[int]) -> list[np.ndarray | None]:
    """ids of keys of one shard, None for keys that it doesn't hold."""
    s = Shard(shards.first().path, part)
    try:
        return [s.ids(int(i)) if i >= 0 else None for i in s.find(np.array(keys, np.int64))]
    finally:
        s.close()
