"""Token counts of whole texts, with overlap resynchronisation for huge documents.

A text of up to `CHUNK` bytes is encoded at once. A longer one is encoded in chunks that overlap; the
tokens' offsets in two neighbouring chunks are compared, and the chunks are spliced at a boundary that
both have and that is proven stable: a space between two visible ASCII signs, before which the
vocabulary's pattern always cuts, whatever stands further left or right. Tokens left of it are counted
in the left chunk and those right of it in the right one. If an overlap holds no such place, it is
doubled; if it has grown to the whole left chunk, the two are encoded as one.

Defined results: a null or empty text has 0 bytes and 0 tokens; special strings inside a text count as
the library's default has it; repeated rows are counted alike; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexframe.llm import kit
from plexframe.llm.encode import Encoder, encoder

#: Bytes of a chunk and of the first try of an overlap.
CHUNK = 32_768
OVERLAP = 512


def stable(raw: np.ndarray, a: int, b: int) -> np.ndarray:
    """Positions p with a < p < b at which every encoding cuts: a space between two visible ASCII signs."""
    a, b = max(a + 1, 1), min(b, len(raw) - 1)
    p = np.arange(a, max(a, b))
    seen = (raw > 0x20) & (raw < 0x7F)
    return p[(raw[p] == 0x20) & seen[p - 1] & seen[p + 1]]


def _character(raw: np.ndarray, p: int) -> int:
    """The start of the character that holds byte p."""
    while 0 < p < len(raw) and raw[p] & 0xC0 == 0x80:
        p -= 1
    return p


def spliced(enc: Encoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[int, int]:
    """(tokens of the text, chunks encoded)."""
    data = text.encode()
    raw, n = np.frombuffer(data, np.uint8), len(data)

    def bounds(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        at, count = enc.bounds(data[a:b].decode())
        return at + a, count

    def upto(known: tuple[np.ndarray, np.ndarray], p: int) -> int:
        i = int(np.searchsorted(known[0], p, "right"))
        return int(known[1][i - 1]) if i else 0

    total, done, a, b = 0, 0, 0, _character(raw, min(chunk, n))
    left, chunks, lap = bounds(a, b), 1, overlap
    while b < n:
        c = _character(raw, b - lap) if b - lap > a else a
        if c <= a:  # no stable place in the whole chunk: encode it with the next as one
            b, lap = _character(raw, min(b + chunk, n)), overlap
            left, chunks = bounds(a, b), chunks + 1
            continue
        d = _character(raw, min(max(c + chunk, b + 1), n)) if c + chunk < n else n
        right = bounds(c, d)
        chunks += 1
        p = stable(raw, max(c, done), b)
        p = p[np.isin(p, left[0]) & np.isin(p, right[0])]
        if not len(p):
            lap *= 2
            continue
        at = int(p[len(p) // 2])
        total += upto(left, at) - (upto(left, done) if done else 0)
        done, a, b, left, lap = at, c, d, right, overlap
    last = int(left[1][-1]) if len(left[1]) else 0
    return total + last - (upto(left, done) if done else 0), chunks


def count_array(array: pa.Array, enc: Encoder, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, tokens, chunks) of each text of a string column."""
    data, off = kit.texts(array)
    size = np.diff(off)
    tokens, chunks = np.zeros(len(size), np.int64), np.ones(len(size), np.int64)
    huge = size > chunk
    at = 0
    while at < len(size):
        if huge[at]:
            tokens[at], chunks[at] = spliced(enc, data[off[at] : off[at + 1]].tobytes().decode(), chunk, overlap)
            at += 1
            continue
        to = at + int(np.argmax(huge[at:])) if huge[at:].any() else len(size)
        for i, j in kit.slices(off[at : to + 1]):
            _, rows = enc.slice(data, off, at + i, at + j)
            tokens[at + i : at + j] = np.diff(rows)
        at = to
    return size, tokens, chunks


def token_counts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """key, n_bytes, n_tokens, n_chunks of every row, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            found = count_array(batch.column(1), enc, chunk, overlap)
            yield pa.record_batch([batch.column(0), *map(pa.array, found)], ["k", "n_bytes", "n_tokens", "n_chunks"])

    kind = docs.schema[key].dataType.simpleString()
    rows = kit.split_rows(docs).select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, f"k {kind}, n_bytes long, n_tokens long, n_chunks long").withColumnRenamed("k", key)
