"""Fuzzy line deduplication.

Lines are normalised: capitals lowered, digits made zeros, other ASCII signs made spaces, words joined by
one space. Lines with a word take part, whatever their length.

Runs of a line's bytes vote on its SimHash. The fingerprint has blocks of 32 bits, as many as the power of two that
leaves `VOTES` to twice as many runs for each, and a run votes in one block only, chosen by its hash: an edit of a few
runs touches as few blocks, and the others are equal (the pigeonhole). Blocks that all runs vote in would each change
with every edit: the 128-bit SimHash over whole words tried first found 0.36 of the similar pairs. The first blocks of
two such fingerprints are the line's keys: one of runs of eight bytes wherever they stand, which edits of words leave,
and one of runs of five bytes with the sixteenth of the line in which they stand, which scattered edits leave. Blocks of
fewer than `LEAST` votes say too little and are no keys, but for the shortest lines. Lines just above a length at which
the number of blocks doubles also write those of the length below, so lines of similar lengths have keys of one kind.
Lines with an equal block are candidates (the README has the share of similar pairs that this finds) and are
verified by the edit similarity of their whole normalised texts. Lines joined by such links, directly or through
others, are one group, as are equal lines; of each group, the occurrence in the document with the smallest id, on
its first line, stays.

Repeats within a slice of a task are settled where they are read, so a line that all documents have goes
to a reducer about once for each megabyte.

Defined results: a null text stays null and has no lines; an empty text has one empty line, which stays;
null ids sort last; rows equal in id and text are one document, so what one of them keeps the other keeps;
other columns are passed through; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexframe.llm import kit
from plexframe.llm.candidates import PAIRED, STEP, entries, groups, near, nearest, pair_up

MIN_WORDS = 1
#: Edit similarity as a whole percentage: 1 - distance / length of the longer.
PERCENT = 85
#: For each fingerprint the bytes of a run, the blocks that are keys, and the parts of a line that tell runs apart.
FINGERPRINTS = ((8, 16, 1), (5, 20, 16))
#: Runs for each block, from this to twice as many on the average, and the votes of a key at least.
VOTES, LEAST = 2, 3
#: Buckets that runs are counted in; pairs whose distances advance together, at least for each word and at most; 64-bit words of their texts.
_RUN_BITS, _MANY, _PAIRS, _WORDS = 14, 32, 1024, 32
#: Characters of the runs that two lines must share; least share of bins of signatures that agree, and the characters up to which lines are compared without.
_RUN, _ALIKE, _SHORT = 5, 0.14, 64
#: Most alike pairs of each component under a key that are verified, in each of `ROUNDS` rounds, before all that pass are.
FIRST, ROUNDS = 2, 1
#: Pairs and characters that a task collects before it verifies them.
_HELD = 8192, 1 << 23
#: An odd multiplier of runs.
_VOTE = np.uint64(0xA0761D6478BD642F)
#: For each byte value its bits, one to a byte.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()

#: What pair_up() takes: characters as powers of candidates.STEP, which only keep lines of unlike lengths from being paired.
ENTRY = ["u4", "u8", "u1"]

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 256)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x30:0x3A] = 0x30
_FOLD[0x0A] = 0x0A

#: An occurrence: hash of the line, document (key, id, null) and number of the line.
_SEEN = ["u8", "u8", "i8", "u1", "u4"]


def normalised(text: bytes) -> str:
    return b" ".join(_FOLD[np.frombuffer(text, np.uint8)].tobytes().split()).decode(errors="replace")


class Lines:
    """Lines of a run of rows that take part: row, number, hash, length and words."""

    def __init__(self, data: np.ndarray, off: np.ndarray, i: int, j: int, min_words: int = MIN_WORDS):
        plain = kit.Spans(data, off, i, j)
        self.raw, self.off = plain.data, plain.off
        s = kit.Spans(data, off, i, j)
        s.data = _FOLD[s.data]
        start, end, row = plain.lines()
        self.n_lines = np.bincount(row, minlength=j - i)
        number = np.arange(len(start)) - np.repeat(np.cumsum(self.n_lines) - self.n_lines, self.n_lines)
        ws, we, _ = s.words()
        self.folded, self.word_start, self.word_end = s.data, ws, we
        self.word = s.hashes(ws, we)
        of = np.searchsorted(start, ws, "right") - 1
        # an empty row's line may start where the next row's does; the later one has the word
        words = np.bincount(of, minlength=len(start))
        chars = np.bincount(of, weights=we - ws + 1, minlength=len(start)).astype(np.int64)
        use = words >= min_words
        at = np.concatenate([[0], np.cumsum(words)])[:-1]
        place = np.arange(len(of)) - at[of]
        piece = np.zeros(len(of) + 1, np.uint64)
        np.cumsum(kit.mix(self.word ^ kit.mix(place.astype(np.uint64) + np.uint64(7))), out=piece[1:])
        total = piece[at + words] - piece[at]
        self.hash = kit.mix(total + words.astype(np.uint64))[use]
        self.row, self.number, self.chars = row[use], number[use], chars[use]
        self.start, self.end, self.at, self.words = start[use], end[use], at[use], words[use]

    def keys(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, place in `which`) of the blocks of these lines."""
        place_of = np.full(len(self.row), -1, np.int64)
        place_of[which] = np.arange(len(which))
        # normalised lines one after the other, a space after each word
        rows = np.insert(self.folded, self.off[1:], 0x0A)
        inside = ~kit.SPACE[rows]
        kept = inside.copy()
        kept[1:] |= inside[:-1]
        plain = np.full(int(kept.sum()) + 8, 0x20, np.uint8)
        plain[:-8] = np.where(inside[kept], rows[kept], 0x20)
        ahead = np.concatenate([[0], np.cumsum(self.word_end - self.word_start + 1)])
        start, n = ahead[self.at], ahead[self.at + self.words] - ahead[self.at]
        if len(start) and (start[0] or (start[1:] != (start + n)[:-1]).any()):  # words of lines that take no part
            plain = np.concatenate([plain[:-8][np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())], plain[-8:]])
            start = np.cumsum(n) - n
        level = np.floor(np.log2(np.maximum(n / VOTES, 1))).astype(np.int64)
        chosen = place_of >= 0
        near = chosen & (level > 0) & (n * PERCENT <= 100 * VOTES * 2.0**level)
        word = np.ndarray((len(plain) - 7,), "<u8", plain.data, strides=(1,))[: int(n.sum())]
        key, place = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for kind, (size, blocks, parts) in enumerate(FINGERPRINTS):
            run = word & kit._MASK[size] if size < 8 else word.copy()
            short = n < size
            run[start[short]] &= kit._MASK[np.minimum(n[short], 8)]
            run *= _VOTE
            run >>= np.uint64(32)
            run = run.astype(np.uint32)
            # the upper bits of a run's hash are its block; of the blocks of the lower level each is two
            top = np.where(chosen, np.minimum(blocks << (32 - level + near), 0xFFFFFFFF), 0).astype(np.uint32)
            vote = np.flatnonzero(run < np.repeat(top, n))
            line = np.searchsorted(start, vote, "right") - 1
            left = n[line] - (vote - start[line])
            whole = (left >= size) | (left == n[line])
            vote, line = vote[whole], line[whole]
            hashed = run[vote].astype(np.int64)
            h = hashed.astype(np.uint64)
            if parts > 1:
                h = h ^ kit.mix(((vote - start[line]) * parts // n[line] + 1).astype(np.uint64))
            h = kit.mix(h)
            for high, some in ((level, np.ones(len(n), bool)), (level - 1, near)):
                block = hashed >> (32 - np.maximum(high, 0))[line]
                own = np.flatnonzero((block < blocks) & some[line])
                slot = line[own] * blocks + block[own]
                both = slot.astype(np.uint64) << np.uint64(40) | h[own] >> np.uint64(24)
                order = np.argsort(both)
                both = both[order]
                new = np.ones(len(own), bool)  # a run that a line repeats votes once
                new[1:] = both[1:] != both[:-1]
                order = order[new]
                slot, own = slot[order], own[order]
                cut = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.zeros(0, np.int64)
                votes = np.diff(np.append(cut, len(slot)))
                good = (votes >= LEAST) | (high[slot[cut] // blocks] <= 1)
                if not good.all():
                    own, slot = own[np.repeat(good, votes)], slot[np.repeat(good, votes)]
                    votes = votes[good]
                    cut = np.cumsum(votes) - votes
                bits = np.zeros(len(cut), np.uint64)
                for k in range(4):  # eight counters of a byte each at a time
                    sums = np.add.reduceat(_SPREAD[(h[own] >> np.uint64(8 * k)).astype(np.uint8)], cut) if len(cut) else bits
                    more = 2 * sums.view(np.uint8).reshape(-1, 8).astype(np.int64) > votes[:, None]
                    bits |= np.packbits(more, axis=1, bitorder="little").ravel().astype(np.uint64) << np.uint64(8 * k)
                at = slot[cut] // blocks
                name = (kind << 48 | high[at] << 40 | slot[cut] % blocks << 32).astype(np.uint64)
                key.append(kit.mix(bits | name)), place.append(place_of[at])
        return np.concatenate(key), np.concatenate(place)

    def text(self, i: int) -> str:
        return normalised(self.raw[self.start[i] : self.end[i]].tobytes())


def aligned_within(a: str, b: str, most: int, sure: int = 8) -> bool:
    """Whether a simple alignment needs `most` edits or fewer; if not, a better one may.

    After a difference it goes on where the next `sure` characters of a stand next in b."""
    i = j = cost = 0
    while cost <= most:
        step = 64
        while step:
            if a[i : i + step] == b[j : j + step] and i + step <= len(a):
                i, j = i + step, j + step
            else:
                step >>= 1
        if len(a) - i < sure or j == len(b):
            return cost + max(len(a) - i, len(b) - j) <= most
        left = most - cost
        for skip in range(min(left, len(a) - i - sure) + 1):
            at = b.find(a[i + skip : i + skip + sure], j, j + left + sure)
            if at >= 0:
                cost, i, j = cost + max(skip, at - j), i + skip, at
                break
        else:
            return False
    return False


def distance_within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is `most` or less, by a bit-parallel column for each character."""
    n = min(len(a), len(b))
    i = 0
    while i < n and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    n, i = min(len(a), len(b)), 0
    while i < n and a[-1 - i] == b[-1 - i]:
        i += 1
    a, b = a[: len(a) - i], b[: len(b) - i]
    if abs(len(a) - len(b)) > most:
        return False
    if not a or not b:
        return max(len(a), len(b)) <= most
    if len(a) > len(b):
        a, b = b, a
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = full, 0, len(a)
    for j, c in enumerate(b):
        match = at.get(c, 0)
        x = match | down
        d = (((x & up) + up) ^ up) | x
        plus, minus = down | ~(d | up) & full, up & d
        score += bool(plus & top) - bool(minus & top)
        if score - (len(b) - 1 - j) > most:
            return False
        plus = (plus << 1 | 1) & full
        up = (minus << 1 & full) | ~(d | plus) & full
        down = plus & d
    return score <= most


def may_be_similar(a: str, b: str, percent: int = PERCENT) -> bool:
    """Whether two texts share the runs that texts within the edit distance must share.

    An edit changes `_RUN` runs at most, so two texts at distance d share all but `_RUN` * d of the longer's. Runs
    are counted by buckets of a hash, which can only raise what is shared: no pair is lost."""
    x, y = (np.bincount(_runs(t), minlength=1 << _RUN_BITS) for t in (a, b))
    longer = max(len(a), len(b))
    return np.minimum(x, y).sum() >= longer - _RUN + 1 - _RUN * (longer * (100 - percent) // 100)


def similar(a: str, b: str, percent: int = PERCENT) -> bool:
    longer = max(len(a), len(b))
    most = longer * (100 - percent) // 100
    return aligned_within(a, b, most) or (may_be_similar(a, b, percent) and distance_within(a, b, most))


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def distances(a: list[str], b: list[str]) -> np.ndarray:
    """Edit distances of pairs; a's texts are not empty and no longer than b's.

    The bit-parallel columns of all pairs advance together, a character of b at a time; carries and shifts go
    from word to word. Pairs stand by falling length of b, so those not yet done are always the first ones."""
    n, m = (np.array([len(x) for x in side], np.int64) for side in (a, b))
    order = np.argsort(-m, kind="stable")
    n, m = n[order], m[order]
    p, t = (_codes([side[i] for i in order]) for side in (a, b))
    seen = np.zeros(int(max(p.max(), t.max())) + 1, bool)
    seen[p], seen[t] = True, True
    code, size = np.cumsum(seen) - 1, int(seen.sum())
    words, pairs = -(-int(n.max()) // 64), len(n)
    of = np.repeat(np.arange(pairs), n)
    place = np.arange(len(p)) - np.repeat(np.cumsum(n) - n, n)
    equal = np.zeros((words, pairs * size), np.uint64)
    # positions of a text differ, so adding their bits sets them
    np.add.at(equal, (place >> 6, of * size + code[p]), np.uint64(1) << (place & 63).astype(np.uint64))
    of = np.repeat(np.arange(pairs), m)
    at = np.zeros((int(m[0]), pairs), np.int64)
    at[np.arange(len(t)) - np.repeat(np.cumsum(m) - m, m), of] = of * size + code[t]
    going = np.searchsorted(-m, -np.arange(int(m[0])), "left")
    one, high, last, each = np.uint64(1), np.uint64(63), ((n - 1) & 63).astype(np.uint64), np.arange(pairs)
    up, down = np.full((words, pairs), ~np.uint64(0)), np.zeros((words, pairs), np.uint64)
    more, less = np.zeros_like(up), np.zeros_like(up)
    end = n - 1 >> 6
    out = n.copy()
    for j, k in enumerate(going.tolist()):
        carry, plus_in, minus_in = np.uint64(0), one, np.uint64(0)
        for w in range(words):
            u, v = up[w, :k], down[w, :k]
            x = equal[w][at[j, :k]] | v
            first = (x & u) + u
            total = first + carry
            carry = ((first < u) | (total < first)).astype(np.uint64)
            d = (total ^ u) | x
            plus, minus = v | ~(d | u), u & d
            more[w, :k], less[w, :k] = plus, minus
            shifted, grown = minus << one | minus_in, plus << one | plus_in
            plus_in, minus_in = plus >> high, minus >> high
            up[w, :k], down[w, :k] = shifted | ~(d | grown), grown & d
        at_end = end[:k], each[:k]
        out[:k] += (more[at_end] >> last[:k] & one).astype(np.int64) - (less[at_end] >> last[:k] & one).astype(np.int64)
    back = np.empty_like(out)
    back[order] = out
    return back


def all_similar(a: list[str], b: list[str], percent: int = PERCENT) -> np.ndarray:
    """similar() of many pairs; the distances that nothing cheaper settles are worked out together where there are many."""
    a, b = zip(*(sorted(pair, key=len) for pair in zip(a, b, strict=True)), strict=True) if a else ((), ())
    n, m = (np.array([len(x) for x in side], np.int64) for side in (a, b))
    most = m * (100 - percent) // 100
    out = m - n <= most
    left = []
    for i in np.flatnonzero(out).tolist():
        out[i] = aligned_within(a[i], b[i], int(most[i]))
        if not out[i] and may_be_similar(a[i], b[i], percent):
            left.append(i)
    left = np.array(left, np.int64)
    # texts of up to 1, 2, 4, ... words together
    words = np.array([1 << (int(k - 1) // 64).bit_length() if k else 0 for k in n[left]], np.int64)
    for w in np.unique(words).tolist():
        which = left[words == w]
        if not 0 < w <= _WORDS or len(which) < _MANY * w:
            out[which] = [distance_within(a[i], b[i], int(most[i])) for i in which.tolist()]
            continue
        which = which[np.argsort(m[which], kind="stable")]
        for i in range(0, len(which), _PAIRS):
            some = which[i : i + _PAIRS]
            kinds = len(set("".join(a[k] + b[k] for k in some)))
            # tables of equal characters take 16 MB at most
            step = max(1, (1 << 21) // (kinds * w))
            for part in (some[k : k + step] for k in range(0, len(some), step)):
                out[part] = distances([a[k] for k in part], [b[k] for k in part]) <= most[part]
    return out


def _order(x: np.ndarray) -> np.ndarray:
    """Occurrences by line, then by document and place in it."""
    return np.lexsort((x["f4"], x["f1"], x["f2"], x["f3"], x["f0"]))


def _same(x: np.ndarray) -> np.ndarray:
    """Which of these ordered occurrences have the line, document and number of the one before them."""
    same = np.zeros(len(x), bool)
    if len(x) > 1:
        same[1:] = (x["f0"][1:] == x["f0"][:-1]) & (x["f1"][1:] == x["f1"][:-1]) & (x["f4"][1:] == x["f4"][:-1])
    return same


def scan(rows: DataFrame, parts: int, min_words: int) -> DataFrame:
    """kind 0: blocks of first occurrences in a slice; kind 1: blocks of the others (document, line), which all go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name = batch.column(0).to_numpy().view(np.uint64)
            null = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            number = batch.column(1).fill_null(0).to_numpy()
            data, off = kit.texts(batch.column(2))
            found: list[tuple[int, int, bytes]] = []
            for i, j in kit.slices(off):
                x = Lines(data, off, i, j, min_words)
                seen = np.zeros(len(x.row), [(f"f{k}", d) for k, d in enumerate(_SEEN)])
                at = i + x.row
                for f, v in (("f0", x.hash), ("f1", name[at]), ("f2", number[at]), ("f3", null[at]), ("f4", x.number)):
                    seen[f] = v
                order = _order(seen)
                h = x.hash[order]
                new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
                # equal rows are one document: an occurrence like the one before it doesn't go
                first, again = order[new], seen[order[~new & ~_same(seen[order])]]
                seen = seen[first]
                found += [(0, p, b) for p, b in kit.blocks((seen["f0"] % np.uint64(parts)).astype(np.int64), [seen[f] for f in seen.dtype.names], parts)]
                found += [(1, p, b) for p, b in kit.blocks(np.zeros(len(again), np.int64), [again["f1"], again["f4"]], parts)]
            kind, part, body = zip(*found, strict=True) if found else ((), (), ())
            yield pa.record_batch([pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array(body, pa.binary())], ["kind", "part", "payload"])

    return rows.mapInArrow(run, "kind int, part int, payload binary")


def settle(table: pa.Table, parts: int) -> pa.Table:
    """Of equal lines in one part: kind 0 the first occurrence, kind 1 the others."""
    x = kit.unblock(table, _SEEN)
    x = x[_order(x)]
    h = x["f0"]
    new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
    # equal rows are one document: an occurrence like the one before it doesn't go
    first, again = x[new], x[~new & ~_same(x)]
    kind, part = [0], [0]
    packed = np.empty(len(first), [("h", "u8"), ("d", "u8"), ("i", "i8"), ("z", "u1"), ("l", "u4")])
    for a, b in zip(("h", "d", "i", "z", "l"), ("f0", "f1", "f2", "f3", "f4"), strict=True):
        packed[a] = first[b]
    body = [packed.tobytes()]
    for _, b in kit.blocks(np.zeros(len(again), np.int64), [again["f1"], again["f4"]], parts):
        kind.append(1), part.append(0), body.append(b)
    return pa.table({"kind": pa.array(kind, pa.int32()), "part": pa.array(part, pa.int32()), "payload": pa.array(body, pa.binary())})


def keyed(rows: DataFrame, parts: int, min_words: int, wave: int = 0, waves: int = 1) -> DataFrame:
    """Blocks of entries (key, line, characters), of each line once for a slice; of all keys those of one wave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = kit.texts(batch.column(2))
            for i, j in kit.slices(off):
                x = Lines(data, off, i, j, min_words)
                h, first = np.unique(x.hash, return_index=True)
                key, place = x.keys(first)
                if waves > 1:
                    own = kit.mix(key) % np.uint64(waves) == wave
                    key, place = key[own], place[own]
                size = np.minimum(np.rint(np.log(x.chars[first]) / np.log(STEP)), 255)
                yield entries(key, h[place], size[place], parts, ENTRY)

    return rows.mapInArrow(run, kit.BLOCK)


def _unpack(df: DataFrame, dtypes: list[tuple[str, str]], schema: str, wanted=None) -> DataFrame:
    """Rows of payloads as long columns; those only whose first column a broadcast filter lets through, if it is given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                x = np.frombuffer(raw, dtypes)
                x = x[wanted.value.may_hold(np.ascontiguousarray(x[dtypes[0][0]]))] if wanted is not None else x
                cols = [np.ascontiguousarray(x[n]) for n, _ in dtypes]
                yield pa.record_batch([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in cols], [n for n, _ in dtypes])

    return df.select("payload").mapInArrow(run, schema)


def fetch(rows: DataFrame, min_words: int, wanted) -> DataFrame:
    """(id, line) of normalised lines whose hashes the filter lets through, once for each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = kit.texts(batch.column(2))
            name, body = [], []
            for i, j in kit.slices(off):
                x = Lines(data, off, i, j, min_words)
                h, first = np.unique(x.hash, return_index=True)
                for k in first[wanted.value.may_hold(h)].tolist():
                    name.append(x.hash[k]), body.append(x.text(k))
            yield pa.record_batch([pa.array(np.array(name, np.uint64).view(np.int64)), pa.array(body, pa.string())], ["id", "line"])

    return rows.mapInArrow(run, "id long, line string")


def lines_of(ids: DataFrame, rows: DataFrame, min_words: int) -> tuple[DataFrame, str]:
    """A scratch table (id, line) of the normalised lines with these hashes."""
    spark = rows.sparkSession
    ids, path = kit.keep(ids.distinct(), "ids")
    wanted = spark.sparkContext.broadcast(kit.build_filter(ids, "id", ids.count()))
    found = kit.keep(fetch(rows, min_words, wanted).join(ids, "id", "left_semi").dropDuplicates(["id"]), "lines")
    kit.remove(spark, path)
    return found


def checked(percent: int):
    """Of batches (a, b, line, line) the pairs (a, b) whose lines are similar, many worked out together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            held.clear()
            good = all_similar(*(t.column(i).cast(pa.string()).to_pylist() for i in (2, 3)), percent)
            return t.select([0, 1]).filter(pa.array(good, pa.bool_())).combine_chunks()

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= _HELD[0] or sum(x.nbytes for x in held) >= _HELD[1]:
                yield from flush().to_batches()
        if held:
            yield from flush().to_batches()

    return run


def verify(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose lines are similar; found: lines_of() all of them."""

    left, right = (found.select(F.col("id").alias(f"id_{x}"), F.col("line").alias(f"t_{x}")) for x in "ab")
    joined = pairs.select("a", "b").join(left, F.col("a") == F.col("id_a")).join(right, F.col("b") == F.col("id_b"))
    good, _ = kit.keep(joined.select("a", "b", "t_a", "t_b").mapInArrow(checked(percent), "a long, b long"), "good")
    return good


def look(percent: int, first: int | None):
    """For candidates.groups(): pairs that the signatures let pass; of each component the `first` most alike pairs only, if given."""

    def run(n: np.ndarray, root: np.ndarray, chunk: np.ndarray, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [x.decode() for x in bodies]
        n = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(n, kind="stable")
        n, root, chunk, drawn = n[order], root[order], chunk[order], signatures([texts[i] for i in order.tolist()])
        a, b = near(n, root, chunk, percent)
        share = alike(drawn, a, b)
        fine = (share >= _ALIKE) | (n[a] < _SHORT)
        a, b, far = a[fine], b[fine], -share[fine]
        if first:
            a, b = nearest(a, b, far, root, first)
        return order[a], order[b]

    return run


def signatures(texts: list[str]) -> np.ndarray:
    """Of each text the least hash of its six-byte runs in each of 128 bins, as a byte; 0 for a bin without one."""
    raw = [t.encode() for t in texts]
    n = np.array([max(0, len(x) - 5) for x in raw], np.int64)
    data = np.frombuffer(b"".join(x + b" " * 8 for x in raw), np.uint8)
    start = np.concatenate([[0], np.cumsum([len(x) + 8 for x in raw])])[:-1]
    word = np.ndarray((len(data) - 7,), "<u8", data.data, strides=(1,))
    row = np.repeat(np.arange(len(texts)), n)
    h = (word[start[row] + np.arange(len(row)) - (np.cumsum(n) - n)[row]] & kit._MASK[6]) * _VOTE
    h = (h ^ h >> np.uint64(29)) * kit.BASE
    out = np.full(len(texts) * 128, 0xFFFFFFFF, np.uint32)
    np.minimum.at(out, row * 128 + (h >> np.uint64(57)).astype(np.int64), (h >> np.uint64(20)).astype(np.uint32) & np.uint32(0x7FFFFFFF))
    return np.where(out == 0xFFFFFFFF, 0, kit.mix(out.astype(np.uint64)) % np.uint64(255) + np.uint64(1)).astype(np.uint8).reshape(-1, 128)


def alike(drawn: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of bins, of those that either text of a pair (a, b) fills, in which they agree; eight bins are compared at a time.

    Lines at the limit of the edit similarity with edits as scattered as can be share 0.23 of their runs, 2.4 standard
    deviations above `_ALIKE`; lines of one language share about 0.05."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    words = np.ascontiguousarray(drawn).view(np.uint64)
    filled = np.packbits(drawn > 0, axis=1).view(np.uint64)
    out = np.zeros(len(a))
    for i in range(0, len(a), 1 << 14):
        p, q = a[i : i + (1 << 14)], b[i : i + (1 << 14)]
        x = words[p] ^ words[q]
        # the upper bit of each byte that differs
        differ = (((x & low) + low) | x) & ~low
        either = np.bitwise_count(filled[p] | filled[q]).sum(1, dtype=np.int64)
        out[i : i + (1 << 14)] = (either - np.bitwise_count(differ).sum(1, dtype=np.int64)) / np.maximum(either, 1)
    return out


def _runs(text: str) -> np.ndarray:
    """Buckets of a text's runs."""
    c = _codes([text])
    h = np.zeros(max(0, len(c) - _RUN + 1), np.uint32)
    for k in range(_RUN):
        h = (h ^ c[k : len(h) + k]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - _RUN_BITS)


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, percent: int = PERCENT, waves: int = 1) -> DataFrame:
    """(document, lines): the numbers of the lines that go, for each document_key() that has any.

    waves: parts in which the keys are shuffled, one after the other; two take half the disk and another scan."""
    spark = docs.sparkSession
    parts = 2 * kit.partitions(docs)
    rows = kit.split_rows(docs).select(document_key(key, text).alias("d"), F.col(key).cast("long").alias("i"), F.col(text).cast("string").alias("t"))
    seen, seen_path = kit.keep(scan(rows, parts, min_words), "seen")
    settled = seen.where("kind = 0").groupBy("part").applyInArrow(lambda t: settle(t, parts), "kind int, part int, payload binary")
    settled, settled_path = kit.keep(settled, "settled")
    found, found_paths = None, []
    for wave in range(waves):
        some, path = kit.keep(kit.block_reduce(keyed(rows, parts, min_words, wave, waves), lambda t: pair_up(t, int(percent / STEP), ENTRY), PAIRED), "candidates")
        # keys of a part are told apart by lower bits that those of another wave may have too
        some = some.withColumn("a", F.when(F.col("kind") == 1, F.col("a") + F.lit(wave << 56)).otherwise(F.col("a")))
        found = found.union(some) if found_paths else some
        found_paths.append(path)
    # all rounds of groups() look at these lines only
    ids = found.select(F.explode(F.when(F.col("kind") == 0, F.array("a", "b")).otherwise(F.array("b"))).alias("id"))
    texts, texts_path = lines_of(ids, rows, min_words)
    labels = groups(found, lambda pairs: verify(pairs, texts, percent), lambda _: texts.select("id", F.col("line").alias("body")), [*[(look(percent, FIRST), checked(percent))] * ROUNDS, (look(percent, None), checked(percent))])
    kit.remove(spark, texts_path)

    grouped = spark.sparkContext.broadcast(kit.build_filter(labels, "id", labels.count()))
    firsts = _unpack(settled.where("kind = 0"), [("h", "u8"), ("d", "u8"), ("i", "i8"), ("z", "u1"), ("l", "u4")], "h long, d long, i long, z long, l long", grouped)
    firsts = firsts.join(labels, F.col("h") == F.col("id")).select("root", F.struct("z", "i", "d", "l").alias("at"))
    best = firsts.groupBy("root").agg(F.min("at").alias("best"))
    others = firsts.join(best, "root").where(F.col("at") != F.col("best")).select(F.col("at.d").alias("d"), F.col("at.l").alias("l"))
    pair = [("d", "u8"), ("l", "u4")]
    gone = _unpack(seen.where("kind = 1").select("payload").union(settled.where("kind = 1").select("payload")), pair, "d long, l long").union(others)
    out, _ = kit.keep(gone.groupBy(F.col("d").alias("document")).agg(F.collect_set(F.col("l").cast("int")).alias("lines")), "gone")
    for path in (seen_path, settled_path, *found_paths):
        kit.remove(spark, path)
    return out


def document_key(key: str, text: str) -> F.Column:
    return F.xxhash64(F.col(f"`{key}`").cast("string"), F.col(f"`{text}`").cast("string"))


def cleaned(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """All rows with the columns _row (as given), _text (what stays), _lines, _gone (numbers of lines).

    Rows that a filter of bounded size knows to lose nothing stay where they are; the others are joined."""
    spark = docs.sparkSession
    gone = repeats(docs, key, text, **how)
    asked = kit.may_hold(spark.sparkContext.broadcast(kit.build_filter(gone, "document", gone.count())))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), document_key(key, text).alias("_d"), F.col(f"`{text}`").cast("string").alias("_t"))
    rows = rows.withColumn("_may", asked("_d"))
    joined = rows.where("_may").join(gone, F.col("_d") == F.col("document"), "left")
    whole = F.when(F.col("_t").isNull(), 0).otherwise(F.length("_t") - F.length(F.replace("_t", F.lit("\n"))) + 1)
    whole = rows.where("not _may").select("_row", F.col("_t").alias("_text"), whole.alias("_lines"), F.lit(0).alias("_gone"))
    x = joined.withColumn("_all", F.split("_t", "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), F.col("lines"))
    kept = F.array_join(F.transform(stay, lambda i: F.get("_all", i)), "\n")
    n = F.when(F.col("_t").isNull(), 0).otherwise(F.size("_all"))
    return whole.unionByName(x.select("_row", F.when(F.col("lines").isNull(), F.col("_t")).otherwise(kept).alias("_text"), n.alias("_lines"), F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).alias("_gone")))


def dedup_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows with what stays of their texts; rows of whose words nothing stays are dropped, as they repeat others whole."""
    x = cleaned(docs, key, text, **how)
    x = x.where((F.col("_gone") == 0) | F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
    out = {c: F.col("_row").getField(c) for c in docs.columns}
    out[text] = F.col("_text")
    if "n_chars" in out and docs.schema["n_chars"].dataType.simpleString() == "bigint":
        out["n_chars"] = F.when(F.col("_gone") > 0, F.char_length("_text").cast("long")).otherwise(out["n_chars"])
    return x.select(*(c.alias(n) for n, c in out.items()))
