"""Exact encoding of whole texts with a given vocabulary file, remembering what pieces give.

The `tokenizers` library cuts a text into pieces by a pattern and merges each piece on its own, so the
ids of a text are the ids of its pieces in order. Nearly all of its time goes into pieces that it has
merged before. Encoder finds the pieces of plain texts with numpy, lets the library's own model merge each
new piece once, and copies remembered ids for the rest.

Plain texts hold ASCII without quotes, tabs and other controls, Latin letters up to U+023F, and, for the
byte-level pattern, single spaces and line feeds between words only. There, pieces are runs of letters,
of digits and of other signs, with the one space before them; a line feed stands alone. For the
vocabulary of lower-case words with word ends, white space is dropped, digits stand alone and capitals
are lowered first. Every other text goes to the library whole. The tests compare both ways.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa

from plexframe.llm import kit

#: Remembered pieces of one Python worker (about 40 bytes each); when full it starts anew, which costs time only.
MOST_PIECES = 3_000_000

#: The byte values that stand for themselves in a byte-level vocabulary.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

#: Bytes of a piece that may be remembered by its hash; texts with longer ones go to the library.
MOST_BYTES = 64

_SPACE, _FEED, _LETTER, _DIGIT, _SIGN, _BAD = range(6)


def _classes() -> np.ndarray:
    out = np.full(256, _BAD, np.uint8)
    out[0x21:0x7F] = _SIGN
    out[0x30:0x3A] = _DIGIT
    out[0x41:0x5B] = out[0x61:0x7B] = _LETTER
    out[0x80:0xC0] = _LETTER  # continuations
    out[0xC3:0xC9] = _LETTER  # U+00C0 to U+023F
    out[0x20], out[0x0A], out[ord("'")] = _SPACE, _FEED, _BAD
    return out


CLASS = _classes()


def _byte_table() -> dict[int, str]:
    table, spare = {b: chr(b) for b in _PRINTED}, 256
    for b in range(256):
        if b not in table:
            table[b], spare = chr(spare), spare + 1
    return table


class Memo:
    """Hash of a piece -> its ids, as sorted arrays: one large run and one of recent pieces."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.runs = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2)]
        self.at, self.size, self.ids, self.n, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32), 0, 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of entries, -1 for unknown hashes."""
        out = np.full(len(h), -1, np.int64)
        for keys, entry in self.runs:
            if len(keys):
                i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[i] == h
                out[hit] = entry[i[hit]]
        return out

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        if n <= len(a):
            return a
        out = np.zeros(max(n, 2 * len(a)), a.dtype)
        out[: len(a)] = a
        return out

    def add(self, h: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        n = len(h)
        self.at, self.size, self.ids = self._room(self.at, self.n + n), self._room(self.size, self.n + n), self._room(self.ids, self.used + len(ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.size[self.n : self.n + n] = size
        self.at[self.n : self.n + n] = self.used + np.concatenate([[0], np.cumsum(size)[:-1]]) if n else 0
        (big, big_at), (new, new_at) = self.runs
        keys, entry = np.concatenate([new, h]), np.concatenate([new_at, np.arange(self.n, self.n + n)])
        self.n, self.used = self.n + n, self.used + len(ids)
        if len(keys) > 100_000 + len(big) // 4:
            keys, entry, big, big_at = np.concatenate([big, keys]), np.concatenate([big_at, entry]), new[:0], new_at[:0]
            order = np.argsort(keys, kind="stable")
            self.runs = [(keys[order], entry[order]), (big, big_at)]
        else:
            order = np.argsort(keys, kind="stable")
            self.runs = [(big, big_at), (keys[order], entry[order])]


class Encoder:
    """ids of whole texts as the library gives them with add_special_tokens=False."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        about = json.loads(Path(path).read_text())
        level, norm = about.get("pre_tokenizer") or {}, json.dumps(about.get("normalizer"))
        steps = json.dumps(level)
        vocabulary = about["model"]["vocab"]
        self.spaced = about.get("normalizer") is None and level.get("type") == "ByteLevel" and level.get("use_regex", True) and not level.get("add_prefix_space")
        self.worded = '"Lowercase"' in norm and '"invert": true' in steps and '"Removed"' in steps and about["model"].get("end_of_word_suffix") is not None
        #: Largest id plus one, and the bytes that each id of a byte-level vocabulary stands for.
        self.top = 1 + max([*vocabulary.values(), *(t["id"] for t in about.get("added_tokens", []))])
        self.width = np.zeros(self.top, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token)
        self.bare = Tokenizer(self.full.model)
        self.table = _byte_table()
        self.memo = Memo()

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)

    # ------------------------------------------------------------ plain texts

    def _plain(self, s: kit.Spans) -> tuple[np.ndarray, np.ndarray]:
        """(class of each byte, which rows are plain); capitals of s are lowered here if the vocabulary asks for it."""
        d = s.data
        c = CLASS[d]
        bad = c == _BAD
        if len(d) > 1:
            bad[1:] |= (d[:-1] == 0xC3) & ((d[1:] == 0x97) | (d[1:] == 0xB7))
            bad[1:] |= (d[:-1] == ord("<")) & (d[1:] == ord("|"))
        if self.worded:
            bad |= (d > 0xC3) & (d < 0xC9)  # capitals there are not lowered by one rule
        else:
            gap = c <= _FEED
            if len(d) > 1:
                bad[1:] |= gap[1:] & gap[:-1]
            full = s.off[1:] > s.off[:-1]
            for edge in (s.off[:-1][full], s.off[1:][full] - 1):
                bad[edge] |= gap[edge]
        sums = np.zeros(len(d) + 1, np.int64)
        np.cumsum(bad, out=sums[1:])
        plain = np.diff(sums[s.off]) == 0
        if self.worded:
            d = kit.LOWER[d]
            if len(d) > 1:
                d[1:][(d[:-1] == 0xC3) & (d[1:] >= 0x80) & (d[1:] <= 0x9E)] += 0x20
            s.data = d
        return c, plain

    def _pieces(self, s: kit.Spans, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(c)
        cut = np.ones(n + 1, bool)
        if n > 1:
            cut[1:n] = c[1:] != c[:-1]
            if self.worded:
                cut[1:n] |= c[1:] == _DIGIT
            else:
                cut[1:n] &= c[:-1] != _SPACE
        cut[s.off] = True
        at = np.flatnonzero(cut)
        start, end = at[:-1], at[1:]
        if self.worded:
            word = c[start] > _FEED
            start, end = start[word], end[word]
        return start, end

    def _learn(self, s: kit.Spans, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        raw = s.data.tobytes()
        pieces = [raw[a:b].decode("latin-1").translate(self.table) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        done = self.bare.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        size = np.bincount(np.array(done.word_ids, np.int64), minlength=len(pieces))
        self.memo.add(h, np.array(done.ids, np.uint32), size)

    def slice(self, data: np.ndarray, off: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of rows i to j, offsets of the rows in them)."""
        s = kit.Spans(data, off, i, j)
        raw = s.data
        c, plain = self._plain(s) if self.spaced or self.worded else (None, np.zeros(j - i, bool))
        count, ids, row = np.zeros(j - i, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if plain.any():
            start, end = self._pieces(s, c)
            of = s.row_of(start)
            plain[of[end - start > MOST_BYTES]] = False
            if not plain.all():
                ok = plain[of]
                start, end, of = start[ok], end[ok], of[ok]
            h = s.hashes(start, end)
            kinds, first, which = np.unique(h, return_index=True, return_inverse=True)
            entry = self.memo.find(kinds)
            new = entry < 0
            if new.any():
                if self.memo.n + int(new.sum()) > MOST_PIECES:
                    self.memo.clear()
                    new = np.ones(len(kinds), bool)
                self._learn(s, kinds[new], start[first[new]], end[first[new]])
                entry = self.memo.find(kinds)
            m = self.memo
            at, size = m.at[entry][which], m.size[entry][which]
            total = np.cumsum(size)
            ids = m.ids[np.arange(total[-1] if len(total) else 0) + np.repeat(at - (total - size), size)]
            count = np.bincount(of, weights=size, minlength=j - i).astype(np.int64)
        if not plain.all():
            got, at = [], np.concatenate([[0], np.cumsum(count)])
            for r in range(j - i):
                if plain[r]:
                    got.append(ids[at[r] : at[r + 1]])
                else:
                    a, b = s.off[r], s.off[r + 1]
                    got.append(self.whole(raw[a:b].tobytes().decode()) if b > a else ids[:0])
                    count[r] = len(got[-1])
            ids = np.concatenate(got)
        return ids, np.concatenate([[0], np.cumsum(count)])

    def rows(self, array: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, last row + 1, their ids, offsets of the rows in them) of slices of a string column."""
        data, off = kit.texts(array)
        for i, j in kit.slices(off):
            yield i, j, *self.slice(data, off, i, j)

    def encode(self, text: str) -> np.ndarray:
        return next((ids for *_, ids, _ in self.rows(pa.array([text]))), np.zeros(0, np.uint32))

    def bounds(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(byte positions at which a token ends, tokens up to there) in ascending order, from the tokens' offsets."""
        raw = np.frombuffer(text.encode(), np.uint8)
        s = kit.Spans(raw, np.array([0, len(raw)]), 0, 1)
        if self.spaced and len(raw) and self._plain(s)[1].all():
            at = np.cumsum(self.width[self.encode(text)])  # tokens cover every byte
            return at, np.arange(1, len(at) + 1)
        lead = np.flatnonzero((raw & 0xC0) != 0x80)
        place = np.append(lead, len(raw))  # of characters
        done = self.full.encode(text, add_special_tokens=False)
        end = np.array([b for _, b in done.offsets], np.int64)
        last = np.append(end[1:] != end[:-1], True) if len(end) else np.zeros(0, bool)
        return place[end[last]], np.flatnonzero(last) + 1


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One Encoder for each file and Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
