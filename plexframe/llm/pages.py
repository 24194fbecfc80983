"""Main text of web pages, by differencing pages of nearest URL.

Each page is cut into blocks of text. Pages of a host are sorted by the path of their URLs; a page is
paired with its nearest neighbours, the blocks of both are aligned by longest common subsequence, and
blocks that the two share in order are deleted as what the site puts on every page. What differencing
can't show, as adverts that differ from page to page and pages without neighbours, goes by its place:
blocks in menus, headers, footers, sidebars, notices, adverts, forms and reader comments, by element
name, role, class or id. If a page marks an article or a main part, only that is kept.

A neighbour that shares more than `COPY_PERCENT` of the characters of the smaller page's marked part is
a copy of the page or of its article, not a sibling; then nothing is deleted on its word. Blocks of a
marked part outside of such places stay even if a sibling has them: the site itself calls them the
article, and articles quote the same passages.

Pages of one host may be a third of all: all pages are dealt by ranges of host and path, whose first and
last pages also go to the range before and after as neighbours only. Neighbours are read in one pass over
sorted rows, three at a time, so what they are doesn't depend on the number of ranges.

Defined results: null or empty html, or html without text, gives an empty text; a null url is a page
without neighbours; equal URLs are ordered by id; repeated rows are extracted alike, as they are copies;
other columns are not looked at; an empty table gives an empty table. An element left open is open to
the page's end.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexframe.llm import kit

COPY_PERCENT = 50

#: Names of elements whose text is never part of an article, and those that have no end tag.
_DROPPED = frozenset("script style head title nav header footer aside form noscript template svg math iframe object canvas audio video button select option textarea menu dialog".split())
_RAW = frozenset("script style textarea title noscript template svg iframe".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img br input".split())
_MARKED = frozenset(("article", "main"))
#: Words of classes, ids and roles that name what is not an article.
_PLACES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar sidebars aside widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer foot "
    "cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments commentlist respond disqus replies discussion "
    "pagination pager toolbar topbar copyright search searchform skip complementary contentinfo alert".split()
)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"""\bhidden(?=[\s=]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none""", re.I)


def _misplaced(attributes: str) -> bool:
    if not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    for m in _NAMED.finditer(attributes):
        names = re.sub(r"([a-z])([A-Z])", r"\1 \2", m[1] or m[2] or m[3] or "").lower()
        if not _PLACES.isdisjoint(_WORDS.findall(names)):
            return True
    return False


def blocks(page: str) -> list[tuple[str, int, bool]]:
    """(text, place, in a marked part) of each block; place: 0 where an article may stand, else 1."""
    out: list[tuple[str, int, bool]] = []
    text: list[str] = []
    dropped, open_names, marked, at = "", 0, 0, 0

    def close() -> None:
        whole = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if whole:
            out.append((whole, int(bool(dropped)), marked > 0))

    n = len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        end, attributes = m[1] == "/", m[3] or ""
        if name in _RAW and not end:
            stop = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else n
            continue
        if name == "br":
            text.append(" ")
            continue
        inline = name in _INLINE
        if not inline:
            close()
        if dropped:
            if name == dropped and name not in _VOID:
                open_names += -1 if end else 0 if attributes.rstrip().endswith("/") else 1
                if open_names <= 0:
                    if inline:
                        close()
                    dropped = ""
        elif not end and name not in _VOID and not attributes.rstrip().endswith("/") and (name in _DROPPED or (name not in ("html", "body", "article", "main") and _misplaced(attributes))):
            if inline:
                close()
            dropped, open_names = name, 1
        if name in _MARKED and not (dropped and dropped != name):
            marked = max(0, marked + (-1 if end else 1))
    close()
    return out


def common(a: list[str], b: list[str]) -> set[int]:
    """Places in a of a longest common subsequence of a and b."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    found = {*range(lo), *range(len(a) - hi, len(a))}
    x, y = [(i, t) for i, t in enumerate(a[lo : len(a) - hi], lo)], b[lo : len(b) - hi]
    known, kinds = set(y), {t for _, t in x}
    x, y = [(i, t) for i, t in x if t in known], [t for t in y if t in kinds]  # others are in no common subsequence
    if not x or not y:
        return found
    masks: dict[str, int] = {}
    for j, t in enumerate(y):
        masks[t] = masks.get(t, 0) | 1 << j
    full = (1 << len(y)) - 1

    def step(v: int, t: str) -> int:
        """The next row of the table as bits: 0 where the longest common subsequence grows."""
        u = v & masks[t]
        return (v + u | v - u) & full

    # every k-th row is kept and the rows between are worked out again, so memory grows with len(y) * sqrt(len(x)) bits
    k = int(len(x) ** 0.5) + 1
    kept, v = [full], full
    for i, (_, t) in enumerate(x):
        v = step(v, t)
        if (i + 1) % k == 0:
            kept.append(v)
    near: list[int] = []
    base, i, j = len(x) + 1, len(x), len(y)

    def row(i: int) -> int:
        nonlocal near, base
        if not base <= i < base + len(near):
            base = (i // k) * k
            near = [kept[i // k]]
            for _, t in x[base : base + k - 1]:
                near.append(step(near[-1], t))
        return near[i - base]

    while i and j:
        if row(i) >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not (i and not row(i) >> (j - 1) & 1):
                found.add(x[i][0])
                j -= 1
    return found


def _main(found: list[tuple[str, int, bool]]) -> list[int]:
    """Blocks that may be the article: those of a marked part, if there is one, outside of dropped places."""
    inside = [i for i, (_, place, mark) in enumerate(found) if mark and not place]
    return inside or [i for i, (_, place, _) in enumerate(found) if not place]


def extract(found: list[tuple[str, int, bool]], neighbours: list[list[tuple[str, int, bool]]]) -> str:
    """The main text of a page, given as blocks, with its neighbours."""
    main = _main(found)
    own = [t for t, *_ in found]
    gone: set[int] = set()
    for other in neighbours:
        shared = common(own, [t for t, *_ in other])
        mine = sum(len(own[i]) for i in main)
        theirs = sum(len(other[i][0]) for i in _main(other))
        if 100 * sum(len(own[i]) for i in main if i in shared) > COPY_PERCENT * min(mine, theirs):
            continue
        gone |= {i for i in shared if not found[i][2]}
    return "\n".join(own[i] for i in main if i not in gone)


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """key, url, text, n_chars of every row."""
    address = F.regexp_replace(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_extract(address, r"^([^/?#]*)", 1)
    path = F.regexp_extract(address, r"^[^/?#]*([^?#]*)", 1)
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.col(source).cast("string").alias("t"), host.alias("h"), path.alias("p"))
    kind, url_kind = (pages.schema[c].dataType.simpleString() for c in (key, url))

    parts = kit.partitions(pages)
    place = F.struct("h", "p", "u", "k")
    ranged = rows.select("h", "p", "u", "k").repartitionByRange(parts, "h", "p", "u", "k")
    ends = ranged.groupBy(F.spark_partition_id().alias("d")).agg(F.min(place).alias("first"), F.max(place).alias("last")).collect()
    firsts, lasts = (sorted(_place(*e[side]) for e in ends) for side in ("first", "last"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(t) if t else [] for t in batch.column(2).to_pylist()]
            texts = pa.array([[t for t, *_ in x] for x in found], pa.list_(pa.string()))
            places = pa.array([bytes(p + 2 * m for _, p, m in x) for x in found], pa.binary())
            h, p, u, k = (batch.column(i).to_pylist() for i in (3, 4, 1, 0))
            row, part, only = [], [], []
            for i, at in enumerate(map(_place, h, p, u, k)):
                d = bisect_right(firsts, at) - 1
                near = [d - 1] * (at == firsts[d] and d > 0) + [d + 1] * (at == lasts[d] and d + 1 < len(firsts))
                for other in (d, *near):
                    row.append(i), part.append(other), only.append(other != d)
            cols = [c.take(pa.array(row, pa.int64())) for c in (batch.column(0), batch.column(1), batch.column(3), batch.column(4), texts, places)]
            yield pa.record_batch([*cols[:4], pa.array(part, pa.int32()), pa.array(only, pa.bool_()), *cols[4:]], ["k", "u", "h", "p", "d", "o", "x", "y"])

    kit.split_rows(pages, 512)
    found = rows.mapInArrow(cut, f"k {kind}, u {url_kind}, h string, p string, d int, o boolean, x array<string>, y binary")
    found = found.repartition(parts, "d").sortWithinPartitions("d", "h", "p", "u", "k")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of() -> Iterator[tuple]:
            for batch in batches:
                k, u, h = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
                d, only = batch.column(4).to_pylist(), batch.column(5).to_pylist()
                x, y = batch.column(6).to_pylist(), batch.column(7).to_pylist()
                for i in range(batch.num_rows):
                    yield k[i], u[i], h[i], [(t, b & 1, b > 1) for t, b in zip(x[i], y[i], strict=True)], d[i], only[i]

        def results() -> Iterator[tuple]:
            before, now = None, None
            for after in _with_end(rows_of()):
                if now is not None and not now[5]:
                    near = [o[3] for o in (before, after) if o is not None and now[2] and o[2] == now[2] and o[4] == now[4]]
                    yield now[0], now[1], extract(now[3], near)
                before, now = now, after

        size, out = 512, []
        for r in results():
            out.append(r)
            if len(out) == size:
                yield _batch(out, kind, url_kind)
                out = []
        yield _batch(out, kind, url_kind)

    result = found.mapInArrow(pair, f"k {kind}, u {url_kind}, text string, n_chars long")
    return result.withColumnsRenamed({"k": key, "u": url})


def _place(h: str, p: str, u: str | None, k) -> tuple:
    """A page's place in the order of all pages, as Spark sorts: nulls first."""
    return h, p, u is not None, u or "", k is not None, k if k is not None else 0


def _with_end(rows: Iterator[tuple]) -> Iterator[tuple | None]:
    yield from rows
    yield None


def _batch(rows: list[tuple], kind: str, url_kind: str) -> pa.RecordBatch:
    names = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    k = pa.array([r[0].as_py() for r in rows], names.get(kind, pa.int64()))
    text = [r[2] for r in rows]
    return pa.record_batch([k, pa.array([r[1] for r in rows], names.get(url_kind, pa.string())), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["k", "u", "text", "n_chars"])
