"""Text operators against brute force, with nulls, empty and repeated rows."""

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyspark.sql.functions
import pytest

from plexframe.llm import candidates, components, counting, jaccard, kit, lines, mixing, packing, pages, quality, search, shards, suffix_tree
from plexframe.llm.encode import Encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PLAIN = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
TEXTS = [None, "", "  \n ", "One", PLAIN, PLAIN, PLAIN + " more", PLAIN.upper(), "x " * 70, "a  b\n\nc's <|endoftext|> d\té 日本 12", "é" * 50_000, "Ünter ß Œuvre ×"]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "en", None if i == 3 else f"s{i % 3}", 0) for i, t in enumerate(TEXTS)] + [(None, PLAIN, "en", "s0", 0), (4, PLAIN, "en", "s1", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def vocabulary(name):
    return pytest.importorskip("public_tokenizers").path(name)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name):
    enc = Encoder(vocabulary(name))
    texts = [t or "" for t in TEXTS] + ["I'LL don't b's", " x", "x ", "a \n b", "a\x1cb \x1d c", "a\xa0b", "“q” — ok…", "İstanbul ΣΑΣ", "a1b22 c33."]
    for i, _, ids, off in enc.rows(pa.array(texts)):
        for r in range(len(off) - 1):
            assert ids[off[r] : off[r + 1]].tolist() == enc.full.encode(texts[i + r], add_special_tokens=False).ids


def test_words_of_a_regular_build_keep_their_own_ids(spark):
    """Thue-Morse words and their complements collide under polynomial hashes modulo 2**64."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word, word.translate(str.maketrans("ab", "ba"))] + [f"{word[:k]} {word[k : 2 * k]}" for k in (32, 64, 128, 512)]
    s = kit.Spans(*kit.texts(pa.array(texts)), 0, len(texts))
    h = s.hashes(*s.words()[:2])
    assert len(set(h.tolist())) == len(h)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        full = Encoder(vocabulary(name)).full
        want = [full.encode(t, add_special_tokens=False).ids for t in texts]
        assert {r.doc_id: r.n_tokens for r in counting.token_counts(df, vocabulary(name)).collect()} == {i: len(w) for i, w in enumerate(want)}
        crc = {i: zlib.crc32(np.array([*w, 1], "<u4").tobytes()) for i, w in enumerate(want)}
        assert {r.doc_id: r.ids_crc32 for r in packing.pieces(df, vocabulary(name)).collect()} == crc
        assert {r.key: r.ids_crc32 for r in shards.read_ids(shards.write_ids(df, vocabulary(name), end=1, shards=2)).collect()} == crc


def test_spliced_counts_equal_whole():
    enc = Encoder(vocabulary("byte_bpe_50k.json"))
    rng = np.random.default_rng(1)
    for text in (" ".join(rng.choice(PLAIN.split(), 3000)), "é" * 3000, "ab" * 2000 + " c " * 900, "日本 語 " * 800):
        got, chunks = counting.spliced(enc, text, 700, 16)
        assert chunks > 1 and got == len(enc.full.encode(text, add_special_tokens=False).ids)


def test_quality_base(spark, docs):
    for r in quality.verdicts(docs).collect():
        if r.doc_id is None:
            continue
        text = TEXTS[r.doc_id] or ""
        w = WORD.findall(text)
        win = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {j for i in range(len(w) - 2) if win[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(hit))
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w)) and not (r.kept and r.base_failed)


def test_jaccard_groups(spark, docs):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs).collect()}
    assert {(4, 16, 4), (5, 16, 4), (6, 17, 4), (7, 16, 4), (None, 16, 4), (0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 1, 3)} <= got


def test_jaccard_keys_meet():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(2, 120))
        a = np.unique(rng.integers(1, 1 << 40, n).astype(np.uint64))
        b = np.unique(np.concatenate([rng.permutation(a)[: int(len(a) * 0.92)], rng.integers(1, 1 << 40, max(0, n // 20)).astype(np.uint64)]))
        if not len(b) or 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
            continue
        common = np.sort(rng.permutation(np.union1d(a, b))[: int(rng.integers(0, len(a) + 1))])
        if len(a) > 1:
            assert len(np.intersect1d(jaccard.keys(a, common), jaccard.keys(b, common)))


def test_suffix_tree_base(spark, docs):
    rows = [r for r in suffix_tree.score(docs).collect() if r.doc_id is not None]
    all_docs = [(i, TEXTS[i]) for i in range(len(TEXTS))] + [(None, PLAIN), (4, PLAIN)]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter()
    for i, t in all_docs:
        if not held(i):
            c.update([*WORD.findall((t or "").translate(LOW)), None])
    n, v = sum(c.values()), len(c)
    for r in rows:
        w = [*WORD.findall((TEXTS[r.doc_id] or "").translate(LOW)), None]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum(c[x] > 0 for x in w), n, held(r.doc_id))
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))


def test_suffix_tree_score(spark):
    """The definition in plain Python, over a corpus in which counts of two and more are listed."""
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(25)]
    texts = [" ".join(rnd.choice(vocab[: rnd.choice((3, 8, 25))]) for _ in range(rnd.randint(0, 60))) + (f" only{i}" if i % 5 == 0 else "") for i in range(80)]
    toks = [[*t.split(), None] for t in texts]
    train = [t for i, t in enumerate(toks) if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    root = lambda w: (c[w] + 1) / (n + v + 1)
    one = Counter(x for t in train for x in zip(t, t[1:]) if min(c[x[0]], c[x[1]]) > 1)
    one = {x: k for x, k in one.items() if k > 1}
    two = Counter(x for t in train for x in zip(t, t[1:], t[2:]) if x[:2] in one and x[1:] in one)
    two = {x: k for x, k in two.items() if k > 1}

    def states(entries, times, lower):
        by, out = {}, {}
        for x, k in entries.items():
            by.setdefault(x[:-1], {})[x[-1]] = k
        for context, after in by.items():
            all_ = times(context)
            p = {w: (k - 0.6) / all_ for w, k in after.items()}
            low = {w: lower(context, w) for w in after}
            rest, below, gone = (max(1 - sum(z), 1e-9) for z in (p.values(), low.values(), [k / all_ for k in after.values()]))
            if sum(k / all_ * math.log2(k / all_ / low[w]) for w, k in after.items()) + gone * math.log2(gone / below) >= 0.02:
                out[context] = p, rest / below
        return out

    first = states(one, lambda x: c[x[0]], lambda _, w: root(w))

    def short(word, w):
        p, rest = first.get((word,), ({}, 1.0))
        return p[w] if w in p else rest * root(w)

    second = states(two, lambda x: one[x], lambda x, w: short(x[1], w))

    def chance(t, i):
        p = short(t[i - 1], t[i]) if i else root(t[i])
        found, rest = second.get(tuple(t[i - 2 : i]) if i > 1 else (), ({}, 1.0))
        return found[t[i]] if t[i] in found else rest * p

    assert first and second
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in suffix_tree.score(df).collect():
        t = toks[r.doc_id]
        assert r.score == pytest.approx(sum(math.log10(chance(t, i)) for i in range(len(t))))


def test_words_and_pairs_are_gone_when_triples_are_looked_up(spark, docs, monkeypatch):
    paths, there, grow, gather = [], [], suffix_tree.grow, suffix_tree.gather

    def grown(*given):
        out = grow(*given)
        paths.extend(out[-1])
        return out

    def gathered(*given):
        there.append([os.path.exists(kit.share(p)) for p in paths])
        return gather(*given)

    monkeypatch.setattr(suffix_tree, "grow", grown)
    monkeypatch.setattr(suffix_tree, "gather", gathered)
    assert suffix_tree.score(docs).count() == docs.count()
    assert there == [[True, True, True], [False, False, True]]


def test_suffix_tree_lists_all_that_training_has_twice(spark):
    """What is frequent enough to be broadcast changes no score."""
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choice(vocab[: rnd.choice((3, 10, 60))]) for _ in range(rnd.randint(0, 50))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = {r.doc_id: r for r in suffix_tree.score(df).collect()}
    for r in suffix_tree.score(df, least=0.05).collect():
        assert r.score == pytest.approx(want[r.doc_id].score) and r.base_score == pytest.approx(want[r.doc_id].base_score) and r.n_known == want[r.doc_id].n_known


@pytest.mark.parametrize(("tile", "links"), [(1024, True), (7, True), (7, False)])
def test_many_items_under_a_key(spark, monkeypatch, tile, links):
    """Items that the first one isn't linked to meet in tiles."""
    monkeypatch.setattr(candidates, "TILE", tile)
    item = np.arange(1, 41, dtype=np.uint64)
    blocks = candidates.entries(np.full(40, 5 << 40 | 5, np.uint64), item, np.full(40, 10), 1)
    found = candidates.pair_up(pa.Table.from_batches([blocks]), 85)
    rows = spark.createDataFrame([tuple(r.values()) for r in found.to_pylist()], candidates.PAIRED)
    verify = lambda p: p.where("a % 4 = b % 4").select("a", "b")

    def look(n, root, chunk, bodies):
        at = [(i, j) for i, others in candidates.apart(n, root, chunk, 85) for j in others.tolist() if not links or int(bodies[i]) % 4 == int(bodies[j]) % 4]
        return np.array([i for i, _ in at], np.int64), np.array([j for _, j in at], np.int64)

    bodies = lambda ids: ids.distinct().select("id", pyspark.sql.functions.col("id").cast("string").alias("body"))
    plain = lambda batches: (b.select(["a", "b"]) for b in batches)
    got = {r.id: r.root for r in candidates.groups(rows, verify, bodies, [(look, plain if links else None)]).collect()}
    assert len(got) == 40 and {frozenset(i for i in got if got[i] == r) for r in got.values()} == {frozenset(range(k, 41, 4)) for k in range(1, 5)}


def test_jaccard_groups_with_a_hot_group_equal_brute_force(spark):
    """60 near copies of one text at changing distances, others of all sizes, and passages that many share."""
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(4000)]
    base, passage = [rnd.choice(vocab) for _ in range(150)], [rnd.choice(vocab) for _ in range(60)]
    texts = []
    for k in range(60):
        w = list(base)
        for i in rnd.sample(range(150), k // 10):
            w[i] = rnd.choice(vocab)
        texts.append(" ".join(w))
    for k in range(60):
        own = [rnd.choice(vocab) for _ in range(rnd.randint(1, 40))]
        texts += [" ".join(passage + own), " ".join(own), " ".join(own[: len(own) * 9 // 10])]
    tokens = []
    for t in texts:
        w = t.split()
        tokens.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)} - {()})
    root = list(range(len(texts)))
    for i, x in enumerate(tokens):
        for j in range(i):
            if x and tokens[j] and 100 * len(x & tokens[j]) >= 80 * len(x | tokens[j]):
                root = [root[j] if r == root[i] else r for r in root]
    want = {i: min(j for j, q in enumerate(root) if q == r) for i, r in enumerate(root)}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in jaccard.similar_groups(df).collect()} == want


def test_pairs_that_are_no_links_are_not_written_by_the_square(spark, monkeypatch):
    """80 texts with one passage, each pair just below the limit: nearly all pass the sketches, none is a link; 30 more are linked in a row."""
    rnd = random.Random(9)
    words = lambda n: [f"x{rnd.random()}" for _ in range(n)]
    passage, rows, meet = words(100), [], candidates._meet
    texts = [passage + words(13) for _ in range(80)]
    for _ in range(30):
        texts.append(texts[-1][:-1] + words(1))

    def counted(*given):
        out = meet(*given)
        rows.append(out.count())
        return out

    monkeypatch.setattr(candidates, "_meet", counted)
    monkeypatch.setattr(candidates, "FAMILY_TILE", 16)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard.similar_groups(df).collect()}
    assert got == {i: min(i, 79) for i in range(110)}
    assert max(rows) <= 4 * len(texts)


def test_a_component_meets_others_under_one_key_first(spark, monkeypatch):
    """40 items under 24 keys that lack an item each: a round doesn't write their pairs once for each key, the last look leaves no key out."""
    met = []

    def meet(still, *_):
        met.append({r.key for r in still.select("key").distinct().collect()})
        return spark.createDataFrame([], "a long, b long")

    monkeypatch.setattr(candidates, "_meet", meet)
    found = spark.createDataFrame([(1, key, i, 10) for key in range(24) for i in range(40) if i != key], candidates.PAIRED)
    bodies = lambda _: spark.createDataFrame([], "id long, body string")
    candidates.groups(found, lambda p: p.select("a", "b"), bodies, [(None, None)], (None, None, None))
    assert met == [{22, 23}, set(range(24))]


@pytest.mark.parametrize("small", [0, 7, 1 << 16])
def test_components_are_the_same_wherever_they_are_joined(spark, monkeypatch, small):
    monkeypatch.setattr(components, "SMALL", small)
    rnd = random.Random(3)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(130)]
    root = {x: x for pair in links for x in pair if pair[0] != pair[1]}
    for a, b in links:
        if a != b:
            root = {x: root[b] if r == root[a] else r for x, r in root.items()}
    got = {r.id: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    sets = lambda of: {frozenset(x for x in of if of[x] == r) for r in of.values()}
    assert got.keys() == root.keys() and sets(got) == sets(root) and all(r in got for r in got.values())


def test_sketches_never_lose_a_similar_pair():
    rng = np.random.default_rng(6)
    for _ in range(400):
        a = np.unique(rng.integers(1, 1 << 62, int(rng.integers(1, 300))).astype(np.uint64))
        b = np.unique(np.concatenate([rng.permutation(a)[: max(1, int(len(a) * rng.uniform(0.7, 1)))], rng.integers(1, 1 << 62, int(len(a) * rng.uniform(0, 0.2))).astype(np.uint64)]))
        if jaccard.similar(a, b, 80):
            x, y = (jaccard.sketches(t, np.array([0, len(t)]), [0])[0] for t in (a, b))
            assert jaccard.close(len(a), x, len(b), y, 80)
            n = np.array([len(a), len(b)])
            found = jaccard.look(80, None)(n, np.array([1, 2]), np.zeros(2, np.int64), [x, y])
            assert {int(found[0][0]), int(found[1][0])} == {0, 1}


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "c": 0, "d": 500, None: 5}
    df = spark.createDataFrame([(k, 1, v) for k, v in sizes.items()], "source string, rows long, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [1, 2, 3, 1, 2], strict=True))
    total, want, open_ = sum(sizes.values()), {}, set(sizes)
    while open_:
        level = (total - sum(want.values())) / sum(weight[k] for k in open_)
        over = {k for k in open_ if weight[k] * level > 3 * sizes[k]}
        want |= {k: 3.0 * sizes[k] for k in over} if over else {k: weight[k] * level for k in open_}
        open_ = open_ - over if over else set()
    assert got == pytest.approx(want)


def test_mix_meets_targets(spark, docs):
    x = mixing.mix(docs.select("doc_id", "source", mixing.sized().alias("size")), "doc_id", "source", "size", bucket_rows=2)
    by = {}
    for r in x.collect():
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault(r.source, [r.target, 0])[1] += r.taken
    for target, taken in by.values():
        assert abs(target - taken) <= 0.5


@pytest.mark.parametrize("bucket_rows", [2, 512])
def test_mixed_documents_meet_targets(spark, bucket_rows):
    rnd = random.Random(3)
    rows = [(i if i % 9 else None, " ".join(f"w{i}x{k}" for k in range(rnd.randint(0, 30))), rnd.choice(("a", "a", "a", "b", "c", None)), 0, "kept") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, rows long, `a.b` string").repartition(3)
    goal = {r.source: r.target for r in mixing.targets(df.groupBy("source").agg(pyspark.sql.functions.count("*").alias("rows"), pyspark.sql.functions.sum(mixing.sized()).alias("source_size"))).collect()}
    out = mixing.mix_documents(df, bucket_rows=bucket_rows).collect()
    text = {(r[0], r[1], r[2]) for r in rows}
    partial, words = Counter(), Counter()
    for r in out:
        words[r.source] += len(r.text.split())
        partial[r.source] += (r.doc_id, r.text, r.source) not in text
    assert {k: words[k] for k in goal} == {k: round(v) for k, v in goal.items()} and max(partial.values()) <= 1
    assert {r["a.b"] for r in out} == {"kept"}


def test_pipeline_stages(spark, tmp_path):
    """Each stage on its own input: what is planted goes, clean documents stay, later stages get what earlier ones kept."""
    import corpus_pipeline

    rnd = random.Random(12)
    vocab = [f"{a}{b}" for a in ("mar", "ten", "sol", "rik", "dun", "pel", "vos", "har") for b in ("ia", "or", "us", "eta", "ino", "al", "ek", "um")]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    clean = [f"{text(40)}\n{text(40)}\n{text(40)}" for _ in range(30)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(clean)]
    rows += [(100, clean[0], "en", "s0", 0), (101, clean[1] + " more", "en", "s1", 0), (102, "too short", "en", "s2", 0), (103, None, "en", None, 0), (104, "$$ ## " * 60, "en", "s0", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = kit.documents(spark, str(tmp_path))
    ids = lambda df: {r.doc_id for r in df.collect()}
    stages = dict(corpus_pipeline.STAGES)
    one = stages["quality_rules"](spark, docs, str(tmp_path))
    assert ids(one) == {*range(30), 100, 101} and one.columns == docs.columns
    two = stages["line_dedup"](spark, one, str(tmp_path))
    assert ids(two) == set(range(30))
    near = spark.createDataFrame([(500, clean[2] + " more", "en", "s0", 0), (2, clean[2], "en", "s0", 0), (3, clean[3], "en", "s1", 0)], docs.schema)
    assert ids(stages["ngram_jaccard_join"](spark, near, str(tmp_path))) == {2, 3}
    mixed = stages["source_mix"](spark, two, str(tmp_path))
    packed = stages["best_fit_packing"](spark, mixed, str(tmp_path))
    assert mixed.columns == docs.columns and packed.count() == mixed.count()
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in final} <= set(range(30)) and len(final) == mixed.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_clashing_and_odd_column_names(spark):
    odd = ["rows", "target", "source_size", "piece", "start", "root", "id", "lines", "a.b", "_row", "_t", "n"]
    df = spark.createDataFrame([(i, f"{PLAIN} number{i}\nline of {i}", "s", *["x"] * len(odd)) for i in range(3)], "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in odd))
    for run in (lines.dedup_rows, jaccard.keep_one, mixing.mix_documents, quality.filter_rows):
        out = run(df)
        assert out.columns == df.columns
        out.collect()
    assert suffix_tree.score(df).count() == 3 and quality.verdicts(df).count() == 3 and jaccard.similar_groups(df).count() == 3
    assert packing.pack_documents(df, vocabulary("word_bpe_49k.json")).count() == 3
    assert counting.token_counts(df, vocabulary("byte_bpe_50k.json")).count() == 3


def test_empty_tables_of_the_other_operators(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert counting.token_counts(docs, vocabulary("byte_bpe_50k.json")).count() == 0
    assert packing.pack_documents(docs, vocabulary("word_bpe_49k.json")).count() == 0
    assert shards.read_ids(shards.write_ids(docs, vocabulary("byte_bpe_50k.json"))).count() == 0
    assert search.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), 5, 50, "vec_id", "embedding").count() == 0
    assert pages.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert mixing.mix(docs.select("doc_id", "source", mixing.sized().alias("size")), "doc_id", "source", "size").count() == 0


def test_shards_round_trip(spark, docs):
    path = vocabulary("byte_bpe_50k.json")
    enc = Encoder(path)
    files = shards.write_ids(docs, path, end=0, shards=3)
    rows = sorted(shards.read_ids(files).collect(), key=lambda r: r.start)
    assert len(rows) == len(TEXTS) + 2 and rows[0].key is None
    start = 0
    for r in rows:
        ids = [*enc.full.encode((PLAIN if r.key is None else TEXTS[r.key]) or "", add_special_tokens=False).ids, 0]
        assert (r.start, r.n_ids, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_perfect_hash():
    h = kit.mix(np.arange(5000, dtype=np.uint64))
    shift, slot = shards.perfect(h)
    assert sorted(slot) == list(range(5000)) and (shards.place(h, shift, 5000) == slot).all()


@pytest.mark.parametrize("limits", [{}, {"documents": 3}, {"attention": 2000.0}])
def test_packing_limits(limits):
    rng = np.random.default_rng(3)
    length = rng.integers(1, 101, 500)
    where, offset = packing.best_fit(length, 100, **limits)
    for s in np.unique(where):
        own = np.flatnonzero(where == s)
        own = own[np.argsort(offset[own])]
        assert (offset[own] == np.concatenate([[0], np.cumsum(length[own])[:-1]])).all() and length[own].sum() <= 100
        assert len(own) <= limits.get("documents", 100) and (len(own) == 1 or (length[own] ** 2).sum() <= limits.get("attention", 1e4))
    if not limits:
        assert where.max() + 1 <= math.ceil(length.sum() / 100) * 1.1


def test_search_is_exact():
    rng = np.random.default_rng(4)
    x, ids = rng.integers(-130, 130, (700, 16)), rng.permutation(700)
    x[:40] = x[0]
    own = np.arange(0, 700, 7)
    q, row, score, _ = search.search(search.Index(x), ids, own, x[own], 5)
    for i, me in enumerate(own):
        s = x @ x[me]
        best = [r for r in np.lexsort((ids, -s)) if r != me][:5]
        assert row[q == i].tolist() == best and score[q == i].tolist() == s[best].tolist()


def test_search_stops_before_a_dense_product():
    x = np.floor(256 * np.random.default_rng(8).normal(0, 0.125, (6000, 64))).astype(np.int64)
    own = np.arange(0, 6000, 50)
    *_, done = search.search(search.Index(x), np.arange(6000), own, x[own], 5)
    assert done < 0.97 * x.size


def test_search_over_tables_equals_brute_force(spark, monkeypatch):
    """Nulls, non-finite components, short vectors, ties, repeated ids, large values and several blocks."""
    monkeypatch.setattr(search, "BLOCK_ROWS", 32)
    rnd = random.Random(9)
    rows = [(i, [rnd.choice((0.0, 0.5, -0.25, rnd.uniform(-1, 1))) for _ in range(6)]) for i in range(150)]
    rows += [(200, [1e8, 0.0, 1.0]), (201, [-1e8]), (202, None), (203, []), (204, [None, 1.0]), (205, [float("nan")]), (206, [float("inf"), 0.0]), (None, [1.0]), (250, [0.5] * 6), (251, [0.5] * 6), (250, [0.5] * 6), (300, [0.0] * 6)]
    df = spark.createDataFrame([(*r, "own") for r in rows], "vec_id long, embedding array<double>, score string").repartition(4)
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for n, (i, v) in enumerate(fine):
        if i % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(v, w)), j) for m, (j, w) in enumerate(fine) if m != n)[:5]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    got = [tuple(r) for r in search.top_k(df, 5, 50, "vec_id", "embedding").collect()]
    assert sorted(got) == sorted(want)
    assert search.top_k(df.where("vec_id = 1"), 5, 50, "vec_id", "embedding").count() == 0
    assert search.top_k(df.where("vec_id = 200"), 5, 50, "vec_id", "embedding").count() == 0


def test_pages():
    page = '<html><head><title>t</title></head><body><nav><a>menu</a></nav><div class="ad">buy</div><article><h1>A &amp; B</h1><p>x\n y<br>z<p>w</article><div id="comments"><p>no</div><footer>f</footer>'
    assert pages.extract(pages.blocks(page), []) == "A & B\nx y z\nw"
    one, two = pages.blocks("<div>site</div><p>alpha text of one page"), pages.blocks("<div>site</div><p>beta text of other page")
    assert pages.extract(one, [two]) == "alpha text of one page"
    assert pages.extract(pages.blocks(""), []) == ""


def test_every_page_meets_its_nearest_neighbours_of_the_host(spark):
    """Pages with a first directory each, against extract() over the sorted host, at several partition counts."""
    html = lambda i: f"<div>site {i // 2}</div><div>site {(i + 1) // 2}</div><p>text that page number {i} alone has</p>"
    rows = [(i, f"http://{host}/title-{i:02d}/", html(i)) for host in ("a.org", "b.org") for i in range(20)]
    rows = [(n, u, t) for n, (_, u, t) in enumerate(rows)] + [(90, None, html(0)), (None, None, html(0)), (3, "http://a.org/title-03/", html(3))]
    order = sorted((r for r in rows if r[1]), key=lambda r: r[1:])
    found = [pages.blocks(t) for *_, t in order]
    host = [u[:12] for _, u, _ in order]
    want = [(k, pages.extract(found[i], [found[j] for j in (i - 1, i + 1) if 0 <= j < len(order) and host[j] == host[i]])) for i, (k, *_) in enumerate(order)]
    want += [(k, pages.extract(pages.blocks(t), [])) for k, u, t in rows if not u]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 4, 13):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            got = [(r.page_id, r.text) for r in pages.extract_pages(df).collect()]
            assert sorted(got, key=repr) == sorted(want, key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_line_dedup(spark):
    a, b = "This is a line that stands in many documents, 1.", "this is a line that stands in many documents 2"
    df = spark.createDataFrame([(2, f"{a}\nown words of two here"), (1, f"short\n{b}"), (3, a), (4, None), (5, "")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.dedup_rows(df).collect()}
    assert got == {1: f"short\n{b}", 2: "own words of two here", 4: None, 5: ""}


def test_repeated_rows_keep_their_lines(spark):
    a, b = "this line stands in a document that is given twice", "another line of the same document given twice"
    df = spark.createDataFrame([(1, f"{a}\n{b}"), (1, f"{a}\n{b}"), (2, f"{b}\nwords that only the second document has"), (None, a), (None, a)], "doc_id long, text string").coalesce(1)
    got = sorted((r.doc_id, r.text) for r in lines.dedup_rows(df).collect())
    assert got == [(1, f"{a}\n{b}"), (1, f"{a}\n{b}"), (2, "words that only the second document has")]


def test_keys_in_two_waves_take_half_the_disk_and_find_the_same(spark):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(500)]
    texts = []
    for i in range(60):
        own = [[rnd.choice(vocab) for _ in range(rnd.randint(3, 40))] for _ in range(3)]
        texts += ["\n".join(map(" ".join, own)), "\n".join(" ".join([*x[:-1], rnd.choice(vocab)]) for x in own)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    one, two = ({r.document: sorted(r.lines) for r in lines.repeats(df, waves=w).collect()} for w in (1, 2))
    assert one and one == two
    rows = kit.split_rows(df).selectExpr("doc_id", "doc_id", "text")
    size = lambda *wave: lines.keyed(rows, 4, 1, *wave).selectExpr("sum(length(payload))").first()[0]
    assert size(0, 2) + size(1, 2) == size() and max(size(0, 2), size(1, 2)) < 0.55 * size()


def test_all_pairs_of_a_tile_at_once():
    rng = np.random.default_rng(1)
    for _ in range(100):
        m = int(rng.integers(0, 60))
        n, root, chunk = np.sort(rng.integers(1, 60, m)), rng.integers(0, 5, m), rng.integers(0, 2, m)
        a, b = candidates.near(n, root, chunk, 85)
        assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == [(i, j) for i, others in candidates.apart(n, root, chunk, 85) for j in others.tolist()]


def test_short_lines_and_lines_without_spaces_are_deduplicated(spark):
    long_ = "日本語の文章には空白がないのでこの行は一つの語になる"
    df = spark.createDataFrame([(1, f"All rights reserved.\n{long_}\n\nyes"), (2, f"all rights reserved\n{long_}\n\nown words of two"), (3, "\n---\n"), (4, "\n---\n")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.dedup_rows(df).collect()}
    assert got == {1: f"All rights reserved.\n{long_}\n\nyes", 2: "\nown words of two", 3: "\n---\n", 4: "\n---\n"}


def edited_lines(seed, n):
    """Lines of 6 to 60 words, each with a copy that has one word, a tenth of the words or 5 % of the characters changed."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9)))
    vocab, out = [word() for _ in range(3000)], []
    for k in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(6, 60))]
        v = list(w)
        for i in rnd.sample(range(len(w)), (1, max(1, len(w) // 10), 0)[k % 3]):
            v[i] = rnd.choice(vocab)
        c = list(" ".join(v))
        for i in rnd.sample(range(len(c)), len(c) // 20 if k % 3 == 2 else 0):
            c[i] = rnd.choice("abcdefghijklmnopqrstuvwxyz")
        out.append((" ".join(w), "".join(c)))
    return out


def test_similar_lines_are_found_as_by_brute_force(spark):
    """Groups by all pairs; at most 2 of 100 lines that brute force removes may be missed, and none removed that it keeps."""
    texts = [t for pair in edited_lines(11, 60) for t in pair]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if lines.similar(texts[i], texts[j]):
                root = [root[j] if r == root[i] else r for r in root]
    want = {i for i, r in enumerate(root) if root.index(r) < i}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    gone = set(range(len(texts))) - {r.doc_id for r in lines.dedup_rows(df).collect()}
    assert gone <= want and len(want - gone) <= 0.02 * len(want) and len(want) > 40


@pytest.mark.parametrize("run", [lambda d: jaccard.similar_groups(d), lambda d: suffix_tree.score(d), lambda d: quality.verdicts(d), lambda d: lines.dedup_rows(d), lambda d: mixing.mix_documents(d)])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_distances_that_advance_together_agree_with_the_plain_recurrence(monkeypatch):
    rnd = random.Random(3)

    def plain(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            last, row = row, [i]
            for j, d in enumerate(y, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
        return row[-1]

    a, b = [], []
    for n in [0, 1, 5, 63, 64, 65, 127, 128, 129, 200, 511, 513, 600] * 6:
        x = [rnd.choice("abcdé 漢") for _ in range(n)]
        y = list(x)
        for _ in range(int(n * rnd.uniform(0, 0.3))):
            i = rnd.randrange(len(y))
            y[i : i + rnd.randrange(2)] = rnd.choice(["", "x", "yz"])
        a.append("".join(x)), b.append("".join(y))
    far = [plain(x, y) for x, y in zip(a, b, strict=True)]
    want = [d <= max(len(x), len(y)) * 15 // 100 for d, x, y in zip(far, a, b, strict=True)]
    assert lines.all_similar(a, b).tolist() == want
    assert [lines.similar(x, y) for x, y in zip(a, b, strict=True)] == want
    assert lines.all_similar([], []).tolist() == []
    short, long_ = zip(*(sorted(x, key=len) for x in zip(a, b, strict=True) if all(x)), strict=True)
    assert lines.distances(list(short), list(long_)).tolist() == [d for d, x, y in zip(far, a, b, strict=True) if x and y]
    monkeypatch.setattr(lines, "_MANY", 1)
    assert lines.all_similar(a, b).tolist() == want
