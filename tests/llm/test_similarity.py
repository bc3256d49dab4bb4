"""SimHash, line dedup and language ID against brute force."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from confluo.llm import langid, linededup, minhash, simhash
from tests.llm.test_rules import DOCS, TEXTS, docs

# --- SimHash


def mark_of(t):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(marks, threshold=2):
    up = list(range(len(marks)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(range(len(marks)), 2):
        if (marks[a] ^ marks[b]).bit_count() <= threshold:
            up[root(a)] = root(b)
    return [root(k) for k in range(len(marks))]


def test_components_of_texts(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghij") * 3 for _ in range(400)) for _ in range(12)]
    near = [(100 + k, " ".join(x if rng.random() > 0.004 else "zz" for x in base[k % 12].split())) for k in range(90)]
    texts = TEXTS + near + near[:4]
    got = simhash.near_duplicates(docs(spark, texts).withColumn("mark", F.lit(0)).withColumn("key", F.lit(0))).collect()
    marks = [mark_of(t) for _, t in texts]
    least = {}
    comp = components(marks)
    for c, (i, _) in zip(comp, texts, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = collections.Counter((i, f"{m:016x}", least.get(c)) for (i, _), m, c in zip(texts, marks, comp, strict=True))
    assert collections.Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    assert len(set(comp)) < len(set(marks))  # some links are between different fingerprints
    kept = simhash.drop_near_duplicates(docs(spark, texts).withColumn("_c", F.lit(0)))
    assert kept.columns == ["doc_id", "text", "lang", "_c"]
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(least.values())  # one for each component


def test_no_documents(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0 and simhash.drop_near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("parts", [1, 2, 3, 7])
def test_repeated_ids_are_told_apart(spark, parts):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(900)]
    a, b, c = (" ".join(words[300 * k : 300 * k + 300]) for k in range(3))
    rows = [(3, a, "x"), (5, a, "x"), (5, b, "x"), (5, b, "x"), (5, b, "y"), (7, b, "z"), (None, c, "x"), (None, c, "x"), (None, a, "x"), (9, None, "x"), (10, "", "x"), (10, " ", "x")]
    own = spark.createDataFrame(rows, DOCS).withColumn("h", F.create_map(F.lit("k"), F.col("lang"))).withColumn("least", F.lit(1)).withColumn("n", F.lit(2)).repartition(parts)
    kept = simhash.drop_near_duplicates(own)
    assert kept.columns == own.columns
    got = sorted(((r["doc_id"], r["text"], r["lang"]) for r in kept.collect()), key=str)
    fives = [r for r in got if r[0] == 5]
    assert [r[:2] for r in got if r[0] != 5] == [(3, a), (9, None), (None, c)] and len(fives) == 1 and fives[0][1] == b
    assert got == sorted(((r["doc_id"], r["text"], r["lang"]) for r in simhash.drop_near_duplicates(own.repartition(5)).collect()), key=str)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_anchors_are_all_code_words_near(radius):
    marks = np.random.default_rng(2).integers(0, 1 << 63, 3, np.uint64) * np.uint64(2) + np.uint64(1)
    anchor, which = simhash.anchors(marks, radius)
    assert (simhash.syndromes(anchor) == 0).all()
    assert (np.bitwise_count(anchor ^ marks[which]) <= radius).all()
    for k, m in enumerate(marks):
        around = [m ^ np.uint64(sum(1 << b for b in bits)) for r in range(radius + 1) for bits in itertools.combinations(range(64), r)]
        near = np.array(around, np.uint64)
        assert set(near[simhash.syndromes(near) == 0].tolist()) == set(anchor[which == k].tolist())


@pytest.mark.parametrize("threshold, radius", [(1, None), (2, None), (2, 3), (3, None)])
def test_links_lose_no_pair(spark, threshold, radius):
    rng = random.Random(9)
    centre = [rng.getrandbits(64) for _ in range(15)]
    marks = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for c in centre for _ in range(25)} | {0, (1 << 64) - 1, 1 << 63}
    marks = sorted(marks)
    rows = spark.createDataFrame([(m - (1 << 64) if m >> 63 else m,) for m in marks], "mark long").repartition(3)
    links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.link_fingerprints(rows, threshold, radius).collect()]
    assert all(0 < (a ^ b).bit_count() <= threshold for a, b in links)
    at = {m: k for k, m in enumerate(marks)}
    up = list(range(len(marks)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[root(at[a])] = root(at[b])
    mine, true = [root(k) for k in range(len(marks))], components(marks, threshold)
    pairs = lambda c: {(a, b) for a, b in itertools.combinations(range(len(c)), 2) if c[a] == c[b]}
    assert pairs(mine) == pairs(true)


def test_a_full_anchor_gives_few_links():
    one = np.uint64(1)
    marks = np.array([0] + [1 << b for b in range(64)] + [1 << a | 1 << b for a, b in itertools.combinations(range(64), 2)], np.uint64) ^ one
    assert len(simhash.links_within(marks, 2)) == len(marks) - 1


def test_the_stage_finds_pairs_of_jaccard_08(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [[word() for _ in range(250)] for _ in range(20)]
    texts = [(k, " ".join(w)) for k, w in enumerate(base)]
    texts += [(100 + k, " ".join(["new"] * (k % 2 == 0) + [word() if j in (40, 140, 200) else x for j, x in enumerate(w)])) for k, w in enumerate(base)]
    texts += [(200 + k, " ".join(w[:125] + [word() for _ in range(125)])) for k, w in enumerate(base)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in texts)]
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert all(alike(k, 20 + k) >= 0.8 > alike(k, 40 + k) for k in range(20))
    own = docs(spark, texts)
    assert simhash.drop_near_duplicates(own).count() > 45
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, own, "").collect()}
    assert kept == {*range(20), *range(200, 220)}
    assert corpus_pipeline.near_duplicates(spark, docs(spark, [(1, None), (2, ""), (None, "a b")]), "").count() == 2


def test_similar_in_large_buckets(spark, monkeypatch):
    """Texts alike to each other and to no hub, among hundreds that share a passage; blocks of several sizes; against all pairs."""
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(1 << 40)}"
    shared = [word() for _ in range(64)]
    texts = [" ".join(shared + [word() for _ in range(rnd.randrange(24, 40))]) for _ in range(400)]
    texts += [" ".join(shared + [word() for _ in range(6)]) for _ in range(4)]  # alike by what they all share
    for _ in range(3):
        own = shared + [word() for _ in range(30)]
        texts += [" ".join(own + [word() for _ in range(4)]) for _ in range(40)]  # near copies, many
    rnd.shuffle(texts)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    marks = [int(np.uint64(simhash.fingerprint(simhash.shingle_hashes(t))).view(np.int64)) for t in texts]
    root = [marks.index(m) for m in marks]
    for i, x in enumerate(sets):
        for j in range(i):
            if root[i] != root[j] and (n := len(x & sets[j])) >= 0.8 * (len(x) + len(sets[j]) - n):
                root = [root[j] if r == root[i] else r for r in root]
    assert sorted(n for n in collections.Counter(root).values() if n > 1) == [4, 40, 40, 40]
    frame = docs(spark, list(enumerate(texts))).repartition(3)
    for most, block in ((16, 256), (3, 16)):
        monkeypatch.setattr(minhash, "MOST_PAIRED", most)
        monkeypatch.setattr(minhash, "BLOCK", block)
        got = {m: m for m in marks}
        for r in minhash.similar(frame).collect():
            got = {m: got[r["b"]] if g == got[r["a"]] else g for m, g in got.items()}
        groups = lambda roots: {frozenset(k for k, r in enumerate(roots) if r == own) for own in set(roots)}
        assert groups([got[m] for m in marks]) == groups(root)


# --- line dedup


def brute_dedup(texts, how):
    order = sorted(range(len(texts)), key=lambda k: (texts[k][0] is not None, texts[k][0] or 0, xx(texts[k][1])))
    seen, out = {}, [None] * len(texts)
    for k in order:
        i, t = texts[k]
        spans = []
        for start, end, lines, words in how.chunks(t) if t else ():
            if lines >= 2 and words >= how.least_words:
                place = (i, t, start)
                if seen.setdefault(linededup.content(t[start:end]), place) != place:
                    spans.append((start, end))
        out[k] = linededup.cut_out(t, spans) if t else t
    return out


def xx(t):
    return -1 if t is None else 0


PASSAGE = "\n".join(f"line {k} of a passage that many share, with words {k * 7}" for k in range(12))


def passages():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    line = lambda: " ".join(word() for _ in range(rng.randrange(3, 12))) + "."
    own = lambda n: [line() for _ in range(n)]
    shared = PASSAGE.split("\n")
    texts = [(20 + k, "\n".join(own(rng.randrange(6)) + shared + own(5))) for k in range(40)]
    texts += [(70, "\n".join(own(9))), (71, "  " + " ".join(own(60))), (72, "\n\n".join(shared * 2))]
    return texts


def test_dedup_is_what_brute_force_gives(spark):
    texts = [x for x in TEXTS if x[0] not in (5,)] + passages() + passages()[:2]
    own = docs(spark, texts).withColumn("start", F.lit(1)).withColumn("hash", F.lit(2)).withColumn("_c_chunks", F.lit(3))
    got = linededup.dedup_lines(own.repartition(5))
    assert got.columns == own.columns
    want = brute_dedup(texts, linededup.Chunker())
    assert collections.Counter((r["doc_id"], r["text"]) for r in got.collect()) == collections.Counter(zip([i for i, _ in texts], want, strict=True))
    assert sum(t is not None and len(t) < len(old) for t, (_, old) in zip(want, texts, strict=True) if old) >= 39


def test_chunks_cover_and_resist_shifts():
    how = linededup.Chunker()
    for _, t in [*passages(), *[x for x in TEXTS if x[1]]]:
        assert "".join(t[s:e] for s, e, _, _ in how.chunks(t)) == t
    inside = lambda t: {t[s:e].strip() for s, e, _, _ in how.chunks(t)}
    a, b = "first words here.\n" + PASSAGE + "\nend", "other. start\nmore of it\n" + PASSAGE + "\nelse"
    assert len(inside(a) & inside(b)) >= 2
    single = "A sentence here. " * 30
    assert [x[2] for x in how.chunks("short\n" + single.strip() + "\nshort")][0] == 1


def test_unlike_chunks_of_equal_hash_stay(spark, monkeypatch):
    """With a hash that is always equal, the comparison of contents alone decides."""

    class Same:
        @staticmethod
        def xxh3_128_digest(_):
            return bytes(16)

        xxh3_64_intdigest = staticmethod(xxhash.xxh3_64_intdigest)

    texts = passages()[:6]
    monkeypatch.setattr(linededup, "xxhash", Same)
    import pyspark.cloudpickle as cp

    cp.register_pickle_by_value(linededup)
    try:
        got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs(spark, texts)).collect()}
    finally:
        cp.unregister_pickle_by_value(linededup)
    kept = "\n".join(got.values())
    for i, t in texts:
        for start, end, _, _ in linededup.Chunker().chunks(t):
            assert linededup.content(t[start:end]).split("\n")[0] in kept


def test_spans_and_nothing(spark):
    got = linededup.dedup_lines(docs(spark, passages()), removed="removed").collect()
    old = dict(passages())
    assert all(linededup.cut_out(old[r["doc_id"]], [tuple(s) for s in r["removed"]]) == r["text"] for r in got)
    assert linededup.dedup_lines(docs(spark, [])).count() == 0
    assert linededup.dedup_lines(docs(spark, [(1, None), (2, "")])).count() == 2


def planted(layout, n=30):
    """Texts with one passage of 52 to 90 words in two of them each, and the passages."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    own = lambda k: [" ".join(word() for _ in range(rng.randrange(3, 16))) + "." for _ in range(k)]
    texts, said = [], []
    for k in range(2 * n):
        if k % 2 == 0:
            if layout in ("sentence", "wide"):
                p = [", ".join(word() for _ in range(60))] if layout == "sentence" else ["".join(chr(rng.randrange(0x4E00, 0x9000)) + "，" * (j % 9 == 8) for j in range(130))]
            else:
                p = []
                while sum(len(x.split()) for x in p) < 52:
                    p += own(1)
            said.append(p)
        gap = " " if layout == "paragraph" else "\n"
        texts.append((k, gap.join([*own(5), *said[-1], *own(5)])))
    return texts, said


@pytest.mark.parametrize("layout", ["lines", "paragraph", "sentence", "wide"])
def test_planted_passages_go(spark, layout):
    texts, said = planted(layout)
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs(spark, texts)).collect()}
    assert all(got[i] == t for i, t in texts if i % 2 == 0)
    whole = sum(len("".join(p)) for p in said)
    gone = sum(len(t) - len(got[i]) for i, t in texts if i % 2)
    assert 0.9 * whole <= gone <= 1.1 * whole


def test_a_lone_repeated_line_stays(spark):
    line = "All rights reserved by the owners of this page and of its parts."
    texts = [(k, f"Text number {k} has words of its own.\n{line}\nIts end is its own too, as number {k}.") for k in range(6)]
    assert {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs(spark, texts)).collect()} == dict(texts)


# --- language ID


def spoken(seed=0, n=240):
    rng = random.Random(seed)
    parts = {"aa": ["the", "ing", "tion", "wh", "er"], "bb": ["sch", "ung", "ein", "ü", "keit"], "cc": ["eau", "é", "oi", "ment", "que"]}
    return [(k, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(30)), lang) for k in range(n) for lang in [list(parts)[k % 3]]]


def test_languages(spark):
    rows = spoken()
    own = spark.createDataFrame(rows, DOCS)
    p = langid.Profiles(dim=256).learn(own.where("doc_id % 4 <> 2"))
    assert p.languages == ("aa", "bb", "cc") and np.allclose(np.linalg.norm(p.prototypes, axis=1), 1)
    got = p.predict(own.select("doc_id", "text", F.col("lang").alias("true")), into=("l", "s")).where("doc_id % 4 = 2").collect()
    assert sum(r["l"] == r["true"] for r in got) >= 0.97 * len(got) and all(0 <= r["s"] <= 1 for r in got)
    other = langid.Profiles(dim=256).learn(own.where("doc_id % 4 <> 2").repartition(7))
    assert (p.prototypes == other.prototypes).all()


def test_cosine_is_that_of_bound_and_bundled_vectors():
    p = langid.Profiles(dim=128)
    space = langid.Space(128, p.seed)
    texts = ["Abc, abd!", "ÉÀ  x9y"]

    def bundle(t):
        codes = langid.letters(t).tolist()
        total = np.zeros(128)
        for g in zip(codes, codes[1:], codes[2:], strict=False):
            v = np.ones(128)
            for place, c in enumerate(reversed(g)):
                v = v * np.roll(langid.letter_vector(c, 128, p.seed), place)
            total += v
        return total

    protos = np.stack([bundle("abc abc"), bundle("éà xy")])
    protos /= np.linalg.norm(protos, axis=1, keepdims=True)
    got = langid.Profiles(128, languages=("a", "b"), prototypes=protos.astype(np.float32)).similarities(texts, space)
    want = [[bundle(t) @ q / np.linalg.norm(bundle(t)) for q in protos] for t in texts]
    assert np.allclose(got, want, atol=1e-5)
    assert bytes(langid.letters("ÀB, c1d")[:2].astype(np.uint8)) == b" \xe0"


def test_no_language(spark):
    p = langid.Profiles(dim=64)
    own = docs(spark, [(1, None), (2, ""), (3, "123 !?"), (4, "abc")])
    assert {(r["lang_pred"], r["score"]) for r in p.learn(own.limit(0)).predict(own).collect()} == {("und", 0.0)}
    got = {r["doc_id"]: r["lang_pred"] for r in p.learn(own).predict(own).collect()}
    assert got == {1: "und", 2: "und", 3: "und", 4: "en"}
    assert p.learn(own).predict(own.limit(0)).count() == 0
    assert hashlib.sha256(langid.letter_vector(97, 64, 7).tobytes()).hexdigest() == hashlib.sha256(langid.letter_vector(97, 64, 7).tobytes()).hexdigest()
