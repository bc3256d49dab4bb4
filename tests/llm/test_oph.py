"""Near-duplicates by one-permutation hashing, against all pairs."""

import random

import numpy as np
import pytest

from confluo.llm import oph

SCHEMA = "doc_id long, text string, `we.ird` string, KEY int, n string"


def sets_of(texts, size=4):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({b" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    return out


def brute(docs, size=4, percent=80):
    sets, n = sets_of([t for _, t in docs], size), len(docs)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(n) if find(j) == find(i) and docs[j][0] is not None]
        least = d if not sets[i] else min(ids, default=None)
        out.append((d, len(sets[i]), least, least == d))
    return sorted(out, key=str)


def tables(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    said = lambda n: [rng.choice(words) for _ in range(n)]

    def changed(w, share):
        return [rng.choice(words) if rng.random() < share else x for x in w]

    docs = []
    for n in (4, 5, 6, 9, 14, 40, 120, 400):
        base = said(n)
        docs += [" ".join(changed(base, share)) for share in (0, 0.01, 0.02, 0.03, 0.05, 0.1) for _ in range(3)]
    hub = said(200)  # copies that are alike to the first one alone
    docs += [" ".join(hub)] + [" ".join(changed(hub, 0.022)) for _ in range(60)]
    shell = said(150)  # much in common, not enough
    docs += [" ".join([*shell, *said(rng.randrange(40, 70))]) for _ in range(50)]
    chain = said(100)
    for _ in range(25):  # each alike to the next one alone
        chain = chain[8:] + said(8)
        docs.append(" ".join(chain))
    docs += [" ".join(said(20_000)), None, "", " \n", "one", "one two three", "ONE  two\tthree", "one two three four"]
    ids = list(range(1, len(docs) + 1))
    rng.shuffle(ids)
    given = list(zip(ids, docs, strict=True))
    return given + [(None, docs[3]), (None, "only here"), given[5], (given[5][0], docs[9])]


@pytest.mark.parametrize("most,grams", [(oph.MOST_PAIRED, oph.BLOCK_GRAMS), (2, 3000)])
def test_all_links(spark, monkeypatch, most, grams):
    monkeypatch.setattr(oph, "MOST_PAIRED", most)
    monkeypatch.setattr(oph, "BLOCK_GRAMS", grams)
    docs = tables(most)
    d = spark.createDataFrame([(*x, "x", 1, "y") for x in docs], SCHEMA).repartition(5)
    got = oph.near_duplicates(d).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs)


def test_rest_alone_finds_all(spark):
    """What the rare shingles join doesn't depend on the stars before them."""
    texts = [t for _, t in tables(11) if t and t.split()]
    sets = {oph.xxhash.xxh3_128_digest(x.tobytes()): x for x in (np.unique(oph.shingle_hashes(t, 4)) for t in texts)}
    frame = spark.createDataFrame([(k, x.view(np.int64).tolist(), len(x), k, oph.bitmap(x)) for k, x in sets.items()], "key binary, grams array<long>, n long, part binary, bits binary")
    for most, grams in ((16, 1 << 20), (2, 3000)):
        oph.MOST_PAIRED, oph.BLOCK_GRAMS, kept = most, grams, (oph.MOST_PAIRED, oph.BLOCK_GRAMS)
        try:
            links = oph._rest(frame.select("key", "n", "part"), frame.select("key", "n", "bits", "grams"), 80).collect()
        finally:
            oph.MOST_PAIRED, oph.BLOCK_GRAMS = kept
        assert joined([(bytes(r["pa"]), bytes(r["pb"])) for r in links], sets) == joined(pairs(sets), sets)


def pairs(sets):
    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                yield a, b


def joined(links, nodes):
    root = {k: k for k in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    return {k: find(k) for k in nodes}


def test_signature():
    rng = np.random.default_rng(3)
    drawn = lambda n: rng.integers(0, 2**64 - 1, n, np.uint64)
    for n in (1, 3, 20, 1000):
        agree = []
        for _ in range(300 if n < 1000 else 100):
            x = drawn(n)
            y = np.concatenate([x[: -(-n * 8 // 10)], drawn(n - -(-n * 8 // 10))])
            share = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
            agree.append((oph.signature(np.unique(x)) == oph.signature(np.unique(y))).mean() - share)
        assert abs(np.mean(agree)) < 0.03
    assert oph.bands(np.empty(0, np.uint64)) == []


def test_bitmaps_bound_what_is_common():
    rng = np.random.default_rng(5)
    for n in (1, 100, 130, 600, 5000):
        x = rng.integers(0, 2**64 - 1, n, np.uint64)
        for share in (0, 0.5, 0.9, 1):
            y = np.unique(np.concatenate([x[: int(share * n)], rng.integers(0, 2**64 - 1, rng.integers(1, n + 1), np.uint64)]))
            both = len(np.intersect1d(x, y))
            bound = oph.at_most_common(oph.bitmap(x), n, oph.bitmap(y), len(y))
            assert both <= bound and (share or 100 * bound < 80 * (n + len(y) - bound)) and bound == oph.at_most_common(oph.bitmap(y), len(y), oph.bitmap(x), n)


def test_small_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert not oph.near_duplicates(none).collect()
    one = spark.createDataFrame([(1, "a b", "", 0, ""), (2, None, "", 0, "")], SCHEMA)
    assert sorted(tuple(r) for r in oph.near_duplicates(one).collect()) == [(1, 1, 1, True), (2, 0, 2, True)]
