"""Ranked search against scoring every document."""

import collections
import math
import random
import re

import numpy as np
import pytest

from confluo.llm import search

DOCS, ITEMS = "doc_id long, text string, `we.ird` string, SCORE int, term string", "item_id long, text string, RANK int"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=50):
    own = [(i, collections.Counter(terms(t)), len(terms(t))) for i, t in docs]
    own = [x for x in own if x[2]]
    n_docs, total = len(own), sum(x[2] for x in own)
    df = collections.Counter(t for _, c, _ in own for t in c)
    wanted = collections.defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = set()
    for item, words in wanted.items():
        scores = []
        for i, c, n in own:
            m = 100 - 50 + 50 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1000000000 * c[w] // (1000 * c[w] + 20 * m)) for w in words if c[w])
            if s > 0:
                scores.append((-s, i is not None, i or 0))
        out |= {(item, k, i if named else None, -s) for k, (s, named, i) in enumerate(sorted(scores)[:top], 1)}
    return out


def tables(seed, n=300):
    rng = random.Random(seed)
    words = [*(f"w{k}" for k in range(60)), "Straße", "東京", "naïve", "A1"]
    said = lambda k: rng.choice((" ", ", ", "\n", "_")).join(rng.choice(words[: rng.choice((8, 64))]) for _ in range(k))
    docs = [(k, said(rng.randrange(1, 60))) for k in range(n)]
    docs += [(n + k, docs[7][1]) for k in range(70)] + [(n + 80, None), (n + 81, ""), (n + 82, " .,;! "), (3, docs[5][1]), (None, docs[7][1]), (n + 83, said(20_000))]
    items = [(k, said(rng.randrange(1, 30))) for k in range(8)] + [(20, docs[7][1]), (21, None), (22, "..."), (23, "nowhere"), (2, "w1 w1 W1"), (None, "w5"), (24, said(3000))]
    return docs, items


@pytest.mark.parametrize("partitions,postings,block", [(1, 10**6, 10**6), (5, 2_000, 40)])
def test_every_document_is_ranked(spark, monkeypatch, partitions, postings, block):
    docs, items = tables(partitions)
    monkeypatch.setattr(search, "BLOCK_POSTINGS", postings)
    d = spark.createDataFrame([(*x, "x", 1, "y") for x in docs], DOCS).repartition(partitions)
    got = search.rank(d, spark.createDataFrame([(*x, 0) for x in items], ITEMS), block_terms=block).collect()
    want = brute(docs, items)
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_small_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", "", 0, "")], DOCS), spark.createDataFrame([(1, "a", 0)], ITEMS)
    assert not search.rank(docs.limit(0), items).collect() and not search.rank(docs, items.limit(0)).collect()
    # w = floor(1000 ln(4 / 3)) = 287, m = 50 + 50, impact 10^9 div (1000 + 2000)
    assert [tuple(r) for r in search.rank(docs, items).collect()] == [(1, 1, 1, 287 * 333333)]


def test_it_stops_early_and_not_too_early():
    rng = np.random.default_rng(1)
    docs, n_terms = 5000, 6
    ptr = np.arange(docs + 1) * n_terms
    terms_, impacts = np.tile(np.arange(n_terms), docs), (rng.pareto(1.0, docs * n_terms) * 1000).astype(np.int64)
    impacts[: 60 * n_terms] = 10**9  # ties at the top: the smallest documents of them are the best
    p = search.Postings(ptr, terms_, impacts, n_terms)
    item = np.array([0, 2, 5])
    found, scores, rounds = p.best(0, item, 50, 0)
    assert sorted(found.tolist()) == list(range(50)) and set(scores.tolist()) == {3 * 10**9}
    assert search.FIRST_ROUND * (2**rounds - 1) < 500
    want = impacts.reshape(docs, n_terms)[:, item].sum(axis=1)
    found, scores, _ = p.best(1, item, 200, 0)
    assert sorted(zip((-scores).tolist(), found.tolist())) == sorted(zip((-want).tolist(), range(docs)))[:200]
    assert len(p.best(2, item, 50, 3 * 10**9 + 1)[0]) == 0
