"""The registered queries over small tables with awkward rows and a text of a megabyte, each against brute force."""

import collections
import hashlib
import random
import unicodedata
import zlib

import pytest
from pyspark.sql import functions as F

from confluo.llm import quality, registry, url_filter, warc
from confluo.plans.shared import new_path
from tests.llm.test_filter_audit import brute as all_orders
from tests.llm.test_oph import brute as alike
from tests.llm.test_rules import brute, hits, words_of
from tests.llm.test_search import brute as best
from tests.llm.test_similarity import components, mark_of, spoken

LONG = 7


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    d = tmp_path_factory.mktemp("tables")
    texts = [(k, t, lang) for k, t, lang in spoken(3, 180)]
    texts += [(200 + k, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) for _ in range(n)), "aa") for k, n in enumerate((49, 50, 51, 3, 120))]
    texts += [(300, None, "aa"), (301, "", None), (302, " 12 !? ", "bb"), (303, texts[5][1], "cc"), (LONG * 100, "\n".join(f"{texts[k % 180][1]} own{k}" for k in range(5000))[:1_000_000], "aa"), (305, "one two three one two three", "aa")]
    spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in texts], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 180, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    items = [(1, texts[5][1]), (2, texts[9][1]), (3, "ONE two"), (4, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    pages = [(k, f"http://h{k % 5}.example/{k}", "<p>" * (k % 4)) for k in range(60)] + [(60, None, None), (61, "x://y", "z" * 1_000_000)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    return str(d), texts, items, pages


def rows(spark, folder, name):
    return registry.QUERIES[name](spark, folder[0]).collect()


def test_op1(spark, folder):
    _, texts, items, _ = folder
    got = {r["doc_id"]: r for r in rows(spark, folder, "op1_decontaminate")}
    assert len(got) == len(texts)
    for i, t, _ in texts:
        if i == LONG * 100:
            assert got[i]["n_words"] == len(words_of(t)) and got[i]["n_items"] == 2
            continue
        n, hit, found = hits(t, items, 8)
        assert tuple(got[i][c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == (n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), len(found) >= 2)


def test_op2(spark, folder):
    first = {}
    for i, _, h in folder[3]:
        first.setdefault(h or "", i)
    got = {r["page_id"]: r for r in rows(spark, folder, "op2_warc")}
    assert len(got) == len(folder[3])
    for i, _, h in folder[3]:
        revisit = first[h or ""] != i
        assert (got[i]["payload_bytes"], got[i]["record_type"], got[i]["refers_to"]) == (len(h or ""), "revisit" if revisit else "response", first[h or ""] if revisit else None)


def test_op3(spark, folder):
    got = {r["doc_id"]: r for r in rows(spark, folder, "op3_linededup")}
    for i, t, _ in folder[1]:
        assert got[i]["chars_kept"] == (None if t is None else len(t) - got[i]["chars_removed"])
        if not got[i]["n_removed"]:
            assert got[i]["text_sha256"] == (None if t is None else hashlib.sha256(t.encode()).hexdigest())
    assert got[303]["n_removed"] == 0 or got[303]["chars_removed"] >= 40


def test_op4(spark, folder):
    texts = folder[1]
    marks = [mark_of(t) for _, t, _ in texts]
    least = {}
    for c, (i, _, _) in zip(components(marks), texts, strict=True):
        least.setdefault(c, []).append(i)
    want = {(i, f"{m:016x}", min(least[c])) for (i, _, _), m, c in zip(texts, marks, components(marks), strict=True)}
    assert {tuple(r) for r in rows(spark, folder, "op4_simhash")} == want


def test_op6(spark, folder):
    got = {r["doc_id"]: r for r in rows(spark, folder, "op6_langid")}
    right = 0
    for i, t, lang in folder[1]:
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not t or not any(c.isalpha() for c in t))
        right += r["held_out"] and i < 180 and r["lang_pred"] == lang
    assert right >= 0.95 * sum(got[i]["held_out"] for i in range(180))


def test_op7(spark, folder):
    size = lambda t: len((t or "").encode()) + 8
    whole, at, slots, want = sum(size(t) for _, t, _ in folder[1]), 0, collections.Counter(), set()
    for i, t, _ in sorted(folder[1], key=lambda x: x[0]):
        shard = min(23, (2 * at + size(t)) * 24 // (2 * whole))
        want.add((i, size(t), None if t is None else zlib.crc32(t.encode()), "bytes", shard, slots[shard], None))
        slots[shard] += 1
        at += size(t)
    assert {tuple(r) for r in rows(spark, folder, "op7_sharding")} == want


def rejects(rules, text):
    """The first rule that holds, by counts taken in Python."""
    t = text or ""
    said = [x for x in t.split("\n") if x.encode().split()]
    counts = dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), brute(text), strict=True))
    counts |= {"n_lines": len(said), "n_upper": sum(unicodedata.category(c) == "Lu" for c in t), "n_bangs": t.count("!"), "n_digits": sum(c in "0123456789" for c in t)}

    def holds(c):
        a, b = (counts[x] for x in quality.FEATURES[c.name])
        value = a / b if b else 0.0
        return value >= c.bound if c.above else value < c.bound

    return any(all(map(holds, rule)) for rule in rules)


def test_op8(spark, folder):
    got = {r["doc_id"]: r for r in rows(spark, folder, "op8_quality")}
    rules = quality.learn(*(spark.read.parquet(f"{folder[0]}/{t}.parquet") for t in ("documents", "labels")))
    for i, t, _ in folder[1]:
        r, want = got[i], brute(t)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["kept"] == (not r["base_failed"] and not rejects(rules, t))


def test_op5_and_op10(spark, folder):
    five, ten = ({r["doc_id"]: r for r in rows(spark, folder, n)} for n in ("op5_sentencepiece", "op10_katz"))
    for i, t, _ in folder[1]:
        assert five[i]["round_trip"] and ten[i]["n_tokens"] == len((t or "").split()) + 1 and ten[i]["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)


def test_op9(spark, folder):
    assert len(rows(spark, folder, "op9_url_filter")) == len(folder[3])


def test_planted_hosts_are_blocked_at_any_base_rate(spark):
    for share in (0.1, 0.6):
        rng = random.Random(1)
        seen = [(f"http://h{h}.s{h % 7}.co.uk/{k}", int(rng.random() < (0.97 if h < 8 else share))) for h in range(80) for k in range(40)]
        pages = spark.createDataFrame([(h, f"http://h{h}.s{h % 7}.co.uk/") for h in range(80)], "page_id long, url string")
        got = url_filter.filter_urls(pages, spark.createDataFrame(seen, "url string, bad int")).where(F.col("verdict") == "block").collect()
        blocked = {r["page_id"] for r in got}
        assert set(range(8)) <= blocked and len(blocked) <= 12


def test_op11(spark, folder):
    given = [(i, t, lang) for i, t, lang in folder[1]]
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 180, 2)]
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in rows(spark, folder, "op11_filter_audit")}
    assert got == all_orders(given, labels)


def test_op12(spark, folder):
    assert {tuple(r) for r in rows(spark, folder, "op12_search")} == best([(i, t) for i, t, _ in folder[1]], folder[2])


def test_op13(spark, folder):
    assert sorted((tuple(r) for r in rows(spark, folder, "op13_oph")), key=str) == alike([(i, t) for i, t, _ in folder[1]])


def test_archives_with_long_heads(spark):
    url = "http://h.example/" + "x" * 5_000_000
    pages = spark.createDataFrame([(1, url, "a"), (2, url + "?", "a"), (3, None, "b" * 700_000)], "page_id long, url string, html string")
    got = {r["record_id"]: r for r in warc.read_warc(warc.write_warc(pages, new_path(spark, "warc"))).collect()}
    assert got["urn:page:1"]["target_uri"] == url and got["urn:page:2"]["target_uri"] == url + "?" and got["urn:page:3"]["payload_bytes"] == 700_000
    assert [got[f"urn:page:{k}"]["record_type"] for k in (1, 2, 3)] == ["response", "revisit", "response"]
