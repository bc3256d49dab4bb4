"""Operators whose whole result a few lines of Python can give."""

import base64
import collections
import gzip
import hashlib
import io
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from confluo.llm import decontaminate, quality, sharding, url_filter, warc
from confluo.plans.shared import new_path

DOCS = "doc_id long, text string, lang string"
#: Texts with every awkward case: null, empty, blank, long, repeated rows and ids, other scripts.
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "One two three four five six seven eight NINE ten"), (5, "one-two three,four five six seven eight; tail"), (5, "another text of the same id"),
    (6, "Größe ÄÖ a b c d e f"), (7, "x " * 3000), (8, "a b c\na b c\n\nlast! 100% <b> | $"), (8, "a b c\na b c\n\nlast! 100% <b> | $"), (9, "a b c d a b c x y z d a b"), (None, "no id at all"), (10, "\x1f\x85a\u00a0b \u2028 c"), (11, "the end of it " * 30),
]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "en") for i, t in texts], DOCS)


# --- decontamination


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def hits(t, items, n):
    w, covered, found = words_of(t), set(), set()
    for item, x in items:
        own = words_of(x)
        k = min(n, len(own))
        for i in range(len(own) - k + 1) if k else ():
            for j in range(len(w) - k + 1):
                if w[j : j + k] == own[i : i + k]:
                    covered |= set(range(j, j + k))
                    found.add(str(item))
    return len(w), len(covered), sorted(found)


ITEMS = [(1, "ONE TWO three four five six seven eight nine"), (12, "größe äö"), (2, "größe ÄÖ"), (3, ""), (4, None), (5, "three four five six seven eight; TAIL!"), (30, "x x x x x x x x x x"), (31, "of the same id"), (31, "another text")]


@pytest.mark.parametrize("block", [2_000_000, 3])
def test_contamination(spark, block):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(docs(spark), bench, block_hashes=block).collect()
    want = [(i, *hits(t, ITEMS, 8)) for i, t in TEXTS]
    key = lambda x: str(x)
    assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got], key=key) == sorted(want, key=key)
    assert all(r["contaminated"] == (r["n_items"] >= 2) for r in got) and any(r["contaminated"] for r in got)
    assert all(sum(s["e"] - s["s"] for s in r["spans"]) == r["n_hit"] for r in got)


def test_removal(spark):
    bench = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    own = docs(spark).withColumn("_c", F.lit(1)).withColumn("gram", F.lit("x")).withColumn("w", F.lit(2))
    kept = decontaminate.decontaminate(own, bench)
    assert kept.columns == own.columns
    assert collections.Counter(r["doc_id"] for r in kept.collect()) == collections.Counter(i for i, t in TEXTS if not hits(t, ITEMS[:1], 8)[1])
    cut = decontaminate.decontaminate(own, bench, remove="spans")
    by = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert by[4] == "ten" and by[6] == TEXTS[6][1] and by[1] is None and cut.count() == len(TEXTS)
    with pytest.raises(ValueError):
        decontaminate.decontaminate(own, bench, remove="lines")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_items"] for r in decontaminate.contamination(docs(spark), none).collect()} == {0}
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(docs(spark, []), bench).count() == 0
    assert decontaminate.decontaminate(docs(spark), none).count() == len(TEXTS)


def test_long_texts_and_many_ngrams(spark):
    """A million n-grams; a text of 1.2 MB with 4,000 spans that don't touch; an n-gram in every text."""
    rng = np.random.default_rng(3)
    passages = [" ".join(f"p{k}x{j}" for j in range(8)) for k in range(4000)]
    long = "\n".join(f"{p}. own{k} " + "w" * int(rng.integers(200, 400)) for k, p in enumerate(passages))
    rows = [(k, f"{passages[0]} text {k}") for k in range(300)] + [(1000, long), (1001, "clean " * 50_000)]
    own = docs(spark, rows)
    filler = spark.range(900_000).select((F.col("id") + 10).alias("item_id"), F.expr("array_join(transform(sequence(1, 8), i -> concat('f', id, 'g', i)), ' ')").alias("text"))
    bench = spark.createDataFrame(list(enumerate(passages)), "item_id long, text string").unionByName(filler)
    got = {r["doc_id"]: r for r in decontaminate.contamination(own, bench).collect()}
    assert all(got[k]["n_hit"] == 8 and got[k]["n_words"] == 10 for k in range(300)) and got[1001]["n_hit"] == 0
    assert got[1000]["n_hit"] == 32_000 and got[1000]["n_items"] == 4000 and len(got[1000]["spans"]) == 4000
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(own, bench, remove="spans").collect()}
    assert cut[5] == "text 5" and cut[1000].split()[:1] == ["own0"] and len(cut[1000].split()) == 8000 and cut[1001] == rows[-1][1]
    assert {r["doc_id"] for r in decontaminate.decontaminate(own, bench).collect()} == {1001}


# --- quality


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + d for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for d in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("bits", [24, 2])
def test_statistics(spark, monkeypatch, bits):
    """Also with so few position bits that every text takes the slow path."""
    monkeypatch.setattr(quality, "POSITION_BITS", bits)
    got = docs(spark).select(F.col("text").alias("t"), quality.statistics("text").alias("s")).collect()
    for r in got:
        assert tuple(r["s"][k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute(r["t"])


def labelled(spark, n=900):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        w = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(80)]
        if bad:
            w = [x + ("***" if k % 2 else "") for k, x in enumerate(w)]
        rows.append((i, " ".join(w), "en"))
        if i % 3:
            labels.append((i, int(not bad), 0))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels + labels[:5] + [(1, None, 0), (10**9, 0, 1)], "doc_id long, quality int, toxic int")


def test_learned_list(spark):
    own, labels = labelled(spark)
    rules = quality.learn(own, labels)
    assert rules and rules[0][0].name == "symbols_per_word"
    kept = quality.keep_good(own.withColumn("s", F.lit(1)).withColumn("judged", F.lit(2)), rules)
    assert kept.columns == [*own.columns, "s", "judged"]
    assert {r["doc_id"] for r in kept.collect()} == {i for i in range(900) if i % 5}
    judged = quality.judge(own, rules).where("not judged.kept").select("judged.rule").distinct().collect()
    assert len(judged) == 1 and judged[0]["rule"].startswith("symbols_per_word >=")
    bounded = quality.learn(own, labels, quality.Learner(sample_rows=100))
    assert bounded


def test_nothing_to_learn(spark):
    own, labels = labelled(spark, 60)
    assert quality.learn(own, labels.limit(0)) == [] and quality.learn(own, labels.where("quality = 1")) == [] and quality.learn(own.limit(0), labels) == []
    got = {r["doc_id"]: r["judged"] for r in quality.judge(docs(spark), []).collect()}
    assert got[1]["base_failed"] and not got[1]["kept"] and got[1]["rule"] is None
    assert got[11]["base_failed"]  # it repeats itself


# --- sharding


@pytest.mark.parametrize("n", [1, 5, 24])
def test_shards(spark, n):
    texts = [(i % 700 if i % 3 else 7, "é" * (i * 37 % 501)) for i in range(3000)] + [(None, None), (5, "")] + [(9, "same")] * 500
    got = sharding.shard_by_bytes(docs(spark, texts).repartition(13), n).collect()
    assert collections.Counter((r["doc_id"], r["size"]) for r in got) == collections.Counter((i, len((t or "").encode()) + 8) for i, t in texts)
    assert all(r["text_crc32"] == zlib.crc32(("é" * ((r["size"] - 8) // 2)).encode()) for r in got if r["size"] > 8 and r["size"] % 2 == 0 and r["doc_id"] != 9)
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert sorted(by) == list(range(n))
    for rows in by.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    sizes = [sum(r["size"] for r in rows) for rows in by.values()]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in got)
    first = [min((-1 if r["doc_id"] is None else r["doc_id"]) for r in by[k]) for k in range(n)]
    assert first == sorted(first)


def test_shards_of_nothing(spark):
    assert sharding.shard_by_bytes(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_by_bytes(docs(spark), 0)


# --- urls


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("https://A.Example.COM/en/7x?q#f", "a.example.com", "/en/7x", "example.com/en/7", "allow"), ("http://x.com/en/1", "x.com", "/en/1", "com/en/", "block"), ("http://com/en/", "com", "/en/", "com/en/", "block"),
    ("http://notcom/en/", "notcom", "/en/", None, None), ("ftp://m.example.net/de/80", "m.example.net", "/de/80", "example.net/de/8", "block"), ("http://a.net/de/80", "a.net", "/de/80", "net/de/", "allow"),
    ("http://o.org?x=/es/", "o.org", "", None, None), (None, "", "", None, None), ("no scheme", "", "", None, None), ("http://", "", "", None, None), ("a://b/c://d/e", "b", "/c://d/e", None, None),
])
def test_url_rules(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, 0)], "page_id long, url string, host int")
    got = url_filter.filter_urls(pages, spark.createDataFrame([], "url string, bad int")).first()
    assert (got["host"], got["path"], got["rule"]) == (host, path, rule)
    assert got["verdict"] == (verdict or "allow")


def test_reputation(spark):
    outcome = lambda host, bad, n: [(f"http://{host}/x/{k}", int(k < bad)) for k in range(n)]
    seen = outcome("bad.one.zz", 95, 100) + outcome("good.one.zz", 1, 100) + outcome("new.two.zz", 1, 1) + outcome("a.three.zz", 1, 80) + outcome("b.three.zz", 0, 80) + [("http://good.one.zz/", None)]
    pages = spark.createDataFrame([(k, f"http://{h}/") for k, h in enumerate(["bad.one.zz", "good.one.zz", "new.two.zz", "unseen.three.zz", "other.yy", "bad.one.zz"])], "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(pages, spark.createDataFrame(seen, "url string, bad int")).collect()}
    assert [got[k]["verdict"] for k in range(6)] == ["block", "allow", "allow", "allow", "allow", "block"]
    assert got[3]["posterior_mean"] < got[4]["posterior_mean"] < got[2]["posterior_mean"] < got[0]["posterior_mean"]
    assert url_filter.filter_urls(pages.limit(0), spark.createDataFrame(seen, "url string, bad int")).count() == 0


def test_suffixes(spark):
    host = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("b.uk",), ("uk",), ("",)], "h string")
    s = url_filter.suffix_of(F.col("h"), ("co.uk",))
    got = [tuple(r) for r in host.select(s, url_filter.domain_of(F.col("h"), s)).collect()]
    assert got == [("co.uk", "b.co.uk"), ("co.uk", "co.uk"), ("uk", "b.uk"), ("uk", "uk"), ("", "")]


# --- WARC

PAGES = [(3, "http://a/\r\nX: y", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "http://b", None), (4, "http://c", ""), (5, "http://d", "z" * 700_000), (6, "http://e", "\r\n\r\nWARC/1.1\r\n"), (1, "http://f", "<p>é</p>"), (None, "http://g", "<p>é</p>"), (None, "http://h", "alone"), (None, "http://i", "alone")]


def written(spark, pages, **how):
    own = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("id", F.lit(0)).withColumn("same", F.lit(0))
    return warc.write_warc(own, new_path(spark, "warc"), **how)


@pytest.mark.parametrize("least", [0, 6])
def test_round_trip(spark, least):
    manifest = written(spark, PAGES, min_dedup_bytes=least, most_bytes=500)
    assert manifest.agg(F.sum("records")).first()[0] == len(PAGES)
    got = warc.read_warc(manifest, keep_payload=True, batch_rows=2).collect()
    body = {i: (h or "").encode() for i, _, h in PAGES}
    first = {}
    for i, _, h in PAGES:
        if i is not None and len((h or "").encode()) >= least:
            first[(h or "").encode()] = min(i, first.get((h or "").encode(), i))
    assert len(got) == len(PAGES)
    for r in got:
        name = r["record_id"].removeprefix("urn:page:")
        if name:
            b = body[int(name)]
            assert r["payload_bytes"] == len(b) and r["payload_digest"] == base64.b32encode(hashlib.sha1(b).digest()).decode()
            revisit = first.get(b, int(name)) != int(name)
            assert (r["record_type"], r["refers_to"]) == (("revisit", f"urn:page:{first[b]}") if revisit else ("response", None))
            assert r["payload"] == (None if revisit else b)
    assert collections.Counter(r["record_type"] for r in got if r["record_id"] == "urn:page:") == {"revisit": 1, "response": 2}


def test_members_are_plain_gzip(spark):
    manifest = written(spark, PAGES[:3])
    paths = [r["path"] for r in manifest.collect()]
    assert warc.archives_in(spark, paths[0].rsplit("/", 1)[0]).count() == len(paths)
    data = b"".join(open(p.removeprefix("file://").removeprefix("file:"), "rb").read() for p in paths)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 3


def test_no_pages(spark):
    assert warc.read_warc(written(spark, [])).count() == 0


def sample():
    return warc.record("urn:page:1", "response", "http://a", b"payload", warc.sha1_base32(b"payload"))


@pytest.mark.parametrize("broken", [
    sample()[:-9], sample()[:30], b"plain text", gzip.compress(gzip.decompress(sample()).replace(b"payload\r\n", b"paYload\r\n")), gzip.compress(gzip.decompress(sample()) + b"more"),
    gzip.compress(gzip.decompress(sample())[:-20]), gzip.compress(gzip.decompress(sample()).replace(b"WARC/1.1", b"HTTP/1.1", 1)), gzip.compress(gzip.decompress(sample()).replace(b"\r\nContent-Length", b"\r\nContent-Size", 1)),
])
def test_broken_archives(broken):
    with pytest.raises(warc.WarcError):
        list(warc.records(io.BytesIO(sample() + broken)))


def test_reading_in_small_steps(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    assert [r["payload_bytes"] for r in warc.records(io.BytesIO(sample() * 3))] == [7] * 3
