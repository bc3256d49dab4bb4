"""SentencePiece, Katz back-off and the pipeline against brute force."""

import collections
import math
import random
import struct
import zlib

import pytest
import sentencepiece as library
from pyspark.sql import functions as F

import corpus_pipeline
from confluo.llm import katz, langid, linededup, quality, sentencepiece
from tests.llm.test_rules import TEXTS, brute, docs, hits, labelled
from tests.llm.test_similarity import components, mark_of, passages

# --- SentencePiece


@pytest.fixture(scope="module")
def model():
    return sentencepiece.Model.load()


@pytest.fixture(scope="module")
def public():
    return library.SentencePieceProcessor(model_file=sentencepiece.MODEL_PATH)


def awkward(n=600):
    rng = random.Random(3)
    signs = " " * 8 + "abetionshr.,\n\t'\"0123éñ😀中▁‑ﬁ\u0301<s>-_()"
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(n)] + [t or "" for _, t in TEXTS] + [" " * k for k in range(40)] + ["y" * 5000, "<unk><s></s><0x0A>"]


def test_encoding_is_the_librarys(model, public):
    t = sentencepiece.Transducer(model)
    for x in awkward():
        assert list(t.encode(x)) == public.encode(x)
    small = sentencepiece.Transducer(model, keep=5)
    for x in awkward(80):
        assert list(small.encode(x)) == public.encode(x)


def test_paths_are_those_of_the_composed_machines(model):
    """Every part's path reads the normalised part, and each pair of neighbours is what merging gives."""
    t = sentencepiece.Transducer(model)
    for x in awkward(200):
        for k, part in enumerate(t._parts.findall(x)):
            state = t.normaliser.WITHIN if k else t.normaliser.START
            labels = t.shortest(part, state)
            said = list(map(t.grammar.text_of, labels))
            assert "".join(said) == t.normaliser.compose(part, state) and said == t.grammar.merged("".join(said))


def test_decoding_is_the_librarys(model, public):
    t, rng = sentencepiece.Transducer(model), random.Random(4)
    for _ in range(600):
        ids = [rng.randrange(3, 259) if rng.random() < 0.4 else rng.randrange(32000) for _ in range(rng.randrange(12))]
        assert t.decode(ids) == public.decode(ids)


def unigram(pieces):
    """A unigram model file with byte pieces, written by hand."""
    field = lambda n, data: bytes([n << 3 | 2, len(data)]) + data
    rows = [("<unk>", 0.0, 2)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] + [(p, s, 1) for p, s in pieces]
    data = b"".join(field(1, field(1, p.encode()) + b"\x15" + struct.pack("<f", s) + bytes([3 << 3, k])) for p, s, k in rows)
    return sentencepiece.Model(data + field(2, bytes([3 << 3, 1])) + field(3, field(1, b"identity") + bytes([3 << 3, 1, 4 << 3, 0])))


def test_unigram_paths_are_shortest():
    pieces = [("▁", -3.0), ("a", -2.0), ("b", -2.5), ("ab", -3.9), ("ba", -1.5), ("▁a", -2.2), ("aba", -4.25)]
    model = unigram(pieces)
    t, score = sentencepiece.Transducer(model), dict(pieces)
    rng = random.Random(8)

    def best(x):
        paths = {0: (0.0, [])}
        for end in range(1, len(x) + 1):
            options = [(paths[s][0] + (score.get(x[s:end], -14.25 if end - s == 1 else None) or -99e9), paths[s][1] + [x[s:end]]) for s in range(end) if x[s:end] in score or end - s == 1]
            paths[end] = max(options, key=lambda o: o[0])
        return paths[len(x)]

    for _ in range(200):
        x = "▁" + "".join(rng.choice("ab▁z") for _ in range(rng.randrange(1, 12)))
        own = t.shortest(x)
        assert math.isclose(sum(score.get(model.pieces[k] if k >= 0 else None, -14.25) for k in own), best(x)[0], abs_tol=1e-5)
    assert t.decode(t.encode("abba zé")) == "abba zé"


def test_encoded_tables(spark, model, public):
    own = docs(spark).withColumn("ids", F.lit("old")).withColumn("IDs2", F.lit(1))
    got = sentencepiece.encode(own, model)
    assert got.columns == ["doc_id", "text", "lang", "IDs2", "ids"]
    assert all(list(r["ids"]) == public.encode(r["text"] or "") for r in got.collect())
    back = sentencepiece.decode(got, model, into="back").collect()
    assert all(r["back"] == (r["text"] or "") for r in back) and len(back) == len(TEXTS)
    assert sentencepiece.encode(own.limit(0), model).count() == 0
    d = {r["doc_id"]: r for r in sentencepiece.digests(docs(spark), model).collect()}
    assert d[1]["n_tokens"] == 0 and all(r["round_trip"] for r in d.values()) and d[8]["n_byte_tokens"] == 3


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        sentencepiece.Model(unigram([]).data + b"\x1a\x02\x20\x01")


# --- Katz


def corpus(n=150):
    rng = random.Random(6)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(60)]
    texts = [(k, " ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randrange(40)))) for k in range(n)]
    return [x for x in TEXTS if x[0] != 7] + texts + texts[:3]


def reference(texts, hold, order=2, scored=None):
    """Katz by dictionaries: the rows of ``scored`` texts (all by default), P(w | h), histories and words for the sums."""
    end, start = object(), object()
    coded = lambda x: [(i, [*(t or "").encode().lower().split(), end]) for i, t in x]
    training = [w for i, w in coded(texts) if not hold(i)]
    history = lambda w, k, n: tuple([start, *w][max(0, k + 2 - n) : k + 1])
    c1 = collections.Counter(x for w in training for x in w)
    grams = {n: collections.Counter((history(w, k, n), x) for w in training for k, x in enumerate(w) if k >= n - 2) for n in range(2, order + 1)}
    of = lambda c: katz.discounts([sum(v == k for v in c.values()) for k in range(1, 7)])
    n_train = sum(c1.values())
    after = {}
    for g in grams.values():
        for (h, w), c in g.items():
            after.setdefault(h, {})[w] = c

    def mass(counts, d):
        """(probability by item, mass left)."""
        total = sum(counts.values())
        left = sum((1 - d[c]) * c for c in counts.values() if c <= katz.MOST)
        total, left = (total, left) if left > 0 else (total + 1, 1)
        return {w: d[min(c, 6)] * c / total for w, c in counts.items()}, left / total

    lower, unknown = mass(c1, of(c1))
    d = {n: of(g) for n, g in grams.items()}
    seen, weight = {}, {}

    def p(w, h):
        if not h:
            return lower.get(w, unknown)
        if h not in after:
            return p(w, h[1:])
        if h not in seen:
            seen[h] = mass(after[h], d[len(h) + 1])
            weight[h] = seen[h][1] / (1 - sum(p(x, h[1:]) for x in after[h]))
        return seen[h][0].get(w) or weight[h] * p(w, h[1:])

    rows = []
    for i, w in coded(texts if scored is None else scored):
        base = sum(math.log10((c1[x] + 1) / (n_train + len(c1) + 1)) for x in w)
        rows.append((i, hold(i), len(w), sum(x in c1 for x in w), n_train, base, sum(math.log10(p(x, history(w, k, order))) for k, x in enumerate(w))))
    return rows, p, after, [*c1, object()]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def agree(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9)


@pytest.mark.parametrize("order, tokens", [(2, None), (2, 150), (3, 400), (4, 100)])
def test_katz(spark, order, tokens):
    texts = corpus()
    want, p, histories, words = reference(texts, is_held, order)
    agree(katz.score(docs(spark, texts).withColumn("block", F.lit(0)).repartition(3), order=order, tokens=tokens).collect(), want)
    for h in histories:
        assert math.isclose(sum(p(w, h) for w in words), 1, rel_tol=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_a_stored_model_scores_other_texts(spark, tmp_path, order):
    texts, others = corpus(), [(1, "a ab never-seen ab a"), (2, None), (3, "abc abc b"), (3, "abc abc b"), (4, corpus()[30][1])]
    path = str(tmp_path / "model")
    katz.learn(docs(spark, texts), order=order, path=path, tokens=200)
    model = katz.Model.load(spark, path)
    assert {k: len(x.totals) > 0 for k, x in model.levels.items()}[2]
    want = reference(texts, lambda _: False, order, others)[0]
    agree([(*r[:1], False, *r[2:]) for r in katz.apply(docs(spark, others), model, tokens=7).collect()], want)
    assert katz.apply(docs(spark, []), model).count() == 0


def test_katz_without_training(spark):
    texts = [(1, "a b"), (2, None)]
    got = katz.score(docs(spark, texts), hold=F.lit(True)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in got} == {(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)}
    assert katz.score(docs(spark, [])).count() == 0
    assert katz.score(docs(spark, [(1, "x")]), hold=F.lit(False)).first()["score"] < 0


def test_discounts():
    d = katz.discounts([100, 40, 20, 12, 8, 6])
    tail = 6 * 6 / 100
    assert math.isclose(d[1], (2 * 40 / 100 - tail) / (1 - tail)) and d[6] == 1 and all(0 < x < 1 for x in d[1:6])
    assert katz.discounts([0] * 6).tolist() == [1] * 7
    assert math.isclose(katz.discounts([5, 0, 0, 0, 0, 0])[1], 0.1) and math.isclose(katz.discounts([0, 5, 0, 0, 0, 0])[1], 1)


# --- the pipeline


def test_pipeline(spark, tmp_path, model, public):
    good, labels = labelled(spark, 240)
    rows = [tuple(r)[:2] for r in good.collect()]
    rng = random.Random(2)
    leak = " ".join(f"leaked{k}" for k in range(14))
    rows += [(1000 + k, f"{t}\n{p}") for k, ((_, t), (_, p)) in enumerate(zip(rows[1:60:3], passages(), strict=False))]
    rows += [(2000, rows[1][1]), (2001, rows[2][1].replace(" ", "  ")), (2002, rows[3][1] + " " + leak), (2003, ""), (2004, None)]
    rng.shuffle(rows)
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    items = [(1, leak), (2, "a b")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    rules = quality.learn(spark.read.parquet(str(tmp_path / "documents.parquet")), labels)
    assert len(rules) == 1 and len(rules[0]) == 1 and rules[0][0].name == "symbols_per_word" and rules[0][0].above

    def passes(t):
        n_words, _, n_symbols, _, n_repeat = brute(t)
        return n_words >= 50 and n_repeat * 2 <= n_words and n_symbols / n_words < rules[0][0].bound

    left = sorted((i, t) for i, t in rows if passes(t))
    how, seen, cut = linededup.Chunker(), set(), []
    for i, t in left:
        spans = []
        for start, end, lines, words in how.chunks(t):
            if lines >= 2 and words >= how.least_words:
                c = linededup.content(t[start:end])
                spans += [(start, end)] if c in seen else []
                seen.add(c)
        new = linededup.cut_out(t, spans)
        if not spans or new.split():
            cut.append((i, new))
    comp = components([mark_of(t) for _, t in cut])
    first = {}
    for c, (i, t) in zip(comp, cut, strict=True):
        first.setdefault(c, (i, t))
    want = {i: t for i, t in first.values() if not hits(t, items, 8)[1]}
    assert {i: r["text"] for i, r in got.items()} == want
    assert all(list(r["ids"]) == public.encode(r["text"]) and r["round_trip"] and r["n_chars"] == len(r["text"]) for r in got.values())
    assert not {2000, 2001, 2002, 2003, 2004} & set(got)


def test_short_items_cost_no_document(spark, tmp_path):
    leak = " ".join(f"leaked{k}" for k in range(14))
    spark.createDataFrame([(1, leak), (2, "a b"), (3, None), (4, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = [(1, "this is a b c"), (2, f"x {leak} y"), (3, "a b"), (4, None), (5, "clean text")]
    own = docs(spark, texts).withColumn("n_chars", F.length("text").cast("long"))
    got = corpus_pipeline.benchmark_decontamination(spark, own, str(tmp_path))
    assert got.columns == own.columns
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in got.collect()} == {1: ("this is c", 9), 4: (None, None), 5: ("clean text", 10)}


def test_stages_take_awkward_tables(spark, tmp_path):
    """Extra columns with the names that stages use themselves, null and repeated ids, repeated rows, null texts, and no rows at all."""
    good = " ".join(f"word{k} and more" for k in range(40))
    kind = "doc_id long, text string, lang string, source string, n_chars long, decoded string, judged int, removed int, h long, k int, key string, items int, _c int, `we.ird` int, `Text ,.x` int"
    more = ("kept as it is", 1, 2, 3, 4, "key", 5, 6, 7, 8)
    rows = [(1, good, "en", "s", 1, *more), (1, good, "en", "s", 1, *more), (1, good[::-1], None, None, None, *more), (None, good + " x", "en", "s", 1, *more), (2, None, "en", "s", None, *more), (3, "", "en", "s", 0, *more)]
    spark.createDataFrame([(9, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "a b"), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for some in (rows, []):
        docs = spark.createDataFrame(some, kind)
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, str(tmp_path))
            assert got.columns == [*docs.columns, *(["ids", "round_trip"] if name == "tokens" else [])], name
            found = got.collect()
            assert bool(found) == bool(some) and all(r["decoded"] == "kept as it is" and r["_c"] == 6 and r["we.ird"] == 7 and r["Text ,.x"] == 8 for r in found), name
            if name == "near_duplicates" and some:
                assert sorted((r["doc_id"], r["text"] or "") for r in found) == sorted([(1, good), (1, good[::-1]), (2, "")])


def test_names_with_dots_come_through(spark):
    own = docs(spark, [(1, "abc " * 30), (2, None)]).withColumn("we.ird", F.lit(7)).withColumn("a.b.c d", F.lit(8))
    model = sentencepiece.Model.load()
    encoded = sentencepiece.encode(own, model)
    profiles = langid.Profiles().learn(own.select("doc_id", "text").withColumn("lang", F.lit("aa")))
    for got in (encoded, sentencepiece.decode(encoded, model, into="back"), profiles.predict(own), linededup.dedup_lines(own)):
        assert {r["we.ird"] for r in got.collect()} == {7} and "a.b.c d" in got.columns


def test_near_copies_go_as_a_whole(spark):
    """Copies with some words replaced are left to the stage that judges them, not cut to pieces; passages that others share go from them, too."""
    rng = random.Random(8)
    words = [f"w{k}" for k in range(5000)]
    said = lambda n: [rng.choice(words) for _ in range(n)]
    lines = lambda w: "\n".join(" ".join(w[k : k + 12]) + "." for k in range(0, len(w), 12))
    shared = lines(said(72))
    bases = [said(rng.randrange(150, 400)) for _ in range(40)]
    texts = [(k, lines(b)) for k, b in enumerate(bases)]
    texts += [(100 + 2 * k + j, lines([rng.choice(words) if rng.random() < 0.015 else w for w in b])) for k, b in enumerate(bases) for j in (0, 1)]
    texts += [(300 + k, lines(said(150)) + "\n" + shared) for k in range(20)] + [(400, lines(bases[3]) + "\n" + shared), (401, lines(bases[5]) + "\n" + shared)]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in texts}
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    own = docs(spark, texts).withColumn("n_chars", F.length("text").cast("long"))
    cut = corpus_pipeline.line_dedup(spark, own, "").cache()
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.near_duplicates(spark, cut, "").collect()}
    planted = [100 + 2 * k + j for k in range(40) for j in (0, 1) if alike(k, 100 + 2 * k + j)]
    assert len(planted) > 60 and sum(i not in left for i in planted) >= 0.9 * len(planted)
    assert set(range(40)) <= set(left) and all(left[k] == texts[k][1] for k in range(40))
    assert sum(shared in t for t in left.values()) == 1 and {300 + k for k in range(20)} <= set(left)


def test_the_tokens_stage_holds_one_worker_a_task(spark):
    """Encoding and decoding in two passes of one task had it hold two Python workers, each with its own model."""
    texts = [None, "", "plain words", " two  blanks ", "caf\u00e9 \U0001f600", "comes back \u2581 as a blank", "a\tb\nc"]
    own = docs(spark, list(enumerate(texts))).withColumn("Round_Trip", F.lit("old")).withColumn("IDS", F.lit("old"))
    got = corpus_pipeline.tokens(spark, own, "")
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    model = sentencepiece.Model.load()
    back = sentencepiece.decode(sentencepiece.encode(own, model), model, into="back").collect()
    want = {r["doc_id"]: (list(r["ids"]), r["back"] == (r["text"] or "")) for r in back}
    assert {r["doc_id"]: (list(r["ids"]), r["round_trip"]) for r in got.collect()} == want
    assert [k for k, (_, same) in want.items() if not same] == [5] and len(got.columns) == len(own.columns)


def test_stages_name_their_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "benchmark", "tokens"]
