"""Filters in every order, against applying them one after another."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from confluo.llm import filter_audit

SCHEMA = "doc_id long, text string, lang string, `we.ird` string, KINDS int, part string"


def failed(rows):
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t, *_ in rows:
        t = t or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        checks = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), re.search(r"[#$%&*|]", t), i is not None and i > least[t])
        out.append("".join(n for n, bad in zip("ABCDE", checks, strict=True) if bad))
    return out


def brute(rows, labels):
    got, fails = {}, failed(rows)
    good, toxic = ({i for i, *v in labels if v[k] == 1} for k in (0, 1))
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        share = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                share[f] += len(gone)
                redundant = sum(f in x[1] for x in own) - len(gone)
                got[part, "".join(order), step] = [len(left), len(gone), redundant, sum(x[1] == f for x in own), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                got[part, "".join(order), step].append(share[f])
    return got


def random_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "b", "Cap", "ÄÖ", "d#", "x" * 30, "東京", "THE", "e&f"]
    texts = [None, "", " \t\n", "A", "ab\u0085cd ef", " ".join(f"w{k}" for k in range(200)), " ".join(f"w{k}" for k in range(199)), "\x0b".join(["q"] * 300)]
    texts += [rng.choice((" ", "\n", "  ")).join(rng.choice(words) + str(rng.randrange(rng.choice((3, 400)))) for _ in range(rng.randrange(1, 320))) for _ in range(30)]
    rows = [(rng.choice([None, *range(80)]), rng.choice(texts), rng.choice(["aa", "bb", "", None]), "x", 7, "own") for _ in range(n)]
    return [*rows, *rows[:5]]


@pytest.mark.parametrize("partitions", [1, 7])
def test_all_orders(spark, partitions):
    rows = random_rows(5)
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 90, 3)] + [(3, 1, 1), (None, 1, 1), (6, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    tags = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, filter_audit.text_filters(F.col("text")), "E", tags, {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}).collect()
    assert {(r[0], r[1], r[2]): list(r[3:]) for r in got} == brute(rows, labels) and len(got) == 600 * 3


def test_parts_that_dont_fit_at_once(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "PARTS_HELD", 2)
    run, _, _ = filter_audit._removals(["A", "B"], [])
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"part": ["x", "y", "x"], "mask": pa.array([1, 2, 3], pa.int32()), "kinds": pa.array([0, 0, 0], pa.int32()), "n": [1, 2, 3]})
    out = pa.Table.from_batches(list(run(iter([batch, batch])))).to_pylist()
    assert sum(r["removed"] for r in out if r["part"] == "x" and r["filter_order"] == "AB" and r["step"] == 1) == 8
    assert sum(r["kept"] for r in out if r["part"] == "y" and r["filter_order"] == "BA" and r["step"] == 2) == 0


def test_table():
    table = filter_audit.first_failure(5)
    assert table.shape == (32, 120) and (table[0] == 5).all() and (table[31] == 0).all()
    assert np.bincount(table[1], minlength=6).tolist() == [24] * 5 + [0]


def test_small_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert not filter_audit.audit(none, filter_audit.text_filters(F.col("text")), "E").collect()
    one = spark.createDataFrame([(1, "x " * 300_000, None, "", 0, "")], SCHEMA)
    got = filter_audit.audit(one, {"long": F.length("text") > 10, "unknown": F.lit(None).cast("boolean")}).collect()
    assert len(got) == 4 and {(r["filter_order"], r["step"], r["removed"], r["unique_fails"]) for r in got} == {("longunknown", 1, 1, 1), ("longunknown", 2, 0, 0), ("unknownlong", 1, 0, 0), ("unknownlong", 2, 1, 1)}
    with pytest.raises(ValueError):
        filter_audit.audit(one, {})
