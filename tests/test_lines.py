"""Lines and link texts of positioned items against plain loops."""

import random

from pyspark.sql import functions as F

from confluo.operators import lines
from confluo.sources import tables

ITEMS = "doc string, page int, x double, y double, w double, h double, str string"
RECTS = "doc string, page int, url string, x1 double, y1 double, x2 double, y2 double"


def placed(seed, n=400):
    rng = random.Random(seed)
    says = ["a", " b", "c ", "long word", " ", "", "é"]
    return [(rng.choice("pqr"), rng.randrange(1, 3), float(rng.randrange(200)), rng.randrange(300) / 2, float(rng.randrange(1, 9)), 2.0, rng.choice(says)) for _ in range(n)]


def brute_lines(items, by_page=True):
    out = {}
    for doc in {i[0] for i in items}:
        own = sorted((i for i in items if i[0] == doc), key=lambda i: (i[1] if by_page else 0, -i[3], i[2], i[4], i[6]))
        groups, anchor = [], None
        for i in own:
            now = (i[1] if by_page else 0, i[3])
            if anchor is None or now[0] != anchor[0] or abs(now[1] - anchor[1]) > 4:
                groups.append([])
                anchor = now
            groups[-1].append(i)
        said = []
        for g in groups:
            text, end = "", None
            for i in sorted(g, key=lambda i: (i[2], -i[3], i[4], i[6])):
                if end is not None and i[2] - end > 1.2 and not text.endswith(" ") and not i[6].startswith(" "):
                    text += " "
                text, end = text + i[6], i[2] + i[4]
            said.append(" ".join(text.split()))
        out[doc] = [t for t in said if t]
    return out


def told(frame):
    found = {}
    for r in frame.orderBy("doc", "n").collect():
        found.setdefault(r["doc"], []).append(r["line"])
    return found


def test_lines(spark):
    items = placed(1)
    frame = spark.createDataFrame(items, ITEMS).repartition(3)
    for by_page in (True, False):
        assert told(lines.grouped_lines(frame, by_page=by_page)) == brute_lines(items, by_page)
    assert not lines.grouped_lines(frame.limit(0)).collect()
    got = lines.grouped_lines(frame).agg(F.max("n").alias("n")).first()["n"]
    assert got == max(map(len, brute_lines(items).values())) - 1


def test_awkward_items(spark):
    rows = [(None, 1, 0.0, 0.0, 1.0, 1.0, "n"), ("p", 1, 5.0, None, 1.0, 1.0, "x"), ("p", 1, 6.0, None, 1.0, 1.0, "y"), ("p", 1, None, 9.0, None, 1.0, None), ("p", 1, 2.0, 9.0, 1.0, 1.0, "z")]
    assert told(lines.grouped_lines(spark.createDataFrame(rows, ITEMS))) == {None: ["n"], "p": ["x", "y", "z"]}


def test_a_long_document(spark):
    n = 100_000
    items = spark.range(n).select(F.lit("d").alias("doc"), F.lit(1).alias("page"), (F.col("id") % 10 * 10).cast("double").alias("x"), (-F.floor(F.col("id") / 10) * 10).cast("double").alias("y"), F.lit(8.5).alias("w"), F.lit("w").alias("str"))
    found = lines.grouped_lines(items).agg(F.count("line").alias("n"), F.min("line").alias("lo"), F.max("line").alias("hi")).first()
    assert tuple(found) == (n // 10, " ".join("w" * 10), " ".join("w" * 10))


def test_link_texts(spark):
    items, rng = placed(2), random.Random(3)
    rects = []
    for k in range(60):
        x, y = rng.randrange(200), rng.randrange(150)
        rects.append((rng.choice("pqrs"), rng.randrange(1, 4), f"u{k}", float(x), float(y), float(x + rng.choice((5, 30))), float(y + rng.choice((2, 12, 90)))))
    rects += [("p", 1, "tall", -1e9, -1e9, 1e9, 1e9), ("p", 1, "odd", 10.0, 20.0, 0.0, 0.0), ("p", 1, "none", None, None, 1.0, 1.0), ("q", 2, None, 0.0, 0.0, 9.0, 9.0)]

    def inside(i, r):
        cx, cy = i[2] + i[4] / 2, i[3] + i[5] / 2
        return None not in r and i[:2] == r[:2] and r[3] - 1 <= cx <= r[5] + 1 and r[4] - 1 <= cy <= r[6] + 1

    want = {r[2]: "".join(i[6] for i in sorted((i for i in items if inside(i, r)), key=lambda i: (-i[3], i[2], i[6]))).strip(" ") for r in rects if r[2]}
    got = lines.anchored_links(spark.createDataFrame(items, ITEMS), spark.createDataFrame(rects, RECTS)).collect()
    assert {r["url"]: r["anchor"] for r in got} == want and len(got) == len(want)


def test_resumes_of_items(spark):
    items = [("d", 1, 0.0, 90.0, 5.0, 2.0, "Ada"), ("d", 1, 9.0, 90.0, 5.0, 2.0, "B"), ("d", 1, 0.0, 50.0, 9.0, 2.0, "SKILLS"), ("d", 1, 0.0, 40.0, 5.0, 2.0, "Go"), ("e", 1, 0.0, 0.0, 1.0, 1.0, " ")]
    links = [("d", 1, "http://x", 8.0, 88.0, 20.0, 95.0)]
    got = {r["source_file"]: r for r in tables.resumes_of_items(spark.createDataFrame(items, ITEMS), spark.createDataFrame(links, RECTS)).collect()}
    assert got["d"]["lines"] == ["Ada B", "SKILLS", "Go"] and got["d"]["sections"] == {"HEADER": ["Ada B"], "SKILLS": ["Go"]}
    assert [tuple(x) for x in got["d"]["links"]] == [("http://x", "B")] and got["e"]["lines"] == [] and got["e"]["raw_text"] == ""
