from pyspark.sql import Row
from pyspark.sql import functions as F

from confluo import schema
from confluo.functions import resume
from confluo.operators import taxonomy
from confluo.sources import tables

NAMES = {"python": "Python", "js": "JavaScript", "go": "Go"}


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def strings(*x):
    return F.array(*[F.lit(s) for s in x])


def test_links(spark):
    links = [("mailto:a@b.co", ""), ("tel:+1", ""), ("https://linkedin.com/in/a", ""), ("https://linkedin.com/in/b", ""), ("https://github.com/u/r", ""), ("https://GitHub.com/u/", ""), ("https://github.com/w", ""), ("https://me.dev", "My Portfolyo"), ("https://me.dev/2", "portfolio"), ("https://j.org", None), ("https://j.org", None), ("https://github.com", "")]
    rows = spark.createDataFrame([(links,)], "links array<struct<url:string,anchor:string>>")
    got = rows.select(resume.classify_links(F.col("links")).alias("v")).first()["v"]
    assert got["linkedin"] == "https://linkedin.com/in/a"
    assert got["github"] == "https://GitHub.com/u/"
    assert got["portfolio"] == "https://me.dev"
    assert got["other"] == ["https://github.com/u/r", "https://github.com/w", "https://j.org", "https://github.com"]


def test_skills_headline_phrases(spark):
    assert one(spark, resume.skill_tokens(strings("• Languages: C/C++ (9.5/10), Python (8/10) & Go.", "•• plain"))) == ["C/C++", "Python", "Go", "plain"]
    assert one(spark, resume.headline(strings("I build", "things. More."))) == "I build things."
    assert one(spark, resume.headline(strings())) is None
    assert one(spark, resume.dedup_phrase(F.lit("Some City  some city"))) == "Some City"
    assert one(spark, resume.dedup_phrase(F.lit("Some  City x"))) == "Some  City x"


def test_education(spark):
    got = one(spark, resume.education(spark, strings("Some Institute, Some City Some City, India", "Bachelor of Technology in Computer Science (CGPA: 8.5/10.00) 2023 – 2027 (Expected)")))
    assert tuple(got["location"]) == ("Some City", None, "IN")
    assert tuple(got["education"][0]) == ("Some Institute", "Bachelor of Technology", "Computer Science", 2027)
    got = one(spark, resume.education(spark, strings("School, Nowhere")))
    assert tuple(got["location"]) == (None, None, None) and tuple(got["education"][0]) == ("School, Nowhere", None, None, None)
    assert one(spark, resume.education(spark, F.array().cast("array<string>")))["education"] == []


def test_projects(spark):
    lines = ["lost", "Alpha: A System § Git repo with details May 2026–Jun 2026", "• did a thing", "went on", "• Tech Stack: Go, React, Kubernetes (K3s).", "Beta § Git repo Nov 2025", "Gamma Jan 2024 - present"]
    got = [tuple(p) for p in one(spark, resume.projects(strings(*lines)))]
    assert got == [("Alpha: A System", "did a thing went on Beta § Git repo Nov 2025", ["Go", "React", "Kubernetes (K3s)"]), ("Gamma", None, [])]


def test_sections_and_lines(spark):
    got = one(spark, resume.segment_sections(strings("A Name", "SKILLS", "x", "EDUCATION & MORE", "y", "SKILLS", "z")))
    assert got == {"HEADER": ["A Name"], "SKILLS": ["x", "z"], "EDUCATIONMORE": ["y"]}
    item = Row("doc", "page", "str", "x", "y", "w", "h")
    items = spark.createDataFrame([item("d", 1, "World", 30.0, 99.0, 20.0, 5.0), item("d", 1, "Hello", 0.0, 100.0, 25.0, 5.0), item("d", 1, "low", 0.0, 94.0, 9.0, 5.0), item("d", 2, "next", 0.0, 200.0, 9.0, 5.0)])
    notes = spark.createDataFrame([("d", 1, "https://github.com/u", 0.0, 98.0, 26.0, 106.0)], "doc string, page long, url string, x1 double, y1 double, x2 double, y2 double")
    got = tables.resumes_of_items(items, notes).first()
    assert got["lines"] == ["Hello World", "low", "next"]
    assert [tuple(x) for x in got["links"]] == [("https://github.com/u", "Hello")]
    assert tables.resumes_of_items(items, notes, by_page=False).first()["lines"][0] == "next"


def test_record(spark):
    raw = spark.createDataFrame([("r.pdf", ["An  Name"], {"TECHNICALSKILLS": ["x: PY, js, Svelte, svelte"]}, [], "me@x.com, +1 415 555 0123", None)], schema.RAW_RESUME)
    r = tables.resume_records(spark, raw, NAMES | {"py": "Python"}).first()
    assert r["full_name"] == "An Name" and r["emails"] == ["me@x.com"] and r["phones"] == ["+14155550123"]
    assert [s["name"] for s in r["skills"]] == ["Python", "JavaScript", "Svelte", "svelte"]
    assert r["procured_at"] == "1970-01-01T00:00:00Z" and r["experience"] == [] and r["links"]["other"] == []


def test_taxonomy(spark):
    known = taxonomy.taxonomy(spark)
    said = spark.createDataFrame([(1, 0, "js"), (1, 1, "JavaScript"), (1, 2, "PY"), (1, 3, "docker swarm"), (2, 0, "Svelte"), (2, 1, "svel-te"), (3, 0, " ")], "rid long, pos int, raw string")
    got = {(r["rid"], r["skill"], r["pos"]) for r in taxonomy.canonicalize(said, taxonomy.register(said, known, ["rid", "pos"]), ["rid"]).collect()}
    assert got == {(1, "JavaScript", 0), (1, "Python", 2), (1, "Docker Swarm", 3), (2, "Svelte", 0)}
    assert known.groupBy("norm").count().where("count > 1").count() == 0
