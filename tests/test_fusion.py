import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from confluo import schema
from confluo.operators import identity, projection, sinks
from confluo.operators.components import connected_components
from confluo.operators.survivorship import experience, fuse
from confluo.sources.tables import record
from confluo.streaming.incremental import IdentityStore, follow, record_stream

OLD, NEW = "2019-04-02T08:00:00Z", "2023-11-20T17:30:00Z"


def rows(spark, *given):
    """Records of one candidate from dicts; what isn't given has the contract's default."""
    full = []
    for n, g in enumerate(given):
        base = {f.name: None for f in schema.RECORD}
        base |= {"source": f"csv_{n + 1}", "method": "normalization", "procured_at": (OLD, NEW)[min(n, 1)]} | g
        full.append([base[f.name] for f in schema.RECORD])
    df = spark.createDataFrame(full, schema.RECORD)
    return df.select(*record(**{f.name: F.col(f.name) for f in schema.RECORD})).withColumn("rid", F.xxhash64("source")).withColumn("candidate_id", F.lit("c"))


def merged(spark, *given):
    return fuse(rows(spark, *given)).first()


def test_unions_and_maximum(spark):
    mail = ["mara@orchard.example", "m.quill@harbour.example"]
    m = merged(spark, {"full_name": "Mara Quill", "emails": mail[:1], "phones": ["+35312345678"], "years_experience": 11.0}, {"full_name": "mara quill", "emails": mail[1:], "phones": ["+35312345678"], "years_experience": 4.0}, {"phones": ["+4930901820"]})
    assert m["emails"] == mail and m["phones"] == ["+35312345678", "+4930901820"] and m["years_experience"] == 11 and m["total_source_points"] == 3
    # names agree but for case: one of two repeats; e-mails differ; of three phones one repeats; no location
    assert m["overall_confidence"] == round(0.2 * 0.5 + 0.15 * 0.7 + 0.15 / 3 + 0.2 + 0.1 + 0.05 + 0.05, 6)


def test_later_name_wins(spark):
    assert merged(spark, {"full_name": "Ines Falk-Sorensen"}, {"full_name": "Ines F."})["full_name"] == "Ines F."
    tie = {"procured_at": OLD}
    assert merged(spark, {"full_name": "Tovi"} | tie, {"full_name": "Sven"} | tie, {"full_name": "Al"} | tie)["full_name"] == "Sven"


def test_skill_confidence(spark):
    named = [[("Erlang", ["csv_1"]), ("Zig", ["csv_1"])], [("Erlang", ["csv_2"])], [("Erlang", ["csv_3"]), ("Ada", ["csv_3"])], []]
    m = merged(spark, *[{"skills": x} for x in named])
    assert [(s["name"], s["sources"], s["confidence"]) for s in m["skills"]] == [("Erlang", ["csv_1", "csv_2", "csv_3"], 0.75), ("Zig", ["csv_1"], 0.25), ("Ada", ["csv_3"], 0.25)]


def test_experience(spark):
    told = [("Norwind", "Analyst", "2011-09", "2015-02", "charts of tides"), ("Norwind", "Analyst", "2012-01", None, "tides"), ("Norwind", "Lead", "2015-03", "2016-04", None), ("Norwind", "Lead", "2015-05", "2018-10", "led")]
    got = experience(rows(spark, {"experience": told[:1]}, {"experience": told[1:]})).first()
    assert [tuple(x) for x in got["experience"]] == [("Norwind", "Analyst", "2011-09", None, "charts of tides"), ("Norwind", "Lead", "2015-03", "2018-10", "led")] and got["experience_score"] == 0.8


def test_education_and_projects(spark):
    schools = [("Lakeside Polytechnic", "M.Sc.", "Geodesy", 2009), ("Lakeside Polytechnic", "msc", "Applied Geodesy", 2008), ("Other Hall", "msc", None, None)]
    built = [("Tide Table", "first", ["Ada"]), (" tide  TABLE ", "of the newer record", ["Zig"]), (None, None, None)]
    m = merged(spark, {"education": schools[:1], "projects": built[:1]}, {"education": schools[1:], "projects": built[1:]})
    assert [tuple(x) for x in m["education"]] == [("Lakeside Polytechnic", "M.Sc.", "Applied Geodesy", 2008), ("Other Hall", "msc", None, None)]
    assert [tuple(x) for x in m["projects"]] == [("Tide Table", "of the newer record", ["Zig"]), (None, None, [])]


def test_provenance(spark):
    m = merged(spark, {"full_name": "Ines Falk", "skills": [("Erlang", ["csv_1"]), ("Zig", ["csv_1"])]}, {"source": "resume_ines", "method": "by hand", "links": (None, "https://github.com/ines", None, ["u"])})
    by = {p["field"]: p for p in m["provenance"]}
    assert len(m["provenance"]) == len(by) == 14
    assert (by["phones"]["source"], by["phones"]["method"], by["phones"]["value"]) == ("multiple", "union", "[]")
    assert (by["links.github"]["source"], by["links.github"]["method"]) == ("resume_ines", "by hand") and json.loads(by["links.other"]["value"]) == ["u"]
    assert json.loads(by["skills"]["value"]) == ["Erlang", "Zig"] and by["headline"]["value"] is None
    assert json.loads(by["location"]["value"]) == {"city": None, "region": None, "country": None}


def test_location_tie_keeps_first(spark):
    m = merged(spark, {"procured_at": OLD, "location": ("Ystad", None, None)}, {"procured_at": OLD, "location": ("Arles", None, None)})
    assert m["location"]["city"] == "Ystad"


def union_find(pairs, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "loops"])
def test_components(spark, kind):
    rnd = random.Random(4)
    pairs = {
        "random": [(rnd.randrange(120), rnd.randrange(120)) for _ in range(90)],
        "chain": [(i, i + 1) for i in range(200) if i % 64 != 63],
        "star": [(7, i) for i in range(300)],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3)],
    }[kind]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == union_find(pairs, {n for p in pairs for n in p})


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([(None, 1)], "a long, b long")).count() == 0


def people(spark):
    given = [(1, ["a"], []), (2, ["b"], ["1"]), (3, ["a", "c"], []), (4, [], []), (5, ["d"], ["1"]), (6, ["c", "d"], []), (7, ["1"], [])]
    return spark.createDataFrame(given, "rid long, emails array<string>, phones array<string>")


def test_identities_bridge_and_increment(spark):
    own = people(spark)
    whole = {r["rid"]: r["component"] for r in identity.identity_components(own).collect()}
    assert whole == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1, 6: 1, 7: 7}  # a phone isn't an e-mail of the same text
    first, rest = own.where("rid <> 6"), own.where("rid in (2, 6)")
    old = identity.identity_components(first)
    assert {r["rid"]: r["component"] for r in old.collect()}[5] == 2
    assert {r["rid"]: r["component"] for r in identity.merge_increment(old, rest, own).collect()} == whole
    assert identity.identity_components(own, max_key_degree=1).select("component").distinct().count() == 7


def test_stream_of_records(spark, tmp_path):
    """Each batch is added by a store opened anew, as after a restart; a batch that was interrupted is written again."""
    given = [{"emails": ["a@x.co"], "full_name": "A"}, {"emails": ["b@x.co"], "full_name": "B"}, {"emails": ["a@x.co", "b@x.co"], "full_name": "C"}]
    folder = str(tmp_path / "store")
    (tmp_path / "store/records/1").mkdir(parents=True)
    (tmp_path / "store/records/1/part-of-an-interrupted-batch.parquet").write_text("broken")
    for n, g in enumerate([given[:2], given[2:], given[:2]]):
        numbered = [x | {"source": f"csv_{given.index(x)}"} for x in g]
        rows(spark, *numbered).drop("rid", "candidate_id").write.mode("append").parquet(str(tmp_path / "in"))
        store = IdentityStore(spark, folder)
        follow(store, record_stream(spark, str(tmp_path / "in")), str(tmp_path / "cp")).awaitTermination()
        assert store.profiles().count() == (2, 1, 1)[n] and store.done() == list(range(n + 1))
    again = IdentityStore(spark, folder)
    again.add(again.records, 1)
    assert again.profiles().first()["total_source_points"] == 3 and again.records.count() == 3


def test_contact_classes(spark):
    got = {(r["kind"], r["value"], r["rid"], r["representative"], r["n"]) for r in identity.contact_classes(people(spark)).collect()}
    assert ("email", "a", 3, 1, 2) in got and ("phone", "1", 5, 2, 2) in got and ("email", "1", 7, 7, 1) in got and len(got) == 10
    pairs = {tuple(r) for r in identity.contact_match(people(spark), people(spark)).collect()}
    assert pairs == {(a[2], b[2]) for a in got for b in got if a[:2] == b[:2]}
    with pytest.raises(ValueError):
        identity.contact_match(people(spark), people(spark), max_degree=1)


# --- projection

PROFILE = {
    "full_name": "Jane", "emails": ["j@x.co", "k@x.co"], "phones": ["+1"], "location": ("Ystad", None, "SE"), "links": ("ln", None, None, ["o1", "o2"]),
    "skills": [("Python", ["csv_1"], 1.0), ("Go", ["csv_2"], 0.5)], "experience": [("Acme", "Eng", ["x"])], "overall_confidence": 0.75, "provenance": [("full_name", "\"Jane\"", "csv_1", "n")], "years_experience": None,
}
KIND = "full_name string, emails array<string>, phones array<string>, location struct<city:string,region:string,country:string>, links struct<linkedin:string,github:string,portfolio:string,other:array<string>>, skills array<struct<name:string,sources:array<string>,confidence:double>>, experience array<struct<company:string,title:string,_start_years:array<string>>>, overall_confidence double, provenance array<struct<field:string,value:string,source:string,method:string>>, years_experience double"


@pytest.fixture(scope="module")
def profile(spark):
    return spark.createDataFrame([tuple(PROFILE.values())], KIND)


def shown(profile, **config):
    return projection.project(profile, projection.Config.of(config))


@pytest.mark.parametrize("path, expected", [
    ("full_name", "Jane"), ("emails[0]", "j@x.co"), ("location.city", "Ystad"), ("skills[].name", ["Python", "Go"]), ("links.other[]", ["o1", "o2"]), ("experience[0].company", "Acme"), ("emails[7]", None), ("nope.x", None), ("skills[].nope", []),
])
def test_paths(profile, path, expected):
    assert shown(profile, fields=[{"path": "v", "from": path}]).first()["v"] == expected


@pytest.mark.parametrize("path", ["a b", "a[0][1]", "", "a..b", "skills[].sources[]"])
def test_bad_paths(profile, path):
    with pytest.raises(projection.ProjectionError):
        shown(profile, fields=[{"path": "v", "from": path}])


def test_double_map_is_only_an_error_where_it_is_reached(profile):
    assert shown(profile, fields=[{"path": "v", "from": "nope[].b[]"}]).first()["v"] is None


def test_normalize_word(profile):
    with pytest.raises(projection.ProjectionError):
        shown(profile, fields=[{"path": "phones", "normalize": "ISO"}])
    assert shown(profile, fields=[{"path": "phones", "normalize": "E164"}]).first()["phones"] == ["+1"]


def test_missing_policies(profile):
    fields = [{"path": "full_name"}, {"path": "years_experience"}]
    assert shown(profile, fields=fields).first()["years_experience"] is None
    with pytest.raises(Exception, match="missing required value for field 'years_experience'"):
        shown(profile, fields=fields, on_missing="error").collect()
    assert json.loads(shown(profile, fields=[*fields, {"path": "location"}], on_missing="omit").first()[0]) == {"full_name": "Jane", "location": {"city": "Ystad", "region": None, "country": "SE"}}


def test_toggles(profile):
    fields = [{"path": "skills"}, {"path": "overall_confidence"}, {"path": "x", "from": "skills[].confidence"}, {"path": "confidence", "from": "full_name"}]
    off = shown(profile, fields=fields)
    assert off.columns == ["skills", "x"] and off.schema["skills"].dataType.elementType.names == ["name"] and off.first()["x"] == [1.0, 0.5]
    on = shown(profile, fields=fields, include_confidence=True, include_provenance=True)
    assert on.columns == ["skills", "overall_confidence", "x", "confidence", "provenance"] and on.first()["overall_confidence"] == 0.75


def test_underscored_keys_go(profile):
    assert shown(profile, fields=[{"path": "experience"}]).schema["experience"].dataType.elementType.names == ["company", "title"]


def test_types(spark, profile):
    assert shown(profile, fields=[{"path": "v", "from": "overall_confidence", "type": "number"}]).first()["v"] == 0.75
    for f in ({"from": "overall_confidence", "type": "integer"}, {"from": "full_name", "type": "number"}, {"from": "years_experience", "type": "number", "required": True}):
        with pytest.raises(Exception, match="validation failed"):
            shown(profile, fields=[{"path": "v"} | f]).collect()
    for f in ({"from": "full_name", "type": "string[]"}, {"from": "emails", "type": "object"}, {"from": "overall_confidence", "type": "string"}):
        with pytest.raises(projection.ProjectionError):
            shown(profile, fields=[{"path": "v"} | f])
    text = spark.createDataFrame([(" 7 ", "yes", 2.0)], "a string, b string, c double")
    got = shown(text, fields=[{"path": "a", "type": "integer"}, {"path": "b", "type": "boolean"}, {"path": "c", "type": "integer"}]).first()
    assert tuple(got) == (7, True, 2)


def test_projection_file(spark, profile, tmp_path):
    config = projection.Config.of({"fields": [{"path": "full_name"}], "on_missing": "omit"})
    sinks.write_projection(profile, config, str(tmp_path / "out.json"))
    assert (tmp_path / "out.json").read_text() == '[\n  {\n    "full_name": "Jane"\n  }\n]\n'


def test_order_and_partitions_do_not_matter(spark):
    rnd = random.Random(1)
    given = [{"full_name": f"N{rnd.randrange(3)}", "emails": [f"e{rnd.randrange(4)}@x.co"], "procured_at": rnd.choice([OLD, NEW, None]), "skills": [(f"s{rnd.randrange(3)}", [f"csv_{n}"])], "years_experience": float(rnd.randrange(3))} for n in range(12)]
    own = rows(spark, *given)
    assert fuse(own).first() == fuse(own.orderBy(F.rand(3)).repartition(7)).first()
    counts = defaultdict(int)
    for r in identity.identity_components(own).collect():
        counts[r["component"]] += 1
    assert sum(counts.values()) == 12


def test_two_exchanges(spark):
    """However many fields there are, a candidate's values are brought together twice, and joined with nothing."""
    own = rows(spark, *[{"full_name": f"N{k}", "emails": [f"e{k}@x.co"], "skills": [("a", [f"csv_{k}"])]} for k in range(9)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = fuse(own)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Exchange") == 2 and "Join" not in plan


def test_a_large_identity(spark):
    """Many records of one candidate are folded within tasks: what meets is its distinct values, and the sources of its skill."""
    n = 200_000
    many = spark.range(n).select(*record(source=F.format_string("csv_%07d", "id"), method=F.lit("m"), procured_at=F.lit(OLD), full_name=F.lit("Ada"), emails=F.array(F.concat((F.col("id") % 3).cast("string"), F.lit("@x.co"))), skills=F.array(F.struct(F.lit("Go").alias("name"), F.array(F.format_string("csv_%07d", "id")).alias("sources")))))
    got = fuse(many.withColumn("rid", F.col("source")).withColumn("candidate_id", F.lit("c"))).select("total_source_points", "emails", F.size(F.col("skills")[0]["sources"]).alias("sources"), F.col("skills")[0]["sources"][n - 1].alias("last"), "skills.confidence").collect()
    assert [tuple(r) for r in got] == [(n, ["0@x.co", "1@x.co", "2@x.co"], n, f"csv_{n - 1:07d}", [1.0])]
