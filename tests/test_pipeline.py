import json

import __spark_entry__
from confluo import cli
from confluo.sources import tables

CSV = '﻿name,email,phone,current_company,title\r\nAda  Byron,ADA@x.org,+44 7700 900123,,Analyst\r\n\r\n"Bo ""B"" Li",bo@y.org,+1 415 555 0100," Acme\nLtd ",Engineer\r\nCy,cy@z.org\r\n'
RESUME = {
    "source_file": "ada.pdf",
    "lines": ["Ada Byron", "INTRODUCTION", "I compute."],
    "sections": {"HEADER": ["Ada Byron"], "INTRODUCTION": ["I compute. A lot."], "TECHNICALSKILLS": ["• Languages: PY, Go."], "EDUCATION": ["Some School, London, United Kingdom", "B.Sc. in Maths 2030"], "PROJECTS": ["Engine Jan 2024 – Feb 2025", "• Tech Stack: Go, Redis"]},
    "links": [{"url": "mailto:ada@x.org", "anchor": ""}, {"url": "https://linkedin.com/in/ada", "anchor": ""}],
    "raw_text": "Ada Byron\nada@x.org",
}


def inputs(tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.CSV").write_bytes(CSV.encode())
    (tmp_path / "csv" / "b.csv").write_text("email,name,skills\ndi@w.org,Di,js; Svelte ;;JS\n")
    (tmp_path / "csv" / "c.txt").write_text("no csv")
    (tmp_path / "res").mkdir()
    (tmp_path / "res" / "ada.json").write_text(json.dumps(RESUME))
    (tmp_path / "res" / "broken.json").write_text("{nope")
    return str(tmp_path / "csv"), str(tmp_path / "res")


def test_csv(spark, tmp_path):
    csvs, _ = inputs(tmp_path)
    rows = {r["source"]: r for r in tables.csv_records(tables.read_csv(spark, csvs), cli.skill_names(spark)).collect()}
    assert set(rows) == {"csv_a.CSV_1", "csv_a.CSV_2", "csv_a.CSV_3", "csv_b.csv_1"}
    assert rows["csv_a.CSV_1"]["full_name"] == "Ada Byron" and rows["csv_a.CSV_1"]["emails"] == ["ada@x.org"]
    assert rows["csv_a.CSV_2"]["full_name"] == 'Bo "B" Li' and rows["csv_a.CSV_2"]["experience"][0]["company"] == "Acme\nLtd"
    assert rows["csv_a.CSV_3"]["phones"] == [] and rows["csv_a.CSV_3"]["experience"] == []
    assert [s["name"] for s in rows["csv_b.csv_1"]["skills"]] == ["JavaScript", "Svelte"]
    assert tables.read_csv(spark, csvs, "row").where("source = 'csv_1'").first()["name"] == "Di"


def test_end_to_end(spark, tmp_path, capsys):
    csvs, resumes = inputs(tmp_path)
    card = tmp_path / "card.json"
    card.write_text(json.dumps({"fields": [{"path": "name", "from": "full_name"}, {"path": "headline"}], "on_missing": "omit"}))
    assert cli.main(["run", "--csvs", csvs, "--resumes", resumes, "--out", str(tmp_path / "out"), "--config", str(card)]) == cli.OK
    profiles = tables.read_profiles(spark, str(tmp_path / "out/profiles"))
    assert profiles.count() == 4
    ada = profiles.where("full_name = 'Ada Byron'").first()
    assert ada["total_source_points"] == 2 and ada["location"]["country"] == "GB" and ada["headline"] == "I compute." and ada["links"]["linkedin"]
    assert [s["name"] for s in ada["skills"]] == ["Python", "Go"] and ada["projects"][0]["tech_stack"] == ["Go", "Redis"]
    assert {"name": "Ada Byron", "headline": "I compute."} in json.loads((tmp_path / "out/card.json").read_text())
    assert cli.main(["project", "--profiles", str(tmp_path / "out/profiles"), "--config", str(card), "--candidate-id", ada["candidate_id"]]) == cli.OK
    assert len(json.loads(capsys.readouterr().out)) == 1
    assert cli.main(["project", "--profiles", str(tmp_path / "out/profiles"), "--config", str(tmp_path / "none.json")]) == cli.UNREADABLE
    strict = tmp_path / "strict.json"
    strict.write_text(json.dumps({"fields": [{"path": "headline"}], "on_missing": "error"}))
    assert cli.main(["project", "--profiles", str(tmp_path / "out/profiles"), "--config", str(strict)]) == cli.FAILED


def test_unknown_skills_are_registered(spark, tmp_path):
    """Spellings of one unknown skill are one skill, named as first met, in this run and, by the taxonomy file, in the next."""
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text("name,email,skills\nEve,eve@x.org,Quark Lang; js\nEve,eve@x.org,quark-lang;JavaScript;Other\n")
    known = tmp_path / "known.json"
    args = ["run", "--csvs", str(tmp_path / "csv"), "--out", str(tmp_path / "out"), "--taxonomy", str(known)]
    assert cli.main(args) == cli.OK
    eve = tables.read_profiles(spark, str(tmp_path / "out/profiles")).first()
    assert [(s["name"], s["confidence"]) for s in eve["skills"]] == [("Quark Lang", 1.0), ("JavaScript", 1.0), ("Other", 0.5)]
    assert json.loads(known.read_text())["quarklang"] == "Quark Lang"
    (tmp_path / "csv" / "a.csv").write_text("name,email,skills\nEve,eve@x.org,QUARKLANG\n")
    assert cli.main(args) == cli.OK
    assert tables.read_profiles(spark, str(tmp_path / "out/profiles")).first()["skills"][0]["name"] == "Quark Lang"
    groups = tmp_path / "groups.json"
    groups.write_text(json.dumps({"Quark": ["qk", "quark lang"]}))
    assert cli.main(["taxonomy", "--groupings", str(groups), "--output", str(known)]) == cli.OK
    assert json.loads(known.read_text()) == {"qk": "Quark", "quark": "Quark", "quarklang": "Quark"}


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
