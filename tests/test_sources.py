"""CSV files by splits, against the standard reader; files passed over; times of files."""

import csv
import io
import os
import random

import pyarrow as pa
import pytest

from confluo import cli
from confluo.sources import csv_scan, tables

COLUMNS = ("name", "email", "title")


def expected(data: bytes):
    rows = standard(data)
    if not rows:
        return []
    at = {c.strip(): k for k, c in enumerate(rows[0])}
    value = lambda r, c: r[at[c]] or None if c in at and at[c] < len(r) else None
    return [(k, *(value(r, c) for c in COLUMNS)) for k, r in enumerate(rows[1:], 1)]


def scanned(spark, folder, split):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows, skipped = csv_scan.scan_csv(spark, str(folder), COLUMNS)
        found = {}
        for r in rows.collect():
            found.setdefault(r["file"], []).append((r["row"], r["name"], r["email"], r["title"]))
        return {f: sorted(x) for f, x in found.items()}, {os.path.basename(r["file"]): r["reason"] for r in skipped.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


AWKWARD = (
    '﻿ name ,email,extra,title\r\n"A ""B""\nC,\r\nD",a@x.org,,"x"\r\n\r\nplain 5" disk,b@x.org,1,""\r\n'
    '"ends\n\n\nlate",c@x.org\n"q"tail,"d,d",,"last ""\n"""\r"one\rtwo",e@x.org\rthree,"f\n\rg",x,y,z\n   \n"never closed\nto the\n\nend, "" of it'
).encode()


def batches(data: bytes, cuts, **more):
    """The lines of a file as the text source gives them, each with the start of the split that it begins in; two lines a batch."""
    rows, at = [], 0
    for line in data.removesuffix(b"\n").split(b"\n"):
        block = max(c for c in (0, *cuts) if c <= at)
        rows.append({"value": line, "file": "f", "block": block, "time": None, "size": len(data), **{k: v[block] for k, v in more.items()}})
        at += len(line) + 1
    for k in range(0, len(rows), 2):
        yield pa.RecordBatch.from_pylist(rows[k : k + 2])


def by_splits(data: bytes, cuts):
    splits = [r for b in csv_scan._summaries(batches(data, cuts)) for r in b.to_pylist()]
    inside, before, state, begun = {}, {}, False, 0
    for s in splits:
        inside[s["block"]], before[s["block"]] = state, begun
        begun += s["begun1"] if state else s["begun0"]
        state = s["ends1"] if state else s["ends0"]
    parsed = [r for b in csv_scan._parsed(batches(data, cuts, inside=inside, before=before)) for r in b.to_pylist()]
    pieces = {}
    for r in parsed:
        if r["piece"] is not None:
            pieces.setdefault(r["record"], []).append(r)
    late = [{"file": "f", "record": k, "pieces": [x["piece"] for x in sorted(v, key=lambda x: x["block"])]} for k, v in pieces.items()]
    if late:
        parsed += [r for b in csv_scan._joined(iter([pa.RecordBatch.from_pylist(late)])) for r in b.to_pylist()]
    rows = sorted((r["record"], r["fields"]) for r in parsed if r["fields"] is not None)
    assert [k for k, _ in rows] == list(range(len(rows)))
    return [r for _, r in rows]


def standard(data: bytes):
    """A last line always counts as ended."""
    return [r for r in csv.reader(io.StringIO((data.removesuffix(b"\n") + b"\n").decode("utf-8-sig"), newline="")) if r]


def test_every_split_place():
    for cut in range(1, len(AWKWARD)):
        assert by_splits(AWKWARD, [cut]) == standard(AWKWARD)
    for width in (1, 2, 3, 5, 11, 30):
        assert by_splits(AWKWARD, range(width, len(AWKWARD), width)) == standard(AWKWARD)
    rng = random.Random(4)
    bits = ['"', '""', ",", "\n", "\r\n", "\r", "a", "é", " ", '"x\ny"', ',"', '",', "word"]
    for _ in range(600):
        data = ("name,email\n" + "".join(rng.choice(bits) for _ in range(rng.randrange(60)))).encode()
        assert by_splits(data, sorted(rng.sample(range(1, len(data)), 4))) == standard(data), data


def test_standing(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for f in ("x", "y", "z"):
        state, begun = False, 0
        for block in range(0, 400, 10):
            ends, n = rng.choice([(False, True), (True, False), (False, False), (True, True)]), (rng.randrange(9), rng.randrange(9))
            rows.append((f, block, None, 0, 0, *ends, *n, None))
            want[f, block] = (state, begun)
            begun, state = begun + n[state], ends[state]
    got = csv_scan._standing(spark.createDataFrame(rows, csv_scan._SUMMARY))
    assert {(r["file"], r["block"]): (r["inside"], r["before"]) for r in got.collect()} == want


@pytest.mark.parametrize("split", [48, 10**6])
def test_folder(spark, tmp_path, split):
    (tmp_path / "a b+c%20.csv").write_bytes(AWKWARD)
    (tmp_path / "B.CSV").write_text("email,name,name\nx@y.org,first,second\n")
    (tmp_path / "header.csv").write_text("name,email")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n\n")
    (tmp_path / "wide.csv").write_text(",".join(["name", *"abcdefghijklmnopqrstuvwxyz"]) + '\n' + '"' + "w\n" * 30 + '"')
    (tmp_path / "split.csv").write_text('"na\n' + "m\n" * 60 + '",email\n1,2\n')
    (tmp_path / "no.txt").write_text("name\nx\n")
    found, skipped = scanned(spark, tmp_path, split)
    names = ["a b+c%20.csv", "B.CSV", "wide.csv", *(["split.csv"] if split > 48 else [])]
    assert found == {n: expected((tmp_path / n).read_bytes()) for n in names}
    assert {f: "header" in r for f, r in skipped.items()} == ({"split.csv": True} if split == 48 else {})


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    """Many splits, half of which begin inside a quoted value, and one value that covers several splits."""
    with open(tmp_path / "big.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(COLUMNS)
        for k in range(6_000):
            w.writerow([f"n{k}", "line\n" * (k % 7), "x\n" * 60_000 if k == 777 else ""])
    found, _ = scanned(spark, tmp_path, 30_000)
    assert found == {"big.csv": expected((tmp_path / "big.csv").read_bytes())}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() >= 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_passed_over(spark, tmp_path, monkeypatch):
    (tmp_path / "good.csv").write_text("name\nAda\n")
    (tmp_path / "latin.csv").write_bytes("name\nAda\nJosé\nBo\n".encode("latin-1"))
    (tmp_path / "open.csv").write_text('name\nAda\n"' + "x\n" * 100_000)
    monkeypatch.setattr(csv_scan, "RECORD_BYTES", 100_000)
    found, skipped = scanned(spark, tmp_path, 20_000)
    assert found == {"good.csv": [(1, "Ada", None, None)]}
    assert skipped["latin.csv"].startswith("not UTF-8") and skipped["open.csv"].startswith("a record of more than") and len(skipped) == 2


def test_walk_agrees_with_the_standard_reader():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choice('"",,a\r \n') for _ in range(rng.randrange(14)))
        state, begun = False, 0
        for line in text.encode().split(b"\n"):
            state, n = csv_scan.walk(line, state)
            begun += n
        assert begun == len(csv_scan.parse(text)), repr(text)


def test_resume_times(spark, tmp_path):
    docs, files = tmp_path / "json", tmp_path / "pdf"
    docs.mkdir()
    files.mkdir()
    for name, body in {"a.json": '{"source_file": "a b.pdf", "procured_at": "2030-01-01T00:00:00Z"}', "b.JSON": '{"source_file": "b.pdf", "procured_at": "2001-01-01T00:00:00Z"}', "c.json": "{}", "bad.json": "{nope", "none.json": " \n", "empty.json": ""}.items():
        (docs / name).write_text(body)
    (files / "a b.pdf").write_text("never read")
    os.utime(files / "a b.pdf", (86400, 86400))
    raw, skipped = tables.scan_resumes(spark, str(docs), str(files))
    assert {r["source_file"]: r["procured_at"] for r in raw.collect()} == {"a b.pdf": "1970-01-02T00:00:00Z", "b.pdf": "2001-01-01T00:00:00Z", "c.json": None}
    assert {os.path.basename(r["file"]): r["reason"] for r in skipped.collect()} == {"bad.json": "not a JSON document", "none.json": "holds no document"}
    plan = tables.file_times(spark, str(files))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


ODD = {
    "a b+%20.json": b'{"source_file": "a"}', "plain é.JSON": b"{}", "array.json": b' [{"source_file": "1"}, {"source_file": "2"}]', "none.json": b"[]",
    "mixed.json": b'[1, {"source_file": "1"}]', "null in array.json": b'[null, {"source_file": "1"}]', "other type.json": b'{"source_file": "t", "lines": "x"}',
    "other type in array.json": b'[{"source_file": "t", "lines": "x"}, {"source_file": "u"}]', "number.json": b"12", "null.json": b"null", "blank.json": b" \n", "empty.json": b"",
    "two.json": b'{"source_file": "t"}{"source_file": "v"}', "bom.json": '{"source_file": "é"}'.encode("utf-8-sig"), "utf16.json": '{"source_file": "é"}'.encode("utf-16-le"),
    "latin.json": '{"source_file": "é"}'.encode("latin-1"), "cut.json": b'{"source_file": "t"', "cut array.json": b'[{"source_file": "t"}', "line end.json": b'{"source_file": "a\nb"}',
    "_hidden.json": b"{}", ".hidden.json": b"{}", "other.txt": b"{}",
}


def test_odd_documents_by_either_reader(spark, tmp_path, monkeypatch):
    """What tasks read of a folder is what Spark's reader reads of it, and files have their own names."""
    for name, body in ODD.items():
        (tmp_path / name).write_bytes(body)
    (tmp_path / "folder.json").mkdir()
    found = []
    for local in (tables.files.local_folder, lambda *_: None):
        monkeypatch.setattr(tables.files, "local_folder", local)
        rows, skipped = tables._documents(spark, str(tmp_path), tables.schema.RAW_RESUME)
        found.append((sorted((r["file"], r["source_file"] or "") for r in rows.collect()), sorted(map(tuple, skipped.collect()))))
    assert found[0] == found[1]
    assert [f for f, _ in found[0][0]] == ["a b+%20.json", "array.json", "array.json", "bom.json", "plain é.JSON", "two.json", "utf16.json"]


def test_files_are_not_listed_on_the_driver(spark, tmp_path):
    """Spark's file source keeps each file's status on the driver, once for each reader."""
    docs, files = tmp_path / "json", tmp_path / "pdf"
    for folder in (docs, files):
        folder.mkdir()
        for k in range(5):
            (folder / f"{k}.json").write_text(f'{{"source": "s{k}"}}')
    for df in (tables.read_records(spark, str(docs)), tables.read_resumes(spark, str(docs), str(files)), tables.file_times(spark, str(files))):
        assert df.inputFiles() == [] and df.count() == 5


def test_run_on_any_file_system(spark, tmp_path, capsys):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("name,email\nAda,a@x.org\nBo,b@x.org\n")
    (folder / "bad.csv").write_bytes(b"name\n\xff\n")
    assert cli.main(["run", "--csvs", f"file://{folder}", "--out", str(tmp_path / "out")]) == cli.OK
    assert tables.read_profiles(spark, str(tmp_path / "out/profiles")).count() == 2
    assert "bad.csv: not UTF-8" in capsys.readouterr().err
    assert cli.main(["run", "--csvs", str(tmp_path / "absent"), "--out", str(tmp_path / "out2")]) == cli.FAILED
    assert capsys.readouterr().err


@pytest.mark.parametrize("name", ["resume_scan", "resume_times"])
def test_resumes_written_one_each_are_not_listed_on_the_driver(spark, name, monkeypatch):
    """Spark's writer of one file each isn't used on a local file system, nor its list of files."""
    from confluo.operators import sinks
    from confluo.plans import queries

    monkeypatch.setattr(sinks, "one_each", None)
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert not any("resumes-" in f or "originals-" in f for f in df.inputFiles()) and df.count() == 150
