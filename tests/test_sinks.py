"""One file for each row: what a file costs."""

import pytest

from confluo.operators import sinks


def test_documents_have_no_checksum_files(spark, tmp_path):
    """A checksum file beside each document doubled the files, and its processes the time."""
    folder = tmp_path / "documents"
    sinks.export_documents(spark.range(7).selectExpr("id", "cast(null as string) as said"), str(folder))
    files = [p.name for p in folder.iterdir() if "part-" in p.name]
    assert len(files) == 7 and all(f.endswith(".json") for f in files)
    assert sorted(p.read_text() for p in folder.glob("part-*")) == [f'{{"id":{k},"said":null}}\n' for k in range(7)]
    assert sorted(r[0] for r in spark.read.json(str(folder)).select("id").collect()) == list(range(7))


def test_documents_replace_a_folder_when_all_are_written(spark, tmp_path):
    """A failed export left nothing of the older folder, and a folder couldn't be written anew from itself."""
    folder = tmp_path / "documents"
    read = lambda: sorted(r["id"] for r in spark.read.schema("id long").json(str(folder)).collect())
    sinks.export_documents(spark.range(7), str(folder))
    with pytest.raises(Exception, match="no more"):
        sinks.export_documents(spark.range(9).selectExpr("if(id = 8, raise_error('no more'), id) as id"), str(folder))
    assert read() == list(range(7)) and [p.name for p in tmp_path.iterdir()] == ["documents"]
    sinks.export_documents(spark.read.schema("id long").json(str(folder)).where("id > 2"), str(folder))
    assert read() == [3, 4, 5, 6]


def test_documents_by_either_writer(spark, tmp_path, monkeypatch):
    rows = spark.sql("select 'é \"x\" \n' as `a b`, null as none, array(1, null) as l, timestamp'2020-01-01 10:00:00' as t, named_struct('x', null, 'y', 2.50d) as s from range(3)")
    for nulls in (True, False):
        texts = []
        for local in (sinks.files.local, lambda *_: None):
            monkeypatch.setattr(sinks.files, "local", local)
            sinks.export_documents(rows, str(tmp_path / "d"), nulls=nulls)
            texts.append(sorted(t for p in (tmp_path / "d").glob("part-*.json") if (t := p.read_text())))  # a task without rows leaves an empty file of Spark's
            monkeypatch.undo()
        assert texts[0] == texts[1] and len(texts[0]) == 3
