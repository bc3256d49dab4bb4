"""Folders of many small files on a local or mounted file system: tasks list, read and write the files themselves.

Spark's file source keeps the status of every file on the driver, and its writers start a process for each file. Here the
driver holds nothing that grows with the files. Folders elsewhere are left to Spark's own readers and writers (``local`` is None).
"""

from __future__ import annotations

import json
import os
import re
import shutil
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

#: What a task holds at a time.
NAMES, FILES, BYTES = 10_000, 1_000, 8 << 20
_STAT = "name string, path string, time timestamp"
_TEXT = "name string, path string, text string, decoded boolean"
_STAT_ARROW = pa.schema([("name", pa.string()), ("path", pa.string()), ("time", pa.timestamp("us", "UTC"))])
_TEXT_ARROW = pa.schema([("name", pa.string()), ("path", pa.string()), ("text", pa.string()), ("decoded", pa.bool_())])


def _url(path: str) -> str:
    """As Spark names a local file in ``_metadata``."""
    return "file:" + re.sub(r"""[\x00-\x20\x7f"#%<>?\[\\\]^`{|}]""", lambda m: f"%{ord(m[0]):02X}", path)


def local(spark: SparkSession, path: str) -> str | None:
    """The path without its scheme, if it is on the local file system (on a cluster: mounted on all machines); None if it is elsewhere."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def local_folder(spark: SparkSession, path: str) -> str | None:
    """Like ``local``, None as well for what is no folder or has signs of a pattern: Spark's readers tell what that means."""
    found = local(spark, path)
    return found if found and os.path.isdir(found) and not set(found) & set("*?[]{}\\") else None


def _walk(folder: str, ending: str) -> Iterator[str]:
    """The files that Spark's readers would see: no hidden ones, and folders only if named like partitions."""
    with os.scandir(folder) as entries:
        for e in entries:
            if e.name.startswith(".") or (e.name.startswith("_") and "=" not in e.name):
                continue
            if e.is_dir():
                if "=" in e.name:
                    yield from _walk(e.path, ending)
            elif e.name.lower().endswith(ending):
                yield e.path


def _listed(spark: SparkSession, folder: str, ending: str) -> DataFrame:
    """(path) of a folder's files, dealt out to tasks. One task goes through the names, and holds few of them."""

    def names(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[str] = []
        for path in _walk(folder, ending):
            some.append(path)
            if len(some) == NAMES:
                yield pa.RecordBatch.from_pydict({"path": some})
                some = []
        yield pa.RecordBatch.from_pydict({"path": pa.array(some, pa.string())})

    found = spark.range(0, 1, 1, 1).mapInArrow(names, "path string")
    return found.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")


def times(spark: SparkSession, folder: str, ending: str = "") -> DataFrame:
    """(name, path, time) of a local folder's files that aren't empty; nothing is opened."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(os.path.basename(p), _url(p), s.st_mtime_ns // 1_000_000 * 1_000) for p in b.column(0).to_pylist() if (s := os.stat(p)).st_size]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_STAT_ARROW)], schema=_STAT_ARROW)

    return _listed(spark, folder, ending).mapInArrow(look, _STAT)


def texts(spark: SparkSession, folder: str, ending: str = "") -> DataFrame:
    """(name, path, text, decoded) of a local folder's files that aren't empty, one row each.

    The encoding is told from the first bytes, as JSON readers do; ``decoded`` is false where
    the text has replacements for bytes that don't fit. A file that can't be read has no text.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, held = [], 0
            for p in b.column(0).to_pylist():
                text, good = None, True
                try:
                    with open(p, "rb", buffering=0) as f:
                        raw = f.readall()
                except FileNotFoundError:
                    raise
                except OSError:
                    raw = None
                if raw is not None:
                    if not raw:
                        continue
                    kind = json.detect_encoding(raw)
                    try:
                        text = raw.decode(kind)
                    except UnicodeDecodeError:
                        text, good = raw.decode(kind, "replace"), False
                rows.append((os.path.basename(p), _url(p), text, good))
                held += len(raw or b"")
                if len(rows) == FILES or held >= BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
            yield _batch(rows)

    return _listed(spark, folder, ending).mapInArrow(load, _TEXT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_TEXT_ARROW)], schema=_TEXT_ARROW)


def write_each(rows: DataFrame, folder: str, ending: str) -> None:
    """Each row's first column, a text, as a file of its own in a local folder, with a line end.

    A task writes to a folder of its attempt and moves its files when it is done; the folder
    takes the place of an older one when all tasks are.
    """
    folder, job = os.path.realpath(folder), uuid.uuid4().hex
    new = f"{os.path.dirname(folder)}/.{os.path.basename(folder)}-{job}"

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get(), 0
        own, name = f"{new}/_temporary/{task.taskAttemptId()}", f"part-{task.partitionId():05}-{job}-c"
        os.makedirs(own)
        for b in batches:
            for text in b.column(0).to_pylist():
                with open(f"{own}/{name}{n:06}{ending}", "wb", buffering=0) as f:
                    left = memoryview(f"{text or ''}\n".encode())
                    while left:
                        left = left[f.write(left) :]
                n += 1
        for k in range(n):
            os.replace(f"{own}/{name}{k:06}{ending}", f"{new}/{name}{k:06}{ending}")
        yield pa.RecordBatch.from_pydict({"n": [n]})

    try:
        os.makedirs(f"{new}/_temporary")
        rows.mapInArrow(put, "n long").groupBy().sum("n").collect()
        shutil.rmtree(f"{new}/_temporary")
        open(f"{new}/_SUCCESS", "wb").close()
        if os.path.isdir(folder):
            shutil.rmtree(folder)
        os.rename(new, folder)
    except BaseException:
        shutil.rmtree(new, ignore_errors=True)
        raise
