"""CSV files read by splits, also where quoted values hold line ends.

A split can't tell by itself whether it begins inside a quoted value. So a first pass over
the lines works out for both cases how each split ends and how many records begin in it; the
splits' functions are composed in file order, and the second pass, which knows where it
stands, parses. Records that cross splits are put together from their pieces.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.shared import discard, settle
from ..plans.sizing import broadcast_if_small

CSV_NAMES = "*.[cC][sS][vV]"
BOM = "﻿".encode()
#: Bytes of whole records that a task parses at a time.
PARSED_AT_ONCE = 4 << 20
#: A record that crosses splits is put together up to so many bytes. A longer one comes of a quote that isn't closed.
RECORD_BYTES = 64 << 20
_BREAK = re.compile(rb"[,\r]")


class Scan(NamedTuple):
    """Rows, and the files that were passed over: (file, reason)."""

    rows: DataFrame
    skipped: DataFrame


def step(line: bytes, at: int, inside: bool) -> tuple[bool, int, int]:
    """(inside, begun, stop): reads from ``at`` to the end of the record there, or of the line.

    inside: does it begin, and end, inside a quoted value; begun: 1 if a record begins in it
    (a blank one is none). A quote opens a value only at its beginning, and is doubled
    within; a carriage return outside ends a record.
    """
    fresh = opening = not inside
    begun = 0
    while True:
        if inside:
            at = line.find(b'"', at)
            if at < 0:
                return True, begun, len(line)
            if line[at + 1 : at + 2] == b'"':
                at += 2
                continue
            inside, opening, at = False, False, at + 1
        if opening and line[at : at + 1] == b'"':
            begun, fresh, inside, at = begun + fresh, False, True, at + 1
            continue
        m = _BREAK.search(line, at)
        stop = m.start() if m else len(line)
        begun, fresh = begun + (fresh and (stop > at or (m is not None and m.group() == b","))), False
        if m is None:
            return False, begun, stop
        if m.group() == b"\r":
            return False, begun, m.end()
        at, opening = m.end(), True


def walk(line: bytes, inside: bool) -> tuple[bool, int]:
    """(does the line end inside a quoted value, records that begin in it), given how it begins."""
    if b'"' not in line and b"\r" not in line:
        return inside, int(not inside and line != b"")
    at = begun = 0
    while True:
        inside, n, at = step(line, at, inside)
        begun += n
        if at >= len(line):
            return inside, begun


def parse(text: str) -> list[list[str]]:
    """The records of whole lines; blank ones are none."""
    csv.field_size_limit(sys.maxsize)
    return [row for row in csv.reader(io.StringIO(text, newline="")) if row]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[bytes], pa.RecordBatch, int]]:
    """(key, lines, batch, place of the first) of the runs of lines of one split; a split's runs follow each other."""
    last = None
    for b in batches:
        values = b.column("value").to_pylist()
        keys = list(zip(b.column("file").to_pylist(), b.column("block").to_pylist(), strict=True))
        start = 0
        for k in range(1, len(keys) + 1):
            if k == len(keys) or keys[k] != keys[start]:
                lines = values[start:k]
                if keys[start] != last and keys[start][1] == 0 and lines[0].startswith(BOM):
                    lines[0] = lines[0][len(BOM) :]
                last = keys[start]
                yield keys[start], lines, b, start
                start = k


def _decoded(data: bytes) -> tuple[str, str | None]:
    try:
        return data.decode("utf-8"), None
    except UnicodeDecodeError as e:
        return data.decode("utf-8", "replace"), f"not UTF-8: {e.reason}"


class _Summary:
    def __init__(self, key: tuple, time, size: int):
        self.key, self.time, self.size = key, time, size
        self.ends, self.begun, self.bytes = [False, True], [0, 0], 0
        self.header: list[str] | None = None
        self.first: list[bytes] = []

    def add(self, lines: list[bytes]) -> None:
        ends, begun = self.ends, self.begun
        for line in lines:
            self.bytes += len(line) + 1
            if self.header is None and self.key[1] == 0:
                self.first.append(line)
            if ends[0] == ends[1]:
                state, n = walk(line, ends[0])
                ends[0] = ends[1] = state
                begun[0], begun[1] = begun[0] + n, begun[1] + n
            else:
                for h in (0, 1):
                    ends[h], n = walk(line, ends[h])
                    begun[h] += n
            if self.first and begun[0] and not ends[0]:
                self.header, self.first = parse(_decoded(b"\n".join(self.first))[0])[0], []

    def row(self) -> tuple:
        return (*self.key, self.time, self.size, self.bytes, *self.ends, *self.begun, self.header)


_SUMMARY = "file string, block long, time timestamp, size long, bytes long, ends0 boolean, ends1 boolean, begun0 long, begun1 long, header array<string>"
_SUMMARY_ARROW = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("time", pa.timestamp("us", "UTC")), ("size", pa.int64()), ("bytes", pa.int64())]
    + [("ends0", pa.bool_()), ("ends1", pa.bool_()), ("begun0", pa.int64()), ("begun1", pa.int64()), ("header", pa.list_(pa.string()))]
)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Summary | None = None

    def packed(s: _Summary) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(s.row(), _SUMMARY_ARROW, strict=True)], schema=_SUMMARY_ARROW)

    for key, lines, b, at in _groups(batches):
        if now is None or now.key != key:
            if now:
                yield packed(now)
            now = _Summary(key, b.column("time")[at].as_py(), b.column("size")[at].as_py())
        now.add(lines)
    if now:
        yield packed(now)


_PARSED = "file string, record long, fields array<string>, block long, piece binary, reason string"


class _Split:
    """Parses a split's lines; what belongs to records that cross its ends is kept as pieces."""

    def __init__(self, key: tuple, inside: bool, before: int):
        self.file, self.block = key
        self.inside, self.next = inside, before  # next: the number of the next record to begin
        self.held: list[bytes] = []
        self.size = self.last = 0  # last: where among the lines held the last record begins
        self.head = inside  # the first lines belong to a record of an earlier split
        self.out: list[tuple] = []

    def add(self, lines: list[bytes]) -> None:
        for line in lines:
            if b"\r" not in line[:-1]:
                self.take(line, walk(line, self.inside)[0])
                continue
            at = 0
            while at < len(line):
                state, _, stop = step(line, at, self.inside)
                self.take(line[at:stop], state)
                at = stop

    def take(self, line: bytes, state: bool) -> None:
        """Holds a line, or a part of one up to a record's end, which leaves the reader in ``state``."""
        if not self.inside:
            self.last = len(self.held)
        self.held.append(line)
        self.size += len(line) + 1
        self.inside = state
        if not state:
            if self.head:
                self.piece(self.next - 1)
                self.head = False
            elif self.size >= PARSED_AT_ONCE:
                self.whole()

    def piece(self, record: int) -> None:
        """The lines held are a part of this record."""
        self.out.append((self.file, record, None, self.block, b"".join(x + b"\n" for x in self.held), None))
        self.held, self.size, self.last = [], 0, 0

    def whole(self) -> None:
        text, reason = _decoded(b"".join(x + b"\n" for x in self.held))
        if reason:
            self.out.append((self.file, None, None, self.block, None, reason))
        for row in parse(text):
            self.out.append((self.file, self.next, row, self.block, None, None))
            self.next += 1
        self.held, self.size, self.last = [], 0, 0

    def pause(self) -> None:
        """Parse what is complete, so that no more than a record is held between batches."""
        if self.held and not self.head and not self.inside:
            self.whole()

    def close(self) -> None:
        if not self.held:
            return
        if self.head:
            self.piece(self.next - 1)
        elif not self.inside:
            self.whole()
        else:
            tail, self.held = self.held[self.last :], self.held[: self.last]
            self.whole()
            self.held = tail
            self.piece(self.next)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.binary(), pa.string())
    names = ("file", "record", "fields", "block", "piece", "reason")
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Split | None = None
    for key, lines, b, at in _groups(batches):
        if now is None or (now.file, now.block) != key:
            if now:
                now.close()
                yield _packed(now.out)
            now = _Split(key, b.column("inside")[at].as_py(), b.column("before")[at].as_py())
        now.add(lines)
        now.pause()
        if now.out:
            yield _packed(now.out)
            now.out = []
    if now:
        now.close()
        yield _packed(now.out)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of pieces that were put together."""
    for b in batches:
        out: list[tuple] = []
        for file, record, pieces in zip(*(b.column(c).to_pylist() for c in ("file", "record", "pieces")), strict=True):
            text, reason = _decoded(b"".join(pieces))
            if reason:
                out.append((file, None, None, None, None, reason))
            out += [(file, record, row, None, None, None) for row in parse(text)]
        yield _packed(out)


@contextmanager
def _same_splits(spark: SparkSession):
    """Files are split alike by all scans within, however many executors there are at the time."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _standing(summaries: DataFrame) -> DataFrame:
    """summaries with ``inside`` (does the split begin in a quoted value) and ``before`` (records begun in earlier ones).

    Of what a split does to the state, only three kinds exist: it keeps it, turns it round,
    or sets it. So the state is the one last set, turned round as often as splits since did.
    """
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    turns = F.when(F.col("ends0") & ~F.col("ends1"), 1).otherwise(0)
    counted = summaries.withColumn("turned", F.coalesce(F.sum(turns).over(earlier), F.lit(0)))
    set_to = F.when(F.col("ends0") == F.col("ends1"), F.struct(F.col("ends0").cast("int").alias("state"), "turned"))
    last = counted.withColumn("set", F.last(set_to, ignorenulls=True).over(earlier))
    inside = (F.coalesce(F.col("set.state"), F.lit(0)) + F.col("turned") - F.coalesce(F.col("set.turned"), F.lit(0))) % 2 == 1
    stood = last.withColumn("inside", inside).withColumn("begun", F.when(F.col("inside"), F.col("begun1")).otherwise(F.col("begun0")))
    return stood.withColumn("before", F.coalesce(F.sum("begun").over(earlier), F.lit(0)))


def scan_csv(spark: SparkSession, folder: str, columns: tuple[str, ...]) -> Scan:
    """Scan(rows, skipped) of a folder's CSV files: rows have ``columns`` as strings, file, row (long, from 1 in each file) and time (the file's).

    A file's first record names its columns (surrounding blanks and a byte-order mark aside;
    of equal names the last counts). Absent columns and those a short row lacks are null,
    others ignored; empty values are null. Quotes, doubled quotes, line ends in quotes, any
    line ends, and a last value whose quote isn't closed (it ends with a line end) are understood; blank lines aren't
    counted. A file of a header alone, or empty, has no rows. A file that isn't UTF-8, can't
    be read to its end, whose header doesn't end within its first split, or of which a record
    crosses splits with more than ``RECORD_BYTES`` bytes, is skipped whole and listed in ``skipped`` with the reason. An absent folder is an error.

    Each file is read by as many tasks as it has splits; a split's lines are parsed as they
    come, so a task holds one record or ``PARSED_AT_ONCE`` bytes. The rows are written to the
    shared folder. Where each split stands is a row for each, as in Spark's own list of splits.
    """
    read = spark.read.option("pathGlobFilter", CSV_NAMES).option("lineSep", "\n").option("ignoreCorruptFiles", True)
    meta = [F.col(f"_metadata.{m}").alias(n) for m, n in (("file_path", "file"), ("file_block_start", "block"), ("file_modification_time", "time"), ("file_size", "size"))]
    with _same_splits(spark):
        lines = read.text(folder).select(F.col("value").cast("binary").alias("value"), *meta)
        summaries = settle(lines.mapInArrow(_summaries, _SUMMARY), "splits")
        stood = settle(_standing(summaries).select("file", "block", "inside", "before"), "standing")
        known = broadcast_if_small(stood)
        placed = lines.select("value", "file", "block").join(known, ["file", "block"], "left")
        placed = placed.withColumn("inside", F.when(F.col("inside").isNull(), F.raise_error(F.lit("a CSV file changed while it was read"))).otherwise(F.col("inside")))
        parsed = settle(placed.mapInArrow(_parsed, _PARSED), "csv")
    parts = parsed.where(F.col("piece").isNotNull())
    lengths = parts.groupBy("file", "record").agg(F.sum(F.octet_length("piece")).alias("n"))
    long = settle(lengths.where(f"n > {RECORD_BYTES}").select("file", F.lit(f"a record of more than {RECORD_BYTES} bytes").alias("reason")).distinct(), "long")
    pieces = parts.join(broadcast_if_small(long), "file", "left_anti").groupBy("file", "record")
    pieces = pieces.agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "piece"))), lambda x: x["piece"]).alias("pieces"))
    late = settle(pieces.mapInArrow(_joined, _PARSED), "pieces")
    every = parsed.where(F.col("piece").isNull()).unionByName(late)

    files = summaries.groupBy("file").agg(F.max("time").alias("time"), F.max("size").alias("size"), F.sum("bytes").alias("bytes"), F.max(F.when(F.col("block") == 0, F.col("header"))).alias("header"), F.sum("begun0").alias("begun"))
    damage = F.when(F.col("bytes") < F.col("size") - len(BOM), "could not be read to its end").when(F.col("header").isNull() & (F.col("begun") > 0), "its header doesn't end within its first split")
    wrong = files.select("file", damage.alias("reason")).where("reason IS NOT NULL").unionByName(every.where("reason IS NOT NULL").select("file", "reason")).unionByName(long)
    wrong = settle(wrong.groupBy("file").agg(F.min("reason").alias("reason")), "wrong")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", CSV_NAMES).load(folder).where("length > 0").select(F.col("_metadata.file_path").alias("file"))
    unread = listed.join(files.select("file"), "file", "left_anti").withColumn("reason", F.lit("could not be read"))

    trimmed = F.transform("header", lambda c: F.btrim(c))
    # array_position finds the first of equal names; the last one counts.
    at = {c: F.when(F.array_contains(trimmed, c), F.size(trimmed) - F.array_position(F.reverse(trimmed), c).cast("int")) for c in columns}
    heads = settle(files.join(wrong, "file", "left_anti").where("header IS NOT NULL").select("file", "time", *[p.alias(f"at_{k}") for k, p in enumerate(at.values())]), "heads")
    rows = every.where("fields IS NOT NULL AND record > 0").join(broadcast_if_small(heads), "file")
    shown = [F.nullif(F.get("fields", F.col(f"at_{k}")), F.lit("")).alias(c) for k, c in enumerate(columns)]
    found = rows.select(*shown, F.col("file").alias("path"), F.url_decode(F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\+", "%2B")).alias("file"), F.col("record").alias("row"), "time")
    discard(stood)
    return Scan(found, wrong.unionByName(unread))
