"""WARC archives: a writer of one gzip member for each record, and a sequential reader."""

from __future__ import annotations

import base64
import hashlib
import re
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import new_path, settle
from ..plans.sizing import broadcast_if_small

VERSION = b"WARC/1.1"
DATE = "2000-01-01T00:00:00Z"  # records carry a fixed date, so equal input gives equal archives
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes that the reader takes and inflates at a time.
CHUNK = 1 << 18


class WarcError(ValueError):
    """An archive that breaks the format, or a record whose block or payload doesn't match its digest."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a URI or of a plain path, on whichever machine this runs."""
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a URI of the store that Spark takes it to be in, so that executors write to the same one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/+", "file:///", uri)


# --- writing


def record(record_id: str, kind: str, url: str | None, payload: bytes, payload_digest: str, refers_to: str | None = None) -> bytes:
    """One record as a gzip member. The block is an HTTP response; a revisit's holds its head only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{record_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": clean_uri(url),
        "WARC-Payload-Digest": f"sha1:{payload_digest}",
        "WARC-Block-Digest": f"sha1:{sha1_base32(block)}",
        "WARC-Refers-To": f"<{refers_to}>" if refers_to else None,
        "WARC-Profile": REVISIT if kind == "revisit" else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head.items() if v is not None)
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + deflate.flush()


def clean_uri(url: str | None) -> str | None:
    """A header value can hold no line ends; they are percent-encoded."""
    return None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")


@dataclass
class _Writer:
    """Archives of at most about ``most`` compressed bytes under names no other task or attempt uses."""

    folder: str
    most: int
    path: str = ""
    out: object = None
    size: int = 0
    records: int = 0
    done: list[tuple[str, int, int]] = field(default_factory=list)

    def add(self, member: bytes) -> None:
        if self.out is not None and self.size + len(member) > self.most:
            self.close()
        if self.out is None:
            store, folder = store_of(self.folder)
            store.create_dir(folder, recursive=True)
            name = f"{uuid.uuid4().hex}.warc.gz"
            self.path, self.out, self.size, self.records = posixpath.join(self.folder, name), store.open_output_stream(posixpath.join(folder, name), compression=None), 0, 0
        self.out.write(member)
        self.size, self.records = self.size + len(member), self.records + 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.path, self.records, self.size))
            self.out = None


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_dedup_bytes: int = 0, most_bytes: int = 256 << 20) -> DataFrame:
    """Writes a record for each row and returns the manifest (path, records, bytes), itself a table in ``folder``.

    The payload is the text in UTF-8; null gives an empty one. Of rows with equal payloads
    of at least ``min_dedup_bytes`` bytes, those with the smallest id are responses and the
    others revisit it; shorter payloads are all responses. Repeated rows of the smallest id
    are all responses. A null id is never the smallest; where no id is left, all are
    responses. A retried task writes archives of new names, and only the manifest's count.
    """
    folder = qualified(pages.sparkSession, folder)
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.encode(F.col(payload_col), "UTF-8"), F.lit(b"")).alias("payload")
    )
    # Payloads are equal if length, SHA-1 and a second hash are. The smallest id of each that
    # several rows share is found from narrow rows; payloads are exchanged only if these are many.
    same = F.struct(F.length("payload").alias("n"), F.unhex(F.sha1("payload")).alias("sha1"), F.xxhash64("payload").alias("h"))
    narrow = settle(rows.select("id", same.alias("same")).where(f"same.n >= {int(min_dedup_bytes)}").groupBy("same").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("same", "first"), "repeats")
    typed = rows.withColumn("same", same).join(broadcast_if_small(narrow), "same", "left")
    revisits = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    typed = typed.select("id", "url", "payload", F.when(revisits, F.col("first")).alias("refers"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _Writer(f"{folder}/archives", most_bytes)
        for b in batches:
            for page, url, payload, refers in zip(*(b.column(c) for c in ("id", "url", "payload", "refers")), strict=True):
                page, refers, body = page.as_py(), refers.as_py(), payload.as_py()
                kind = "response" if refers is None else "revisit"
                w.add(record(f"urn:page:{'' if page is None else page}", kind, url.as_py(), body, sha1_base32(body), None if refers is None else f"urn:page:{refers}"))
        w.close()
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*w.done, strict=True) if w.done else ([], [], []), (pa.string(), pa.int64(), pa.int64()), strict=True)], ["path", "records", "bytes"])

    typed.mapInArrow(save, "path string, records long, bytes long").write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


# --- reading


def members(source) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each an iterator of inflated pieces; memory is bounded by CHUNK.

    A member that isn't read to its end is read over before the next one starts.
    """
    left = source.read(CHUNK)
    while left:
        inflate, rest = zlib.decompressobj(31), [left]

        def pieces(inflate=inflate, rest=rest) -> Iterator[bytes]:
            while not inflate.eof:
                data = inflate.unconsumed_tail or rest.pop() if (inflate.unconsumed_tail or rest) else source.read(CHUNK)
                if not data:
                    raise WarcError("the archive ends within a gzip member")
                try:
                    piece = inflate.decompress(data, CHUNK)
                except zlib.error as e:
                    raise WarcError(f"not a gzip member: {e}") from e
                if piece:
                    yield piece

        own = pieces()
        yield own
        for _ in own:
            pass
        left = inflate.unused_data or source.read(CHUNK)


class _Head:
    """A head as it grows up to the blank line that ends it, however long its values are."""

    def __init__(self) -> None:
        self.lines = bytearray()

    def add(self, piece: bytes) -> bytes | None:
        """What follows the head, or None while it goes on; each byte is searched once."""
        since = max(0, len(self.lines) - 3)
        self.lines += piece
        end = self.lines.find(b"\r\n\r\n", since)
        if end < 0:
            return None
        rest = bytes(self.lines[end + 4 :])
        del self.lines[end:]
        return rest


class _Framed:
    """Takes a head and then blocks of known length from a member's pieces."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.held = pieces, b""

    def _more(self) -> bool:
        piece = next(self.pieces, b"")
        self.held += piece
        return bool(piece)

    def head(self) -> list[str]:
        head = _Head()
        while (rest := head.add(self.held)) is None:
            self.held = next(self.pieces, b"")
            if not self.held:
                raise WarcError("a record's head has no end")
        self.held = rest
        return bytes(head.lines).decode("utf-8", "replace").split("\r\n")

    def block(self, n: int) -> Iterator[bytes]:
        """Exactly n bytes, piece by piece."""
        while n:
            if not self.held and not self._more():
                raise WarcError("a block is shorter than its Content-Length")
            piece, self.held = self.held[:n], self.held[n:]
            n -= len(piece)
            yield piece

    def end(self) -> None:
        while self._more():
            if len(self.held) > 4:
                break
        if self.held != b"\r\n\r\n":
            raise WarcError("a block is longer than its Content-Length")


def fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def records(source, keep_payload: bool = False) -> Iterator[dict]:
    """The records of an archive in order, each verified against its digests.

    payload_bytes and payload_digest are of the full payload: measured for a response; for a
    revisit, which has none, as its HTTP head and its WARC head state them.
    """
    for pieces in members(source):
        framed = _Framed(pieces)
        lines = framed.head()
        if not lines[0].startswith("WARC/1."):
            raise WarcError(f"not a WARC record: {lines[0][:40]!r}")
        head = fields(lines[1:])
        try:
            length = int(head["content-length"])
        except (KeyError, ValueError) as e:
            raise WarcError("a record has no Content-Length") from e
        whole, body, n, kept = hashlib.sha1(), hashlib.sha1(), 0, []
        http, is_http = _Head(), head.get("content-type", "").startswith("application/http")
        in_body = not is_http
        for piece in framed.block(length):
            whole.update(piece)
            if not in_body:
                piece = http.add(piece)
                if piece is None:
                    continue
                in_body = True
            body.update(piece)
            n += len(piece)
            if keep_payload:
                kept.append(piece)
        framed.end()
        named = lambda key: head.get(key, "").removeprefix("sha1:") or None
        digest = lambda h: base64.b32encode(h.digest()).decode()
        if (want := named("warc-block-digest")) and want != digest(whole):
            raise WarcError(f"{head.get('warc-record-id')}: the block doesn't match its digest")
        kind = head.get("warc-type", "")
        if kind == "revisit":
            stated = fields(bytes(http.lines).decode("latin-1").split("\r\n")[1:]).get("content-length")
            size, sha1 = int(stated) if stated else None, named("warc-payload-digest")
        else:
            size, sha1 = n, digest(body)
            if (want := named("warc-payload-digest")) and want != sha1:
                raise WarcError(f"{head.get('warc-record-id')}: the payload doesn't match its digest")
        strip = lambda v: v.removeprefix("<").removesuffix(">") if v else None
        yield {
            "record_id": strip(head.get("warc-record-id")), "record_type": kind, "target_uri": head.get("warc-target-uri"), "refers_to": strip(head.get("warc-refers-to")),
            "payload_bytes": size, "payload_digest": sha1, "payload": b"".join(kept) if keep_payload and kind != "revisit" else None,
        }


SCHEMA = "path string, record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def read_warc(paths: DataFrame, keep_payload: bool = False, batch_rows: int = 1000, batch_bytes: int = 16 << 20) -> DataFrame:
    """Reads the archives named by ``paths.path``, one row for each record.

    An archive is a stream, so each is read by one task, in pieces; archives are dealt out
    round robin. A broken archive fails the query with WarcError. Rows go on to Spark in
    batches bounded by rows and payload bytes. No archives: no rows.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        types = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary()]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, types, strict=True)], names)
        for b in batches:
            for path in b.column("path").to_pylist():
                store, name = store_of(path)
                held, size = [], 0
                with store.open_input_stream(name, compression=None) as source:
                    for r in records(source, keep_payload):
                        held.append(r | {"path": path})
                        size += len(r["payload"] or b"")
                        if len(held) >= batch_rows or size >= batch_bytes:
                            yield pack(held)
                            held, size = [], 0
                yield pack(held)

    spark = paths.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return paths.select("path").repartition(n).mapInArrow(load, SCHEMA)


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of the .warc.gz files under a folder, for archives of other writers; their contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc.gz").load(folder)
    return found.select("path")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    manifest = write_warc(pages, new_path(spark, "warc"))
    number = lambda c: F.nullif(F.regexp_replace(c, "^urn:page:", ""), F.lit("")).cast("long")
    return read_warc(manifest).select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


#: The query in DuckDB's SQL: base32 takes five hex digits (20 bits) to four letters.
ORACLE = """
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
), d as (
  select page_id, octet_length(encode(html))::bigint as payload_bytes, min(page_id) over (partition by h) as first,
    list_transform(generate_series(0, 7), lambda i: ('0x' || substr(h, i * 5 + 1, 5))::bigint) as v from p
)
select page_id, payload_bytes,
  array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> s) & 31) + 1, 1)), '')), '') as payload_digest,
  case when first < page_id then 'revisit' else 'response' end as record_type, case when first < page_id then first end as refers_to
from d
"""
