"""SimHash near-duplicates, found by anchor-point covering."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..plans.shared import columns_but, settle
from ..plans.sizing import broadcast_if_small

SEED = 42
BITS = 64


# --- fingerprints


def shingle_hashes(text: str | None, size: int = 3) -> np.ndarray:
    """XXH64 of every shingle of ``size`` words (repeats too), A-Z lower-cased; of all words if there are fewer."""
    words = (text or "").encode().lower().split()  # bytes: lower() and split() know ASCII only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    line, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-size]]]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts, ends[size - 1 :], strict=True)), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray, piece: int = 1 << 15) -> int:
    """The bits set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), piece):
        part = hashes[k : k + piece].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        marks = np.array([fingerprint(shingle_hashes(t.as_py())) for t in b.column(1)], np.uint64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(marks.view(np.int64)), *b.columns[2:]], ["doc_id", "mark", *b.schema.names[2:]])


# --- anchors
#
# The code: on the lower 63 bits the Hamming code (a word is the set of the numbers 1 to 63
# of its bits; it is in the code if these numbers xor to zero), on the top bit every value.
# It is a perfect code and so covers all 64-bit words within radius 1.

COVERING_RADIUS = 1
_NUMBERS = np.arange(1, BITS, dtype=np.uint64)


def syndromes(marks: np.ndarray) -> np.ndarray:
    """The xor of the numbers of the bits set among the lower 63: parities under six masks."""
    out = np.zeros(len(marks), np.uint64)
    for bit in range(6):
        mask = np.uint64(sum(1 << int(n - 1) for n in _NUMBERS.tolist() if n >> bit & 1))
        out |= (np.bitwise_count(marks & mask).astype(np.uint64) & np.uint64(1)) << np.uint64(bit)
    return out


@cache
def flips(radius: int) -> list[np.ndarray]:
    """By syndrome: the flips of at most ``radius`` bits that lead to a code word."""
    found: list[list[int]] = [[] for _ in range(BITS)]

    def extend(first: int, syndrome: int, flipped: int, left: int) -> None:
        found[syndrome].append(flipped)
        if left:
            for n in range(first, BITS + 1):  # number 64 stands for the top bit, which has no syndrome
                extend(n + 1, syndrome ^ (n if n < BITS else 0), flipped | 1 << (n - 1), left - 1)

    extend(1, 0, 0, radius)
    return [np.array(x, np.uint64) for x in found]


def anchors(marks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, position of its fingerprint) for every code word within ``radius`` of each fingerprint."""
    table, s = flips(radius), syndromes(marks).astype(np.int64)
    counts = np.array([len(x) for x in table])[s]
    which = np.repeat(np.arange(len(marks)), counts)
    return marks[which] ^ (np.concatenate([table[k] for k in s]) if len(s) else np.empty(0, np.uint64)), which


def _spread(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = b.column("mark").to_numpy().view(np.uint64)
            for k in range(0, len(marks), 4096):
                anchor, which = anchors(marks[k : k + 4096], radius)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(marks[k : k + 4096][which].view(np.int64))], ["anchor", "mark"])

    return run


def links_within(marks: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links that join the same fingerprints as all pairs at most ``threshold`` apart would, one less than their number at most."""
    left, links = marks, []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            by = np.zeros(len(left), np.int64)
            for k, m in enumerate(front):
                new = ~near & (np.bitwise_count(left ^ m) <= threshold)
                near |= new
                by[new] = k
            links += zip(front[by[near]].tolist(), left[near].tolist(), strict=True)
            front, left = left[near], left[~near]
    return links


def _compare(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor; the last anchor's rows are held until the next batch."""
        held = (np.empty(0, np.int64), np.empty(0, np.int64))

        def links(anchor: np.ndarray, mark: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(np.diff(anchor)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(anchor)]])
            found = []
            for k in np.flatnonzero(ends - starts > 1):
                found += links_within(mark[starts[k] : ends[k]].view(np.uint64), threshold)
            pairs = np.array(sorted(set(found)), np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for b in batches:
            anchor, mark = (np.concatenate([h, b.column(c).to_numpy()]) for h, c in zip(held, ("anchor", "mark"), strict=True))
            if not len(anchor):
                continue
            cut = int(np.searchsorted(anchor, anchor[-1]))
            held = (anchor[cut:].copy(), mark[cut:].copy())
            if cut:
                yield links(anchor[:cut], mark[:cut])
        if len(held[0]):
            yield links(*held)

    return run


def link_fingerprints(marks: DataFrame, threshold: int = 2, radius: int | None = None) -> DataFrame:
    """(a, b): links among the distinct fingerprints of ``marks.mark``, which join what all pairs at most ``threshold`` bits apart would.

    Each fingerprint is copied to every anchor within ``radius`` and compared with the
    others there. The radius is the covering radius plus the threshold's half, rounded up:
    two words ``threshold`` apart have a word between them within that half of both, and an
    anchor lies within the covering radius of this word, so both meet there. (The covering
    radius plus the whole threshold is right as well and may be asked for; it sends 21 times
    the copies.) What meets at an anchor is bounded by the code, not by the data: at most
    the 2,081 words within radius 2 of it, for the default.
    """
    if radius is None:
        radius = COVERING_RADIUS + -(-threshold // 2)
    spread = marks.select("mark").mapInArrow(_spread(radius), "anchor long, mark long")
    met = spread.repartition("anchor").sortWithinPartitions("anchor")
    return met.mapInArrow(_compare(threshold), "a long, b long").distinct()


def _rooted(nodes: DataFrame, threshold: int, links: DataFrame | None) -> DataFrame:
    """nodes (distinct ``mark`` and more) with ``root``, the smallest fingerprint reachable; those without links are their own."""
    near = link_fingerprints(nodes, threshold)
    joined = connected_components(near.unionByName(links) if links is not None else near)
    return nodes.join(joined, nodes["mark"] == joined["node"], "left").select(*[nodes[c] for c in nodes.columns], F.coalesce("component", "mark").alias("root"))


def near_duplicates(docs: DataFrame, threshold: int = 2, id_col: str = "doc_id", text_col: str = "text", links: DataFrame | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs.

    fingerprint: 16 hex digits of the SimHash of the text's 3-word shingles; a null text is
    like an empty one: zero. component_id: the smallest id reachable over links of at most
    ``threshold`` bits (null ids are passed over; null if the component has no other).
    Equal fingerprints are one node, so copies cost a row each and no pairs. Repeated rows
    each give a row. An empty table gives no rows; further columns are ignored.
    ``links``, (a, b), are further pairs of fingerprints to join.
    """
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    ids = own.schema["doc_id"].dataType.simpleString()
    marked = settle(own.mapInArrow(_fingerprints, f"doc_id {ids}, mark long"), "fingerprints")
    nodes = settle(marked.groupBy("mark").agg(F.min("doc_id").alias("least")), "nodes")
    led = _rooted(nodes, threshold, links)
    roots = led.groupBy("root").agg(F.min("least").alias("component_id")).select(F.struct("root").alias("k"), "component_id")
    named = led.withColumn("k", F.struct("root")).join(roots, "k").select(F.struct("mark").alias("key"), "component_id")
    # A struct as key has both sides exchanged for this join alone, so adaptive execution can split a hot fingerprint.
    return marked.withColumn("key", F.struct("mark")).join(named, "key").select("doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def text_classes(docs: DataFrame, threshold: int = 2, id_col: str = "doc_id", text_col: str = "text", links: DataFrame | None = None) -> DataFrame:
    """(mark, lead_id, lead_mark) for each text that has near-duplicates: its ``xxhash64``, and the id and hash of its group's first row.

    Groups are those of ``near_duplicates``; one of a single text has no row here. A null id
    is the smallest; null and empty texts are one group. An empty table gives no rows.
    """
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"))
    ids = own.schema["doc_id"].dataType.simpleString()
    marked = own.mapInArrow(_fingerprints, f"doc_id {ids}, mark long, h long")
    texts = settle(marked.groupBy("mark", "h").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id")).alias("least")), "texts")
    led = _rooted(texts.select("mark").distinct(), threshold, links).select(F.struct("mark").alias("k"), "root")
    rooted = settle(texts.withColumn("k", F.struct("mark")).join(led, "k").select("h", "root", F.struct("least", "h").alias("place")), "rooted")
    first = rooted.groupBy("root").agg(F.min("place").alias("lead"), F.max("place").alias("last")).where("lead <> last").select(F.struct("root").alias("k"), "lead")
    told = rooted.withColumn("k", F.struct("root")).join(first, "k")
    return told.select(F.col("h").alias("mark"), F.col("lead.least.doc_id").alias("lead_id"), F.col("lead.h").alias("lead_mark"))


def drop_near_duplicates(docs: DataFrame, threshold: int = 2, id_col: str = "doc_id", text_col: str = "text", links: DataFrame | None = None) -> DataFrame:
    """One row of each group of near-duplicates, columns unchanged.

    Groups are those of ``near_duplicates``, found from the rows' own texts, so rows that
    share an id but no text are told apart. The row of the smallest id stays (one without an
    id only if all are); of several under that id the one whose hash over all columns is the
    smallest, which is the same row however the table is partitioned; of rows equal in every
    column one. Null and empty texts are one group. An empty table gives no rows.
    """
    p = columns_but(docs)
    same = [F.to_json(F.struct(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]
    hashed = docs.withColumn(p, F.xxhash64(*same))
    own = hashed.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(p).alias("h"))
    ids = own.schema["doc_id"].dataType.simpleString()
    marked = settle(own.mapInArrow(_fingerprints, f"doc_id {ids}, mark long, h long"), "fingerprints")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "h"))
    led = _rooted(settle(marked.groupBy("mark").agg(best.alias("least")), "nodes"), threshold, links)
    stay = led.groupBy("root").agg(F.min("least").alias("least")).select("least.doc_id", "least.h")
    # Those that go are mostly few; so are rows equal in all columns, of which only the ones that stay are brought together.
    rows = marked.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n"))
    told = rows.join(stay.withColumn("stays", F.lit(True)), rows["doc_id"].eqNullSafe(stay["doc_id"]) & (rows["h"] == stay["h"]), "left").select(rows["doc_id"], rows["h"], "n", "stays")
    odd = settle(told.where("stays IS NULL OR n > 1"), "odd").withColumnsRenamed({"doc_id": f"{p}_id", "h": f"{p}_h", "n": f"{p}_n", "stays": f"{p}_stays"})
    met = F.col(f"`{id_col}`").eqNullSafe(F.col(f"{p}_id")) & (F.col(p) == F.col(f"{p}_h"))
    once = hashed.join(broadcast_if_small(odd), met, "left_anti").drop(p)
    again = odd.where(f"{p}_stays")
    if not again.limit(1).count():
        return once
    return once.unionByName(hashed.join(broadcast_if_small(again), met, "left_semi").dropDuplicates([id_col, p]).drop(p))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
