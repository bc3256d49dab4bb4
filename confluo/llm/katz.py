"""Katz back-off language model over words: learned into partitioned tables, evaluated level by level where they lie.

Order K: P_k(w | h) = d_k(c) c(h, w) / c(h) for a gram seen c times in training, else
a_k(h) P_{k-1}(w | h') with h' the history less its oldest word; a history never seen gives
P_{k-1}. P_1(w) = d_1(c) c(w) / N for a seen word, else the mass that the discounts leave,
which belongs to the one unknown word. The discounts are Good-Turing's for counts up to
``MOST``, for each level; a_k(h) is the exact ratio of the mass that h's seen grams leave and
the mass P_{k-1} gives to the words not seen after h, so each history's probabilities sum to
1. Where the discounts leave a history (or the words) nothing, its count is taken one higher,
and this one is the mass left. A text begins with a start symbol, which no history reaches
beyond, and ends with an end, which is a token.

The model is a folder of tables, one row of packed columns for each bucket:

* ``words``: hashes, ids and counts, by hash. Ids rise with the rank in the bucket, so that
  frequent words have small ones.
* ``grams`` (partitioned by level): histories, words and counts, by history.
* ``backoff`` (partitioned by level): histories, what their counts are divided by, a(h).
* ``hot`` (partitioned by level): the same for frequent histories. Such a one would fill its
  bucket, so histories of half a bucket's tokens or more, 2 x buckets of them at most, are
  dealt out by the word that follows; what the buckets know of them is added up by a query.

Texts are coded once, in blocks of documents. For each level a block asks the buckets for its
distinct grams, and the answers (counts, and weights where a gram is unseen) give each of its
tokens P_k from P_{k-1}. Nothing of the corpus goes to the driver but sums and the hot table.
Blocks and buckets hold ``TOKENS`` tokens, or the root of ``SPOKEN`` x all tokens if this is
more, so that a message between the two holds ``SPOKEN`` tokens on average at least and their
number grows with the corpus, not with its square.
"""

from __future__ import annotations

import json
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..plans.shared import discard, new_path, settle

#: Counts above this one aren't discounted.
MOST = 5
#: Tokens of a block and of a bucket, and of a message between the two, at least.
TOKENS, SPOKEN = 1_000_000, 256
#: Bytes of text that a token takes, for a first guess at their number.
TOKEN_BYTES = 6
#: Ids of the start symbol and of words not in the model; those of the model's words follow.
START, UNKNOWN, FIRST = 0, 1, 2
#: The hash of a text's end, a symbol that no word equals, as words have no white space.
END = np.uint64(xxhash.xxh64_intdigest(b"\n</s>"))
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two numbers, element by element: a history's key from its parts."""
    x = a.astype(np.uint64) * _MIX[0] ^ (b.astype(np.uint64) + _MIX[2])
    x = (x ^ x >> np.uint64(32)) * _MIX[1]
    return x ^ x >> np.uint64(29)


# --- packed columns: bytes by significance, then zstd; small and sorted numbers take little

_SMALLER, _LARGER = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _planes(a: np.ndarray) -> bytes:
    return bytes([a.itemsize]) + _SMALLER.compress(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _bytes(data: bytes, kind: str) -> np.ndarray:
    size = data[0]
    raw = np.frombuffer(_LARGER.decompress(data[1:]), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(f"{kind}{size}").ravel()


def pack(a: np.ndarray) -> bytes:
    """Numbers that aren't negative, in as few bytes as the largest takes."""
    most = int(a.max()) if len(a) else 0
    return _planes(a.astype(next(f"u{k}" for k in (1, 2, 4, 8) if most < 1 << 8 * k)))


def unpack(data: bytes) -> np.ndarray:
    return _bytes(data, "u").astype(np.uint64)


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def pack_floats(a: np.ndarray) -> bytes:
    """Doubles by their distinct values, of which there may be few."""
    values, at = np.unique(a, return_inverse=True)
    first = _planes(values)
    return len(first).to_bytes(4, "little") + first + pack(at)


def unpack_floats(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    return _bytes(data[4 : 4 + n], "f")[unpack(data[4 + n :])]


# --- the model's numbers


def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing's d(1..MOST) from how many things were seen 1..MOST + 1 times, as an array with d[0] unused and d[MOST + 1] = 1.

    Discounts run up to the largest count for which all are between 0 and 1; if there is
    none, once-seen things are discounted by Ney's n1 / (n1 + 2 n2), held to 0.1 to 0.9.
    """
    d = np.ones(MOST + 2)
    for k in range(MOST, 0, -1):
        if not n[0]:
            break
        tail = (k + 1) * n[k] / n[0]
        if tail >= 1 or not all(n[:k]):
            continue
        own = np.array([((r + 1) * n[r] / (r * n[r - 1]) - tail) / (1 - tail) for r in range(1, k + 1)])
        if ((own > 0) & (own < 1)).all():
            d[1 : k + 1] = own
            return d
    if n[0]:
        d[1] = 1 - min(max(n[0] / (n[0] + 2 * n[1]), 0.1), 0.9)
    return d


@dataclass(frozen=True)
class Words:
    """What the words' partitions say of all training tokens."""

    tokens: int
    types: int
    texts: int
    seen: tuple[int, ...]  # how many words were seen 1..MOST + 1 times

    def probability(self, count: np.ndarray) -> np.ndarray:
        """P(w) by the word's count; for 0 that of the unknown word."""
        d = discounts(list(self.seen))
        left = float(sum((1 - d[r]) * r * self.seen[r - 1] for r in range(1, MOST + 1)))
        total, left = (self.tokens, left) if left > 0 else (self.tokens + 1, 1.0)
        return np.where(count > 0, d[np.minimum(count, MOST + 1)] * count, left) / total

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.tokens + self.types + 1))


def backoff(d: np.ndarray, count: np.ndarray, seen: np.ndarray, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(denominator, a(h)) of histories from their counts, how many of their pairs were seen 1..MOST times (rows), and the P of the words seen after them."""
    left = ((1 - d[1 : MOST + 1]) * np.arange(1, MOST + 1)) @ seen
    none = left <= 0
    total = np.where(none, count + 1, count)
    weight = np.where(none, 1.0, left) / total / np.maximum(1 - covered, np.finfo(float).tiny)
    return np.where(count > 0, total, 1), np.where(count > 0, weight, 1.0)


# --- blocks


def held_out(doc_id: Column, parts: int = 7, part: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def _block_schema(ids: T.DataType) -> T.StructType:
    b = T.BinaryType()
    return T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(ids)), T.StructField("n_train", T.LongType()), T.StructField("n_texts", T.LongType())]
        + [T.StructField(c, b) for c in ("held", "lens", "tokens", "words", "counts")]
    )


def _blocks(ids_type: pa.DataType, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, held, lens, tokens, vocabulary = [], [], [], array("i"), defaultdict()
        vocabulary.default_factory = vocabulary.__len__
        place = vocabulary.__getitem__
        end = place(None)

        def block() -> pa.RecordBatch:
            words = list(vocabulary)
            hashes = np.fromiter((END if w is None else xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
            order = np.argsort(hashes, kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[order] = np.arange(len(words), dtype=np.uint32)
            coded, each = rank[np.frombuffer(tokens, np.int32)], np.array(lens, np.uint32)
            train = np.repeat(~np.array(held, bool), each)
            counts = np.bincount(coded[train], minlength=len(words)).astype(np.uint32)
            row = [number, ids, int(train.sum()), len(held) - sum(held), pack(np.array(held, np.uint8)), pack(each), pack(coded), pack_sorted(hashes[order]), pack(counts)]
            kinds = [pa.int64(), pa.list_(ids_type), pa.int64(), pa.int64()] + [pa.binary()] * 5
            names = ["block", "ids", "n_train", "n_texts", "held", "lens", "tokens", "words", "counts"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for b in batches:
            for key, out, x in zip(b.column("doc_id").to_pylist(), b.column("held").to_pylist(), b.column("text"), strict=True):
                words = (x.as_py() or "").encode().lower().split()  # bytes: lower() and split() know ASCII only
                if lens and len(tokens) + len(words) >= most:
                    yield block()
                    number += 1
                    ids, held, lens, tokens = [], [], [], array("i")
                    vocabulary.clear()
                    end = place(None)
                tokens.extend(map(place, words))
                tokens.append(end)
                ids.append(key)
                held.append(out)
                lens.append(len(words) + 1)
        if lens:
            yield block()

    return run


def _schema(text: str) -> T.StructType:
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "binary": T.BinaryType(), "longs": T.ArrayType(T.LongType()), "doubles": T.ArrayType(T.DoubleType())}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split() for x in text.split(", "))])


def _rows(schema: T.StructType, rows: list[tuple]) -> pa.RecordBatch:
    cells = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(cells, schema, strict=True)], schema.names)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time: a batch of them would be far larger as Python values."""
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[Iterator[dict]]:
    """The rows of each key, which they come sorted by; a group is read before the next one."""
    return (rows for _, rows in groupby(_each(batches), lambda r: r[key]))


def _union(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right, allowMissingColumns=True)


def _dealt(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """Each bucket's rows in a partition of its own."""
    return rows.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", *order)


@dataclass(frozen=True)
class Spread:
    """How blocks are dealt: their numbers (the task that made them, then one after the other) as places, of which there are twice as many as blocks at most."""

    parts: int
    each: int

    @classmethod
    def of(cls, blocks: DataFrame) -> Spread:
        r = blocks.agg(F.count(F.lit(1)).alias("n"), F.max(F.shiftright("block", 32)).alias("task"), F.max(F.col("block").bitwiseAND((1 << 32) - 1)).alias("k")).first()
        each = (r["k"] or 0) + 1
        return cls(max(1, min(((r["task"] or 0) + 1) * each, 2 * r["n"])), each)

    def dealt(self, rows: DataFrame) -> DataFrame:
        place = F.shiftright("block", 32) * self.each + F.col("block").bitwiseAND((1 << 32) - 1)
        return rows.repartitionById(self.parts, F.pmod(place, F.lit(self.parts)).cast("int")).sortWithinPartitions("block", "bucket")


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Equal ranges of the hashes' upper half, so sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _slices(buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, start, end) of the runs in sorted buckets."""
    if len(buckets):
        cuts = np.flatnonzero(np.diff(buckets)) + 1
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(buckets)], strict=True):
            yield int(buckets[s]), s, e


# --- words

ASK_WORDS = _schema("bucket int, block long, words binary, counts binary")
TOLD_WORDS = _schema("bucket int, block long, words binary, ids binary, counts binary, stats longs, often longs")


def _ask_words(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            words, counts = unpack_sorted(row["words"]), unpack(row["counts"])
            yield _rows(ASK_WORDS, [(k, row["block"], pack_sorted(words[s:e]), pack(counts[s:e])) for k, s, e in _slices(bucket_of(words, n))])

    return run


def _tell_words(n: int, often: int | None):
    """A bucket's row for the model (without ``often``: it is there) and the ids and counts of the words that blocks asked about."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "bucket"):
            rows = list(group)  # a bucket's share of the vocabulary from each block
            bucket = rows[0]["bucket"]
            known, ids, counts = (np.empty(0, np.uint64) for _ in range(3))
            if often is None:
                if rows[0]["block"] is None:
                    known, ids, counts = unpack_sorted(rows[0]["words"]), unpack(rows[0]["ids"]), unpack(rows[0]["counts"])
                    rows = rows[1:]
                out = []
            else:
                known, at = np.unique(np.concatenate([unpack_sorted(r["words"]) for r in rows]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([unpack(r["counts"]) for r in rows]), len(known)).astype(np.uint64)
                known, counts = known[counts > 0], counts[counts > 0]
                ids = np.empty(len(known), np.uint64)
                ids[np.argsort(-counts.astype(np.int64), kind="stable")] = np.arange(len(known), dtype=np.uint64) * np.uint64(n) + np.uint64(FIRST + bucket)
                stats = [int((counts == k).sum()) for k in range(1, MOST + 2)] + [len(known)]
                out = [(bucket, None, pack_sorted(known), pack(ids), pack(counts), stats, ids[counts >= often].view(np.int64).tolist())]
            ids, counts = np.append(ids, np.uint64(UNKNOWN)), np.append(counts, np.uint64(0))
            for r in rows:
                at = _places(known, unpack_sorted(r["words"]))
                out.append((bucket, r["block"], None, pack(ids[at]), pack(counts[at]), None, None))
            yield _rows(TOLD_WORDS, out)

    return run


def _places(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where each of ``asked`` is in the sorted ``known``; the place after the last for those that aren't."""
    if not len(known):
        return np.zeros(len(asked), np.int64)
    at = np.searchsorted(known, asked)
    return np.where(known[np.minimum(at, len(known) - 1)] == asked, at, len(known))


def _coded_schema(ids: T.DataType) -> T.StructType:
    """A block with its words' ids: ``tokens`` are places in ``uniq`` (sorted ids; the start and the unknown word are the first two)."""
    b = T.BinaryType()
    return T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(ids)), *[T.StructField(c, b) for c in ("held", "lens", "tokens", "uniq", "counts", "probs")]])


def _recode(schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "block"):
            block = next(rows)
            told = [(unpack(r["word_ids"]), unpack(r["counts"])) for r in rows]
            ids, counts = np.concatenate([x[0] for x in told]), np.concatenate([x[1] for x in told])
            uniq, at = np.unique(np.append(ids, np.array([START, UNKNOWN], np.uint64)), return_inverse=True)
            of = np.zeros(len(uniq), np.uint64)
            of[at[:-2]] = counts
            yield _rows(schema, [(block["block"], block["ids"], block["held"], block["lens"], pack(at[unpack(block["tokens"])]), pack_sorted(uniq), pack(of), None)])

    return run


# --- grams

ASK_GRAMS = _schema("bucket int, block long, histories binary, sizes binary, words binary, counts binary, lower binary")
COUNTED = _schema("bucket int, histories binary, sizes binary, words binary, counts binary, totals binary, seen binary, covered binary, stats longs, often longs, hot longs, hot_counts longs, hot_covered doubles")
BACKOFF = _schema("bucket int, histories binary, totals binary, weights binary")
TOLD_GRAMS = _schema("bucket int, block long, counts binary, totals binary, weights binary")


@dataclass(frozen=True)
class Level:
    """What is known of a level beyond its tables: the discounts, and the frequent histories (sorted) with their divisors and weights."""

    discounts: np.ndarray
    hot: np.ndarray
    totals: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))


@dataclass
class _Grams:
    """The distinct grams of some of a block's tokens, ordered by the bucket that knows them, and where each of these tokens' is."""

    histories: np.ndarray  # keys
    history: np.ndarray  # of each gram, a place among histories
    word: np.ndarray  # and one among uniq
    bucket: np.ndarray
    tokens: np.ndarray  # the places of the tokens in the block
    at: np.ndarray

    @classmethod
    def of(cls, row: dict, level: int, n: int, hot: np.ndarray, train: bool) -> _Grams:
        uniq, tokens, lens = unpack_sorted(row["uniq"]), unpack(row["tokens"]).astype(np.int64), unpack(row["lens"]).astype(np.int64)
        place = np.arange(len(tokens)) - np.repeat(np.cumsum(lens) - lens, lens)
        some = place >= level - 2
        if train:
            some &= ~np.repeat(unpack(row["held"]).astype(bool), lens)
        some = np.flatnonzero(some)

        def before(k: int) -> np.ndarray:
            """The symbols k places before; the start's place among uniq is 0."""
            return np.where(place[some] >= k, tokens[some - k], 0)

        if level == 2:
            histories, history = uniq, before(1)
        else:
            key = uniq[before(level - 1)]
            for k in range(level - 2, 0, -1):
                key = mix(key, uniq[before(k)])
            histories, history = np.unique(key, return_inverse=True)
        word, both = tokens[some], history.astype(np.int64) * len(uniq) + tokens[some]
        del place, history
        # Like unique with its inverse, in less memory: a block's arrays are what a worker holds at most.
        by = np.argsort(both)
        both = both[by]
        new = np.diff(both, prepend=-1) != 0
        grams, at = both[new], np.empty(len(both), np.int32)
        at[by] = np.cumsum(new, dtype=np.int32) - 1
        del both, by, new
        history, word = grams // len(uniq), grams % len(uniq)
        own = bucket_of(mix(histories, np.zeros(1, np.uint64)), n)
        bucket = np.where(np.isin(histories, hot)[history], bucket_of(mix(histories[history], uniq[word]), n), own[history])
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        return cls(histories, history[order], word[order], bucket[order], some, rank[at])


def _ask_grams(level: int, n: int, hot: np.ndarray, train: Words | None):
    """Messages with a block's distinct grams, by bucket; with ``train`` those of its training tokens, their counts and P of the level below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            g, uniq = _Grams.of(row, level, n, hot, train is not None), unpack_sorted(row["uniq"])
            if train:
                counts = np.bincount(g.at, minlength=len(g.word))
                if level == 2:
                    lower = train.probability(unpack(row["counts"]))[g.word]
                else:
                    lower = np.empty(len(g.word))
                    lower[g.at] = unpack_floats(row["probs"])[g.tokens]
            out = []
            for bucket, s, e in _slices(g.bucket):
                histories, sizes = np.unique(g.history[s:e], return_counts=True)
                more = (pack(counts[s:e]), pack_floats(lower[s:e])) if train else (None, None)
                out.append((bucket, row["block"], pack_sorted(g.histories[histories]), pack(sizes), pack(uniq[g.word[s:e]]), *more))
            yield _rows(ASK_GRAMS, out)

    return run


def _count(often: int, hot: np.ndarray):
    """A bucket's row for the model: grams by history and word, with their counts and what gives the histories' weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "bucket"):
            parts = []
            for r in group:
                parts.append((r["bucket"], np.repeat(unpack_sorted(r["histories"]), unpack(r["sizes"]).astype(np.int64)), unpack(r["words"]), unpack(r["counts"]), unpack_floats(r["lower"])))
            bucket, (h, w, c, lower) = parts[0][0], (np.concatenate([p[k] for p in parts]) for k in range(1, 5))
            del parts
            order = np.lexsort((w, h))
            h, w = h[order], w[order]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])]))
            total, h, w, lower = np.add.reduceat(c[order], new), h[new], w[new], lower[order[new]]
            del order, c
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            known = h[first]
            sums = np.add.reduceat(total, first)
            seen = np.stack([np.add.reduceat((total == k).astype(np.uint64), first) for k in range(1, MOST + 1)])
            covered = np.add.reduceat(lower, first)
            stats = [int((total == k).sum()) for k in range(1, MOST + 2)]
            frequent = np.flatnonzero(np.isin(known, hot))
            nums = np.vstack([sums[None, frequent], seen[:, frequent]]).T.ravel().astype(np.int64).tolist()
            next_often = mix(h, w)[total >= often].view(np.int64).tolist()
            row = (bucket, pack_sorted(known), pack(np.diff(np.append(first, len(h)))), pack(w), pack(total), pack(sums), pack(seen.ravel()), pack_floats(covered))
            yield _rows(COUNTED, [(*row, stats, next_often, known[frequent].view(np.int64).tolist(), nums, covered[frequent].tolist())])

    return run


def _weights(d: np.ndarray):
    """The back-off row of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _each(batches):
            seen = unpack(r["seen"]).reshape(MOST, -1)
            total, weight = backoff(d, unpack(r["totals"]).astype(np.int64), seen, unpack_floats(r["covered"]))
            yield _rows(BACKOFF, [(r["bucket"], r["histories"], pack(total), pack_floats(weight))])

    return run


def _tell_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of the grams that blocks ask about, and their histories' divisors and, where a gram is unseen, weights."""
    for group in _groups(batches, "bucket"):
        h = w = at = total = np.empty(0, np.uint64)
        count, divisor, weight = np.zeros(1, np.uint64), np.ones(1, np.uint64), np.ones(1)
        for r in group:
            if r["kind"] == 0:
                h, sizes, w = unpack_sorted(r["histories"]), unpack(r["sizes"]).astype(np.int64), unpack(r["words"])
                count = np.append(unpack(r["counts"]), np.uint64(0))
                at = np.repeat(np.arange(len(h), dtype=np.uint64), sizes) << np.uint64(36) | w
            elif r["kind"] == 1:
                divisor, weight = np.append(unpack(r["totals"]), np.uint64(1)), np.append(unpack_floats(r["weights"]), 1.0)
            else:
                asked, sizes = unpack_sorted(r["histories"]), unpack(r["sizes"]).astype(np.int64)
                place = _places(h, asked)
                got = count[_places(at, np.repeat(place.astype(np.uint64), sizes) << np.uint64(36) | unpack(r["words"]))]
                unseen = np.add.reduceat(got == 0, np.cumsum(sizes) - sizes, dtype=np.int64) > 0
                yield _rows(TOLD_GRAMS, [(r["bucket"], r["block"], pack(got), pack(divisor[place]), pack_floats(np.where(unseen, weight[place], 0.0)))])


def _climb(level: int, n: int, at: Level, words: Words, out: T.StructType, last: bool):
    """P of the level for each token from P of the level below; the last level's are added up by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "block"):
            row = next(rows)
            g = _Grams.of(row, level, n, at.hot, False)
            tokens, lens, counts = unpack(row["tokens"]).astype(np.int64), unpack(row["lens"]).astype(np.int64), unpack(row["counts"]).astype(np.int64)
            p = words.probability(counts)[tokens] if level == 2 else unpack_floats(row["probs"])
            count, total, weight = np.zeros(len(g.word), np.int64), np.ones(len(g.histories)), np.ones(len(g.histories))
            for (_, s, e), r in zip(_slices(g.bucket), rows, strict=True):
                own = np.unique(g.history[s:e])
                count[s:e], total[own], weight[own] = unpack(r["told_counts"]), unpack(r["totals"]), unpack_floats(r["weights"])
            there = _places(at.hot, g.histories)
            frequent = there < len(at.totals)
            total[frequent], weight[frequent] = at.totals[there[frequent]], at.weights[there[frequent]]
            d = at.discounts[np.minimum(count, MOST + 1)] * count / total[g.history]
            p[g.tokens] = np.where(count[g.at] > 0, d[g.at], weight[g.history][g.at] * p[g.tokens])
            if not last:
                yield _rows(out, [(*(row[c] for c in out.names[:-1]), pack_floats(p))])
                continue
            starts = np.cumsum(lens) - lens
            sums = [np.add.reduceat(x, starts) for x in ((counts > 0).astype(np.int64)[tokens], words.base(counts)[tokens], np.log10(p))]
            cells = [row["ids"], unpack(row["held"]).astype(bool), lens, sums[0], np.full(len(lens), words.tokens), sums[1], sums[2]]
            yield pa.RecordBatch.from_arrays([pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(cells, out, strict=True)], out.names)

    return run


# --- the model


@dataclass(frozen=True)
class Model:
    """A learned model: the folder of its tables, and what of it is small."""

    path: str
    order: int
    buckets: int
    words: Words
    levels: dict[int, Level]

    def table(self, spark: SparkSession, name: str, level: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{name}/level={level}")

    def save(self, spark: SparkSession) -> None:
        w = self.words
        said = {"order": self.order, "buckets": self.buckets, "tokens": w.tokens, "types": w.types, "texts": w.texts, "seen": w.seen, "discounts": {k: x.discounts.tolist() for k, x in self.levels.items()}}
        spark.createDataFrame([(json.dumps(said),)], "said string").coalesce(1).write.parquet(f"{self.path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Model:
        """The model that ``learn`` left in a folder."""
        said = json.loads(spark.read.parquet(f"{path}/model").first()[0])
        words = Words(said["tokens"], said["types"], said["texts"], tuple(said["seen"]))
        levels = {}
        for k, d in said["discounts"].items():
            rows = sorted((r["history"] % (1 << 64), r["total"], r["weight"]) for r in spark.read.parquet(f"{path}/hot/level={k}").collect())  # 2 x buckets of them at most
            levels[int(k)] = Level(np.array(d), *(np.array([r[c] for r in rows], t) for c, t in enumerate((np.uint64, np.uint64, np.float64))))
        return cls(path, said["order"], said["buckets"], words, levels)


def _block_table(docs: DataFrame, id_col: str, text_col: str, hold: Column, tokens: int | None) -> tuple[DataFrame, T.DataType, Spread, int]:
    """(blocks, the id's type, how they are dealt, tokens of a block)."""
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(hold, F.lit(False)).alias("held"), F.col(f"`{text_col}`").alias("text"))
    if tokens is None:
        size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        tokens = max(TOKENS, int((SPOKEN * size / TOKEN_BYTES) ** 0.5))
    ids = own.schema["doc_id"].dataType
    blocks = settle(own.mapInArrow(_blocks(to_arrow_type(ids), tokens), _block_schema(ids)), "blocks")
    return blocks, ids, Spread.of(blocks), tokens


def _coded(blocks: DataFrame, told: DataFrame, ids: T.DataType, spread: Spread) -> DataFrame:
    answers = told.where("block IS NOT NULL").select("block", "bucket", F.col("ids").alias("word_ids"), "counts")
    own = blocks.select("block", F.lit(-1).alias("bucket"), "ids", "held", "lens", "tokens")
    schema = _coded_schema(ids)
    return settle(spread.dealt(_union(own, answers)).mapInArrow(_recode(schema), schema), "coded")


def _learn(docs: DataFrame, order: int, path: str | None, id_col: str, text_col: str, hold: Column, tokens: int | None) -> tuple[Model, DataFrame, T.DataType, Spread]:
    """The model, and the coded blocks of all of docs."""
    if order < 2:
        raise ValueError("a back-off model has an order of 2 at least")
    spark = docs.sparkSession
    path = path or new_path(spark, "katz")
    blocks, ids, spread, tokens = _block_table(docs, id_col, text_col, hold, tokens)
    whole = blocks.agg(F.sum("n_train").alias("tokens"), F.sum("n_texts").alias("texts")).first()
    total, texts = whole["tokens"] or 0, whole["texts"] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // tokens))
    often = max(1, total // (2 * n))

    asked = blocks.select("block", "words", "counts").mapInArrow(_ask_words(n), ASK_WORDS)
    told = settle(_dealt(asked, n).mapInArrow(_tell_words(n, often), TOLD_WORDS), "words")
    own = told.where("block IS NULL")
    own.select("bucket", "words", "ids", "counts").write.parquet(f"{path}/words")
    *seen, types = _sums(own, MOST + 2)
    words = Words(total, types, texts, tuple(seen))
    hot = _often(own, [START])
    coded = carried = _coded(blocks, told, ids, spread)
    discard(blocks, told)

    model = Model(path, order, n, words, {})
    for level in range(2, order + 1):
        if level > 2:
            carried = settle(_scored(carried, model, level - 1, spread, _coded_schema(ids), False), f"level{level - 1}")
        asked = carried.mapInArrow(_ask_grams(level, n, hot, words), ASK_GRAMS)
        grams = f"{path}/grams/level={level}"
        counted = settle(_dealt(asked, n).mapInArrow(_count(often, hot), COUNTED), "counted", grams)
        d = discounts(_sums(counted, MOST + 1))
        counted.select("bucket", "histories", "totals", "seen", "covered").mapInArrow(_weights(d), BACKOFF).write.parquet(f"{path}/backoff/level={level}")
        model.levels[level] = Level(d, *_hot_table(spark, counted, d, f"{path}/hot/level={level}"))
        hot = _often(counted, [])
    model.save(spark)
    return model, coded, ids, spread


def _sums(rows: DataFrame, n: int) -> list[int]:
    """Sums of the numbers in ``stats`` over all buckets."""
    return [x or 0 for x in rows.agg(*[F.sum(F.col("stats")[k]).alias(f"s{k}") for k in range(n)]).first()]


def _often(rows: DataFrame, more: list[int]) -> np.ndarray:
    """The frequent histories of the next level: each has over a 2n-th of all tokens, so there are 2n at most."""
    found = [r[0] for r in rows.select(F.explode("often")).collect()]
    return np.unique(np.array([*found, *more], np.int64).view(np.uint64))


def _hot_table(spark: SparkSession, counted: DataFrame, d: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(histories, divisors, weights) of the frequent histories, added up over the buckets and written to ``path``."""
    each = counted.select(F.posexplode("hot").alias("k", "history"), "hot_counts", "hot_covered")
    sums = [F.sum(F.col("hot_counts")[F.col("k") * (MOST + 1) + j]).alias(f"n{j}") for j in range(MOST + 1)]
    rows = each.groupBy("history").agg(*sums, F.sum(F.col("hot_covered")[F.col("k")]).alias("covered")).collect()  # 2 x buckets of them at most
    rows.sort(key=lambda r: r["history"] % (1 << 64))
    nums = np.array([r[1 : MOST + 2] for r in rows], np.int64).reshape(-1, MOST + 1)
    total, weight = backoff(d, nums[:, 0], nums[:, 1:].T, np.array([r["covered"] for r in rows], np.float64))
    table = [(r["history"], int(t), float(w)) for r, t, w in zip(rows, total, weight, strict=True)]
    spark.createDataFrame(table, "history long, total long, weight double").coalesce(1).write.parquet(path)
    return np.array([r["history"] for r in rows], np.int64).view(np.uint64), total.astype(np.uint64), weight


def _scored(carried: DataFrame, model: Model, level: int, spread: Spread, out: T.StructType, last: bool) -> DataFrame:
    """The blocks with P of ``level`` for each token; the last level's as rows of texts."""
    spark, n, at = carried.sparkSession, model.buckets, model.levels[level]
    grams = model.table(spark, "grams", level).select("bucket", F.lit(0).alias("kind"), "histories", "sizes", "words", "counts")
    weights = model.table(spark, "backoff", level).select("bucket", F.lit(1).alias("kind"), "totals", "weights")
    asked = carried.mapInArrow(_ask_grams(level, n, at.hot, None), ASK_GRAMS).select("bucket", F.lit(2).alias("kind"), "block", "histories", "sizes", "words")
    told = settle(_dealt(_union(_union(asked, grams), weights), n, "kind").mapInArrow(_tell_grams, TOLD_GRAMS), "told")
    rows = spread.dealt(_union(carried.withColumn("bucket", F.lit(-1)), told.withColumnRenamed("counts", "told_counts")))
    return rows.mapInArrow(_climb(level, n, at, model.words, out, last), out)


def _evaluated(coded: DataFrame, model: Model, ids: T.DataType, spread: Spread) -> DataFrame:
    for level in range(2, model.order):
        coded = settle(_scored(coded, model, level, spread, _coded_schema(ids), False), f"level{level}")
    out = T.StructType([T.StructField("doc_id", ids), T.StructField("held_out", T.BooleanType()), *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")], T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    return _scored(coded, model, model.order, spread, out, True)


def learn(docs: DataFrame, order: int = 2, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", tokens: int | None = None) -> Model:
    """A model of all texts of docs, its tables in the folder ``path`` (else in the shared folder, until the driver ends).

    Null texts are like empty ones, repeated rows count each, texts may be of any length, an
    empty table gives a model of which every word is unknown; further columns are ignored.
    ``tokens`` sets the size of blocks and buckets.
    """
    return _learn(docs, order, path, id_col, text_col, F.lit(False), tokens)[0]


def apply(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", hold: Column | None = None, tokens: int | None = None) -> DataFrame:
    """Each row of docs scored by a learned model, with the columns of ``score``; ``hold`` only fills held_out."""
    spark = docs.sparkSession
    blocks, ids, spread, _ = _block_table(docs, id_col, text_col, F.lit(True) if hold is None else hold, tokens)
    n = model.buckets
    known = spark.read.parquet(f"{model.path}/words").withColumn("block", F.lit(None).cast("long"))
    asked = blocks.select("block", "words", "counts").mapInArrow(_ask_words(n), ASK_WORDS)
    told = settle(_dealt(_union(asked, known), n, "block").mapInArrow(_tell_words(n, None), TOLD_WORDS), "words")
    coded = _coded(blocks, told, ids, spread)
    discard(blocks, told)
    return _evaluated(coded, model, ids, spread)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hold: Column | None = None, order: int = 2, tokens: int | None = None) -> DataFrame:
    """Each row's log10 probability under the model learned from the rows that ``hold`` isn't true for.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigrams),
    score. A null text is like an empty one: it has the end alone. Repeated rows count and
    are scored each. With no training rows every word is the unknown one, of probability 1.
    Texts may be of any length: one of more than a block's tokens is a block of its own. An
    empty table gives no rows; further columns are ignored. Words are told apart by 64-bit
    hashes, histories of two words and more as well.
    """
    hold = held_out(F.col(f"`{id_col}`")) if hold is None else hold
    model, coded, ids, spread = _learn(docs, order, None, id_col, text_col, hold, tokens)
    return _evaluated(coded, model, ids, spread)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
