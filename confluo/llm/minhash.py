"""Links between texts by the Jaccard similarity of their word shingles: MinHash bands name candidates, exact sets decide."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..plans.shared import settle
from ..plans.sizing import broadcast_if_small
from .simhash import SEED, fingerprint, shingle_hashes

#: Bands of four values each: a pair of similarity 0.8 meets in one of 16 with probability 0.9998.
BANDS, ROWS = 16, 4
#: Of at most so many texts that meet, all pairs are listed. Those of a larger bucket are compared with two of them, which joins
#: most, and ``_rest`` finds what is still to be joined.
MOST_PAIRED = 16
#: Where more texts meet by a rare shingle, a task compares so many with so many.
BLOCK = 256
#: Texts, and shingles of each, that tell which shingles are frequent. They give an order only; under any order the same texts are joined.
COUNTED_TEXTS, COUNTED_GRAMS = 2_000, 1_000
_DRAWN = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64)
_XOR, _TIMES = _DRAWN[0], _DRAWN[1] * np.uint64(2) + np.uint64(1)


def key_of(text: str | None) -> int:
    """Equal for texts of equal words, A-Z lower-cased."""
    return xxhash.xxh64_intdigest(b" ".join((text or "").encode().lower().split()), SEED)


def bands(hashes: np.ndarray) -> list[int]:
    if not len(hashes):
        return []
    least = np.array([((hashes ^ x) * t).min() for x, t in zip(_XOR, _TIMES, strict=True)], np.uint64)
    return [xxhash.xxh64_intdigest(least[k * ROWS : (k + 1) * ROWS].tobytes(), k) for k in range(BANDS)]


def _long(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py() for t in b.column(1)]
            found = [_long(bands(np.unique(shingle_hashes(t, size)))).tolist() for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_long([key_of(t) for t in texts])), pa.array(found, pa.list_(pa.int64()))], ["id", "key", "bands"])

    return run


def _grams(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py() for t in b.column(0)]
            marks, keys = (pa.array(_long(x)) for x in ([fingerprint(shingle_hashes(t)) for t in texts], [key_of(t) for t in texts]))
            sets = [np.unique(shingle_hashes(t, size)).view(np.int64) for t in texts]
            yield pa.RecordBatch.from_arrays([keys, marks, pa.array(sets, pa.list_(pa.int64()))], ["key", "mark", "grams"])

    return run


def _alike(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= least * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _first(least: float, often: dict[int, int]):
    """The shingles of each set of which one at least is common to any two sets of similarity ``least``, the rarest first.

    Of x, ``least * |x|`` are common at least. So the first of the common ones, in any order
    of shingles, comes before all but so many less one in x, and likewise in the other set.
    """
    known = np.array(sorted(often), np.int64)
    counts = np.array([often[g] for g in known.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for x in b.column("grams"):
                x = x.values.to_numpy()
                n = np.zeros(len(x), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
                    n = np.where(known[at] == x, counts[at], 0)
                found.append(x[np.lexsort((x, n))[: len(x) - ceil(least * len(x) - 1e-9) + 1]])
            which = pa.array(np.repeat(np.arange(b.num_rows), [len(x) for x in found]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *found])), *(b.column(c).take(which) for c in ("key", "part"))], ["gram", "key", "part"])

    return run


def joins(sets: list[np.ndarray], parts: np.ndarray, left: np.ndarray, right: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Places of alike sets, one of ``left`` and one of ``right`` each, that join the parts that all such pairs would."""
    sizes, parts, links = np.array([len(x) for x in sets]), parts.copy(), []
    which = np.repeat(np.arange(len(sets)), sizes)
    _, grams, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    ends = np.cumsum(sizes)
    common = counts[grams] > 1
    there, of = grams[common], which[common]
    own = np.zeros(len(counts), bool)
    for k in np.flatnonzero(left):
        others = right & (parts != parts[k])
        if not others.any():
            continue
        mine = grams[ends[k] - sizes[k] : ends[k]]
        own[mine] = True
        both = np.bincount(of[own[there]], minlength=len(sets))
        own[mine] = False
        alike = np.flatnonzero(others & (both >= least * (sizes[k] + sizes - both)))
        met, at = np.unique(parts[alike], return_index=True)
        links += [(int(k), int(alike[j])) for j in at]
        parts[np.isin(parts, met)] = parts[k]
    return links


def _blocks(least: float):
    def run(cell: pa.Table) -> pa.Table:
        sets = [x.values.to_numpy() for x in cell.column("grams")]
        parts, marks, own, lo, hi = (cell.column(c).to_numpy() for c in ("part", "mark", "own", "lo", "hi"))
        links = joins(sets, parts, own == lo, own == hi, least)
        return pa.table({"a": pa.array([marks[i] for i, _ in links], pa.int64()), "b": pa.array([marks[j] for _, j in links], pa.int64())})

    return run


def _paired(small: DataFrame, by: str, *more: str) -> DataFrame:
    """(a, b): all pairs of keys that meet, either way."""
    row = F.struct("key", *more)
    each = small.groupBy(by).agg(F.collect_list(row).alias("rows"))
    return each.select(F.explode("rows").alias("x"), "rows").select("x", F.explode("rows").alias("y"))


def _alike_pairs(either: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b): fingerprints of those pairs of keys whose sets are alike."""
    either = either.where("a <> b")
    pairs = settle(either.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")

    def side(k: str, grams: str, mark: str) -> DataFrame:
        return sets.select(F.struct(F.col("key").alias(k)).alias("k"), F.col("grams").alias(grams), F.col("mark").alias(mark))

    one = pairs.withColumn("k", F.struct("a")).join(side("a", "x", "ma"), "k").drop("k")
    two = one.withColumn("k", F.struct("b")).join(side("b", "y", "mb"), "k")
    joined = two.select(F.col("ma").alias("a"), F.col("mb").alias("b"), "x", "y")
    return joined.mapInArrow(_alike(least), "a long, b long").where("a <> b").distinct()


def _rest(large: DataFrame, links: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b): links that with ``links`` join what all alike pairs of texts in large buckets would.

    Texts that are joined need no further link, so a bucket whose texts all are is done. The
    texts of the others meet again by the rarest of their shingles (see ``_first``), where
    all that aren't joined are compared, many of them block by block in separate tasks.
    """
    joined = connected_components(links).select(F.struct(F.col("node").alias("mark")).alias("k"), "component")
    named = sets.select("key", F.struct("mark").alias("k")).join(joined, "k", "left").select(F.struct("key").alias("k"), F.coalesce("component", "k.mark").alias("part"))
    crowd = settle(large.select("band", F.struct("key").alias("k")).join(named, "k").select("band", "k.key", "part"), "crowd")
    apart = crowd.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select(F.struct("band").alias("k"))
    still = crowd.withColumn("k", F.struct("band")).join(apart, "k", "left_semi").select("key", "part").distinct()
    members = settle(sets.join(still, "key").select("key", "mark", "part", "grams"), "members")
    drawn = members.select(F.xxhash64("key").alias("h"), "key", F.slice("grams", 1, COUNTED_GRAMS).alias("grams")).orderBy("h", "key").limit(COUNTED_TEXTS)
    often: Counter[int] = Counter()
    for x in drawn.select("grams").toArrow().column(0):
        often.update(x.values.to_numpy().tolist())
    often = {g: n for g, n in often.items() if n > 1}

    firsts = settle(members.mapInArrow(_first(least, often), "gram long, key long, part long"), "firsts")
    ends = F.min("part").alias("lo"), F.max("part").alias("hi"), F.bit_xor(F.xxhash64("key")).alias("h"), F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("i")
    shared = firsts.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), *ends).where("lo <> hi")
    # Where the same texts meet by several shingles, one is enough.
    shared = shared.groupBy("n", "h", "i").agg(F.min("gram").alias("gram")).select(F.struct("gram").alias("k"), "n")
    met = settle(firsts.withColumn("k", F.struct("gram")).join(shared, "k").select("gram", "n", "key", "part"), "rare")

    few = _paired(met.where(F.col("n") <= MOST_PAIRED), "gram", "part").where("x.part <> y.part")
    found = _alike_pairs(few.select(F.col("x.key").alias("a"), F.col("y.key").alias("b")), members, least)
    count = F.ceil(F.col("n") / BLOCK)
    own = met.where(F.col("n") > MOST_PAIRED).select("gram", "key", F.pmod(F.xxhash64("key"), count).alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("other"))
    cells = own.select("gram", F.struct("key").alias("k"), "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    filled = cells.join(members.select(F.struct("key").alias("k"), "mark", "part", "grams"), "k").drop("k")
    return found.unionByName(filled.groupBy("gram", "lo", "hi").applyInArrow(_blocks(least), "a long, b long")).distinct()


def similar(docs: DataFrame, least: float = 0.8, size: int = 5, text_col: str = "text") -> DataFrame:
    """(a, b): fingerprints (see ``simhash``) of texts whose sets of ``size``-word shingles have a Jaccard similarity of ``least`` or more.

    The links join what all such pairs that meet in a band would; of many texts that are all
    alike, not every pair is listed. Texts of equal words are one, whatever their rows' ids.
    Texts without a word have no shingle and no link; null ones neither. An empty table gives no rows.
    """
    text = F.col(f"`{text_col}`")
    own = docs.select(F.xxhash64(text).alias("id"), text.alias("text"))
    sketched = settle(own.mapInArrow(_sketch(size), "id long, key long, bands array<long>"), "sketches")
    nodes = sketched.groupBy("key").agg(F.min("id").alias("id"), F.first("bands").alias("bands"))
    rows = settle(nodes.select("key", "id", F.explode("bands").alias("band")), "bands")
    drawn = F.struct(F.xxhash64("key", "band").alias("h"), "key")
    buckets = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min(drawn).alias("lo"), F.max(drawn).alias("hi")).where("n > 1")
    buckets = buckets.select(F.struct("band").alias("k"), "n", F.col("lo.key").alias("lo"), F.col("hi.key").alias("hi"))
    # A struct as key has both sides exchanged for this join alone, so adaptive execution can split a hot band.
    met = settle(rows.withColumn("k", F.struct("band")).join(buckets, "k").select("band", "key", "id", "n", "lo", "hi"), "buckets")
    large = met.where(F.col("n") > MOST_PAIRED)
    paired = _paired(met.where(F.col("n") <= MOST_PAIRED), "band").select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))
    hubs = large.select("key", F.explode(F.array("lo", "hi")).alias("hub"))
    either = paired.unionByName(hubs.select(F.col("key").alias("a"), F.col("hub").alias("b")))

    wanted = broadcast_if_small(met.select("id").distinct())
    texts = own.join(wanted, "id", "left_semi").select("text").mapInArrow(_grams(size), "key long, mark long, grams array<long>")
    sets = settle(texts.dropDuplicates(["key"]), "grams")
    links = _alike_pairs(either, sets, least)
    if not large.limit(1).count():
        return links
    links = settle(links, "links")
    return links.unionByName(_rest(large, links, sets, least)).distinct()
