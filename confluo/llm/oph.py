"""Near-duplicates by the Jaccard similarity of word shingles: one-permutation hashing names candidates, exact sets decide."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..plans.shared import discard, settle
from ..plans.sizing import broadcast_if_small
from .minhash import joins
from .simhash import SEED, fingerprint, shingle_hashes

#: 24 bands of four values: a pair of similarity 0.8 meets in none with probability 3e-6.
BANDS, ROWS = 24, 4
BINS = BANDS * ROWS
#: Of a bucket of at most so many sets that two stars haven't joined, the pairs still apart are compared. Larger ones meet by rare shingles.
MOST_PAIRED = 16
#: Shingles in a block of sets that a task compares with another block.
BLOCK_GRAMS = 1 << 20
#: Sets, and shingles of each, that tell which shingles are frequent. They give an order only; under any order the same sets are joined.
COUNTED_SETS, COUNTED_GRAMS = 2_000, 1_000


@cache
def _probes(rounds: int = 4096) -> np.ndarray:
    """[attempt, bin]: where an empty bin looks for a value."""
    return np.random.default_rng(SEED).integers(0, BINS, (rounds, BINS), np.int16)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin of one permutation; ``hashes`` are sorted, at least one.

    The hash is the permutation and its upper half tells the bin. An empty bin takes the
    value of the first bin that isn't, in a random order of its own (optimal
    densification), so two sets agree in each bin with the probability of their similarity.
    """
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    filled, first = np.unique(bins, return_index=True)
    values, has = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    values[filled], has[filled] = hashes[first], True
    empty = np.flatnonzero(~has)
    for probe in _probes():
        if not len(empty):
            return values
        at = probe[empty]
        found = has[at]
        values[empty[found]] = values[at[found]]
        empty = empty[~found]
    values[empty] = hashes[0]
    return values


def bands(hashes: np.ndarray) -> list[int]:
    if not len(hashes):
        return []
    values = signature(hashes)
    return [xxhash.xxh64_intdigest(values[k * ROWS : (k + 1) * ROWS].tobytes(), k) for k in range(BANDS)]


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, counts, found = [], [], []
            for t in b.column("text"):
                hashes = np.unique(shingle_hashes(t.as_py(), size))
                keys.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                counts.append(len(hashes))
                found.append(np.array(bands(hashes), np.uint64).view(np.int64))
            columns = [b.column("doc_id"), b.column("h"), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h", "key", "n", "bands"])

    return run


def bitmap(hashes: np.ndarray) -> bytes:
    """A bit for each remainder of the hashes, set if it occurs an odd number of times; 2 to 4 bits for a hash, 256 at least."""
    bits = 1 << max(8, (2 * len(hashes) - 1).bit_length())
    return np.packbits(np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def at_most_common(x: bytes, nx: int, y: bytes, ny: int) -> int:
    """A bound on what sets of such bitmaps have in common: where these differ, the sets do."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return (nx + ny - int(np.bitwise_count(x ^ y).sum())) // 2


def _grams(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), size)) for t in b.column("text")]
            keys = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
            columns = [pa.array(keys, pa.binary()), pa.array([len(x) for x in sets], pa.int64()), pa.array([bitmap(x) for x in sets], pa.binary()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n", "bits", "grams"])

    return run


def _possible(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, nx, y, ny in zip(*(b.column(c).to_pylist() for c in ("x", "nx", "y", "ny")), strict=True):
                both = at_most_common(x, nx, y, ny)
                keep.append(100 * both >= percent * (nx + ny - both))
            yield b.select(["a", "b", "pa", "pb"]).filter(pa.array(keep, pa.bool_()))

    return run


def _alike(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b", "pa", "pb"]).filter(pa.array(keep, pa.bool_()))

    return run


def _first(percent: int, often: dict[int, int]):
    """The shingles of each set of which any two alike sets share one at least: all but the share they may lack, the rarest first."""
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
                found.append(x[np.lexsort((x, n))[: len(x) - -(-percent * len(x) // 100) + 1]])
            which = pa.array(np.repeat(np.arange(b.num_rows), [len(x) for x in found]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *found])), *(b.column(c).take(which) for c in ("key", "n", "part"))], ["gram", "key", "n", "part"])

    return run


def _sides(cell: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parts, left, right) of two blocks of sets: two of one size class (across 0), or one of this class and one of the class below."""
    parts = cell.column("part").combine_chunks().dictionary_encode().indices.to_numpy()
    across, own, lo, hi, cls, c = (cell.column(x).to_numpy() for x in ("across", "own", "lo", "hi", "cls", "c"))
    return parts, np.where(across == 0, own == lo, cls == c), np.where(across == 0, own == hi, cls < c)


def _active(percent: int):
    """The sets of two blocks that may be alike to one of another part, by their bitmaps."""

    def run(cell: pa.Table) -> pa.Table:
        parts, left, right = _sides(cell)
        maps = [np.frombuffer(x, np.uint64) for x in cell.column("bits").to_pylist()]
        least = min(map(len, maps))
        for k, x in enumerate(maps):
            while len(x) > least:
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            maps[k] = x
        maps, n, keep = np.stack(maps), cell.column("n").to_numpy(), np.zeros(len(maps), bool)
        others = np.flatnonzero(right)
        for k in np.flatnonzero(left):
            near = others[parts[others] != parts[k]]
            both = (n[near] + n[k] - np.bitwise_count(maps[near] ^ maps[k]).sum(axis=1, dtype=np.int64)) // 2
            near = near[100 * both >= percent * (n[near] + n[k] - both)]
            keep[near] = True
            keep[k] |= len(near) > 0
        return cell.select(CELL).filter(pa.array(keep))

    return run


#: What tells a set's place in the cells of ``_rest``.
CELL = ["gram", "c", "across", "lo", "hi", "own", "cls", "key", "part"]


def _cell(percent: int):
    """Links of two blocks of sets."""

    def run(cell: pa.Table) -> pa.Table:
        parts, left, right = _sides(cell)
        links = joins([x.values.to_numpy() for x in cell.column("grams")], parts, left, right, percent / 100)
        rows = [pa.array([i for i, _ in links], pa.int64()), pa.array([j for _, j in links], pa.int64())]
        return pa.table({"pa": cell.column("part").take(rows[0]), "pb": cell.column("part").take(rows[1])})

    return run


class _Parts:
    """Which sets are joined so far: (key, part) of every set that met another one."""

    def __init__(self, met: DataFrame):
        self.table = settle(met.select("key", F.col("key").alias("part")).distinct(), "parts")

    def join(self, links: DataFrame) -> None:
        """Unite the parts at the ends of ``links`` (pa, pb)."""
        found = connected_components(links.select("pa", "pb"), "pa", "pb").select(F.struct(F.col("node").alias("part")).alias("k"), "component")
        named = self.table.select("key", F.struct("part").alias("k")).join(found, "k", "left").select("key", F.coalesce("component", "k.part").alias("part"))
        old, self.table = self.table, settle(named, "parts")
        discard(old)

    def name(self, rows: DataFrame) -> DataFrame:
        """rows (key, ...) with ``part``. A struct as key has both sides exchanged for this join alone, so a hot one can be split."""
        return rows.withColumn("k", F.struct("key")).join(self.table.select(F.struct("key").alias("k"), "part"), "k").drop("k")


def _near(x: Column | str, y: Column | str, percent: int) -> Column:
    """Sets of such sizes can be alike."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, pa, pb) whose sets are alike."""
    way = F.col("a") < F.col("b")
    ends = [F.when(way, F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (("a", "b", "a"), ("b", "a", "b"), ("pa", "pb", "pa"), ("pb", "pa", "pb"))]
    kind = "a binary, b binary, pa binary, pb binary"

    def both(pairs: DataFrame, **given: str) -> DataFrame:
        ends = settle(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "ends")
        some = sets.join(broadcast_if_small(ends), "key", "left_semi")
        for end, suffix in (("a", "x"), ("b", "y")):
            side = some.select(F.struct(F.col("key").alias(end)).alias("k"), *[F.col(c).alias(f"{p}{suffix}") for c, p in given.items()])
            pairs = pairs.withColumn("k", F.struct(end)).join(side, "k").drop("k")
        return pairs

    # Bitmaps, a few dozen bytes for a set of a hundred, tell most pairs that aren't alike; the sets of the others are sent.
    once = settle(pairs.where("a <> b").select(*ends).distinct(), "pairs")
    likely = settle(both(once, bits="", n="n").select("a", "b", "pa", "pb", "x", "nx", "y", "ny").mapInArrow(_possible(percent), kind), "likely")
    discard(once)
    links = settle(both(likely, grams="").select("a", "b", "pa", "pb", "x", "y").mapInArrow(_alike(percent), kind), "links")
    discard(likely)
    return links


def _apart(crowd: DataFrame, by: str) -> DataFrame:
    """crowd without the groups whose sets are all joined."""
    ends = crowd.groupBy(by).agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select(F.struct(by).alias("k"))
    return crowd.withColumn("k", F.struct(by)).join(ends, "k", "left_semi").drop("k")


def _cross(small: DataFrame, by: str, percent: int) -> DataFrame:
    """(a, b, pa, pb): the pairs of each group that aren't joined."""
    each = small.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("key", "n", "part"))).alias("rows"))
    pairs = each.select(F.explode("rows").alias("x"), "rows").select("x", F.explode("rows").alias("y")).where(F.col("x.key") < F.col("y.key"))
    return pairs.where((F.col("x.part") != F.col("y.part")) & _near("x.n", "y.n", percent)).select(F.col("x.key").alias("a"), F.col("y.key").alias("b"), F.col("x.part").alias("pa"), F.col("y.part").alias("pb"))


def _rest(still: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(pa, pb): links that join what all alike pairs of ``still`` (key, n, part) would.

    Any two alike sets share one of the rarest of their shingles (see ``_first``) and lie in
    the same class of sizes or in neighbouring ones. Few that meet there are compared pair
    by pair; of many, blocks of a bounded number of shingles meet in separate tasks.
    """
    members = settle(sets.select("key", "bits", "grams").join(broadcast_if_small(still.select("key", "n", "part")), "key").select("key", "n", "part", "bits", "grams"), "members")
    drawn = members.select(F.xxhash64("key").alias("h"), "key", F.slice("grams", 1, COUNTED_GRAMS).alias("grams")).orderBy("h", "key").limit(COUNTED_SETS)
    often: Counter[int] = Counter()
    for x in drawn.select("grams").toArrow().column(0):
        often.update(x.values.to_numpy().tolist())
    often = {g: n for g, n in often.items() if n > 1}

    firsts = settle(members.select("key", "n", "part", "grams").mapInArrow(_first(percent, often), "gram long, key binary, n long, part binary"), "firsts")
    ends = F.min("part").alias("lo"), F.max("part").alias("hi"), F.bit_xor(F.xxhash64("key")).alias("h"), F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("i")
    shared = firsts.groupBy("gram").agg(F.count(F.lit(1)).alias("size"), *ends).where("lo <> hi")
    # Where the same sets meet by several shingles, one is enough.
    shared = shared.groupBy("size", "h", "i").agg(F.min("gram").alias("gram")).select(F.struct("gram").alias("k"), "size")
    cls = F.floor(F.log(F.col("n").cast("double")) / log(100 / percent) + 1e-9).cast("long")
    met = settle(firsts.withColumn("k", F.struct("gram")).join(shared, "k").select("gram", "size", "key", "n", "part", cls.alias("cls")), "rare")
    discard(firsts)
    few = _verified(_cross(met.where(f"size <= {MOST_PAIRED}"), "gram", percent), sets, percent).select("pa", "pb")

    many = met.where(f"size > {MOST_PAIRED}")
    counts = many.groupBy("gram", "cls").agg(F.ceil(F.sum("n") / BLOCK_GRAMS).alias("blocks")).groupBy("gram")
    blocks = counts.agg(F.map_from_entries(F.collect_list(F.struct("cls", "blocks"))).alias("blocks")).select(F.struct("gram").alias("k"), "blocks")
    own = many.withColumn("k", F.struct("gram")).join(blocks, "k").drop("k").withColumn("own", F.pmod(F.xxhash64("key"), F.expr("blocks[cls]")))
    cells = F.expr(
        "concat(transform(sequence(0L, blocks[cls] - 1), o -> struct(cls AS c, 0 AS across, least(own, o) AS lo, greatest(own, o) AS hi)),"
        " if(blocks[cls - 1] IS NULL, array(), transform(sequence(0L, blocks[cls - 1] - 1), o -> struct(cls AS c, 1 AS across, own AS lo, o AS hi))),"
        " if(blocks[cls + 1] IS NULL, array(), transform(sequence(0L, blocks[cls + 1] - 1), o -> struct(cls + 1 AS c, 1 AS across, o AS lo, own AS hi))))"
    )
    dealt, at = own.select("gram", "own", "cls", "key", "part", F.inline(cells)), ["gram", "c", "across", "lo", "hi"]
    mapped = dealt.join(broadcast_if_small(members.select("key", "n", "bits")), "key").groupBy(*at)
    active = settle(mapped.applyInArrow(_active(percent), "gram long, c long, across int, lo long, hi long, own long, cls long, key binary, part binary"), "active")
    filled = active.withColumn("k", F.struct("key")).join(members.select(F.struct("key").alias("k"), "grams"), "k").drop("k")
    crossed = filled.groupBy(*at).applyInArrow(_cell(percent), "pa binary, pb binary")
    return settle(few.unionByName(crossed).distinct(), "late")


def _classes(own: DataFrame, sketched: DataFrame, size: int, percent: int) -> DataFrame:
    """(key, part) of every set that met another one: part is the same for those that are joined."""
    nodes = sketched.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("h").alias("h"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    rows = settle(nodes.select("key", "h", "n", F.explode("bands").alias("band")), "bands")
    drawn = F.struct(F.xxhash64("key", "band").alias("h"), "key", "n")
    buckets = rows.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min(drawn).alias("centre")).where("size > 1")
    buckets = buckets.select(F.struct("band").alias("k"), "size", F.col("centre.key").alias("centre"), F.col("centre.n").alias("centre_n"))
    met = settle(rows.withColumn("k", F.struct("band")).join(buckets, "k").drop("k"), "buckets")
    discard(rows)
    wanted = broadcast_if_small(settle(met.select("h").distinct(), "wanted"))
    sets = settle(own.join(wanted, "h", "left_semi").mapInArrow(_grams(size), "key binary, n long, bits binary, grams array<long>").where(F.col("key").isNotNull()).dropDuplicates(["key"]), "grams")

    # The first star of each bucket: every set with one drawn at random.
    parts = _Parts(met)
    star = met.where(_near("n", "centre_n", percent)).select(F.col("key").alias("a"), F.col("centre").alias("b"), F.col("key").alias("pa"), F.col("centre").alias("pb"))
    links = _verified(star, sets, percent)
    parts.join(links)

    # The second one, where sets are still apart: its centre is the set with the most links, which copies of one text have to it.
    apart = settle(_apart(parts.name(met.select("band", "size", "key", "n", "centre")), "band"), "apart")
    degree = links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("degree"))
    ranked = apart.join(degree, "key", "left").groupBy("band").agg(F.max(F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), "key", "n", "part")).alias("hub"))
    ranked = ranked.select(F.struct("band").alias("k"), "hub")
    star = apart.withColumn("k", F.struct("band")).join(ranked, "k").where((F.col("part") != F.col("hub.part")) & (F.col("hub.key") != F.col("centre")) & _near("n", "hub.n", percent))
    links = _verified(star.select(F.col("key").alias("a"), F.col("hub.key").alias("b"), F.col("part").alias("pa"), F.col("hub.part").alias("pb")), sets, percent)
    parts.join(links)

    # What is apart after two stars, exactly.
    left = settle(_apart(parts.name(apart.drop("part")), "band"), "left")
    discard(apart)
    small = _verified(_cross(left.where(f"size <= {MOST_PAIRED}"), "band", percent), sets, percent)
    parts.join(small)
    large = left.where(f"size > {MOST_PAIRED}")
    if large.limit(1).count():
        still = settle(_apart(parts.name(large.drop("part")), "band").select("key", "n", "part").distinct(), "still")
        if still.limit(1).count():
            parts.join(_rest(still, sets, percent))
    discard(met, left, sets)
    return parts.table


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs.

    A text's set has its distinct shingles of ``size`` words (A-Z lower-cased; all words as
    one shingle if there are fewer). Sets are linked if ``percent`` of a hundred of what
    either holds is in both. component_id: the smallest id reachable over links; kept: that
    is the row's own.

    Null and empty texts have an empty set and are linked with nothing. Null ids are passed
    over: component_id is null, and the rows kept, if the component has no other. Repeated
    rows each give a row; those of the smallest id are all kept. Texts may be of any length.
    An empty table gives no rows; further columns are ignored, whatever their names.

    Equal sets are one node. Those that agree in a band of the signature meet in a bucket,
    where candidate edges form a star: each set with one centre, then, where that leaves sets
    apart, with the one of the most links. So there are no more edges than places in buckets. Sets of
    a bucket that both stars leave apart are compared with each other, by rare shingles if
    they are many (see ``_rest``), so what all pairs of a bucket would join is joined.
    """
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"), F.col(f"`{text_col}`").alias("text"))
    ids = own.schema["doc_id"].dataType.simpleString()
    sketched = settle(own.mapInArrow(_sketch(size), f"doc_id {ids}, h long, key binary, n long, bands array<long>"), "sketches")
    parts = _classes(own.select("h", "text"), sketched, size, percent)
    rows = sketched.select("doc_id", "n", F.struct("key").alias("k"))
    least = sketched.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("least"))
    led = least.join(parts, "key", "left").select("key", "least", F.coalesce("part", "key").alias("part"))
    roots = led.groupBy("part").agg(F.min("least").alias("component_id"))
    named = led.join(roots, "part").select(F.struct("key").alias("k"), "component_id")
    # A struct as key has both sides exchanged for this join alone, so the rows of a text with many copies can be split.
    found = rows.join(named, "k", "left")
    component = F.when(F.col("k.key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        marks = np.array([fingerprint(shingle_hashes(t.as_py())) for t in b.column("text")], np.uint64)
        yield pa.RecordBatch.from_arrays([b.column("h"), pa.array(marks.view(np.int64))], ["h", "mark"])


def similar(docs: DataFrame, percent: int = 80, size: int = 5, text_col: str = "text") -> DataFrame:
    """(a, b): fingerprints (see ``simhash``) that join the texts which ``near_duplicates`` would, for shingles of ``size`` words.

    The links of a class are a star. Texts without a word have no link, null ones neither. An empty table gives no rows.
    """
    own = docs.select(F.xxhash64(F.col(f"`{text_col}`")).alias("h"), F.col(f"`{text_col}`").alias("text"))
    sketched = settle(own.select(F.lit(None).cast("long").alias("doc_id"), "h", "text").mapInArrow(_sketch(size), "doc_id long, h long, key binary, n long, bands array<long>"), "sketches")
    parts = _classes(own, sketched, size, percent)
    texts = sketched.where(F.col("key").isNotNull()).groupBy("h").agg(F.first("key").alias("key")).join(parts, "key", "left").select("h", F.coalesce("part", "key").alias("part"))
    ends = texts.groupBy("part").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select(F.struct("part").alias("k"))
    joined = settle(texts.withColumn("k", F.struct("part")).join(ends, "k", "left_semi").drop("k"), "joined")
    discard(sketched)
    marked = own.join(broadcast_if_small(joined.select("h")), "h", "left_semi").mapInArrow(_marks, "h long, mark long").dropDuplicates(["h"])
    named = settle(marked.join(joined, "h").select("mark", "part").distinct(), "marks")
    least = named.groupBy("part").agg(F.min("mark").alias("b")).select(F.struct("part").alias("k"), "b")
    return named.withColumn("k", F.struct("part")).join(least, "k").where("mark <> b").select(F.col("mark").alias("a"), "b").distinct()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
with recursive d as (
  select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), t as (
  select min(rid) as tid, w from d where len(w) > 0 group by w
), s as (
  select distinct tid, gram from (select tid, array_to_string(w[i : i + 3], ' ') as gram from (select *, unnest(generate_series(1, greatest(len(w) - 3, 1))) as i from t))
), n as (
  select tid, count(*) as n from s group by 1
), p as (
  select a.tid as x, b.tid as y, count(*) as common from s a join s b using (gram) where a.tid < b.tid group by 1, 2
), e as (
  select x, y from p join n nx on nx.tid = x join n ny on ny.tid = y where 100 * common >= 80 * (nx.n + ny.n - common)
), l as (
  select x, y from e union all select y, x from e
), r as (
  select tid as x, tid as y from t union select r.x, l.y from r join l on r.y = l.x
), c as (
  select r.x as tid, min(doc_id) as component_id from r join t on t.tid = r.y join d on d.w = t.w group by 1
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, case when len(d.w) = 0 then doc_id else component_id end as component_id,
  doc_id is not distinct from (case when len(d.w) = 0 then doc_id else component_id end) as kept
from d left join t on t.w = d.w left join n using (tid) left join c using (tid)
"""
