"""Benchmark decontamination with DataFrame functions only.

The 64-bit hashes of the benchmark's n-grams are broadcast as a hash set, in blocks of a
fixed size, mostly one. Every window of every document is hashed and looked up where the row
lies, so what is shuffled of the corpus is its hits, however large the benchmark is. A hit is
verified by a join with the n-gram's text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.shared import columns_but, settle
from ..plans.sizing import broadcast_if_small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What lies between words, after lower-casing; and words themselves in either case.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Hashes that are broadcast at a time, 8 bytes each. A benchmark with more takes a pass over the texts for each block.
BLOCK_HASHES = 2_000_000


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words; null text has none."""
    ascii_low = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.filter(F.split(F.coalesce(ascii_low, F.lit("")), GAP), lambda w: w != "")


def benchmark_windows(benchmark: DataFrame, n: int = 8, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(len, gram, items): the distinct windows of n words (all words of a shorter item), each with its items' ids as sorted strings.

    Items without words have no window; null ids are left out of ``items``.
    """
    own = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    own = own.withColumn("len", F.least(F.size("w"), F.lit(n)))
    grams = own.select("item", "len", F.explode(F.expr("transform(sequence(1, size(w) - len + 1), i -> array_join(slice(w, i, len), ' '))")).alias("gram"))
    return grams.groupBy("len", "gram").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _text_key(text: Column) -> Column:
    """Equal for equal texts alone; hits are found for each text once, by this key."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _hits(docs: DataFrame, windows: DataFrame, block_hashes: int, with_rows: bool) -> DataFrame:
    """The windows of docs (doc_id, text) whose hash is one of the n-grams': (doc_id, key, n_words, s, len, gram).

    ``with_rows`` adds a row for every row of docs, whose ``len`` is 0. Windows are rows only
    within the stage that scans the texts; those without a match go before anything is written.
    """
    hashed = settle(windows.select(F.xxhash64(F.split("gram", " ")).alias("hash"), "len").distinct(), "hashes")
    lens = sorted(r["len"] for r in hashed.select("len").distinct().collect())  # n values at most
    blocks = max(1, -(-hashed.count() // block_hashes))
    worded = docs.select("doc_id", _text_key(F.col("text")).alias("key"), words_of(F.col("text")).alias("w")).withColumn("n_words", F.size("w").cast("long"))
    each = [f"transform(if(size(w) >= {n}, sequence(1, size(w) - {n} + 1), cast(array() as array<int>)), i -> xxhash64(slice(w, i, {n})))" for n in lens]
    # A window's place among the hashes tells where it starts and how long it is; that is worked out for the few that match.
    start, length = ("case" + "".join(f" when at < {' + '.join(f'greatest(n_words - {m} + 1, 0)' for m in lens[: k + 1])} then {out(k, n)}" for k, n in enumerate(lens)) + " end" if lens else "0" for out in (
        lambda k, n: " - ".join(["at", *(f"greatest(n_words - {m} + 1, 0)" for m in lens[:k])]), lambda k, n: str(n)))
    passes = []
    for k in range(blocks):
        rows = with_rows and k == 0
        listed = ["array(cast(null as bigint))"] * rows + each
        if not listed:
            continue
        one = worded.select("doc_id", "key", "w", "n_words", F.posexplode(F.expr(f"concat({', '.join(listed)})")).alias("pos", "hash"))
        # At most this block's share of block_hashes rows, by the count above.
        block = F.broadcast(hashed.where(F.pmod(F.col("hash"), F.lit(blocks)) == k).select(F.col("hash").alias("known")).distinct())
        met = one.join(block, F.col("hash") == F.col("known"), "left" if rows else "inner").withColumn("at", F.col("pos") - int(rows))
        met = met.where("known IS NOT NULL OR at < 0") if rows else met
        placed = met.select("doc_id", "key", "n_words", "w", F.expr(f"cast(if(at < 0, 0, {start}) as int)").alias("s"), F.expr(f"cast(if(at < 0, 0, {length}) as int)").alias("len"))
        passes.append(placed.select("doc_id", "key", "n_words", "s", "len", F.expr("if(len > 0, array_join(slice(w, s + 1, len), ' '), '')").alias("gram")))
    if not passes:
        return worded.select("doc_id", "key", "n_words", F.lit(0).alias("s"), F.lit(0).alias("len"), F.lit("").alias("gram")).limit(0)
    return settle(reduce(DataFrame.unionByName, passes), "hits")


def _verified(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, s, len, items) of the hits whose text is the n-gram's; copies of a text give them once."""
    own = hits.where("len > 0").select("key", "s", "len", "gram").distinct().withColumn("k", F.struct("len", "gram"))
    known = broadcast_if_small(windows.select(F.struct("len", "gram").alias("k"), "items"))
    return own.join(known, "k").select("key", "s", "len", "items")


def _spans(verified: DataFrame) -> DataFrame:
    """(key, n_hit, spans): the hit words of each text, merged where they touch, in one ordered pass over its hits."""
    before = Window.partitionBy("key").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("key").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, 0)
    placed = verified.select("key", "s", (F.col("s") + F.col("len")).alias("e")).withColumn("reach", F.max("e").over(before))
    runs = placed.withColumn("run", F.sum(F.when(F.col("s") <= F.col("reach"), 0).otherwise(1)).over(upto)).groupBy("key", "run").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    return runs.groupBy("key").agg(F.sum(F.col("e") - F.col("s")).cast("long").alias("n_hit"), F.array_sort(F.collect_list(F.struct("s", "e"))).alias("spans"))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 8, id_col: str = "doc_id", text_col: str = "text", min_items: int = 2, block_hashes: int = BLOCK_HASHES) -> DataFrame:
    """For each row of docs: doc_id, n_words, n_hit, spans, n_items, items, contaminated.

    A document word inside any occurrence of a benchmark window (see
    ``benchmark_windows``) is hit; spans are the merged hit words as (s, e). items: the
    sorted ids of the items with an occurring window; contaminated: ``min_items`` of them
    at least. Null and empty texts have no words and are clean; repeated rows and ids are
    judged row by row, equal texts alike; texts may be of any length; empty tables work on
    either side; further columns are ignored.
    """
    windows = settle(benchmark_windows(benchmark, n, text_col="text"), "windows")
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    hits = _hits(own, windows, block_hashes, with_rows=True)
    verified = settle(_verified(hits, windows), "verified")
    items = verified.groupBy("key").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    told = broadcast_if_small(_spans(verified).join(items, "key").select(F.struct("key").alias("k"), "n_hit", "spans", "items"))
    # A struct as key has both sides exchanged for this join alone, so adaptive execution can split the rows of a text with many copies.
    rows = hits.where("len = 0").select("doc_id", "n_words", F.struct("key").alias("k")).join(told, "k", "left")
    found = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    size = F.size(found).cast("long")
    spans = F.coalesce("spans", F.expr("cast(array() as array<struct<s:int,e:int>>)"))
    return rows.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), spans.alias("spans"), size.alias("n_items"), found.alias("items"), (size >= min_items).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 8, remove: str = "documents", text_col: str = "text", block_hashes: int = BLOCK_HASHES) -> DataFrame:
    """docs without what the benchmark's windows hit, columns unchanged.

    ``remove="documents"`` drops rows with a hit; ``"spans"`` keeps every row and cuts the
    hit words with the gaps after them. Rows without a hit stay as they are, null and empty
    texts too; repeated rows are treated alike; empty tables work on either side.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    windows = settle(benchmark_windows(benchmark, n, text_col="text"), "windows")
    text = F.col(f"`{text_col}`")
    hits = _hits(docs.select(F.lit(None).cast("long").alias("doc_id"), text.alias("text")), windows, block_hashes, with_rows=False)
    verified = settle(_verified(hits, windows), "verified")
    p = columns_but(docs)
    same = _text_key(text) == F.col(p)
    if remove == "documents":
        return docs.join(broadcast_if_small(verified.select(F.col("key").alias(p)).distinct()), same, "left_anti")
    spans = f"{p}_spans"
    joined = docs.join(broadcast_if_small(_spans(verified).select(F.col("key").alias(p), F.col("spans").alias(spans))), same, "left")
    word, name = WORD_ANY_CASE.replace("\\", "\\\\"), f"`{text_col}`"
    # Each word with the gap after it; what lies between the spans is taken in slices.
    parts = f"zip_with(regexp_extract_all({name}, '{word}', 0), slice(split({name}, '{word}'), 2, {1 << 30}), (w, gap) -> concat(w, gap))"
    between = f"zip_with(concat(array(0), {spans}.e), concat({spans}.s, array(size(x.parts))), (a, b) -> array_join(slice(x.parts, a + 1, b - a), ''))"
    kept = f"transform(array(struct({parts} AS parts, split({name}, '{word}')[0] AS lead)), x -> concat(x.lead, array_join({between}, '')))[0]"
    cut = F.when(F.col(spans).isNotNull(), F.expr(kept)).otherwise(text)
    return joined.select(*[cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = rf"""
with d as (
  select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), bl as (
  select item_id, w, least(len(w), 8) as n from b where len(w) > 0
), bw as (
  select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as gram from (select *, unnest(generate_series(1, len(w) - n + 1)) as i from bl)
), dw as (
  select rid, n, i, array_to_string(w[i : i + n - 1], ' ') as gram
  from (select rid, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from d, (select distinct n from bw) where len(w) >= n)
), h as (
  select rid, n, i, item_id from dw join bw using (n, gram)
), c as (
  select rid, count(distinct p) as n_hit from (select rid, unnest(generate_series(i, i + n - 1)) as p from h) group by 1
), t as (
  select rid, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from h group by 1
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_items, 0) >= 2 as contaminated
from d left join c using (rid) left join t using (rid)
"""
