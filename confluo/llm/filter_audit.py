"""How filters interact: what each removes in every order that they can be applied in."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import settle

#: White space between words, as a character class and as its characters.
BLANK, BLANKS = r"[\x20\x09-\x0D]+", " \t\n\x0b\f\r"
#: With seven filters the table has 128 x 5,040 entries.
MOST_FILTERS = 7
#: Parts counted at a time within a task.
PARTS_HELD = 1024


def steps_of(n: int) -> np.ndarray:
    """[order, step]: the filter applied there; orders are the permutations in lexical order."""
    return np.array(list(permutations(range(n))), np.int64).reshape(-1, n)


def first_failure(n: int) -> np.ndarray:
    """[failed filters as bits, order]: the step that removes such a document, ``n`` if none does."""
    failed = np.arange(1 << n)[:, None, None] >> steps_of(n) & 1
    return np.where(failed.any(axis=2), failed.argmax(axis=2), n)


def _removals(names: list[str], kinds: list[str]):
    """Adds up rows of (part, mask, kinds, n) into the removals of each part, order and step."""
    n, labels = len(names), 1 << len(kinds)
    columns = ["kept", "removed", "redundant", "unique_fails", *[f"{k}_lost" for k in kinds], "shapley"]

    def partial(held: dict[str, np.ndarray]) -> pa.RecordBatch:
        steps, table = steps_of(n), first_failure(n)
        orders, parts = len(steps), list(held)
        counts = np.stack([held[p] for p in parts])  # part, kinds, mask
        cells = (np.arange(len(parts))[:, None, None] * orders + np.arange(orders)) * (n + 1) + table

        def by_step(weights: np.ndarray) -> np.ndarray:  # part, mask
            spread = np.repeat(weights[:, :, None], orders, axis=2)
            return np.bincount(cells.ravel(), spread.ravel(), len(parts) * orders * (n + 1)).reshape(len(parts), orders, n + 1)[:, :, :n]

        every = counts.sum(axis=1)
        removed = by_step(every)
        bits = np.arange(1 << n)
        failing = np.stack([every[:, bits >> f & 1 == 1].sum(axis=1) for f in range(n)], axis=1)  # part, filter
        alone = every[:, 1 << np.arange(n)]
        shares = np.stack([np.bincount(steps.ravel(), r.ravel(), n) for r in removed])
        kept = every.sum(axis=1)[:, None, None] - removed.cumsum(axis=2)
        lost = [by_step(counts[:, np.arange(labels) >> k & 1 == 1].sum(axis=1)) for k in range(len(kinds))]
        values = [kept, removed, failing[:, steps] - removed, alone[:, steps], *lost, shares[:, steps]]
        said = np.repeat(["".join(names[f] for f in s) for s in steps], n)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(parts, object), orders * n), pa.string()),
                pa.array(np.tile(said, len(parts)), pa.string()),
                pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(parts) * orders)),
                *(pa.array(np.rint(v).astype(np.int64).ravel()) for v in values),
            ],
            ["part", "filter_order", "step", *columns],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for b in batches:
            part = b.column("part").dictionary_encode()
            cell = (part.indices.to_numpy().astype(np.int64) * labels + b.column("kinds").to_numpy()) * (1 << n) + b.column("mask").to_numpy()
            met = part.dictionary.to_pylist()
            counts = np.bincount(cell, b.column("n").to_numpy(), len(met) * labels << n).reshape(len(met), labels, 1 << n)
            for p, c in zip(met, counts, strict=True):
                held[p] = held[p] + c if p in held else c
            if len(held) >= PARTS_HELD:
                yield partial(held)
                held = {}
        if held:
            yield partial(held)

    return run, ", ".join(["part string", "filter_order string", "step int", *[f"{c} long" for c in columns]]), columns


def audit(
    docs: DataFrame,
    fails: dict[str, Column],
    copies: str | None = None,
    labels: DataFrame | None = None,
    kinds: dict[str, Column] | None = None,
    part_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row for each part, order of the filters and step in it: part, filter_order, step (from 1), kept, removed, redundant, unique_fails, <kind>_lost..., shapley.

    ``fails`` names the filters: a condition over the columns of docs under which a document
    fails (null: it doesn't). ``copies`` names one more, which a document fails if a smaller
    id has an identical text anywhere in the table. A document goes at the first step it
    fails. kept: documents of the part left after the step; removed: those that go there;
    redundant: those that fail the step's filter but went before; unique_fails: those that
    fail it alone; shapley: what it removes, summed over all orders. ``kinds`` are
    conditions over ``labels``, of which any row of a document's id may hold; <kind>_lost
    are those removed at the step.

    A null text is an empty one; texts may be of any length, and are read once. A null part
    is the empty string. Rows of one id each count, and aren't copies of each other. Rows
    without an id have no label, are copies of none and have none. An empty table gives no
    rows; without labels nothing is lost; further columns are ignored, whatever their names.

    A document is one of 2^n sets of failed filters. Each task counts these by part and
    label and looks their steps up in a table for all orders; the tasks' arrays, all of one
    size, are summed. Copies cost one exchange of narrow rows by their text's SHA-256, which
    keeps the smallest id of each text within tasks first: all rows of a text count as
    copies, then its first document is taken back.
    """
    names, kinds = [*fails, *([copies] if copies else [])], kinds or {}
    if not 1 <= len(names) <= MOST_FILTERS or len(set(names)) < len(names):
        raise ValueError(f"one to {MOST_FILTERS} filters of different names are needed")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    mask = sum((F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(fails.values())), F.lit(0))
    part = F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit(""))
    facts = settle(docs.select(F.col(f"`{id_col}`").alias("id"), part.alias("part"), mask.alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest")), "facts")
    known = F.col("id").isNotNull()
    own = facts.where(known)
    if labels is not None and kinds:
        said = [F.max(F.coalesce(c, F.lit(False)).cast("int")) * (1 << k) for k, c in enumerate(kinds.values())]
        tags = labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("id")).agg(sum(said, F.lit(0)).alias("kinds")).where("kinds > 0")
        own = own.join(tags, "id", "left")
    else:
        own = own.withColumn("kinds", F.lit(0))
    # Both groups hold within the join's partitions, so nothing is exchanged for them.
    each = own.groupBy("id", "digest", "part", "mask", F.coalesce("kinds", F.lit(0)).alias("kinds")).agg(F.count(F.lit(1)).alias("n"))
    each = settle(each.groupBy("id", "digest").agg(F.collect_list(F.struct("part", "mask", "kinds", "n")).alias("cells")), "labelled")
    rest = facts.where(~known).select("part", "mask", F.lit(0).alias("kinds"), F.lit(1).cast("long").alias("n"))
    rows = each.select(F.inline("cells"))
    if copies:
        bit = F.lit(1 << len(fails))
        first = each.groupBy("digest").agg(F.min(F.struct("id", "cells")).alias("first")).select(F.inline("first.cells"))
        back = first.select("part", "kinds", F.explode(F.array(F.struct("mask", "n"), F.struct((F.col("mask") + bit).alias("mask"), (-F.col("n")).alias("n")))).alias("c"))
        rows = rows.withColumn("mask", F.col("mask") + bit).unionByName(back.select("part", "c.mask", "kinds", "c.n"))
    count, schema, columns = _removals(names, list(kinds))
    cells = rows.unionByName(rest).mapInArrow(count, schema)
    return cells.groupBy("part", "filter_order", "step").agg(*[F.sum(c).alias(c) for c in columns])


def text_filters(text: Column) -> dict[str, Column]:
    """A: under 200 words; B: under half of the words distinct; C: over 3 % capitals A-Z; D: a symbol of ``#$%&*|``."""
    text = F.coalesce(text, F.lit(""))
    bare = F.btrim(text, F.lit(BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": F.size(words) < 200, "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words), "C": 100 * capitals > 3 * F.length(text), "D": text.rlike(r"[#$%&*|]")}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return audit(docs, text_filters(F.col("text")), copies="E", labels=labels, kinds={"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1})


ORACLE = r"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), tags as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by 1
), f as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic, concat(
    case when len(w) < 200 then 'A' end, case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' end,
    case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) then 'C' end,
    case when regexp_matches(t, '[#$%&*|]') then 'D' end, case when doc_id > min(doc_id) over (partition by t) then 'E' end) as fails
  from d left join tags using (doc_id)
), g as (
  select part, good, toxic, fails, count(*) as n from f group by all
), l as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as x
), o as (
  select concat(a.x, b.x, c.x, d.x, e.x) as filter_order from l a, l b, l c, l d, l e
  where b.x <> a.x and c.x not in (a.x, b.x) and d.x not in (a.x, b.x, c.x) and e.x not in (a.x, b.x, c.x, d.x)
), s as (
  select filter_order, step::int as step, filter_order[step] as own, filter_order[1 : step - 1] as before from o, range(1, 6) r(step)
), j as (
  select *, contains(fails, own) as failing, translate(fails, before, '') = fails as there from s, g
), r as (
  select part, filter_order, step, own, sum(n) filter (there and not failing) as kept, sum(n) filter (there and failing) as removed,
    sum(n) filter (failing and not there) as redundant, sum(n) filter (fails = own) as unique_fails,
    sum(n) filter (there and failing and good) as good_lost, sum(n) filter (there and failing and toxic) as toxic_lost
  from j group by all
)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
  coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  coalesce(sum(removed) over (partition by part, own), 0)::bigint as shapley
from r
"""
