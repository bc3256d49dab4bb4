"""Lines and link texts from positioned text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Heights are dealt into cells of so much; a rectangle over more than ``MOST_CELLS`` of them meets its whole page.
CELL, MOST_CELLS = 32.0, 1000

_FIRST = (False, 0.0)


def _text(items: list[tuple], gap: float) -> str:
    """The items (x, down, w, str) of a line from left to right; a space goes between those further apart than ``gap`` unless one of them has it."""
    text, end = "", None
    for x, _, w, said in sorted(items, key=lambda i: tuple(_FIRST if v is None else (True, v) for v in i[:3]) + (i[3] or "",)):
        if end is not None and x is not None and x - end > gap and not text.endswith(" ") and not (said or "").startswith(" "):
            text += " "
        text += said or ""
        end = None if x is None or w is None else x + w
    return " ".join(text.split())


def _lines(tolerance: float, gap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None  # document, page
        anchor: float | None = None
        held: list[tuple] = []
        n = 0
        for b in batches:
            out: list[tuple] = []
            for doc, page, down, x, w, said in zip(*(b.column(c).to_pylist() for c in ("doc", "page", "down", "x", "w", "str")), strict=True):
                if now != (doc, page) or anchor is None or down is None or abs(down - anchor) > tolerance:
                    if held and (text := _text(held, gap)):
                        out.append((now[0], n, text))
                        n += 1
                    if now is None or now[0] != doc:
                        n = 0
                    now, anchor, held = (doc, page), down, []
                held.append((x, down, w, said))
            yield packed(out, b.schema.field("doc").type)
        if held and (text := _text(held, gap)):
            yield packed([(now[0], n, text)], b.schema.field("doc").type)

    def packed(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((kind, pa.int32(), pa.string()))], ["doc", "n", "line"])

    return run


def grouped_lines(items: DataFrame, tolerance: float = 4.0, gap: float = 1.2, by_page: bool = True) -> DataFrame:
    """(doc, n, line): the visual lines of positioned items (doc, page, x, y, w, str), top to bottom, n from 0 in each document.

    A line takes items whose y is within ``tolerance`` of its first item's. ``by_page`` keeps
    pages apart; without it they interleave by height. Lines of white space alone are none.
    A null y is a line of its own. Items are sorted by Spark and read in one pass that holds
    one line, so time and memory don't depend on a document's size; an empty table gives no rows.
    """
    page = F.col("page").cast("int") if by_page else F.lit(0)
    kind = items.schema["doc"].dataType.simpleString()
    own = items.select("doc", page.alias("page"), (-F.col("y")).cast("double").alias("down"), F.col("x").cast("double").alias("x"), F.col("w").cast("double").alias("w"), "str")
    ordered = own.repartition("doc").sortWithinPartitions("doc", "page", "down", "x", "w", "str")
    return ordered.mapInArrow(_lines(tolerance, gap), f"doc {kind}, n int, line string")


def anchored_links(items: DataFrame, annotations: DataFrame) -> DataFrame:
    """Link rectangles (doc, page, url, x1, y1, x2, y2) with ``anchor``, the text of the items whose centre lies in them, one unit of slack.

    Items and rectangles meet by cells of height within their page, so a page of many of both
    costs what lies side by side. A rectangle without items, or with a null side, has an
    empty anchor; those without a url are left out.
    """
    a = annotations.where("url is not null").withColumn("link", F.monotonically_increasing_id())
    lo, hi = F.floor((F.col("y1") - 1) / CELL), F.floor((F.col("y2") + 1) / CELL)
    cells = F.when(hi - lo <= MOST_CELLS, F.when(hi >= lo, F.sequence(lo, hi)))
    # A tall rectangle meets its whole page, where each item is once more.
    tall = F.when(hi - lo > MOST_CELLS, F.array(F.struct(F.lit(True).alias("tall"), F.lit(0).cast("long").alias("cell"))))
    none = F.array(F.struct(F.lit(None).cast("boolean").alias("tall"), F.lit(None).cast("long").alias("cell")))
    dealt = a.withColumn("at", F.explode(F.coalesce(tall, F.transform(cells, lambda c: F.struct(F.lit(False).alias("tall"), c.alias("cell"))), none)))
    cx, cy = F.col("x") + F.col("w") / 2, F.col("y") + F.col("h") / 2
    own = items.withColumn("cx", cx).withColumn("cy", cy).withColumnsRenamed({"doc": "i_doc", "page": "i_page"})
    placed = own.withColumn("i_at", F.explode(F.array(F.struct(F.lit(False).alias("tall"), F.floor(F.col("cy") / CELL).alias("cell")), F.struct(F.lit(True).alias("tall"), F.lit(0).cast("long").alias("cell")))))
    inside = F.col("cx").between(F.col("x1") - 1, F.col("x2") + 1) & F.col("cy").between(F.col("y1") - 1, F.col("y2") + 1)
    same = (F.col("doc") == F.col("i_doc")) & (F.col("page") == F.col("i_page")) & (F.col("at.tall") == F.col("i_at.tall")) & (F.col("at.cell") == F.col("i_at.cell"))
    met = dealt.join(placed, same & inside, "left").groupBy("doc", "page", "link", "url", "x1", "y1")
    said = F.array_sort(F.collect_list(F.when(F.col("str").isNotNull(), F.struct((-F.col("y")).alias("down"), "x", "str"))))
    return met.agg(F.trim(F.array_join(F.transform(said, lambda v: v["str"]), "")).alias("anchor")).drop("link")
