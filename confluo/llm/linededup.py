"""Removal of multi-line passages that repeat anywhere in a corpus, by content-defined chunks of lines and sentences."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import columns_but, discard, map_arrow, settle
from ..plans.sizing import broadcast_if_small

#: Ends of lines and of sentences, with the blanks after them; wide full stops need none. Told by the first character, so that all others are passed over fast.
_ENDS = re.compile(r"[\n.!?…。！？](?:(?<=\n)|(?<=[.!?…])[\"'”’»)\]]*[ \t]+|(?<=[。！？])[”’」』）]*[ \t]*)")
_WIDE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"  # scripts without blanks between words
_WIDES, _TOKEN = re.compile(f"[{_WIDE}]"), re.compile(rf"[{_WIDE}]|[^\s{_WIDE}]+")


#: CRC-32 of the words met, so that frequent ones are hashed once; emptied when full.
_CRC: dict[str, int] = {}


def _crc(word: str) -> int:
    if len(_CRC) >= 200_000:
        _CRC.clear()
    got = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    if len(word) < 32:
        _CRC[word] = got
    return got


def words_in(text: str) -> int:
    """Words between blanks; in scripts without blanks two letters count as one."""
    if text.isascii():
        return len(text.split())
    wide = len(_WIDES.findall(text))
    return len(_TOKEN.findall(text)) - wide + (wide + 1) // 2 if wide else len(text.split())


@dataclass(frozen=True)
class Chunker:
    """Cuts texts into chunks at places that the words at the cut alone decide.

    Pieces are lines, cut after their sentences; one of over ``long_words`` words is cut
    further, after a word whose hash with the word before it is 0 modulo ``spread``, and after
    ``long_words`` words, into pieces of ``least_words`` words at least. A piece of ``least_words`` words is a chunk. A run of shorter
    ones is a chunk, ended where it has twice that many words and the last one's hash is even,
    and after ``most_lines``. A line of at least ``paragraph_words`` words opens and closes a chunk.
    """

    spread: int = 8
    least_words: int = 4
    long_words: int = 32
    paragraph_words: int = 40
    most_lines: int = 64
    #: A repeated passage of one line or sentence is cut from so many words on; of several, from least_passage.
    single_words: int = 40
    least_passage: int = 8

    def lines(self, text: str) -> list[tuple[int, int, int, bool, bool]]:
        """(start, end, words, opens, closes) of each piece; they cover the text.

        opens, closes: it starts or ends a line of at least ``paragraph_words`` words.
        """
        found, first, total, at, most, size, long = [], 0, 0, 0, self.long_words, len(text), self.paragraph_words
        plain = text.isascii() or not _WIDES.search(text)
        stops = [m.end() for m in _ENDS.finditer(text)]
        if not stops or stops[-1] < size:
            stops.append(size)
        for stop in stops:
            if stop > at:
                n = len(text[at:stop].split()) if plain else words_in(text[at:stop])
                if n > most:
                    found += [(*x, False, False) for x in self._parts(text, at, stop, plain)]
                else:
                    found.append((at, stop, n, False, False))
                total, at = total + n, stop
            if stop == size or text[stop - 1] == "\n":
                if total >= long:
                    found[first] = (*found[first][:3], True, False)
                    found[-1] = (*found[-1][:4], True)
                first, total = len(found), 0
        return found

    def _parts(self, text: str, start: int, stop: int, plain: bool) -> list[tuple[int, int, int]]:
        words = text[start:stop].split() if plain else _TOKEN.findall(text, start, stop)
        fewest, most, spread, size = max(self.least_words * (1 if plain else 2), 1), self.long_words, self.spread, len(words)
        known = [0, *map(_CRC.get, words)]  # before each word the hash of the one before it
        if None in known:
            for k, w in enumerate(words, 1):
                if known[k] is None:
                    known[k] = _crc(w)
        hashes = np.array(known, np.int64)
        ends = (np.flatnonzero(((hashes[1:] ^ hashes[:-1] * 5) >> 7) % spread == 0) + 1).tolist()
        cuts, since = [], 0
        for k in [*ends, size]:
            while k - since >= most:
                since += most
                cuts.append(since)
            if k - since >= fewest:
                cuts.append(k)
                since = k
        while cuts and cuts[-1] >= size:
            cuts.pop()
        if cuts and size - cuts[-1] < fewest:  # too few for a piece of their own
            cuts.pop()
        found, at, k = [], start, 0
        place = text.find(words[0], start)
        even = plain and text.startswith(" ".join(words), place)  # one blank between any two words
        for cut in cuts:
            if even:
                place += len(" ".join(words[k:cut])) + 1
            else:
                for w in words[k:cut]:
                    place = text.find(w, place) + len(w)
                place = text.find(words[cut], place)
            found.append((at, place, cut - k if plain else words_in(text[at:place])))
            at, k = place, cut
        return [*found, (at, stop, size - k if plain else words_in(text[at:stop]))]

    def chunks(self, text: str) -> list[tuple[int, int, int, int]]:
        """(start, end, lines, words) of each chunk; a piece of ``least_words`` words counts as two lines."""
        found, least = [], self.least_words
        start = end = lines = words = 0
        for at, stop, n, opens, closes in self.lines(text):
            small = n < least
            if lines and (opens or not small):
                found.append((start, end, lines, words))
                start, lines, words = end, 0, 0
            end = stop
            if not n:
                continue
            lines, words = lines + (1 if small else 2), words + n
            if not small or closes or lines >= self.most_lines or (words >= 2 * least and not _crc(text[at:stop].strip()) & 1):
                found.append((start, end, lines, words))
                start, lines, words = end, 0, 0
        if end > start:
            found.append((start, end, lines, words))
        return found

    def passages(self, text: str, listed: list[tuple[int, int, int, bool, int]]) -> list[tuple[int, int]]:
        """The spans to cut: runs of repeated chunks that follow each other where they come first, too."""
        runs: list[list] = []
        seen: set[int] = set()
        for start, end, h, first, near in listed:
            if first and h not in seen:
                seen.add(h)
                continue
            gap = text[runs[-1][1] : start] if runs and start - runs[-1][1] < 200 else None
            after, before = (runs[-1][2] & 2, near & 1) if runs else (0, 0)
            # Words too few for a chunk to be listed go if they stand between the same chunks at the first place.
            if gap is not None and ((not gap and (after or before)) or (after and before and words_in(gap) < self.least_words)):
                runs[-1][1:] = [end, near]
            else:
                runs.append([start, end, near])
        out = []
        for start, end, _ in runs:
            said = text[start:end]
            words = words_in(said)
            if words >= self.single_words or (words >= self.least_passage and _ENDS.search(said.strip())):
                out.append((start, end))
        return out


def content(text: str) -> str:
    """What chunks are compared by: the lines stripped of white space at their ends, without blank ones."""
    text = text.strip()
    return text if "\n" not in text else "\n".join(x for x in map(str.strip, text.split("\n")) if x)


#: Texts whose chunks are held at a time.
_TEXTS = 256


def _chunks(how: Chunker):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, least = xxhash.xxh3_128_digest, how.least_words
        for b in (whole.slice(k, _TEXTS) for whole in batches for k in range(0, whole.num_rows, _TEXTS)):
            counts, rows, digests = [], [], []
            for text in b.column("text").to_pylist():
                own = how.chunks(text) if text else []
                counts.append(len(own))
                rows += own
                for at, stop, _, _ in own:
                    said = text[at:stop].strip()
                    digests.append(digest(said if "\n" not in said else content(said)))
            places = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
            start, end, lines, words = np.fromiter(chain.from_iterable(rows), np.int32, 4 * len(rows)).reshape(-1, 4).T
            hashes = np.frombuffer(b"".join(digests), np.dtype([("h", "<i8"), ("near", "<u4"), ("rest", "<u4")]))
            near = (hashes["near"] >> 1 | 1).astype(np.int32)
            # What stands beside a chunk in its own text; 0 at the text's ends.
            same = places[1:] == places[:-1]
            before, after = np.zeros_like(near), np.zeros_like(near)
            before[1:], after[:-1] = np.where(same, near[:-1], 0), np.where(same, near[1:], 0)
            listed = (lines >= 2) & (words >= least)
            which = pa.array(places[listed])
            columns = (pa.array(np.ascontiguousarray(x[listed])) for x in (start, end, hashes["h"], before, after))
            yield pa.RecordBatch.from_arrays([b.column("id").take(which), b.column("mark").take(which), *columns], ["id", "mark", "start", "end", "h", "before", "after"])

    return run


def _listed(chunks: pa.ListArray) -> Iterator[list[tuple[int, int, int, bool, int]]]:
    """(start, end, h, first, near) of the chunks listed in each row."""
    flat, ends = chunks.flatten(), chunks.value_lengths().fill_null(0).to_pylist()
    rows = list(zip(*(flat.field(k).to_pylist() for k in range(5)), strict=True))
    at = 0
    for n in ends:
        yield rows[at : at + n]
        at += n


def _said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, content) of the listed chunks, each content once for a batch."""
    for b in batches:
        seen: dict[int, str] = {}
        others: set[tuple[int, str]] = set()
        for t, listed in zip(b.column("text"), _listed(b.column("chunks")), strict=True):
            text = t.as_py()
            for start, end, h, _, _ in listed:
                said = content(text[start:end])
                if seen.setdefault(h, said) != said:
                    others.add((h, said))
        rows = [*seen.items(), *others]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["h", "content"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The content of every listed chunk of each text."""
    for b in batches:
        rows = []
        for k, (t, listed) in enumerate(zip(b.column("text"), b.column("chunks"), strict=True)):
            text = t.as_py()
            rows += [(k, c["start"], c["h"], c["first"], content(text[c["start"] : c["end"]])) for c in listed.as_py()]
            if len(rows) >= 5000:
                yield _packed(b, rows)
                rows = []
        yield _packed(b, rows)


def _packed(b: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    which = pa.array([r[0] for r in rows], pa.int32())
    types = (pa.int32(), pa.int64(), pa.bool_(), pa.string())
    return pa.RecordBatch.from_arrays([b.column("id").take(which), b.column("mark").take(which), *(pa.array([r[c + 1] for r in rows], t) for c, t in enumerate(types))], ["id", "mark", "start", "h", "first", "content"])


def cut_out(text: str, spans: list[tuple[int, int]]) -> str:
    kept, at = [], 0
    for start, end in sorted(spans):
        kept.append(text[at:start])
        at = max(at, end)
    return "".join([*kept, text[at:]])


def _cut(how: Chunker, text_col: str, chunks: str, removed: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = b.schema.get_field_index(text_col)
            texts, gone = [], []
            for t, listed in zip(b.column(k), _listed(b.column(chunks)), strict=True):
                text = t.as_py()
                spans = how.passages(text, listed)
                texts.append(cut_out(text, spans) if spans else text)
                gone.append([{"start": s, "end": e} for s, e in spans])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield b.set_column(k, text_col, pa.array(texts, pa.string())).append_column(removed, pa.array(gone, kind))

    return run


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def dedup_lines(docs: DataFrame, how: Chunker = Chunker(), id_col: str = "doc_id", text_col: str = "text", removed: str | None = None, classes: DataFrame | None = None) -> DataFrame:
    """docs with every repeat of a passage cut from its text; the first one (by id, then place) stays.

    A passage is a run of repeated chunks, of which each follows the one before it at the
    first place of one of the two as well. It is cut if it has several lines or sentences
    and ``least_passage`` words, or ``single_words`` words; a lone repeated line stays.
    ``removed`` names a column for the spans cut, (start, end) in characters of the old text;
    without it the columns are those of docs. Candidates meet by a 64-bit hash of their
    content; each is compared with the first one's content before it is cut. Rows equal in
    id and text are one document, which repeats nothing by that: they come out alike. Null
    and empty texts stay as they are; a null id is the smallest. An empty table gives no rows.

    ``classes`` (mark, lead_id, lead_mark) names texts by their ``xxhash64`` that count as one
    document together, that of their first one: they keep what only they have in common,
    and lose what another document has before the first of them.

    Shuffled are a narrow row for each chunk, each text once (to meet its list of chunks),
    and the contents of repeated chunks.
    """
    p = columns_but(docs, removed or "")
    spans, mark = f"{p}_chunks", f"{p}_mark"
    text, ids = F.col(f"`{text_col}`"), docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(f"`{id_col}`").alias("id"), _key(text).alias("mark"), text.alias("text"))
    found = settle(own.mapInArrow(_chunks(how), f"id {ids}, mark long, start int, end int, h long, before int, after int"), "chunks")

    # Which hashes occur twice is told by a count of narrow rows; the places of chunks are
    # shuffled after that, and only those of repeats meet again. A struct as key has both
    # sides exchanged for its join alone, so a hot chunk's rows can be split.
    twice = found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.struct("h").alias("k"))
    again = settle(found.withColumn("k", F.struct("h")).join(twice, "k", "left_semi").drop("k"), "again")
    discard(found)
    if classes is None:
        grouped, first = again.withColumn("of", F.struct("id", "mark")), F.expr("struct(id, mark, start) <=> struct(least.id, least.mark, least.start)")
    else:
        led = again.join(broadcast_if_small(classes), "mark", "left")
        grouped, first = led.withColumn("of", F.when(F.col("lead_mark").isNull(), F.struct("id", "mark")).otherwise(F.struct(F.col("lead_id").alias("id"), F.col("lead_mark").alias("mark")))).drop("lead_id", "lead_mark"), F.expr("of <=> least.of")
    place = F.struct("of", "id", "mark", "start")
    whole_place = F.struct("of", "id", "mark", "start", "before", "after")
    least = grouped.groupBy("h").agg(F.min(whole_place).alias("least"), F.max(place).alias("last")).where("not (struct(least.of, least.id, least.mark, least.start) <=> last)")
    least = least.select(F.struct("h").alias("k"), "least")
    repeats = grouped.withColumn("k", F.struct("h")).join(least, "k")
    near = F.expr("if(before = least.before AND before <> 0, 1, 0) + if(after = least.after AND after <> 0, 2, 0)")
    listed = repeats.withColumn("first", first).withColumn("near", near).groupBy("id", "mark")
    listed = listed.agg(F.array_sort(F.collect_set(F.struct("start", "end", "h", "first", "near"))).alias(spans)).withColumnsRenamed({"id": f"{p}_id", "mark": mark})
    joined = docs.join(listed, F.col(f"`{id_col}`").eqNullSafe(F.col(f"{p}_id")) & (_key(text) == F.col(mark)), "left")
    met = settle(joined.drop(f"{p}_id", mark), "met")
    discard(again)

    # Contents are compared where they differ at all under one hash: each distinct one is sent once by a task.
    some = met.where(F.col(spans).isNotNull())
    said = some.select(text.alias("text"), F.col(spans).alias("chunks")).mapInArrow(_said, "h long, content string")
    odd = settle(said.groupBy("h", "content").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.struct("h").alias("k")), "odd")
    if odd.limit(1).count():  # equal hashes of unlike chunks: those unlike the first stay
        whole = some.select(F.col(f"`{id_col}`").alias("id"), _key(text).alias("mark"), text.alias("text"), F.col(spans).alias("chunks"))
        contents = whole.mapInArrow(_texts, f"id {ids}, mark long, start int, h long, first boolean, content string")
        contents = contents.withColumn("k", F.struct("h")).join(odd, "k", "left_semi")
        firsts = contents.where("first").groupBy("k").agg(F.min("content").alias("said"))
        wrong = settle(contents.where("not first").join(firsts, "k").where("content <> said").select("id", "mark", "start").distinct(), "unlike")
        kept = wrong.groupBy("id", "mark").agg(F.collect_set("start").alias("starts")).withColumnsRenamed({"id": f"{p}_id", "mark": mark, "starts": f"{p}_starts"})
        met = met.join(kept, F.col(f"`{id_col}`").eqNullSafe(F.col(f"{p}_id")) & (_key(text) == F.col(mark)), "left")
        met = met.withColumn(spans, F.expr(f"filter({spans}, c -> NOT coalesce(array_contains({p}_starts, c.start), false))")).drop(f"{p}_id", mark, f"{p}_starts")

    # Of a document's class the first place of each chunk in it stays, so a chunk that it has twice is cut as well.
    cut = F.exists(F.col(spans), lambda c: ~c["first"]) | (F.size(F.array_distinct(F.transform(F.col(spans), lambda c: c["h"]))) < F.size(F.col(spans)))
    gone, kind = removed or f"{p}_removed", "array<struct<start:int,end:int>>"
    touched = met.where(cut)
    schema = touched.withColumn(gone, F.lit(None).cast(kind)).schema
    edited = map_arrow(touched, _cut(how, text_col, spans, gone), schema)
    all_rows = met.where(~F.coalesce(cut, F.lit(False))).withColumn(gone, F.expr(f"cast(array() as {kind})")).unionByName(edited)
    return all_rows.drop(spans) if removed else all_rows.drop(spans, gone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), removed="removed")
    chars = F.aggregate("removed", F.lit(0).cast("long"), lambda a, c: a + c["end"] - c["start"])
    return done.select("doc_id", F.size("removed").cast("long").alias("n_removed"), chars.alias("chars_removed"), F.length("text").cast("long").alias("chars_kept"), F.sha2(F.col("text"), 256).alias("text_sha256"))
