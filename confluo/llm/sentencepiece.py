"""SentencePiece encoding and decoding by weighted finite-state transduction.

The model file is compiled to machines, which are data: states, and arcs of an input, an
output, a weight and a next state.

* ``Normaliser`` puts the dummy prefix before a text and writes the space as U+2581.
* ``Pieces`` is a trie closed over its root: where a piece ends, an arc emits its id, with the
  piece's weight. A character without a piece has an arc to the ids of its UTF-8 bytes.
* ``Grammar`` says which label may follow which: its states are labels, its arcs weigh 0 and
  are there or not (an infinite weight).

Encoding composes an input with the three as far as it is read and takes the shortest path in
the tropical semiring. A unigram model's piece weighs its negative score, and its grammar has
one state. A byte-pair model's pieces weigh nothing; an arc of its grammar is there if merging
the two labels' text alone gives just these two. Exactly the model's segmentation has a finite
path: merges are local, so a sequence is what merging gives if and only if each neighbouring
pair is.

The input is read in parts between characters that stand side by side in no piece: paths of
the parts are independent, so their concatenation is the shortest path of the whole.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain, islice
from operator import itemgetter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.shared import map_arrow

SPACE = "▁"
#: Where this box keeps its public vocabularies; a parameter of every entry point.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"

# Fixed values of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: How much worse than the worst piece an unknown character is in a unigram model.
UNKNOWN_PENALTY = 10.0


def _proto(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message; 32- and 64-bit values as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        if kind not in (1, 2, 5):
            raise ValueError("not a SentencePiece model")
        n = varint() if kind == 2 else 8 if kind == 1 else 4
        yield tag >> 3, data[at : at + n]
        at += n


@dataclass
class Model:
    """A model file's content. ``data`` is what travels to the workers; it is compiled there once."""

    data: bytes
    pieces: list[str] = field(default_factory=list, repr=False)
    scores: list[float] = field(default_factory=list, repr=False)
    kinds: list[int] = field(default_factory=list, repr=False)
    kind: int = UNIGRAM
    dummy_prefix: bool = True
    unknown_surface: str = " ⁇ "

    def __post_init__(self) -> None:
        trim = charsmap = 0
        for f, v in _proto(self.data):
            if f == 1:
                own = dict(_proto(v))
                self.pieces.append(own.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                self.kinds.append(own.get(3, NORMAL))
            elif f == 2:
                trainer = dict(_proto(v))
                self.kind = trainer.get(3, UNIGRAM)
                self.unknown_surface = trainer.get(44, self.unknown_surface.encode()).decode()
                if trainer.get(24):
                    raise ValueError("models that treat white space as a suffix aren't supported")
            elif f == 3:
                rules = dict(_proto(v))
                charsmap, self.dummy_prefix, trim = rules.get(2, b""), bool(rules.get(3, 1)), rules.get(4, 1)
        if self.kind not in (UNIGRAM, BPE) or charsmap or trim or {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError("supported are unigram and byte-pair models with the identity normaliser and without user-defined or unused pieces")

    @classmethod
    def load(cls, path: str = MODEL_PATH) -> Model:
        return cls(Path(path).read_bytes())


#: What an arc without input reads; added to labels, which are at least -1 less the last code point, it gives numbers above 0.
ANY, NO_LABEL = "", 0x110002


class Normaliser:
    """From the state START, an arc without input emits the dummy prefix and leads to the state WITHIN; there, characters are rewritten or pass."""

    START, WITHIN = 0, 1

    def __init__(self, dummy_prefix: bool) -> None:
        self.arcs: dict[tuple[int, str], tuple[str, int]] = {(self.START, ANY): (SPACE if dummy_prefix else "", self.WITHIN), (self.WITHIN, " "): (SPACE, self.WITHIN)}

        self._within = {ord(c): said for (state, c), (said, to) in self.arcs.items() if state == to == self.WITHIN}

    def compose(self, text: str, state: int) -> str:
        """The output along the one path that reads the text."""
        before = self.arcs[state, ANY][0] if state == self.START else ""
        return before + text.translate(self._within)


class Pieces:
    """The trie: ``next[state]`` has the arcs by character, ``label[state]`` the piece that ends in a state (-1: none), ``weight`` those of the pieces."""

    def __init__(self, ids: dict[str, int], weight: list[float], fallback: float) -> None:
        self.next: list[dict[str, int] | None] = [None]
        self.label = [-1]
        self.weight, self.fallback, self.weighted = weight, fallback, any(weight)
        self.longest = max(map(len, ids), default=1)
        for piece, k in ids.items():
            state = 0
            for c in piece:
                arcs = self.next[state]
                if arcs is None:
                    arcs = self.next[state] = {}
                to = arcs.get(c)
                if to is None:
                    to = arcs[c] = len(self.next)
                    self.next.append(None)
                    self.label.append(-1)
                state = to
            self.label[state] = k

    def arcs(self, text: str, at: int) -> list[tuple[int, int, float]]:
        """(end, label, weight) of the ways from the root to it again that read ``text`` from a place, by weight, the longest first.

        A character that is no piece itself goes to its bytes, with the label -1 less its code point.
        """
        state, found, end, follow, labels, weight = 0, [], at, self.next, self.label, self.weight
        for c in text[at : at + self.longest]:
            arcs = follow[state]
            if arcs is None:
                break
            state = arcs.get(c)
            if state is None:
                break
            end += 1
            k = labels[state]
            if k >= 0:
                found.append((end, k, weight[k]))
        if not found or found[0][0] > at + 1:
            found.insert(0, (at + 1, -1 - ord(text[at]), self.fallback))
        found.reverse()
        if self.weighted:
            found.sort(key=itemgetter(2))
        return found


class Grammar:
    """Which label may follow which; its arcs are found when they are first asked for, and at most ``keep`` are kept."""

    def __init__(self, model: Model, ids: dict[str, int], keep: int = 300_000) -> None:
        self.model, self.ids, self.keep = model, ids, keep
        self.arcs: dict[tuple[int | None, int], bool] = {}

    def text_of(self, label: int) -> str:
        return self.model.pieces[label] if label >= 0 else chr(-1 - label)

    def merged(self, text: str) -> list[str]:
        """The symbols that merging leaves: always the best-scored neighbours that make a piece, of equal ones the leftmost."""
        symbols, ids, scores = list(text), self.ids, self.model.scores
        while True:
            best, place = -np.inf, -1
            for k in range(len(symbols) - 1):
                i = ids.get(symbols[k] + symbols[k + 1])
                if i is not None and scores[i] > best:
                    best, place = scores[i], k
            if place < 0:
                return symbols
            symbols[place : place + 2] = [symbols[place] + symbols[place + 1]]

    def accepts(self, key: tuple[int | None, int]) -> bool:
        """Whether there is an arc from the first label (None: the part's start) to the second."""
        if len(self.arcs) >= self.keep:
            self.arcs.clear()
        a = "" if key[0] is None else self.text_of(key[0])
        b = self.text_of(key[1])
        got = self.arcs[key] = self.merged(a + b) == ([a, b] if a else [b])
        return got


class _Paths(dict):
    """Paths of parts, as the bytes of their ids: those met lately, then those met before, then the search."""

    def __init__(self, search, state: int) -> None:
        self.search, self.state, self.before = search, state, {}

    def __missing__(self, part: str) -> bytes:
        got = self.before.get(part)
        if got is None:
            got = self.search(part, self.state)
        self[part] = got
        return got

    def age(self, keep: int) -> None:
        if len(self) >= keep:
            self.before = dict(self)
            self.clear()


class Transducer:
    """The compiled model. ``encode`` keeps the paths of parts met lately, 2 x ``keep`` of them (more within one text)."""

    def __init__(self, model: Model, keep: int = 250_000) -> None:
        self.model, self.keep = model, keep
        self.ids = {p: k for k, (p, kind) in enumerate(zip(model.pieces, model.kinds, strict=True)) if kind == NORMAL}
        self.byte_ids = {int(p[3:5], 16): k for k, (p, kind) in enumerate(zip(model.pieces, model.kinds, strict=True)) if kind == BYTE}
        self.bytes_of = {k: b for b, k in self.byte_ids.items()}
        self.is_byte = np.array(model.kinds) == BYTE
        self.unknown = next((k for k, kind in enumerate(model.kinds) if kind == UNKNOWN), 0)
        worst = min((model.scores[k] for k in self.ids.values()), default=0.0)
        merges = model.kind == BPE
        self.normaliser = Normaliser(model.dummy_prefix)
        self.pieces = Pieces(self.ids, [0.0] * len(model.scores) if merges else [-x for x in model.scores], 0.0 if merges else UNKNOWN_PENALTY - worst)
        self.grammar = Grammar(model, self.ids) if merges else None
        self._surface = [p.replace(SPACE, " ") if kind == NORMAL else chr(b) if (b := self.bytes_of.get(k, 256)) < 128 else None for k, (p, kind) in enumerate(zip(model.pieces, model.kinds, strict=True))]
        self._parts = self._cutter()
        self._first, self._paths = (_Paths(self._ids_of, state) for state in (Normaliser.START, Normaliser.WITHIN))

    def _cutter(self) -> re.Pattern:
        """Cuts a text into parts that no piece spans, whichever way its spaces are written."""
        several = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in several):
            return re.compile(r"(?s).+")
        joined = {c for p in several for c in p} - {SPACE}
        if not joined:
            return re.compile("(?s).")
        # Signs that follow a letter in no piece start a part; those that do count as letters.
        steps = {(a, b) for p in several for a, b in zip(p, p[1:], strict=False)}
        signs = {c for c in joined if not c.isalpha()}
        while moved := {b for a, b in steps if b in signs and a in joined - signs}:
            signs -= moved
        inside, before = ("".join(map(re.escape, sorted(x))) for x in (joined - signs, signs))
        space = f"[ {SPACE}]"
        if not signs or not joined - signs:
            return re.compile(f"{space}*[{inside}{before}]+|{space}+|[^ {SPACE}]", re.DOTALL)
        return re.compile(f"{space}*[{before}]*[{inside}]+|{space}*[{before}]+|{space}+|[^ {SPACE}]", re.DOTALL)

    # -- the composition

    def shortest(self, part: str, state: int = Normaliser.WITHIN) -> list[int]:
        """The labels on the shortest path of a part through the composed machines; of equally long ones, that which went furthest first.

        Its states are places in the normalised part with a state of the grammar (the last
        label; always the same where there is no grammar). Weights aren't negative, so states
        are settled in the order of their distance, those further on first where it is equal.
        An arc of the grammar is looked up only when its turn comes.
        """
        text = self.normaliser.compose(part, state)
        n, grammar, arcs_from = len(text), self.grammar, self.pieces.arcs
        known = grammar.arcs if grammar else {}
        # A state's number is its place and, with a grammar, its last label (from NO_LABEL on). It is kept with the one before, the label and the distance.
        came: dict[int, tuple[int, int | None, float]] = {0: (-1, None, 0.0)}
        lattice: list[list[tuple[int, int, float]] | None] = [None] * n
        lattice[0] = arcs_from(text, 0)
        end, label, weight = lattice[0][0]
        heap: list = [(weight, -end, 0, 0, None, label)]
        while heap:
            distance, at, k, before, last, label = heappop(heap)
            # A state's arcs are sorted, so that only the next one of them need be in the heap.
            arcs = lattice[before >> 22]
            if k + 1 < len(arcs):
                end, other, weight = arcs[k + 1]
                heappush(heap, (came[before][2] + weight, -end, k + 1, before, last, other))
            here = -at << 22 | (label + NO_LABEL if grammar else 0)
            if here in came:
                continue
            if grammar:
                ok = known.get((last, label))
                if not (grammar.accepts((last, label)) if ok is None else ok):
                    continue
            came[here] = (before, label, distance)
            if -at == n:
                out = []
                while here:
                    here, label, _ = came[here]
                    out.append(label)
                return out[::-1]
            arcs = lattice[-at]
            if arcs is None:
                arcs = lattice[-at] = arcs_from(text, -at)
            end, other, weight = arcs[0]
            heappush(heap, (distance + weight, -end, 0, here, label, other))
        raise ValueError(f"no path through {part!r}")

    def _ids_of(self, part: str, state: int) -> bytes:
        labels = self.shortest(part, state)
        if labels and min(labels) < 0:
            labels = list(chain.from_iterable(map(self.emit, labels)))
        return array("i", labels).tobytes()

    def emit(self, label: int) -> list[int]:
        if label >= 0:
            return [label]
        return [self.byte_ids.get(b, self.unknown) for b in chr(-1 - label).encode("utf-8", "replace")] if self.byte_ids else [self.unknown]

    # -- whole texts

    def encode(self, text: str | None) -> array:
        parts = self._parts.findall(text) if text else []
        if not parts:
            return array("i")
        self._first.age(self.keep)
        self._paths.age(self.keep)
        out = array("i")
        out.frombytes(b"".join([self._first[parts[0]], *map(self._paths.__getitem__, islice(parts, 1, None))]))
        return out

    def decode(self, ids) -> str:
        """The text of ids: bytes that make no UTF-8 become U+FFFD, control pieces nothing."""
        ids = list(ids)
        try:  # most texts have no bytes beyond ASCII, and each id a text of its own
            text = "".join(map(self._surface.__getitem__, ids))
            first = bool(ids) and self.model.dummy_prefix and self.model.pieces[ids[0]].startswith(SPACE)
            return text[1:] if first else text
        except TypeError:
            pass
        out, held, first = [], bytearray(), True
        for k in ids:
            b = self.bytes_of.get(k)
            if b is not None:
                held.append(b)
                first = False
                continue
            if held:
                out.append(held.decode("utf-8", "each_byte"))
                held.clear()
            kind = self.model.kinds[k]
            if kind == CONTROL:
                continue
            piece = self.model.unknown_surface if kind == UNKNOWN else self.model.pieces[k]
            if first and self.model.dummy_prefix and kind != UNKNOWN:
                piece = piece.removeprefix(SPACE)
            first = False
            out.append(piece.replace(SPACE, " ") if kind != UNKNOWN else piece)
        out.append(held.decode("utf-8", "each_byte"))
        return "".join(out)


def _each_byte(e: UnicodeDecodeError) -> tuple[str, int]:
    return "\ufffd" * (e.end - e.start), e.end


codecs.register_error("each_byte", _each_byte)


@lru_cache(maxsize=1)  # a worker compiles a model once and keeps it for its tasks
def compiled(data: bytes) -> Transducer:
    return Transducer(Model(data))


def encode(docs: DataFrame, model: Model, text_col: str = "text", into: str = "ids", round_trip: str | None = None) -> DataFrame:
    """docs with the ids of each text (array<int>; empty for null and empty texts) as a further column.

    ``round_trip`` names one more, whether decoding them gives the text back (a null text
    counts as empty): told in the same pass, as a second one would have a task hold two workers.
    Each row is encoded for itself, whole; repeated rows alike. A column that is already
    named as one of these is replaced. The model (its file's bytes) goes to the workers with the code.
    """
    data = model.data
    new = [into, round_trip] if round_trip else [into]
    rest = [c for c in docs.columns if c.lower() not in [n.lower() for n in new]]
    own = docs.select(*[F.col(f"`{c}`") for c in rest])
    k = rest.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = compiled(data)
        for b in batches:
            for part in runs(b, k):
                ids = [t.encode(x.as_py()) for x in part.column(k)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate([np.frombuffer(x, np.int32) for x in ids if len(x)] or [np.empty(0, np.int32)])
                found = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                if round_trip:
                    found.append(pa.array([t.decode(y) == (x.as_py() or "") for x, y in zip(part.column(k), ids, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays([*part.columns, *found], [*part.schema.names, *new])

    kinds = (T.ArrayType(T.IntegerType()), T.BooleanType())
    return map_arrow(own, run, T.StructType([*own.schema, *map(T.StructField, new, kinds)]))


def runs(b: pa.RecordBatch, k: int, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """b in slices of bounded text bytes (but for a single long text)."""
    start = size = 0
    for i, x in enumerate(b.column(k)):
        n = x.as_buffer().size if x.is_valid else 0
        if i > start and size + n > most_bytes:
            yield b.slice(start, i - start)
            start, size = i, 0
        size += n
    if b.num_rows > start:
        yield b.slice(start)


def decode(rows: DataFrame, model: Model, ids_col: str = "ids", into: str = "text") -> DataFrame:
    """rows with the text of each id sequence (null for null) as a further column, replacing one of that name."""
    data = model.data
    rest = [c for c in rows.columns if c.lower() != into.lower()]
    own = rows.select(*[F.col(f"`{c}`") for c in rest])
    k = rest.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = compiled(data)
        for b in batches:
            # One sequence at a time becomes Python numbers; a batch of them would take many times its size.
            texts = [t.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in b.column(k)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, into])

    return map_arrow(own, run, T.StructType([*own.schema, T.StructField(into, T.StringType())]))


DIGEST = "n_tokens long, n_byte_tokens long, ids_sha256 string, round_trip boolean"


def digests(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, how many ids and how many of them are bytes, the SHA-256 of the ids (32-bit, little-endian), and whether decoding gives the text back.

    A null text counts as empty; U+2581 in a text comes back as a space and so makes no round trip.
    """
    data = model.data
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ids_type = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = compiled(data)
        for b in batches:
            rows = []
            for x in b.column("text"):
                text = x.as_py() or ""
                ids = t.encode(text)
                of_bytes = int(t.is_byte[np.frombuffer(ids, np.int32)].sum()) if len(ids) else 0
                rows.append((len(ids), of_bytes, hashlib.sha256(ids.tobytes()).hexdigest(), t.decode(ids) == text))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], ["doc_id", "n_tokens", "n_byte_tokens", "ids_sha256", "round_trip"])

    return own.mapInArrow(run, f"doc_id {ids_type}, {DIGEST}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), Model.load())
