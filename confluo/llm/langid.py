"""Language identification by hyperdimensional profiles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.shared import map_arrow

UNKNOWN = "und"
SPACE = 0x20


@cache
def _fold() -> np.ndarray:
    """By code point: its lower-case letter (the space where it is none)."""
    table = np.full(0x110000, SPACE, np.uint32)
    for c in range(0x110000):
        if (s := chr(c)).isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def letters(text: str) -> np.ndarray:
    """The text's letters in lower case, what lies between them as one space, with a space at either end."""
    codes = _fold()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    codes = np.concatenate([[SPACE], codes, [SPACE]]).astype(np.uint32)
    gap = codes == SPACE
    return codes[~(gap & np.concatenate([[False], gap[:-1]]))]


def letter_vector(code: int, dim: int, seed: int) -> np.ndarray:
    """The random bipolar vector of a letter: drawn from its code point and the seed, on every machine the same."""
    bits = hashlib.shake_128(f"{seed}:{code}".encode()).digest(dim // 8)
    return np.unpackbits(np.frombuffer(bits, np.uint8)).astype(np.int8) * 2 - 1


class Space:
    """n-gram vectors: each letter's vector is permuted (rolled) by its place and all are bound (multiplied)."""

    def __init__(self, dim: int, seed: int, n: int = 3, keep: int = 40_000) -> None:
        self.dim, self.seed, self.n, self.keep = dim, seed, n, keep
        self._letters: dict[int, np.ndarray] = {}
        self._grams: dict[int, np.ndarray] = {}

    def _letter(self, code: int) -> np.ndarray:
        if code not in self._letters:
            if len(self._letters) >= self.keep:
                self._letters.clear()
            self._letters[code] = letter_vector(code, self.dim, self.seed)
        return self._letters[code]

    def vectors(self, keys: np.ndarray) -> np.ndarray:
        """A row for each n-gram key; memory for kept ones is bounded, all others are bound again when met."""
        out = np.empty((len(keys), self.dim), np.float32)
        for row, key in enumerate(keys.tolist()):
            v = self._grams.get(key)
            if v is None:
                v = np.ones(self.dim, np.int8)
                for place in range(self.n):
                    v = v * np.roll(self._letter(key >> (21 * place) & 0x1FFFFF), place)
                if len(self._grams) >= self.keep:
                    self._grams.clear()
                self._grams[key] = v
            out[row] = v
        return out


def gram_keys(codes: np.ndarray, n: int = 3) -> np.ndarray:
    """The n-grams of a letter sequence as 64-bit keys; none if it is shorter or holds no letter."""
    if len(codes) < n:
        return np.empty(0, np.int64)
    wide = codes.astype(np.int64)
    return sum(wide[n - 1 - p : len(wide) - p] << (21 * p) for p in range(n))


def counted(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, position in keys, count) of each text's distinct n-grams, and the distinct keys of all."""
    each = [gram_keys(letters(t), n) if t else np.empty(0, np.int64) for t in texts]
    rows = np.repeat(np.arange(len(each)), [len(k) for k in each])
    keys, at = np.unique(np.concatenate(each) if each else np.empty(0, np.int64), return_inverse=True)
    pairs, counts = np.unique(rows * max(1, len(keys)) + at, return_counts=True)
    return pairs // max(1, len(keys)), pairs % max(1, len(keys)), counts, keys


def blocks(texts: list[str | None], chars: int = 400_000, most: int = 64) -> Iterator[tuple[int, int]]:
    """Runs of texts of bounded number and, but for a single text, length."""
    start = size = 0
    for k, t in enumerate(texts):
        if k > start and (size + len(t or "") > chars or k - start >= most):
            yield start, k
            start, size = k, 0
        size += len(t or "")
    if start < len(texts):
        yield start, len(texts)


@dataclass(frozen=True)
class Profiles:
    """The settings of a hyperdimensional space and, once learned, a prototype for each language."""

    dim: int = 512
    n: int = 3
    seed: int = 7
    languages: tuple[str, ...] = ()
    prototypes: np.ndarray | None = None  # a row for each language, of length 1

    def learn(self, docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Profiles:
        """Bundles (sums) the n-gram vectors of all texts of each language.

        Every task sends one sum for each language it met; sums of whole numbers are exact,
        so the order of tasks doesn't matter. Rows without text or language are skipped. The
        driver gets a vector for each language: languages times ``dim`` numbers.
        """
        dim, n, seed = self.dim, self.n, self.seed

        def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            space, sums = Space(dim, seed, n), {}
            for b in batches:
                langs, texts = b.column("lang").to_pylist(), b.column("text")
                for lang in set(langs):
                    own = texts.filter(pa.array([x == lang for x in langs])).to_pylist()
                    for i, j in blocks(own):
                        _, at, counts, keys = counted(own[i:j], n)
                        total = np.bincount(at, counts, len(keys))
                        into = sums.setdefault(lang, np.zeros(dim))
                        for k in range(0, len(keys), 4096):
                            into += total[k : k + 4096] @ space.vectors(keys[k : k + 4096]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "v"])

        own = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
        part = own.mapInArrow(bundle, "lang string, v array<double>")
        sums = part.select("lang", F.posexplode("v")).groupBy("lang", "pos").agg(F.sum("col").alias("x"))
        whole = sums.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("v"))
        got = sorted((r["lang"], r["v"]) for r in whole.collect() if any(r["v"]))
        if not got:
            return self
        m = np.array([v for _, v in got])
        return Profiles(dim, n, seed, tuple(k for k, _ in got), (m / np.linalg.norm(m, axis=1, keepdims=True)).astype(np.float32))

    def similarities(self, texts: list[str | None], space: Space) -> np.ndarray:
        """The cosine of each text's bundle with each prototype; nan where a text has no letter."""
        out = np.full((len(texts), len(self.languages)), np.nan)
        for i, j in blocks(texts):
            rows, at, counts, keys = counted(texts[i:j], self.n)
            if not len(keys):
                continue
            bundles = np.zeros((j - i, self.dim), np.float32)
            for k in range(0, len(keys), 8192):
                own = (at >= k) & (at < k + 8192)
                c = np.zeros((j - i, min(8192, len(keys) - k)), np.float32)
                c[rows[own], at[own] - k] = counts[own]
                bundles += c @ space.vectors(keys[k : k + 8192])
            norms = np.linalg.norm(bundles, axis=1)
            some = norms > 0
            out[i:j][some] = bundles[some] @ self.prototypes.T / norms[some, None]
        return out

    def predict(self, docs: DataFrame, text_col: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
        """docs with the language of the closest prototype (of equally close ones the first by name) and its cosine, 0 at least.

        A null text, one without a letter, and every text if nothing was learned: ``und``, 0.
        The text itself isn't kept; all other columns are, but those named like the new ones.
        Each row is judged for itself.
        """
        me = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            space = Space(me.dim, me.seed, me.n)
            for b in batches:
                texts = b.column(0).to_pylist()
                if me.languages:
                    s = me.similarities(texts, space)
                    none = np.isnan(s).any(1)
                    best = np.where(none, 0, np.nan_to_num(s, nan=-1).argmax(1))
                    lang = [UNKNOWN if x else me.languages[k] for x, k in zip(none, best, strict=True)]
                    score = np.where(none, 0.0, np.clip(np.nan_to_num(s[np.arange(len(s)), best]), 0, 1))
                else:
                    lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*b.schema.names[1:], *into])

        rest = [c for c in docs.columns if c != text_col and c.lower() not in map(str.lower, into)]
        own = docs.select(F.col(f"`{text_col}`"), *[F.col(f"`{c}`") for c in rest])
        schema = T.StructType([*own.schema[1:], T.StructField(into[0], T.StringType()), T.StructField(into[1], T.DoubleType())])
        return map_arrow(own, run, schema)


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = Profiles().learn(docs.where(~held_out(F.col("doc_id"))))
    return profiles.predict(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"))
