"""Language identification by prediction by partial matching (PPM).

Each language has a context tree over bytes of depth 0 to 3 with escape probabilities
(method C: a context seen T times with D different symbols gives a symbol seen c times
c / (T + D) and escapes to the next shorter context with D / (T + D)). The statistics are
frozen after training, and a text's exact code length in bits under each language decides.
Contexts that a language never saw cost nothing to leave. Below depth 0, symbols are uniform.

Symbols are all bytes, A-Z lower-cased, so scripts of any kind keep their own statistics and any byte string has a
code length. Each text starts in a context of three blanks. The trees are sorted tables of the (context,
symbol) codes that occur, looked up in hash tables; what the tasks get grows with the codes of the training sample.

Trees are learned from a bounded sample: of each language about ``sample_docs`` documents,
chosen by a hash of their id among all its labelled training rows.

Defined results: a text that is null or holds no letter (no character of a Unicode letter class) is
``und`` with score 0; so is every text when nothing could be learned. The score is the posterior of the
predicted language under equal priors; ties go to the name that sorts first. Rows without an id
are not held out and not learned from. Repeated rows get the same answer each. Columns of the
input named like an output column are replaced.

The pipeline's stage drops what is ``und`` and texts of ``LEAST_BYTES`` bytes or more that the best language's tree
does not code in fewer than ``MOST_BITS`` bits a byte: text like none of the learned languages (random bytes take 7.8).
Without any labelled row nothing can be told apart, and all texts with a letter stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, lean, ship_package, table, text_column
from .words import LOWER, pieces

UND = "und"
DEPTH = 3
SYMBOLS = 256 - 26               # bytes that are left once A-Z are lower-cased
SAMPLE_DOCS = 3000
PIECE_BYTES = 1 << 19
MOST_BITS, LEAST_BYTES = 7.0, 200
BLANK = 32
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def held_out(id_col: str) -> Column:
    """True for the quarter of ids that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _symbol_codes(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """For each byte the byte itself and the three before it (of the same row), 8 bits each."""
    rows = len(off) - 1
    padded = np.full(len(buf) + DEPTH * rows, BLANK, dtype=np.uint32)
    at = np.arange(len(buf)) + DEPTH * (1 + np.repeat(np.arange(rows), np.diff(off)))
    padded[at] = LOWER[buf]
    code = padded[DEPTH:].copy()
    for j in range(1, DEPTH + 1):
        code |= padded[DEPTH - j:len(padded) - j] << np.uint32(8 * j)
    return code[at - DEPTH]


class Slots:
    """Place (from 1; 0: absent) of codes in a sorted table, by open addressing."""

    def __init__(self, keys: np.ndarray):
        keys = keys.astype(np.uint32)
        self.width = max(4, int(4 * len(keys)).bit_length())
        self.key = np.zeros(1 << self.width, dtype=np.uint32)
        self.slot = np.zeros(1 << self.width, dtype=np.int32)
        todo, at = np.arange(len(keys)), self._first(keys)
        while len(todo):
            free = np.flatnonzero(self.slot[at] == 0)
            mine = free[np.unique(at[free], return_index=True)[1]]
            self.slot[at[mine]] = todo[mine] + 1
            self.key[at[mine]] = keys[todo[mine]]
            rest = np.ones(len(todo), dtype=bool)
            rest[mine] = False
            todo, at = todo[rest], self._next(at[rest])

    def _first(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.width)).astype(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.width) - 1)

    def of(self, codes: np.ndarray) -> np.ndarray:
        at = self._first(codes)
        found = self.slot[at]
        open_ = np.flatnonzero((found > 0) & (self.key[at] != codes))
        found[open_] = 0
        at = self._next(at[open_])
        while len(open_):
            s = self.slot[at]
            hit = (s > 0) & (self.key[at] == codes[open_])
            found[open_[hit]] = s[hit]
            go = (s > 0) & ~hit
            open_, at = open_[go], self._next(at[go])
        return found


@dataclass
class Model:
    """Tables per depth, one column a language. ``bits``, ``bits2`` and ``escape`` have a first row for codes never seen."""
    languages: list[str]
    codes: np.ndarray         # (context, symbol) of depth 3 seen in any language, sorted
    bits: np.ndarray          # code lengths
    contexts: np.ndarray      # contexts of depth 3, sorted
    escape: np.ndarray        # bits to leave one
    codes2: np.ndarray        # the same of depth 2
    bits2: np.ndarray
    escape2: np.ndarray       # by context of depth 2
    bits1: np.ndarray         # by (context, symbol) of depth 1


def _counted(context: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Total plus kinds of each context, its kinds, and bits to leave it (0 where it was never seen)."""
    kinds = np.bincount(context, minlength=size)
    total = np.bincount(context, weights=count, minlength=size) + kinds
    escape = np.zeros(size)
    known = kinds > 0
    escape[known] = -np.log2(kinds[known] / total[known])
    return total, kinds, escape


def fit_trees(languages: list[str], lang: np.ndarray, code: np.ndarray, count: np.ndarray) -> Model:
    """Code lengths of every seen context, from counts of depth-3 codes (one row each)."""
    n = len(languages)
    code = code.astype(np.int64)
    codes, contexts, codes2 = np.unique(code), np.unique(code >> 8), np.unique(code & 0xFFFFFF)
    bits, escape = np.zeros((len(codes) + 1, n), np.float32), np.zeros((len(contexts) + 1, n), np.float32)
    bits2, escape2 = np.zeros((len(codes2) + 1, n), np.float32), np.zeros((1 << 16, n), np.float32)
    bits1 = np.zeros((1 << 16, n), np.float32)
    for k in range(n):
        mine = lang == k
        c, m = code[mine], count[mine].astype(np.float64)
        length = np.full(256, np.log2(SYMBOLS))                 # below depth 0: uniform
        for depth in (0, 1):
            seen = np.bincount(c & ((1 << 8 * (depth + 1)) - 1), weights=m, minlength=1 << 8 * (depth + 1))
            at = np.flatnonzero(seen)
            total, _, leave = _counted(at >> 8, seen[at], 1 << 8 * depth)
            below = np.tile(length, 1 << 8 * depth) + np.repeat(leave, 256)
            below[at] = -np.log2(seen[at] / total[at >> 8])
            length = below if depth else below[:256]
        bits1[:, k] = length
        pair, inverse = np.unique(c & 0xFFFFFF, return_inverse=True)
        seen = np.bincount(inverse, weights=m)
        total, _, leave = _counted(pair >> 8, seen, 1 << 16)
        escape2[:, k] = leave
        bits2[1:, k] = leave[codes2 >> 8] + length[codes2 & 0xFFFF]
        bits2[1 + np.searchsorted(codes2, pair), k] = -np.log2(seen / total[pair >> 8])
        own, inverse = np.unique(c >> 8, return_inverse=True)
        total, _, leave = _counted(inverse, m, len(own))
        escape[1 + np.searchsorted(contexts, own), k] = leave
        bits[1:, k] = escape[1 + np.searchsorted(contexts, codes >> 8), k] + bits2[1 + np.searchsorted(codes2, codes & 0xFFFFFF), k]
        bits[1 + np.searchsorted(codes, c), k] = -np.log2(m / total[inverse])
    return Model(languages, codes.astype(np.uint32), bits, contexts.astype(np.uint32), escape, codes2.astype(np.uint32), bits2, escape2, bits1)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from the rows of ``docs`` with a text and a language (held-out rows excluded)."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")
                       ).where("id is not null and text is not null and lang is not null").where(~held_out("id"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], *(np.zeros(0),) * 8)
    share = F.create_map(*[F.lit(x) for k in languages
                           for x in (k, min(1.0, sample_docs / counts[k]))])
    number = F.create_map(*[F.lit(x) for i, k in enumerate(languages) for x in (k, i)])
    draw = F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string"), F.lit("ppm")), 11) / F.lit(float(1 << 53))
    sample = (rows.where(draw < share[F.col("lang")])
                  .select("text", number[F.col("lang")].alias("k")))

    def count_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang = np.asarray(b.column(1))
            for lo, buf, off in pieces(text_column(b, "text"), PIECE_BYTES):
                code = _symbol_codes(buf, off).astype(np.int64)
                key = code + (np.repeat(lang[lo:lo + len(off) - 1], np.diff(off)).astype(np.int64) << 32)
                key, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    # at most sample_docs texts a language: the table of distinct codes is as bounded as the sample
    got = (sample.mapInArrow(lean(count_codes), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
                 .toArrow())
    key, n = np.asarray(got.column("key")), np.asarray(got.column("n"))
    return fit_trees(languages, key >> 32, key & 0xFFFFFFFF, n)


Tables = tuple[Slots, Slots, Slots]


def tables(model: Model) -> Tables:
    """Hash tables of a model's codes; a task makes them and drops them at its end."""
    return Slots(model.codes), Slots(model.contexts), Slots(model.codes2)


def code_lengths(model: Model, buf: np.ndarray, off: np.ndarray, slots: Tables | None = None) -> np.ndarray:
    """Bits of each row under each language."""
    codes, contexts, codes2 = slots or tables(model)
    code = _symbol_codes(buf, off)
    slot = codes.of(code)
    out = np.zeros((len(off) - 1, len(model.languages)))
    miss = np.flatnonzero(slot == 0)
    code = code[miss]
    miss_row = np.searchsorted(off, miss, side="right") - 1
    left, shorter = contexts.of(code >> np.uint32(8)), codes2.of(code & np.uint32(0xFFFFFF))
    none = shorter == 0
    filled = np.flatnonzero(np.diff(off))
    for k in range(len(model.languages)):
        if len(filled):
            out[filled, k] = np.add.reduceat(model.bits[:, k][slot], off[filled], dtype=np.float64)
        rest = model.bits2[:, k][shorter].astype(np.float64)
        rest[none] = model.escape2[:, k][(code[none] >> np.uint32(8)) & np.uint32(0xFFFF)] + model.bits1[:, k][code[none] & np.uint32(0xFFFF)]
        out[:, k] += np.bincount(miss_row, weights=model.escape[:, k][left] + rest, minlength=len(out))
    return out


def _has_letter(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    rows = len(off) - 1
    row = np.repeat(np.arange(rows), np.diff(off))
    letter = np.bincount(row[_ASCII_LETTER[buf]], minlength=rows) > 0
    for i in np.flatnonzero(~letter).tolist():
        letter[i] = any(c.isalpha() for c in buf[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace"))
    return letter


def predict(docs: DataFrame, model: Model, text_col: str = "text", pred_col: str = "lang_pred",
            score_col: str = "score", bits_col: str | None = None) -> DataFrame:
    """All columns of ``docs`` plus ``pred_col`` and ``score_col``, and with ``bits_col`` the best language's bits
    a byte (null for an empty text or without languages)."""
    spark = docs.sparkSession
    ship_package(spark)
    more = [pred_col, score_col, *[bits_col] * bool(bits_col)]
    docs = docs.drop(*more)
    shared = spark.sparkContext.broadcast(model)      # bounded by the training sample
    schema = T.StructType([*docs.schema.fields, T.StructField(pred_col, T.StringType()),
                           *[T.StructField(c, T.DoubleType()) for c in more[1:]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, UND], dtype=object)
        slots = tables(m) if m.languages else None
        for b in batches:
            pred, score, rate = np.full(len(b), len(m.languages)), np.zeros(len(b)), np.full(len(b), np.nan)
            if m.languages:
                for lo, buf, off in pieces(text_column(b, text_col), PIECE_BYTES):
                    bits = code_lengths(m, buf, off, slots)
                    best = bits.argmin(1)
                    ok = _has_letter(buf, off)
                    rel = np.exp2(np.minimum(bits.min(1, keepdims=True) - bits, 0.0)).sum(1)
                    pred[lo:lo + len(ok)] = np.where(ok, best, len(m.languages))
                    score[lo:lo + len(ok)] = np.where(ok, 1.0 / rel, 0.0)
                    size = np.diff(off)
                    rate[lo:lo + len(ok)] = np.where(size > 0, bits.min(1) / np.maximum(size, 1), np.nan)
            made = [pa.array(names[pred], pa.string()), pa.array(score), pa.array(rate, from_pandas=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, *made[:len(more)]], [*b.schema.names, *more])

    return docs.mapInArrow(lean(run), schema)


def op7_ppm_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs)
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose text is in one of the learned languages."""
    model = train(docs)
    pred, score, rate = (free_name(docs.columns, c) for c in ("lang_pred", "score", "bits_per_byte"))
    found = predict(docs, model, pred_col=pred, score_col=score, bits_col=rate)
    if not model.languages:                       # nothing to tell languages by
        return docs.where(F.col("text").rlike("\\p{L}"))
    alien = (F.octet_length("text") >= LEAST_BYTES) & (F.col(rate) >= MOST_BITS)
    return found.where((F.col(pred) != UND) & ~alien).select(*docs.columns)
