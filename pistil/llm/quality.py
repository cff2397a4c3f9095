"""Quality rules as a bitmask ledger.

One pass over the texts takes a handful of measurements per document, every rule is evaluated once on
them, and the ledger keeps both: the measurements and one bit per rule, set where the document fails
it. A policy is a named version of "which bits drop a document"; applying another policy, or asking what
a rule adds to a policy (``ablations``), reads the ledger's bits only, never a text. Ablations first
count documents per distinct bit pattern (combined map-side; at most ``2 ** rules`` patterns, however many
documents), and every answer is bit arithmetic on those patterns.

Words are ``[^\\x20\\x09-\\x0D]+``, lines are split at line feeds. Measurements, all long:

* ``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (characters of ``[#*$%&|<>]``)
* ``n_lines`` (lines with a word), ``n_dup_lines`` (of those, lines equal to an earlier line)
* ``n_repeat_words`` (words in windows of three words that the text holds twice or more, the first included)
* ``n_letters`` and ``n_capitals`` (A-Z and a-z, and A-Z), ``n_plain_words`` (words that hold a byte of a letter: ASCII or
  any beyond ASCII)

Defined results: a null or empty text has all measurements 0; repeated rows get a row each; ids may be
null or repeat; other columns are ignored, whatever their names; empty input gives no rows. Texts are
compared by 64-bit hashes inside one document (lines, windows).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_package, table, text_column, written
from .words import NOT_SPACE, U64, chain, hash_spans, mix, split_words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_capitals",
            "n_plain_words")
WINDOW = 3
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[65:91] = True
_LETTER = _CAPITAL.copy()
_LETTER[97:123] = True
_WORDY = _LETTER.copy()
_WORDY[128:] = True


@dataclass(frozen=True)
class Rule:
    """A rule that a document fails where ``fails`` (SQL over the measurements) is true."""
    name: str
    fails: str


#: The position of a rule is its bit: new rules go to the end, old ones are never moved.
RULES: tuple[Rule, ...] = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("capitals", "100 * n_capitals > 40 * n_letters"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("few_plain_words", "100 * n_plain_words < 70 * n_words"),
)
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A version of the filter: any rule of ``veto`` drops a document, and so do more than ``allowed``
    failed rules of ``counted``."""
    version: str
    veto: tuple[str, ...]
    counted: tuple[str, ...] = ()
    allowed: int = 0


POLICIES = {p.version: p for p in (
    Policy("base", BASE),
    Policy("lenient", BASE, tuple(r.name for r in RULES[2:]), allowed=1),
    Policy("strict", tuple(r.name for r in RULES)),
)}


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    """The bits of some rules."""
    place = {r.name: i for i, r in enumerate(rules)}
    unknown = [n for n in names if n not in place]
    if unknown:
        raise ValueError(f"unknown rules {unknown}; known: {sorted(place)}")
    return sum(1 << place[n] for n in set(names))


def _per_row(marks: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of set marks in each row of ``off``."""
    out = np.zeros(len(off) - 1, dtype=np.int64)
    filled = np.flatnonzero(np.diff(off))
    if len(filled):
        out[filled] = np.add.reduceat(marks, off[filled], dtype=np.int64)
    return out


def _surplus(key: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """How many entries of each row repeat an earlier entry with the same key and row."""
    key = key ^ mix(row.astype(U64))
    once = np.unique(key, return_index=True)[1]
    return np.bincount(row, minlength=rows) - np.bincount(row[once], minlength=rows)


def _repeat_words(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Words of each row inside windows that the row holds at least twice."""
    n = len(h) - WINDOW + 1
    if n <= 0:
        return np.zeros(rows, dtype=np.int64)
    whole = np.flatnonzero(row[:n] == row[WINDOW - 1:])
    key = chain(h, WINDOW)[whole] ^ mix(row[whole].astype(U64))
    _, at, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = whole[count[at] > 1]
    edge = np.zeros(len(h) + 1, dtype=np.int32)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    return np.bincount(row[np.cumsum(edge)[:-1] > 0], minlength=rows)


def measure(col: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """``(first row, [measurements])`` of pieces of a ``large_binary`` column."""
    for w in split_words(col, NOT_SPACE, fold_case=False):
        buf, rows = w.buf, w.rows
        off = w.off
        breaks = np.flatnonzero(buf == 10)
        start = np.union1d(off[:-1], breaks + 1)
        start = start[start < len(buf)]
        row = np.searchsorted(off, start, side="right") - 1
        end = np.append(breaks, len(buf))[np.searchsorted(breaks, start)]
        end = np.minimum(end, off[row + 1])
        wordy = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
        start, end, row = start[wordy], end[wordy], row[wordy]
        line = hash_spans(buf, start, end, fold_case=False)
        plain = np.zeros(0, dtype=np.int64)
        if len(w.start):
            spans = np.ravel(np.column_stack([w.start, w.end]))
            marks = np.append(_WORDY[buf], False)            # reduceat needs every bound inside
            plain = np.bitwise_or.reduceat(marks, spans)[::2]
        yield w.lo, [np.diff(w.first), _per_row(NOT_SPACE[buf] & ((buf & 0xC0) != 0x80), off), _per_row(_SYMBOL[buf], off),
                     np.bincount(row, minlength=rows), _surplus(line, row, rows), _repeat_words(w.hash, w.row, rows),
                     _per_row(_LETTER[buf], off), _per_row(_CAPITAL[buf], off),
                     np.bincount(w.row[plain.astype(bool)], minlength=rows) if len(plain) else np.zeros(rows, np.int64)]


def failed_bits(rules: Sequence[Rule] = RULES) -> Column:
    """One long with the bit of every failed rule, from the measurements."""
    bits = F.lit(0).cast("long")
    for i, r in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``id``, the measurements and ``failed`` (the bits) of every row of ``docs``."""
    if len(rules) > 63:
        raise ValueError("a ledger has room for 63 rules")
    ship_package(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, got in measure(text_column(b, "text")):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, len(got[0])), *(pa.array(x, pa.int64()) for x in got)],
                                                 ["id", *MEASURES])

    measured = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    return measured.withColumn("failed", failed_bits(rules))


def passes(policy: str | Policy, rules: Sequence[Rule] = RULES, bits: str | Column = "failed") -> Column:
    """True where a policy keeps the document of these bits."""
    p = POLICIES[policy] if isinstance(policy, str) else policy
    bits = F.col(bits) if isinstance(bits, str) else bits
    kept = bits.bitwiseAND(F.lit(mask(p.veto, rules))) == 0
    if p.counted:
        kept = kept & (F.bit_count(bits.bitwiseAND(F.lit(mask(p.counted, rules)))) <= p.allowed)
    return kept


def patterns(ledger: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``failed, n``: documents per distinct bit pattern (and per value of the columns ``by``)."""
    return ledger.groupBy(*by, "failed").agg(F.count("*").alias("n"))


def ablations(ledger: DataFrame, policy: str | Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per rule: ``rule``, ``n_failed`` (documents that fail it), ``n_kept`` (kept by the policy),
    ``n_kept_without`` (kept by the policy with this rule taken out) and ``n_only`` (the difference: dropped by
    nothing but this rule); all long. An empty ledger has zeros."""
    spark = ledger.sparkSession
    names = spark.createDataFrame([(r.name, 1 << i) for i, r in enumerate(rules)], "rule string, bit long")
    seen = patterns(ledger)
    without = F.col("failed").bitwiseAND(F.bitwise_not("bit"))
    # rules x patterns: both small (at most 63, and 2 ** rules), one aggregate
    each = seen.select("failed", "n", F.explode(F.array(*[F.lit(1 << i).cast("long") for i in range(len(rules))])).alias("bit"))
    counts = each.groupBy("bit").agg(
        F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(passes(policy, rules), F.col("n")).otherwise(0)).alias("n_kept"),
        F.sum(F.when(passes(policy, rules, without), F.col("n")).otherwise(0)).alias("n_kept_without"))
    full = names.join(counts, "bit", "left").select(
        "rule", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("n_failed", "n_kept", "n_kept_without")])
    return full.withColumn("n_only", F.col("n_kept_without") - F.col("n_kept"))


POLICY = "strict"


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all ``documents`` and the verdict of the policy ``strict``."""
    rows = written(ledger(table(spark, sf_dir, "documents")), "quality_ledger")
    return rows.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (F.col("failed").bitwiseAND(F.lit(mask(BASE))) != 0).alias("base_failed"),
                       passes(POLICY).alias("kept"), "failed")


_BITS = " + ".join(f"CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END" for i, r in enumerate(RULES))
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
word AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
per_word AS (SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars,
                    count(*) FILTER (WHERE regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]')) AS n_plain_words
             FROM word GROUP BY rid),
line AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
per_line AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
             FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
spot AS (SELECT rid, i, word AS w1, lead(word) OVER row AS w2, lead(word, 2) OVER row AS w3 FROM word
         WINDOW row AS (PARTITION BY rid ORDER BY i)),
win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w1, w2, w3) AS n FROM spot WHERE w3 IS NOT NULL),
cov AS (SELECT DISTINCT rid, unnest([i, i + 1, i + 2]) AS p FROM win WHERE n > 1),
per_win AS (SELECT rid, count(*) AS n_repeat_words FROM cov GROUP BY rid),
m AS (SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
             length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
             coalesce(n_plain_words, 0) AS n_plain_words
      FROM d LEFT JOIN per_word USING (rid) LEFT JOIN per_line USING (rid) LEFT JOIN per_win USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & {mask(BASE)}) <> 0 AS base_failed, (failed & {mask(POLICIES[POLICY].veto)}) = 0 AS kept, failed
FROM (SELECT *, CAST({_BITS} AS BIGINT) AS failed FROM m)
"""
