"""Periodic runs of words by string synchronising sets.

A run is a stretch of consecutive words of a text with smallest period q (words q apart are identical) and at
least ``max(min_length, 2 q)`` words that no neighbouring word extends. All runs of a text are found, exactly:

* periods under 12 by comparing the words with themselves q places on;
* for every t = 4, 8, 16, ... periods from 3t to 6t. Position i is *selected* at scale t if, among the stretches
  of t words that start at i, i+1, ..., i+t and have no period of t/3 or less, the smallest hash is at i or
  i+t. That depends on the 2t words from i on only (its context), so a run of period q selects the same
  places in every repetition. Selected positions with equal contexts 3t to 6t apart propose
  their distance as a period; equal contexts are more than t/3 apart, so there are at most 18 such
  partners each, and the selected positions thin out with t;
* a run none of whose repetitions holds a selected position is a stretch of small period u <= t/3 that meets
  a second one of the same repeating unit. These stretches are known by then (they are runs of smaller
  scales); where two with one unit meet, the distances that align their phases are proposed.

Every proposal is extended to both sides as far as words agree (binary search over running hashes of the
text). Stretches found with several periods keep the smallest, which divides the others.

Texts are handled a piece of about 512 KB at a time, all steps vectorised over all texts of the piece; a unique
word between texts keeps periods apart. Words are ``[^\\x20\\x09-\\x0D]+``, compared by 64-bit hashes, longer
stretches by 62-bit hashes.

Defined results: a null text or one without words has no runs and an empty collapsed text; repeated rows get a row
each, ids may be null or repeat; other columns are ignored, whatever their names; empty input gives no rows.
A single text is handled in one task, in memory of about 30 times its words' number of 8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_array, ship_package, table, text_column
from .words import NOT_SPACE, U64, Words, mix, split_words

MIN_LENGTH = 12
FIRST_SCALE = 4
DIRECT = 3 * FIRST_SCALE          # smaller periods are compared directly
# Two primes under 2^31 and a base for each.
_PRIMES = (2147483647, 2147483629)
_BASES = (1103515245, 826366247)
_NEVER = U64(0xFFFFFFFFFFFFFFFF)


def _power_table(base: int, p: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint32)
    size, step = 1, base % p
    while size < n:                                    # doubling: out[size:2 size] = out[:size] * base ** size
        more = min(size, n - size)
        out[size:size + more] = out[:more].astype(U64) * U64(step) % U64(p)
        size, step = size + more, step * step % p
    return out


class Hashes:
    """Running hashes of a sequence of words: equal stretches have equal hashes wherever they start."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.n, self.sums, self.powers, self.inverse = n, [], [], []
        for p, base, shift in zip(_PRIMES, _BASES, (U64(0), U64(29))):
            power = _power_table(base, p, n + 1)
            v = (words >> shift) % U64(p) * power[:n] % U64(p)
            s = np.zeros(n + 1, dtype=np.uint32)
            s[1:] = np.cumsum(v, dtype=U64) % U64(p)
            self.sums.append(s)
            self.powers.append(power)
            self.inverse.append(_power_table(pow(base, -1, p), p, n + 1))

    def of(self, at: np.ndarray, length) -> np.ndarray:
        """Hash of the ``length`` words from each position on."""
        out = None
        for p, s, inv in zip(_PRIMES, self.sums, self.inverse):
            h = (s[at + length].astype(U64) + U64(p) - s[at]) % U64(p) * inv[at] % U64(p)
            out = h if out is None else (out << U64(31)) | h
        return mix(out)

    def same(self, a: np.ndarray, b: np.ndarray, length) -> np.ndarray:
        """Whether the ``length`` words from ``a`` and from ``b >= a`` on are equal."""
        ok = np.ones(len(a), dtype=bool)
        for p, s, power in zip(_PRIMES, self.sums, self.powers):
            left = (s[a + length].astype(U64) + U64(p) - s[a]) % U64(p) * power[b - a] % U64(p)
            ok &= left == (s[b + length].astype(U64) + U64(p) - s[b]) % U64(p)
        return ok

    def extent(self, a: np.ndarray, q: np.ndarray, room: np.ndarray, ahead: bool) -> np.ndarray:
        """How many words from ``a`` on (or before ``a``) equal those ``q`` further on, up to ``room``."""
        got = np.zeros(len(a), dtype=np.int64)
        if not len(a):
            return got
        step = 1 << int(room.max()).bit_length()
        while step:
            fits = np.flatnonzero(got + step <= room)
            if len(fits):
                at = a[fits] + got[fits] if ahead else a[fits] - got[fits] - step
                fits = fits[self.same(at, at + q[fits], step)]
                got[fits] += step
            step >>= 1
        return got


def _stretches(equal: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretches with period ``q``, from where a word equals the one q on."""
    edge = np.diff(np.concatenate([[0], equal.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + q


class Found:
    """Stretches (start, end, period) found so far, each once with its smallest period."""

    def __init__(self):
        self.start = self.end = self.period = np.zeros(0, dtype=np.int64)

    def add(self, start, end, period) -> None:
        start, end, period = (np.concatenate([a, np.broadcast_to(b, np.shape(start))]).astype(np.int64) for a, b in
                              ((self.start, start), (self.end, end), (self.period, period)))
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        first = np.ones(len(start), dtype=bool)
        first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        self.start, self.end, self.period = start[first], end[first], period[first]


def _selected(hash_t: np.ndarray, low: np.ndarray, t: int) -> np.ndarray:
    """Mask of the positions selected at scale ``t``; ``low`` marks stretches of a small period."""
    h = hash_t.copy()
    h[low] = _NEVER
    n = len(h) - t
    if n <= 0:
        return np.zeros(0, dtype=bool)
    least, width = h, 1
    while width < t:                                   # minimum over t, then t + 1, positions
        least = np.minimum(least[:len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[:n], h[t:])
    return (least != _NEVER) & ((least == h[:n]) | (least == h[t:]))


def _merge(at: np.ndarray, q: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last position of proposals of one period that follow within ``reach`` of each other."""
    order = np.lexsort((at, q))
    at, q = at[order], q[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (q[1:] != q[:-1]) | (at[1:] - at[:-1] > reach)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[:len(first)] - 1
    return at[first], at[last], q[first]


def _pairs(position: np.ndarray, context: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """``(position, distance)`` of equal contexts 3t to 6t apart."""
    order = np.lexsort((position, context))
    position, context = position[order], context[order]
    at, dist, lag = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 1
    while lag < len(position):
        d = position[lag:] - position[:-lag]
        near = (context[lag:] == context[:-lag]) & (d < 6 * t)
        if not near.any():
            break
        take = np.flatnonzero(near & (d >= 3 * t))
        at.append(position[take])
        dist.append(d[take])
        lag += 1
    return np.concatenate(at), np.concatenate(dist)


def _expand(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts (2, 0, 3): owners 0 0 2 2 2 and numbers 0 1 0 1 2."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)


def _meeting(found: Found, hashes: Hashes, t: int) -> tuple[np.ndarray, np.ndarray]:
    """``(position, period)`` proposed where two stretches of one small unit meet: periods 3t to 6t."""
    none = np.zeros(0, dtype=np.int64)
    use = np.flatnonzero((found.period <= t // 3) & (found.end - found.start >= 3 * t))
    order = use[np.lexsort((found.start[use], found.period[use]))]
    s, e, u = found.start[order], found.end[order], found.period[order]
    a = np.flatnonzero((u[1:] == u[:-1]) & (s[1:] <= e[:-1])) if len(u) > 1 else none
    if not len(a):
        return none, none
    s1, e1, s2, e2, u = s[a], e[a], s[a + 1], e[a + 1], u[a]
    # the place in the first unit of the left stretch where the right one's unit starts
    owner, m = _expand(u)
    fits = hashes.of(s1[owner] + m, u[owner]) == hashes.of(s2[owner], u[owner])
    owner, m = owner[fits], m[fits]
    s1, e1, s2, e2, u = s1[owner], e1[owner], s2[owner], e2[owner], u[owner]
    most = np.minimum(np.minimum(e1 - s1, e2 - s2), 6 * t - 1)
    q0 = 3 * t + (s2 - s1 - m - 3 * t) % u             # smallest q >= 3t that aligns the phases
    owner, j = _expand(np.maximum(0, (most - q0) // u + 1))
    q = q0[owner] + j * u[owner]
    return np.maximum(s1[owner], s2[owner] - q), q


def find(words: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, ...]:
    """``text, start, length, period`` of all runs of texts whose words are ``words[first[i]:first[i + 1]]``,
    sorted by text, start, period."""
    rows = len(first) - 1
    size = np.diff(first)
    # a word of its own after every text
    text = np.repeat(np.arange(rows), size)
    begin = first[:-1] + np.arange(rows)
    seq = mix(np.arange(len(words) + rows, dtype=U64) + U64(0x2545F4914F6CDD1D))
    seq[np.arange(len(words)) + text] = words
    ends = begin + size
    text = np.repeat(np.arange(rows), size + 1)
    found = Found()
    for q in range(1, min(DIRECT, len(seq))):
        start, end = _stretches(seq[q:] == seq[:-q], q)
        keep = end - start >= max(3, 2 * q)
        found.add(start[keep], end[keep], q)
    hashes, t = None, FIRST_SCALE
    while size.size and 6 * t <= size.max():
        hashes = hashes or Hashes(seq)
        long = np.flatnonzero(size >= 6 * t)           # only texts with room for a period of 3t
        owner, off = _expand(size[long] + 1)
        pos = begin[long][owner] + off
        at = np.minimum(pos, hashes.n - t)
        low = np.zeros(hashes.n + 1, dtype=np.int32)
        use = (found.period <= t // 3) & (found.end - found.start >= t)
        np.add.at(low, found.start[use], 1)
        np.add.at(low, found.end[use] - t + 1, -1)
        sel = np.flatnonzero(_selected(hashes.of(at, t), (np.cumsum(low)[:-1] > 0)[pos], t))
        sel = pos[sel[pos[sel] + 2 * t <= ends[text[pos[sel]]]]]
        i, q = _pairs(sel, hashes.of(sel, 2 * t), t)
        lo, hi, period = _merge(i, q, 2 * t)
        i, q = _meeting(found, hashes, t)
        lo, hi, period = np.concatenate([lo, i]), np.concatenate([hi, i]), np.concatenate([period, q])
        start = lo - hashes.extent(lo, period, lo - begin[text[lo]], ahead=False)
        end = hi + period + hashes.extent(hi, period, ends[text[hi]] - hi - period, ahead=True)
        keep = end - start >= 2 * period
        found.add(start[keep], end[keep], period[keep])
        t *= 2
    keep = found.end - found.start >= np.maximum(min_length, 2 * found.period)
    start, end, period = found.start[keep], found.end[keep], found.period[keep]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    return text[start], start - begin[text[start]], end - start, period


def repeated_words(words: int, first: np.ndarray, found: tuple[np.ndarray, ...]) -> np.ndarray:
    """Mask of the words inside any run after that run's first period."""
    text, start, length, period = found
    edge = np.zeros(words + 1, dtype=np.int32)
    np.add.at(edge, first[text] + start + period, 1)
    np.add.at(edge, first[text] + start + length, -1)
    return np.cumsum(edge)[:-1] > 0


def _join(w: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of the chosen words (numbers, row by row), joined by one blank in each row."""
    row = w.row[chosen]
    length = w.end[chosen] - w.start[chosen]
    last = np.ones(len(row), dtype=bool)
    last[:-1] = row[1:] != row[:-1]
    wide = length + ~last
    off = np.zeros(w.rows + 1, dtype=np.int64)
    off[1:] = np.cumsum(np.bincount(row, weights=wide, minlength=w.rows)).astype(np.int64)
    out = np.full(int(off[-1]), 32, dtype=np.uint8)
    owner, j = _expand(length)
    out[(np.cumsum(wide) - wide)[owner] + j] = w.buf[w.start[chosen][owner] + j]
    return out, off


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``id, runs, collapsed`` of every row: all runs by start, then period, and the words outside repetitions
    (a word goes if a run holds it after that run's first period), joined by one blank."""
    ship_package(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in split_words(text_column(b, "text"), NOT_SPACE, fold_case=False):
                found = find(w.hash, w.first, min_length)
                text, start, length, period = found
                kept = np.flatnonzero(~repeated_words(len(w.hash), w.first, found))
                runs = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(text, np.arange(w.rows + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (start, length, period)],
                                               ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(w.lo, w.rows), runs, binary_array(*_join(w, kept)).cast(pa.large_string()).cast(pa.string())],
                    ["id", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, runs array<{RUN}>, collapsed string")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where a tenth of the texts (by the id's crc32 h) repeats p of its words from word a on:
    a = g mod n, p = 1 + floor((n - a) / (3 + g mod 8)), g = floor(h / 10)."""
    ship_package(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in split_words(text_column(b, "text"), NOT_SPACE, fold_case=False):
                source = np.arange(len(w.hash))
                for r in range(w.rows):
                    lo, n = int(w.first[r]), int(w.first[r + 1] - w.first[r])
                    doc_id = b.column(0)[w.lo + r].as_py()
                    g, rest = divmod(crc32(str(doc_id).encode()), 10)
                    if rest == 0 and n and doc_id is not None:
                        a = g % n
                        p = 1 + (n - a) // (3 + g % 8)
                        source[lo + a:lo + n] = lo + a + np.arange(n - a) % p
                text = binary_array(*_join(w, source)).cast(pa.large_string()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(w.lo, w.rows), text], ["doc_id", "text"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, text string")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs of every text of ``documents``, a tenth of which get planted periods first."""
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"),
                                                                  (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                                            r["period"].cast("string")), F.lit("\n"))), "")
    return (found.select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"),
                         F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
                 .select("doc_id", "n_runs", (-F.col("longest.s")).alias("start"), F.col("longest.length").alias("length"),
                         (-F.col("longest.p")).alias("period"),
                         F.expr("1000 * longest.length div -longest.p").alias("exponent_milli"),
                         "runs_sha256", "collapsed_sha256"))
