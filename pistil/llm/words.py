"""Vectorised word splitting and hashing over the UTF-8 bytes of a whole Arrow column.

Words are maximal runs of bytes of a class. The classes used here hold either all or none of
the bytes of a multi-byte character, so splitting bytes equals splitting characters. A word
becomes a 64-bit hash of its (lower-cased) bytes; nothing is done per word in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}


def lower_table() -> np.ndarray:
    """Byte -> byte, A-Z lower-cased."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = lower_table()

#: Words of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Words of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing): digits, letters, non-ASCII.
WORD_BYTES = np.zeros(256, dtype=bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "pow" not in _tables or len(_tables["pow"]) < n:
        size = max(n, 1 << 19)
        with np.errstate(over="ignore"):
            for name, base in (("pow", _BASE), ("inv", _INVERSE)):
                t = np.ones(size, dtype=U64)
                t[1:] = U64(base)
                np.multiply.accumulate(t, out=t)
                _tables[name] = t
    return _tables["pow"][:n], _tables["inv"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@dataclass
class Words:
    """Words of consecutive rows ``lo..hi`` of a column."""
    lo: int                  # first row
    rows: int                # rows in this piece
    start: np.ndarray        # byte positions in ``buf``
    end: np.ndarray
    row: np.ndarray          # row of each word, from 0
    first: np.ndarray        # rows + 1 offsets into the words
    hash: np.ndarray         # uint64
    buf: np.ndarray          # bytes of these rows
    off: np.ndarray          # rows + 1 offsets into them


def pieces(col: pa.Array, piece_bytes: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, byte buffer, offsets)`` of runs of rows of about ``piece_bytes`` together
    (a longer single row makes a piece of its own). Null rows are empty."""
    if len(col) == 0:
        return
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    if col.null_count:
        keep = np.asarray(col.is_valid())
        length = np.where(keep, np.diff(off), 0)
        if int(length.sum()) != int(off[-1] - off[0]):      # null rows that hold bytes
            col = col.fill_null(b"")
            off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + piece_bytes, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def split_words(col: pa.Array, word_bytes: np.ndarray, piece_bytes: int = 1 << 19, fold_case: bool = True) -> Iterator[Words]:
    """Words of a ``large_binary`` column, a piece of rows at a time (bounded memory)."""
    for lo, buf, off in pieces(col, piece_bytes):
        n = len(off) - 1
        inside = np.zeros(len(buf) + 2, dtype=np.int8)
        inside[1:-1] = word_bytes[buf]
        edge = np.diff(inside)
        # a row's end also ends a word: cut runs that cross into the next row
        start_mark, end_mark = edge == 1, edge == -1
        cut = off[1:-1]
        cut = cut[(cut > 0) & (cut < len(buf))]
        both = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]
        start_mark[both] = True
        end_mark[both] = True
        start, end = np.flatnonzero(start_mark), np.flatnonzero(end_mark)
        first = np.searchsorted(start, off, side="left")
        row = np.repeat(np.arange(n), np.diff(first))
        yield Words(lo, n, start, end, row, first, hash_spans(buf, start, end, fold_case), buf, off)


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray, fold_case: bool = True) -> np.ndarray:
    """64-bit hash of each span of (by default lower-cased) bytes, from one running polynomial sum."""
    p, inv = _powers(len(buf) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(buf) + 1, dtype=U64)
        v = (LOWER[buf] if fold_case else buf).astype(U64)
        v += U64(1)
        v *= p[:len(buf)]
        np.cumsum(v, out=total[1:])
        h = total[end] - total[start]
        h *= inv[start]
        h += (end - start).astype(U64) * U64(0xD1342543DE82EF95)
        return mix(h)


def chain(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words (``len(h) - k + 1`` values)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for j in range(1, k):
            out *= U64(0x9FB21C651E98DF25)
            out = mix(out + h[j:j + n])
        return out


def fold(h: np.ndarray) -> int:
    """Hash of a whole word sequence that is shorter than a shingle (its length counts)."""
    out = 0x243F6A8885A308D3 + len(h)
    for x in h.tolist():
        out = int(mix(np.array([(out * 0x9FB21C651E98DF25 + x) & ((1 << 64) - 1)], dtype=U64))[0])
    return out
