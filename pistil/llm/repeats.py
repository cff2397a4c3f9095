"""Repeated byte strings across documents by a distributed enhanced suffix array.

Every string of ``size`` bytes has an anchor: the smallest hash among its ``gram``-byte
substrings. Consecutive strings with one anchor hash form a stretch, so equal strings lie in
stretches of equal anchor hash, wherever they occur, and only those have to meet.

1. Documents are stored in segments (about 1 MB of whole documents, at least one).
2. Segments send their anchor hashes (5 bytes each) to buckets, which answer a bit each: met in
   another segment or not. Stretches whose anchor occurs in one document only are done.
3. Of the others, a segment sends each distinct stretch once, with the smallest id it has for it
   (so a passage of very many documents is combined before it is shuffled). In its bucket, the
   suffixes of all distinct stretches that share strings are sorted, neighbours' common prefixes
   are taken, and a stack scan of these gives the tree of common-prefix intervals. An interval
   whose occurrences have different bytes on their left is a maximal repeat, with all its
   occurrences; one whose occurrences all extend to the left is part of a longer one. Each
   repeat passes its smallest id on to the strings it covers. Suffixes are compared to two string lengths: a
   repeat that goes on beyond that is output window by window, each with all its occurrences, and is not
   left to a longer one, so every string of it gets the smallest id too, and a stretch of n equal
   bytes costs n windows and not n nested repeats.
4. Segments read the answers and remove every byte covered by a string that also starts in a
   document with a smaller id.

Nothing is indexed but stretches, and no task holds more than a segment or a bucket. Buckets
grow with the number of segments that hold a passage, not with its copies.

Defined results: a null text is empty; texts shorter than ``size`` lose nothing; matches never cross
documents; rows that repeat an id do not remove each other's bytes (no id is smaller); rows
without an id come after all ids and remove nothing. Other columns pass through, and those that
are named like an output column are replaced. Empty input gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import file_system, free_name, lean, scratch_path, ship_package, table, text_column
from .words import U64, hash_spans, mix, pieces

SIZE, GRAM = 50, 20
SEGMENT_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20           # text bytes a bucket answers for
STEP = 1 << 20                   # string marks made at once
CHUNK = 1 << 17                  # suffixes of a bucket that are indexed at once
NO_ID = np.iinfo(np.int64).max


# ---------------------------------------------------------------- stretches of a segment

def rolling_hash(buf: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k``-byte substring, by doubling."""
    with np.errstate(over="ignore"):
        n, power = 1, U64(0x9E3779B97F4A7C15)
        cur, out, have = buf.astype(U64) + U64(1), None, 0
        while True:
            if k & n:                                  # put the piece of n bytes behind what there is
                m = len(buf) - k + 1
                piece = cur[have:have + max(m, 0)]
                out = piece.copy() if out is None else out * power + piece
                have += n
            if 2 * n > k:
                break
            cur = cur[:-n] * power + cur[n:] if len(cur) > n else cur[:0]
            power, n = power * power, 2 * n
        return mix(out)


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    n, cur = 1, h
    while 2 * n <= w:
        cur, n = np.minimum(cur[:-n], cur[n:]), 2 * n
    m = max(0, len(h) - w + 1)
    return np.minimum(cur[:m], cur[w - n:w - n + m])


class Stretches:
    """Stretches of one segment: ``start``/``end`` of the strings' first bytes, row, anchor key,
    and a number for each distinct content."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, size: int, gram: int):
        n = len(buf) - size + 1
        empty = np.zeros(0, dtype=np.int64)
        self.start = self.end = self.row = empty
        self.key = self.content = np.zeros(0, dtype=U64)
        if n <= 0:
            return
        low = sliding_min(rolling_hash(buf, gram), size - gram + 1)
        open_ = np.zeros(n + 1, dtype=np.int32)        # no string starts near the end of its row
        for sign, at in ((1, np.maximum(off[1:] - size + 1, off[:-1])), (-1, off[1:])):
            np.add.at(open_, np.minimum(at, n), sign)
        ok = np.cumsum(open_[:n]) == 0
        first = ok.copy()
        first[1:] &= (low[1:] != low[:-1]) | ~ok[:-1]
        self.start = np.flatnonzero(first)
        stops = np.append(np.flatnonzero(first | ~ok), n)
        self.end = stops[np.searchsorted(stops, self.start, side="right")]
        self.row = np.searchsorted(off, self.start, side="right") - 1
        self.key = low[self.start]
        self.content = hash_spans_exact(buf, self.start, self.end - 1 + size)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys and whether several rows of this segment hold each."""
        order = np.lexsort((self.row, self.key))
        k, r = self.key[order], self.row[order]
        new = np.ones(len(k), dtype=bool)
        new[1:] = k[1:] != k[:-1]
        group = np.cumsum(new) - 1
        other = ~new
        other[1:] &= r[1:] != r[:-1]
        return k[new], np.bincount(group, weights=other, minlength=int(new.sum())) > 0


def hash_spans_exact(buf, start, end):
    """Like ``words.hash_spans`` but case matters."""
    return hash_spans(buf, start, end, fold_case=False)


def key_bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> U64(40)) % U64(buckets)).astype(np.int64)


def _cut(order_key: np.ndarray, buckets: int):
    order = np.argsort(order_key, kind="stable")
    cut = np.searchsorted(order_key[order], np.arange(buckets + 1))
    return order, cut, np.flatnonzero(np.diff(cut))


def _five(key: np.ndarray) -> np.ndarray:
    """Low 40 bits as 5 bytes each (the bucket comes from bits above)."""
    return np.ascontiguousarray(key.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5]


def _from_five(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8")


# ---------------------------------------------------------------- segments and answers on disk

def store_segments(docs: DataFrame, text_col: str, path: str) -> DataFrame:
    """Write ``segment, rest, ends, text``: texts end to end, other columns as an Arrow stream."""
    rest_cols = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for b in batches:
            rest = b.select(rest_cols)
            for lo, buf, off in pieces(text_column(b, text_col), SEGMENT_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rest.schema) as w:
                    w.write_batch(rest.slice(lo, len(off) - 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) + number]), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                     pa.array([off.astype("<i8").tobytes()], pa.binary()), pa.array([buf.tobytes()], pa.binary())],
                    ["segment", "rest", "ends", "text"])
                number += 1

    schema = "segment long, rest binary, ends binary, text binary"
    (docs.mapInArrow(lean(run), schema).write.option("compression", "zstd").option("parquet.block.size", 8 << 20)
         .option("parquet.block.size.row.check.min", 1).parquet(path))
    return docs.sparkSession.read.schema(schema).parquet(path)


def _write_answers(answers: DataFrame, path: str, shards: int) -> None:
    """Answers (``segment, bucket, ...``) in one folder per shard of segments."""
    (answers.withColumn("shard", F.pmod(F.hash("segment"), F.lit(shards)))
            .withColumn("shard", F.col("shard").cast("int"))
            .repartition(shards, "shard").write.partitionBy("shard").parquet(path))


class Answers:
    """Rows of one segment at a time from the folder of its shard."""

    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns, self.shard, self.rows = path, columns, None, {}

    def of(self, segment: int, shard: int) -> list[tuple]:
        if shard != self.shard:
            fs, base = file_system(f"{self.path}/shard={shard}")
            self.shard, self.rows = shard, {}
            if fs.get_file_info(base).type.name == "Directory":
                t = pads.dataset(base, filesystem=fs, format="parquet").to_table(columns=["segment", "bucket", *self.columns])
                for r in zip(*(t.column(c).to_pylist() for c in t.column_names)):
                    self.rows.setdefault(r[0], []).append(r[1:])
        return sorted(self.rows.get(segment, []))


def _segment(b: pa.RecordBatch, i: int) -> tuple[int, np.ndarray, np.ndarray]:
    return (b.column(b.schema.get_field_index("segment"))[i].as_py(),
            np.frombuffer(b.column(b.schema.get_field_index("text"))[i].as_buffer() or b"", dtype=np.uint8),
            np.frombuffer(b.column(b.schema.get_field_index("ends"))[i].as_buffer(), dtype="<i8"))


def _rest(b: pa.RecordBatch, i: int) -> pa.RecordBatch:
    t = pa.ipc.open_stream(b.column(b.schema.get_field_index("rest"))[i].as_buffer()).read_all()
    return t.combine_chunks().to_batches()[0] if t.num_rows else pa.RecordBatch.from_pylist([], schema=t.schema)


def _ids(rest: pa.RecordBatch, id_col: str) -> np.ndarray:
    """Ids as int64, a missing one after all others."""
    col = rest.column(rest.schema.get_field_index(id_col)).cast(pa.int64())
    return np.asarray(col.fill_null(NO_ID))


# ---------------------------------------------------------------- the interval tree of a bucket

def lcp_intervals(lcp: np.ndarray, least: int, low: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """``(first, last, length, smallest of low)`` of every common-prefix interval of length at least
    ``least``, children before parents, by one scan with a stack.

    ``lcp[i]`` is the common prefix of suffixes ``i - 1`` and ``i`` (``lcp[0]`` unused).
    """
    stack: list[list[int]] = []                  # [length, first, smallest]
    values, lows = lcp.tolist(), low.tolist()
    n = len(lows)
    for i in range(1, n + 1):
        v = values[i] if i < n else 0
        first, least_low = i - 1, lows[i - 1]
        while stack and stack[-1][0] > v:
            length, first, m = stack.pop()
            least_low = m if m < least_low else least_low
            yield first, i - 1, length, least_low
        if stack and stack[-1][0] == v:
            if least_low < stack[-1][2]:
                stack[-1][2] = least_low
        elif v >= least:
            stack.append([v, first, least_low])


def suffix_groups(buf: np.ndarray, at: np.ndarray, stop: np.ndarray, left: np.ndarray, low: np.ndarray,
                  size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal repeats among the suffixes at ``at`` (ending before ``stop``; ``left`` the byte before,
    below 0 at a stretch's start): the suffix array, and rows ``first, last, length, smallest id``. Repeats
    of ``2 * size`` bytes or more come as all their windows of that many bytes."""
    most = 2 * size                                  # bytes of a suffix that are compared
    padded = np.concatenate([buf, np.zeros(most, dtype=np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, most)[at]
    length = np.minimum(stop - at, most)
    rows[np.arange(most) >= length[:, None]] = 0
    order = np.argsort(length, kind="stable")        # of equal rows, the one that ends first (others go on with zero bytes)
    order = order[np.argsort(rows[order].view(f"S{most}").ravel(), kind="stable")]
    rows, length, left = rows[order], length[order], left[order]
    lcp = np.zeros(len(order), dtype=np.int64)
    diff = rows[1:] != rows[:-1]
    same = np.where(diff.any(1), diff.argmax(1), most)
    lcp[1:] = np.minimum(same, np.minimum(length[1:], length[:-1]))
    found = np.array(list(lcp_intervals(lcp, size, low[order])), dtype=np.int64).reshape(-1, 4)
    changes = np.concatenate([[0], np.cumsum(left[1:] != left[:-1])])
    diverse = (left[found[:, 0]] < 0) | (changes[found[:, 1]] > changes[found[:, 0]])
    # one that all extend to the left is part of a longer one, unless that would not be seen in full either
    return order, found[diverse | (found[:, 2] == most)]


def _runs_of(key: np.ndarray, size: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Bounds of stretches of ``key`` (sorted) of about ``most`` together by ``size``, never inside equal keys."""
    if not len(key):
        return []
    edge = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
    total = np.append(0, np.cumsum(size))[edge]
    cuts, at = [0], 0
    while at < len(edge) - 1:
        at = max(at + 1, int(np.searchsorted(total, total[at] + most, side="right")) - 1)
        cuts.append(int(edge[at]))
    return list(zip(cuts[:-1], cuts[1:]))


def bucket_answers(contents: list[bytes], key: np.ndarray, low: np.ndarray, size: int, step: int = STEP, chunk: int = CHUNK
                   ) -> tuple[list[np.ndarray], Callable[[], Iterator[tuple[bytes, list[tuple[int, int]], int]]]]:
    """For each entry (a stretch with a segment's smallest id) the smallest id anywhere of each of its
    strings; and a function that lists the maximal repeats as ``(string, [(entry, offset)], smallest id)``.

    Equal strings have one key and one hash: the strings of some keys, and of these the suffixes of some hashes, are
    indexed at a time, about ``chunk`` together.
    """
    at_of: dict[bytes, int] = {}
    kind = np.array([at_of.setdefault(c, len(at_of)) for c in contents], dtype=np.int64)
    distinct = list(at_of)
    kind_low = np.full(len(distinct), NO_ID, dtype=np.int64)
    np.minimum.at(kind_low, kind, low)
    kind_key = np.zeros(len(distinct), dtype=key.dtype)
    kind_key[kind] = key
    length = np.array([len(c) for c in distinct], dtype=np.int64)
    begin = np.cumsum(length) - length
    strings = length - size + 1
    s_begin = np.cumsum(strings) - strings
    best = np.repeat(kind_low, strings)
    # strings that several contents of a key share are sorted; a string met once is in no interval
    _, inv, n = np.unique(kind_key, return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(n[inv] > 1)
    mixed = mixed[np.argsort(kind_key[mixed], kind="stable")]
    buf = np.frombuffer(b"".join(distinct), dtype=np.uint8) if len(mixed) else np.zeros(0, dtype=np.uint8)

    def indexed() -> Iterator[tuple[np.ndarray, ...]]:
        """Per chunk: content, number in it and place of the suffixes, their order, and the repeats."""
        for a, e in _runs_of(kind_key[mixed], strings[mixed], chunk):
            some = mixed[a:e]
            own = np.repeat(some, strings[some])
            nth = np.arange(len(own)) - np.repeat(np.cumsum(strings[some]) - strings[some], strings[some])
            # only the bytes of these contents are hashed
            text = np.concatenate([buf[begin[c]:begin[c] + length[c]] for c in some.tolist()])
            shift = np.cumsum(length[some]) - length[some]
            here = np.repeat(shift, strings[some]) + nth
            h = hash_spans_exact(text, here, here + size)
            by_hash = np.argsort(h, kind="stable")
            h = h[by_hash]
            alone = np.append(True, h[1:] != h[:-1]) & np.append(h[1:] != h[:-1], True)
            by_hash, h = by_hash[~alone], h[~alone]
            for lo, hi in _runs_of(h, np.ones(len(h), dtype=np.int64), chunk):
                pick = by_hash[lo:hi]
                at = here[pick]
                left = np.where(nth[pick] > 0, text[at - 1].astype(np.int64), -1)
                stop = at + length[own[pick]] - nth[pick]
                yield own[pick], nth[pick], begin[own[pick]] + nth[pick], *suffix_groups(text, at, stop, left, kind_low[own[pick]], size)

    def occurrences(order: np.ndarray, found: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Repeat and suffix of each occurrence of the repeats ``lo..hi``."""
        n = found[lo:hi, 1] - found[lo:hi, 0] + 1
        group = np.repeat(np.arange(lo, hi), n)
        return group, order[found[group, 0] + np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)]

    for own, nth, _, order, found in indexed():
        over = found[:, 2] - size + 1                    # strings a repeat covers in each occurrence
        work = np.cumsum((found[:, 1] - found[:, 0] + 1) * over)
        steps = np.unique(np.searchsorted(work, np.arange(0, int(work[-1]) + step, step))) if len(work) else [0]
        for lo, hi in zip(steps, [*steps[1:], len(found)]):
            group, who = occurrences(order, found, lo, hi)
            o = over[group]
            hit = np.repeat(s_begin[own[who]] + nth[who] - (np.cumsum(o) - o), o) + np.arange(int(o.sum()))
            np.minimum.at(best, hit, np.repeat(found[group, 3], o))

    def repeats():
        for own, nth, at, order, found in indexed():
            for g in range(len(found)):
                _, w = occurrences(order, found, g, g + 1)
                yield (buf[at[w[0]]:at[w[0]] + found[g, 2]].tobytes(),
                       [(int(e), int(nth[x])) for x in w for e in np.flatnonzero(kind == own[x])], int(found[g, 3]))
    return [best[s_begin[k]:s_begin[k] + strings[k]] for k in kind.tolist()], repeats


# ---------------------------------------------------------------- the passes

def _plan(spark: SparkSession, segments: DataFrame) -> tuple[int, int]:
    r = segments.select(F.octet_length("text").alias("n")).agg(F.sum("n").alias("b"), F.count("*").alias("c")).first()
    return max(1, -(-(r["b"] or 0) // BUCKET_BYTES)), max(1, -(-r["c"] // 32))


def _met_elsewhere(segments: DataFrame, path: str, buckets: int, shards: int, size: int, gram: int) -> None:
    """Pass 2: one bit per (segment, distinct key)."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                seg, buf, off = _segment(b, i)
                key, _ = Stretches(buf, off, size, gram).keys()
                order, cut, full = _cut(key_bucket(key, buckets), buckets)
                raw = _five(key[order])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full.astype(np.int32)), pa.array(np.full(len(full), seg)),
                     pa.array([raw[cut[j]:cut[j + 1]].tobytes() for j in full.tolist()], pa.binary())],
                    ["bucket", "segment", "keys"])

    def answer(t: pa.Table) -> pa.Table:
        lists = [_from_five(x) for x in t.column("keys").to_pylist()]
        _, inv, n = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        met = n[inv] > 1
        end = np.cumsum([len(x) for x in lists])
        bits = [np.packbits(met[e - len(x):e]).tobytes() for e, x in zip(end.tolist(), lists)]
        return pa.table([t.column("segment"), t.column("bucket"), pa.array(bits, pa.binary())],
                        names=["segment", "bucket", "bits"])

    sent = segments.select("segment", "ends", "text").mapInArrow(lean(send), "bucket int, segment long, keys binary")
    _write_answers(sent.groupBy("bucket").applyInArrow(lean(answer), "segment long, bucket int, bits binary"), path, shards)


def _shared(st: Stretches, seg: int, shard: int, met: Answers, buckets: int) -> np.ndarray:
    """Which stretches have an anchor that another document has too."""
    key, several = st.keys()
    order, cut, _ = _cut(key_bucket(key, buckets), buckets)
    for bucket, bits in met.of(seg, shard):
        n = cut[bucket + 1] - cut[bucket]
        got = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=n).astype(bool)
        several[order[cut[bucket]:cut[bucket + 1]]] |= got
    return several[np.searchsorted(key, st.key)]


class Exchange:
    """What a segment sends in pass 3, and where the answers belong: distinct shared stretches
    ordered by (bucket, key, content)."""

    def __init__(self, st: Stretches, shared: np.ndarray, ids: np.ndarray, buckets: int, size: int):
        self.which = np.flatnonzero(shared)
        content, low = st.content[self.which], ids[st.row[self.which]]
        bucket = key_bucket(st.key[self.which], buckets)
        order = np.lexsort((content, bucket))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (content[order][1:] != content[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])
        self.kind = np.zeros(len(order), dtype=np.int64)
        self.kind[order] = np.cumsum(new) - 1              # of each shared stretch
        head = self.which[order[new]]
        self.low = np.full(len(head), NO_ID, dtype=np.int64)
        np.minimum.at(self.low, self.kind, low)
        self.start, self.stop, self.key = st.start[head], st.end[head] - 1 + size, st.key[head]
        self.strings = st.end[head] - st.start[head]
        self.cut = np.searchsorted(bucket[order[new]], np.arange(buckets + 1))


def _answer_strings(segments: DataFrame, met_path: str, path: str, buckets: int, shards: int, id_col: str,
                    size: int, gram: int) -> None:
    """Pass 3: for each distinct shared stretch of a segment, runs of (strings, smallest id)."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Answers(met_path, ["bits"])
        for b in batches:
            for i in range(len(b)):
                seg, buf, off = _segment(b, i)
                st = Stretches(buf, off, size, gram)
                shared = _shared(st, seg, b.column(b.schema.get_field_index("shard"))[i].as_py(), met, buckets)
                x = Exchange(st, shared, _ids(_rest(b, i), id_col), buckets, size)
                rows = []
                for j in np.flatnonzero(np.diff(x.cut)).tolist():
                    own = slice(x.cut[j], x.cut[j + 1])
                    text = b"".join(buf[s:e].tobytes() for s, e in zip(x.start[own].tolist(), x.stop[own].tolist()))
                    rows.append((j, seg, (x.stop[own] - x.start[own]).astype("<u4").tobytes(),
                                 (x.key[own] & U64(0xFFFFFFFF)).astype("<u4").tobytes(), x.low[own].astype("<i8").tobytes(), text))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), *[pa.binary()] * 4))],
                        ["bucket", "segment", "lengths", "keys", "lows", "text"])

    def answer(t: pa.Table) -> pa.Table:
        contents, key, low, count = [], [], [], []
        for n, k, m, text in zip(*(t.column(c).to_pylist() for c in ("lengths", "keys", "lows", "text"))):
            end = np.cumsum(np.frombuffer(n, dtype="<u4").astype(np.int64)).tolist()
            contents += [text[s:e] for s, e in zip([0, *end[:-1]], end)]
            key.append(np.frombuffer(k, dtype="<u4"))
            low.append(np.frombuffer(m, dtype="<i8"))
            count.append(len(end))
        best, _ = bucket_answers(contents, np.concatenate(key), np.concatenate(low), size)
        flat = np.concatenate(best)
        n = np.array([len(x) for x in best], dtype=np.int64)
        own = np.repeat(np.arange(len(n)), n)
        new = np.ones(len(flat), dtype=bool)
        new[1:] = (flat[1:] != flat[:-1]) | (own[1:] != own[:-1])
        at = np.flatnonzero(new)
        run = np.diff(np.append(at, len(flat)))
        cut = np.searchsorted(own[at], np.concatenate([[0], np.cumsum(count)]))
        return pa.table([t.column("segment"), t.column("bucket"),
                         pa.array([run[a:e].astype("<u4").tobytes() for a, e in zip(cut, cut[1:])], pa.binary()),
                         pa.array([flat[at[a:e]].astype("<i8").tobytes() for a, e in zip(cut, cut[1:])], pa.binary())],
                        names=["segment", "bucket", "runs", "lows"])

    sent = _with_shard(segments, shards).mapInArrow(
        lean(send), "bucket int, segment long, lengths binary, keys binary, lows binary, text binary")
    _write_answers(sent.groupBy("bucket").applyInArrow(lean(answer), "segment long, bucket int, runs binary, lows binary"), path, shards)


def _with_shard(segments: DataFrame, shards: int) -> DataFrame:
    return segments.withColumn("shard", F.pmod(F.hash("segment"), F.lit(shards)).cast("int"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                   gram: int = GRAM, kept_as: str | None = "binary") -> DataFrame:
    """All columns of ``docs`` but the text, plus ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept``,
    the remaining bytes: as ``"binary"``, as ``"string"`` (characters that were cut are dropped), or left out."""
    spark = docs.sparkSession
    ship_package(spark)
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * bool(kept_as)]
    docs = docs.withColumn(text_col, F.col(text_col).cast("string")).drop(*names)
    segments = store_segments(docs, text_col, scratch_path(spark, "segments"))
    buckets, shards = _plan(spark, segments)
    met_path, low_path = scratch_path(spark, "met"), scratch_path(spark, "lows")
    _met_elsewhere(segments, met_path, buckets, shards, size, gram)
    _answer_strings(segments, met_path, low_path, buckets, shards, id_col, size, gram)
    rest = [f for f in docs.schema.fields if f.name != text_col]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, lows = Answers(met_path, ["bits"]), Answers(low_path, ["runs", "lows"])
        for b in batches:
            for i in range(len(b)):
                seg, buf, off = _segment(b, i)
                other = _rest(b, i)
                ids = _ids(other, id_col)
                shard = b.column(b.schema.get_field_index("shard"))[i].as_py()
                st = Stretches(buf, off, size, gram)
                x = Exchange(st, _shared(st, seg, shard, met, buckets), ids, buckets, size)
                best = np.concatenate([np.zeros(0, np.int64), *(
                    np.repeat(np.frombuffer(m, dtype="<i8"), np.frombuffer(r, dtype="<u4"))
                    for _, r, m in lows.of(seg, shard))])
                if len(best) != int(x.strings.sum()):
                    raise ValueError(f"answers for segment {seg} do not fit")
                n = (st.end - st.start)[x.which]
                first = (np.cumsum(x.strings) - x.strings)[x.kind]
                own = np.repeat(np.arange(len(n)), n)
                nth = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                gone = best[first[own] + nth] < ids[st.row[x.which]][own]
                at = st.start[x.which][own][gone] + nth[gone]
                cover = np.zeros(len(buf) + 1, dtype=np.int32)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + size, -1)
                cut = np.cumsum(cover[:-1]) > 0
                total = np.concatenate([[0], np.cumsum(cut)])
                begin = cut.copy()
                begin[1:] &= ~cut[:-1]
                begin[off[:-1][off[:-1] < len(buf)]] = cut[off[:-1][off[:-1] < len(buf)]]
                spans = np.concatenate([[0], np.cumsum(begin)])
                kept = [buf[a:e][~cut[a:e]].tobytes() if total[e] > total[a] else buf[a:e].tobytes()
                        for a, e in zip(off[:-1].tolist(), off[1:].tolist())]
                cols = [pa.array(np.diff(off)), pa.array(total[off[1:]] - total[off[:-1]]),
                        pa.array(spans[off[1:]] - spans[off[:-1]]),
                        pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
                if kept_as == "string":
                    cols.append(pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()))
                elif kept_as:
                    cols.append(pa.array(kept, pa.binary()))
                yield pa.RecordBatch.from_arrays([*other.columns, *cols], [*other.schema.names, *names])

    kinds = {"kept_sha256": T.StringType(), "kept": T.StringType() if kept_as == "string" else T.BinaryType()}
    schema = T.StructType([*rest, *(T.StructField(c, kinds.get(c, T.LongType())) for c in names)])
    return _with_shard(segments, shards).mapInArrow(lean(finish), schema)


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document covered by 50-byte strings that start in an earlier document too."""
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), kept_as=None).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without the strings that an earlier document holds.

    A cut inside a multi-byte character drops the rest of that character. ``n_chars`` follows the new
    text; documents of which nothing is left go. A null text stays null.
    """
    columns = docs.columns
    made = ("kept", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    held = {c: free_name([*columns, *made], f"held_{c}") for c in columns if c in made}
    missing = free_name([*columns, *made], "no_text")
    left = remove_repeats(docs.withColumnsRenamed(held).withColumn(missing, F.col("text").isNull()), kept_as="string")
    out = (left.where((F.col("n_removed") == 0) | (F.octet_length("kept") > 0))
               .withColumn("text", F.when(~F.col(missing), F.col("kept"))))
    if "n_chars" in columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*(F.col(held.get(c, c)).alias(c) for c in columns))
