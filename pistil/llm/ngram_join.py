"""Exact self-join of word n-gram sets by Jaccard similarity, with set-relation skipping.

Documents with equal sets form one class and take part once. A class's shingles are ordered rarest first by a
frequency sketch of fixed size that counts the shingles of all documents (any one order gives
exact results; the sketch only keeps shingles that very many documents share out of prefixes).
By the prefix filter two similar sets share a shingle among their first ones, so an inverted
index over prefixes holds every candidate pair.

Skipping by position: the lists of the index are sorted by (set size, position) and equal ones form
blocks; a probe skips all blocks whose size cannot reach the threshold and, within a size, all blocks
whose position leaves too few shingles behind.

Skipping by set relation: first only the pair of each set with one leader per list (the smallest
set it may link to) is looked at. Pairs whose prefixes leave similarity possible make one cell, and whole
blocks of a list that lie in one cell are passed over from then on; only pairs between cells are
enumerated, and join cells where their prefixes do not rule them out. So cells hold every candidate
pair, without the pairs of a large group of near copies ever being listed. Each set is then sent to its
cell once. There, the overlaps of a set with all others are derived from those of the set before
it, mostly a near copy, by the few lists in which the two differ; links leave the cell as a forest.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased, compared by 64-bit hashes, as are
shingles and the digests that name equal sets.

Defined results: a document without words has an empty set, is linked with nothing and is its own
component; with fewer words than a shingle, the whole sequence is the one shingle. Rows that repeat an
id give a row each. The component is named by the smallest id reachable (a null id only if no
other is). Rows without words keep their own id. Other columns are ignored; empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, free_name, lean, ship_package, table, text_column, written
from .components import components
from .words import NOT_SPACE, chain, fold, split_words

SHINGLE = 5
PERCENT = 80
SKETCH_BITS = 20
SLICES = 64
HOT_LIST = 200_000           # entries of one shingle that one list takes; longer ones are split
BUCKET_ENTRIES = 1_000_000
BLOOM_BITS = 25
CELL = 512                   # sets that one task compares with each other
U64 = np.uint64


def shingle_sets(col: pa.Array, k: int = SHINGLE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, sorted distinct shingles of all rows, offsets)`` a piece of rows at a time."""
    for w in split_words(col, NOT_SPACE):
        n = np.diff(w.first)
        all_runs = chain(w.hash, k)
        row_of = w.row[:len(all_runs)]
        inside = row_of == w.row[k - 1:] if len(all_runs) else np.zeros(0, bool)
        h, row = all_runs[inside], row_of[inside]
        short = np.flatnonzero((n > 0) & (n < k))
        if len(short):
            own = np.array([fold(w.hash[w.first[i]:w.first[i + 1]]) for i in short.tolist()], dtype=U64)
            h, row = np.concatenate([h, own]), np.concatenate([row, short])
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        h, row = h[new], row[new]
        yield w.lo, h, np.searchsorted(row, np.arange(w.rows + 1))


def _class_of(h: np.ndarray) -> int:
    """Name of a set: signed 64-bit digest of its sorted shingles."""
    return xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63)


def least_overlap(x, y, percent: int):
    """Smallest intersection with which sets of these sizes are similar enough."""
    return -(-percent * (x + y) // (100 + percent))


def _sizes_and_counts(docs: DataFrame, k: int) -> DataFrame:
    """Written rows of two kinds: ``(id, n, node)`` of a document, and ``(slice, counts)`` of the sketch."""
    kind = dict(docs.dtypes)["id"]
    width = (1 << SKETCH_BITS) // SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        id_type = None
        names = ["id", "n", "node", "slice", "counts"]
        for b in batches:
            id_type = b.column(0).type
            for lo, h, off in shingle_sets(text_column(b, "text"), k):
                sketch += np.bincount((h >> U64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
                n = np.diff(off)
                node = [_class_of(h[off[i]:off[i + 1]]) if n[i] else None for i in range(len(n))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(n)), pa.array(n), pa.array(node, pa.int64()),
                     pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names)
        if id_type is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(SLICES, id_type), pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.int64()),
                 pa.array(np.arange(SLICES, dtype=np.int32)),
                 pa.array([sketch[i * width:(i + 1) * width].astype("<u4").tobytes() for i in range(SLICES)], pa.binary())],
                names)

    return written(docs.mapInArrow(lean(run), f"id {kind}, n long, node long, slice int, counts binary"), "sets")


def _frequency(rows: DataFrame) -> np.ndarray:
    """The sketch summed over all tasks (fixed size, whatever the input)."""
    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, dtype="<u4").astype(np.int64) for x in t.column("counts").to_pylist())
        return pa.table({"slice": t.column("slice")[:1], "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    parts = (rows.where("slice is not null").select("slice", "counts").groupBy("slice")
                 .applyInArrow(lean(add), "slice int, counts binary").collect())
    out = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    width = len(out) // SLICES
    for r in parts:
        out[r["slice"] * width:(r["slice"] + 1) * width] = np.frombuffer(r["counts"], dtype="<i8")
    return out


def _levels(count: np.ndarray) -> np.ndarray:
    return np.minimum(63, np.floor(2 * np.log2(count + 1.0))).astype(U64)


def _rank_keys(h: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Shingle -> sort key, rarest first: frequency level in the top 6 bits, the hash below."""
    return (level[(h >> U64(64 - SKETCH_BITS)).astype(np.int64)] << U64(58)) | (h & U64((1 << 58) - 1))


def _prefix_index(docs: DataFrame, count: np.ndarray, buckets: int, k: int, percent: int) -> DataFrame:
    """Written inverted index over prefixes: per bucket, entries sorted by (key, size, position);
    lists that hold one class only are left out."""
    level = _levels(count)
    shared = docs.sparkSession.sparkContext.broadcast((level, count))       # fixed size

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, count = shared.value
        done: set[int] = set()                      # classes this task has sent
        for b in batches:
            for _, h, off in shingle_sets(text_column(b, "text"), k):
                keys = _rank_keys(h, level)
                out = []
                for i in range(len(off) - 1):
                    n = int(off[i + 1] - off[i])
                    if not n:
                        continue
                    node = _class_of(h[off[i]:off[i + 1]])
                    if node in done:
                        continue
                    done.add(node)
                    probe = n - (-(-percent * n // 100)) + 1
                    index = n - (-(-2 * percent * n // (100 + percent))) + 1
                    key = np.sort(keys[off[i]:off[i + 1]])[:probe]
                    out.append((key, np.full(probe, node), np.full(probe, n), np.arange(probe), np.arange(probe) < index))
                if not out:
                    continue
                key, node, size, pos, first = (np.concatenate(x) for x in zip(*out))
                # a list that would be too long is split: every part is probed by all, holds its share
                parts = _parts(key, level, count)
                if parts.max() > 1:
                    rep = np.repeat(np.arange(len(key)), parts)
                    part = np.arange(len(rep)) - np.repeat(np.cumsum(parts) - parts, parts)
                    key, node, size, pos, first = (x[rep] for x in (key, node, size, pos, first))
                    first = first & (node % parts[rep] == part)
                    spread = key + part.astype(U64) * U64(0x9E3779B97F4A7C15)
                else:
                    part, spread = np.zeros(len(key), dtype=np.int64), key
                bucket = ((spread * U64(0xD1342543DE82EF95)) >> U64(33)).astype(np.int64) % buckets
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(cut))
                data = [x[order] for x in (key.astype("<u8"), node.astype("<i8"), size.astype("<u4"),
                                           (pos * 2 + first).astype("<u4"), part.astype("<u2"))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full.astype(np.int32)),
                     *(pa.array([x[cut[j]:cut[j + 1]].tobytes() for j in full.tolist()], pa.binary()) for x in data)],
                    names)

    names = ["bucket", "key", "node", "size", "pos", "part"]
    schema = "bucket int, key binary, node binary, size binary, pos binary, part binary"

    def gather(t: pa.Table) -> pa.Table:
        key, node, size, pos, part = (np.frombuffer(b"".join(t.column(c).to_pylist()), dtype=d)
                                      for c, d in zip(names[1:], _TYPES))
        order = np.lexsort((node, pos >> 1, size, part, key))
        key, node, size, pos, part = (x[order] for x in (key, node, size, pos, part))
        same = np.zeros(len(key), dtype=bool)          # the same entry sent by several tasks
        same[1:] = ((key[1:] == key[:-1]) & (part[1:] == part[:-1]) & (node[1:] == node[:-1])
                    & (pos[1:] == pos[:-1]) & (size[1:] == size[:-1]))
        keep = ~same
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
        group = np.cumsum(new) - 1
        keep &= (np.bincount(group, weights=keep) > 1)[group]
        cols = [x[keep] for x in (key, node, size, pos, part)]
        return pa.table([t.column("bucket")[:1], *(pa.array([x.tobytes()], pa.binary()) for x in cols)], names=names)

    return written(docs.mapInArrow(lean(emit), schema).groupBy("bucket").applyInArrow(lean(gather), schema), "prefixes")


_TYPES = ("<u8", "<i8", "<u4", "<u4", "<u2")


def _parts(key: np.ndarray, level: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Parts that each key's list is split into, from its frequency level (the same in all tasks)."""
    at_least = np.floor(np.exp2((key >> U64(58)).astype(np.float64) / 2))
    typical = float(count.mean())                       # what unrelated shingles add to a counter
    return np.maximum(1, np.ceil((at_least - 4 * typical) / HOT_LIST)).astype(np.int64)


class Lists:
    """The lists of one bucket, with blocks of equal (list, size, position) among index entries."""

    def __init__(self, key, node, size, pos, part, percent: int):
        self.percent = percent
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
        self.list = np.cumsum(new) - 1
        self.node, self.size, self.pos = node, size.astype(np.int64), (pos >> 1).astype(np.int64)
        ind = np.flatnonzero(pos & 1)                       # entries of index prefixes
        self.ind = ind
        start = np.ones(len(ind), dtype=bool)
        start[1:] = ((self.list[ind][1:] != self.list[ind][:-1]) | (self.size[ind][1:] != self.size[ind][:-1])
                     | (self.pos[ind][1:] != self.pos[ind][:-1]))
        self.block_at = np.append(np.flatnonzero(start), len(ind))
        head = ind[self.block_at[:-1]]
        self.block_key = (self.list[head] << 32) + self.size[head]
        self.block_size, self.block_pos = self.size[head], self.pos[head]

    def ranges(self, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First block of a size that each probe can reach, and one past the last."""
        base, size = self.list[probe] << 32, self.size[probe]
        return (np.searchsorted(self.block_key, base + -(-self.percent * size // 100), side="left"),
                np.searchsorted(self.block_key, base + size, side="right"))

    def reachable(self, probe: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Whether positions leave enough: in the list of the first shingle that two sets share, all they
        share is this one and what the shorter tail holds (other lists need not find the pair)."""
        x, y, i, j = self.size[probe], self.block_size[block], self.pos[probe], self.block_pos[block]
        return np.minimum(x - i, y - j) >= least_overlap(x, y, self.percent)

    def leaders(self) -> tuple[np.ndarray, np.ndarray]:
        """``(probe entry, index entry)``: for each probe the first entry of a reachable block that is not
        its own set. All probes step over their blocks together."""
        probe = np.arange(len(self.node))
        block, last = self.ranges(probe)
        found = [(probe[:0], probe[:0])]
        while True:
            live = block < last
            probe, block, last = probe[live], block[live], last[live]
            if not len(probe):
                break
            at = self.block_at[block]
            at = at + (self.node[self.ind[at]] == self.node[probe])
            ok = (at < self.block_at[block + 1]) & self.reachable(probe, block)
            found.append((probe[ok], self.ind[at[ok]]))
            probe, block, last = probe[~ok], block[~ok] + 1, last[~ok]
        return tuple(np.concatenate(x) for x in zip(*found))

    def blocks(self, probes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(probe entry, block)`` that no skipping rule excludes, about ``STEP`` at a time."""
        first, last = self.ranges(probes)
        n = last - first
        work = np.cumsum(n)
        steps = np.unique(np.searchsorted(work, np.arange(0, int(work[-1]) + STEP, STEP))) if len(work) else np.zeros(1, int)
        for lo, hi in zip(steps.tolist(), [*steps[1:].tolist(), len(probes)]):
            m = n[lo:hi]
            owner = np.repeat(np.arange(lo, hi), m)
            block = np.repeat(first[lo:hi] - (np.cumsum(m) - m), m) + np.arange(len(owner))
            probe = probes[owner]
            ok = self.reachable(probe, block)
            yield probe[ok], block[ok]

    def entries(self, probe: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(probe entry, index entry)`` of the blocks."""
        n = self.block_at[block + 1] - self.block_at[block]
        own = np.repeat(np.arange(len(probe)), n)
        at = np.repeat(self.block_at[block] - (np.cumsum(n) - n), n) + np.arange(len(own))
        return probe[own], self.ind[at]


STEP = 1_000_000             # probes times blocks, and pairs, looked at together


def _pairs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distinct pairs (smaller name first) as rows."""
    return np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)


def _read_lists(t: pa.Table, percent: int) -> Lists:
    cols = [np.frombuffer(b"".join(t.column(c).to_pylist()), dtype=d)
            for c, d in zip(("key", "node", "size", "pos", "part"), _TYPES)]
    return Lists(*cols, percent)


def _leader_pairs(index: DataFrame, percent: int) -> DataFrame:
    """For each list and set, the pair with the first entry it may be similar to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                ls = _read_lists(pa.Table.from_batches([b.slice(i, 1)]), percent)
                probe, e = ls.leaders()
                found = _pairs(ls.node[probe], ls.node[e])
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["x", "y"])

    return index.mapInArrow(lean(run), "x long, y long")


def _bucket_nodes(index: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                node = np.unique(np.frombuffer(b.column(1)[i].as_buffer(), dtype="<i8"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(node), b.column(0)[i].as_py(), np.int32)), pa.array(node)], ["bucket", "node"])

    return index.select("bucket", "node").mapInArrow(lean(run), "bucket int, node long")


def _cross_pairs(index: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of sets that no verified links connect so far."""
    labels = _bucket_nodes(index).join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))

    def run(t: pa.Table, lab: pa.Table) -> pa.Table:
        found = [np.zeros((0, 2), np.int64)]
        ls = _read_lists(t, percent) if t.num_rows else None
        if ls is not None and len(ls.node):
            node, root = np.asarray(lab.column("node")), np.asarray(lab.column("root"))
            order = np.argsort(node)
            comp = root[order][np.searchsorted(node[order], ls.node)]
            at = np.flatnonzero(np.append(True, ls.list[1:] != ls.list[:-1]))
            mixed = np.minimum.reduceat(comp, at) < np.maximum.reduceat(comp, at)     # lists of one cell are skipped
            probes = np.flatnonzero(mixed[ls.list])
            at = ls.block_at[:-1]
            if len(at):
                low, high = np.minimum.reduceat(comp[ls.ind], at), np.maximum.reduceat(comp[ls.ind], at)
            pending = 0
            for probe, block in ls.blocks(probes):
                known = (low[block] == high[block]) & (low[block] == comp[probe])     # blocks of one cell too
                probe, block = probe[~known], block[~known]
                n = ls.block_at[block + 1] - ls.block_at[block]
                for part in np.split(np.arange(len(probe)), np.searchsorted(np.cumsum(n), np.arange(STEP, int(n.sum()), STEP))):
                    p, q = ls.entries(probe[part], block[part])
                    far = comp[p] != comp[q]
                    found.append(_pairs(ls.node[p[far]], ls.node[q[far]]))
                    pending += len(found[-1])
                if pending > STEP:
                    found = [np.unique(np.concatenate(found), axis=0)]
                    pending = 0
            found = [np.unique(np.concatenate(found), axis=0)]
        return pa.table({"x": found[0][:, 0], "y": found[0][:, 1]})

    return (index.groupBy("bucket").cogroup(labels.groupBy("bucket")).applyInArrow(run, "x long, y long"))


def _bloom_positions(node: np.ndarray) -> np.ndarray:
    h = node.astype(np.int64).view(U64)
    return np.stack([(h >> U64(s)) & U64((1 << BLOOM_BITS) - 1) for s in (0, 18, 36)], 1).astype(np.int64)


def _node_filter(nodes: DataFrame) -> np.ndarray:
    """Bloom filter of fixed size over all values of ``nodes``' columns, as packed bits."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = np.zeros(1 << BLOOM_BITS, dtype=bool)
        for b in batches:
            for c in b.columns:
                f[_bloom_positions(np.asarray(c)).ravel()] = True
        packed = np.packbits(f).reshape(SLICES, -1)
        full = np.flatnonzero(packed.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)),
                                          pa.array([packed[i].tobytes() for i in full], pa.binary())], ["slice", "bits"])

    def either(t: pa.Table) -> pa.Table:
        out = None
        for x in t.column("bits").to_pylist():
            x = np.frombuffer(x, dtype=np.uint8)
            out = x if out is None else out | x
        return pa.table({"slice": t.column("slice")[:1], "bits": pa.array([out.tobytes()], pa.binary())})

    packed = np.zeros((SLICES, (1 << BLOOM_BITS) // 8 // SLICES), dtype=np.uint8)
    for r in (nodes.mapInArrow(lean(bits), "slice int, bits binary").groupBy("slice")
                   .applyInArrow(lean(either), "slice int, bits binary").collect()):
        packed[r["slice"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return packed.ravel()


def _sets_of(docs: DataFrame, wanted: np.ndarray, k: int, make) -> DataFrame:
    """``node, n, set`` of the classes that pass a node filter, one row each; sets are made again from the
    texts and ``make(shingles)`` gives the bytes to send. The filter keeps the other sets from being shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)               # fixed size

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        done: set[int] = set()
        for b in batches:
            for _, h, off in shingle_sets(text_column(b, "text"), k):
                full = np.flatnonzero(np.diff(off))
                node = np.array([_class_of(h[off[i]:off[i + 1]]) for i in full.tolist()], dtype=np.int64)
                if not len(node):
                    continue
                at = _bloom_positions(node)
                ok = ((f[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(1)
                rows = []
                for i, c in zip(full[ok].tolist(), node[ok].tolist()):
                    if c not in done:
                        done.add(c)
                        rows.append((c, int(off[i + 1] - off[i]), make(h[off[i]:off[i + 1]])))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], ["node", "n", "set"])

    return docs.mapInArrow(lean(sets), "node long, n long, set binary").dropDuplicates(["node"])


def prefix_bound(x: np.ndarray, nx: int, y: np.ndarray, ny: int) -> int:
    """Most shingles that two sets can share, seen from their sorted prefixes alone."""
    if x[-1] > y[-1]:
        x, nx, y, ny = y, ny, x, nx
    both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
    return both + min(nx - len(x), ny - int(np.searchsorted(y, x[-1], side="right")))


def _alike(docs: DataFrame, pairs: DataFrame, count: np.ndarray, k: int, percent: int) -> DataFrame:
    """The pairs (written ``x, y``) that their prefixes do not rule out."""
    level = docs.sparkSession.sparkContext.broadcast(_levels(count))

    def prefix(h: np.ndarray) -> bytes:
        key = np.sort(_rank_keys(h, level.value))
        return key[:len(h) - (-(-percent * len(h) // 100)) + 1].astype("<u8").tobytes()

    made = _sets_of(docs, _node_filter(pairs.select("x", "y")), k, prefix)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nx, ny = b.column(4).to_pylist(), b.column(5).to_pylist()
            keep = pa.array([prefix_bound(np.frombuffer(b.column(2)[i].as_buffer(), dtype="<u8"), nx[i],
                                          np.frombuffer(b.column(3)[i].as_buffer(), dtype="<u8"), ny[i])
                             >= least_overlap(nx[i], ny[i], percent) for i in range(len(b))], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    x, y = (made.select(F.col("node").alias(c), F.col("set").alias(f"s{c}"), F.col("n").alias(f"n{c}")) for c in "xy")
    joined = pairs.join(x, "x").join(y, "y").select("x", "y", "sx", "sy", "nx", "ny")
    return written(joined.mapInArrow(lean(check), "a long, b long"), "alike")


def set_links(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each set the later ones that are similar to it.

    The overlaps of a set with all others are derived from those of the set before it: lists of the
    shingles it has and the other lacks are added, and the other way round taken off. Sets are walked by
    size and first shingles, so neighbours are mostly near copies and few lists are read.
    """
    n = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), n)
    _, token, spread = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = spread[token] > 1                              # a shingle of one set meets nothing
    owner, token = owner[shared], token[shared]
    by_token = np.argsort(token, kind="stable")
    members = owner[by_token]
    begin = np.searchsorted(token[by_token], np.arange(len(spread) + 1))
    at = np.searchsorted(owner, np.arange(len(sets) + 1))
    own = [np.sort(token[at[i]:at[i + 1]]) for i in range(len(sets))]
    order = sorted(range(len(sets)), key=lambda i: (own[i][:3].tolist(), n[i]))
    overlap = np.zeros(len(sets), dtype=np.int64)
    before = np.zeros(0, dtype=np.int64)

    def lists(t: np.ndarray) -> np.ndarray:
        size = begin[t + 1] - begin[t]
        return members[np.repeat(begin[t] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]

    for i in order:
        more, less = np.setdiff1d(own[i], before, assume_unique=True), np.setdiff1d(before, own[i], assume_unique=True)
        if len(more) + len(less) < len(own[i]):
            overlap = overlap + np.bincount(lists(more), minlength=len(sets)) - np.bincount(lists(less), minlength=len(sets))
        else:                                               # nothing to gain: start anew
            overlap = np.bincount(lists(own[i]), minlength=len(sets))
        before = own[i]
        hit = np.flatnonzero(overlap * (100 + percent) >= percent * (n[i] + n))
        yield i, hit[hit > i]


def _cell_links(docs: DataFrame, cells: DataFrame, k: int, percent: int) -> DataFrame:
    """Written ``a, b``: for each cell (``node, root``) of sets that may be similar, edges that connect the
    similar ones. Each set is sent to its cell once; cells of more than ``CELL`` sets meet block by block."""
    size = written(cells.groupBy("root").agg(F.count("*").alias("m")).where("m > 1")
                        .withColumn("blocks", F.ceil(F.col("m") / CELL).cast("int")), "cells")
    total = size.agg(F.sum("m").alias("n")).first()["n"] or 0
    groups = max(1, -(-total // CELL))
    placed = cells.join(size, "root").select("node", "root", "blocks")
    made = _sets_of(docs, _node_filter(placed.select("node")), k, lambda h: h.astype("<u8").tobytes())
    rows = placed.join(made.drop("n"), "node").withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    small = rows.where("blocks = 1").select(
        F.pmod(F.xxhash64("root"), F.lit(groups)).alias("g"), F.lit(0).alias("i"), F.lit(0).alias("j"), "root", "node", "side", "set")
    large = (rows.where("blocks > 1").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select(F.col("root").alias("g"), F.least("side", "o").alias("i"), (F.greatest("side", "o") + 1).alias("j"),
                         "root", "node", "side", "set"))

    def link(t: pa.Table) -> pa.Table:
        root, node = np.asarray(t.column("root")), np.asarray(t.column("node"))
        order = np.argsort(root, kind="stable")
        cut = np.append(np.flatnonzero(np.append(True, root[order][1:] != root[order][:-1])), len(order))
        sets = t.column("set").to_pylist()
        a, b = [], []
        for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
            at = order[lo:hi]
            # links as a forest: each set to the smallest place that its links reach
            low = np.arange(len(at))

            def top(x: int) -> int:
                while low[x] != x:
                    low[x] = low[low[x]]
                    x = low[x]
                return x

            for i, hit in set_links([np.frombuffer(sets[x], dtype="<u8") for x in at.tolist()], percent):
                for j in np.unique(low[hit]).tolist():
                    p, q = top(i), top(j)
                    if p != q:
                        low[max(p, q)] = min(p, q)
            reach = np.array([top(x) for x in range(len(at))])
            own = np.flatnonzero(reach != np.arange(len(at)))
            a.append(node[at[own]])
            b.append(node[at[reach[own]]])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return written(small.unionByName(large).groupBy("g", "i", "j").applyInArrow(lean(link), "a long, b long"), "links")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                       percent: int = PERCENT) -> DataFrame:
    """``id, n_shingles, component_id, node`` of every row; ``node`` names the row's set (null if empty)."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = _sizes_and_counts(docs, k)
    members = rows.where("slice is null").select("id", "n", "node")
    total = members.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = max(1, -(-total * (100 - percent) // 100 // BUCKET_ENTRIES))
    count = _frequency(rows)
    index = _prefix_index(docs, count, int(buckets), k, percent)
    pairs = written(_leader_pairs(index, percent).distinct(), "pairs")
    alike = _alike(docs, pairs, count, k, percent)
    cells = components(alike)
    more = written(_cross_pairs(index, cells, percent).distinct(), "pairs")
    discard(docs.sparkSession, index, pairs)
    if not more.isEmpty():
        found = _alike(docs, more, count, k, percent)
        if not found.isEmpty():
            cells = components(alike.unionByName(found))
    roots = components(_cell_links(docs, cells, k, percent))
    classes = (members.where("node is not null").groupBy("node").agg(F.min("id").alias("low"))
                      .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    low = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    named = classes.join(low, "root").select("node", "component_id")
    return members.join(named, "node", "left").select(
        "id", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"), "node")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents`` by Jaccard similarity of 5-word shingles."""
    return similar_components(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id")


def keep_first_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near duplicates, the document with the smallest id stays.

    Rows that share that id are told apart by their texts: the smallest text hash stays, once. Documents
    without words are in no group and stay.
    """
    place, taken = free_name(docs.columns, "place"), docs.columns
    # the order of documents, the same wherever a row is read: no copy of the texts is needed
    docs = docs.withColumn(place, F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                                           F.xxhash64("text").alias("digest")))
    found = written(similar_components(docs, id_col=place).where("n_shingles > 0").select(
        F.col("id").alias(place), (F.col("id") == F.col("component_id")).alias("first")), "decisions")
    # null-safe on every field: a struct itself is never null
    gone = found.where("not first").select(place).distinct()
    kept = docs.join(gone, _same(docs[place], gone[place]), "left_anti")
    twice = found.where("first").groupBy(place).agg(F.count("*").alias("n")).where("n > 1").select(place)
    if not twice.isEmpty():                                   # rows with the same id and text
        again = _same(kept[place], twice[place])
        kept = kept.join(twice, again, "left_anti").unionByName(kept.join(twice, again, "left_semi").dropDuplicates([place]))
    return kept.select(*taken)


def _same(a, b):
    return (a["none"] == b["none"]) & a["id"].eqNullSafe(b["id"]) & (a["digest"] == b["digest"])


__all__ = ["keep_first_of_group", "op9_ngram_join", "shingle_sets", "similar_components"]
