"""Near-duplicate vectors by a robust-pruned flat graph over overlapping cluster shards.

Vectors are compared only within one label (and one dimension). A label's vectors are split
into cells around centroids (fitted on a bounded sample), again and again, until a cell is
small. A vector joins its nearest cell and every other one whose bisecting plane is near enough
that a linked vector could lie beyond it (half the search radius; the whole radius for copies
that come from such a neighbour), so each linked pair meets in the own cell of one of the two.
Where most planes are that near (vectors spread evenly over many dimensions) a split would copy
every vector many times over, and its copies again at the next: a cell is only split while that
makes at most ``MAX_COPIES`` rows of each vector, and stays whole otherwise.

Each cell's graph is built on its own: candidate neighbours by blocked products plus random far
ones, pruned so that no kept neighbour is much nearer to another kept one (alpha rule), with
reverse edges and every vector reachable from the medoid. The adjacency lists that different
cells give a vector are then united by vector, and each cell is searched with the united lists:
a greedy beam from the medoid, then an expansion over everything in range. Links are verified by
cosine in double precision. The recall of the whole search is audited against brute force for a
fixed number of query vectors over all rows; if it falls short the beam is widened, and after that every cell is
compared exactly (linked pairs meet in a cell, so that misses nothing).

A cell many of whose pairs are linked is compared exactly, and a large one that was not split (its vectors are almost
equal, or the split would copy them too often) block by block.
Links inside a cell are counted where they are found and leave it only as one edge per vector, so a
large group of copies sends no list of pairs.

Vectors are stored as wide as they are given. Graphs and cells are handled in rounds, each of which sends a part of the
vectors, and shuffle files go when a round ends.

Defined results: a vector that is null, empty, zero or holds a null or non-finite component, or
whose label is null, links with nothing and is its own component. Rows that repeat an id are
vectors of their own and count as links of each other if similar. Other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffles_freed, stored_bytes
from .common import discard, ship_package, table, written, written_parts
from .components import components

THRESHOLD = 0.98
MAX_CELL = 4096
DENSE = 0.05                     # share of linked pairs from which a cell is compared exactly
STEP = 1 << 21                   # components of pairs that are verified at once
BLOCK = 1 << 20                  # components of a block's vectors, where a cell is compared in blocks
MAX_COPIES = 2                   # rows of a vector over all cells, on average, up to which a cell is split
ROUND_BYTES, MAX_ROUNDS = 64 << 20, 8
CHILDREN = 16
SAMPLE_ROWS = 2048               # rows of a cell that its centroids are fitted on
MAX_DEPTH = 12
DEGREE, NEAR, FAR, ALPHA = 24, 48, 16, 1.2
BEAM, AUDIT_ROWS, LEAST_RECALL = 32, 256, 0.95
log = logging.getLogger("pistil.llm.graph")


# ---------------------------------------------------------------- one cell

def fit_centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(len(x))
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ c.T - 0.5 * (c * c).sum(1)).argmax(1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def robust_prune(x: np.ndarray, own: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Kept neighbours (``-1`` for none) of the rows ``own`` among their candidates ``cand``: nearest
    first, dropping those that are ``alpha`` times nearer to a kept one than to the row."""
    v = x[cand]
    d = np.maximum(0.0, 2.0 - 2.0 * np.einsum("ncd,nd->nc", v, x[own]))
    between = np.maximum(0.0, 2.0 - 2.0 * np.einsum("ncd,ned->nce", v, v))
    d = np.where((cand == own[:, None]), np.inf, d)
    for j in range(1, cand.shape[1]):                   # a candidate listed twice counts once
        d[:, j] = np.where((cand[:, :j] == cand[:, j:j + 1]).any(1), np.inf, d[:, j])
    live, rows = d.copy(), np.arange(len(own))
    kept = np.full((len(own), degree), -1, dtype=np.int64)
    for j in range(degree):
        best = live.argmin(1)
        ok = np.isfinite(live[rows, best])
        if not ok.any():
            break
        kept[ok, j] = cand[ok, best[ok]]
        near = alpha * alpha * between[rows, best] <= d
        live = np.where(near & ok[:, None], np.inf, live)
        live[rows, best] = np.inf
    return kept


def medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(0)).argmax())


def build_graph(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges ``(from, to)`` of the pruned graph of unit vectors, both ways, connected."""
    n, edges = len(x), []
    rng = np.random.default_rng(n)
    step = 256
    for lo in range(0, n, step):
        own = np.arange(lo, min(lo + step, n))
        s = x[own] @ x.T
        k = min(NEAR + 1, n)
        near = np.argpartition(-s, k - 1, axis=1)[:, :k]
        cand = np.concatenate([near, rng.integers(0, n, (len(own), FAR))], axis=1)
        kept = robust_prune(x, own, cand, DEGREE, ALPHA)
        r, c = np.nonzero(kept >= 0)
        edges.append(np.stack([own[r], kept[r, c]], 1))
    e = np.concatenate(edges) if edges else np.zeros((0, 2), np.int64)
    e = np.concatenate([e, e[:, ::-1]])
    root = local_roots(n, e[:, 0], e[:, 1])
    heads = np.flatnonzero(root == np.arange(n))
    start = medoid(x)
    extra = np.stack([np.full(len(heads), start), heads], 1)
    extra = extra[root[heads] != root[start]]
    e = np.unique(np.concatenate([e, extra, extra[:, ::-1]]), axis=0)
    return e[:, 0], e[:, 1]


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component (edges in any direction)."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _expand(begin: np.ndarray, to: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index into ``node`` and neighbour, for all neighbours."""
    n = begin[node + 1] - begin[node]
    own = np.repeat(np.arange(len(node)), n)
    return own, to[np.repeat(begin[node] - (np.cumsum(n) - n), n) + np.arange(len(own))]


def range_search(x: np.ndarray, begin: np.ndarray, to: np.ndarray, queries: np.ndarray, threshold: float,
                 beam: int) -> tuple[np.ndarray, np.ndarray]:
    """``(query row, row)`` pairs in range: greedy beam from the medoid, then everything in range
    (and a little beyond) is expanded until nothing new is in range."""
    start, n = medoid(x), len(x)
    out: list[np.ndarray] = []
    loose = threshold - (1 - threshold)
    for lo in range(0, len(queries), 256):
        q = queries[lo:lo + 256]
        m = len(q)
        seen = np.zeros((m, n), dtype=bool)
        seen[:, start] = True
        ids = np.full((m, beam), -1, dtype=np.int64)
        sim = np.full((m, beam), -np.inf)
        done = np.ones((m, beam), dtype=bool)
        ids[:, 0], sim[:, 0], done[:, 0] = start, x[q] @ x[start], False
        got: list[np.ndarray] = [np.stack([np.arange(m), np.full(m, start)], 1)[sim[:, 0] >= loose]]
        while True:
            at = np.where(done, -np.inf, sim).argmax(1)
            live = np.flatnonzero(~done[np.arange(m), at])
            if not len(live):
                break
            done[live, at[live]] = True
            own, nb = _expand(begin, to, ids[live, at[live]])
            own = live[own]
            fresh = ~seen[own, nb]
            own, nb = own[fresh], nb[fresh]
            seen[own, nb] = True
            s = np.einsum("ij,ij->i", x[q[own]], x[nb])
            hit = s >= loose
            got.append(np.stack([own[hit], nb[hit]], 1))
            # merge into the beams: one ragged block padded to its longest row
            count = np.bincount(own, minlength=m)
            width = int(count.max(initial=0))
            if not width:
                continue
            col = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
            order = np.argsort(own, kind="stable")
            new_ids = np.full((m, width), -1, dtype=np.int64)
            new_sim = np.full((m, width), -np.inf)
            new_ids[own[order], col], new_sim[own[order], col] = nb[order], s[order]
            ids = np.concatenate([ids, new_ids], 1)
            sim = np.concatenate([sim, new_sim], 1)
            done = np.concatenate([done, new_ids < 0], 1)
            top = np.argpartition(-sim, beam - 1, axis=1)[:, :beam]
            ids, sim, done = (np.take_along_axis(v, top, 1) for v in (ids, sim, done))
        front = np.concatenate(got)
        out_chunk = [front]
        while len(front):
            own, nb = _expand(begin, to, front[:, 1])
            own = front[own, 0]
            fresh = ~seen[own, nb]
            pair = np.unique(own[fresh] * n + nb[fresh])
            own, nb = pair // n, pair % n
            seen[own, nb] = True
            s = np.einsum("ij,ij->i", x[q[own]], x[nb])
            front = np.stack([own, nb], 1)[s >= loose]
            out_chunk.append(front)
        got_all = np.concatenate(out_chunk)
        out.append(np.stack([q[got_all[:, 0]], got_all[:, 1]], 1))
    found = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
    found = found[found[:, 0] != found[:, 1]]
    return found[:, 0], found[:, 1]


def cosine_pairs(raw: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine in double precision of the original vectors, about ``STEP`` components at a time."""
    norm = np.sqrt((raw * raw).sum(1))
    out, step = np.empty(len(a)), max(1, STEP // raw.shape[1])
    for lo in range(0, len(a), step):
        p, q = a[lo:lo + step], b[lo:lo + step]
        out[lo:lo + step] = np.einsum("ij,ij->i", raw[p], raw[q]) / (norm[p] * norm[q])
    return out


def linked_pairs(raw: np.ndarray, own: np.ndarray, left: np.ndarray, right: np.ndarray,
                 threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs over the threshold of a row of ``left`` and one of ``right`` (of equal sides each pair once) with one
    of the cell's own vectors, a part at a time. Products in single precision decide all but those that rounding could
    have moved over the threshold."""
    x, square = _unit(raw).astype(np.float32), (raw * raw).sum(1)
    plain = (square > 1e-280) & (square < 1e280)        # others are judged by their cosine alone
    other, same = x[right].T, left is right
    slack = (raw.shape[1] + 8) * 2.0 ** -23
    step = max(1, STEP // max(1, len(right)))
    for lo in range(0, len(left), step):
        near = x[left[lo:lo + step]] @ other[:, lo * same:]
        a, b = np.nonzero(near >= threshold - slack)
        sure = near[a, b] >= threshold + slack
        a, b = left[a + lo], right[b + lo * same]
        keep = ((a < b) if same else (a != b)) & (own[a] | own[b])
        a, b = a[keep], b[keep]
        sure = sure[keep] & plain[a] & plain[b]
        sure[~sure] = cosine_pairs(raw, a[~sure], b[~sure]) >= threshold
        if sure.any():
            yield a[sure], b[sure]


def exact_pairs(raw: np.ndarray, own: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs over the threshold with one of the cell's own vectors."""
    rows = np.arange(len(raw))
    pair = np.concatenate([np.zeros((0, 2), dtype=np.int32),
                           *(np.stack(p, 1).astype(np.int32) for p in linked_pairs(raw, own, rows, rows, threshold))])
    return pair[:, 0], pair[:, 1]


def _dense(x: np.ndarray, threshold: float) -> bool:
    """Whether many pairs of a cell are linked, from 64 of its (unit) vectors."""
    some = x[np.linspace(0, len(x) - 1, min(64, len(x))).astype(np.int64)]
    return len(x) > 64 and float((some @ x.T >= threshold).mean()) > DENSE


# ---------------------------------------------------------------- cells

def _decoded(rows: list[bytes], cell: str) -> np.ndarray:
    """Stored vectors as doubles; the cell's name begins with their dimension, which tells how wide they are stored."""
    kind = f"<f{len(rows[0]) // int(cell.split(':')[0])}"
    return np.frombuffer(b"".join(rows), dtype=kind).reshape(len(rows), -1).astype(np.float64)


def _vectors(t: pa.Table) -> np.ndarray:
    return _decoded(t.column("vec").to_pylist(), t.column("cell")[0].as_py()) if len(t) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)             # no overflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def clean_vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """Written ``rid, id, cell, vec``: a row number, the vector as little-endian floats or doubles and its first
    cell (label and dimension); ``cell`` and ``vec`` are null where the row links with nothing."""
    kind, width = dict(df.dtypes)[id_col], "<f4" if dict(df.dtypes)[vec_col] == "array<float>" else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, vec = [], []
            for label, v in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                a = np.array(v, dtype=np.float64) if v and None not in v else np.zeros(0)
                ok = label is not None and len(a) and np.isfinite(a).all() and a.any()
                vec.append(a.astype(width).tobytes() if ok else None)
                cell.append(f"{len(a)}:{label}" if ok else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell, pa.string()), pa.array(vec, pa.binary())],
                                             ["rid", "id", "cell", "vec"])

    rows = df.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                     F.col(label_col).cast("string").alias("label"),
                     F.col(vec_col).cast("array<double>").alias("v"))
    return written(rows.mapInArrow(run, f"rid long, id {kind}, cell string, vec binary"), "vectors")


def near_cells(x: np.ndarray, own: np.ndarray, c: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of each (unit) vector's nearest centroid, and which cells it joins."""
    d = 1.0 - 2.0 * (x @ c.T) + (c * c).sum(1)
    first, rows = d.argmin(1), np.arange(len(x))
    gap = np.sqrt(np.maximum(((c[first][:, None] - c[None]) ** 2).sum(2), 1e-18))
    near = (d - d[rows, first][:, None]) / (2 * gap) <= np.where(own, half, 2 * half)[:, None]
    near[rows, first] = True
    return first, near


def split_cells(rows: DataFrame, threshold: float, max_cell: int) -> tuple[DataFrame, list[DataFrame]]:
    """``top, cell, own, rid, vec, blocks``: overlapping cells of at most about ``max_cell`` rows; ``top`` is the first
    cell, ``own`` in the cell a vector belongs to; ``blocks`` 0, or in a larger cell that was not split the blocks in
    which it is compared; and what was written of them. Read from ``rows`` if no cell was split (else ``rows`` is deleted)."""
    half, spark = float(np.sqrt(2 - 2 * threshold) / 2), rows.sparkSession
    kept = ["top", "cell", "own", "rid", "vec"]

    def fit(t: pa.Table) -> pa.Table:
        x, own = _unit(_vectors(t)), np.asarray(t.column("own"))
        c = fit_centroids(x, int(t.column("children")[0].as_py()))
        pays = near_cells(x, own, c, half)[1].sum() <= MAX_COPIES * own.sum()
        return pa.table([t.column("cell")[:1], pa.array([c.astype("<f8").tobytes() if pays else None], pa.binary())], names=["cell", "centroids"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = np.array(b.column(1).to_pylist(), dtype=object)
            own = np.asarray(b.column(2))
            for cell in dict.fromkeys(cells.tolist()):
                at = np.flatnonzero(cells == cell)
                x = _unit(_vectors(pa.Table.from_batches([b]).take(pa.array(at))))
                c = np.frombuffer(b.column(6)[int(at[0])].as_buffer(), dtype="<f8").reshape(-1, x.shape[1])
                first, near = near_cells(x, own[at], c, half)
                r, j = np.nonzero(near)
                top, rid, vec, parent = (b.column(k).take(pa.array(at[r])) for k in (0, 3, 4, 5))
                yield pa.RecordBatch.from_arrays(
                    [top, pa.array([f"{cell}.{k}" for k in j.tolist()], pa.string()), pa.array(own[at][r] & (j == first[r])),
                     rid, vec, parent], [*kept, "parent"])

    todo = rows.where("vec is not null").select(F.col("cell").alias("top"), "cell", F.lit(True).alias("own"), "rid", "vec",
                                                F.lit(1 << 60).alias("parent"))
    level, final = rows, []
    for depth in range(MAX_DEPTH):
        size = todo.groupBy("cell").agg(F.count("*").alias("n"), F.max("parent").alias("p")).where(F.col("n") > max_cell)
        dim = F.split("cell", ":")[0].cast("long")
        # a cell that kept nearly all of its parent's rows is one dense mass
        large = written(size.select("cell", "n", F.ceil(F.col("n") * dim / BLOCK).cast("int").alias("blocks"),
                                    ((F.col("n") < 0.8 * F.col("p")) & F.lit(depth < MAX_DEPTH - 1)).alias("big")), "sizes")
        big = large.where("big")
        picked = (todo.join(F.broadcast(big), "cell")
                      .where(F.pmod(F.xxhash64("rid"), F.lit(1 << 30)) < F.lit(float(1 << 30)) * SAMPLE_ROWS / F.col("n"))
                      .select("cell", "own", "vec", F.least(F.lit(CHILDREN), F.ceil(2 * F.col("n") / max_cell)).cast("int").alias("children")))
        centroids = written(picked.groupBy("cell").applyInArrow(fit, "cell string, centroids binary").where("centroids is not null"), "centroids")
        stays = (todo.join(F.broadcast(large.select("cell", "blocks")), "cell", "left")
                     .join(F.broadcast(centroids.select("cell")), "cell", "left_anti")
                     .select(*kept, F.coalesce("blocks", F.lit(0)).alias("blocks")))
        if centroids.isEmpty():
            final.append(stays)
            break
        final.append(written(stays, "cells"))            # what goes on is in the next level's
        split = (todo.drop("parent").join(F.broadcast(big.select("cell", F.col("n").alias("parent"))), "cell")
                     .join(F.broadcast(centroids), "cell").select(*kept, "parent", "centroids"))
        todo = written(split.mapInArrow(assign, "top string, cell string, own boolean, rid long, vec binary, parent long"), "cells")
        discard(spark, level)
        level = todo
    out = final[0]
    for f in final[1:]:
        out = out.unionByName(f)
    return out, [*final[:-1], level]


def in_rounds(cells: DataFrame) -> tuple[str, int]:
    """Column and number of the rounds in which the cells that have a graph are handled: by first cell, whose vectors
    have no neighbours in others, or where these are few by cell."""
    n = min(MAX_ROUNDS, max(1, -(-stored_bytes(cells) // ROUND_BYTES)))
    return "top" if n == 1 or cells.select("top").distinct().limit(n).count() == n else "cell", n


def _round(df: DataFrame, cols: list[str], n: int, k: int) -> DataFrame:
    return df if n == 1 else df.where(F.pmod(F.xxhash64(*cols), F.lit(n)) == k)


def graph_edges(cells: DataFrame) -> DataFrame:
    """Written ``top, rid, near``: each vector's neighbours, united over its cells."""
    def build(t: pa.Table) -> pa.Table:
        a, b = build_graph(_unit(_vectors(t)))
        rid = np.asarray(t.column("rid"))
        n = np.bincount(a, minlength=len(rid))
        off = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        return pa.table([t.column("top"), pa.array(rid), pa.ListArray.from_arrays(pa.array(off), pa.array(rid[b]))], names=["top", "rid", "near"])

    small = cells.where("blocks = 0").drop("own", "blocks")
    by, n = in_rounds(cells)
    parts = [small] if by == "cell" else [_round(small, ["top"], n, k) for k in range(n)]
    return written_parts((part.groupBy("cell").applyInArrow(build, "top string, rid long, near array<long>")
                              .groupBy("rid").agg(F.first("top").alias("top"), F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
                              .select("top", "rid", "near") for part in parts), "graph")


def _report(rid: np.ndarray, own: np.ndarray, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    """Links of a cell (each once, in parts): counts and one edge per vector for those between own vectors; the
    others as pairs, which another cell may find too."""
    count, root, all_rows = np.zeros(len(rid), dtype=np.int64), np.arange(len(rid)), np.arange(len(rid))
    first, second = [], []
    for a, b in pairs:
        both = own[a] & own[b]
        x, y = a[both], b[both]
        if len(x):
            count += np.bincount(np.concatenate([x, y]), minlength=len(rid))
            met = np.flatnonzero(root != all_rows)           # what earlier parts united
            root = local_roots(len(rid), np.concatenate([x, met]), np.concatenate([y, root[met]]))
        p, q = rid[a[~both]], rid[b[~both]]
        first.append(np.minimum(p, q))
        second.append(np.maximum(p, q))
    linked = np.flatnonzero(count)
    between = sum(map(len, first))
    return pa.table([pa.array(np.concatenate([rid[linked], *first])), pa.array(np.concatenate([rid[root[linked]], *second])),
                     pa.array(np.concatenate([count[linked], np.zeros(between, dtype=np.int64)]))], names=["a", "b", "n"])


_FOUND = "a long, b long, n long"


def search_cells(cells: DataFrame, graph: DataFrame, threshold: float, beam: int | None) -> DataFrame:
    """Written links: rows ``a, b, n`` with ``n`` links of ``a`` counted (``b`` its root in the cell), or
    with ``n`` 0 a single link between cells. Without a beam every cell is compared exactly."""
    def search(t: pa.Table, lists: pa.Table | None = None) -> pa.Table:
        raw, rid, own = _vectors(t), np.asarray(t.column("rid")), np.asarray(t.column("own"))
        x, rows = _unit(raw), np.arange(len(rid))
        if lists is None or _dense(x, threshold):      # products in blocks take less than walking to every pair
            return _report(rid, own, linked_pairs(raw, own, rows, rows, threshold))
        order = np.argsort(rid)
        near = lists.column("near").combine_chunks()
        n = np.diff(np.asarray(near.offsets))
        a = np.repeat(order[np.searchsorted(rid[order], np.asarray(lists.column("node")))], n)
        to = np.asarray(near.flatten())
        at = np.minimum(np.searchsorted(rid[order], to), len(rid) - 1)
        here = rid[order][at] == to                      # neighbours that are in this cell
        a, b = a[here], order[at[here]]
        sort = np.argsort(a, kind="stable")
        begin = np.concatenate([[0], np.cumsum(np.bincount(a, minlength=len(rid)))])
        p, q = range_search(x, begin, b[sort], np.flatnonzero(own), threshold, beam)
        p, q = np.divmod(np.unique(np.minimum(p, q) * len(x) + np.maximum(p, q)), len(x))
        ok = cosine_pairs(raw, p, q) >= threshold
        return _report(rid, own, [(p[ok], q[ok])])

    def exact(t: pa.Table) -> pa.Table:
        raw, rid, own = _vectors(t), np.asarray(t.column("rid")), np.asarray(t.column("own"))
        side, i, j = np.asarray(t.column("side")), t.column("i")[0].as_py(), t.column("j")[0].as_py()
        left = np.flatnonzero(side == i)
        return _report(rid, own, linked_pairs(raw, own, left, left if i == j else np.flatnonzero(side == j), threshold))

    small, by, n = cells.where("blocks = 0").drop("blocks"), *in_rounds(cells)
    parts = []
    for k in range(n):
        part = _round(small, [by], n, k)
        group = part.select("cell", "own", "rid", "vec").groupBy("cell")
        if beam is None:
            parts.append(group.applyInArrow(lambda t: search(t), _FOUND))
            continue
        member = part.select(F.col("cell").alias("met"), F.col("rid").alias("node"))
        lists = (_round(graph, [by], n, k) if by == "top" else graph).select(F.col("rid").alias("node"), "near").join(member, "node")
        parts.append(group.cogroup(lists.groupBy("met")).applyInArrow(search, _FOUND))
    dense = cells.where("blocks > 0").select("cell", "own", "rid", "vec", "blocks")
    copies = dense.agg(F.avg("blocks")).first()[0] or 0.0       # each row goes to as many pairs of blocks
    stored = stored_bytes(cells)
    n = max(1, int(np.ceil(copies * stored / max(stored, ROUND_BYTES))))
    dense = dense.withColumn("side", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    dense = (dense.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                  .withColumn("i", F.least("side", "o")).withColumn("j", F.greatest("side", "o")))
    if copies:
        parts += [_round(dense, ["cell", "i", "j"], n, k).groupBy("cell", "i", "j").applyInArrow(exact, _FOUND) for k in range(n)]
    return written_parts(parts, "links")


def audit(cells: DataFrame, links: DataFrame, threshold: float, queries: int = AUDIT_ROWS) -> float:
    """Share of the links of a fixed number of query vectors that were found, by brute force over all
    rows: the ``queries`` vectors with the smallest id hashes, and as many of those for which a link was found. Of
    both the share of links and the mean share of each vector's links (in which small groups count as
    much as large ones); the least of these. The queries' vectors are broadcast."""
    spark, rows = cells.sparkSession, cells.where("own").select("rid", "top", "vec")
    least = lambda df: df.select("rid").orderBy(F.xxhash64("rid"), "rid").limit(queries).collect()
    strata = [least(rows), least(link_counts(links))]
    picked = rows.where(F.col("rid").isin(list({r["rid"] for side in strata for r in side}))).collect()
    shared = spark.sparkContext.broadcast([(r["rid"], r["top"], bytes(r["vec"])) for r in picked])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), dtype=np.int64)
        for b in batches:
            cells = np.array(b.column(1).to_pylist(), dtype=object)
            for cell in dict.fromkeys(c for _, c, _ in shared.value):
                at = np.flatnonzero(cells == cell)
                mine = [k for k, q in enumerate(shared.value) if q[1] == cell]
                if len(at):
                    x = _unit(_decoded(b.column(2).take(pa.array(at)).to_pylist(), cell))
                    q = _unit(_decoded([shared.value[k][2] for k in mine], cell))
                    total[mine] += (x @ q.T >= threshold).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([q[0] for q in shared.value], pa.int64()), pa.array(total - 0)], ["rid", "n"])

    truth = {r["rid"]: r["n"] - 1 for r in rows
             .mapInArrow(count, "rid long, n long").groupBy("rid").agg(F.sum("n").alias("n")).collect()}
    got = {r["rid"]: r["n"] for r in link_counts(links).where(F.col("rid").isin([q[0] for q in shared.value])).collect()}
    shares = [1.0]
    for side in strata:
        n = {r["rid"]: truth[r["rid"]] for r in side if truth[r["rid"]]}
        if n:
            met = {k: min(got.get(k, 0), v) for k, v in n.items()}
            shares += [sum(met.values()) / sum(n.values()), sum(met[k] / n[k] for k in n) / len(n)]
    return min(shares)


def link_counts(links: DataFrame) -> DataFrame:
    """``rid, n``: links counted inside cells plus distinct links between cells."""
    between = links.where("n = 0").select("a", "b").distinct()
    return (links.where("n > 0").select(F.col("a").alias("rid"), "n")
                 .unionByName(between.select(F.col("a").alias("rid"), F.lit(1).cast("long").alias("n")))
                 .unionByName(between.select(F.col("b").alias("rid"), F.lit(1).cast("long").alias("n")))
                 .groupBy("rid").agg(F.sum("n").alias("n")))


def near_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 threshold: float = THRESHOLD, max_cell: int = MAX_CELL, beam: int = BEAM) -> DataFrame:
    """``id, n_links, component_id, kept`` of every row."""
    spark = df.sparkSession
    ship_package(spark)
    with shuffles_freed(spark):
        rows = clean_vectors(df, id_col, vec_col, label_col)
        names = written(rows.select("rid", "id"), "names")
        cells, stored = split_cells(rows, threshold, max_cell)
        graph = graph_edges(cells)
        for width in (beam, 2 * beam, None):             # at last every cell exactly
            links = search_cells(cells, graph, threshold, width)
            recall = audit(cells, links, threshold) if width else 1.0
            log.info("graph search with beam %s: audited recall %.4f", width, recall)
            if recall >= LEAST_RECALL:
                break
            if width:
                discard(spark, links)
        discard(spark, rows, graph, *stored)
        roots = components(links.select("a", "b"))
    named = names.join(roots.withColumnRenamed("node", "rid"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    low = named.groupBy("root").agg(F.min("id").alias("component_id"))
    out = named.join(low, "root").join(link_counts(links), "rid", "left")
    return out.select("id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op4_graph_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all ``embeddings`` with cosine of at least 0.98 within a label."""
    return near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
