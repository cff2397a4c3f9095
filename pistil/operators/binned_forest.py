"""Fits a random forest on the distinct binned rows of a table instead of on its rows.

A tree of Spark ML sees a row only through its bins (``maxBins`` a feature, cut at quantiles) and its class, so rows that
fall into the same bins are one *cell* with a row count. Cells are counted once (one pass and one
exchange); the trees then grow level by level over the cells, one job a level for all trees: a task adds up the class
counts of its cells per node, feature and bin, the sums of a tree meet in one group, which picks the best
splits, and only these reach the driver. A row's bootstrap count is Poisson(1), so a cell's is Poisson(its rows):
the draws are those of single rows, added up. Where all rows differ cells are as many as rows, and as distributed.

Limits and rules are Spark's: gini gain above 0, ``minInstancesPerNode``, ``minWeightFractionPerNode`` of the rows,
``sqrt`` features a node, split candidates from a sample of at least 10,000 rows, leaves of one parent with the same class merged. The
result is a ``RandomForestClassificationModel``, loaded from its stored form.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import current_session, held, scratch_path
from .forests import NODE, forest_nodes

SAMPLE_ROWS = 10_000
CELLS_PER_PARTITION = 25_000
LEAST_PARTITIONS = 8
SPLIT_PARTITIONS = 32
NODE_FIELDS = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,"
               "gain:double,leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` thresholds between distinct values, all of them where they are that few."""
    distinct, count = np.unique(values, return_counts=True)
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) < bins:
        return middle
    at = np.searchsorted(np.cumsum(count), np.arange(1, bins) * len(values) / bins)
    return middle[np.unique(np.minimum(at, len(middle) - 1))]


def cell_counts(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """``b`` (the bin of each feature, two bytes each), ``label`` and ``n`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(0).flatten()).reshape(len(batch), len(cuts))
            b = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype("<u2")
            kind = pa.binary(2 * len(cuts))
            packed = pa.FixedSizeBinaryArray.from_buffers(kind, len(b), [None, pa.py_buffer(np.ascontiguousarray(b))])
            yield pa.RecordBatch.from_arrays([packed.cast(pa.binary()), batch.column(1)], ["b", "label"])

    return rows.mapInArrow(run, "b binary, label int").groupBy("b", "label").agg(F.count("*").alias("n"))


def _cells(rows: DataFrame, cuts: list[np.ndarray], classes: int, n: int) -> DataFrame:
    """The cells of ``rows``, placed and ordered by their values."""
    possible = min(n, math.prod(len(c) + 1 for c in cuts) * classes)
    parts = max(LEAST_PARTITIONS, -(-possible // CELLS_PER_PARTITION))
    return cell_counts(rows, cuts).repartition(parts, "b", "label").sortWithinPartitions("b", "label")


def thresholds(models: Iterable[RandomForestClassificationModel], dims: int) -> list[np.ndarray] | None:
    """The distinct split thresholds of each feature over all ``models``; None if a split is by category."""
    spark, cuts = current_session(), [set() for _ in range(dims)]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for m in models:
        path = scratch_path(spark, "splits")
        m.write().save(path)
        split = forest_nodes(path).where(f"{NODE}.leftChild >= 0").select(f"{NODE}.split.*").distinct().collect()
        hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop(path), True)
        if any(r["numCategories"] >= 0 for r in split):
            return None
        for r in split:                                        # at most maxBins - 1 a feature
            cuts[r["featureIndex"]].add(r["leftCategoriesOrThreshold"][0])
    out = [np.array(sorted(c), dtype=float) for c in cuts]
    return out if all(len(c) < 1 << 16 for c in out) else None


def cell_rows(cells: DataFrame, cuts: list[np.ndarray], features: str, label: str) -> DataFrame:
    """One row ``features, label, n`` for each cell, on the same side of every threshold as the rows it counts."""
    at = [np.append(c, np.nextafter(c[-1], np.inf)) if len(c) else np.zeros(1) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u2").reshape(len(batch), len(at))
            x = np.stack([v[b[:, j]] for j, v in enumerate(at)], axis=1)
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(at)).cast(pa.list_(pa.float64())), batch.column(1), batch.column(2)], ["x", "label", "n"])

    out = cells.mapInArrow(run, "x array<double>, label int, n long")
    return out.select(array_to_vector("x").alias(features), F.col("label").alias(label), F.col("n"))


def _histograms(cells: DataFrame, trees: list[dict], active: dict[int, dict[int, np.ndarray]], sizes: list[int],
                classes: int, bootstrap: bool, seed: int) -> DataFrame:
    """``tree, node, sums`` per task: rows by feature of the node's subset, bin and class."""
    dims, width = len(sizes), max(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if got is None:
            return
        b = np.frombuffer(b"".join(got["b"].to_pylist()), "<u2").reshape(-1, dims)
        y, n, part = np.asarray(got["label"]), np.asarray(got["n"]), TaskContext.get().partitionId()
        for t, nodes in active.items():
            w = np.random.default_rng([seed & 0x7FFFFFFF, t, part]).poisson(n) if bootstrap else n
            at = np.zeros(len(b), dtype=np.int64)
            tree = {k: np.asarray(trees[t][k]) for k in ("feature", "bin", "left", "right")}
            for _ in range(max(trees[t]["depth"])):
                f = tree["feature"][at]
                inner = f >= 0
                low = b[np.arange(len(b)), np.where(inner, f, 0)] <= tree["bin"][at]
                at = np.where(inner, np.where(low, tree["left"][at], tree["right"][at]), at)
            slot = np.full(len(tree["feature"]), -1)
            ids = list(nodes)
            slot[ids] = np.arange(len(ids))
            use = (slot[at] >= 0) & (w > 0)
            if not use.any():
                continue
            where, cell, lab, weight = slot[at][use], b[use], y[use], w[use].astype(np.float64)
            wanted = np.stack([nodes[i] for i in ids])
            sums = np.zeros((len(ids), wanted.shape[1], width, classes))
            for j in np.unique(wanted):
                h = np.bincount((where * width + cell[:, j]) * classes + lab, weight, len(ids) * width * classes).reshape(len(ids), width, classes)
                i, m = np.nonzero(wanted == j)
                sums[i, m] = h[i]
            seen = np.nonzero(sums.any(axis=(1, 2, 3)))[0]
            yield pa.RecordBatch.from_arrays([pa.array([t] * len(seen), pa.int32()), pa.array([ids[s] for s in seen], pa.int32()),
                                              pa.array([sums[s].tobytes() for s in seen], pa.binary())], ["tree", "node", "sums"])
    return cells.mapInArrow(run, "tree int, node int, sums binary")


def gini(counts: np.ndarray) -> float:
    return float(1.0 - ((counts / max(counts.sum(), 1e-300)) ** 2).sum())


def _splits(sums: DataFrame, active: dict[int, dict[int, np.ndarray]], sizes: list[int], classes: int, least: float) -> list:
    """The best split of every node: its tree's sums meet in one group."""
    width = max(sizes)

    # these go to the workers inside ``run``: a function of this module would have to be importable there
    def impurity(counts: np.ndarray) -> np.ndarray:
        total = np.maximum(counts.sum(axis=-1, keepdims=True), 1e-300)
        return 1.0 - ((counts / total) ** 2).sum(axis=-1)

    def best_split(h: np.ndarray, subset: np.ndarray) -> tuple[float, int, int, np.ndarray]:
        """Gain, feature, bin and left class counts of the best split (gain 0: none); first one on ties."""
        best = (0.0, -1, 0, np.zeros(h.shape[2]))
        total = h[0].sum(axis=0)
        for m, j in enumerate(subset):
            left = np.cumsum(h[m], axis=0)[:max(0, sizes[j] - 1)]
            right = total - left
            nl, nr = left.sum(axis=1), right.sum(axis=1)
            ok = (nl >= max(least, 1)) & (nr >= max(least, 1))
            if not ok.any():
                continue
            gain = np.where(ok, impurity(total) - (nl * impurity(left) + nr * impurity(right)) / total.sum(), -1.0)
            s = int(gain.argmax())
            if gain[s] > best[0]:
                best = (float(gain[s]), int(j), s, left[s])
        return best

    def run(table: pa.Table) -> pa.Table:
        added: dict[tuple[int, int], np.ndarray] = {}
        for t, node, raw in zip(*(table[c].to_pylist() for c in ("tree", "node", "sums"))):
            h = np.frombuffer(raw).reshape(-1, width, classes)
            added[t, node] = added[t, node] + h if (t, node) in added else h
        out = []
        for (t, node), h in sorted(added.items()):
            gain, j, s, left = best_split(h, active[t][node])
            out.append((t, node, h[0].sum(axis=0).tolist(), gain, j, s, left.tolist()))
        return pa.table(dict(zip(("tree", "node", "counts", "gain", "feature", "bin", "low"), map(list, zip(*out)))),
                        schema=pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("counts", pa.list_(pa.float64())), ("gain", pa.float64()),
                                          ("feature", pa.int32()), ("bin", pa.int32()), ("low", pa.list_(pa.float64()))]))
    return sums.repartition(min(len(active), SPLIT_PARTITIONS), "tree").groupBy("tree").applyInArrow(
        run, "tree int, node int, counts array<double>, gain double, feature int, bin int, low array<double>").collect()


def _stored_nodes(t: int, tree: dict, cuts: list[np.ndarray]) -> list[tuple]:
    """The tree's nodes as stored: parents first, sibling leaves of one class merged."""
    leaf = [f < 0 for f in tree["feature"]]
    winner = [float(np.argmax(c)) for c in tree["counts"]]
    for i in reversed(range(len(leaf))):                       # children come after their parent
        if not leaf[i]:
            l, r = tree["left"][i], tree["right"][i]
            leaf[i] = leaf[l] and leaf[r] and winner[l] == winner[r]
    order, stack = [], [0]
    while stack:
        i = stack.pop()
        order.append(i)
        if not leaf[i]:
            stack += [tree["right"][i], tree["left"][i]]
    place = {i: k for k, i in enumerate(order)}
    out = []
    for i in order:
        c, f = tree["counts"][i], tree["feature"][i]
        split = (-1, [], -1) if leaf[i] else (int(f), [float(cuts[f][tree["bin"][i]])], -1)
        out.append((t, (place[i], winner[i], gini(np.asarray(c)), [float(v) for v in c], int(sum(c)), -1.0 if leaf[i] else tree["gain"][i],
                        -1 if leaf[i] else place[tree["left"][i]], -1 if leaf[i] else place[tree["right"][i]], split)))
    return out


def fit_binned(est: RandomForestClassifier, train: DataFrame) -> RandomForestClassificationModel:
    """The forest that ``est`` describes, fitted on all rows of ``train``."""
    x, label = vector_to_array(F.col(est.getFeaturesCol())).alias("x"), F.col(est.getLabelCol()).cast("int").alias("label")
    shape = train.agg(F.max(label).alias("top"), F.count("*").alias("n")).first()
    if not shape["n"]:
        raise ValueError("no rows to fit")
    n, classes, bins = shape["n"], max(2, shape["top"] + 1), est.getMaxBins()
    asked = max(bins * bins, SAMPLE_ROWS)
    some = train if n <= asked else train.sample(fraction=asked / n, seed=est.getSeed())
    seen = np.array([r["x"] for r in some.select(x).collect()], dtype=float)          # about max(10,000, maxBins^2) rows
    dims, rows = seen.shape[1], train.select(x, label)
    cuts = [_cuts(seen[:, j], bins) for j in range(dims)]
    sizes, subset = [len(c) + 1 for c in cuts], math.ceil(math.sqrt(dims))
    cells = _cells(rows, cuts, classes, n)
    least, seed = est.getMinWeightFractionPerNode() * n, est.getSeed()
    trees: list[dict] = [{"feature": [-1], "bin": [0], "left": [0], "right": [0], "depth": [0], "counts": [None], "gain": [-1.0]}
                         for _ in range(est.getNumTrees())]

    def drawn(t: int, node: int) -> np.ndarray:
        return np.sort(np.random.default_rng([seed & 0x7FFFFFFF, t, node, 1]).choice(dims, subset, replace=False))

    active = {t: {0: drawn(t, 0)} for t in range(len(trees))}
    with held(cells):
        for level in range(est.getMaxDepth() + 1):
            if not active:
                break
            sums = _histograms(cells, trees, active, sizes, classes, est.getBootstrap(), seed)
            grown: dict[int, dict[int, np.ndarray]] = {}
            for r in sorted(_splits(sums, active, sizes, classes, least), key=lambda r: (r["tree"], r["node"])):
                t, node, tree = r["tree"], r["node"], trees[r["tree"]]
                counts, low = np.asarray(r["counts"]), np.asarray(r["low"])
                tree["counts"][node] = counts.tolist()
                if r["feature"] < 0 or level >= est.getMaxDepth():
                    continue
                tree["feature"][node], tree["bin"][node], tree["gain"][node] = r["feature"], r["bin"], r["gain"]
                for side, c in (("left", low), ("right", counts - low)):
                    new = len(tree["feature"])
                    tree[side][node] = new
                    for k, v in (("feature", -1), ("bin", 0), ("left", 0), ("right", 0), ("depth", level + 1), ("counts", c.tolist()), ("gain", -1.0)):
                        tree[k].append(v)
                    if level + 1 < est.getMaxDepth() and (c > 0).sum() > 1 and c.sum() >= 2 * max(least, 1):
                        grown.setdefault(t, {})[new] = drawn(t, new)
            active = grown
    for tree in trees:                                          # a bootstrap of few rows may draw none
        tree["counts"] = [c if c is not None else [0.0] * classes for c in tree["counts"]]
    return _loaded(est, [r for t, tree in enumerate(trees) for r in _stored_nodes(t, tree, cuts)], dims, classes)


def _loaded(est: RandomForestClassifier, nodes: list[tuple], dims: int, classes: int) -> RandomForestClassificationModel:
    """The model of these nodes: a forest of as many bare roots is stored, its nodes replaced, and loaded."""
    spark = current_session()
    blank = spark.createDataFrame([([0.0] * dims, float(c)) for c in range(classes)], "x array<double>, label double").coalesce(1)
    blank = blank.select(array_to_vector("x").alias(est.getFeaturesCol()), F.col("label").alias(est.getLabelCol()))
    path = scratch_path(spark, "binned")
    roots = est.copy()
    roots.setParams(maxDepth=0)
    roots.fit(blank).write().save(path)
    spark.createDataFrame(nodes, NODE_FIELDS).coalesce(1).write.parquet(f"{path}/grown")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(hadoop(f"{path}/data"), True)
    fs.rename(hadoop(f"{path}/grown"), hadoop(f"{path}/data"))
    out = RandomForestClassificationModel.load(path)
    fs.delete(hadoop(path), True)                  # the loaded model is on the driver
    return est._copyValues(out)
