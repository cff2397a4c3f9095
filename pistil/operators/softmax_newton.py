"""Multinomial logistic regression over many rows, in a few passes instead of one pass per L-BFGS step.

Spark's own fit reads all rows once a step and takes up to ``maxIter`` of them. Here the same objective (mean log-loss plus
``regParam / 2`` times the squared weights, intercepts free) is minimised by Newton's method, first over about
``start_rows`` of the rows, from there on over all of them, so that a handful of passes over all rows is left. A pass sums
loss, gradient and second derivatives over the rows (numpy inside tasks, Spark adds them up); the driver solves
one system of classes times features. It ends as Spark's does: by ``maxIter``, or once a step lowers the mean loss by
less than ``tol`` times that of no model. Rows are packed (features and label as bytes) and cached once for all
fits that run side by side on them.

The result is a ``LogisticRegressionModel``, loaded from its stored form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, MatrixUDT, Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import current_session, held, scratch_path

MAX_WEIGHTS = 300                 # classes times features; second derivatives are summed in full
START_PARTITIONS = 16
STORED = T.StructType([T.StructField("numClasses", T.IntegerType()), T.StructField("numFeatures", T.IntegerType()),
                       T.StructField("interceptVector", VectorUDT()), T.StructField("coefficientMatrix", MatrixUDT()),
                       T.StructField("isMultinomial", T.BooleanType())])


def _packed(rows: DataFrame, dims: int) -> DataFrame:
    """Blocks of rows ``x, label``: features as doubles and labels as two bytes each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column(0).flatten(), dtype="<f8").reshape(len(b), dims)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([np.asarray(b.column(1)).astype("<u2").tobytes()], pa.binary())], ["x", "y"])
    return rows.mapInArrow(run, "x binary, y binary")


def _sums(blocks: DataFrame, w: np.ndarray, mean: np.ndarray, size: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Summed loss, gradient and second derivatives at the weights ``w`` of the scaled features, the intercepts last."""
    k, dims = w.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, grad, curve = 0.0, np.zeros((k, dims)), np.zeros((k, dims, k, dims))
        for b in batches:
            for xs, ys in zip(b.column(0), b.column(1)):
                y = np.frombuffer(ys.as_buffer(), "<u2")
                x = np.ones((len(y), dims))
                x[:, :-1] = (np.frombuffer(xs.as_buffer(), "<f8").reshape(len(y), dims - 1) - mean) / size
                m = x @ w.T
                m -= m.max(axis=1, keepdims=True)
                p, at = np.exp(m), np.arange(len(y))
                total = p.sum(axis=1)
                p /= total[:, None]
                loss += float((np.log(total) - m[at, y]).sum())
                z = (p[:, :, None] * x[:, None, :]).reshape(len(y), k * dims)
                curve -= (z.T @ z).reshape(curve.shape)
                own = (x.T @ z).reshape(dims, k, dims)
                for c in range(k):
                    curve[c, :, c] += own[:, c]
                p[at, y] -= 1.0
                grad += p.T @ x
        flat = np.concatenate([[loss], grad.ravel(), curve.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["i", "v"])

    out = np.zeros(1 + k * dims + (k * dims) ** 2)
    for r in blocks.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]                                   # (classes * features) squared numbers
    return float(out[0]), out[1:1 + k * dims].reshape(k, dims), out[1 + k * dims:].reshape(k * dims, k * dims)


def _newton(blocks: DataFrame, n: int, w: np.ndarray, mean: np.ndarray, size: np.ndarray, penalty: np.ndarray,
            enough: float, most: int) -> tuple[np.ndarray, int, bool]:
    """The least mean loss plus ``penalty / 2 * w^2`` from the weights ``w`` on, its steps, and whether none got stuck."""
    def value(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, grad, curve = _sums(blocks, w, mean, size)
        weight = np.tile(penalty, len(w))
        return loss / n + float((penalty * w * w).sum()) / 2, grad / n + penalty * w, curve / n + np.diag(weight)

    now, grad, curve = value(w)
    step, scale, steps = None, 1.0, 0
    while steps < most:
        if step is None:
            unit = np.sqrt(np.diag(curve))                     # lstsq drops directions that are small beside others
            unit[unit == 0] = 1.0
            step, scale = (np.linalg.lstsq(curve / np.outer(unit, unit), grad.ravel() / unit, rcond=None)[0] / unit).reshape(w.shape), 1.0
        trial = w - scale * step
        got = value(trial)
        steps += 1
        if not got[0] <= now + 1e-12 * max(now, enough):       # also where it is not a number
            scale /= 2
            if scale < 1e-3:
                return w, steps, False
            continue
        full, gain, w, step = scale == 1.0, now - got[0], trial, None
        now, grad, curve = got
        if full and gain <= enough:
            break
    return w, steps, True


def fits_large(est: LogisticRegression) -> bool:
    """Whether ``est`` asks for what is minimised here."""
    return (est.getElasticNetParam() == 0.0 and est.getFitIntercept() and not est.getStandardization() and est.getFamily() == "multinomial"
            and not any(est.isDefined(p) for p in ("weightCol", "lowerBoundsOnCoefficients", "upperBoundsOnCoefficients",
                                                   "lowerBoundsOnIntercepts", "upperBoundsOnIntercepts")))


def _named_classes(train: DataFrame, label: str) -> int:
    """Classes that the label column's metadata name (0: none)."""
    return len(train.schema[label].metadata.get("ml_attr", {}).get("vals", []))


def fit_large(est: LogisticRegression, train: DataFrame, start_rows: int) -> LogisticRegressionModel:
    """The model that ``est`` describes, fitted on all rows of ``train``."""
    x, label = vector_to_array(F.col(est.getFeaturesCol())).alias("x"), F.col(est.getLabelCol()).cast("int").alias("label")
    rows = train.select(x, label)
    seen = dict(rows.groupBy("label").count().collect())       # a row a class
    n, dims = sum(seen.values()), len(rows.first()["x"])
    classes = max(max(seen) + 1, _named_classes(train, est.getLabelCol()))
    if len(seen) < 2 or classes * (dims + 1) > MAX_WEIGHTS:
        return est.fit(train)
    with held(rows.sample(fraction=min(1.0, start_rows / n), seed=0).coalesce(START_PARTITIONS)) as part:
        each = [f(F.col("x")[j]).alias(f"{name}{j}") for j in range(dims) for name, f in (("m", F.avg), ("s", F.stddev_pop))]
        few = part.agg(F.count("*").alias("n"), F.count_distinct("label").alias("classes"), *each).first()
        # any scale gives the same optimum; this one makes the system well conditioned
        mean = np.array([few[f"m{j}"] or 0.0 for j in range(dims)])
        size = np.array([few[f"s{j}"] or 0.0 for j in range(dims)])
        size[size <= 1e-9 * np.abs(mean)] = 1.0                # constant but for rounding
        penalty = np.append(est.getRegParam() / size ** 2, 0.0)
        zeros, enough, well = np.zeros((classes, dims + 1)), est.getTol() * float(np.log(classes)), False
        if few["classes"] == len(seen):                        # weights of a class that it lacks would run off
            with held(_packed(part, dims)) as start:
                w, _, well = _newton(start, few["n"], zeros, mean, size, penalty, enough, est.getMaxIter())
    with held(_packed(rows, dims)) as blocks:
        for first in (w, zeros) if well else (zeros,):         # few rows may be separable where all are not
            w, steps, well = _newton(blocks, n, first, mean, size, penalty, enough, est.getMaxIter())
            if well:
                break
    if not well:                                               # the surface is too flat for Newton's steps
        return est.fit(train)
    w[:, :-1] /= size
    w[:, -1] -= w[:, :-1] @ mean
    w[:, -1] -= w[:, -1].mean()                                # as Spark's, intercepts add up to 0
    if not est.getRegParam():
        w[:, :-1] -= w[:, :-1].mean(axis=0)
    model = _loaded(est, w)
    model.newton_steps = steps
    return model


def _loaded(est: LogisticRegression, w: np.ndarray) -> LogisticRegressionModel:
    """The model of these weights: one of bare zeros is stored, its weights replaced, and loaded."""
    spark, (classes, dims) = current_session(), (len(w), w.shape[1] - 1)
    blank = spark.createDataFrame([([0.0] * dims, float(c)) for c in range(classes)], "x array<double>, label double").coalesce(1)
    blank = blank.select(array_to_vector("x").alias(est.getFeaturesCol()), F.col("label").alias(est.getLabelCol()))
    path = scratch_path(spark, "softmax")
    zeros = est.copy()
    zeros.setParams(maxIter=0)
    zeros.fit(blank).write().save(path)
    row = (classes, dims, Vectors.dense(w[:, -1].tolist()), DenseMatrix(classes, dims, w[:, :-1].T.ravel().tolist()), True)
    spark.createDataFrame([row], STORED).coalesce(1).write.parquet(f"{path}/fitted")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(hadoop(f"{path}/data"), True)
    fs.rename(hadoop(f"{path}/fitted"), hadoop(f"{path}/data"))
    out = LogisticRegressionModel.load(path)
    fs.delete(hadoop(path), True)                  # the loaded model is on the driver
    return est._copyValues(out)
