"""Logistic regression as one two-class fit per class, with the intercept penalised like a weight.

That is the optimum of the ``liblinear`` solver: for each class c it minimises
``C * sum(log(1 + exp(-y (w . x + b)))) + (|w|^2 + b^2) / 2`` with y = +1 for rows of class c, else -1. Two classes need one
fit. Probabilities are the classes' sigmoids, divided by their sum; the predicted class has the largest margin,
the first on ties.

Spark's own logistic regression cannot penalise an intercept (and gives a constant feature the weight 0), so
the optimum is found by Newton's method (over many rows from the optimum of a few of them, so that a handful of steps
is left for all): a pass sums loss, gradient and second derivatives of all classes over the
rows (numpy inside tasks; a task sends k * D * D numbers, D features with the constant, and Spark adds
them up), the driver solves k systems of size D. The objective is convex; a step that does not lower it
is halved. The optimum does not depend on the features' scales.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol,
                                     HasRawPredictionCol, HasRegParam, HasTol)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import current_session, held

MARKER = "one_vs_rest"
MAX_FEATURES = 1000               # second derivatives are summed in full
LARGE = 4                         # fits over more than this many times ``startRows`` rows start from a fit of that many
START_PARTITIONS = 16
STORED = "coefficients array<array<double>>, iterations int, features string, prediction string, probability string, raw string"


class _Columns(HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    """The columns that the estimator and its models share."""


def _sums(rows: DataFrame, w: np.ndarray, targets: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, gradient and second derivatives of each class's summed loss at its weights, over rows ``x, label``."""
    k, dims = w.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, 2 + dims, dims))
        for b in batches:
            x = np.asarray(b.column(0).flatten()).reshape(len(b), dims - 1)
            x = np.concatenate([x, np.ones((len(b), 1))], axis=1)
            label = np.asarray(b.column(1))
            for c in range(k):
                y, m = label == targets[c], x @ w[c]
                e = np.exp(-np.abs(m))                        # one exponential and one logarithm a row and class
                p = np.where(m >= 0, 1.0, e) / (1.0 + e)
                total[c, 0, 0] += (np.log1p(e) + np.maximum(np.where(y, -m, m), 0.0)).sum()
                total[c, 1] += (p - y) @ x
                total[c, 2:] += (x * (p * (1 - p))[:, None]).T @ x
        at = np.indices(total.shape).reshape(3, -1)
        full = total.ravel() != 0
        yield pa.RecordBatch.from_arrays([*(pa.array(i[full].astype(np.int32)) for i in at), pa.array(total.ravel()[full])],
                                         ["c", "i", "j", "v"])

    out = np.zeros((k, 2 + dims, dims))
    for r in rows.mapInArrow(run, "c int, i int, j int, v double").groupBy("c", "i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["c"], r["i"], r["j"]] = r["v"]                  # k * D * D numbers
    return out[:, 0, 0], out[:, 1], out[:, 2:]


def _newton(rows: DataFrame, w: np.ndarray, targets: Sequence[int], penalty: float, most: int, tol: float) -> tuple[np.ndarray, int]:
    """The optimum of the summed loss plus ``penalty / 2 * |w|^2`` from the weights ``w`` on, and its passes over ``rows``."""
    value = lambda loss, w: loss + penalty / 2 * (w * w).sum(axis=1)
    loss, grad, curve = _sums(rows, w, targets)
    now, step, steps = value(loss, w), None, 0
    scale = np.ones(len(targets))
    while steps < most:
        if step is None:
            step = np.stack([np.linalg.lstsq(h + penalty * np.eye(len(g)), g + penalty * v, rcond=None)[0]
                             for g, h, v in zip(grad, curve, w)])
            scale = np.ones(len(targets))
        trial = w - scale[:, None] * step
        got = _sums(rows, trial, targets)
        steps += 1
        gain = now - value(got[0], trial)
        worse = gain < -1e-12 * np.maximum(now, 1.0)
        if worse.any() and scale.min() > 1e-6:
            scale = np.where(worse, scale / 2, scale)
            continue
        done = bool((np.abs(gain) <= tol * np.maximum(now, 1e-12)).all())
        w, (loss, grad, curve), step = np.where(worse[:, None], w, trial), got, None
        now = value(loss, w)
        if done or worse.any():
            break
    return w, steps


class OneVsRestLogistic(Estimator, _Columns, HasLabelCol, HasRegParam, HasMaxIter, HasTol):
    """Estimator; ``regParam`` is ``1 / (C * rows)``, ``tol`` bounds the last step's relative gain. Over many rows
    Newton's method starts at the optimum of about ``startRows`` of them (0: always at zero); it ends by all rows."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", regParam=0.0, maxIter=100, tol=1e-10, startRows=0):
        super().__init__()
        given = dict(self._input_kwargs)
        self.startRows = given.pop("startRows", 0)
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability",
                         rawPredictionCol="rawPrediction", regParam=0.0, maxIter=100, tol=1e-10)
        self._set(**given)

    def setParams(self, **params):
        return self._set(**{k: v for k, v in params.items() if self.hasParam(k)})

    def _fit(self, dataset: DataFrame) -> "OneVsRestLogisticModel":
        label, x = F.col(self.getLabelCol()).cast("int"), vector_to_array(F.col(self.getFeaturesCol()))
        rows = dataset.select(x.alias("x"), label.alias("label"))
        shape = rows.agg(F.max("label").alias("top"), F.max(F.size("x")).alias("dims"), F.count("*").alias("n")).first()
        if not shape["n"]:
            raise ValueError("no rows to fit")
        if shape["dims"] > MAX_FEATURES:
            raise ValueError(f"solver 'liblinear' takes at most {MAX_FEATURES} features here, got {shape['dims']}")
        classes = shape["top"] + 1
        targets = list(range(classes)) if classes > 2 else [1]
        w = np.zeros((len(targets), shape["dims"] + 1))
        if self.startRows and shape["n"] > LARGE * self.startRows:
            with held(rows.sample(fraction=self.startRows / shape["n"], seed=0).coalesce(START_PARTITIONS)) as part:
                w, _ = _newton(part, w, targets, self.getRegParam() * part.count(), self.getMaxIter(), self.getTol())
        w, steps = _newton(rows, w, targets, self.getRegParam() * shape["n"], self.getMaxIter(), self.getTol())
        return self._copyValues(OneVsRestLogisticModel(w, steps))


def _dot(x: Column, w: Sequence[float]) -> Column:
    """``x . w`` plus the constant's weight (the last), for an array column."""
    if len(w) <= 33:
        out = F.lit(float(w[-1]))
        for j, v in enumerate(w[:-1]):
            out = out + F.lit(float(v)) * x[j]
        return out
    return F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in w[:-1]]), lambda a, b: a * b), F.lit(float(w[-1])), lambda a, b: a + b)


class OneVsRestLogisticModel(Model, _Columns):
    """Weights per class (one row for two classes), the intercept last."""

    def __init__(self, coefficients, iterations: int | None = None):
        super().__init__()
        self.coefficients, self.totalIterations = np.asarray(coefficients, dtype=float), iterations
        self._setDefault(featuresCol="features", predictionCol="prediction", probabilityCol="probability", rawPredictionCol="rawPrediction")

    @property
    def numClasses(self) -> int:
        return max(2, len(self.coefficients))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x, margins = f"_x_{uuid4().hex[:6]}", f"_m_{uuid4().hex[:6]}"
        out = dataset.withColumn(x, vector_to_array(F.col(self.getFeaturesCol())))
        each = [_dot(F.col(x), w) for w in self.coefficients.tolist()]
        if len(each) == 1:
            each = [-each[0], each[0]]
        out = out.withColumn(margins, F.array(*each)).drop(x)
        every = [F.col(margins)[i] for i in range(self.numClasses)]
        sigmoid = [F.lit(1.0) / (F.lit(1.0) + F.exp(-m)) for m in every]
        total = sigmoid[0]
        for s in sigmoid[1:]:
            total = total + s
        best = F.array_position(F.col(margins), F.greatest(*every)).cast("double") - 1.0
        return (out.withColumn(self.getRawPredictionCol(), array_to_vector(F.col(margins)))
                   .withColumn(self.getProbabilityCol(), array_to_vector(F.array(*[s / total for s in sigmoid])))
                   .withColumn(self.getPredictionCol(), best).drop(margins))

    def save(self, path: str) -> None:
        """The weights and column names as one row (overwrites)."""
        row = (self.coefficients.tolist(), self.totalIterations, self.getFeaturesCol(), self.getPredictionCol(), self.getProbabilityCol(), self.getRawPredictionCol())
        current_session().createDataFrame([row], STORED).coalesce(1).write.mode("overwrite").parquet(f"{path}/{MARKER}")

    @staticmethod
    def stored_at(path: str) -> bool:
        spark = current_session()
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MARKER}")
        return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))

    @classmethod
    def load(cls, path: str) -> "OneVsRestLogisticModel":
        r = current_session().read.schema(STORED).parquet(f"{path}/{MARKER}").first()
        model = cls(r["coefficients"], r["iterations"])
        return model._set(featuresCol=r["features"], predictionCol=r["prediction"], probabilityCol=r["probability"], rawPredictionCol=r["raw"])
