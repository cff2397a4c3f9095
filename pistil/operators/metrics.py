"""Scoring metrics as distributed aggregates over (label, prediction) columns.

Any number of models is scored from one pass: each row is counted once per model under its (label,
prediction), combined map-side, so a few counts per model leave a task. Every metric that depends on the
confusion counts alone (``METRICS``, or a ``CountMetric`` of the caller's) is then computed from them.
A plain callable still gets a trial's (label, prediction) frame, one pass a trial.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .binned_forest import cell_counts, cell_rows, thresholds
from .models import predict


def accuracy(df: DataFrame, label_col: str = "label", pred_col: str = "prediction"
             ) -> DataFrame:
    """One row: ``accuracy`` (share of rows whose prediction equals the label) and ``rows``.

    Equality is null-safe, as an element-wise comparison of two label lists would be.
    """
    hit = F.col(pred_col).eqNullSafe(F.col(label_col)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("rows"))


def accuracy_value(df: DataFrame, label_col: str = "label",
                   pred_col: str = "prediction") -> float:
    return float(accuracy(df, label_col, pred_col).first()["accuracy"])


def confusion_counts(df: DataFrame, label: str | Column, predictions: Mapping[Any, str | Column], rows: Column | None = None) -> DataFrame:
    """``trial, label, prediction, n`` for every named prediction column of ``df``, in one aggregate (``rows``, a sum of
    the column ``n``, where a row of ``df`` stands for several)."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    each = F.array(*[F.struct(F.lit(t).alias("trial"), col(c).alias("prediction")) for t, c in predictions.items()])
    return (df.select(col(label).alias("label"), F.explode(each).alias("e"), *([] if rows is None else ["n"]))
              .groupBy("e.trial", "label", "e.prediction").agg((F.count("*") if rows is None else rows).alias("n"))
              .select("trial", "label", "prediction", "n"))


def confusion_metrics(counts: DataFrame, by: str = "trial") -> DataFrame:
    """One row per trial of ``confusion_counts``: ``rows, accuracy, precision_macro, recall_macro, f1_macro, f1_weighted,
    kappa``. Averages run over the classes that occur as label or prediction (null is a class); a class without
    predictions has precision 0, one without labels recall 0, one with neither right nor wrong F1 0."""
    sides = F.array(*[F.struct(F.col(c).alias("class"), F.when(F.lit(c == "label"), F.col("n")).otherwise(0).alias("labels"),
                               F.when(F.lit(c == "prediction"), F.col("n")).otherwise(0).alias("predicted"),
                               F.when(F.lit(c == "label") & F.col("label").eqNullSafe(F.col("prediction")), F.col("n")).otherwise(0).alias("hit"))
                      for c in ("label", "prediction")])
    classes = (counts.select(by, F.explode(sides).alias("s")).groupBy(by, "s.class")
                     .agg(*[F.sum(f"s.{c}").alias(c) for c in ("labels", "predicted", "hit")]))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    per = classes.select("*", ratio(F.col("hit"), F.col("predicted")).alias("p"), ratio(F.col("hit"), F.col("labels")).alias("r"),
                         ratio(2 * F.col("hit"), F.col("labels") + F.col("predicted")).alias("f"))
    out = per.groupBy(by).agg(
        F.sum("labels").alias("rows"), (F.sum("hit") / F.sum("labels")).alias("accuracy"), F.avg("p").alias("precision_macro"),
        F.avg("r").alias("recall_macro"), F.avg("f").alias("f1_macro"), (F.sum(F.col("f") * F.col("labels")) / F.sum("labels")).alias("f1_weighted"),
        F.sum(F.col("labels").cast("double") * F.col("predicted")).alias("_both"))
    chance = F.col("_both") / F.col("rows") / F.col("rows")
    return out.withColumn("kappa", F.when(chance < 1, (F.col("accuracy") - chance) / (1 - chance)).otherwise(0.0)).drop("_both")


# Confusion counts of one trial: (label, prediction) -> rows.
Counts = Mapping[tuple[Any, Any], int]


@dataclass(frozen=True)
class CountMetric:
    """A metric computed from confusion counts; all trials of a batch share one pass over the rows."""
    of: Callable[[Counts], float]


def _ratio(a: float, b: float) -> float:
    return a / b if b else 0.0


def _classes(n: Counts) -> dict[Any, tuple[int, int, int]]:
    """Class -> rows with that label, with that prediction, with both."""
    names = {k for pair in n for k in pair}
    return {c: (sum(v for (a, _), v in n.items() if a == c), sum(v for (_, b), v in n.items() if b == c), n.get((c, c), 0))
            for c in names}


def _accuracy(n: Counts) -> float:
    return _ratio(sum(h for _, _, h in _classes(n).values()), sum(n.values()))


def _mean(value: Callable[[int, int, int], float]) -> Callable[[Counts], float]:
    return lambda n: _ratio(sum(value(*c) for c in _classes(n).values()), len(_classes(n)))


def _f1_weighted(n: Counts) -> float:
    return _ratio(sum(a * _ratio(2 * h, a + b) for a, b, h in _classes(n).values()), sum(n.values()))


def _kappa(n: Counts) -> float:
    rows = sum(n.values())
    chance = _ratio(sum(a * b for a, b, _ in _classes(n).values()), rows * rows)
    return _ratio(_accuracy(n) - chance, 1 - chance)


# A metric maps confusion counts, or a frame with ``label`` and ``prediction`` columns, to one float;
# higher is better when used with ``maximize=True``.
Metric = Callable[[DataFrame], float] | CountMetric

METRICS: dict[str, CountMetric] = {
    "accuracy": CountMetric(_accuracy),
    "precision_macro": CountMetric(_mean(lambda a, b, h: _ratio(h, b))),
    "recall_macro": CountMetric(_mean(lambda a, b, h: _ratio(h, a))),
    "f1_macro": CountMetric(_mean(lambda a, b, h: _ratio(2 * h, a + b))),
    "f1_weighted": CountMetric(_f1_weighted),
    "kappa": CountMetric(_kappa),
}


def resolve_metric(metric: str | Metric) -> Metric:
    if isinstance(metric, CountMetric) or callable(metric):
        return metric
    try:
        return METRICS[metric]
    except KeyError:
        raise ValueError(f"unknown metric {metric!r}; known: {sorted(METRICS)}") from None


CELL_ROWS = 250_000               # forests score more rows than this by cells


def _forest_counts(models: Mapping[int, Model], df: DataFrame, label_col: str) -> dict[int, dict[tuple, int]] | None:
    """Confusion counts of forests: rows on the same side of every threshold get the same prediction, so they are counted
    in one pass and each such cell is predicted once. None where splits are not by threshold."""
    features = next(iter(models.values())).getFeaturesCol()
    dims = next(iter(models.values())).numFeatures
    cuts = thresholds(models.values(), dims)
    if cuts is None:
        return None
    rows = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label_col).cast("int").alias("label"))
    cells = cell_rows(cell_counts(rows, cuts), cuts, features, label_col)
    return _chained_counts(models, cells, label_col, F.sum("n"))


def model_counts(models: Mapping[int, Model], df: DataFrame, label_col: str = "label") -> dict[int, dict[tuple, int]]:
    """Confusion counts of every model from one pass over ``df``; one more for forests over many rows."""
    forests = {t: m for t, m in models.items() if isinstance(m, RandomForestClassificationModel)}
    if forests and len({m.getFeaturesCol() for m in forests.values()}) == 1 and df.count() > CELL_ROWS:
        found = _forest_counts(forests, df, label_col)
        if found is not None:
            rest = {t: m for t, m in models.items() if t not in forests}
            return {**found, **(_chained_counts(rest, df, label_col) if rest else {})}
    return _chained_counts(models, df, label_col)


def _chained_counts(models: Mapping[int, Model], df: DataFrame, label_col: str, rows: Column | None = None) -> dict[int, dict[tuple, int]]:
    """The models' transforms are chained on the same rows. Classes squared times models small rows reach the driver."""
    scored = df.select("*")
    for tid, model in models.items():
        scored = predict(model, scored, prefix=f"_t{tid}_", probability_array=False).drop(f"_t{tid}_probability_vec")
    out: dict[int, dict[tuple, int]] = {tid: {} for tid in models}
    for r in confusion_counts(scored, F.col(label_col).cast("double"), {t: f"_t{t}_prediction" for t in models}, rows).collect():
        out[r["trial"]][(r["label"], r["prediction"])] = r["n"]
    return out


def score_model(model: Model, df: DataFrame, metric: Metric, label_col: str = "label") -> float:
    if isinstance(metric, CountMetric):
        return float(metric.of(model_counts({0: model}, df, label_col)[0]))
    return float(metric(predict(model, df, probability_array=False).select(F.col(label_col).alias("label"), "prediction")))


def batch_scores(models: Mapping[int, Model], df: DataFrame, metric: Metric, label_col: str = "label"
                 ) -> tuple[dict[int, float], dict[int, Exception]]:
    """Scores by trial, and the errors of trials that could not be scored. One pass for all models, unless the
    metric wants rows or one bad model fails the pass: then one by one."""
    scores: dict[int, float] = {}
    errors: dict[int, Exception] = {}
    if models and isinstance(metric, CountMetric):
        try:
            counts = model_counts(models, df, label_col)
            return {t: float(metric.of(n)) for t, n in counts.items()}, errors
        except Exception:  # noqa: BLE001 - one bad model must not spoil the batch
            pass
    for tid, m in models.items():
        try:
            scores[tid] = score_model(m, df, metric, label_col)
        except Exception as e:  # noqa: BLE001 - that trial failed, the others did not
            errors[tid] = e
    return scores, errors
