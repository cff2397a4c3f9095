"""Refit on train + validation, soft-vote ensemble, test accuracy.

Both models transform the same frame one after the other, so their probabilities
sit on the same row: no positional pairing and no join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import argmax, index_to_label, mean_arrays
from .metrics import accuracy
from .models import FitContext, Family, fit, predict


def refit(train_val: DataFrame, family: str | Family, params: dict[str, Any],
          ctx: FitContext) -> Model:
    """Fit ``family`` with chosen params on the combined training data."""
    return fit(family, params, train_val, ctx)


def union_train_val(train: DataFrame, val: DataFrame) -> DataFrame:
    """Row concatenation, duplicates kept (no shuffle)."""
    return train.unionByName(val)


def soft_vote(df: DataFrame, models: Mapping[str, Model], labels: Sequence[Any],
              keep: Sequence[str] = (), label_type: str | None = None,
              prob_col: str = "probability", index_col: str = "prediction_index",
              pred_col: str = "predicted") -> DataFrame:
    """Average the class probabilities of ``models`` and take the most likely class.

    Ties go to the first (smallest) class index. The predicted label comes from the
    fitted label list, cast back to ``label_type`` when the target was not a string.
    """
    if not models:
        raise ValueError("soft_vote needs at least one model")
    out = df
    names = list(models)
    for name in names:
        out = predict(models[name], out, prefix=f"{name}_")
    probs = [F.col(f"{n}_probability") for n in names]
    label = index_to_label(F.col(index_col), [str(v) for v in labels])
    if label_type:
        label = label.cast(label_type)
    return (out.withColumn(prob_col, mean_arrays(*probs, size=len(labels)))
               .withColumn(index_col, argmax(prob_col))
               .select(*keep, *[f"{n}_probability" for n in names], prob_col, index_col,
                       label.alias(pred_col)))


def ensemble_accuracy(predictions: DataFrame, target_col: str,
                      pred_col: str = "predicted") -> DataFrame:
    return accuracy(predictions, target_col, pred_col)
