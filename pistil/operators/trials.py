"""Trial bookkeeping as frame operators: score -> loss, best trial per experiment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score_to_loss(score: str | Column, maximize: bool = True) -> Column:
    """Loss to minimise: ``-score`` when the metric is maximised, else the score."""
    s = F.col(score) if isinstance(score, str) else score
    return -s if maximize else s


def best_trial(trials: DataFrame, group_cols: Sequence[str] = ("experiment",),
               trial_col: str = "trial_id", loss_col: str = "val_loss",
               status_col: str | None = "status") -> DataFrame:
    """Lowest-loss trial per group; the smallest trial id wins ties.

    Only successful trials with a loss take part (a NULL loss would sort first in
    Spark); NaN sorts above every number, so a NaN loss wins only when nothing else
    is left. ``min_by`` over a (loss, id) struct aggregates partially before the exchange
    (Spark sorts for it, as its buffer is a struct): no single-task window, any group size.
    """
    ok = trials.where(F.col(loss_col).isNotNull())
    if status_col:
        ok = ok.where(F.col(status_col) == F.lit("ok"))
    order = F.struct(F.col(loss_col).alias("l"), F.col(trial_col).alias("t"))
    row = F.struct(*[F.col(c) for c in trials.columns if c not in group_cols])
    best = ok.groupBy(*group_cols).agg(F.min_by(row, order).alias("_best"))
    return best.select(*group_cols, "_best.*")
