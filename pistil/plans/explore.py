"""Exploration: the five descriptive queries of the original notebook as frames.

``profile_report`` gives all of them from one scan; the separate frames are there
for users who want the original shapes (``describe`` strings, ``count`` and
``avg(col)`` column names).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import profile


def explore(df: DataFrame, numeric_cols: Sequence[str], class_col: str, mean_col: str,
            corr_pair: tuple[str, str], order_cols: Sequence[str] | None = None,
            n_head: int = 5) -> dict[str, DataFrame]:
    return {
        "head": profile.head(df, n_head, order_cols),
        "describe": profile.describe_strings(df, numeric_cols),
        "class_counts": profile.class_counts(df, class_col),
        "class_means": df.groupBy(class_col).agg(F.avg(mean_col).alias(f"avg({mean_col})")),
        "corr": df.agg(profile.safe_corr(*corr_pair).alias(f"corr({corr_pair[0]}, {corr_pair[1]})")),
    }


def report(df: DataFrame, numeric_cols: Sequence[str], class_col: str,
           pairs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Everything in one pass, long form (see ``profile.profile_report``)."""
    return profile.profile_report(df, numeric_cols, class_col, pairs)
