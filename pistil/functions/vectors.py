"""Array expressions for class probabilities: soft vote, argmax, index -> label.

All of them are built-in higher-order functions, so they run inside codegen on
executors; no Python UDF is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mean_arrays(*arrays: str | Column, size: int | None = None) -> Column:
    """Element-wise mean of equally long numeric arrays (soft vote of k models).

    With ``size`` (the number of classes, known once the label list is fitted) the
    mean is spelled out element by element, which stays inside whole-stage codegen;
    without it a ``zip_with``/``transform`` lambda handles any length.
    """
    if not arrays:
        raise ValueError("need at least one probability array")
    cols = [_col(a) for a in arrays]
    if len(cols) == 1:
        return cols[0]
    if size is not None:
        k = float(len(cols))
        return F.array(*[sum((c[i] for c in cols[1:]), cols[0][i]) / F.lit(k)
                         for i in range(size)])
    if len(cols) == 2:
        return F.zip_with(cols[0], cols[1], lambda x, y: (x + y) / F.lit(2.0))
    k = float(len(cols))
    return F.transform(cols[0], lambda x, i: (x + sum(c[i] for c in cols[1:])) / F.lit(k))


def argmax(arr: str | Column) -> Column:
    """0-based index of the largest element; the first one wins ties."""
    a = _col(arr)
    return (F.array_position(a, F.array_max(a)) - F.lit(1)).cast("int")


def index_to_label(idx: str | Column, labels: Sequence[str] | Column) -> Column:
    """Map a 0-based class index to its label through the fitted label list.

    Always goes through the list, so integer labels such as 10/20/30 come back as
    themselves and never as 0/1/2.
    """
    lab = labels if isinstance(labels, Column) else F.array(*[F.lit(v) for v in labels])
    return F.element_at(lab, _col(idx) + F.lit(1))
