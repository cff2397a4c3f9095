"""Descriptive statistics: head, row count, describe, class counts/means, correlation.

Everything here is a hash aggregate with a partial (map-side) phase, so a class that
holds a third of the table costs no more than any other: each task ships one partial
row per class, not its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DESCRIBE_STATS = ("count", "mean", "stddev", "min", "max")


def head(df: DataFrame, n: int = 5, order_cols: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows; ordered (a distributed top-k) so the answer is repeatable."""
    return (df.orderBy(*order_cols) if order_cols else df).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    """One row: ``rows`` and ``columns``."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)))


def _stat(stat: str, c: Column) -> Column:
    x = c.cast("double")
    return {
        "count": F.count(c).cast("double"),
        "mean": F.avg(x),
        "stddev": F.stddev_samp(x),
        "min": F.min(x),
        "max": F.max(x),
    }[stat]


def safe_corr(x: str, y: str) -> Column:
    """Pearson correlation over rows where both values are present; NULL (not an error)
    when either column is constant there.

    ``corr`` raises DIVIDE_BY_ZERO on a constant column under ANSI mode, and a CASE
    around it does not help because the aggregate still runs. Built from
    population moments instead, each one restricted to the complete pairs.
    """
    cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
    both = cx.isNotNull() & cy.isNotNull()
    cov = F.covar_pop(cx, cy)
    den = F.stddev_pop(F.when(both, cx)) * F.stddev_pop(F.when(both, cy))
    return F.when(den == F.lit(0.0), F.lit(None).cast("double")).otherwise(cov / den)


def _long(rows: list[tuple[str, str, Column]], extra: Sequence[Column] = ()) -> Column:
    """explode(array(struct(column, statistic, value))) for an aggregated frame."""
    return F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("statistic"),
                 v.cast("double").alias("value"))
        for c, s, v in rows]))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Typed long form of ``describe``: (statistic, column, value double), one pass."""
    aggs, rows = [], []
    for i, c in enumerate(cols):
        for s in DESCRIBE_STATS:
            alias = f"_d{i}_{s}"
            aggs.append(_stat(s, F.col(c)).alias(alias))
            rows.append((c, s, F.col(alias)))
    return df.agg(*aggs).select(_long(rows).alias("r")).select(
        "r.statistic", "r.column", "r.value")


def describe_strings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spark's own ``describe`` (every value a string, one row per statistic)."""
    return df.describe(list(cols))


def class_counts(df: DataFrame, class_col: str, count_col: str = "count") -> DataFrame:
    return df.groupBy(class_col).agg(F.count(F.lit(1)).alias(count_col))


def class_means(df: DataFrame, class_col: str, cols: Sequence[str],
                suffix: str = "_mean") -> DataFrame:
    return df.groupBy(class_col).agg(*[F.avg(c).alias(f"{c}{suffix}") for c in cols])


def class_summary(df: DataFrame, class_col: str, cols: Sequence[str]) -> DataFrame:
    """Counts and means per class in one grouped aggregate."""
    return df.groupBy(class_col).agg(
        F.count(F.lit(1)).alias("count"), *[F.avg(c).alias(f"{c}_mean") for c in cols])


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(x, y, corr) for each pair, all pairs in one aggregate pass."""
    aggs = [safe_corr(x, y).alias(f"_c{i}") for i, (x, y) in enumerate(pairs)]
    arr = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"),
                             F.col(f"_c{i}").alias("corr"))
                    for i, (x, y) in enumerate(pairs)])
    return df.agg(*aggs).select(F.explode(arr).alias("r")).select("r.x", "r.y", "r.corr")


def profile_report(df: DataFrame, numeric_cols: Sequence[str], class_col: str,
                   pairs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """All exploration statistics from a single scan.

    ``rollup(class_col)`` produces the whole-table group and every class group in one
    aggregation (an Expand before the partial aggregate) instead of one job per
    statistic. Long form: ``scope`` ('all' or 'class'), ``class`` (string, NULL for
    scope 'all'), ``column``, ``statistic``, ``value``. Statistics: rows; count, mean,
    stddev, min, max per column; corr per pair (column named ``x,y``).
    """
    aggs, rows = [F.count(F.lit(1)).alias("_rows")], [("*", "rows", F.col("_rows"))]
    for i, c in enumerate(numeric_cols):
        for s in DESCRIBE_STATS:
            alias = f"_d{i}_{s}"
            aggs.append(_stat(s, F.col(c)).alias(alias))
            rows.append((c, s, F.col(alias)))
    for i, (x, y) in enumerate(pairs):
        aggs.append(safe_corr(x, y).alias(f"_c{i}"))
        rows.append((f"{x},{y}", "corr", F.col(f"_c{i}")))
    agg = df.rollup(class_col).agg(F.grouping(class_col).alias("_g"), *aggs)
    return agg.select(
        F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.lit("class")).alias("scope"),
        F.when(F.col("_g") == 1, F.lit(None).cast("string"))
         .otherwise(F.col(class_col).cast("string")).alias("class"),
        _long(rows).alias("r"),
    ).select("scope", "class", "r.column", "r.statistic", "r.value")
