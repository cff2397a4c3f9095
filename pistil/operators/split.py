"""Train / validation / test splitting."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import keyed_uniform

SPLIT_NAMES = ("train", "val", "test")
DEFAULT_RATIOS = (0.7, 0.15, 0.15)


def check_ratios(train: float, val: float, test: float) -> None:
    """Ratios must be finite, non-negative and sum to 1 within 1e-6 (zero is allowed)."""
    vals = (train, val, test)
    if any(not math.isfinite(v) for v in vals):
        raise ValueError(f"split ratios must be finite numbers, got {vals}")
    if any(v < 0 for v in vals):
        raise ValueError(f"split ratios must not be negative, got {vals}")
    total = train + val + test
    if not abs(total - 1.0) < 1e-6:
        raise ValueError(
            f"split ratios {vals} add up to {total}, not to 1")


def split_thresholds(ratios: Sequence[float] = DEFAULT_RATIOS) -> tuple[float, float]:
    """Cut points on the hash-uniform draw: train below the first, val below the second."""
    a, b, c = ratios
    check_ratios(a, b, c)
    return a, a + b


def split_label(u: Column, ratios: Sequence[float] = DEFAULT_RATIOS) -> Column:
    lo, hi = split_thresholds(ratios)
    return (F.when(u < F.lit(lo), F.lit(SPLIT_NAMES[0]))
             .when(u < F.lit(hi), F.lit(SPLIT_NAMES[1]))
             .otherwise(F.lit(SPLIT_NAMES[2])))


def tag_split(df: DataFrame, key_cols: Sequence[str] | str,
              ratios: Sequence[float] = DEFAULT_RATIOS, seed: int = 42,
              col: str = "split") -> DataFrame:
    """Add the split name of each row from a hash of its key and the seed.

    Stateless and narrow: no shuffle, no sort, the same answer for the same key on
    any partitioning, and it also runs on a streaming frame. Sizes are binomial
    around the ratios, as with any Bernoulli split.
    """
    return df.withColumn(col, split_label(keyed_uniform(key_cols, seed), ratios))


def hash_split(df: DataFrame, key_cols: Sequence[str] | str,
               ratios: Sequence[float] = DEFAULT_RATIOS, seed: int = 42
               ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three frames (train, val, test); each is a filter over the same projection."""
    tagged = tag_split(df, key_cols, ratios, seed, col="_split")
    return tuple(tagged.where(F.col("_split") == n).drop("_split") for n in SPLIT_NAMES)


def select_splits(tagged: DataFrame, names: Sequence[str], split_col: str = "split"
                  ) -> DataFrame:
    """Rows of several parts of a tagged frame, e.g. train + validation for a refit:
    one filter over one scan (a partition filter when the table is partitioned by
    the split), rather than a union of separately filtered scans."""
    return tagged.where(F.col(split_col).isin(list(names)))


def random_split(df: DataFrame, ratios: Sequence[float] = DEFAULT_RATIOS,
                 seed: int = 42) -> list[DataFrame]:
    """Spark's ``randomSplit``: same parts on re-run of the same plan, different ones
    after the input is repartitioned. Each part re-reads and re-sorts its input."""
    a, b, c = ratios
    check_ratios(a, b, c)
    return df.randomSplit([a, b, c], seed=seed)


def tag_random_split(df: DataFrame, ratios: Sequence[float] = DEFAULT_RATIOS,
                     seed: int = 42, col: str = "split") -> DataFrame:
    """Bernoulli split in one pass: each row's seeded draw is compared with the two
    thresholds. Like ``random_split`` it changes when the input is repartitioned."""
    draw = "_draw"
    while draw in df.columns:
        draw = "_" + draw
    return df.withColumn(draw, F.rand(seed)).withColumn(col, split_label(F.col(draw), ratios)).drop(draw)


def split_counts(tagged: DataFrame, split_col: str = "split",
                 by: Sequence[str] = ()) -> DataFrame:
    """Rows per split (and per ``by`` columns): one grouped count instead of a job per part."""
    return tagged.groupBy(split_col, *by).agg(F.count(F.lit(1)).alias("rows"))
