"""Hyperparameter search spaces compiled to Spark columns.

A space is a dict ``name -> distribution``. Each trial's value of each parameter is
a hash-uniform draw keyed by ``trial_id|name|seed``, so a trials frame of any size
is one projection over a frame of trial ids, reproducible without a random state
and checkable in SQL. This is the start-up phase of the Parzen search in ``tpe``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Any, Union

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash_uniform, key_string, sql_hash_uniform, sql_key


@dataclass(frozen=True)
class Choice:
    values: tuple

    def __init__(self, values):
        object.__setattr__(self, "values", tuple(values))


@dataclass(frozen=True)
class IntRange:
    """Uniform choice from ``range(start, stop, step)`` (stop excluded)."""
    start: int
    stop: int
    step: int = 1

    @property
    def size(self) -> int:
        return len(range(self.start, self.stop, self.step))


@dataclass(frozen=True)
class Uniform:
    lo: float
    hi: float


@dataclass(frozen=True)
class LogUniform:
    """``exp(uniform(lo, hi))``: bounds are on the log scale."""
    lo: float
    hi: float


Distribution = Union[Choice, IntRange, Uniform, LogUniform]

# The two search spaces of the original flow.
RF_SPACE: dict[str, Distribution] = {
    "n_estimators": IntRange(50, 301, 10),
    "max_depth": IntRange(5, 31),
    "min_samples_split": Uniform(0.01, 0.3),
    "min_samples_leaf": Uniform(0.01, 0.3),
    "bootstrap": Choice([True, False]),
}
LR_SPACE: dict[str, Distribution] = {
    "penalty": Choice(["l2", "none"]),
    "C": LogUniform(-4, 4),
    "solver": Choice(["saga", "liblinear", "lbfgs", "newton-cg", "sag"]),
    "l1_ratio": Uniform(0, 1),
}


def draw(dist: Distribution, u: Column) -> Column:
    """Map a uniform draw ``u`` in [0, 1) to a value of ``dist``."""
    if isinstance(dist, Choice):
        n = len(dist.values)
        arr = F.array(*[F.lit(v) for v in dist.values])
        return F.element_at(arr, (F.floor(u * F.lit(float(n))) + F.lit(1)).cast("int"))
    if isinstance(dist, IntRange):
        n = dist.size
        return (F.lit(dist.start) + F.lit(dist.step) * F.floor(u * F.lit(float(n)))).cast("int")
    if isinstance(dist, Uniform):
        return F.lit(float(dist.lo)) + F.lit(float(dist.hi - dist.lo)) * u
    if isinstance(dist, LogUniform):
        return F.exp(F.lit(float(dist.lo)) + F.lit(float(dist.hi - dist.lo)) * u)
    raise TypeError(f"unknown distribution {dist!r}")


def sample_space(trials: DataFrame, space: dict[str, Distribution], seed: int = 42,
                 trial_col: str = "trial_id", prefix: str = "") -> DataFrame:
    """Add one column per parameter, drawn for each row's trial id."""
    key = key_string(trial_col)
    return trials.select("*", *[
        draw(dist, hash_uniform(key, seed, salt=name)).alias(prefix + name)
        for name, dist in space.items()])


def trial_frame(spark: SparkSession, space: dict[str, Distribution], max_evals: int,
                seed: int = 42, first_id: int = 1) -> DataFrame:
    """Frame of ``max_evals`` trials (ids from ``first_id``) with their drawn params."""
    if max_evals < 1:
        raise ValueError("max_evals must be at least 1")
    ids = spark.range(first_id, first_id + max_evals, numPartitions=1).withColumnRenamed(
        "id", "trial_id")
    return sample_space(ids, space, seed)


def row_params(row, space: dict[str, Distribution]) -> dict[str, Any]:
    """Plain Python values of one trial row."""
    out = {}
    for name in space:
        v = row[name]
        out[name] = float(v) if isinstance(v, float) and not math.isnan(v) else v
    return out


def space_fields(space: dict[str, Distribution]) -> list[T.StructField]:
    """Columns of a frame that holds one value of each parameter."""
    kinds = {bool: T.BooleanType(), int: T.IntegerType(), float: T.DoubleType(), str: T.StringType()}

    def kind(d: Distribution) -> T.DataType:
        if isinstance(d, IntRange):
            return T.IntegerType()
        return kinds[type(d.values[0])] if isinstance(d, Choice) else T.DoubleType()

    return [T.StructField(name, kind(d)) for name, d in space.items()]


# DuckDB twin of ``draw`` for the oracle SQL.

def _sql_lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def sql_draw(dist: Distribution, u_sql: str) -> str:
    if isinstance(dist, Choice):
        n = len(dist.values)
        items = ", ".join(_sql_lit(v) for v in dist.values)
        return f"([{items}])[CAST(floor({u_sql} * {float(n)!r}) AS BIGINT) + 1]"
    if isinstance(dist, IntRange):
        return (f"CAST({dist.start} + {dist.step} * floor({u_sql} * {float(dist.size)!r})"
                f" AS INTEGER)")
    if isinstance(dist, Uniform):
        return f"({float(dist.lo)!r}::DOUBLE + {float(dist.hi - dist.lo)!r}::DOUBLE * {u_sql})"
    if isinstance(dist, LogUniform):
        return f"exp({float(dist.lo)!r}::DOUBLE + {float(dist.hi - dist.lo)!r}::DOUBLE * {u_sql})"
    raise TypeError(f"unknown distribution {dist!r}")


def sql_sample_space(trial_col: str, space: dict[str, Distribution], seed: int = 42,
                     prefix: str = "") -> list[str]:
    key = sql_key(trial_col)
    return [f"{sql_draw(d, sql_hash_uniform(key, seed, salt=n))} AS {prefix}{n}"
            for n, d in space.items()]
