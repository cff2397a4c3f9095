"""Exploration statistics of a table that grows load by load.

Each load's moments are stored once: per class and column the count, mean, sum of squared deviations, minimum and maximum, per
class and column pair the same of the complete pairs with the sum of products of deviations. Moments of several loads add
up exactly (deviations are shifted to the common mean before they are added), so the report over all loads reads the
small moment table only, and an append reads only its own rows.

Moments are kept in one folder per load, replaced as a whole: a load that is profiled again counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = ("class string, no_class boolean, x string, y string, n_rows long, n long, mean_x double, mean_y double, "
          "m2_x double, m2_y double, c_xy double, min_x double, max_x double")


def moments(df: DataFrame, numeric_cols: Sequence[str], class_col: str, pairs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """The moments of ``df``: one scan, one aggregate by class (a row per class leaves a task), in long form."""
    aggs, rows = [F.count("*").alias("_n")], []
    none = F.lit(None).cast("double")

    def entry(x: Column, y: Column, *values: Column) -> Column:
        names = ("n", "mean_x", "mean_y", "m2_x", "m2_y", "c_xy", "min_x", "max_x")
        return F.struct(x.alias("x"), y.alias("y"), *[v.alias(n) for n, v in zip(names, values)])

    for i, c in enumerate(numeric_cols):
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"a{i}"), (F.var_pop(v) * F.count(v)).alias(f"v{i}"), F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}")]
        rows.append(entry(F.lit(c), F.lit(None).cast("string"), F.col(f"n{i}"), F.col(f"a{i}"), none, F.col(f"v{i}"), none, none, F.col(f"l{i}"), F.col(f"h{i}")))
    for i, (x, y) in enumerate(pairs):
        cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
        both = cx.isNotNull() & cy.isNotNull()
        px, py = F.when(both, cx), F.when(both, cy)
        n = F.count(px)
        aggs += [n.alias(f"pn{i}"), F.avg(px).alias(f"px{i}"), F.avg(py).alias(f"py{i}"), (F.var_pop(px) * n).alias(f"pv{i}"),
                 (F.var_pop(py) * n).alias(f"pw{i}"), (F.covar_pop(px, py) * n).alias(f"pc{i}")]
        rows.append(entry(F.lit(x), F.lit(y), *[F.col(f"{k}{i}") for k in ("pn", "px", "py", "pv", "pw", "pc")], none, none))
    # a row of its own for the row count, so that a table without numeric columns has one too
    rows.append(entry(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(0).cast("long"), *[none] * 7))
    by = df.groupBy(F.col(class_col).alias("_class")).agg(*aggs)
    return (by.select(F.col("_class").cast("string").alias("class"), F.col("_class").isNull().alias("no_class"), F.col("_n").alias("n_rows"),
                      F.explode(F.array(*rows)).alias("e"))
              .select("class", "no_class", "e.x", "e.y", "n_rows", *[f"e.{c}" for c in ("n", "mean_x", "mean_y", "m2_x", "m2_y", "c_xy", "min_x", "max_x")]))


def merged(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Moments of unions of rows: ``parts`` added up by ``by`` (null-safe) and (x, y)."""
    keys = [*by, "x", "y"]
    mean = lambda c: F.try_divide(F.sum(F.col("n") * F.col(c)), F.sum(F.when(F.col(c).isNotNull(), F.col("n"))))
    whole = (parts.groupBy(*keys).agg(mean("mean_x").alias("all_x"), mean("mean_y").alias("all_y"))
                  .withColumnsRenamed({k: f"_{k}" for k in keys}))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    n, dx, dy = F.col("n"), F.col("mean_x") - F.col("all_x"), F.col("mean_y") - F.col("all_y")
    return parts.join(whole, same).groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.first("all_x").alias("mean_x"), F.first("all_y").alias("mean_y"),
        F.sum(F.col("m2_x") + n * dx * dx).alias("m2_x"), F.sum(F.col("m2_y") + n * dy * dy).alias("m2_y"),
        F.sum(F.col("c_xy") + n * dx * dy).alias("c_xy"), F.min("min_x").alias("min_x"), F.max("max_x").alias("max_x"))


def moments_report(parts: DataFrame) -> DataFrame:
    """``scope, class, column, statistic, value``: what ``profile.profile_report`` gives for all rows behind ``parts``."""
    per = merged(parts, ["class", "no_class"]).withColumn("scope", F.lit("class"))
    whole = (merged(parts.withColumn("class", F.lit(None).cast("string")).withColumn("no_class", F.lit(True)), ["class", "no_class"])
             .withColumn("scope", F.lit("all")))
    n = F.col("n")
    stat = lambda c, s, v: F.struct(c.alias("column"), F.lit(s).alias("statistic"), v.cast("double").alias("value"))
    one = F.array(stat(F.col("x"), "count", n), stat(F.col("x"), "mean", F.col("mean_x")),
                  stat(F.col("x"), "stddev", F.when(n > 1, F.sqrt(F.col("m2_x") / (n - 1)))),
                  stat(F.col("x"), "min", F.col("min_x")), stat(F.col("x"), "max", F.col("max_x")))
    den = F.sqrt(F.col("m2_x")) * F.sqrt(F.col("m2_y"))
    pair = F.array(stat(F.concat_ws(",", "x", "y"), "corr", F.when(den != 0, F.col("c_xy") / den)))
    rows = F.array(stat(F.lit("*"), "rows", F.col("n_rows")))
    out = per.unionByName(whole).select("scope", "class", F.explode(
        F.when(F.col("x").isNull(), rows).when(F.col("y").isNull(), one).otherwise(pair)).alias("r"))
    return out.select("scope", "class", "r.column", "r.statistic", "r.value")


class MomentStore:
    """Moments by load under ``path`` (one folder a load)."""

    def __init__(self, spark: SparkSession, path: str, numeric_cols: Sequence[str], class_col: str, pairs: Sequence[tuple[str, str]] = ()):
        self.spark, self.path = spark, path.rstrip("/")
        self.spec = (list(numeric_cols), class_col, list(pairs))

    def add(self, load: int, rows: DataFrame) -> None:
        """Store (or replace) the moments of one load's rows."""
        moments(rows, *self.spec).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/load={int(load)}")

    def read(self) -> DataFrame:
        return self.spark.read.schema(f"{SCHEMA}, load int").parquet(self.path)

    def loads(self) -> list[int]:
        """Loads that are stored (folder names; no rows are read)."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("load="))

    def add_new(self, table: DataFrame, load_col: str) -> list[int]:
        """Profile the loads of a table, partitioned by ``load_col``, that are not stored yet: only their partitions are
        read. Returns them."""
        known = self.loads()
        there = [r[0] for r in table.select(load_col).distinct().collect()]          # one value a load, from the folder names
        new = sorted(x for x in there if x not in known)
        for load in new:
            self.add(load, table.where(F.col(load_col) == load))
        return new

    def report(self) -> DataFrame:
        return moments_report(self.read().drop("load"))
