"""Table-to-table steps with the shape of the original flow's functions.

Each step reads catalog tables, runs the frame operators and writes catalog tables,
returning the row/column counts it logged. They exist so a user of the original
functions can move over step by step; the pipelines in ``data_flow`` /
``model_flow`` run the same operators with fewer passes.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.naming import snake_case
from ..operators import prep, split
from ..operators.models import assemble, fit_label_indexer, free_name, place_rows, training_frame
from ..operators.positions import POSITION, pair_by_position
from ..operators.tpe import TpeSettings
from ..operators.tune import TuneResult, tune
from ..sources.tables import LoadResult, load_csv_table, table_name, write_table

log = logging.getLogger("pistil")


def _name(catalog: str | None, schema: str | None, table: str) -> str:
    return table_name(catalog, schema, table) if (catalog or schema) else table


def _shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def load_data(spark: SparkSession, path: str, table: str, *, catalog: str | None = None,
              schema: str | None = None, header: bool = True, infer_schema: bool = True,
              sep: str = ",", mode: str = "overwrite", fmt: str = "parquet",
              add_key: str | None = None) -> LoadResult:
    """CSV file -> table. Rows and columns are counted on the written table."""
    res = load_csv_table(spark, path, _name(catalog, schema, table), header=header,
                         infer_schema=infer_schema, sep=sep, mode=mode, fmt=fmt,
                         add_key=add_key)
    log.info("loaded %s: %d rows, %d columns", res.table, res.rows, res.columns)
    return res


def process_data(spark: SparkSession, source_table: str, target_table: str, *,
                 id_column: str | None = "id", key_cols: Sequence[str] | None = None,
                 seed: int = 42, catalog: str | None = None, schema: str | None = None,
                 fmt: str = "parquet") -> tuple[int, int]:
    """Drop id, snake_case names, seeded shuffle (hash of the key when given, else
    ``rand(seed)`` as in the original), overwrite the target table."""
    prep.check_id_is_no_key(id_column, key_cols)
    df = spark.table(_name(catalog, schema, source_table))
    method = "hash" if key_cols else "random"
    out = prep.process_table(df, id_column, key_cols, seed, shuffle=method)
    target = _name(catalog, schema, target_table)
    write_table(out, target, fmt=fmt)
    shape = _shape(spark.table(target))
    log.info("processed %s: %d rows, %d columns", target, *shape)
    return shape


def train_val_test_split(spark: SparkSession, source_table: str, train_table: str,
                         val_table: str, test_table: str, *,
                         ratios: Sequence[float] = split.DEFAULT_RATIOS, seed: int = 42,
                         key_cols: Sequence[str] | None = None,
                         catalog: str | None = None, schema: str | None = None,
                         fmt: str = "parquet") -> dict[str, tuple[int, int]]:
    """Three tables. With ``key_cols`` the hash split (stable under any partitioning);
    without, Spark's ``randomSplit`` as in the original. Ratios are checked first."""
    split.check_ratios(*ratios)
    df = spark.table(_name(catalog, schema, source_table))
    if key_cols:
        parts = split.hash_split(df, [snake_case(k) for k in key_cols], ratios, seed)
    else:
        parts = split.random_split(df, ratios, seed)
    out = {}
    for part, t in zip(parts, (train_table, val_table, test_table)):
        name = _name(catalog, schema, t)
        write_table(part, name, fmt=fmt)
        out[t] = _shape(spark.table(name))
        log.info("split %s: %d rows, %d columns", name, *out[t])
    return out


def features_and_target(spark: SparkSession, table: str, feature_cols: Sequence[str],
                        target_col: str, *, key_cols: Sequence[str] | None = None,
                        catalog: str | None = None, schema: str | None = None,
                        buckets: int | None = None, fmt: str = "parquet") -> tuple[str, str]:
    """Write ``<table>_x`` and ``<table>_y`` (each with the key, if one is given)."""
    df = spark.table(_name(catalog, schema, table))
    key_cols = [snake_case(k) for k in key_cols or []]
    x, y = prep.features_and_target(df, feature_cols, target_col, key_cols)
    xn, yn = _name(catalog, schema, f"{table}_x"), _name(catalog, schema, f"{table}_y")
    prep.write_features_target(x, y, xn, yn, key_cols, buckets=buckets, fmt=fmt)
    return xn, yn


def read_xy(spark: SparkSession, base: str, key_cols: Sequence[str] | None, target_col: str,
            catalog: str | None = None, schema: str | None = None) -> DataFrame:
    """Re-pair ``<base>_x`` with ``<base>_y`` on the key; without one, row by row in stored order, with
    the position as the column ``position``."""
    key_cols = [snake_case(k) for k in key_cols or []]
    x = spark.table(_name(catalog, schema, f"{base}_x"))
    y = spark.table(_name(catalog, schema, f"{base}_y"))
    if not key_cols:
        paired = pair_by_position(x, y)
        return paired.select(POSITION, *x.columns, target_col)
    return prep.join_features_target(x, y.select(*key_cols, target_col), key_cols)


def frame_from_xy(spark: SparkSession, bases: dict[str, str], key_cols: Sequence[str] | None,
                  target_col: str, catalog: str | None = None, schema: str | None = None,
                  split_col: str = "split") -> DataFrame:
    """One keyed frame with a split column from per-split ``_x``/``_y`` tables
    (``bases`` maps split name -> table base name), ready for the model flow."""
    from pyspark.sql import functions as F
    out = None
    for split_name, base in bases.items():
        part = read_xy(spark, base, key_cols, target_col, catalog, schema).withColumn(
            split_col, F.lit(split_name))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("bases is empty")
    return out


def hp_tune(spark: SparkSession, train_base: str, val_base: str, family: str, *,
            feature_cols: Sequence[str], target_col: str, key_cols: Sequence[str] | None = None,
            space=None, max_evals: int = 3, metric="accuracy", maximize: bool = True,
            seed: int = 42, parallelism: int = 2, catalog: str | None = None,
            schema: str | None = None, experiment: str | None = None,
            model_dir: str | None = None, trial_table: str | None = None, search: str = "tpe",
            settings: TpeSettings = TpeSettings(), resume: bool = False) -> TuneResult:
    """Tune one family on ``<train_base>_x/_y`` and ``<val_base>_x/_y`` (paired by position without ``key_cols``)."""
    tr = read_xy(spark, train_base, key_cols, target_col, catalog, schema)
    va = read_xy(spark, val_base, key_cols, target_col, catalog, schema)
    feat, lab = free_name(tr.columns, "features"), free_name(tr.columns, "label")
    indexer = fit_label_indexer(tr.unionByName(va), target_col, out=lab)

    def prepare(df):
        rows = place_rows(df, [snake_case(k) for k in key_cols or [POSITION]])
        return indexer.transform(assemble(rows, feature_cols, out=feat)).select(feat, lab)
    train, val = training_frame(prepare(tr)), training_frame(prepare(va))
    try:
        return tune(train, val, family, space, max_evals=max_evals, metric=metric,
                    maximize=maximize, seed=seed, parallelism=parallelism,
                    experiment=experiment, model_dir=model_dir, trial_table=trial_table,
                    features_col=feat, label_col=lab, search=search, settings=settings, resume=resume)
    finally:
        train.unpersist()
        val.unpersist()
