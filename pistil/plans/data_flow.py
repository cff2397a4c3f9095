"""Data pipeline: load -> process -> split -> features/target tables.

Compared with writing eleven tables one after another, the plan here is:

1. ``raw``: the source as a table (CSV, parquet or an existing table), with a persisted
   row key added at ingest, unique across appended loads.
2. ``processed``: id dropped, names snake_cased, every row tagged with its split by
   a hash of its key, optionally ordered by a seeded hash, written **once**,
   partitioned by ``split``. Train, validation and test are partitions of it, so
   reading one of them prunes the others away.
3. ``train`` / ``val`` / ``test``: views of ``processed``, one per part (no copy).
4. ``<split>_x`` / ``<split>_y``: row key (and the user's keys) + features and + target
   per split, bucketed and sorted by the pairing key so re-pairing them is shuffle-free.

The hash split is narrow (no shuffle). The optional hash shuffle is the only
exchange: a range-partitioned sort, kept because the original flow stores its rows
in random order; ``shuffle=None`` drops it when order does not matter.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import keyed_uniform
from ..functions.naming import snake_case
from ..operators import prep
from ..operators.split import DEFAULT_RATIOS, SPLIT_NAMES, check_ratios, split_label
from ..sources.csv import read_csv
from ..session import default_parallelism, partitions_for, shuffles_freed, stored_bytes
from ..sources.tables import next_row_key, table_name, with_row_key, write_table
from . import defaults

ROW_KEY = "row_key"
XY_BUCKET_BYTES = 128 << 20   # a bucket is sorted in one task when x and y are paired
MAX_PARTS = 2
log = logging.getLogger("pistil.data_flow")


@dataclass
class DataFlowConfig:
    source: str                               # CSV/parquet path or table name
    source_format: str = "csv"                # "csv" | "parquet" | "table"
    catalog: str | None = None
    schema: str | None = None
    raw_table: str = defaults.TABLES["raw"]
    processed_table: str = defaults.TABLES["processed"]
    train_table: str = defaults.TABLES["train"]
    val_table: str = defaults.TABLES["val"]
    test_table: str = defaults.TABLES["test"]
    id_column: str | None = "id"
    key_cols: Sequence[str] | None = None     # keys that the split hashes; None: the row key
    row_key: str | None = ROW_KEY             # persisted key of each row; None: key_cols alone
    feature_cols: Sequence[str] = defaults.FEATURES
    target_col: str = defaults.TARGET
    ratios: Sequence[float] = DEFAULT_RATIOS
    seed: int = 42
    shuffle: str | None = "hash"              # "hash" | "random" | None
    partitions: int | None = None             # processed-table partitions (hash shuffle)
    skew_safe: bool = False                   # hash shuffle of keys that repeat very often
    parse_mode: str = "PERMISSIVE"            # of CSV records that do not fit the schema
    header: bool = True
    infer_schema: bool = True
    csv_schema: object = None
    sep: str = ","
    load_mode: str = "overwrite"
    fmt: str = "parquet"
    write_xy: bool = True
    xy_buckets: int | None = None             # None: from the stored size; 0: no buckets
    split_views: bool = True                  # train/val/test as views of the processed table
    table_root: str | None = None             # external table folder (shared storage)
    write_parallelism: int = 3                # per-split x/y writes submitted together

    def name(self, table: str) -> str:
        return table_name(self.catalog, self.schema, table)

    def path(self, table: str) -> str | None:
        return f"{self.table_root.rstrip('/')}/{table}" if self.table_root else None


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_source(spark: SparkSession, cfg: DataFlowConfig) -> DataFrame:
    if cfg.source_format == "csv":
        return read_csv(spark, cfg.source, header=cfg.header, infer_schema=cfg.infer_schema,
                        sep=cfg.sep, schema=cfg.csv_schema, parse_mode=cfg.parse_mode)
    if cfg.source_format == "parquet":
        return spark.read.parquet(cfg.source)
    if cfg.source_format == "table":
        return spark.table(cfg.source)
    raise ValueError(f"unknown source_format {cfg.source_format!r}")


def split_and_order(df: DataFrame, key_cols: Sequence[str], ratios: Sequence[float],
                    seed: int, shuffle: str | None, partitions: int | None = None,
                    skew_safe: bool = False, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """Tag the split; with the hash shuffle, place rows by hash range and sort each
    partition by (split, hash, key): every split directory is then written in seeded
    order, and the writer's required ordering by ``split`` already holds (no second
    sort). ``part`` is that of ``hash_ordered``."""
    out = df.withColumn("split", split_label(keyed_uniform(list(key_cols), seed), ratios))
    if shuffle == "hash":
        return prep.hash_ordered(out, key_cols, seed, partitions, first=["split"],
                                 skew_safe=skew_safe, part=part)
    if shuffle == "random":
        return out.orderBy("split", F.rand(seed))
    if shuffle is None:
        return out
    raise ValueError("shuffle must be 'hash', 'random' or None")


def run_data_flow(spark: SparkSession, cfg: DataFlowConfig) -> DataFrame:
    """Run the pipeline; return a report frame ``table, split, rows, columns``."""
    with shuffles_freed(spark):
        return _run_data_flow(spark, cfg)


def _run_data_flow(spark: SparkSession, cfg: DataFlowConfig) -> DataFrame:
    check_ratios(*cfg.ratios)
    prep.check_id_is_no_key(cfg.id_column, cfg.key_cols)
    if not cfg.key_cols and not cfg.row_key:
        raise ValueError("either key_cols or row_key must name a key")
    raw_df = read_source(spark, cfg)
    raw = cfg.name(cfg.raw_table)
    key_cols = list(cfg.key_cols or [cfg.row_key])
    if cfg.row_key:
        raw_df = with_row_key(raw_df, cfg.row_key, next_row_key(spark, raw, cfg.row_key, cfg.load_mode))
    t0 = time.perf_counter()
    write_table(raw_df, raw, mode=cfg.load_mode, fmt=cfg.fmt, path=cfg.path(cfg.raw_table))
    log.info("raw table %s written in %.1fs", raw, time.perf_counter() - t0)

    processed_df = prep.process_table(spark.table(raw), cfg.id_column, None, shuffle=None)
    keys = [snake_case(k) for k in key_cols]
    processed = cfg.name(cfg.processed_table)
    # rows on their way take three times their stored bytes: a table of many partitions is exchanged and written in parts
    n, parts = int(cfg.partitions or partitions_for(processed_df)), 1
    if cfg.shuffle == "hash" and prep.can_order_in_parts(processed_df, cfg.skew_safe):
        parts = max(1, min(MAX_PARTS, n // (2 * default_parallelism(spark))))
    for k in range(parts):
        write_table(split_and_order(processed_df, keys, cfg.ratios, cfg.seed, cfg.shuffle, n, cfg.skew_safe, (k, parts)),
                    processed, mode="append" if k else "overwrite", fmt=cfg.fmt, partition_by=["split"],
                    path=cfg.path(cfg.processed_table))
    log.info("processed table %s written in %.1fs", processed, time.perf_counter() - t0)

    stored = spark.table(processed)
    pair = [snake_case(cfg.row_key)] if cfg.row_key else keys
    carried = list(dict.fromkeys([*pair, *keys]))
    if cfg.split_views:
        for s, base in zip(SPLIT_NAMES, (cfg.train_table, cfg.val_table, cfg.test_table)):
            spark.sql(f"CREATE OR REPLACE VIEW {cfg.name(base)} AS "
                      f"SELECT {', '.join(_quoted(c) for c in stored.columns if c != 'split')} "
                      f"FROM {processed} WHERE split = '{s}'")
    xy_names = []
    if cfg.write_xy:
        split_tables = dict(zip(SPLIT_NAMES, (cfg.train_table, cfg.val_table, cfg.test_table)))

        def write_split(item):
            s, base = item
            part = stored.where(F.col("split") == s)
            buckets = cfg.xy_buckets
            if buckets is None:              # of one part: the size of a whole partitioned table is not known to Spark
                buckets = max(1, -(-stored_bytes(part) // XY_BUCKET_BYTES))
            x, y = prep.features_and_target(part, cfg.feature_cols, cfg.target_col, carried)
            xn, yn = cfg.name(f"{base}_x"), cfg.name(f"{base}_y")
            prep.write_features_target(x, y, xn, yn, pair, buckets=buckets,
                                       fmt=cfg.fmt, x_path=cfg.path(f"{base}_x"),
                                       y_path=cfg.path(f"{base}_y"))
            return [(xn, s, "x"), (yn, s, "y")]

        # The per-split writes are independent jobs over disjoint partitions of the
        # stored table: submitted together they share the executors instead of
        # queueing (the val/test parts alone would not fill a large cluster).
        with ThreadPoolExecutor(max_workers=cfg.write_parallelism) as pool:
            for names in pool.map(write_split, split_tables.items()):
                xy_names += names
        log.info("x/y tables written in %.1fs", time.perf_counter() - t0)
    return flow_report(spark, raw, processed, xy_names)


def flow_report(spark: SparkSession, raw: str, processed: str,
                xy_names: list[tuple[str, str, str]]) -> DataFrame:
    """Rows and columns of every written table, counted from storage (no recompute)."""
    r = spark.table(raw)
    parts = [r.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("raw").alias("table"), F.lit(None).cast("string").alias("split"), "rows",
        F.lit(len(r.columns)).alias("columns"))]
    p = spark.table(processed)
    parts.append(p.groupBy("split").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("processed").alias("table"), "split", "rows",
        F.lit(len(p.columns)).alias("columns")))
    for name, s, role in xy_names:
        t = spark.table(name)
        parts.append(t.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(f"{s}_{role}").alias("table"), F.lit(s).alias("split"), "rows",
            F.lit(len(t.columns)).alias("columns")))
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out
