"""Command line for the two flows.

    python -m pistil data  --source Iris.csv --schema schema_iris ...
    python -m pistil model --schema schema_iris ...
    spark-submit --py-files pistil.zip pistil/plans/cli.py data ...

The session comes from ``SparkSession.builder.getOrCreate()`` (spark-submit or the
cluster provides master and settings). Both commands print their report frame.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

# Absolute imports: this file is also run as a script by spark-submit.
from pistil.operators.positions import POSITION
from pistil.operators.split import DEFAULT_RATIOS
from pistil.operators.tpe import TpeSettings
from pistil.plans.data_flow import DataFlowConfig, run_data_flow
from pistil.plans.defaults import FEATURES, REFIT_MAX_ITER, TABLES, TARGET
from pistil.plans.model_flow import ModelFlowConfig, run_model_flow
from pistil.plans.table_steps import frame_from_xy


def _common(p: argparse.ArgumentParser) -> None:
    p.add_argument("--catalog", default=None)
    p.add_argument("--schema", default=None)
    p.add_argument("--random_seed", type=int, default=42)
    p.add_argument("--logging_level", default="INFO")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pistil", description=__doc__.split("\n\n")[0])
    sub = top.add_subparsers(dest="command", required=True)

    d = sub.add_parser("data", help="load -> process + split -> x/y tables")
    _common(d)
    d.add_argument("--source", required=True, help="CSV path (or table / parquet path)")
    d.add_argument("--source_format", default="csv", choices=["csv", "parquet", "table"])
    d.add_argument("--raw_table_name", default=TABLES["raw"])
    d.add_argument("--processed_table_name", default=TABLES["processed"])
    d.add_argument("--id_column_name", default="id")
    d.add_argument("--key_columns", nargs="*", default=None)
    d.add_argument("--train_table_name", default=TABLES["train"])
    d.add_argument("--val_table_name", default=TABLES["val"])
    d.add_argument("--test_table_name", default=TABLES["test"])
    d.add_argument("--train_ratio", type=float, default=DEFAULT_RATIOS[0])
    d.add_argument("--val_ratio", type=float, default=DEFAULT_RATIOS[1])
    d.add_argument("--test_ratio", type=float, default=DEFAULT_RATIOS[2])
    d.add_argument("--csv_separator", default=",")
    d.add_argument("--feature_columns", nargs="+", default=list(FEATURES))
    d.add_argument("--target_column", default=TARGET)
    d.add_argument("--table_root", default=None,
                   help="shared folder for the tables (default: the warehouse)")
    d.add_argument("--schema_ddl", default=None,
                   help="column names and types of the CSV; skips the inference pass")
    d.add_argument("--parse_mode", default="PERMISSIVE",
                   choices=["PERMISSIVE", "DROPMALFORMED", "FAILFAST"])
    d.add_argument("--load_mode", default="overwrite", choices=["overwrite", "append"])
    d.add_argument("--skew_safe", action="store_true")
    d.add_argument("--shuffle", default="hash", choices=["hash", "random", "none"])

    m = sub.add_parser("model", help="tune -> refit -> soft vote -> test accuracy")
    _common(m)
    m.add_argument("--processed_table_name", default=None,
                   help="one table with a split column (default: " + TABLES["processed"] + ")")
    for part in ("train", "val", "test"):
        m.add_argument(f"--{part}_table_name", default=None,
                       help=f"base name of the {part} _x/_y tables (all three, instead of one table)")
    m.add_argument("--key_columns", nargs="*", default=["row_key"],
                   help="keys of the rows; give none to pair keyless _x/_y tables by position")
    m.add_argument("--feature_columns", nargs="+", default=list(FEATURES))
    m.add_argument("--target_column", default=TARGET)
    m.add_argument("--max_evals", type=int, default=3)
    m.add_argument("--parallelism", type=int, default=3)
    m.add_argument("--base_experiment_path", default="experiments")
    m.add_argument("--model_dir", default=None)
    m.add_argument("--trial_table", default=None)
    m.add_argument("--search", default="tpe", choices=["tpe", "random"])
    m.add_argument("--startup_trials", type=int, default=TpeSettings.startup,
                   help="random trials before the Parzen search proposes")
    m.add_argument("--stamp", default=None, help="stamp of the experiments' names (default: now)")
    m.add_argument("--resume", action="store_true",
                   help="run only the trials of --stamp that --trial_table does not hold")
    m.add_argument("--families", nargs="+",
                   default=["random_forest", "logistic_regression"])
    m.add_argument("--max_iter", type=int, default=100)
    m.add_argument("--refit_max_iter", type=int, default=REFIT_MAX_ITER)
    m.add_argument("--checkpoint_inputs", action="store_true")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None):
    args = parser().parse_args(argv)
    logging.basicConfig(level=getattr(logging, args.logging_level.upper(), logging.INFO))
    spark = spark or SparkSession.builder.getOrCreate()
    if args.command == "data":
        cfg = DataFlowConfig(
            source=args.source, source_format=args.source_format, catalog=args.catalog,
            schema=args.schema, raw_table=args.raw_table_name,
            processed_table=args.processed_table_name, train_table=args.train_table_name,
            val_table=args.val_table_name, test_table=args.test_table_name,
            id_column=args.id_column_name or None, key_cols=args.key_columns,
            feature_cols=args.feature_columns, target_col=args.target_column,
            ratios=(args.train_ratio, args.val_ratio, args.test_ratio),
            seed=args.random_seed, sep=args.csv_separator, table_root=args.table_root,
            csv_schema=args.schema_ddl, infer_schema=args.schema_ddl is None,
            parse_mode=args.parse_mode, load_mode=args.load_mode, skew_safe=args.skew_safe,
            shuffle=None if args.shuffle == "none" else args.shuffle)
        out = run_data_flow(spark, cfg)
    else:
        cfg = ModelFlowConfig(
            key_cols=args.key_columns or [POSITION], feature_cols=args.feature_columns,
            target_col=args.target_column, max_evals=args.max_evals, seed=args.random_seed,
            parallelism=args.parallelism, experiment_base=args.base_experiment_path,
            model_dir=args.model_dir, trial_table=args.trial_table, families=args.families,
            max_iter=args.max_iter, refit_max_iter=args.refit_max_iter,
            checkpoint_inputs=args.checkpoint_inputs, search=args.search,
            settings=TpeSettings(startup=args.startup_trials), stamp=args.stamp, resume=args.resume)
        bases = {"train": args.train_table_name, "val": args.val_table_name, "test": args.test_table_name}
        if all(bases.values()) and not args.processed_table_name:
            data = frame_from_xy(spark, bases, args.key_columns, args.target_column, args.catalog, args.schema)
        elif any(bases.values()):
            raise SystemExit("give either --processed_table_name or all of --train/--val/--test_table_name")
        else:
            data = spark.table(DataFlowConfig(source="", catalog=args.catalog, schema=args.schema).name(
                args.processed_table_name or TABLES["processed"]))
        out = run_model_flow(data, cfg).metrics
    out.show(truncate=False)
    return out


if __name__ == "__main__":
    main()
