"""pistil: Spark-native tabular preparation and model selection.

Every operator is a function from DataFrames to DataFrames (or to fitted Spark ML
models); writing is kept apart so each step can be planned, explained and checked
on its own. Nothing collects table data to the driver.

The names below are the everyday surface; the modules hold the rest.
"""

from .functions.hashing import hash_uniform, keyed_uniform, key_string
from .functions.naming import snake_case
from .functions.stamps import experiment_path, zone_stamp
from .functions.vectors import argmax, index_to_label, mean_arrays
from .operators.ensemble import refit, soft_vote, union_train_val
from .operators.metrics import accuracy
from .operators.models import assemble, fit, fit_label_indexer, predict, training_frame
from .operators.prep import (drop_column, features_and_target, join_features_target,
                             process_table, rename_snake_case, shuffle_rows,
                             with_hash_position)
from .operators.profile import (class_counts, class_means, correlations, describe, head,
                                profile_report, row_count, safe_corr)
from .operators.space import LR_SPACE, RF_SPACE, Choice, IntRange, LogUniform, Uniform
from .operators.split import (check_ratios, hash_split, random_split, select_splits,
                              split_counts, tag_split)
from .operators.trials import best_trial, score_to_loss
from .operators.tune import tune
from .plans.data_flow import DataFlowConfig, run_data_flow
from .plans.model_flow import ModelFlowConfig, run_model_flow
from .sources.csv import read_csv, write_csv
from .sources.tables import load_csv_table, table_name, write_table

__version__ = "0.1.0"
