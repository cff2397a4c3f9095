"""Default table and column names of the original flow."""

TABLES = {
    "raw": "table_iris_raw",
    "processed": "table_iris_processed",
    "train": "table_iris_train",
    "val": "table_iris_val",
    "test": "table_iris_test",
}
FEATURES = ("sepal_length_cm", "sepal_width_cm", "petal_length_cm", "petal_width_cm")
TARGET = "species"
REFIT_MAX_ITER = 1000
