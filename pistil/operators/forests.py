"""Forest limits that Spark's trees do not have: the least number of rows of a node that is split.

A fitted forest stores with every node how many rows (bootstrap draws counted) reached it. Children have fewer than
their parent, so making every node below the limit a leaf, with the class counts it already has, leaves a forest
none of whose splits is of a smaller node. Nodes are rows of a table: the cut is a join of nodes with their
parents and a renumbering inside each tree, on the stored form of the model.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import current_session, scratch_path

NODE = "nodeData"


def forest_nodes(path: str) -> DataFrame:
    """The nodes of a stored forest: ``treeID`` and ``nodeData``."""
    return current_session().read.parquet(f"{path}/data")


def cut_small_splits(nodes: DataFrame, least: int) -> DataFrame:
    """``nodes`` where every node of fewer than ``least`` rows is a leaf; numbered without gaps in each tree, parents first."""
    n = nodes.select("treeID", f"{NODE}.*")
    split = (F.col("leftChild") >= 0) & (F.col("rawCount") >= least)
    below = (n.where("leftChild >= 0").select("treeID", (F.col("rawCount") >= least).alias("reached"),
                                              F.explode(F.array("leftChild", "rightChild")).alias("id")))
    # counts fall from parent to child, so a node goes exactly if its parent is under the limit
    kept = n.join(below, ["treeID", "id"], "left").where(F.coalesce("reached", F.lit(True)))
    order = Window.partitionBy("treeID").orderBy("id")
    kept = kept.withColumn("new", (F.row_number().over(order) - 1).cast("int"))
    place = kept.select("treeID", F.col("id").alias("old"), "new")
    for side in ("leftChild", "rightChild"):
        to = place.select("treeID", F.col("old").alias(side), F.col("new").alias(f"new_{side}"))
        kept = kept.join(to, ["treeID", side], "left")
    parts = {
        "id": F.col("new"),
        "gain": F.when(split, F.col("gain")).otherwise(-1.0),
        "leftChild": F.when(split, F.col("new_leftChild")).otherwise(-1),
        "rightChild": F.when(split, F.col("new_rightChild")).otherwise(-1),
        "split": F.when(split, F.col("split")).otherwise(F.struct(
            F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))),
    }
    shape = nodes.schema[NODE].dataType
    return kept.select("treeID", F.struct(*[parts.get(c, F.col(c)).cast(shape[c].dataType).alias(c) for c in shape.names]).alias(NODE))


def with_least_split(model: RandomForestClassificationModel, share: float, rows: int) -> RandomForestClassificationModel:
    """The forest with no split of a node under ``ceil(share * rows)`` rows."""
    spark = current_session()
    path = scratch_path(spark, "forest")
    model.write().save(path)
    cut_small_splits(forest_nodes(path), math.ceil(share * rows)).coalesce(1).write.parquet(f"{path}/cut")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(hadoop(f"{path}/data"), True)
    fs.rename(hadoop(f"{path}/cut"), hadoop(f"{path}/data"))
    out = RandomForestClassificationModel.load(path)
    fs.delete(hadoop(path), True)                  # the loaded model is on the driver
    return out
