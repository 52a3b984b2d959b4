"""Probabilities of a fitted random forest, batch by batch.

Spark walks one row at a time through objects that lie all over the heap, about 1,600 of them in 200 trees of
depth 8. Here the nodes of the saved model are arrays, and all rows of a batch walk down a few trees at a time.
"""

from __future__ import annotations

from functools import partial
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.sources.scratch import remove_folder, shared_folder

# Trees walked at a time: their nodes and the places of a batch's rows fit a core's cache.
TREES_AT_ONCE = 16
CONTINUOUS = -1

Forest = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]


def forest_nodes(spark: SparkSession, model: RandomForestClassificationModel) -> Forest | None:
    """``roots, children, features, thresholds, shares`` and the depth; None where a split is by categories.

    The children of node ``i`` are ``children[2 * i]`` and ``children[2 * i + 1]``; a leaf's are itself.
    """
    path = f"{shared_folder(spark)}/forest-{uuid4().hex[:12]}"
    model.save(path)
    try:
        node, split = "nodeData.", "nodeData.split."
        rows = (
            spark.read.parquet(f"{path}/data")
            .select(
                F.col("treeID").alias("tree"),
                *[F.col(node + c).alias(c) for c in ("id", "leftChild", "rightChild", "impurityStats")],
                F.col(split + "featureIndex").alias("feature"),
                F.get(split + "leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
                F.col(split + "numCategories").alias("categories"),
            )
            .toPandas()
            .sort_values(["tree", "id"])
        )
    finally:
        remove_folder(spark, path)
    tree = rows["tree"].to_numpy(np.int64)
    inner = rows["leftChild"].to_numpy() >= 0
    if (rows["categories"].to_numpy()[inner] != CONTINUOUS).any():
        return None
    roots = np.searchsorted(tree, np.arange(model.getNumTrees))
    own = np.arange(len(rows))
    # Nodes of a tree are numbered from 0 without gaps.
    sides = [np.where(inner, roots[tree] + rows[c].to_numpy(np.int64), own) for c in ("leftChild", "rightChild")]
    stats = np.array(rows["impurityStats"].tolist(), float)
    total = stats[:, 0] + stats[:, 1]
    shares = np.where(total[:, None] != 0, stats / np.where(total != 0, total, 1.0)[:, None], 0.0)
    features = np.where(inner, rows["feature"], 0).astype(np.int64)
    thresholds = np.where(inner, rows["threshold"].astype(float), 0.0)
    depth = max(t.depth for t in model.trees)
    return roots, np.column_stack(sides).ravel(), features, thresholds, shares, depth


def walk(forest: Forest, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each row of ``x``, the votes added tree by tree as Spark adds them."""
    roots, children, features, thresholds, shares, depth = forest
    n, width = x.shape
    values, start = x.ravel(), np.arange(n) * width
    votes = np.zeros((2, n))
    for first in range(0, len(roots), TREES_AT_ONCE):
        some = roots[first : first + TREES_AT_ONCE]
        place = np.repeat(some, n)
        row = np.tile(start, len(some))
        for _ in range(depth):
            left = values[row + features[place]] <= thresholds[place]
            place = children[2 * place + ~left]
        for leaves in place.reshape(len(some), n):
            votes += shares[leaves].T
    total = votes[0] + votes[1]
    return np.divide(votes[1], total, out=np.zeros(n), where=total != 0)


def _batch(sent, features: pa.Array) -> pa.Array:
    if not len(features):
        return pa.array([], pa.float64())
    x = features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), -1)
    return pa.array(walk(sent.value, x))


def forest_probability(spark: SparkSession, model: RandomForestClassificationModel, features: str) -> Column | None:
    """Probability of label 1 as the model's ``transform`` gives it; None where only that can tell."""
    if model.numClasses != 2:
        return None
    nodes = forest_nodes(spark, model)
    if nodes is None:
        return None
    work = partial(_batch, spark.sparkContext.broadcast(nodes))

    def probability(column: pa.Array) -> pa.Array:
        return work(column)

    return F.arrow_udf(probability, "double")(vector_to_array(features))


def with_probability(model: RandomForestClassificationModel, df: DataFrame, output: str) -> DataFrame:
    """``df`` with the probability of label 1 in ``output``."""
    column = forest_probability(df.sparkSession, model, model.getFeaturesCol())
    if column is None:
        return model.transform(df).withColumn(output, vector_to_array("probability")[1])
    return df.withColumn(output, column)
