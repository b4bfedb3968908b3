"""Fitted tree ensembles as arrays: scores of their first trees, and pruned copies.

A saved ensemble is a table of nodes. ``ensemble`` reads it into arrays, of which one pass
over the rows makes the scores of several ensembles that the one fit holds: its first 50 or
100 trees, and its trees cut where a node has fewer rows than asked. An ensemble lives on
the driver anyway, so the arrays are as bounded as the fit itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import drop_staged, staged_path


@dataclass
class Ensemble:
    """Nodes of all trees in one table; a leaf is its own child.

    ``value`` is the share of class 1 (forests) or the prediction (boosting) of a node, and
    ``weights`` the weight of each tree.
    """

    roots: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    rows: np.ndarray
    weights: np.ndarray

    def leaf_values(self, x: np.ndarray, least_rows: int = 2) -> np.ndarray:
        """(row, tree) values of the nodes where rows end up; a node of fewer than
        ``least_rows`` rows is not split."""
        split = (self.left != np.arange(len(self.left))) & (self.rows >= least_rows)
        node = np.tile(self.roots, (len(x), 1))
        row, tree = np.nonzero(split[node])
        while len(row):
            here = node[row, tree]
            low = x[row, self.feature[here]] <= self.threshold[here]
            here = np.where(low, self.left[here], self.right[here])
            node[row, tree] = here
            more = split[here]
            row, tree = row[more], tree[more]
        return self.value[node]

    def forest_scores(self, x: np.ndarray, sizes: Sequence[int], least_rows: int) -> np.ndarray:
        """(row, size): the mean share of class 1 over the first trees."""
        total = np.cumsum(self.leaf_values(x, least_rows), axis=1)
        return np.stack([total[:, n - 1] / n for n in sizes], axis=1)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """The weighted sum over all trees."""
        return self.leaf_values(x) @ self.weights

    def boosted_scores(self, x: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
        """(row, size): the probability by the first trees."""
        total = np.cumsum(self.leaf_values(x) * self.weights, axis=1)
        return np.stack([1 / (1 + np.exp(np.clip(-2 * total[:, n - 1], -700, 700))) for n in sizes], axis=1)


def ensemble(spark: SparkSession, model: Model, forest: bool) -> Ensemble:
    """The nodes of a fitted forest or boosted ensemble over continuous features."""
    path = staged_path(spark, "ensemble")
    model.write().save(path)
    share = "get(nodeData.impurityStats, 1) / aggregate(nodeData.impurityStats, 0D, (a, x) -> a + x)"
    nodes = (
        spark.read.parquet(f"{path}/data")
        .selectExpr(
            "treeID as tree", "nodeData.id as id", "nodeData.leftChild as left", "nodeData.rightChild as right",
            "nodeData.split.featureIndex as feature", "get(nodeData.split.leftCategoriesOrThreshold, 0) as threshold",
            f"{share if forest else 'nodeData.prediction'} as value", "nodeData.rawCount as rows",
        )
        .toArrow()
    )
    drop_staged(spark, path)
    tree, node, left, right, feature, threshold, value, rows = (
        nodes.column(i).fill_null(0).to_numpy() for i in range(8)
    )
    order = np.lexsort((node, tree))
    tree, node, left, right = tree[order], node[order], left[order], right[order]
    roots = np.flatnonzero(node == 0)
    base, own = roots[tree], np.arange(len(tree))
    inner = left >= 0
    return Ensemble(
        roots,
        np.where(inner, base + left, own),
        np.where(inner, base + right, own),
        np.maximum(feature[order], 0),
        threshold[order],
        value[order],
        rows[order],
        np.array(model.treeWeights),
    )


def pruned(spark: SparkSession, model: Model, least_rows: int) -> Model:
    """The same forest, no node of fewer than ``least_rows`` rows being split.

    Growth is greedy, so a forest grown under that bound is this one cut short (Spark merges
    leaves that predict the same class, and has done so before the cut): the saved table of nodes is rewritten with such nodes as leaves, and loaded again.
    """
    if least_rows <= 2:
        return model
    path, target = staged_path(spark, "forest"), staged_path(spark, "forest")
    model.write().save(path)
    small = F.col("nodeData.rawCount") < least_rows
    split = F.struct(
        F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories")
    )
    cut = F.col("nodeData")
    for name, value in (("leftChild", F.lit(-1)), ("rightChild", F.lit(-1)), ("gain", F.lit(-1.0)), ("split", split)):
        cut = cut.withField(name, F.when(small, value).otherwise(F.col(f"nodeData.{name}")))
    spark.read.parquet(f"{path}/data").withColumn("nodeData", cut).write.parquet(f"{target}/data")
    spark.read.text(f"{path}/metadata").coalesce(1).write.text(f"{target}/metadata")
    spark.read.parquet(f"{path}/treesMetadata").write.parquet(f"{target}/treesMetadata")
    found = type(model).load(target)
    drop_staged(spark, path, target)
    return found


def scored_by(df: DataFrame, features: str, label: str, score, names: Sequence[int]) -> DataFrame:
    """(point, label, score): every row's score by every point, ``score(x)`` giving (row, point)."""
    import pyarrow as pa
    from pyspark.ml.functions import vector_to_array

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                x = part.column(0).flatten().to_numpy().reshape(part.num_rows, -1)
                found = score(x)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.array(names, np.int32), n)),
                        pa.array(np.repeat(part.column(1).to_numpy(), len(names))),
                        pa.array(np.ascontiguousarray(found, dtype=np.float64).ravel()),
                    ],
                    ["point", "label", "score"],
                )

    read = df.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("label"))
    return read.mapInArrow(run, "point int, label int, score double")
