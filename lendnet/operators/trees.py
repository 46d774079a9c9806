"""Per-row attributions of boosted trees: path contributions over a small broadcast tree table.

On a row's way down a tree each step changes the expected value by (child - node); that change belongs to
the node's feature. Per row, base + sum of contributions = margin, exactly. The node table has one row
per tree node (trees x 2**depth), whatever the number of rows scored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T


class TreeNode(NamedTuple):
    """``feature`` is -1 at a leaf; rows with value <= threshold go to ``left`` (node numbers inside the tree)."""
    tree: int
    node: int
    feature: int
    threshold: float
    left: int
    right: int
    value: float
    weight: float


def gbt_nodes(model) -> list[TreeNode]:
    """The node table of a fitted Spark ML gradient-boosted-trees model."""
    out: list[TreeNode] = []
    for k, (tree, weight) in enumerate(zip(model.trees, model.treeWeights)):
        todo = [(tree._call_java("rootNode"), 0)]
        count = 1
        while todo:
            node, number = todo.pop()
            if node.getClass().getSimpleName() == "LeafNode":
                out.append(TreeNode(k, number, -1, 0.0, -1, -1, float(node.prediction()), float(weight)))
                continue
            split = node.split()
            left, right = count, count + 1
            count += 2
            out.append(TreeNode(k, number, int(split.featureIndex()), float(split.threshold()), left, right,
                                float(node.prediction()), float(weight)))
            todo += [(node.leftChild(), left), (node.rightChild(), right)]
    return out


def base_margin(nodes: list[TreeNode]) -> float:
    return sum(n.weight * n.value for n in nodes if n.node == 0)


def _walk(nodes: list[TreeNode], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(margin, contributions rows x features) of a feature matrix."""
    contrib = np.zeros_like(x)
    margin = np.zeros(len(x))
    for tree in sorted({n.tree for n in nodes}):
        own = {n.node: n for n in nodes if n.tree == tree}
        todo = [(own[0], np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node.feature < 0:
                margin[rows] += node.weight * node.value
                continue
            # a missing value is not <= any threshold, so it goes right, as in the trained model
            goes_left = x[rows, node.feature] <= node.threshold
            for child, part in ((own[node.left], rows[goes_left]), (own[node.right], rows[~goes_left])):
                contrib[part, node.feature] += node.weight * (child.value - node.value)
                todo.append((child, part))
    return margin, contrib


def tree_contrib(df: DataFrame, nodes: list[TreeNode], features: list[str], out: str = "factors",
                 margin: str = "margin") -> DataFrame:
    """``df`` plus ``margin`` and ``out`` (array<struct<feature, shap_value>> in feature order)."""
    spark = df.sparkSession
    ref = spark.sparkContext.broadcast((nodes, list(features)))
    kind = T.ArrayType(T.StructType([T.StructField("feature", T.StringType()), T.StructField("shap_value", T.DoubleType())]))
    schema = T.StructType([*df.schema.fields, T.StructField(margin, T.DoubleType()), T.StructField(out, kind)])

    def run(batches):
        import pyarrow as pa
        table, names = ref.value
        for b in batches:
            x = np.column_stack([np.asarray(b.column(b.schema.get_field_index(c)).cast(pa.float64()).to_numpy(
                zero_copy_only=False), dtype=float) for c in names]) if b.num_rows else np.zeros((0, len(names)))
            m, c = _walk(table, x)
            items = pa.StructArray.from_arrays(
                [pa.array(names * b.num_rows, pa.string()), pa.array(c.reshape(-1), pa.float64())],
                names=["feature", "shap_value"])
            cuts = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(names))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(m, pa.float64()), pa.ListArray.from_arrays(cuts, items)],
                names=[*b.schema.names, margin, out])
    return df.mapInArrow(run, schema)
