"""A fitted ensemble of trees: its node table, scores, and storage."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One node: its split (feature -1: a leaf), the children's places in the table of its tree, the
#: rows and sums it was grown from, and what a row that ends there adds to the margin.
NODE = np.dtype(
    [
        ("feature", np.int32), ("bin", np.int32), ("threshold", float), ("left", np.int32), ("right", np.int32),
        ("gain", float), ("n", np.int64), ("g", float), ("h", float), ("value", float),
    ]
)
_NUMBERS = {np.int32: "int", np.int64: "bigint", np.float64: "double"}
NODE_SCHEMA = "tree int, node int, " + ", ".join(f"{n} {_NUMBERS[NODE[n].type]}" for n in NODE.names)


def _ends(tree: np.ndarray, n: int, goes_left) -> np.ndarray:
    """Where each of ``n`` rows ends; ``goes_left(nodes, rows)`` decides for rows at split nodes."""
    split, left, right = tree["feature"] >= 0, tree["left"].astype(np.int64), tree["right"].astype(np.int64)
    ends, at, rows = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.arange(n)
    while len(rows):
        goes = split.take(at)
        if not goes.all():
            ends[rows[~goes]] = at[~goes]
            rows, at = rows[goes], at[goes]
        at = np.where(goes_left(at, rows), left.take(at), right.take(at))
    return ends


def bin_leaves(tree: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The node of ``tree`` where each row ends; ``bins`` has a line per feature."""
    n = bins.shape[1]
    feature, bin_ = tree["feature"].astype(np.int64) * n, tree["bin"].copy()
    return _ends(tree, n, lambda node, rows: bins.take(feature.take(node) + rows) <= bin_.take(node))


def leaves(tree: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The node of ``tree`` where each row of ``x`` ends."""
    return _ends(tree, len(x), lambda node, rows: x[rows, tree["feature"][node]] <= tree["threshold"][node])


def table_of(nodes: list[tuple], features: list[str]) -> np.ndarray:
    """A node table from (feature, threshold, left, right, gain, rows) and (value, rows) tuples."""
    tree = np.zeros(len(nodes), dtype=NODE)
    for i, node in enumerate(nodes):
        if len(node) == 2:
            tree["feature"][i], tree["value"][i], tree["n"][i] = -1, *node
        else:
            tree["feature"][i] = features.index(node[0])
            for name, value in zip(("threshold", "left", "right", "gain", "n"), node[1:]):
                tree[name][i] = value
    return tree


@dataclass
class Ensemble:
    """Trees whose values add up, with ``start``, to the log-odds of the positive class.

    Its size depends on the growing parameters only (at most 1000 trees of 511 nodes as
    configured), never on the rows it was fitted on.
    """

    features: list[str]
    start: float
    trees: list[np.ndarray]

    def margins(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((tree["value"][leaves(tree, x)] for tree in self.trees), np.zeros(len(x)))

    def margin(self, spark: SparkSession, x: Column) -> Column:
        """The log-odds for an array column of feature values."""
        shared = spark.sparkContext.broadcast(self)  # bounded by the growing parameters

        @F.pandas_udf(T.DoubleType())
        def margin(values: pd.Series) -> pd.Series:
            return pd.Series(shared.value.margins(np.stack(values.to_numpy())) if len(values) else [], dtype=float)

        return margin(x)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The node table; see NODE."""
        frames = [pd.DataFrame(tree).assign(tree=k, node=np.arange(len(tree))) for k, tree in enumerate(self.trees)]
        table = pd.concat(frames) if frames else pd.DataFrame(columns=["tree", "node", *NODE.names])
        names = ["tree", "node", *NODE.names]
        return spark.createDataFrame(table[names], NODE_SCHEMA) if len(table) else spark.createDataFrame([], NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model to a folder, replacing what is there."""
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        head = [(float(self.start), len(self.trees), list(self.features))]
        spark.createDataFrame(head, "start double, n_trees int, features array<string>").coalesce(1).write.mode("overwrite").parquet(f"{path}/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Ensemble:
        head = spark.read.parquet(f"{path}/head").first()
        # bounded: the node table depends on the growing parameters only
        table = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"])
        trees: list[np.ndarray] = []
        for _, group in table.groupby("tree", sort=True):
            tree = np.zeros(len(group), dtype=NODE)
            for name in NODE.names:
                tree[name] = group[name].to_numpy()
            trees.append(tree)
        return Ensemble(list(head["features"]), head["start"], trees)


def importance(nodes: DataFrame, names: list[str], kind: str = "gain") -> DataFrame:
    """(feature, importance) of every feature, adding up to 1 (all 0 without a split).

    ``gain`` is the mean gain of a feature's splits, ``total_gain`` their sum, ``splits`` their
    number.
    """
    measure = {"gain": F.avg("gain"), "total_gain": F.sum("gain"), "splits": F.count("gain").cast("double")}[kind]
    values = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    every = nodes.sparkSession.sql(f"SELECT * FROM VALUES {values} AS f(id, name)")
    own = nodes.filter("feature >= 0").groupBy(F.col("feature").alias("id")).agg(measure.alias("value"))
    total = own.agg(F.sum("value").alias("total"))
    # bounded: one row, and one row per feature
    rows = every.join(F.broadcast(own), "id", "left").join(F.broadcast(total))
    return rows.select(F.col("name").alias("feature"), F.coalesce(F.col("value") / F.col("total"), F.lit(0.0)).alias("importance"))
