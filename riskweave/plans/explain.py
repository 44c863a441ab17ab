"""Per-transaction explanations of tree ensembles: exact Shapley values of the trees.

The value of a set of known features is the tree's expectation when every split on an unknown
feature is averaged by the training rows on either side (the published path-dependent tree
Shapley values).  The base value and the contributions of a row add up to its log-odds.

A leaf is reached with the product over its features of ``met`` (known: is the row within the
leaf's bounds) or ``share`` (unknown: the share of rows that go there).  When every feature is known
with the same chance t, the product is one polynomial in t per leaf, a feature's part is that
polynomial with its own factor divided out, and the Shapley value is the integral over t from 0 to
1.  A polynomial below degree 2q is integrated exactly by q points, so a leaf of d features costs
d multiplications and d divisions at d/2 points.

Rows are explained independently inside the tasks; what travels to them is the table of leaves,
flat arrays whose size depends on the growing parameters only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.rates import top
from .ensemble import Ensemble

#: Cells (rows x leaves x features of a leaf) worked on at once.
CELLS = 1 << 20


@dataclass(frozen=True)
class Leaves:
    """The leaves of one tree, a line each: value, and per feature on its path the bounds
    (``low < x <= high``) and the share of rows.  Short paths are filled up with a feature that is
    always met and has share 1, which changes nothing."""

    value: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray

    @property
    def base(self) -> float:
        return float((self.value * self.share.prod(axis=1)).sum())


def tree_leaves(tree: np.ndarray) -> Leaves:
    """The leaves of a node table."""
    found, stack = [], [(0, {})]
    while stack:
        node, path = stack.pop()
        row = tree[node]
        if row["feature"] < 0:
            found.append((float(row["value"]), path))
            continue
        f, threshold = int(row["feature"]), float(row["threshold"])
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        for child, bounds in ((row["left"], (low, min(high, threshold))), (row["right"], (max(low, threshold), high))):
            part = share * float(tree["n"][child]) / float(row["n"])
            stack.append((int(child), {**path, f: (*bounds, part)}))
    depth = max(1, max(len(path) for _, path in found))
    lines = [[(f, *v) for f, v in path.items()] + [(0, -np.inf, np.inf, 1.0)] * (depth - len(path)) for _, path in found]
    columns = np.array(lines, dtype=float)
    return Leaves(np.array([v for v, _ in found]), columns[:, :, 0].astype(np.int32), *(columns[:, :, i] for i in (1, 2, 3)))


def _leaf_parts(leaves: Leaves, met: np.ndarray) -> np.ndarray:
    """What each feature of each leaf contributes where ``met`` (leaf, place on its path, case) says
    which bounds hold."""
    points, weights = np.polynomial.legendre.leggauss(met.shape[1] // 2 + 1)
    points, weights = (points + 1) / 2, weights / 2
    share, parts = leaves.share[:, :, None], np.zeros(met.shape)
    for t, weight in zip(points, weights):
        factor = share * (1 - t) + met * t
        parts += weight * factor.prod(axis=1, keepdims=True) / factor
    return parts * (met - share) * leaves.value[:, None, None]


def shapley_values(x: np.ndarray, trees: list[Leaves]) -> np.ndarray:
    """Contribution of every feature for every row of ``x``.

    A leaf's part of a row depends only on which of the leaf's bounds hold.  Where there are at
    least as many rows as ways they can hold, each way is worked out once and rows look theirs up.
    """
    columns = np.ascontiguousarray(x.T)
    out = np.zeros(columns.shape)
    for leaves in trees:
        n_leaves, depth = leaves.feature.shape
        low, high = leaves.low[:, :, None], leaves.high[:, :, None]
        real = [f[np.isfinite(a) | np.isfinite(b)] for f, a, b in zip(leaves.feature, leaves.low, leaves.high)]
        table = None
        if depth < 31 and 1 << depth <= min(len(x), max(1, CELLS // leaves.feature.size)):
            ways = (np.arange(1 << depth) >> np.arange(depth)[:, None] & 1).astype(float)
            table = _leaf_parts(leaves, np.broadcast_to(ways, (n_leaves, *ways.shape)))
        step = max(1, CELLS // leaves.feature.size)
        for at in range(0, len(x), step):
            seen = columns[:, at : at + step][leaves.feature]
            met = (seen > low) & (seen <= high)
            own = out[:, at : at + step]
            if table is None:
                for features, parts in zip(real, _leaf_parts(leaves, met.astype(float))):
                    own[features] += parts[: len(features)]
                continue
            way = sum(met[:, j].astype(np.int64) << j for j in range(depth))
            for features, parts, row in zip(real, table, way):
                own[features] += parts[: len(features)].take(row, axis=1)
    return out.T


def attribute(df: DataFrame, model: Ensemble, key: str = S.KEY) -> DataFrame:
    """Key, base value and one contribution per feature, in feature order, for every row of model
    input (``x``)."""
    trees = [tree_leaves(tree) for tree in model.trees]
    base = model.start + sum(leaves.base for leaves in trees)
    shared = df.sparkSession.sparkContext.broadcast(trees)  # bounded by the growing parameters
    key_type = dict(df.dtypes)[key]

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                values = shapley_values(np.stack(batch["x"].to_numpy()), shared.value)
                yield pd.DataFrame({key: batch[key], "base": base, "contributions": list(values)})

    rows = df.select(key, "x").repartition(F.col(key))
    return rows.mapInPandas(explain, f"{key} {key_type}, base double, contributions array<double>")


def attribution_rows(attributions: DataFrame, names: list[str], key: str = S.KEY) -> DataFrame:
    """One row per transaction and feature: feature, contribution."""
    labels = F.array(*[F.lit(n) for n in names])
    pairs = F.explode(F.arrays_zip(labels.alias("feature"), F.col("contributions").alias("contribution")))
    return attributions.select(key, pairs.alias("p")).select(
        key, F.col("p.feature").alias("feature"), F.col("p.contribution").alias("contribution")
    )


def attribution_summary(rows: DataFrame, n: int = 20) -> DataFrame:
    """Features by mean absolute contribution."""
    means = rows.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
    return top(means, n, by="mean_abs_contribution", ties=["feature"])


def drill_through(rows: DataFrame, transaction_id: int, n: int = 20, key: str = S.KEY) -> DataFrame:
    """The strongest drivers of one transaction's score."""
    one = rows.filter(F.col(key) == transaction_id)
    return one.orderBy(F.desc(F.abs("contribution")), "feature").limit(n)
