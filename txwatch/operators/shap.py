"""Exact Shapley values of a boosted-tree model, for every row.

A row's raw score is a sum over trees, and a tree is a sum over its leaves, so
Shapley values add up leaf by leaf. A leaf is a box: each feature on its path
has to lie between two cuts. If a feature is not known, a row goes on with the
share of the training weight that went that way (the path-dependent
expectation). A leaf's part for one feature then depends only on which of its at
most ``depth`` features lie inside the box, so all ``2 ** m`` cases of a leaf are
worked out once, and a row looks its case up: the work a row is
``leaves x depth`` whatever the number of features.

Rows are scored in Arrow batches where they lie; means travel as one partial
sum a task and feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch import schemas as S

#: Rows that a task holds as a matrix.
ROWS = 4096


@dataclass
class Leaf:
    """``feature, low, high`` of each feature on the path (inside: low < x <= high)
    and ``part[case, k]``, its k-th feature's share when the bits of ``case`` lie inside."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    part: np.ndarray


@dataclass
class Explainer:
    """The leaves of all trees, and the mean raw score (``base``)."""

    leaves: list[Leaf]
    base: float
    features: int

    def values(self, x: np.ndarray) -> np.ndarray:
        """Shapley values of the raw score (rows, features)."""
        out = np.zeros((len(x), self.features))
        columns = np.ascontiguousarray(x.T)
        rows = np.arange(len(x))
        for leaf in self.leaves:
            case = np.zeros(len(x), np.int64)
            for k, f in enumerate(leaf.feature.tolist()):
                # as the trees go: a missing value is not at or below any cut
                inside = ~(columns[f] <= leaf.low[k]) if np.isfinite(leaf.low[k]) else np.ones(len(x), bool)
                if np.isfinite(leaf.high[k]):
                    inside &= columns[f] <= leaf.high[k]
                case |= inside.astype(np.int64) << k
            out[rows[:, None], leaf.feature] += leaf.part[case]
        return out


def shares(value: float, ratio: np.ndarray) -> np.ndarray:
    """``part[case, k]`` of a leaf whose features' unknown shares are ``ratio``.

    The leaf adds ``value * prod(inside_j or ratio_j)``; feature k's Shapley value
    in that game is ``value * (inside_k - ratio_k)`` times the sum over the sets of
    other known features of their weight and product."""
    m = len(ratio)
    weight = [factorial(s) * factorial(m - s - 1) / factorial(m) for s in range(m)]
    cases = (np.arange(1 << m)[:, None] >> np.arange(m)) & 1  # (cases, features)
    part = np.zeros((1 << m, m))
    for k in range(m):
        sums = np.zeros((1 << m, m))  # by the number of known features
        sums[:, 0] = 1.0
        for j in range(m):
            if j != k:
                known = sums[:, :-1] * cases[:, j, None]
                sums *= ratio[j]
                sums[:, 1:] += known
        part[:, k] = value * (cases[:, k] - ratio[k]) * (sums * weight).sum(1)
    return part


def _boxes(node, scale: float) -> Iterator[tuple[float, float, dict[int, tuple[float, float, float]]]]:
    """``value, share, {feature: (low, high, ratio)}`` of each leaf below a node of the fitted tree."""
    stack = [(node, 1.0, {})]
    while stack:
        at, share, path = stack.pop()
        if at.getClass().getSimpleName() == "LeafNode":
            yield scale * at.prediction(), share, path
            continue
        split = at.split()
        if split.getClass().getSimpleName() != "ContinuousSplit":
            raise ValueError("only continuous splits can be explained")
        f, cut, whole = at.split().featureIndex(), split.threshold(), at.impurityStats().count()
        low, high, ratio = path.get(f, (-np.inf, np.inf, 1.0))
        for child, box in ((at.leftChild(), (low, min(high, cut))), (at.rightChild(), (max(low, cut), high))):
            part = child.impurityStats().count() / whole
            stack.append((child, share * part, {**path, f: (*box, ratio * part)}))


def explainer(model: PipelineModel, features: int = len(S.FEATURES)) -> Explainer:
    """The fitted pipeline's last stage, taken apart (bounded by trees x leaves x 2**depth)."""
    gbt = model.stages[-1]
    leaves, base = [], 0.0
    for tree, scale in zip(gbt.trees, gbt.treeWeights, strict=True):
        for value, share, path in _boxes(tree._java_obj.rootNode(), scale):
            base += value * share
            if path and value:
                low, high, ratio = (np.array(x) for x in zip(*path.values(), strict=True))
                leaves.append(Leaf(np.array(list(path)), low, high, shares(value, ratio)))
    return Explainer(leaves, base, features)


def _matrices(batches, features: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, np.column_stack([part.column(f).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in features])


def shap_values(model: PipelineModel, df: DataFrame, features: list[str] = S.FEATURES,
                id_col: str = "transaction_id") -> DataFrame:
    """One row per input row: the id, ``base`` and ``shap`` (one value a feature);
    base and values add up to the model's raw score of class 1."""
    taken = explainer(model, len(features))
    wanted = list(features)

    def run(batches):
        for part, x in _matrices(batches, wanted):
            values = taken.values(x)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.full(len(x), taken.base)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(wanted)), pa.array(values.ravel()))],
                names=[id_col, "base", "shap"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, *wanted).mapInArrow(run, f"`{id_col}` {kind}, base double, shap array<double>")


def shap_importance(model: PipelineModel, df: DataFrame, features: list[str] = S.FEATURES) -> DataFrame:
    """``feature, mean_abs_shap, mean_shap``, most important first, over all rows."""
    taken = explainer(model, len(features))
    wanted = list(features)

    def run(batches):
        n, total, absolute = 0, np.zeros(len(wanted)), np.zeros(len(wanted))
        for _, x in _matrices(batches, wanted):
            values = taken.values(x)
            n, total, absolute = n + len(x), total + values.sum(0), absolute + np.abs(values).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(wanted), pa.array([n] * len(wanted), pa.int64()), pa.array(total), pa.array(absolute)],
                                             names=["feature", "n", "total", "absolute"])

    parts = df.select(*wanted).mapInArrow(run, "feature string, n long, total double, absolute double")
    return (parts.groupBy("feature").agg((F.sum("absolute") / F.sum("n")).alias("mean_abs_shap"),
                                         (F.sum("total") / F.sum("n")).alias("mean_shap"))
            .orderBy(F.desc("mean_abs_shap"), "feature"))
