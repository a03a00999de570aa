"""Gradient-boosted CPU-spike predictor (M2-M9).

The six features are codes and flags, so the log has at most ``MOST_CELLS``
combinations of them and the label, whatever its size. Spark counts the log
per combination; the learner works on these counts as weights, and training
cost does not depend on the number of log rows.

Boosting is of second order: every row has a gradient and a curvature, a level
of a tree is grown from one histogram of both over (node, feature, value), and
leaves are ridge steps. Gradients and curvatures are whole numbers of 2^-24,
so histograms are exact sums, equal splits have equal gains, and the trees do
not depend on the order of the counts. Of equal gains the first feature, then
the smallest value is taken. A missing value is less than all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import metrics
from tidewatch.operators.selection import split_stratified
from tidewatch.session import stage

FEATURES = ["hour_of_day", "day_of_week", "is_peak_hour", "is_orders_table", "qt_code", "tbl_code"]
LABEL = "is_high_cpu"

# Fixed values of the learner.
N_TREES = 300
DEPTH = 5
RATE = 0.05
BASE = 0.0  # log odds before the first tree
RIDGE = 1.0
LEAST_CURVATURE = 1.0
LEAST_GAIN = 1e-6
TEST_SHARE = 0.2
SEED = 42

UNIT = 1 << 24
MOST_CELLS = 200_000
MISSING = -1
_NODES = "tree int, slot int, feature int, threshold int, gain double, value double"


@dataclass(frozen=True)
class Booster:
    """Trees as complete binary heaps: slot i has the children 2i+1 and 2i+2; a leaf has the feature -1."""

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    gain: np.ndarray
    value: np.ndarray

    @property
    def trees(self) -> int:
        return len(self.feature)

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of each row of feature values."""
        out, at = np.full(len(rows), self.base), np.arange(len(rows))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            slot = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth):
                split = feature[slot]
                left = rows[at, split] <= threshold[slot]
                slot = np.where(split < 0, slot, 2 * slot + np.where(left, 1, 2))
            out += value[slot]
        return out

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The model as a table, one row per node that was reached."""
        tree, slot = np.nonzero((self.feature >= 0) | (self.value != 0))
        held = {n: getattr(self, n)[tree, slot] for n in ("feature", "threshold", "gain", "value")}
        return spark.createDataFrame(pd.DataFrame({"tree": tree, "slot": slot, **held}), _NODES)


def weighted_counts(features: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """Rows per split, feature combination and label."""
    split = split_stratified(features, LABEL, key, TEST_SHARE, seed)
    return split.groupBy("is_test", *FEATURES, LABEL).agg(F.count("*").alias("weight"))


def fit(counts: DataFrame, n_trees: int = N_TREES, depth: int = DEPTH) -> Booster:
    """Train on weighted combinations (M2); rows without a label are left out."""
    labelled = counts.filter(F.col(LABEL).isNotNull()).groupBy(*FEATURES, LABEL).agg(F.sum("weight").cast("long").alias("weight"))
    cells = labelled.limit(MOST_CELLS + 1).toPandas()
    if len(cells) > MOST_CELLS:
        raise ValueError("the features have more combinations than codes and flags can have")
    return boost(_matrix(cells), cells[LABEL].to_numpy(np.int64), cells["weight"].to_numpy(np.int64), n_trees, depth)


def _matrix(cells: pd.DataFrame) -> np.ndarray:
    return cells[FEATURES].fillna(MISSING).to_numpy(np.int64)


def boost(rows: np.ndarray, label: np.ndarray, weight: np.ndarray, n_trees: int, depth: int) -> Booster:
    slots = 2 ** (depth + 1) - 1
    shape = (n_trees, slots)
    model = Booster(
        BASE, depth, np.full(shape, -1, np.int32), np.zeros(shape, np.int32), np.zeros(shape), np.zeros(shape)
    )
    margin = np.full(len(rows), BASE)
    for tree in range(n_trees):
        chance = 1 / (1 + np.exp(-margin))
        pull = np.floor((chance - label) * UNIT + 0.5).astype(np.int64) * weight
        curve = np.floor(chance * (1 - chance) * UNIT + 0.5).astype(np.int64) * weight
        slot = _grow(model, tree, rows, pull, curve)
        margin += model.value[tree][slot]
    return model


def _grow(model: Booster, tree: int, rows: np.ndarray, pull: np.ndarray, curve: np.ndarray) -> np.ndarray:
    """Grows one tree level by level; the slot of the leaf that each row ends in."""
    slot = np.zeros(len(rows), dtype=np.int64)
    for level in range(model.depth):
        first, width = 2**level - 1, 2**level
        inside = slot >= first
        if not inside.any():
            break
        found = _best_splits(rows[inside], slot[inside] - first, width, pull[inside], curve[inside])
        for node, (gain, feature, value) in enumerate(found):
            if feature >= 0:
                model.feature[tree, first + node], model.threshold[tree, first + node] = feature, value
                model.gain[tree, first + node] = gain
        split = model.feature[tree][slot]
        left = rows[np.arange(len(rows)), split] <= model.threshold[tree][slot]
        slot = np.where(inside & (split >= 0), 2 * slot + np.where(left, 1, 2), slot)
    sums = np.zeros((2, len(model.value[tree])), dtype=np.int64)
    np.add.at(sums[0], slot, pull)
    np.add.at(sums[1], slot, curve)
    leaf = np.unique(slot)
    model.value[tree, leaf] = -(sums[0, leaf] / UNIT) / (sums[1, leaf] / UNIT + RIDGE) * RATE
    return slot


def _worth(pull: np.ndarray, curve: np.ndarray) -> np.ndarray:
    pull, curve = pull / UNIT, curve / UNIT
    return pull * pull / (curve + RIDGE)


def _best_splits(rows, node, width, pull, curve) -> list[tuple[float, int, int]]:
    """(gain, feature, value) of each node of a level; feature -1 where no split is worth it."""
    best = [(LEAST_GAIN, -1, 0)] * width
    for feature in range(rows.shape[1]):
        values, place = np.unique(rows[:, feature], return_inverse=True)
        held = np.zeros((3, width, len(values)), dtype=np.int64)
        for total, of in zip(held, (pull, curve, np.ones_like(pull)), strict=True):
            np.add.at(total, (node, place), of)
        left = held.cumsum(axis=2)
        whole, right = left[:, :, -1:], left[:, :, -1:] - left
        gain = _worth(left[0], left[1]) + _worth(right[0], right[1]) - _worth(whole[0], whole[1])
        enough = (left[1] >= LEAST_CURVATURE * UNIT) & (right[1] >= LEAST_CURVATURE * UNIT)
        # A value that no row of the node has splits like the one before it.
        gain = np.where(enough & (held[2] > 0), gain, -np.inf)
        at = gain.argmax(axis=1)
        for i in range(width):
            if gain[i, at[i]] > best[i][0]:
                best[i] = (float(gain[i, at[i]]), feature, int(values[at[i]]))
    return best


def predict(model: Booster, df: DataFrame) -> DataFrame:
    """Adds the predicted label and the probability of a spike (M3).

    Only the six features travel to Python, where each combination of a batch
    walks the trees once.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def chance(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            rows = np.column_stack([c.fillna(MISSING).to_numpy(np.int64) for c in columns])
            each, place = np.unique(rows, axis=0, return_inverse=True)
            yield pd.Series((1 / (1 + np.exp(-shared.value.margins(each))))[place.ravel()])

    scored = df.withColumn("spike_probability", chance(*[F.col(c) for c in FEATURES]))
    predicted = (F.col("spike_probability") > 0.5).cast("int").alias("predicted")
    return scored.select(*df.columns, predicted, "spike_probability")


@dataclass(frozen=True)
class Evaluation:
    """A fitted predictor with its weighted counts and test predictions."""

    model: Booster
    counts: DataFrame
    test: DataFrame


def train_and_evaluate(features: DataFrame, key: str, n_trees: int = N_TREES, depth: int = DEPTH) -> Evaluation:
    counts = stage(weighted_counts(features, key), "spike-counts")
    model = fit(counts.filter(~F.col("is_test")), n_trees, depth)
    return Evaluation(model, counts, predict(model, counts.filter("is_test")))


# ---- reports --------------------------------------------------------------


def confusion(test: DataFrame) -> DataFrame:
    return metrics.confusion(test, LABEL, "predicted", "weight")


def class_report(test: DataFrame) -> DataFrame:
    return metrics.class_report(test, LABEL, "predicted", "weight")


def scorecard(evaluation: Evaluation) -> DataFrame:
    """One row: sizes, class shares, accuracy and ROC-AUC (M5, M6, M9)."""
    weight, label = F.col("weight"), F.col(LABEL)
    balance = evaluation.counts.agg(
        *[
            expression.alias(f"{side}_{name}")
            for side, wanted in (("train", ~F.col("is_test")), ("test", F.col("is_test")))
            for name, expression in (
                ("rows", F.sum(F.when(wanted, weight)).cast("long")),
                ("positive_rate", F.sum(F.when(wanted, weight) * label) / F.sum(F.when(wanted, weight))),
            )
        ]
    )
    right = evaluation.test.agg(metrics.accuracy(LABEL, "predicted", "weight").alias("accuracy"))
    auc = metrics.roc_auc(evaluation.test, "spike_probability", LABEL, "weight")
    # Three frames of one row each.
    card = balance.join(right, F.lit(True)).join(auc, F.lit(True))
    return card.select(
        "*", F.lit(evaluation.model.trees).alias("trees"), F.lit(evaluation.model.depth).alias("depth")
    )


def importances(evaluation: Evaluation) -> DataFrame:
    """Features by their mean gain per split, as shares of one, the highest first (M8)."""
    model = evaluation.model
    means = [float(model.gain[model.feature == i].mean()) if (model.feature == i).any() else 0.0 for i in range(len(FEATURES))]
    total = sum(means) or 1.0
    pairs = sorted(((name, mean / total) for name, mean in zip(FEATURES, means)), key=lambda p: (-p[1], p[0]))
    return evaluation.counts.sparkSession.createDataFrame(pairs, "feature string, importance double")
