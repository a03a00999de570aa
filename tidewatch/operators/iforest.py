"""Isolation forest (M10-M13): MLlib has none.

Spark draws the rows of each tree, fits the trees in parallel and scores all
rows; what crosses the driver is the model itself, whose size is set by the
number of trees and the rows per tree, not by the data.

Trees are grown from draws by (tree, slot), so that a tree is a function of its
rows alone. Path lengths are whole numbers of ``PATH_UNIT``: their sums are
exact, and rows that take equal paths have equal scores on any engine. A row
with a missing feature has no score and no flag.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.functions.hashing import BITS, draw, drawn_number, whole_key
from tidewatch.operators.estimates import spread
from tidewatch.operators.selection import exact_quantile, sample_exact
from tidewatch.session import stage

# Fixed values of the detector.
N_TREES = 200
ROWS_PER_TREE = 256
CONTAMINATION = 0.05
SEED = 42

PATH_UNIT = 1e-9

_NODES = "tree int, slot int, feature int, threshold double, path long"
_SLOTS = 1 << 20  # numbers of slots that draws keep apart within a tree
_SCORING_ROWS = 256
_ROUND_STEP = 1_000_003_000_019


@dataclass(frozen=True)
class Forest:
    """Trees as complete binary heaps: slot i has the children 2i+1 and 2i+2.

    A leaf above the lowest level sends every row left, down to a slot of the
    lowest level that holds its path length.
    """

    features: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    sample_size: int
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    path: np.ndarray

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The model as a table, one row per node, to be saved as Parquet."""
        trees, inner = self.feature.shape
        lowest = self.path.shape[1]
        pdf = pd.DataFrame(
            {
                "tree": np.repeat(np.arange(trees), inner + lowest),
                "slot": np.tile(np.arange(inner + lowest), trees),
                "feature": np.hstack([self.feature, np.full((trees, lowest), -1)]).ravel(),
                "threshold": np.hstack([self.threshold, np.zeros((trees, lowest))]).ravel(),
                "path": np.hstack([np.zeros((trees, inner), dtype="int64"), self.path]).ravel(),
            }
        )
        meta = F.struct(
            F.array(*map(F.lit, self.features)).alias("features"),
            F.array(*map(F.lit, self.means)).alias("means"),
            F.array(*map(F.lit, self.scales)).alias("scales"),
            F.lit(self.sample_size).alias("sample_size"),
        )
        return spark.createDataFrame(pdf, _NODES).withColumn("meta", meta)


def from_frame(nodes: DataFrame) -> Forest:
    """The model of a table written by ``Forest.to_frame``."""
    meta = nodes.select("meta.*").first()
    return _forest(nodes.drop("meta"), meta.features, meta.means, meta.scales, meta.sample_size)


def mean_path(n):
    """Expected depth of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype="float64")
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


# ---- fit ------------------------------------------------------------------


def fit(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    n_trees: int = N_TREES,
    rows_per_tree: int = ROWS_PER_TREE,
    seed: int = SEED,
) -> Forest:
    """Fit a forest on a frame with a unique key."""
    data = df.select(key, *[F.col(c).cast("double").alias(c) for c in features])
    n, means, scales = moments(data, features)
    if not n:
        raise ValueError("cannot fit a forest on an empty frame")
    sample_size = min(rows_per_tree, n)

    drawn = tree_samples(data, n, key, n_trees, sample_size, seed)
    scaled = standardised(drawn, features, means, scales).select("tree", "place", *features)
    grow = _grower(list(features), _depth(sample_size), seed)
    # A fixed number of partitions, or the few small rows would all land in one task.
    tasks = min(n_trees, df.sparkSession.sparkContext.defaultParallelism)
    nodes = scaled.repartition(tasks, "tree").groupBy("tree").applyInPandas(grow, _NODES)
    return _forest(nodes, features, means, scales, sample_size)


def moments(df: DataFrame, features: Sequence[str]) -> tuple[int, list[float], list[float]]:
    """Rows, means and population standard deviations in one pass; a constant column scales by 1."""
    row = df.agg(
        F.count("*").alias("n"),
        *[F.avg(c).alias(f"mean_{c}") for c in features],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in features],
    ).first()
    return row.n, [row[f"mean_{c}"] for c in features], [row[f"std_{c}"] or 1.0 for c in features]


def standardised(
    df: DataFrame, features: Sequence[str], means: Sequence[float], scales: Sequence[float]
) -> DataFrame:
    """Features with mean 0 and population variance 1."""
    return df.withColumns(
        {c: (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(features, means, scales)}
    )


def tree_samples(
    df: DataFrame, n: int, key: str, n_trees: int, sample_size: int, seed: int
) -> DataFrame:
    """The rows of every tree, drawn without replacement, with ``tree`` and ``place``.

    One shuffled order of the rows is cut into runs of ``sample_size``, one
    for each tree. If it is too short for all trees, further orders follow.
    So the trees take ``n_trees * sample_size`` rows in all, and no row is
    offered to every tree.
    """
    wanted = n_trees * sample_size
    pool = sample_exact(df, wanted, key, seed) if n > wanted else df
    trees_per_round = max(1, min(n, wanted) // sample_size)
    rounds = math.ceil(n_trees / trees_per_round)
    offered = pool.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    # Each order draws from keys moved far apart, so that the orders differ.
    shuffled = draw(seed, "order", whole_key(offered, key) + F.col("round").cast("long") * _ROUND_STEP)
    order = Window.partitionBy("round").orderBy(shuffled, key)
    placed = offered.withColumn("at", F.row_number().over(order) - 1)
    return (
        placed.filter(F.col("at") < trees_per_round * sample_size)
        .withColumn("tree", (F.col("round") * trees_per_round + F.floor(F.col("at") / sample_size)).cast("int"))
        .withColumn("place", (F.col("at") % sample_size).cast("int"))
        .filter(F.col("tree") < n_trees)
        .drop("round", "at")
    )


def _depth(sample_size: int) -> int:
    return max(1, math.ceil(math.log2(max(sample_size, 2))))


def path_units(level: int, n: int) -> int:
    """The path length of a leaf with n rows, as a whole number."""
    return math.floor((level + float(mean_path(n))) / PATH_UNIT + 0.5)


def _grower(features: list[str], depth: int, seed: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rows = pdf.sort_values("place")[features].to_numpy("float64")
        inner = 2**depth - 1
        feature = np.zeros(2 * inner + 1, dtype="int32")
        threshold = np.full(2 * inner + 1, np.inf)
        path = np.zeros(2 * inner + 1, dtype="int64")
        todo = [(0, 0, rows)]
        while todo:
            slot, level, part = todo.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            usable = np.flatnonzero(high > low)
            if level == depth or not len(usable):
                length = path_units(level, len(part))
                for _ in range(level, depth):
                    slot = 2 * slot + 1
                path[slot] = length
                continue
            node = tree * _SLOTS + slot
            chosen = usable[drawn_number(seed, "feature", node) * len(usable) >> BITS]
            cut = low[chosen] + (high[chosen] - low[chosen]) * (drawn_number(seed, "cut", node) / 2.0**BITS)
            feature[slot], threshold[slot] = chosen, cut
            left = part[:, chosen] <= cut
            todo.append((2 * slot + 1, level + 1, part[left]))
            todo.append((2 * slot + 2, level + 1, part[~left]))
        return pd.DataFrame(
            {
                "tree": tree,
                "slot": np.arange(len(path)),
                "feature": feature,
                "threshold": threshold,
                "path": path,
            }
        )

    return grow


def _forest(nodes: DataFrame, features, means, scales, sample_size: int) -> Forest:
    # Trees * 2 * rows per tree nodes at most, whatever the data.
    pdf = nodes.toPandas().sort_values(["tree", "slot"])
    trees = pdf["tree"].nunique()
    slots = len(pdf) // trees
    inner = slots // 2

    def grid(column: str) -> np.ndarray:
        return pdf[column].to_numpy().reshape(trees, slots)

    return Forest(
        features=tuple(features),
        means=tuple(means),
        scales=tuple(scales),
        sample_size=sample_size,
        depth=(inner + 1).bit_length() - 1,
        feature=grid("feature")[:, :inner].astype("int32"),
        threshold=grid("threshold")[:, :inner],
        path=grid("path")[:, inner:].astype("int64"),
    )


# ---- score ----------------------------------------------------------------


def path_lengths(model: Mapping, rows: np.ndarray) -> np.ndarray:
    """The sum of each row's path lengths over the trees of a model, given as its fields, in ``PATH_UNIT``.

    All trees are walked together, one level at a time, for as many rows as
    keep the arrays (trees x rows) in the processor's cache.
    """
    trees, inner = model["feature"].shape
    slots = 2 * inner + 1
    feature = np.zeros((trees, slots), dtype="intp")
    threshold, path = np.zeros((trees, slots)), np.zeros((trees, slots), dtype="int64")
    feature[:, :inner], threshold[:, :inner] = model["feature"], model["threshold"]
    path[:, inner:] = model["path"]
    feature, threshold, path = feature.ravel(), threshold.ravel(), path.ravel()
    root = (np.arange(trees) * slots)[:, None]

    scaled = ((rows - np.asarray(model["means"])) / np.asarray(model["scales"])).T
    out = np.empty(len(rows), dtype="int64")
    for start in range(0, len(rows), _SCORING_ROWS):
        part = scaled[:, start : start + _SCORING_ROWS]
        width = part.shape[1]
        values, column = part.ravel(), np.arange(width)
        at = np.repeat(root, width, axis=1)
        place = np.empty_like(at)
        value, cut = np.empty(at.shape), np.empty(at.shape)
        right = np.empty(at.shape, dtype=bool)
        for _ in range(model["depth"]):
            feature.take(at, out=place, mode="clip")
            place *= width
            place += column
            values.take(place, out=value, mode="clip")
            threshold.take(at, out=cut, mode="clip")
            np.greater(value, cut, out=right)
            # The children of slot i are 2i+1 and 2i+2, counted from the root of its tree.
            at += at
            at += 1 - root
            at += right
        out[start : start + width] = path.take(at).sum(axis=0)
    return out


def score_column(spark: SparkSession, forest: Forest) -> Column:
    """Raw score of a row, in [-1, 0): the lower, the more isolated (M12); NULL if a feature is.

    Only the feature columns travel to Python; the rest of the row stays.
    """
    shared = spark.sparkContext.broadcast(vars(forest))
    norm = len(forest.path) / PATH_UNIT * (float(mean_path(forest.sample_size)) or 1.0)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = shared.value
        for columns in batches:
            rows = np.column_stack([c.to_numpy("float64") for c in columns])
            raw = -np.exp2(-path_lengths(model, rows) / norm)
            yield pd.Series(raw).mask(np.isnan(rows).any(axis=1))

    return score(*[F.col(c).cast("double") for c in forest.features])


def flag_anomalies(
    scored: DataFrame, raw_score: str, contamination: float = CONTAMINATION, offset: float | None = None
) -> DataFrame:
    """Adds ``anomaly_score`` and ``is_anomaly`` (M13) in place of the raw score.

    The offset is the contamination quantile of the raw scores, or the stored
    one of an earlier fit. ``scored`` should be stored: the quantile reads it.
    """
    if offset is None:
        offset = exact_quantile(scored, raw_score, contamination)
    decision = F.col(raw_score) - F.lit(offset).cast("double")
    return (
        scored.withColumn("anomaly_score", decision)
        .withColumn("is_anomaly", F.when(F.col("anomaly_score") < 0, 1).otherwise(0).cast("int"))
        .drop(raw_score)
    )


def detect(df: DataFrame, features: Sequence[str], key: str, **fit_options) -> DataFrame:
    """Fit on a frame and flag its own rows."""
    forest = fit(df, features, key, **fit_options)
    scored = stage(spread(df).withColumn("raw_score", score_column(df.sparkSession, forest)), "scored")
    return flag_anomalies(scored, "raw_score")
