"""Isolation forest: planted outliers, determinism, storage, brute-force paths."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions.hashing import drawn_number
from tidewatch.operators import iforest as I


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    cloud = rng.normal(0, 1, (2000, 2))
    outliers = rng.normal(0, 0.3, (20, 2)) + [9, -9]
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(np.vstack([cloud, outliers]))]
    return spark.createDataFrame(rows, "id long, x double, y double")


OPTIONS = {"n_trees": 50, "rows_per_tree": 64}


def test_planted_outliers_are_flagged(points):
    flagged = I.detect(points, ["x", "y"], "id", **OPTIONS).collect()
    assert {r.id for r in flagged if r.is_anomaly} >= set(range(2000, 2020))
    share = sum(r.is_anomaly for r in flagged) / len(flagged)
    assert abs(share - 0.05) <= 1 / len(flagged)
    assert all((r.anomaly_score < 0) == bool(r.is_anomaly) for r in flagged)


def test_same_forest_under_any_partitioning(points):
    a = I.fit(points.repartition(1), ["x", "y"], "id", **OPTIONS)
    b = I.fit(points.repartition(7), ["x", "y"], "id", **OPTIONS)
    assert np.array_equal(a.feature, b.feature)
    assert np.allclose(a.threshold, b.threshold) and np.array_equal(a.path, b.path)


def test_tree_samples_are_drawn_without_replacement(points):
    drawn = I.tree_samples(points, 2020, "id", 50, 64, 1)
    per_tree = drawn.groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).collect()
    assert len(per_tree) == 50 and all(r.n == r.ids == 64 for r in per_tree)


def test_fewer_rows_than_a_tree_takes(spark):
    tiny = spark.createDataFrame([(i, float(i), 1.0) for i in range(5)], "id long, x double, y double")
    forest = I.fit(tiny, ["x", "y"], "id", n_trees=7)
    assert forest.sample_size == 5 and forest.feature.shape[0] == 7
    assert I.detect(tiny, ["x", "y"], "id", n_trees=7).count() == 5


def test_empty_input_is_an_error(spark):
    with pytest.raises(ValueError):
        I.fit(spark.createDataFrame([], "id long, x double"), ["x"], "id")


def test_stored_forest_scores_alike(spark, points, tmp_path):
    forest = I.fit(points, ["x", "y"], "id", **OPTIONS)
    forest.to_frame(spark).write.parquet(str(tmp_path / "forest"))
    again = I.from_frame(spark.read.parquet(str(tmp_path / "forest")))
    rows = np.array([[0.0, 0.0], [9.0, -9.0]])
    assert np.array_equal(I.path_lengths(vars(forest), rows), I.path_lengths(vars(again), rows))


def test_path_lengths_equal_a_walk_of_each_tree(points):
    forest = I.fit(points, ["x", "y"], "id", n_trees=8, rows_per_tree=32)
    rows = np.random.default_rng(0).normal(0, 3, (40, 2))

    def walk(tree, row):
        slot, inner = 0, forest.feature.shape[1]
        while slot < inner:
            scaled = (row - np.array(forest.means)) / np.array(forest.scales)
            slot = 2 * slot + (2 if scaled[forest.feature[tree, slot]] > forest.threshold[tree, slot] else 1)
        return forest.path[tree, slot - inner]

    wanted = [sum(int(walk(t, row)) for t in range(8)) for row in rows]
    assert I.path_lengths(vars(forest), rows).tolist() == wanted


def test_mean_path_values():
    assert I.mean_path(1) == 0 and I.mean_path(2) == 1
    assert I.mean_path(256) == pytest.approx(2 * (np.log(255) + np.euler_gamma) - 2 * 255 / 256)


def test_a_missing_feature_gives_no_score(spark, points):
    forest = I.fit(points, ["x", "y"], "id", **OPTIONS)
    rows = spark.createDataFrame([(0.0, 0.0), (None, 0.0), (float("nan"), 1.0)], "x double, y double")
    scored = rows.select(I.score_column(spark, forest).alias("raw_score"))
    assert [r.raw_score is None for r in scored.collect()] == [False, True, True]
    assert [r.is_anomaly for r in I.flag_anomalies(scored, "raw_score", offset=0.5).collect()] == [1, 0, 0]


def test_a_tree_is_a_function_of_its_rows(points):
    """Slot by slot: the drawn feature and cut lie where the draws for (tree, slot) put them."""
    forest = I.fit(points, ["x", "y"], "id", n_trees=3, rows_per_tree=16)
    drawn = I.standardised(I.tree_samples(points, 2020, "id", 3, 16, I.SEED), ["x", "y"], forest.means, forest.scales)
    rows = {t: np.array([(r.x, r.y) for r in drawn.collect() if r.tree == t]) for t in range(3)}
    for tree, held in rows.items():
        low, high = held.min(axis=0), held.max(axis=0)
        chosen = drawn_number(I.SEED, "feature", tree * I._SLOTS) * 2 >> 31
        cut = low[chosen] + (high[chosen] - low[chosen]) * drawn_number(I.SEED, "cut", tree * I._SLOTS) / 2**31
        assert forest.feature[tree, 0] == chosen and forest.threshold[tree, 0] == pytest.approx(cut, rel=1e-12)
