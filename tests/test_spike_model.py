"""Predictor: weighted training, and a scorecard that agrees with itself."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import spike_model as M
from tidewatch.plans import logs
from tidewatch.sources.synthetic import synthetic_logs


@pytest.fixture(scope="module")
def evaluation(spark):
    features = logs.predictor_features(synthetic_logs(spark, 4000))
    return M.train_and_evaluate(features, "log_id", n_trees=5)


def test_counts_cover_every_row(evaluation):
    sums = {r.is_test: r.n for r in evaluation.counts.groupBy("is_test").agg(F.sum("weight").alias("n")).collect()}
    assert sums[True] + sums[False] == 4000
    assert abs(sums[True] - 800) <= 1


def test_scorecard_agrees_with_the_confusion_matrix(evaluation):
    card = M.scorecard(evaluation).first()
    cells = {r.actual: (r.predicted_normal, r.predicted_high) for r in M.confusion(evaluation.test).collect()}
    assert sum(map(sum, cells.values())) == card.test_rows
    assert card.accuracy == pytest.approx((cells[0][0] + cells[1][1]) / card.test_rows)
    assert card.trees == 5 and card.depth == 5 and 0 <= card.roc_auc <= 1
    assert card.train_positive_rate == pytest.approx(card.test_positive_rate, abs=0.001)


def test_class_report_agrees_with_the_confusion_matrix(evaluation):
    cells = {r.actual: (r.predicted_normal, r.predicted_high) for r in M.confusion(evaluation.test).collect()}
    report = {r["class"]: r for r in M.class_report(evaluation.test).collect()}
    assert report["High CPU"].recall == pytest.approx(cells[1][1] / sum(cells[1]))
    assert report["High CPU"].precision == pytest.approx(cells[1][1] / (cells[0][1] + cells[1][1]))
    assert report["macro avg"].support == report["weighted avg"].support == sum(map(sum, cells.values()))
    assert report["macro avg"].recall == pytest.approx((report["High CPU"].recall + report["Normal CPU"].recall) / 2)


def test_auc_equals_pairwise_counting(evaluation):
    rows = evaluation.test.select("spike_probability", M.LABEL, "weight").collect()
    wins = total = 0.0
    for a in rows:
        for b in rows:
            if a[M.LABEL] == 1 and b[M.LABEL] == 0:
                pairs = a.weight * b.weight
                total += pairs
                wins += pairs * ((a.spike_probability > b.spike_probability) + 0.5 * (a.spike_probability == b.spike_probability))
    assert M.scorecard(evaluation).first().roc_auc == pytest.approx(wins / total, abs=1e-9)


def test_importances_are_sorted_and_sum_to_one(evaluation):
    rows = M.importances(evaluation).collect()
    values = [r.importance for r in rows]
    assert {r.feature for r in rows} == set(M.FEATURES)
    assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1)


def test_planted_rule_is_learned(spark):
    rows = [(i, i % 24, i % 7, int(18 <= i % 24 <= 22), int(i % 5 == 0), i % 4, i % 5, int(18 <= i % 24 <= 22)) for i in range(2000)]
    features = spark.createDataFrame(rows, "log_id long, " + ", ".join(f"{c} int" for c in [*M.FEATURES, M.LABEL]))
    card = M.scorecard(M.train_and_evaluate(features, "log_id", n_trees=3)).first()
    assert card.accuracy == 1.0 and card.roc_auc == 1.0


def test_trees_equal_a_plain_search_of_all_splits():
    """Node by node, with whole gradients: the split of most gain, ties to the first feature and value."""
    draw = np.random.default_rng(4)
    rows = np.column_stack([draw.integers(-1, n, 300) for n in (24, 7, 2, 2, 4, 5)])
    rows[:, 3] = rows[:, 2]  # equal splits
    label, weight = (rows[:, 0] > 15).astype(int) ^ (draw.random(300) < 0.1), draw.integers(1, 9, 300)
    model = M.boost(rows, label, weight, 4, 3)
    margin = [0.0] * 300

    def worth(g, h):
        return (g / M.UNIT) * (g / M.UNIT) / (h / M.UNIT + 1.0)

    for tree in range(4):
        chance = [1 / (1 + math.exp(-m)) for m in margin]
        pull = [math.floor((p - y) * M.UNIT + 0.5) * int(w) for p, y, w in zip(chance, label, weight)]
        curve = [math.floor(p * (1 - p) * M.UNIT + 0.5) * int(w) for p, w in zip(chance, weight)]
        todo = [(0, 0, list(range(300)))]
        while todo:
            slot, level, held = todo.pop()
            g, h = sum(pull[i] for i in held), sum(curve[i] for i in held)
            best = (1e-6, -1, 0)
            for feature in range(6) if level < 3 else ():
                for value in sorted({int(rows[i, feature]) for i in held}):
                    left = [i for i in held if rows[i, feature] <= value]
                    lg, lh = sum(pull[i] for i in left), sum(curve[i] for i in left)
                    gain = worth(lg, lh) + worth(g - lg, h - lh) - worth(g, h)
                    if lh >= M.UNIT and h - lh >= M.UNIT and gain > best[0]:
                        best = (gain, feature, value)
            assert model.feature[tree, slot] == best[1]
            if best[1] < 0:
                value = -(g / M.UNIT) / (h / M.UNIT + 1.0) * 0.05
                assert model.value[tree, slot] == pytest.approx(value, rel=1e-12)
                for i in held:
                    margin[i] += value
                continue
            assert (model.threshold[tree, slot], model.gain[tree, slot]) == (best[2], pytest.approx(best[0]))
            todo.append((2 * slot + 1, level + 1, [i for i in held if rows[i, best[1]] <= best[2]]))
            todo.append((2 * slot + 2, level + 1, [i for i in held if rows[i, best[1]] > best[2]]))
    assert np.allclose(model.margins(rows), margin, rtol=1e-12)


def test_same_trees_under_any_partitioning_and_order(spark):
    rows = logs.predictor_features(synthetic_logs(spark, 3000))
    one, two = (M.fit(M.weighted_counts(rows.repartition(n), "log_id").orderBy(o), 10) for n, o in ((1, "weight"), (5, "tbl_code")))
    assert np.array_equal(one.feature, two.feature) and np.array_equal(one.value, two.value)


def test_missing_features_and_a_single_class(spark):
    schema = ", ".join(f"{c} int" for c in [*M.FEATURES, M.LABEL]) + ", weight long"
    rows = [(None, 1, 0, 0, None, 2, 1, 5), (3, 1, 0, 0, 1, 2, 1, 7), (3, 1, 0, 0, 1, 2, None, 9)]
    counts = spark.createDataFrame(rows, schema)
    model = M.fit(counts, 3)
    assert all(r.predicted == 1 and r.spike_probability > 0.5 for r in M.predict(model, counts).collect())
    assert M.fit(counts.limit(0), 3).margins(np.zeros((2, 6), dtype=int)).tolist() == [0.0, 0.0]
