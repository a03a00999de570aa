"""Classifier figures against plain counting."""

import random

import pytest

from tidewatch.operators import metrics as M


def pairwise(rows):
    won = total = 0
    for s, y, w in rows:
        for t, z, v in rows:
            if s is not None and t is not None and (y, z) == (1, 0):
                total += w * v
                won += w * v * ((s > t) + 0.5 * (s == t))
    return won / total if total else None


def auc(spark, rows, parts=5):
    frame = spark.createDataFrame(rows, "score double, label int, weight long").repartition(parts)
    return M.roc_auc(frame, "score", "label", "weight").first().roc_auc


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_with_ties_weights_and_a_hot_score(spark, seed):
    draw = random.Random(seed)
    rows = [(draw.choice([0.5, 0.5, draw.random(), round(draw.random(), 1), None, -0.0, 0.0]), draw.randint(0, 1), draw.randint(1, 5)) for _ in range(300)]
    assert auc(spark, rows) == pytest.approx(pairwise(rows), rel=1e-12)
    assert auc(spark, rows, 1) == auc(spark, rows, 9)


def test_auc_of_many_rows_stays_exact(spark):
    huge = 3 * 10**12
    assert auc(spark, [(0.1, 0, huge), (0.9, 1, huge), (0.9, 0, huge)]) == 0.75


def test_auc_of_one_class_or_no_rows(spark):
    assert auc(spark, [(0.3, 1, 1), (0.4, 1, 2)]) is None and auc(spark, []) is None


def test_report_of_a_class_that_is_never_predicted(spark):
    frame = spark.createDataFrame([(0, 0, 3), (1, 0, 1)], "label int, predicted int, weight long")
    report = {r["class"]: r for r in M.class_report(frame, "label", "predicted", "weight").collect()}
    assert (report["High CPU"].precision, report["High CPU"].recall, report["High CPU"].f1) == (0, 0, 0)
    assert (report["Normal CPU"].precision, report["Normal CPU"].recall) == (0.75, 1.0)
    assert report["weighted avg"].recall == 0.75 and report["macro avg"].support == 4
    empty = M.class_report(frame.limit(0), "label", "predicted", "weight").collect()
    assert {r.support for r in empty} == {0} and {r.f1 for r in empty} == {0.0}
