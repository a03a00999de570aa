"""Recall of the index at its own parameters, on vectors without clusters."""

import numpy as np
import pytest

from tidewatch.llm import inverted_multi_index


@pytest.mark.parametrize("spread", [None, 0.1])
def test_recall_on_tables_above_two_thousand(spark, spread):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(8000, 32))
    if spread:
        x = draw.normal(size=(100, 32))[np.arange(8000) % 100] + spread * x
    x = x.astype(np.float32)
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    found = {}
    for r in inverted_multi_index.neighbours(table).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    scores = x[::20].astype(np.float64) @ x.astype(np.float64).T
    scores[np.arange(400), np.arange(400) * 20] = -np.inf
    hits = sum(len(found[20 * i] & set(np.argpartition(-row, 20)[:20].tolist())) for i, row in enumerate(scores))
    print("recall", spread, hits / 8000)
    assert hits / 8000 >= 0.9
