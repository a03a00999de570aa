"""Running counts and quantiles per group against plain sorting."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import ranks as R


def drawn(seed):
    draw = random.Random(seed)
    groups = ["hot"] * 400 + [draw.choice(["a", "b", None]) for _ in range(60)] + ["single"]
    return [(g, "x" if g == "a" else None, draw.choice([None, round(draw.random(), 1), draw.random(), -3.0])) for g in groups]


def counted(spark, rows, parts):
    frame = spark.createDataFrame(rows, "g string, h string, v double").repartition(parts)
    return frame.groupBy("g", "h", "v").agg(F.count("*").alias("n"))


@pytest.mark.parametrize(("seed", "parts"), [(1, 1), (2, 6)])
def test_quantiles_of_every_group(spark, seed, parts):
    rows = drawn(seed)
    found = R.grouped_quantiles(counted(spark, rows, parts), ["g", "h"], "v", "n", {"low": 0.0, "third": 1 / 3, "median": 0.5, "top": 1.0})
    held = {}
    for g, h, v in rows:
        if v is not None:
            held.setdefault((g, h), []).append(v)
    got = {(r.g, r.h): r for r in found.collect()}
    assert set(got) == set(held)
    for key, values in held.items():
        values.sort()
        assert (got[key].low, got[key].top) == (values[0], values[-1])
        assert got[key].median == pytest.approx(statistics.median(values), rel=1e-12)
        at = (len(values) - 1) / 3
        low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
        assert got[key].third == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-9)


def test_running_counts_over_many_ranges(spark):
    rows = [("hot", None, float(i)) for i in range(500)] + [(None, None, 1.0)] * 5
    placed = R.running(counted(spark, rows, 4), ["g", "h"], "v", "n").collect()
    assert {(r.g, r.v): r.before for r in placed} == {**{("hot", float(i)): i for i in range(500)}, (None, 1.0): 0}


def test_no_rows(spark):
    assert R.grouped_quantiles(counted(spark, [("a", None, None)], 1), ["g"], "v", "n", {"m": 0.5}).count() == 0
