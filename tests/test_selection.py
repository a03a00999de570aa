"""Samples, splits and quantiles against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions.hashing import PRIME, coefficients, draw, pick
from tidewatch.operators import selection as X


def rank(key, seed=42):
    factor, *powers = coefficients(seed, "rank")
    x = ((key >> 31) % PRIME * factor + key % 2**31) % PRIME
    return sum(c * x**i for i, c in enumerate(reversed(powers))) % PRIME


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(5000).withColumn("y", (F.col("id") % 7 == 0).cast("int"))


def test_sample_is_the_lowest_hashes(rows):
    wanted = sorted(range(5000), key=lambda i: (rank(i), i))[:500]
    assert {r.id for r in X.sample_exact(rows, 500, "id").collect()} == set(wanted)


@pytest.mark.parametrize("n", [0, 1, 4999, 5000, 9000])
def test_sample_sizes(rows, n):
    assert X.sample_exact(rows, n, "id").count() == min(n, 5000)


def test_sample_does_not_depend_on_partitions(rows):
    a, b = X.sample_exact(rows.repartition(1), 300, "id"), X.sample_exact(rows.repartition(7), 300, "id")
    assert a.exceptAll(b).isEmpty()
    assert not a.exceptAll(X.sample_exact(rows, 300, "id", seed=1)).isEmpty()


def test_index_runs_from_zero_in_drawing_order(rows):
    sample = X.indexed(X.sample_exact(rows, 50, "id"), "id").orderBy("row_idx").collect()
    assert [r.row_idx for r in sample] == list(range(50))
    assert [r.id for r in sample] == sorted((r.id for r in sample), key=lambda i: (rank(i), i))


def test_split_is_exact_per_label(rows):
    split = X.split_stratified(rows, "y", "id").collect()
    for label in (0, 1):
        members = [r for r in split if r.y == label]
        wanted = sorted((r.id for r in members), key=lambda i: (rank(i), i))[: round(0.2 * len(members))]
        assert {r.id for r in members if r.is_test} == set(wanted)


@pytest.mark.parametrize("q", [0.0, 0.05, 0.25, 0.5, 0.777, 1.0])
def test_quantile_equals_numpy(spark, q):
    rng = random.Random(7)
    shapes = {
        "spread": [rng.gauss(0, 1) for _ in range(1001)],
        "ties": [float(rng.randrange(3)) for _ in range(1001)],
        "outlier": [rng.random() for _ in range(999)] + [1e12, -1e12],
        "one": [4.5],
        "close": [1.0 + k * 2**-52 for k in range(50)] + [1e300],
    }
    for name, values in shapes.items():
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        assert X.exact_quantile(df, "v", q) == pytest.approx(np.quantile(values, q), rel=1e-12), name


def test_quantile_of_nothing(spark):
    assert X.exact_quantile(spark.createDataFrame([(None,)], "v double"), "v", 0.5) is None


def test_draws_are_uniform_and_independent(spark):
    keys = spark.range(100_000).union(spark.range(2**40, 2**40 + 100_000))
    drawn = keys.select(pick(draw(1, "a", F.col("id")), 10).alias("a"), pick(draw(1, "b", F.col("id")), 10).alias("b"))
    cells = drawn.groupBy("a", "b").count().collect()
    assert len(cells) == 100 and all(1800 < c["count"] < 2200 for c in cells)


def test_draws_of_large_keys(spark):
    keys = [0, 5, 2**31 - 1, 2**31, 2**31 + 5, 2**40 + 123, 2**62 - 1]
    df = spark.createDataFrame([(k,) for k in keys], "id long")
    found = {r.id: r.r for r in df.select("id", draw(42, "rank", F.col("id")).alias("r")).collect()}
    assert found == {k: rank(k) for k in keys}


def test_text_keys(spark):
    rows = spark.range(3000).select(F.concat(F.lit("r"), "id").alias("k"))
    a, b = X.sample_exact(rows.repartition(5), 700, "k"), X.sample_exact(rows, 700, "k")
    assert a.count() == 700 and a.exceptAll(b).isEmpty()


def test_repeated_keys_give_exact_samples(spark):
    rows = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    for n in (7, 25, 40, 333):
        drawn = X.sample_exact(rows.repartition(5), n, "k")
        assert drawn.count() == n and drawn.exceptAll(X.sample_exact(rows, n, "k")).isEmpty()
    copies = rows.select("k")
    assert X.sample_exact(copies, 33, "k").count() == 33
    split = X.split_stratified(rows.withColumn("y", F.col("k") % 2), "y", "k")
    assert split.filter("is_test").count() == 200 and split.count() == 1000


def test_numbers_are_gapless_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(X, "_RANGE_ROWS", 10)
    rows = spark.range(2000).select((F.col("id") % 700).alias("k"), F.col("id").alias("v"))
    found = X.indexed(rows, "k")
    assert sorted(r.row_idx for r in found.collect()) == list(range(2000))
    assert found.exceptAll(X.indexed(rows.repartition(7), "k")).isEmpty()
    ranks = [(rank(r.k), r.k) for r in found.orderBy("row_idx").collect()]
    assert ranks == sorted(ranks)


def test_quantile_leaves_out_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (None,)], "v double")
    assert X.exact_quantile(df, "v", 0.5) == 2.0


@pytest.mark.parametrize("most", [1, 100_000])
def test_a_hot_key_is_cut_by_content(spark, monkeypatch, most):
    """A third of the rows share a key; ranges of one row at most take every digit on its own."""
    monkeypatch.setattr(X, "_RANGE_ROWS", most)
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    before = sum(rank(k) < rank(7) for k in range(1000, 3000))
    for n in (before, before + 1, before + 400, before + 1000, before + 1001):
        drawn = X.sample_exact(rows.repartition(5), n, "k")
        assert drawn.count() == n and drawn.filter("k = 7").count() == min(1000, n - before)
        order = rows.withColumn("h", F.xxhash64("k", "v", F.lit(0))).filter("k = 7").collect()
        wanted = sorted(order, key=lambda r: r.h % 2**64)[: n - before]
        assert {r.v for r in drawn.filter("k = 7").collect()} == {r.v for r in wanted}


def test_equal_rows_are_cut_by_their_count(spark, monkeypatch):
    monkeypatch.setattr(X, "_COPIES", 16)
    rows = spark.range(1000).select(F.lit(5).alias("k"), F.lit("same").alias("t"))
    assert X.sample_exact(rows, 333, "k").collect() == [(5, "same")] * 333
    split = X.split_stratified(rows.withColumn("y", F.lit(1)), "y", "k")
    assert split.count() == 1000 and split.filter("is_test").count() == 200


def test_nulls_in_key_and_label(spark):
    rows = spark.range(100).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    assert [X.sample_exact(rows, n, "k").count() for n in (10, 50, 60, 100)] == [10, 50, 60, 100]
    split = X.split_stratified(rows.withColumn("y", F.when(F.col("v") < 50, 1)), "y", "v")
    assert split.count() == 100 and split.filter("is_test").count() == 10


def test_numbering_deals_rows_to_many_tasks(spark):
    """No task gets most of the rows, as their texts travel with them."""
    named = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(named, "false")
    try:
        found = X.indexed(spark.range(20_000).withColumn("text", F.lit("t")), "id")
        held = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set(named, "true")
    assert sum(held) == 20_000 and max(held) < 12_000
