"""The joins against a plain left join, on keys that are hot on either side."""

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import estimates, joins as J
from tidewatch.plans import reviews


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame(
        [(i, (7 if i % 3 == 0 else i % 50) if i % 11 else None) for i in range(2000)], "lid long, k int"
    )
    right = spark.createDataFrame(
        [(9 if j % 3 == 0 else j % 60, j % 5) for j in range(1500)] + [(None, 1)], "k int, v int"
    )
    return left, right


def same(a, b):
    b = b.select(a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_salted_join_equals_plain_join(sides, partitions):
    left, right = sides if partitions is None else [s.repartition(partitions) for s in sides]
    assert same(J.salted_left_join(left, right, "k", salts=4, hot_share=0.05), left.join(right, "k", "left"))


def test_both_sides_hot_on_one_key(spark):
    left = spark.createDataFrame([(i, 1 if i % 2 else i) for i in range(400)], "lid long, k long")
    right = spark.createDataFrame([(1 if j % 2 else 1000 + j, j % 2) for j in range(200)], "k long, v int")
    assert same(J.salted_left_join(left, right, "k", salts=3, hot_share=0.1), left.join(right, "k", "left"))


def test_copies_of_one_row_are_scattered(spark):
    left = spark.createDataFrame([(1, "a")] * 400 + [(2, "b")], "k long, t string")
    right = spark.createDataFrame([(1, 5)] * 30 + [(3, 6)], "k long, v int")
    joined = J.salted_left_join(left, right, "k", salts=8, hot_share=0.1)
    assert same(joined, left.join(right, "k", "left"))


def test_small_right_is_broadcast_and_large_is_not(sides, spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    left = spark.range(1000).selectExpr("id % 20 AS k", "id AS lid")
    plan = J.left_join(left, small, "k")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "_salt_left" not in plan
    forced = J.left_join(left, small, "k", small_side_bytes=1)
    assert "_salt_left" in forced._jdf.queryExecution().toString()
    assert same(forced, left.join(small, "k", "left"))


def test_small_left_cuts_the_right_down(spark, tmp_path):
    spark.range(20000).selectExpr("id % 500 AS k", "id AS v").write.parquet(str(tmp_path / "r"))
    right = spark.read.parquet(str(tmp_path / "r"))
    left = spark.range(5).selectExpr("id * 100 + 3 AS k", "id AS lid")
    joined = J.left_join(left, right, "k", small_side_bytes=estimates.plan_bytes(left))
    assert same(joined, left.join(right, "k", "left"))


def test_hot_keys_are_counted(sides, spark):
    left, right = sides
    assert list(J.hot_keys(left, "k", 0.05)) == [7] and list(J.hot_keys(right, "k", 0.05)) == [9]
    assert J.hot_keys(spark.range(5000), "id", 0.01) == {}
    assert J.hot_keys(spark.range(0), "id", 0.01) == {}


def test_salts_follow_the_rows_of_a_key(spark):
    rows = spark.range(1000).selectExpr("CASE WHEN id < 400 THEN 'a' WHEN id < 500 THEN 'b' ELSE string(id) END AS k")
    assert J.hot_keys(rows, "k", 0.05) == {"a": 0.4, "b": 0.1}
    assert dict(J.salts_of(rows, "k", 0.05, 100).collect()) == {"a": 8, "b": 2}
    assert dict(J.salts_of(rows, "k", 0.05, 3).collect()) == {"a": 3, "b": 2}


def test_a_hot_key_ends_in_many_tasks(spark, tmp_path):
    spark.range(8000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS lid").write.parquet(str(tmp_path / "l"))
    spark.range(8000).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / "r"))
    left, right = spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r"))
    joined = J.salted_left_join(left, right, "k", salts=16)
    salted = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt_left" in salted
    assert same(joined, left.join(right, "k", "left"))
    salts = left.withColumn("_position", F.monotonically_increasing_id()).filter("k = 7")
    assert salts.select(F.pmod("_position", F.lit(16))).distinct().count() == 16


def test_keys_of_one_row_are_never_salted(spark):
    names = spark.range(20).selectExpr("id AS k", "string(id) AS name")
    assert J.salts_of(names, "k", 0.01, 16).collect() == []
    twice = names.union(names.where("k = 3"))
    assert dict(J.salts_of(twice, "k", 0.01, 16).collect()) == {3: 2}
    left = spark.range(400).selectExpr("id % 25 AS k", "id AS lid")
    assert same(J.salted_left_join(left, twice, "k"), left.join(twice, "k", "left"))


def test_lines_are_moved_once_for_their_categories(spark, monkeypatch):
    lines = spark.createDataFrame([(str(i % 7), f"p{i % 9}") for i in range(60)], "order_id string, product_id string")
    products = spark.createDataFrame(
        [(f"p{i}", None if i == 2 else f"b{i % 3}") for i in range(8)], "product_id string, product_category_name string"
    )
    names = spark.createDataFrame([("b0", "x"), ("b1", "y")], "product_category_name string, product_category_name_english string")
    lefts = []
    salted = J.salted_left_join
    monkeypatch.setattr(J, "salted_left_join", lambda left, *a, **k: lefts.append(left.columns) or salted(left, *a, **k))
    found = reviews._categories(lines, products, names, -1)
    assert sum("order_id" in columns for columns in lefts) == 1 and len(lefts) == 2
    plain = lines.join(products, "product_id", "left").join(names, "product_category_name", "left").drop("product_id")
    assert same(found, plain)
