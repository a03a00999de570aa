"""Every check against a frame that passes it and one that fails it."""

import pytest
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.operators import quality as Q
from tidewatch.plans import column_tests, contracts

RAW = ("2024-01-01 18:00:00", "SELECT", "orders", 100, 50.0, "SUCCESS")


def raw(spark, **changes):
    row = dict(zip(S.RAW_LOGS.fieldNames(), RAW)) | changes
    return spark.createDataFrame([row], S.RAW_LOGS)


def clean(spark, **changes):
    row = dict.fromkeys(S.CLEAN_LOGS.fieldNames()) | {"risk_level": "OK", "is_anomaly": 0, "anomaly_score": 0.1}
    return spark.createDataFrame([row | changes], S.CLEAN_LOGS)


def delivery(spark, rows=1, **changes):
    row = dict.fromkeys(S.DELIVERY.fieldNames()) | {
        "order_id": "o0", "customer_state": "SP", "country": "Brazil", "delivery_days": 9.0, "is_late": 0,
    }
    return spark.createDataFrame([(row | changes) | {"order_id": f"o{i}"} for i in range(rows)], S.DELIVERY)


def sentiment(spark, *labels_and_scores):
    rows = [(f"r{i}", "o", score, "t", "d", label) for i, (label, score) in enumerate(labels_and_scores)]
    return spark.createDataFrame(rows, S.SENTIMENT)


def statuses(report):
    return {r.check: r.status for r in report.collect()}


def test_raw_log_checks(spark):
    good = statuses(contracts.raw_logs(raw(spark), expected_rows=1))
    assert [c for c, s in good.items() if s != "PASS"] == ["Timeout rate in [1%, 10%]"]
    assert good["Timeout rate in [1%, 10%]"] == "WARN"
    for change, failing in [
        ({"query_type": None}, {"No nulls in any column", "query_type values valid"}),
        ({"execution_time_ms": 0}, {"execution_time_ms > 0"}),
        ({"server_cpu_load": 100.5}, {"server_cpu_load in [0, 100]"}),
        ({"server_cpu_load": -0.5}, {"server_cpu_load in [0, 100]"}),
        ({"status": "LOST"}, {"status values valid"}),
        ({"query_type": "MERGE"}, {"query_type values valid"}),
        ({"target_table": "users"}, {"target_table values valid"}),
    ]:
        found = statuses(contracts.raw_logs(raw(spark, **change), expected_rows=1))
        assert {c for c, s in found.items() if s == "FAIL"} == failing
    assert statuses(contracts.raw_logs(raw(spark)))["Row count = 15,000"] == "FAIL"


def test_clean_log_checks(spark):
    good = statuses(contracts.clean_logs(clean(spark), raw(spark)))
    assert set(good.values()) == {"PASS"} and len(good) == 5
    for change, failing in [
        ({"risk_level": "HIGH"}, {"risk_level values valid"}),
        ({"risk_level": None}, {"risk_level values valid", "No nulls in risk columns"}),
        ({"is_anomaly": 2}, {"is_anomaly is binary"}),
        # NOT IN lets a NULL flag pass; the NULL check catches it.
        ({"is_anomaly": None}, {"No nulls in risk columns"}),
        ({"anomaly_score": None}, {"No nulls in risk columns"}),
    ]:
        found = statuses(contracts.clean_logs(clean(spark, **change), raw(spark)))
        assert {c for c, s in found.items() if s == "FAIL"} == failing
    assert statuses(contracts.clean_logs(clean(spark, risk_level="CRITICAL"), raw(spark)))["CRITICAL share < 15%"] == "WARN"
    assert statuses(contracts.clean_logs(clean(spark), None))["Row count matches raw_logs"] == "FAIL"


def test_delivery_checks(spark):
    good = statuses(contracts.delivery(delivery(spark), min_rows=0))
    assert len(good) == 11 and {c for c, s in good.items() if s != "PASS"} == {"Late rate in [2%, 20%]"}
    for change, check, status in [
        ({"customer_state": None}, "No nulls in key columns", "FAIL"),
        ({"delivery_days": -0.1}, "delivery_days >= 0", "FAIL"),
        ({"delivery_days": 365.1}, "delivery_days < 365 days", "WARN"),
        ({"is_late": 3}, "is_late is binary", "FAIL"),
        ({"delivery_days": 31.0}, "Avg delivery in [5, 30] days", "WARN"),
        ({"country": "Chile"}, "country = Brazil only", "FAIL"),
        ({"country": None}, "country = Brazil only", "FAIL"),
    ]:
        assert statuses(contracts.delivery(delivery(spark, **change), min_rows=0))[check] == status
    twice = delivery(spark).unionByName(delivery(spark))
    assert statuses(contracts.delivery(twice, min_rows=0))["No duplicate order_ids"] == "WARN"
    assert statuses(contracts.delivery(delivery(spark)))["Row count > 90,000"] == "FAIL"
    bare = statuses(contracts.delivery(delivery(spark).drop("country", "state_name"), min_rows=0))
    assert bare["country column present"] == bare["state_name column present"] == "FAIL"
    assert "country = Brazil only" not in bare
    empty = statuses(contracts.delivery(delivery(spark).limit(0), min_rows=0))
    assert empty["country = Brazil only"] == empty["Row count > 0"] == "FAIL"


def test_sentiment_checks(spark):
    good = statuses(contracts.sentiment(sentiment(spark, ("Positive", 5), ("Negative", 1))))
    assert set(good.values()) == {"PASS"} and len(good) == 6
    assert statuses(contracts.sentiment(sentiment(spark, ("Great", 5))))["sentiment values valid"] == "FAIL"
    assert statuses(contracts.sentiment(sentiment(spark, ("Neutral", 6))))["review_score in [1, 5]"] == "FAIL"
    nulls = statuses(contracts.sentiment(sentiment(spark, (None, 5))))
    assert nulls["No nulls in sentiment/review_score"] == nulls["sentiment values valid"] == "FAIL"
    bad = statuses(contracts.sentiment(sentiment(spark, ("Negative", 5), ("Positive", 1))))
    assert bad["5-star mostly Positive/Neutral (>60%)"] == bad["1-star mostly Negative/Neutral (>60%)"] == "WARN"
    assert statuses(contracts.sentiment(sentiment(spark)))["Row count > 0"] == "FAIL"


def test_category_checks(spark):
    def rows(*values):
        return spark.createDataFrame(
            [("r", "o", stars, label, category, "t") for stars, label, category in values], S.CATEGORY_SENTIMENT
        )

    five = [(3, "Neutral", f"c{i}") for i in range(5)]
    assert set(statuses(contracts.category_sentiment(rows(*five))).values()) == {"PASS"}
    assert statuses(contracts.category_sentiment(rows(*five[:4])))["At least 5 distinct categories"] == "FAIL"
    found = statuses(contracts.category_sentiment(rows((0, "Odd", None))))
    assert [found[c] for c in ("star_rating in [1, 5]", "sentiment values valid", "No nulls in category/sentiment")] == [
        "FAIL", "FAIL", "FAIL",
    ]


def test_cross_table_checks(spark):
    def run(**tables):
        report = contracts.tables_report(spark, tables).filter(F.col("phase") == contracts.CROSS)
        return {(r.table, r.check): r.status for r in report.collect()}

    twice = sentiment(spark, ("Neutral", 3)).unionByName(sentiment(spark, ("Neutral", 3)))
    two_raw = raw(spark).unionByName(raw(spark))
    found = run(raw_logs=two_raw, clean_logs=clean(spark, risk_level=None), sentiment=twice)
    assert set(found.values()) == {"FAIL"} and len(found) == 3
    found = run(raw_logs=raw(spark), clean_logs=clean(spark), sentiment=sentiment(spark, ("Neutral", 3)))
    assert set(found.values()) == {"PASS"}


def test_missing_tables_fail_once(spark):
    report = contracts.tables_report(spark, {"raw_logs": raw(spark)}, expected_logs=1)
    missing = report.filter("check = 'Table exists' AND status = 'FAIL'").collect()
    assert {r.table for r in missing} == {"clean_logs", "delivery", "sentiment", "category_sentiment"}
    assert report.filter("table = 'delivery'").count() == 1


def test_report_totals_and_lines(spark):
    report = contracts.tables_report(spark, {"raw_logs": raw(spark)}, expected_logs=1)
    totals = Q.totals(report).first()
    assert totals.checks == totals["pass"] + totals["warn"] + totals["fail"] == 13
    lines = Q.report_lines(report)
    assert "13 checks" in lines and sum(line.startswith("FAIL Phase") for line in lines) == 4
    with pytest.raises(RuntimeError, match="delivery: Table exists"):
        Q.require_no_failures(report)


def test_declared_tests_are_all_there():
    kinds = [t.kind for t in column_tests.ALL_TESTS]
    assert len(kinds) == 53
    assert [kinds.count(k) for k in (Q.NOT_NULL, Q.UNIQUE, Q.ACCEPTED)] == [31, 6, 16]
    assert [len(t) for t in (column_tests.SOURCE_TESTS, column_tests.STAGING_TESTS, column_tests.MART_TESTS)] == [22, 19, 12]


def test_column_tests_find_what_they_should(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "y"), (None, "x")], "k string, v string")
    tests = [
        Q.ColumnTest("t", "k", Q.NOT_NULL),
        Q.ColumnTest("t", "k", Q.UNIQUE),
        Q.ColumnTest("t", "v", Q.ACCEPTED, ("x",)),
        Q.ColumnTest("t", "v", Q.ACCEPTED, ("x", "y")),
    ]
    rows = [(r.column, r.test, r.failures, r.status) for r in Q.column_tests({"t": df}, tests).collect()]
    assert sorted(rows) == [
        ("k", "not_null", 2, "FAIL"),
        ("k", "unique", 1, "FAIL"),
        ("v", "accepted_values", 0, "PASS"),
        ("v", "accepted_values", 1, "FAIL"),
    ]


def test_column_tests_read_every_relation_once(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("a", "b", "none")]
    for path, rows in zip(paths, ([(1, "x")] * 900 + [(2, "y"), (3, None)], [(7, "z")], []), strict=True):
        spark.createDataFrame(rows, "k long, v string").write.parquet(path)
    relations = {name: spark.read.parquet(path) for name, path in zip("abn", paths, strict=True)}
    tests = [Q.ColumnTest(r, c, k, ("x", "z")) for r in "abn" for c, k in (("k", Q.UNIQUE), ("v", Q.UNIQUE), ("v", Q.NOT_NULL), ("v", Q.ACCEPTED))]
    report = Q.column_tests(relations, [*tests, Q.ColumnTest("absent", "k", Q.UNIQUE)])
    found = {(r.relation, r.column, r.test): (r.failures, r.status) for r in report.collect()}
    assert len(found) == len(tests)
    assert found["a", "k", Q.UNIQUE] == found["a", "v", Q.UNIQUE] == (1, "FAIL")  # 900 copies are one value
    assert found["a", "v", Q.NOT_NULL] == found["a", "v", Q.ACCEPTED] == (1, "FAIL")
    assert {v for (r, _, _), v in found.items() if r != "a"} == {(0, "PASS")}
    plan = Q.column_tests(relations, tests)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3 and plan.count("hashpartitioning(number") == 2  # by (test, key), then by test


def test_report_reads_every_table_once(spark, tmp_path):
    tables = {"raw_logs": raw(spark), "clean_logs": clean(spark), "sentiment": sentiment(spark, ("Neutral", 3))}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    stored = {name: spark.read.parquet(str(tmp_path / name)) for name in tables}
    plan = contracts.tables_report(spark, stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3


def test_null_profile_and_duplicates(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, None)], "k string, v string")
    assert [(r.column, r.rows, r.nulls, r.is_empty) for r in Q.null_profile(df, "t").collect()] == [
        ("k", 3, 1, False), ("v", 3, 3, True),
    ]
    row = Q.duplicates(df, "t", "k").first()
    assert (row.rows, row.distinct_keys, row.duplicates) == (3, 1, 2)


def test_one_aggregate_per_table(spark):
    plan = contracts.sentiment(sentiment(spark, ("Neutral", 3)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
