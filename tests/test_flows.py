"""The flows on small inputs that hold every odd case."""

import datetime as dt

import pytest

from tidewatch import schemas as S
from tidewatch.operators import joins
from tidewatch.plans import delivery, logs, marts, reviews
from tidewatch.sources import adapters as A
from tidewatch.sources.synthetic import synthetic_logs


@pytest.fixture(scope="module")
def delivered(spark):
    day = "2018-01-10 00:00:00"
    orders = [
        ("late", "c1", "delivered", "2018-01-01 00:00:00", "2018-01-08 02:24:00", "2018-01-05 00:00:00"),
        ("early", "c2", "delivered", "2018-01-01 00:00:00", "2018-01-06 00:00:00", day),
        ("exact", "c3", "delivered", "2018-01-01 00:00:00", day, day),
        ("rounded", "c1", "delivered", "2018-01-01 00:00:00", "2018-01-10 01:00:00", day),
        ("nobody", "c9", "delivered", "2018-01-01 00:00:00", day, day),
        ("no key", None, "delivered", "2018-01-01 00:00:00", day, day),
        ("shipped", "c1", "shipped", "2018-01-01 00:00:00", day, day),
        ("no date", "c1", "delivered", "2018-01-01 00:00:00", None, day),
        ("bad date", "c1", "delivered", "2018-01-01 00:00:00", "soon", day),
        ("bad start", "c1", "delivered", "2018-99-01 00:00:00", day, day),
    ]
    customers = [("c1", "SP"), ("c2", "XX"), ("c3", None)]
    return (
        spark.createDataFrame(orders, S.ORDERS),
        spark.createDataFrame(customers, S.CUSTOMERS),
    )


def test_delivery_rows(delivered):
    rows = {r.order_id: r for r in delivery.enriched(*delivered).collect()}
    assert set(rows) == {"late", "early", "exact", "rounded", "nobody", "no key"}
    late = rows["late"]
    assert (late.delivery_days, late.days_vs_estimate, late.is_late, late.is_early, late.days_late) == (7.1, 3.1, 1, 0, 3.1)
    assert (late.performance_flag, late.delivery_bucket, late.estimate_label) == ("Normal", "6-10 days", "3+ days late")
    assert (late.purchase_month, late.month_name, late.month_sort) == ("2018-01", "Jan 2018", 201801)
    assert (late.state_name, late.region, late.country) == ("São Paulo", "Southeast", "Brazil")
    early = rows["early"]
    assert (early.is_late, early.is_early, early.days_late, early.estimate_label) == (0, 1, 0.0, "Early")
    assert (early.state_name, early.region) == ("XX", "XX")
    assert (rows["exact"].is_late, rows["exact"].is_early, rows["exact"].estimate_label) == (0, 0, "On time")
    # An hour late rounds to no days: flags follow the rounded value.
    assert (rows["rounded"].days_vs_estimate, rows["rounded"].is_late) == (0.0, 0)
    for order in ("exact", "nobody", "no key"):
        assert (rows[order].customer_state, rows[order].region) == (None, "Other")
    assert delivery.enriched(*delivered).schema.simpleString() == S.DELIVERY.simpleString()


def test_date_audit(delivered):
    row = delivery.date_audit(delivered[0]).first()
    assert (row.delivered_orders, row.null_delivered, row.null_purchased, row.dropped) == (8, 1, 1, 2)


def test_salted_join_gives_the_same_delivery(delivered, monkeypatch):
    wanted = delivery.enriched(*delivered)
    monkeypatch.setattr(joins, "is_small", lambda *a: False)
    forced = delivery.enriched(*delivered)
    assert "_salt_left" in forced._jdf.queryExecution().toString()
    assert forced.exceptAll(wanted).isEmpty() and wanted.exceptAll(forced).isEmpty()


def test_delivery_reports(delivered):
    table = delivery.enriched(*delivered)
    row = delivery.summary(table, min_orders=1).first()
    assert (row.orders, row.late_orders, row.outside_0_365) == (6, 1, 0)
    assert (row.fastest_state, row.slowest_state) == ("XX", None)
    assert delivery.state_averages(table, 2).count() == 2
    assert delivery.late_rates(table, 100).count() == 0
    bins = delivery.histogram(table, 60).collect()
    assert sum(r.orders for r in bins) == 6 and {r.bin for r in bins} >= {0, 59}
    nothing = delivery.summary(table.limit(0)).first()
    assert nothing.orders is None or nothing.orders == 0


@pytest.fixture(scope="module")
def review_tables(spark):
    sentiment = [
        ("r1", "o1", 5, "bom", "d", "Positive"),
        ("r2", "o2", 1, "ruim", "d", "Negative"),
        ("r3", "o3", 3, "hm", "d", "Neutral"),
        ("r4", "o4", 4, "ok", "d", "Neutral"),
        ("r5", "o9", 2, "?", "d", "Neutral"),
    ]
    items = [("o1", "p1"), ("o1", "p1"), ("o1", "p2"), ("o2", "p2"), ("o3", "p3"), ("o4", "p9")]
    products = [("p1", "beleza"), ("p2", "brinquedos"), ("p3", None)]
    translation = [("beleza", "beauty"), ("livros", "books")]
    return (
        spark.createDataFrame(sentiment, S.SENTIMENT),
        spark.createDataFrame(items, S.ITEMS),
        spark.createDataFrame(products, S.PRODUCTS),
        spark.createDataFrame(translation, S.TRANSLATION),
    )


def test_category_rows_keep_the_fan_out(review_tables):
    joined = reviews.category_sentiment(*review_tables)
    rows = sorted((r.review_id, r.category) for r in joined.collect())
    assert rows == [
        ("r1", "beauty"), ("r1", "beauty"), ("r1", "brinquedos"), ("r2", "brinquedos"),
        ("r3", "Unknown"), ("r4", "Unknown"), ("r5", "Unknown"),
    ]
    orphans = reviews.orphans(joined).first()
    assert (orphans.joined_rows, orphans.unknown_rows, orphans.is_poor) == (7, 3, True)
    assert reviews.orphans(joined.limit(0)).first().unknown_share == 0.0


@pytest.mark.parametrize("small", [False, True])
def test_category_join_beyond_the_broadcast_limit(review_tables, monkeypatch, small):
    wanted = reviews.category_sentiment(*review_tables)
    monkeypatch.setattr(joins, "is_small", lambda *a: False)
    monkeypatch.setattr(reviews, "is_small", lambda *a: small)
    forced = reviews.category_sentiment(*review_tables)
    assert forced.exceptAll(wanted).isEmpty() and wanted.exceptAll(forced).isEmpty()


def test_category_stats_threshold_grows_with_the_rows(spark):
    def stats(n_large):
        rows = [("r", "o", 5, "Positive", "large", "t")] * n_large + [("r", "o", 1, "Negative", "small", "t")] * 4
        rows += [("r", "o", 1, "Negative", "Unknown", "t")] * 5
        return {r.category for r in reviews.category_stats(spark.createDataFrame(rows, S.CATEGORY_SENTIMENT)).collect()}

    assert stats(50) == {"large", "small"}
    assert stats(600) == {"large"}


def test_mart_of_categories(spark):
    rows = [("r", "o", 4, s, "toys", "t") for s in ("Positive", "Negative", "Neutral", "Negative", "Positive")]
    rows += [("r", "o", 1, "Negative", "few", "t")] * 2 + [("r", "o", 1, "Negative", "Unknown", "t")] * 9
    mart = marts.dim_category_sentiment(spark.createDataFrame(rows, S.CATEGORY_SENTIMENT)).collect()
    assert [r.asDict() for r in mart] == [
        {
            "category": "toys", "review_count": 5, "avg_stars": 4.0, "pct_positive": 40.0, "pct_negative": 40.0,
            "pct_neutral": 20.0, "dominant_sentiment": "Negative", "is_high_complaint_category": True,
        }
    ]


def test_complaint_flag_is_strict(spark):
    rows = [("r", "o", 4, "Negative" if i < 3 else "Positive", "toys", "t") for i in range(10)]
    mart = marts.dim_category_sentiment(spark.createDataFrame(rows, S.CATEGORY_SENTIMENT)).first()
    assert mart.pct_negative == 30.0 and mart.is_high_complaint_category is False


def test_star_tables_fill_missing_labels(review_tables):
    counts = {r.review_score: (r.Positive, r.Neutral, r.Negative) for r in reviews.by_star(review_tables[0]).collect()}
    assert counts[5] == (1, 0, 0) and counts[1] == (0, 0, 1)
    shares = reviews.shares(review_tables[0].limit(0)).first()
    assert (shares.n, shares.positive) == (0, 0.0)


def test_classified_reviews_can_be_sampled(spark):
    rows = [(f"r{i}", "o", 5, "bom" if i % 4 else None, "d") for i in range(80)]
    table = spark.createDataFrame(rows, S.REVIEWS)
    assert reviews.classified_reviews(table).count() == 60
    drawn = reviews.classified_reviews(table, sample=13)
    assert drawn.count() == 13 and set(drawn.columns) == {*S.SENTIMENT.fieldNames(), "is_error"}
    assert reviews.sentiment_table(drawn).schema.simpleString() == S.SENTIMENT.simpleString()


def test_clean_logs_invariants(spark):
    raw = synthetic_logs(spark, 3000)
    clean = logs.clean_logs(raw, n_trees=20, rows_per_tree=64)
    assert clean.schema.simpleString() == S.CLEAN_LOGS.simpleString()
    rows = clean.collect()
    assert len(rows) == 3000
    assert abs(sum(r.is_anomaly for r in rows) - 150) <= 1
    assert all(r.status == "TIMEOUT" for r in rows if r.risk_level == "CRITICAL")
    assert sum(r.share for r in logs.risk_distribution(clean).collect()) == pytest.approx(1)
    mart = marts.fct_server_health(marts.stg_clean_logs(clean)).collect()
    assert [r.risk_level for r in mart] == [x for x in S.RISK_LEVELS if x in {r.risk_level for r in rows}]
    assert sum(r.pct_of_total for r in mart) == pytest.approx(100, abs=0.02)


def test_new_logs_can_be_scored_with_a_stored_forest(spark):
    raw = synthetic_logs(spark, 2000)
    forest, offset = logs.fit_forest(raw, n_trees=20, rows_per_tree=64)
    scored = logs.stored_forest_scores(synthetic_logs(spark, 300, seed=9), forest, offset)
    assert scored.count() == 300 and scored.filter("anomaly_score IS NULL").isEmpty()
    again = logs.stored_forest_scores(raw, forest, offset).agg({"is_anomaly": "sum"}).first()[0]
    assert abs(again - 100) <= 1


def test_log_features(spark):
    row = ("2024-01-07 22:59:59", "UPDATE", "order_items", 2001, 75.01, "TIMEOUT")
    f = logs.features(spark.createDataFrame([row], S.RAW_LOGS)).first()
    assert f.timestamp == dt.datetime(2024, 1, 7, 22, 59, 59)
    assert (f.hour_of_day, f.day_of_week, f.is_peak_hour, f.is_slow_query, f.is_high_cpu) == (22, 7, 1, 1, 1)
    assert (f.is_orders_table, f.qt_code, f.tbl_code) == (0, 2, 3)


def test_summary_of_an_empty_log(spark):
    row = logs.summary(spark.createDataFrame([], S.RAW_LOGS)).first()
    assert (row.total, row.timeouts, row.timeout_share, row.orders_slowdown) == (0, 0, None, None)


def test_marts_do_not_depend_on_partitions(spark):
    sf = "/root/testdata/sf0.01"
    table = delivery.enriched(A.orders(spark, sf), A.customers(spark, sf), A.DELIVERED)
    raw = A.raw_logs(spark, sf)
    for build in (
        lambda n: marts.fct_delivery_by_state(marts.stg_delivery_orders(table.repartition(n))),
        lambda n: delivery.summary(table.repartition(n)),
        lambda n: logs.box_stats(raw.repartition(n)),
        lambda n: logs.summary(raw.repartition(n)),
    ):
        assert build(1).collect() == build(7).collect()


def test_chart_labels_are_cut(spark):
    rows = [("c" * 50, 5, 4.0, 0.5, 0.25, 0.25)]
    stats = spark.createDataFrame(rows, S.CATEGORY_STATS)
    assert len(reviews.best_rated(stats).first().label) == 30
    assert len(reviews.worst_rated(stats).first().label) == 30
    row = reviews.most_complained(stats).first()
    assert len(row.label) == 35 and (row.neg_pct, row.is_red) == (25.0, True)
