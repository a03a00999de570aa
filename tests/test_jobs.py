"""All flows end to end on CSV inputs made from the smallest test tables."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.plans import jobs
from tidewatch.sources import adapters as A
from tidewatch.sources import files
from tidewatch.streaming.scoring import score_submitted

cloudpickle.register_pickle_by_value(sys.modules[__name__])
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def settings(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    frames = {
        "orders": A.orders(spark, SF).replace(A.DELIVERED, "delivered", "order_status"),
        # States that no table knows are turned away by the column tests.
        "customers": A.customers(spark, SF).fillna("SP").replace("XX", "SP"),
        "reviews": A.reviews(spark, SF).drop("lang"),
        "items": A.items(spark, SF),
        "products": A.products(spark, SF),
        "translation": A.translation(spark, SF),
    }
    for name, df in frames.items():
        files.write_csv(df, str(folder / name))
    files.create_database(spark, "flows")
    return jobs.Settings(
        **{f"{name}_csv": str(folder / name) for name in frames},
        export_folder=str(folder / "exports"),
        database="flows",
        mart_database="flows_marts",
        n_logs=2000,
        review_sample=120,
        predictor_trees=3,
        forest_options={"n_trees": 20, "rows_per_tree": 64},
    )


@pytest.fixture(scope="module")
def run(spark, settings):
    return jobs.run_all(spark, settings, expected_logs=2000, min_deliveries=100)


def test_tables_and_marts(spark, settings, run):
    assert spark.table("flows.raw_logs").count() == spark.table("flows.clean_logs").count() == 2000
    assert spark.table("flows.delivery").schema.simpleString() == S.DELIVERY.simpleString()
    assert spark.table("flows.sentiment").count() == 120
    assert spark.table("flows.category_sentiment").count() >= 120
    assert run.marts["fct_server_health"].agg(F.sum("query_count")).first()[0] == 2000
    assert spark.catalog.tableExists("flows_marts.dim_category_sentiment")


def test_column_tests_pass(run):
    assert run.column_tests.count() == 53 and run.column_tests.filter("status != 'PASS'").isEmpty()


def test_report_is_complete(run):
    rows = run.report.collect()
    assert len(rows) == 67
    # The run is smaller than the row bounds of the two large exports.
    failed = {(r.table, r.check) for r in rows if r.status == "FAIL"}
    assert failed == {
        ("synthetic_sql_logs.csv", "Row count >= 14,000"),
        ("processed_logs.csv", "Row count >= 14,000"),
        ("delivery_analysis.csv", "Row count >= 90,000"),
    }


def test_exports_have_their_columns(spark, settings, run):
    assert len(run.exports) == 9
    assert files.header_of(spark, f"{settings.export_folder}/synthetic_sql_logs.csv") == S.RAW_LOGS.fieldNames()
    assert files.header_of(spark, f"{settings.export_folder}/category_stats.csv") == S.CATEGORY_STATS.fieldNames()


@pytest.mark.parametrize(
    ("file", "table", "schema"),
    [
        ("processed_logs.csv", "clean_logs", S.CLEAN_LOGS),
        ("delivery_analysis.csv", "delivery", S.DELIVERY),
        ("enriched_customer_sentiment.csv", "sentiment", S.SENTIMENT),
        ("category_sentiment.csv", "category_sentiment", S.CATEGORY_SENTIMENT),
    ],
)
def test_exports_hold_the_tables(spark, settings, run, file, table, schema):
    stored = spark.table(f"flows.{table}")
    again = files.read_csv(spark, f"{settings.export_folder}/{file}", schema, line_breaks=True)
    assert again.exceptAll(stored).isEmpty() and stored.exceptAll(again).isEmpty()


def test_log_reports(run):
    assert run.log_reports["summary"].first().total == 2000
    assert run.log_reports["hourly_ms"].count() == 24


def test_a_job_names_the_one_it_waits_for(spark, settings):
    files.create_database(spark, "empty_db")
    bare = jobs.Settings(**{**vars(settings), "database": "empty_db"})
    with pytest.raises(RuntimeError, match="make_raw_logs"):
        jobs.make_clean_logs(spark, bare)


def test_failed_batches_are_left_out(spark, settings):
    def sometimes_down(instructions, request):
        if len(request) % 2:
            raise RuntimeError("down")
        return json.dumps([])

    files.create_database(spark, "partial_db")
    s = jobs.Settings(**{**vars(settings), "database": "partial_db", "provider": sometimes_down})
    kept = jobs.make_sentiment(spark, s)
    assert kept.count() <= 120 and kept.filter("sentiment != 'Neutral'").isEmpty()


def test_submitted_queries_are_scored_as_a_stream(spark, run, tmp_path):
    known = ["timestamp", "query_type", "target_table"]
    submitted = spark.table("flows.raw_logs").select(known).limit(40)
    submitted.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(submitted.schema).parquet(str(tmp_path / "in"))
    query = (
        score_submitted(stream, run.predictor.model)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    scored = spark.read.parquet(str(tmp_path / "out"))
    batch = score_submitted(spark.read.parquet(str(tmp_path / "in")), run.predictor.model)
    assert scored.count() == 40
    assert scored.exceptAll(batch).isEmpty()
