"""Every query by name: (session, folder of the test tables) -> DataFrame."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.functions.scalar import round_half_away
from tidewatch.functions.text import normalise_label
from tidewatch import schemas as S
from tidewatch.operators import classify as C
from tidewatch.operators import quality as Q
from tidewatch.operators import iforest, metrics, selection, spike_model
from tidewatch.plans import column_tests, contracts, delivery, exports, jobs, logs, marts, reviews
from tidewatch.session import fresh_path, scratch, stage, stage_alone
from tidewatch.sources import adapters as A
from tidewatch.sources import files, synthetic

Query = Callable[[SparkSession, str], DataFrame]

# The provider below travels with its job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- tables the queries start from ----------------------------------------


def clean_table(spark: SparkSession, sf: str) -> DataFrame:
    return logs.clean_logs_by_run_time(A.raw_logs(spark, sf))


def delivery_table(spark: SparkSession, sf: str) -> DataFrame:
    return delivery.enriched(A.orders(spark, sf), A.customers(spark, sf), A.DELIVERED)


def labelled_reviews(spark: SparkSession, sf: str) -> DataFrame:
    recorded = A.reviews(spark, sf).withColumn("raw_label", A.raw_label(F.col("review_score"), F.col("lang")))
    return recorded.withColumn("sentiment", normalise_label(F.col("raw_label")))


def sentiment_table(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.sentiment_table(
        reviews.with_text(labelled_reviews(spark, sf)).withColumn("is_error", F.lit(False))
    )


def categories_table(spark: SparkSession, sf: str, **options) -> DataFrame:
    return reviews.category_sentiment(
        sentiment_table(spark, sf), A.items(spark, sf), A.products(spark, sf), A.translation(spark, sf), **options
    )


def stats_table(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.category_stats(categories_table(spark, sf))


def rounded_log(table: DataFrame) -> DataFrame:
    """The last bit of a logarithm differs between math libraries."""
    return table.withColumn("log_exec_time", round_half_away(F.col("log_exec_time"), 9))


def rounded_scores(table: DataFrame) -> DataFrame:
    """The last bits of a power differ too; plus zero, as a rounded score may be minus zero."""
    return table.withColumn("anomaly_score", round_half_away(F.col("anomaly_score"), 9) + 0.0)


def on(table: Query, report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: report(table(spark, sf))


# ---- queries --------------------------------------------------------------

def _synthetic(spark: SparkSession, sf: str) -> DataFrame:
    return synthetic.logs_for(A.read(spark, sf, "events"), "event_id")


def _split(rows: DataFrame) -> DataFrame:
    return selection.split_stratified(rows, "is_high_cpu", "log_id").select("log_id", "is_high_cpu", "is_test")


def _training_counts(rows: DataFrame) -> DataFrame:
    counts = spike_model.weighted_counts(rows, "log_id")
    return counts.withColumn("weight", F.col("weight").cast("long"))


def _split_balance(rows: DataFrame) -> DataFrame:
    split = selection.split_stratified(rows, "is_high_cpu", "log_id")
    return split.groupBy("is_test").agg(
        F.count("*").alias("n"),
        F.sum("is_high_cpu").alias("high_cpu"),
        (F.sum("is_high_cpu").cast("double") / F.count("*")).alias("high_cpu_share"),
    )


def _tree_samples(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.raw_logs(spark, sf).select("log_id")
    n = rows.count()
    drawn = iforest.tree_samples(
        rows, n, "log_id", iforest.N_TREES, min(iforest.ROWS_PER_TREE, n), iforest.SEED
    )
    return drawn.select("tree", "place", "log_id")


def _scaled_features(spark: SparkSession, sf: str) -> DataFrame:
    columns = logs.FOREST_FEATURES
    rows = logs.features(A.raw_logs(spark, sf)).select("log_id", *[F.col(c).cast("double") for c in columns])
    _, means, scales = iforest.moments(rows, columns)
    scaled = iforest.standardised(rows, columns, means, scales)
    # Plus zero, as a rounded value may be minus zero.
    return scaled.select("log_id", *[(round_half_away(F.col(c), 6) + 0.0).alias(c) for c in columns])


def _mart_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A mart exported as one CSV file and read back with its types."""
    mart = marts.fct_delivery_by_state(marts.stg_delivery_orders(delivery_table(spark, sf)))
    folder = fresh_path(spark, "mart-csv")
    (path,) = exports.export_tables({"fct_delivery_by_state": mart}, folder)
    return files.read_csv(spark, path, mart.schema)


def _numbered_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews with text in batches of ten neighbouring ids, numbered within each."""
    texts = reviews.with_text(labelled_reviews(spark, sf)).withColumn("id", F.col("review_id").cast("long"))
    return texts.withColumn("batch_id", F.floor(F.col("id") / C.BATCH))


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    return C.requests(_numbered_reviews(spark, sf), "batch_id", "id", "review_comment_message")


def _parsed_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Replies as a model may give them, some fenced, some broken, parsed to labels.

    What a batch gets depends on the length of its texts: a fenced reply, one
    that leaves out the third review, one that is cut off, one with quoted
    ids, or a plain one.
    """
    rows = _numbered_reviews(spark, sf)
    at = Window.partitionBy("batch_id").orderBy("id")
    placed = rows.withColumn("position", F.row_number().over(at) - 1)
    answer = F.struct(F.col("position").alias("id"), F.col("raw_label").alias("sentiment"))
    batches = placed.groupBy("batch_id").agg(
        F.array_sort(F.collect_list(answer)).alias("answers"),  # ten at most
        F.sum(F.length("review_comment_message")).alias("chars"),
    )
    full = F.to_json("answers")
    quoted = F.regexp_replace(full, r'"id":([0-9]+)', '"id":"$1"')
    kind = F.col("chars") % 5
    reply = (
        F.when(kind == 0, F.concat(F.lit("```json\n"), full, F.lit("\n```")))
        .when(kind == 1, F.to_json(F.filter("answers", lambda a: a["id"] != 2)))
        .when(kind == 2, F.left(full, F.length(full) - 2))
        .when(kind == 3, quoted)
        .otherwise(full)
    )
    replies = batches.select("batch_id", reply.alias("reply"))
    labelled = C.apply_replies(placed.drop("sentiment"), replies, "batch_id", "position", "reply")
    return labelled.select("review_id", "batch_id", "position", "raw_label", "sentiment", "is_error")


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    """All reviews through the stand-in model, label against word stems of the text."""
    labelled = C.classify(
        reviews.with_text(A.reviews(spark, sf)).select(S.REVIEWS.fieldNames()), C.stem_provider, key="review_id"
    )
    return labelled.select("review_id", "sentiment", "is_error")


def unreliable_provider(instructions: str, request: str) -> str:
    """The stand-in model, down for every request whose length is a multiple of five."""
    if len(request) % 5 == 0:
        raise ConnectionError("model is down")
    return C.stem_provider(instructions, request)


def _sentiment_job(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the reviews with text drawn, batched, sent to a model that fails at times, and labelled."""
    rows = A.reviews(spark, sf).withColumn("id", F.col("review_id").cast("long"))
    half = reviews.with_text(rows).count() // 2
    return reviews.sentiment_job(rows, unreliable_provider, fresh_path(spark, "ledger"), "id", half, per_task=25)


def _job_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.sentiment_table(_sentiment_job(spark, sf))


def _job_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return C.rejected(_sentiment_job(spark, sf)).select("review_id", "batch_id", "position")


def _forest_logs(spark: SparkSession, sf: str) -> DataFrame:
    return logs.clean_logs(A.raw_logs(spark, sf))


def _evaluation(spark: SparkSession, sf: str) -> spike_model.Evaluation:
    rows = logs.predictor_features(A.raw_logs(spark, sf))
    return spike_model.train_and_evaluate(rows, "log_id")


def _few_rounds(spark: SparkSession, sf: str) -> spike_model.Evaluation:
    """Three rounds of the learner, as many as plain SQL can follow."""
    return spike_model.train_and_evaluate(logs.predictor_features(A.raw_logs(spark, sf)), "log_id", n_trees=3)


def _boosted_trees(spark: SparkSession, sf: str) -> DataFrame:
    nodes = _few_rounds(spark, sf).model.to_frame(spark)
    figures = [(round_half_away(F.col(c), 9) + 0.0).alias(c) for c in ("gain", "value")]
    return nodes.select("tree", "slot", "feature", "threshold", *figures)


def _boosted_predictions(spark: SparkSession, sf: str) -> DataFrame:
    test = _few_rounds(spark, sf).test.drop("is_test")
    return test.withColumn("spike_probability", round_half_away(F.col("spike_probability"), 9))


def _boosted_report(spark: SparkSession, sf: str) -> DataFrame:
    """All figures of the full predictor from one training, in long form."""
    done = _evaluation(spark, sf)
    card = spike_model.scorecard(done)
    card = card.select(F.lit("scorecard").alias("report"), F.explode(_cells(card.columns)))
    report = spike_model.class_report(done.test)
    measures = [c for c in report.columns if c != "class"]
    report = report.select(F.col("class").alias("report"), F.explode(_cells(measures)))
    cells = spike_model.confusion(done.test)
    counts = [c for c in cells.columns if c != "actual"]
    cells = cells.select(F.concat(F.lit("actual "), F.col("actual").cast("string")).alias("report"), F.explode(_cells(counts)))
    shares = spike_model.importances(done)
    shares = shares.select(F.lit("importance").alias("report"), F.col("feature").alias("name"), F.col("importance").alias("value"))
    rows = [part.select("report", "col.name", "col.value") for part in (card, report, cells)]
    return Q.union_all([*rows, shares])


def _cells(columns: list[str]):
    return F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])


def _rule_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """The log with a fixed rule as the predictor: many equal scores, both kinds of errors."""
    rows = logs.predictor_features(A.raw_logs(spark, sf))
    mixed = F.col("hour_of_day") * 7 + F.col("day_of_week") * 3 + F.col("qt_code") * 5 + F.col("tbl_code") * 11
    score = (mixed + F.col("is_orders_table") * 20 + F.col("is_peak_hour") * 13) % 101
    scored = rows.withColumn("score", score / F.lit(101.0)).withColumn("weight", F.lit(1))
    return scored.withColumn("predicted", (F.col("score") > 0.5).cast("int"))


def _metrics_summary(rows: DataFrame) -> DataFrame:
    label = spike_model.LABEL
    right = rows.agg(F.count("*").alias("n"), metrics.accuracy(label, "predicted", "weight").alias("accuracy"))
    auc = metrics.roc_auc(rows, "score", label, "weight")
    # Two frames of one row each.
    return right.join(auc, F.lit(True)).select("n", "accuracy", round_half_away(F.col("roc_auc"), 12).alias("roc_auc"))


def _metrics_classes(rows: DataFrame) -> DataFrame:
    report = metrics.class_report(rows, spike_model.LABEL, "predicted", "weight")
    return report.withColumns({c: round_half_away(F.col(c), 12) for c in ("precision", "recall", "f1")})


def _tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The five tables. Those that take a join are stored, as several checks read them.

    Checks look at no review text, so the texts are not stored once per item.
    """
    return {
        "raw_logs": A.raw_logs(spark, sf).drop("log_id"),
        "clean_logs": clean_table(spark, sf),
        "delivery": stage_alone(spark, lambda: delivery_table(spark, sf), "delivery"),
        "sentiment": sentiment_table(spark, sf),
        "category_sentiment": stage_alone(
            spark, lambda: categories_table(spark, sf).drop("review_comment_message"), "categories"
        ),
    }


def _marts(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "fct_server_health": marts.fct_server_health(marts.stg_clean_logs(tables["clean_logs"])),
        "fct_delivery_by_state": marts.fct_delivery_by_state(marts.stg_delivery_orders(tables["delivery"])),
        "dim_category_sentiment": marts.dim_category_sentiment(tables["category_sentiment"]),
    }


def _column_tests(spark: SparkSession, sf: str) -> DataFrame:
    tables = _tables(spark, sf)
    staging = {
        "stg_server_logs": marts.stg_server_logs(tables["raw_logs"]),
        "stg_delivery_orders": marts.stg_delivery_orders(tables["delivery"]),
        "stg_reviews": marts.stg_reviews(tables["sentiment"]),
    }
    return column_tests.run({**tables, **staging, **_marts(tables)})


def _contract_report(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.tables_report(spark, _tables(spark, sf))


def _null_profile(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        "raw_logs": A.raw_logs(spark, sf).drop("log_id"),
        "orders_csv": A.orders(spark, sf),
        "customers_csv": A.customers(spark, sf),
        "delivery": delivery_table(spark, sf),
        "reviews_csv": A.reviews(spark, sf).drop("lang"),
        "products_csv": A.products(spark, sf),
    }
    return Q.union_all(Q.null_profile(df, name) for name, df in tables.items())


def _duplicates(spark: SparkSession, sf: str) -> DataFrame:
    joined = categories_table(spark, sf)
    return Q.union_all(
        [
            Q.duplicates(delivery_table(spark, sf), "delivery", "order_id"),
            Q.duplicates(sentiment_table(spark, sf), "sentiment", "review_id"),
            Q.duplicates(joined, "category_sentiment", "review_id"),
        ]
    )


def _export_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """All exports written, then checked from the files. What is staged for them is deleted once they are written."""
    folder = fresh_path(spark, "exports")
    with scratch(spark):
        # The texts of all items are most of what is written, so they go first, alone on the disk.
        per_item = categories_table(spark, sf, deal=True)
        exports.export_tables({"category_sentiment": per_item}, folder, texts_compressed=True)
    with scratch(spark):
        tables = _tables(spark, sf)
        stats = reviews.category_stats(tables["category_sentiment"])
        frames = {**tables, **_marts(tables), "sentiment": reviews.dealt(tables["sentiment"]), "category_stats": stats}
        del frames["category_sentiment"]
        exports.export_tables(frames, folder, texts_compressed=True)
    return contracts.export_report(spark, folder).withColumn(
        "detail", F.replace(F.col("detail"), F.lit(folder), F.lit(""))
    )


def _review_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews written as CSV and read back, texts with quotes and line breaks included."""
    path = fresh_path(spark, "reviews-csv")
    files.write_csv(A.reviews(spark, sf).drop("lang"), path)
    return files.read_csv(spark, path, S.REVIEWS, line_breaks=True)


def _table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The log stored as a table under a fresh path, read back and counted by SQL."""
    path = fresh_path(spark, "raw-logs-table")
    A.raw_logs(spark, sf).write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("stored_raw_logs")
    return spark.sql(
        "SELECT target_table, status, count(*) AS n, sum(execution_time_ms) AS total_ms "
        "FROM stored_raw_logs GROUP BY target_table, status"
    )


def _layers(spark: SparkSession, sf: str, report: Callable[[str], DataFrame]) -> DataFrame:
    """A report on the layers, built in a database of its own that is gone afterwards.

    The five tables are stored (the log twice, so that one is replaced), then
    staging views and mart tables are made from them by name.
    """
    base = f"layers_{uuid.uuid4().hex}"
    settings = jobs.Settings(*[""] * 7, database=base, mart_database=base)
    files.create_database(spark, base)
    try:
        tables = _tables(spark, sf)
        files.replace_table(tables["raw_logs"].where("status = 'TIMEOUT'"), settings.table("raw_logs"))
        for name, df in tables.items():
            files.replace_table(df, settings.table(name))
        jobs.make_marts(spark, settings)
        return stage(report(base), "layers")
    finally:
        for view in jobs.STAGING:
            spark.catalog.dropTempView(view)
        spark.sql(f"DROP DATABASE IF EXISTS {base} CASCADE")


def _layer_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Every stored table and staging view with its rows, read by name; a name that is not stored is refused."""

    def report(base: str) -> DataFrame:
        stored = {name: files.require_table(spark, f"{base}.{name}", "the jobs") for name in files.table_names(spark, base)}
        views = {name: spark.table(name) for name in jobs.STAGING}
        counts = [
            df.agg(F.count("*").alias("rows")).select(F.lit(kind).alias("kind"), F.lit(name).alias("name"), "rows")
            for kind, frames in (("table", stored), ("view", views))
            for name, df in frames.items()
        ]
        return Q.union_all(counts)

    return _layers(spark, sf, report)


def _layer_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The delivery mart as it is stored, by SQL over its name."""
    return _layers(spark, sf, lambda base: spark.sql(f"SELECT * FROM {base}.fct_delivery_by_state"))


def _column_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The header of every mart export, from the files."""
    folder = fresh_path(spark, "listing")
    return exports.column_listing(spark, exports.export_tables(_marts(_tables(spark, sf)), folder))


def queries() -> dict[str, Query]:
    predictor = on(A.raw_logs, logs.predictor_features)
    return {
        "logs_by_table": on(A.raw_logs, logs.by_table),
        "logs_by_period": on(A.raw_logs, logs.by_period),
        "eda_hourly_ms": on(A.raw_logs, logs.hourly_ms),
        "eda_hourly_cpu": on(A.raw_logs, logs.hourly_cpu),
        "eda_timeouts_by_table": on(A.raw_logs, logs.timeouts_by_table),
        "eda_summary": on(A.raw_logs, logs.summary),
        "eda_box_stats": on(A.raw_logs, logs.box_stats),
        "log_features": on(A.raw_logs, lambda t: rounded_log(logs.features(t))),
        "stg_server_logs": on(A.raw_logs, marts.stg_server_logs),
        "stg_clean_logs": on(clean_table, marts.stg_clean_logs),
        "predictor_features": predictor,
        "predictor_class_balance": on(predictor, logs.class_balance),
        "split_stratified": on(predictor, _split),
        "risk_level_rule_based": on(clean_table, rounded_log),
        "risk_distribution": on(clean_table, logs.risk_distribution),
        "anomaly_share": on(clean_table, logs.anomaly_share),
        "fct_server_health": on(clean_table, lambda t: marts.fct_server_health(marts.stg_clean_logs(t))),
        "synthetic_logs": _synthetic,
        "predictor_training_counts": on(predictor, _training_counts),
        "split_class_balance": on(predictor, _split_balance),
        "iforest_tree_samples": _tree_samples,
        "iforest_scaled_features": _scaled_features,
        "sample_indexed": on(
            A.raw_logs,
            lambda t: selection.indexed(selection.sample_exact(t, 500, "log_id"), "log_id"),
        ),
        "sample_exact": on(A.raw_logs, lambda t: selection.sample_exact(t, 3000, "log_id")),
        "delivery_enriched": delivery_table,
        "delivery_date_audit": on(A.orders, lambda t: delivery.date_audit(t, A.DELIVERED)),
        "delivery_summary": on(delivery_table, delivery.summary),
        "delivery_state_avg": on(delivery_table, delivery.state_averages),
        "delivery_late_rate": on(delivery_table, delivery.late_rates),
        "delivery_histogram": on(delivery_table, delivery.histogram),
        "stg_delivery_orders": on(delivery_table, marts.stg_delivery_orders),
        "fct_delivery_by_state": on(
            delivery_table, lambda t: marts.fct_delivery_by_state(marts.stg_delivery_orders(t))
        ),
        "reviews_sanitise": on(labelled_reviews, lambda t: t.select("review_id", "raw_label", "sentiment")),
        "reviews_sentiment": sentiment_table,
        "stg_reviews": on(sentiment_table, marts.stg_reviews),
        "sentiment_shares": on(sentiment_table, reviews.shares),
        "sentiment_label_counts": on(sentiment_table, reviews.label_counts),
        "sentiment_by_star": on(sentiment_table, reviews.by_star),
        "sentiment_by_star_pct": on(sentiment_table, reviews.by_star_pct),
        "category_join": categories_table,
        # The plan for sides that are too large to broadcast, whatever their size here.
        "category_join_shuffled": lambda spark, sf: categories_table(spark, sf, small_side_bytes=-1),
        "category_orphans": on(categories_table, reviews.orphans),
        "category_stats": stats_table,
        "category_top5": on(stats_table, reviews.best_rated),
        "category_top10": on(stats_table, lambda t: reviews.best_rated(t, 10)),
        "category_bottom10": on(stats_table, reviews.worst_rated),
        "category_most_complained": on(stats_table, reviews.most_complained),
        "category_overall_avg": on(stats_table, reviews.overall_averages),
        "dim_category_sentiment": on(categories_table, marts.dim_category_sentiment),
        "review_requests": _requests,
        "provider_parse": _parsed_replies,
        "provider_classify": _classified,
        "sentiment_job_accepted": _job_sentiment,
        "sentiment_job_rejected": _job_rejects,
        "classification_audit": on(_parsed_replies, reviews.classification_audit),
        "mart_csv_roundtrip": _mart_csv_roundtrip,
        "dq_column_tests": _column_tests,
        "dq_contract_report": _contract_report,
        "dq_status_totals": on(_contract_report, Q.totals),
        "dq_null_profile": _null_profile,
        "dq_duplicates": _duplicates,
        "review_csv_roundtrip": _review_csv_roundtrip,
        "table_roundtrip": _table_roundtrip,
        "layer_listing": _layer_listing,
        "layer_mart": _layer_mart,
        "export_columns": _column_listing,
        "export_roundtrip": _export_roundtrip,
        "clean_logs": on(_forest_logs, lambda t: rounded_scores(rounded_log(t))),
        "iforest_scores": on(
            _forest_logs, lambda t: rounded_scores(t.select("timestamp", "anomaly_score", "is_anomaly"))
        ),
        "iforest_flags": on(_forest_logs, logs.anomaly_share),
        "fct_server_health_forest": on(
            _forest_logs, lambda t: marts.fct_server_health(marts.stg_clean_logs(t))
        ),
        "gbt_trees": _boosted_trees,
        "gbt_predictions": _boosted_predictions,
        "gbt_report": _boosted_report,
        "metrics_summary": on(_rule_predictions, _metrics_summary),
        "metrics_class_report": on(_rule_predictions, _metrics_classes),
        "metrics_confusion": on(
            _rule_predictions, lambda t: metrics.confusion(t, spike_model.LABEL, "predicted", "weight")
        ),
        "gbt_scorecard": lambda spark, sf: spike_model.scorecard(_evaluation(spark, sf)),
        "gbt_class_report": lambda spark, sf: spike_model.class_report(_evaluation(spark, sf).test),
        "gbt_confusion": lambda spark, sf: spike_model.confusion(_evaluation(spark, sf).test),
        "gbt_importances": lambda spark, sf: spike_model.importances(_evaluation(spark, sf)),
    }
