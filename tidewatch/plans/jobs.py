"""The flows end to end, in the order their data demands.

Every job reads stored tables and replaces its own, so a run can be taken up
again at any job.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidewatch import schemas as S
from tidewatch.operators import classify as C
from tidewatch.operators import quality as Q
from tidewatch.operators import spike_model
from tidewatch.plans import column_tests, contracts, delivery, exports, logs, marts, reviews
from tidewatch.sources import files
from tidewatch.sources.synthetic import N_LOGS, synthetic_logs

STAGING = {
    "stg_server_logs": ("raw_logs", marts.stg_server_logs),
    "stg_clean_logs": ("clean_logs", marts.stg_clean_logs),
    "stg_delivery_orders": ("delivery", marts.stg_delivery_orders),
    "stg_reviews": ("sentiment", marts.stg_reviews),
}
MARTS = {
    "fct_server_health": ("stg_clean_logs", marts.fct_server_health),
    "fct_delivery_by_state": ("stg_delivery_orders", marts.fct_delivery_by_state),
    "dim_category_sentiment": ("category_sentiment", marts.dim_category_sentiment),
}


@dataclass(frozen=True)
class Settings:
    """Where the inputs are, where results go, and the sizes of a run."""

    orders_csv: str
    customers_csv: str
    reviews_csv: str
    items_csv: str
    products_csv: str
    translation_csv: str
    export_folder: str
    database: str = "default"
    mart_database: str = "marts"
    n_logs: int = N_LOGS
    review_sample: int | None = None
    provider: C.Provider = C.stem_provider
    ledger: str | None = None  # a folder of model replies: a later run sends only what has none
    predictor_trees: int = spike_model.N_TREES
    forest_options: dict = field(default_factory=dict)

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def mart(self, name: str) -> str:
        return f"{self.mart_database}.{name}"


def make_raw_logs(spark: SparkSession, s: Settings) -> DataFrame:
    """The query log; ``log_id`` gives its rows the identity they otherwise lack."""
    return files.replace_table(synthetic_logs(spark, s.n_logs), s.table("raw_logs"))


def log_reports(spark: SparkSession, s: Settings) -> dict[str, DataFrame]:
    raw = files.require_table(spark, s.table("raw_logs"), "make_raw_logs")
    return {
        "by_table": logs.by_table(raw),
        "by_period": logs.by_period(raw),
        "hourly_ms": logs.hourly_ms(raw),
        "hourly_cpu": logs.hourly_cpu(raw),
        "timeouts_by_table": logs.timeouts_by_table(raw),
        "box_stats": logs.box_stats(raw),
        "summary": logs.summary(raw),
    }


def train_predictor(spark: SparkSession, s: Settings) -> spike_model.Evaluation:
    raw = files.require_table(spark, s.table("raw_logs"), "make_raw_logs")
    return spike_model.train_and_evaluate(logs.predictor_features(raw), "log_id", s.predictor_trees)


def make_clean_logs(spark: SparkSession, s: Settings) -> DataFrame:
    raw = files.require_table(spark, s.table("raw_logs"), "make_raw_logs")
    return files.replace_table(logs.clean_logs(raw, "log_id", **s.forest_options), s.table("clean_logs"))


def make_delivery(spark: SparkSession, s: Settings) -> DataFrame:
    orders = files.read_csv(spark, s.orders_csv, S.ORDERS)
    customers = files.read_csv(spark, s.customers_csv, S.CUSTOMERS)
    return files.replace_table(delivery.enriched(orders, customers), s.table("delivery"))


def make_sentiment(spark: SparkSession, s: Settings) -> DataFrame:
    source = files.read_csv(spark, s.reviews_csv, S.REVIEWS, line_breaks=True)
    if s.ledger is None:
        classified = reviews.classified_reviews(source, s.provider, s.review_sample)
    else:
        classified = reviews.sentiment_job(source, s.provider, s.ledger, sample=s.review_sample)
    return files.replace_table(reviews.sentiment_table(classified), s.table("sentiment"))


def make_category_sentiment(spark: SparkSession, s: Settings) -> DataFrame:
    labelled = files.require_table(spark, s.table("sentiment"), "make_sentiment")
    joined = reviews.category_sentiment(
        labelled,
        files.read_csv(spark, s.items_csv, S.ITEMS),
        files.read_csv(spark, s.products_csv, S.PRODUCTS),
        files.read_csv(spark, s.translation_csv, S.TRANSLATION),
    )
    return files.replace_table(joined, s.table("category_sentiment"))


def make_marts(spark: SparkSession, s: Settings) -> dict[str, DataFrame]:
    """Staging as views, marts as tables."""
    for view, (table, build) in STAGING.items():
        build(files.require_table(spark, s.table(table), f"make_{table}")).createOrReplaceTempView(view)
    files.create_database(spark, s.mart_database)
    out = {}
    for mart, (source, build) in MARTS.items():
        name = source if source in STAGING else s.table(source)
        out[mart] = files.replace_table(build(spark.table(name)), s.mart(mart))
    return out


def run_column_tests(spark: SparkSession, s: Settings) -> DataFrame:
    tables = {t: spark.table(s.table(t)) for t in exports.TABLE_EXPORTS if t != "category_stats"}
    views = {v: spark.table(v) for v in STAGING}
    built = {m: spark.table(s.mart(m)) for m in MARTS}
    return column_tests.run({**tables, **views, **built})


def make_exports(spark: SparkSession, s: Settings) -> list[str]:
    categories = spark.table(s.table("category_sentiment"))
    frames = {t: spark.table(s.table(t)) for t in exports.TABLE_EXPORTS if t != "category_stats"}
    frames["raw_logs"] = frames["raw_logs"].select(S.RAW_LOGS.fieldNames())
    frames["category_stats"] = reviews.category_stats(categories)
    frames.update({m: spark.table(s.mart(m)) for m in MARTS})
    return exports.export_tables(frames, s.export_folder)


def validate(spark: SparkSession, s: Settings, **bounds) -> DataFrame:
    """The full report on tables and exports."""
    names = [t for t in exports.TABLE_EXPORTS if t != "category_stats"]
    tables = {t: files.table_if_exists(spark, s.table(t)) for t in names}
    report = contracts.tables_report(spark, tables, **bounds)
    return report.unionByName(contracts.export_report(spark, s.export_folder))


@dataclass(frozen=True)
class Run:
    log_reports: dict[str, DataFrame]
    predictor: spike_model.Evaluation
    marts: dict[str, DataFrame]
    column_tests: DataFrame
    exports: list[str]
    report: DataFrame


def run_all(spark: SparkSession, s: Settings, **bounds) -> Run:
    """All flows. A failed column test stops the run; the report is returned."""
    make_raw_logs(spark, s)
    diagnostics = log_reports(spark, s)
    predictor = train_predictor(spark, s)
    make_clean_logs(spark, s)
    make_delivery(spark, s)
    make_sentiment(spark, s)
    make_category_sentiment(spark, s)
    built = make_marts(spark, s)
    tested = run_column_tests(spark, s)
    failed = [r.asDict() for r in tested.filter(tested.status == Q.FAIL).collect()]
    if failed:
        raise RuntimeError(f"failed column tests: {failed}")
    written = make_exports(spark, s)
    return Run(diagnostics, predictor, built, tested, written, validate(spark, s, **bounds))
