"""The star-schema test tables, reshaped into the inputs of the three flows.

Every mapping reads the whole table and is row-local, so it costs no shuffle
(the dictionary of category names is the exception: it is one row per brand).
The odd values (missing or unreadable dates, unknown states, products without
a category) are there because the jobs must treat them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions.scalar import lookup, round_half_away
from tidewatch.sources.synthetic import status_of

TABLE_OF_EVENT = {
    "purchase": "orders",
    "signup": "customers",
    "view": "products",
    "click": "order_items",
    "error": "order_reviews",
}
# The status that stands for a delivered order here; kept as it is in the
# table, so that the filter on it reaches the scan.
DELIVERED = "F"
# What a model might answer for each star rating, by language of the review.
RAW_LABELS = {
    5: {"en": "Positive", "fr": "Super recomendo", "de": "positive", "es": "ótimo"},
    4: {"en": "positive", "fr": "Bom produto", "de": "Great", "es": "Positivo"},
    3: {"en": "Neutral", "fr": "Mixed", "de": "", "es": "Neutral"},
    2: {"en": "Negative", "fr": "Negativo", "de": "not recommended", "es": "poor"},
    1: {"en": "ruim", "fr": "Negative", "de": "terrible", "es": "péssimo"},
}
RAW_LABEL_DEFAULT = "unclear"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events")
    query_type = F.element_at(
        F.array(*map(F.lit, S.QUERY_TYPES)), (F.col("user_id") % 4 + 1).cast("int")
    )
    timed = events.select(
        F.col("event_id").alias("log_id"),
        F.date_format("ts", S.TIMESTAMP_FORMAT).alias("timestamp"),
        query_type.alias("query_type"),
        lookup(F.col("event_type"), TABLE_OF_EVENT).alias("target_table"),
        F.greatest(F.lit(10), F.floor(F.col("value") * 10)).cast("long").alias("execution_time_ms"),
        "user_id",
    )
    ms = F.col("execution_time_ms")
    cpu = F.least(F.lit(98.0), F.lit(40.0) + F.lit(0.15) * ms + F.col("user_id") % 20 - F.lit(5.0))
    return timed.select(
        "log_id",
        "timestamp",
        "query_type",
        "target_table",
        "execution_time_ms",
        round_half_away(cpu, 2).alias("server_cpu_load"),
        status_of(ms).alias("status"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = F.unix_timestamp("o_orderdate")

    def text(seconds):
        return F.date_format(F.timestamp_seconds(seconds), S.TIMESTAMP_FORMAT)

    delivered = (
        F.when(F.col("o_totalprice") < 5_000, F.lit(None).cast("string"))
        .when(F.col("o_totalprice") > 495_000, "not recorded")
        .otherwise(text(placed + F.col("o_orderkey") * 7919 % 3_024_000))
    )
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.date_format("o_orderdate", S.TIMESTAMP_FORMAT).alias("order_purchase_timestamp"),
        delivered.alias("order_delivered_customer_date"),
        text(placed + (F.col("o_custkey") % 20 + 25) * 86_400).alias("order_estimated_delivery_date"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.element_at(F.array(*map(F.lit, S.STATE_NAMES)), (F.col("c_custkey") % 27 + 1).cast("int"))
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.when(F.col("c_acctbal") < -900, F.lit(None).cast("string"))
        .when(F.col("c_acctbal") > 9_900, "XX")
        .otherwise(state)
        .alias("customer_state"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as reviews; a text of under ten characters counts as none.

    Whether there is a text shows from its length, so reports that need no
    text do not read the column.
    """
    documents = read(spark, sf_dir, "documents")
    written = F.date_add(F.lit("2018-01-01").cast("date"), (F.col("n_chars") % 365).cast("int"))
    return documents.select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.col("doc_id").cast("string").alias("order_id"),
        (F.col("n_chars") % 5 + 1).cast("int").alias("review_score"),
        F.when(F.col("n_chars") >= 10, F.coalesce("text", F.lit(""))).alias("review_comment_message"),
        F.date_format(written, S.TIMESTAMP_FORMAT).alias("review_creation_date"),
        "lang",
    )


def raw_label(score, lang):
    """The recorded answer of the model for a review."""
    by_key = {f"{s}:{code}": label for s, labels in RAW_LABELS.items() for code, label in labels.items()}
    key = F.concat_ws(":", score.cast("string"), lang)
    return F.coalesce(lookup(key, by_key), F.lit(RAW_LABEL_DEFAULT))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_size") > 1, F.col("p_brand")).alias("product_category_name"),
    )


def translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English names of the brands; those ending in 5 have no entry."""
    brands = read(spark, sf_dir, "part").select("p_brand").distinct()
    return brands.filter(~F.col("p_brand").endswith("5")).select(
        F.col("p_brand").alias("product_category_name"),
        F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit("_"))).alias("product_category_name_english"),
    )
