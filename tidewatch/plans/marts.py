"""Staging views and marts (K1-K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch import schemas as S
from tidewatch.functions import scalar as X
from tidewatch.operators.ranks import grouped_quantiles
from tidewatch.plans.delivery import exact_mean
from tidewatch.session import stage

MIN_ORDERS_PER_STATE = 50
MIN_ROWS_PER_CATEGORY = 3
HIGH_COMPLAINT_PCT = 30

# ---- staging: types and names only ----------------------------------------


def stg_server_logs(raw_logs: DataFrame) -> DataFrame:
    return raw_logs.select(
        F.col("timestamp").cast("timestamp").alias("logged_at"),
        "query_type",
        "target_table",
        F.col("execution_time_ms").cast("double").alias("execution_time_ms"),
        F.col("server_cpu_load").cast("double").alias("server_cpu_load"),
        "status",
    )


def stg_clean_logs(clean_logs: DataFrame) -> DataFrame:
    return clean_logs.select(
        F.col("timestamp").cast("timestamp").alias("logged_at"),
        "query_type",
        "target_table",
        F.col("execution_time_ms").cast("double").alias("execution_time_ms"),
        F.col("server_cpu_load").cast("double").alias("server_cpu_load"),
        "status",
        F.col("anomaly_score").cast("double").alias("anomaly_score"),
        F.col("is_anomaly").cast("boolean").alias("is_anomaly"),
        "risk_level",
    )


def stg_delivery_orders(delivery: DataFrame) -> DataFrame:
    casts = {
        "delivery_days": "double",
        "days_vs_estimate": "double",
        "is_late": "boolean",
        "is_early": "boolean",
        "days_late": "double",
        "month_sort": "int",
    }
    return delivery.select(
        *[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in S.DELIVERY.fieldNames()]
    )


def stg_reviews(sentiment: DataFrame) -> DataFrame:
    return sentiment.filter(F.col("sentiment").isin(S.SENTIMENTS)).select(
        "review_id",
        "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        "sentiment",
        F.col("review_comment_message").alias("review_text"),
    )


# ---- marts ----------------------------------------------------------------


def fct_server_health(staged_logs: DataFrame) -> DataFrame:
    """Counts, run times, CPU and timeouts per risk level (K5)."""
    n = F.count("*")
    timeouts = F.count_if(F.col("status") == "TIMEOUT")
    per_level = staged_logs.groupBy("risk_level").agg(
        n.alias("query_count"),
        X.round_half_away(F.avg("execution_time_ms"), 1).alias("avg_exec_ms"),
        X.round_half_away(F.max("execution_time_ms"), 1).alias("max_exec_ms"),
        X.round_half_away(F.avg("server_cpu_load"), 1).alias("avg_cpu_pct"),
        timeouts.alias("timeout_count"),
        X.percent(timeouts, n, 2).alias("timeout_rate_pct"),
        F.count_if(X.is_peak(F.col("logged_at"))).alias("peak_hour_queries"),
        F.count_if(F.col("target_table") == "orders").alias("orders_table_queries"),
    )
    # One row per risk level passes through the window.
    everything = F.sum("query_count").over(Window.partitionBy(F.lit(0)))
    rank = F.array_position(F.array(*map(F.lit, S.RISK_LEVELS)), F.col("risk_level"))
    return (
        per_level.withColumn("pct_of_total", X.percent(F.col("query_count"), everything, 2))
        .select(
            "risk_level",
            "query_count",
            "pct_of_total",
            "avg_exec_ms",
            "max_exec_ms",
            "avg_cpu_pct",
            "timeout_count",
            "timeout_rate_pct",
            "peak_hour_queries",
            "orders_table_queries",
        )
        .orderBy(F.when(rank > 0, rank).asc_nulls_last(), "risk_level")
    )


def fct_delivery_by_state(staged_orders: DataFrame, min_orders: int = MIN_ORDERS_PER_STATE) -> DataFrame:
    """Delivery performance per state (K6).

    Orders are first counted per state and tenth of a day; these counts are
    stored, and all measures, the exact median included, follow from them.
    """
    keys = ["customer_state", "state_name", "region"]
    gap_tenths = F.round(F.col("days_vs_estimate") * 10).cast("long")
    counts = staged_orders.groupBy(*keys, "performance_flag", "delivery_days").agg(
        F.count("*").alias("n"),
        F.sum(gap_tenths).alias("gap_tenths"),
        F.count("days_vs_estimate").alias("gaps"),
        F.count_if(F.col("is_late")).alias("late"),
        F.count_if(F.col("is_early")).alias("early"),
    )
    counts = stage(counts, "state-days")
    per_day = counts.groupBy(*keys, "delivery_days").agg(F.sum("n").alias("n"))
    medians = grouped_quantiles(per_day, keys, "delivery_days", "n", {"median": 0.5})
    medians = medians.withColumnsRenamed({k: f"_{k}" for k in keys})
    n = F.col("n")
    total = F.sum(n)
    has_days = F.when(F.col("delivery_days").isNotNull(), n)

    def tier(name: str):
        hits = F.coalesce(F.sum(F.when(F.col("performance_flag") == name, n)), F.lit(0))
        return X.percent(hits, total, 1).alias(f"pct_{name.lower()}")

    return (
        counts.groupBy(*keys)
        .agg(
            total.alias("total_orders"),
            X.round_half_away(exact_mean("delivery_days", has_days), 1).alias("avg_delivery_days"),
            X.round_half_away(F.sum("gap_tenths") / (F.sum("gaps") * 10.0), 1).alias("avg_days_vs_estimate"),
            X.percent(F.sum("late"), total, 1).alias("late_rate_pct"),
            X.percent(F.sum("early"), total, 1).alias("early_rate_pct"),
            *[tier(name) for name in S.PERFORMANCE_FLAGS],
        )
        .filter(F.col("total_orders") >= min_orders)
        .join(medians, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left")
        .select(
            *keys,
            "total_orders",
            "avg_delivery_days",
            X.round_half_away(F.col("median"), 1).alias("median_delivery_days"),
            "avg_days_vs_estimate",
            "late_rate_pct",
            "early_rate_pct",
            *[f"pct_{name.lower()}" for name in S.PERFORMANCE_FLAGS],
        )
        .orderBy(F.desc("avg_delivery_days"), "customer_state")
    )


def dim_category_sentiment(categories: DataFrame, min_rows: int = MIN_ROWS_PER_CATEGORY) -> DataFrame:
    """Ratings and label percentages per category (K7).

    Counted per category and label first; the most frequent label is read off
    the counts, the first in the alphabet if there are several.
    """
    n = F.col("n")
    counts = (
        categories.filter(F.col("category") != "Unknown")
        .groupBy("category", "sentiment")
        .agg(F.count("*").alias("n"), F.sum("star_rating").alias("stars"), F.count("star_rating").alias("rated"))
    )
    total = F.sum(n)

    def labelled(label: str):
        return F.coalesce(F.sum(F.when(F.col("sentiment") == label, n)), F.lit(0))

    by_frequency = F.when(F.col("sentiment").isNotNull(), F.struct((-n).alias("rank"), F.col("sentiment")))
    complaints = labelled("Negative") * F.lit(100.0) / total
    return (
        counts.groupBy("category")
        .agg(
            total.alias("review_count"),
            X.round_half_away(F.sum("stars") / F.sum("rated"), 2).alias("avg_stars"),
            *[X.percent(labelled(s), total, 1).alias(f"pct_{s.lower()}") for s in ("Positive", "Negative", "Neutral")],
            F.min(by_frequency)["sentiment"].alias("dominant_sentiment"),
            (complaints > HIGH_COMPLAINT_PCT).alias("is_high_complaint_category"),
        )
        .filter(F.col("review_count") >= min_rows)
        .orderBy(F.desc("avg_stars"), "category")
    )
