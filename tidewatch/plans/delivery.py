"""Order delivery: times, lateness, regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions import scalar as X
from tidewatch.operators.joins import left_join

# Days carry one decimal, so sums of tenths are whole numbers: exact, and the
# same under any partitioning.
TENTHS = 10.0

DELIVERED = "delivered"
DATES = {
    "purchased": "order_purchase_timestamp",
    "delivered": "order_delivered_customer_date",
    "estimated": "order_estimated_delivery_date",
}
SLOW_STATE_DAYS = 15
LATE_STATE_PCT = 10
HISTOGRAM_DAYS = (0.0, 60.0)
HISTOGRAM_BINS = 60
MIN_ORDERS_PER_STATE = 100


def delivered_orders(orders: DataFrame, status: str = DELIVERED) -> DataFrame:
    """Delivered orders with both dates present, dates parsed leniently."""
    kept = orders.filter(
        (F.col("order_status") == status)
        & F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_estimated_delivery_date").isNotNull()
    )
    parsed = [X.parse_lenient(F.col(source)).alias(name) for name, source in DATES.items()]
    return kept.select("order_id", "customer_id", *parsed)


def enriched(orders: DataFrame, customers: DataFrame, status: str = DELIVERED) -> DataFrame:
    """The delivery table.

    Dates shrink to two numbers and a month before the join, so only narrow
    rows are moved if customers are too many to broadcast.
    """
    timed = delivered_orders(orders, status).dropna(subset=list(DATES))
    measured = timed.select(
        "order_id",
        "customer_id",
        X.days_between(F.col("delivered"), F.col("purchased")).alias("delivery_days"),
        X.days_between(F.col("delivered"), F.col("estimated")).alias("days_vs_estimate"),
        X.month_key(F.col("purchased")).alias("purchase_month"),
    )
    placed = left_join(measured, customers.select("customer_id", "customer_state"), "customer_id")
    days, gap, month = (F.col(c) for c in ("delivery_days", "days_vs_estimate", "purchase_month"))
    state = F.col("customer_state")
    return placed.select(
        "order_id",
        "customer_state",
        X.state_name(state).alias("state_name"),
        F.lit(S.COUNTRY).alias("country"),
        X.region_of(state).alias("region"),
        "delivery_days",
        "days_vs_estimate",
        (gap > 0).cast("int").alias("is_late"),
        (gap < 0).cast("int").alias("is_early"),
        X.at_least_zero(gap).alias("days_late"),
        X.band(days, S.DELIVERY_BUCKETS, S.DELIVERY_BUCKET_LAST).alias("delivery_bucket"),
        X.estimate_label(gap).alias("estimate_label"),
        X.band(days, S.PERFORMANCE_LIMITS, S.PERFORMANCE_LAST).alias("performance_flag"),
        "purchase_month",
        X.month_name(month).alias("month_name"),
        X.month_sort(month).alias("month_sort"),
    )


def date_audit(orders: DataFrame, status: str = DELIVERED) -> DataFrame:
    """Dates that did not parse, and the rows lost to them (Q20)."""
    unread = [F.col(name).isNull() for name in DATES]
    return delivered_orders(orders, status).agg(
        F.count("*").alias("delivered_orders"),
        *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in DATES],
        F.count_if(unread[0] | unread[1] | unread[2]).alias("dropped"),
    )


def exact_mean(column: str, n: Column | None = None) -> Column:
    """Mean of a column of tenths, summed in whole numbers."""
    tenths = F.round(F.col(column) * TENTHS).cast("long")
    total, count = (F.sum(tenths), F.count(column)) if n is None else (F.sum(tenths * n), F.sum(n))
    return total / (count * TENTHS)


# ---- reports --------------------------------------------------------------


def summary(delivery: DataFrame, min_orders: int = MIN_ORDERS_PER_STATE) -> DataFrame:
    """One row: orders, mean, median, late rate, odd values, extreme states."""
    days = F.col("delivery_days")
    # Days have one decimal, so the groups are states times a few hundred values.
    counts = delivery.groupBy("customer_state", "delivery_days").agg(
        F.count("*").alias("n"), F.sum("is_late").alias("late")
    )
    n = F.col("n")
    odd = (days <= 0) | (days > 365)
    totals = counts.agg(
        F.sum(n).alias("orders"),
        exact_mean("delivery_days", n).alias("mean_days"),
        F.percentile("delivery_days", F.lit(0.5), n).alias("median_days"),
        F.sum("late").cast("long").alias("late_orders"),
        F.coalesce(F.sum(F.when(odd, n)), F.lit(0)).alias("outside_0_365"),
    )
    states = (
        counts.groupBy("customer_state")
        .agg(F.sum(n).alias("orders"), exact_mean("delivery_days", n).alias("avg_days"))
        .filter(F.col("orders") >= min_orders)
    )
    extremes = states.agg(
        F.min(F.struct("avg_days", "customer_state")).alias("fast"),
        F.max(F.struct("avg_days", "customer_state")).alias("slow"),
    )
    one = F.lit(0).alias("_one")
    joined = totals.select("*", one).join(F.broadcast(extremes.select("*", one)), "_one")
    return joined.select(
        "orders",
        X.round_half_away(F.col("mean_days"), 1).alias("avg_days"),
        "median_days",
        "late_orders",
        F.try_divide(F.col("late_orders").cast("double"), F.col("orders")).alias("late_rate"),
        "outside_0_365",
        F.col("fast.customer_state").alias("fastest_state"),
        X.round_half_away(F.col("fast.avg_days"), 1).alias("fastest_days"),
        F.col("slow.customer_state").alias("slowest_state"),
        X.round_half_away(F.col("slow.avg_days"), 1).alias("slowest_days"),
    )


def state_averages(delivery: DataFrame, min_orders: int = MIN_ORDERS_PER_STATE) -> DataFrame:
    """Mean delivery days per state with enough orders, slow states marked."""
    return (
        delivery.groupBy("customer_state")
        .agg(exact_mean("delivery_days").alias("avg_days"), F.count("*").alias("orders"))
        .filter(F.col("orders") >= min_orders)
        .withColumn("is_slow", F.col("avg_days") > SLOW_STATE_DAYS)
        .orderBy("avg_days", "customer_state")
    )


def late_rates(delivery: DataFrame, min_orders: int = MIN_ORDERS_PER_STATE) -> DataFrame:
    """Late orders per state with enough orders, in percent."""
    return (
        delivery.groupBy("customer_state")
        .agg(
            (F.sum("is_late").cast("double") / F.count("*")).alias("late_rate"),
            F.count("*").alias("orders"),
        )
        .filter(F.col("orders") >= min_orders)
        .withColumn("late_pct", F.col("late_rate") * 100)
        .withColumn("is_red", F.col("late_pct") > LATE_STATE_PCT)
        .orderBy("late_pct", "customer_state")
    )


def histogram(delivery: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Orders per bin of delivery days, from the least to the greatest value in range.

    The last bin includes its upper edge.
    """
    in_range = delivery.filter(F.col("delivery_days").between(*HISTOGRAM_DAYS))
    # A few hundred distinct values, as days have one decimal.
    counts = in_range.groupBy("delivery_days").agg(F.count("*").alias("n"))
    ends = counts.agg(F.min("delivery_days").alias("low"), F.max("delivery_days").alias("high"))
    one = F.lit(0).alias("_one")
    width = (F.col("high") - F.col("low")) / bins
    at = F.floor((F.col("delivery_days") - F.col("low")) / width)
    return (
        counts.select("*", one)
        .join(F.broadcast(ends.select("*", one)), "_one")
        .withColumn("bin", F.least(F.coalesce(F.when(width > 0, at), F.lit(0)), F.lit(bins - 1)).cast("int"))
        .groupBy("bin", "low", "high")
        .agg(F.sum("n").alias("orders"))
        .select(
            "bin",
            (F.col("low") + F.col("bin") * width).alias("bin_start"),
            (F.col("low") + (F.col("bin") + 1) * width).alias("bin_end"),
            "orders",
        )
        .orderBy("bin")
    )
