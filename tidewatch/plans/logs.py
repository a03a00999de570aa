"""Server-log health: reports, features, anomaly scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch import schemas as S
from tidewatch.functions import scalar as X
from tidewatch.operators import iforest
from tidewatch.operators.estimates import spread
from tidewatch.operators.ranks import quantile, running, totals
from tidewatch.operators.selection import exact_quantile
from tidewatch.operators.spike_model import FEATURES
from tidewatch.session import stage

FOREST_FEATURES = [
    "log_exec_time", "server_cpu_load", "hour_of_day", "qt_code", "tbl_code", "is_peak_hour",
]


def _time() -> Column:
    return F.col("timestamp").cast("timestamp")


# ---- sanity reports and diagnostics ---------------------------------------


def by_table(logs: DataFrame) -> DataFrame:
    """Run time and count per target table (K8)."""
    return (
        logs.groupBy("target_table")
        .agg(
            X.round_half_away(F.avg("execution_time_ms"), 1).alias("avg_ms"),
            F.max("execution_time_ms").alias("max_ms"),
            F.count("*").alias("n"),
        )
        .orderBy(F.desc("avg_ms"), "target_table")
    )


def by_period(logs: DataFrame) -> DataFrame:
    """Run time in the evening peak against the rest of the day (K8)."""
    return logs.groupBy(X.period_label(_time()).alias("period")).agg(
        X.round_half_away(F.avg("execution_time_ms"), 1).alias("avg_ms"), F.count("*").alias("n")
    )


def hourly(logs: DataFrame, measure: str, name: str, digits: int) -> DataFrame:
    """Mean of a measure per hour of day, the peak hours marked."""
    return (
        logs.groupBy(F.hour(_time()).alias("hour"))
        .agg(X.round_half_away(F.avg(measure), digits).alias(name))
        .withColumn("is_peak", F.col("hour").between(*S.PEAK_HOURS))
        .orderBy("hour")
    )


def hourly_ms(logs: DataFrame) -> DataFrame:
    return hourly(logs, "execution_time_ms", "avg_ms", 1)


def hourly_cpu(logs: DataFrame) -> DataFrame:
    return hourly(logs, "server_cpu_load", "avg_cpu", 2)


def timeouts_by_table(logs: DataFrame) -> DataFrame:
    """Timeouts per table."""
    return (
        logs.filter(F.col("status") == "TIMEOUT")
        .groupBy("target_table")
        .agg(F.count("*").alias("timeouts"))
        .orderBy(F.desc("timeouts"), "target_table")
    )


def summary(logs: DataFrame) -> DataFrame:
    """One row of totals, with the slowdown of the orders table."""
    ms = F.col("execution_time_ms")
    on_orders = F.col("target_table") == "orders"
    totals = logs.agg(
        F.count("*").alias("total"),
        F.coalesce(F.sum(X.flag(F.col("status") == "TIMEOUT")), F.lit(0)).alias("timeouts"),
        X.round_half_away(F.avg(ms), 1).alias("avg_ms"),
        F.max(ms).alias("max_ms"),
        X.round_half_away(F.avg(F.when(on_orders, ms)), 1).alias("orders_avg"),
        X.round_half_away(F.avg(F.when(~on_orders, ms)), 1).alias("others_avg"),
    )
    return totals.withColumn(
        "timeout_share", F.try_divide(F.col("timeouts").cast("double"), F.col("total"))
    ).withColumn("orders_slowdown", F.try_divide("orders_avg", "others_avg"))


def box_stats(logs: DataFrame) -> DataFrame:
    """Box-plot figures of run time per table.

    Rows are first counted per (table, run time), which partial aggregation
    does before the shuffle; quartiles, whiskers and outliers all come from
    the stored counts, whose ranges share the work of a large table.
    """
    ms, n = F.col("execution_time_ms").cast("double"), F.col("n")
    counts = logs.groupBy("target_table", ms.alias("ms")).agg(F.count("*").alias("n"))
    placed = running(counts.filter("ms IS NOT NULL"), ["target_table"], "ms", "n")
    quartiles = totals(placed, ["target_table"], "n").groupBy("target_table").agg(
        F.array(*[quantile(q, "ms", "n") for q in (0.25, 0.5, 0.75)]).alias("q"),
        (F.sum(F.col("ms") * n) / F.sum(n)).alias("mean_ms"),
    )
    reach = (F.col("q")[2] - F.col("q")[0]) * 1.5
    bounds = quartiles.select(
        "target_table",
        "mean_ms",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
        (F.col("q")[0] - reach).alias("low"),
        (F.col("q")[2] + reach).alias("high"),
    )
    inside = F.col("ms").between(F.col("low"), F.col("high"))
    keys = ["target_table", "q1", "median", "q3", "mean_ms"]
    return (
        placed.join(bounds, "target_table")
        .groupBy(*keys)
        .agg(
            F.min(F.when(inside, F.col("ms"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("ms"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(n)).cast("long").alias("outliers"),
        )
        .select(
            "target_table",
            "q1",
            "median",
            "q3",
            "whisker_low",
            "whisker_high",
            "outliers",
            X.round_half_away(F.col("mean_ms"), 1).alias("avg_ms"),
        )
        .orderBy(F.desc("avg_ms"), "target_table")
    )


# ---- features -------------------------------------------------------------


def features(logs: DataFrame) -> DataFrame:
    """Typed log rows with the nine engineered columns."""
    ts, ms = F.col("timestamp"), F.col("execution_time_ms")
    return logs.withColumns(
        {
            "timestamp": X.parse_strict(ts),
            "execution_time_ms": ms.cast("double"),
            "server_cpu_load": F.col("server_cpu_load").cast("double"),
        }
    ).withColumns(
        {
            "hour_of_day": F.hour(ts).cast("int"),
            "day_of_week": X.weekday_iso(ts),
            "is_peak_hour": X.flag(X.is_peak(ts)),
            "is_slow_query": X.flag(ms > S.TIMEOUT_MS),
            "is_high_cpu": X.flag(F.col("server_cpu_load") > S.HIGH_CPU_PCT),
            "is_orders_table": X.flag(F.col("target_table") == "orders"),
            "qt_code": X.code_of(F.col("query_type"), S.QUERY_CODES),
            "tbl_code": X.code_of(F.col("target_table"), S.TABLE_CODES),
            "log_exec_time": F.log10(ms),
        }
    )


def predictor_features(logs: DataFrame, key: str = "log_id") -> DataFrame:
    """What is known of a query before it runs, and whether CPU went high (M1)."""
    ts = _time()
    columns = {
        "hour_of_day": F.hour(ts).cast("int"),
        "day_of_week": X.weekday_from_sunday(ts),
        "is_peak_hour": X.flag(X.is_peak(ts)),
        "is_orders_table": X.flag(F.col("target_table") == "orders"),
        "qt_code": X.code_of(F.col("query_type"), S.QUERY_CODES),
        "tbl_code": X.code_of(F.col("target_table"), S.TABLE_CODES),
    }
    label = X.flag(F.col("server_cpu_load") > S.HIGH_CPU_PCT).alias("is_high_cpu")
    return logs.select(key, *[columns[c].alias(c) for c in FEATURES], label)


def class_balance(predictor_rows: DataFrame) -> DataFrame:
    """Rows, high-CPU rows and their share (M9)."""
    high = F.col("is_high_cpu")
    return predictor_rows.agg(
        F.count("*").alias("n"),
        F.sum(high).cast("long").alias("high_cpu"),
        (F.sum(high).cast("double") / F.count("*")).alias("high_cpu_share"),
    )


# ---- anomalies ------------------------------------------------------------


def with_risk(flagged: DataFrame) -> DataFrame:
    """Rows with anomaly columns and their risk level, in table order."""
    risk = X.risk_level(F.col("is_anomaly"), F.col("is_high_cpu"), F.col("is_slow_query"))
    return flagged.withColumn("risk_level", risk).select(S.CLEAN_LOGS.fieldNames())


def clean_logs(logs: DataFrame, key: str = "log_id", **forest_options) -> DataFrame:
    """The enriched log with anomaly score and risk level."""
    return with_risk(iforest.detect(features(logs), FOREST_FEATURES, key, **forest_options))


def clean_logs_by_run_time(logs: DataFrame, contamination: float = iforest.CONTAMINATION) -> DataFrame:
    """The enriched log with run time alone as the score.

    The same flagging and risk rules as ``clean_logs``, with the longest run
    times taken for the anomalies: a model-free baseline to hold the forest
    against.
    """
    scored = features(logs).withColumn("raw_score", -F.col("execution_time_ms"))
    offset = exact_quantile(scored, "raw_score", contamination)
    return with_risk(iforest.flag_anomalies(scored, "raw_score", offset=offset))


def anomaly_share(clean: DataFrame) -> DataFrame:
    return clean.agg(
        F.count("*").alias("n"),
        F.sum("is_anomaly").cast("long").alias("anomalies"),
        F.avg(F.col("is_anomaly").cast("double")).alias("anomaly_share"),
    )


def risk_distribution(clean: DataFrame) -> DataFrame:
    """Rows per risk level and their share of all."""
    counts = clean.groupBy("risk_level").agg(F.count("*").alias("n"))
    # At most one row per risk level passes through the window.
    return share_of_total(counts, "n", "share").orderBy(F.desc("n"), "risk_level")


def share_of_total(counts: DataFrame, n: str, name: str) -> DataFrame:
    total = F.sum(n).over(Window.partitionBy(F.lit(0)))
    return counts.withColumn(name, F.col(n).cast("double") / total)


def stored_forest_scores(logs: DataFrame, forest: iforest.Forest, offset: float) -> DataFrame:
    """Score new rows with a forest and an offset fitted earlier; row by row."""
    score = iforest.score_column(logs.sparkSession, forest)
    scored = features(logs).withColumn("raw_score", score)
    return with_risk(iforest.flag_anomalies(scored, "raw_score", offset=offset))


def fit_forest(logs: DataFrame, key: str = "log_id", **options) -> tuple[iforest.Forest, float]:
    """A forest and its offset, to be kept for later rows."""
    rows = features(logs)
    forest = iforest.fit(rows, FOREST_FEATURES, key, **options)
    score = iforest.score_column(logs.sparkSession, forest)
    scored = stage(spread(rows).select(score.alias("raw_score")), "forest-scores")
    return forest, exact_quantile(scored, "raw_score", iforest.CONTAMINATION)
