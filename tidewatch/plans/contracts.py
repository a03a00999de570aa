"""Contract checks on the five tables, the exports and across tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas as S
from tidewatch.operators import quality as Q
from tidewatch.operators.quality import Check
from tidewatch.sources import files

LOGS, DELIVERY, REVIEWS, EXPORTS, CROSS = "Phase 1", "Phase 2", "Phase 3", "Exports", "Cross-phase"

EXPECTED_LOGS = 15_000
MIN_DELIVERIES = 90_000


@dataclass(frozen=True)
class ExportContract:
    file: str
    min_rows: int
    columns: tuple[str, ...]
    line_breaks: bool = True  # inside fields; without them a file is split between tasks


EXPORT_CONTRACTS = [
    ExportContract(
        "synthetic_sql_logs.csv",
        14_000,
        ("timestamp", "execution_time_ms", "server_cpu_load", "status"),
        line_breaks=False,
    ),
    ExportContract(
        "processed_logs.csv", 14_000, ("risk_level", "is_anomaly", "anomaly_score"), line_breaks=False
    ),
    ExportContract(
        "delivery_analysis.csv",
        90_000,
        ("customer_state", "state_name", "country", "delivery_days", "is_late"),
        line_breaks=False,
    ),
    ExportContract("enriched_customer_sentiment.csv", 100, ("review_score", "sentiment")),
    ExportContract("category_sentiment.csv", 50, ("category", "sentiment", "star_rating")),
    ExportContract(
        "category_stats.csv",
        3,
        ("category", "avg_stars", "pct_positive", "pct_negative", "pct_neutral", "review_count"),
    ),
]

_ONE = "_one"


def _text(value: Column, *, before: str = "", after: str = "") -> Column:
    return F.concat(F.lit(before), value.cast("string"), F.lit(after))


def _none(figure: str, after: str) -> tuple[Column, Column]:
    """Condition and detail of a check that some count is zero."""
    return F.col(figure) == 0, _text(F.col(figure), after=after)


def _got(figure: str) -> Column:
    return F.concat(F.lit("Got "), Q.grouped_number(F.col(figure)))


def _beside(figures: DataFrame, others: DataFrame) -> DataFrame:
    """Two one-row frames as one."""
    one = F.lit(0).alias(_ONE)
    return figures.select("*", one).join(F.broadcast(others.select("*", one)), _ONE).drop(_ONE)


# ---- tables ---------------------------------------------------------------


def _raw_figures(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("n"),
        # NULLs are summed over the columns: a row may count more than once.
        sum((Q.count_if(F.col(c).isNull()) for c in S.RAW_LOGS.fieldNames()), F.lit(0)).alias("nulls"),
        Q.count_if(F.col("execution_time_ms") <= 0).alias("bad_ms"),
        Q.count_if((F.col("server_cpu_load") < 0) | (F.col("server_cpu_load") > 100)).alias("bad_cpu"),
        Q.count_if(Q.outside("status", S.STATUSES)).alias("bad_status"),
        Q.count_if(Q.outside("query_type", S.QUERY_TYPES)).alias("bad_type"),
        Q.count_if(Q.outside("target_table", S.TARGET_TABLES)).alias("bad_table"),
        Q.rate(F.col("status") == "TIMEOUT").alias("timeouts"),
    )


def _raw_logs_checks(expected_rows: int = EXPECTED_LOGS) -> list[Check]:
    return [
        Check(f"Row count = {expected_rows:,}", F.col("n") == expected_rows, _got("n")),
        Check("No nulls in any column", *_none("nulls", " nulls found")),
        Check("execution_time_ms > 0", *_none("bad_ms", " invalid rows")),
        Check("server_cpu_load in [0, 100]", *_none("bad_cpu", " out of range")),
        Check("status values valid", *_none("bad_status", " other values")),
        Check("query_type values valid", *_none("bad_type", " other values")),
        Check("target_table values valid", *_none("bad_table", " other values")),
        Check(
            "Timeout rate in [1%, 10%]",
            F.col("timeouts").between(0.01, 0.10),
            Q.as_percent(F.col("timeouts")),
            warn_only=True,
        ),
    ]


def raw_logs(df: DataFrame, expected_rows: int = EXPECTED_LOGS) -> DataFrame:
    return Q.results(_raw_figures(df), LOGS, "raw_logs", _raw_logs_checks(expected_rows))


def _clean_figures(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("n"),
        Q.count_if(Q.outside("risk_level", S.RISK_LEVELS)).alias("bad_risk"),
        Q.count_if(~F.col("is_anomaly").isin(0, 1)).alias("bad_flag"),
        Q.count_if(Q.nulls_in("risk_level", "is_anomaly", "anomaly_score")).alias("nulls"),
        Q.rate(F.col("risk_level") == "CRITICAL").alias("critical"),
        Q.count_if(F.col("risk_level").isNull()).alias("open"),
    )


def _clean_logs_checks() -> list[Check]:
    return [
        Check(
            "Row count matches raw_logs",
            F.col("n") == F.col("raw_n"),
            F.concat(
                F.lit("clean="),
                Q.grouped_number(F.col("n")),
                F.lit("  raw="),
                Q.grouped_number(F.col("raw_n")),
            ),
        ),
        Check("risk_level values valid", *_none("bad_risk", " other values")),
        Check("is_anomaly is binary", *_none("bad_flag", " invalid values")),
        Check("No nulls in risk columns", *_none("nulls", " nulls")),
        Check(
            "CRITICAL share < 15%", F.col("critical") < 0.15, Q.as_percent(F.col("critical")), warn_only=True
        ),
    ]


def clean_logs(df: DataFrame, raw: DataFrame | None) -> DataFrame:
    report = log_tables(raw, df)[0]
    return report.filter((F.col("phase") == LOGS) & (F.col("table") == "clean_logs"))


def delivery(df: DataFrame, min_rows: int = MIN_DELIVERIES) -> DataFrame:
    has_country = "country" in df.columns
    figures = df.agg(
        F.count("*").alias("n"),
        Q.count_if(Q.nulls_in("customer_state", "delivery_days", "is_late")).alias("nulls"),
        Q.count_if(F.col("delivery_days") < 0).alias("negative"),
        Q.count_if(F.col("delivery_days") > 365).alias("extreme"),
        Q.count_if(~F.col("is_late").isin(0, 1)).alias("bad_flag"),
        F.avg(F.col("is_late").cast("double")).alias("late"),
        F.avg("delivery_days").alias("days"),
        (Q.count_if(Q.outside("country", [S.COUNTRY])) if has_country else F.lit(None)).alias("abroad"),
        F.count_distinct("order_id").alias("orders"),
    )

    def column_present(name: str) -> Check:
        found = name in df.columns
        return Check(f"{name} column present", F.lit(found), F.lit("present" if found else "missing"))

    checks = [
        Check(f"Row count > {min_rows:,}", F.col("n") > min_rows, _got("n")),
        Check("No nulls in key columns", *_none("nulls", " nulls")),
        Check("delivery_days >= 0", *_none("negative", " negative values")),
        Check("delivery_days < 365 days", *_none("extreme", " extreme rows"), warn_only=True),
        Check("is_late is binary", *_none("bad_flag", " invalid values")),
        Check(
            "Late rate in [2%, 20%]",
            F.col("late").between(0.02, 0.20),
            Q.as_percent(F.col("late")),
            warn_only=True,
        ),
        Check(
            "Avg delivery in [5, 30] days",
            F.col("days").between(5, 30),
            F.format_string("%.1f days", "days"),
            warn_only=True,
        ),
        column_present("state_name"),
        column_present("country"),
        *(
            [
                Check(
                    "country = Brazil only",
                    (F.col("abroad") == 0) & (F.col("n") > 0),
                    _text(F.col("abroad"), after=" other values"),
                )
            ]
            if has_country
            else []
        ),
        Check(
            "No duplicate order_ids",
            F.col("n") == F.col("orders"),
            _total_and_unique("n", "orders"),
            warn_only=True,
        ),
    ]
    return Q.results(figures, DELIVERY, "delivery", checks)


def _total_and_unique(total: str, unique: str) -> Column:
    return F.concat(
        F.lit("total="),
        Q.grouped_number(F.col(total)),
        F.lit("  unique="),
        Q.grouped_number(F.col(unique)),
    )


def _sentiment_figures(df: DataFrame, *more: Column) -> DataFrame:
    def agreement(stars: int, labels: list[str]) -> Column:
        share = F.avg(F.when(F.col("review_score") == stars, F.col("sentiment").isin(labels).cast("double")))
        return F.coalesce(share, F.lit(0.0))

    return df.agg(
        F.count("*").alias("n"),
        Q.count_if(Q.outside("sentiment", S.SENTIMENTS)).alias("bad_label"),
        Q.count_if((F.col("review_score") < 1) | (F.col("review_score") > 5)).alias("bad_score"),
        Q.count_if(Q.nulls_in("sentiment", "review_score")).alias("nulls"),
        agreement(5, ["Positive", "Neutral"]).alias("five"),
        agreement(1, ["Negative", "Neutral"]).alias("one"),
        *more,
    )


def _sentiment_checks() -> list[Check]:
    return [
        Check("Row count > 0", F.col("n") > 0, _got("n")),
        Check("sentiment values valid", *_none("bad_label", " other values")),
        Check("review_score in [1, 5]", *_none("bad_score", " out-of-range")),
        Check("No nulls in sentiment/review_score", *_none("nulls", " nulls")),
        Check(
            "5-star mostly Positive/Neutral (>60%)",
            F.col("five") >= 0.6,
            Q.as_percent(F.col("five"), 1),
            warn_only=True,
        ),
        Check(
            "1-star mostly Negative/Neutral (>60%)",
            F.col("one") >= 0.6,
            Q.as_percent(F.col("one"), 1),
            warn_only=True,
        ),
    ]


def sentiment(df: DataFrame) -> DataFrame:
    return Q.results(_sentiment_figures(df), REVIEWS, "sentiment", _sentiment_checks())


def category_sentiment(df: DataFrame) -> DataFrame:
    figures = df.agg(
        F.count("*").alias("n"),
        Q.count_if(Q.nulls_in("category", "sentiment")).alias("nulls"),
        Q.count_if(Q.outside("sentiment", S.SENTIMENTS)).alias("bad_label"),
        Q.count_if((F.col("star_rating") < 1) | (F.col("star_rating") > 5)).alias("bad_stars"),
        F.count_distinct("category").alias("categories"),
    )
    checks = [
        Check("Row count > 0", F.col("n") > 0, _got("n")),
        Check("No nulls in category/sentiment", *_none("nulls", " nulls")),
        Check("sentiment values valid", *_none("bad_label", " other values")),
        Check("star_rating in [1, 5]", *_none("bad_stars", " out-of-range")),
        Check(
            "At least 5 distinct categories",
            F.col("categories") >= 5,
            _text(F.col("categories"), before="Found "),
        ),
    ]
    return Q.results(figures, REVIEWS, "category_sentiment", checks)


def log_tables(raw: DataFrame | None, clean: DataFrame | None, expected_rows: int = EXPECTED_LOGS) -> list[DataFrame]:
    """Checks of the log tables, by themselves and across (Q12, Q17), from one pass over each."""
    if clean is None:
        return [] if raw is None else [raw_logs(raw, expected_rows)]
    rated = Check("All rows have a risk_level", *_none("open", " unclassified"))
    rows = [Q.result_rows(LOGS, "clean_logs", _clean_logs_checks()), Q.result_rows(CROSS, "clean_logs", [rated])]
    figures = _clean_figures(clean)
    if raw is None:
        figures = figures.withColumn("raw_n", F.lit(-1))
    else:
        same = Check(
            "Row counts match",
            F.col("n") == F.col("raw_n"),
            F.concat(
                F.lit("raw="),
                Q.grouped_number(F.col("raw_n")),
                F.lit("  clean="),
                Q.grouped_number(F.col("n")),
            ),
        )
        of_raw = Q.result_rows(LOGS, "raw_logs", _raw_logs_checks(expected_rows)).alias("of_raw")
        figures = _beside(figures, _raw_figures(raw).select(F.col("n").alias("raw_n"), of_raw))
        rows = [F.col("of_raw"), *rows, Q.result_rows(CROSS, "raw_logs <-> clean_logs", [same])]
    return [figures.select(F.concat(*rows).alias("r")).select(F.inline("r"))]


def sentiment_and_keys(df: DataFrame) -> DataFrame:
    """Checks of the labelled reviews and of their keys (Q15), from one pass."""
    figures = _sentiment_figures(df, F.count_distinct("review_id").alias("ids"))
    unique = Check("No duplicate review_ids", F.col("n") == F.col("ids"), _total_and_unique("n", "ids"))
    rows = [Q.result_rows(REVIEWS, "sentiment", _sentiment_checks()), Q.result_rows(CROSS, "sentiment", [unique])]
    return figures.select(F.concat(*rows).alias("r")).select(F.inline("r"))


def tables_report(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    expected_logs: int = EXPECTED_LOGS,
    min_deliveries: int = MIN_DELIVERIES,
) -> DataFrame:
    """All table and cross-table checks; a table that is missing fails one check only.

    Every table is read once, checks across tables included.
    """
    phases = {"raw_logs": LOGS, "clean_logs": LOGS, "delivery": DELIVERY, "sentiment": REVIEWS, "category_sentiment": REVIEWS}
    found = [(phase, name, "Table exists", *_existence(tables.get(name))) for name, phase in phases.items()]
    frames = [Q.plain_results(spark, found)]
    frames += log_tables(tables.get("raw_logs"), tables.get("clean_logs"), expected_logs)
    sections = {
        "delivery": lambda df: delivery(df, min_deliveries),
        "sentiment": sentiment_and_keys,
        "category_sentiment": category_sentiment,
    }
    frames += [checks(tables[name]) for name, checks in sections.items() if tables.get(name) is not None]
    return Q.union_all(frames)


def _existence(df: DataFrame | None) -> tuple[str, str]:
    return (Q.PASS if df is not None else Q.FAIL), f"Found: {df is not None}"


# ---- exports --------------------------------------------------------------


def export_report(
    spark: SparkSession, folder: str, contracts: list[ExportContract] | None = None
) -> DataFrame:
    """Existence, size, columns and empty columns of every export (Q18)."""
    frames = []
    for contract in contracts or EXPORT_CONTRACTS:
        path = f"{folder.rstrip('/')}/{contract.file}"
        exists = files.file_exists(spark, path)
        status = Q.PASS if exists else Q.FAIL
        frames.append(Q.plain_results(spark, [(EXPORTS, contract.file, "File exists", status, path)]))
        if exists:
            frames.append(_export_checks(spark, path, contract))
    return Q.union_all(frames)


def _export_checks(spark: SparkSession, path: str, contract: ExportContract) -> DataFrame:
    header = files.header_of(spark, path)
    missing = [c for c in contract.columns if c not in header]
    # Only presence matters here, so the columns are read as text.
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    rows = files.read_csv(spark, path, text, line_breaks=contract.line_breaks)
    empty = F.array_compact(
        F.array(*[F.when(F.count(F.col(f"`{c}`")) == 0, F.lit(c)) for c in header])
    )
    figures = rows.agg(F.count("*").alias("n"), empty.alias("empty"))
    checks = [
        Check(f"Row count >= {contract.min_rows:,}", F.col("n") >= contract.min_rows, _got("n")),
        Check(
            "Required columns present",
            F.lit(not missing),
            F.lit(f"Missing: {missing}" if missing else "All present"),
        ),
        Check(
            "No fully-null columns",
            F.size("empty") == 0,
            F.when(F.size("empty") == 0, "None").otherwise(
                F.concat(F.lit("Empty cols: "), F.array_join("empty", ", "))
            ),
            warn_only=True,
        ),
    ]
    return Q.results(figures, EXPORTS, contract.file, checks)
