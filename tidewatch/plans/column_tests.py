"""The declared column tests of sources, staging views and marts (Q1-Q3)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tidewatch import schemas as S
from tidewatch.operators.quality import ACCEPTED, NOT_NULL, UNIQUE, ColumnTest, column_tests


def _declare(relation: str, *columns: tuple) -> list[ColumnTest]:
    """Each column is (name, kinds, values); values add an accepted-values test."""
    tests = []
    for name, kinds, *values in columns:
        tests += [ColumnTest(relation, name, kind) for kind in kinds]
        tests += [ColumnTest(relation, name, ACCEPTED, tuple(v)) for v in values]
    return tests


_KEY, _PRESENT, _ANY = (NOT_NULL, UNIQUE), (NOT_NULL,), ()

SOURCE_TESTS = [
    *_declare(
        "raw_logs",
        ("query_type", _PRESENT, S.QUERY_TYPES),
        ("target_table", _PRESENT, S.TARGET_TABLES),
        ("execution_time_ms", _PRESENT),
        ("server_cpu_load", _PRESENT),
        ("status", _ANY, S.STATUSES),
    ),
    *_declare("clean_logs", ("risk_level", _PRESENT, S.RISK_LEVELS), ("is_anomaly", _PRESENT)),
    *_declare(
        "delivery",
        ("order_id", _KEY),
        ("delivery_days", _PRESENT),
        ("is_late", _PRESENT),
        ("performance_flag", _ANY, S.PERFORMANCE_FLAGS),
        ("region", _ANY, S.REGIONS),
    ),
    *_declare(
        "sentiment",
        ("review_id", _KEY),
        ("sentiment", _PRESENT, S.SENTIMENTS),
        ("review_score", _PRESENT),
    ),
    *_declare("category_sentiment", ("sentiment", _ANY, S.SENTIMENTS)),
]
STAGING_TESTS = [
    *_declare(
        "stg_server_logs",
        ("logged_at", _PRESENT),
        ("query_type", _PRESENT, S.QUERY_TYPES),
        ("status", _ANY, S.STATUSES),
        ("execution_time_ms", _PRESENT),
        ("server_cpu_load", _PRESENT),
    ),
    *_declare(
        "stg_delivery_orders",
        ("order_id", _KEY),
        ("delivery_days", _PRESENT),
        ("performance_flag", _PRESENT, S.PERFORMANCE_FLAGS),
        ("country", _PRESENT, [S.COUNTRY]),
        ("region", _ANY, S.REGIONS),
    ),
    *_declare(
        "stg_reviews",
        ("review_id", _KEY),
        ("sentiment", _PRESENT, S.SENTIMENTS),
        ("review_score", _PRESENT),
    ),
]
MART_TESTS = [
    *_declare(
        "fct_server_health",
        ("risk_level", _PRESENT, S.RISK_LEVELS),
        ("query_count", _PRESENT),
        ("pct_of_total", _PRESENT),
        ("timeout_rate_pct", _PRESENT),
    ),
    *_declare("fct_delivery_by_state", ("customer_state", _KEY), ("avg_delivery_days", _PRESENT)),
    *_declare(
        "dim_category_sentiment",
        ("category", _KEY),
        ("dominant_sentiment", _PRESENT, S.SENTIMENTS),
    ),
]
ALL_TESTS = SOURCE_TESTS + STAGING_TESTS + MART_TESTS


def run(relations: Mapping[str, DataFrame]) -> DataFrame:
    """Results of the declared tests of the given relations."""
    return column_tests(relations, ALL_TESTS)
