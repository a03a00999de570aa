"""CSV exports of tables and marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidewatch.sources import files

TABLE_EXPORTS = {
    "raw_logs": "synthetic_sql_logs.csv",
    "clean_logs": "processed_logs.csv",
    "delivery": "delivery_analysis.csv",
    "sentiment": "enriched_customer_sentiment.csv",
    "category_sentiment": "category_sentiment.csv",
    "category_stats": "category_stats.csv",
}
MART_EXPORTS = {
    "fct_server_health": "fct_server_health.csv",
    "fct_delivery_by_state": "fct_delivery_by_state.csv",
    "dim_category_sentiment": "dim_category_sentiment.csv",
}
# Results with one row per level, state or category.
_SMALL = {"category_stats", *MART_EXPORTS}
# Exports with review texts, and the rows that one file of theirs holds at most.
_TEXTS = {"sentiment", "category_sentiment"}
ROWS_A_FILE = 20_000


def export_tables(frames: Mapping[str, DataFrame], folder: str, *, texts_compressed: bool = False) -> list[str]:
    """Write every frame that has an export name; the paths written.

    Exports with texts, which repeat a text for every item of its order, can be written as gzip files.
    """
    paths = []
    for table, file in {**TABLE_EXPORTS, **MART_EXPORTS}.items():
        if table in frames:
            path = f"{folder.rstrip('/')}/{file}"
            most = ROWS_A_FILE if table in _TEXTS else 0
            compression = "gzip" if texts_compressed and table in _TEXTS else "none"
            files.write_csv(frames[table], path, single_file=table in _SMALL, rows_a_file=most, compression=compression)
            paths.append(path)
    return paths


def column_listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The header of every export."""
    rows = [(p.rsplit("/", 1)[-1], i, c) for p in paths for i, c in enumerate(files.header_of(spark, p))]
    return spark.createDataFrame(rows, "file string, position int, column string")
