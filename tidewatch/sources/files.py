"""File and table input and output."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewatch import schemas as S
from tidewatch.session import shuffles_dropped

# Text columns hold quotes and line breaks, so a record may span lines and a
# quote inside a field is doubled.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "timestampFormat": S.TIMESTAMP_FORMAT,
}
# An empty field is NULL but a quoted empty one is a text of no characters: the
# reader tells them apart if its own mark for NULL is not the empty text.
READ_OPTIONS = {**CSV_OPTIONS, "nullValue": "\0"}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, *, line_breaks: bool = False
) -> DataFrame:
    """Read the named columns of a headed CSV file.

    Columns are matched by the header, so the file may hold others and in
    another order. ``line_breaks`` is for free text only: a file read that way
    cannot be split between tasks. Bytes that are not UTF-8 become U+FFFD.
    """
    reader = spark.read.options(**READ_OPTIONS, multiLine=str(line_breaks).lower())
    declared = {f.name: f for f in schema.fields}
    header = header_of(spark, path)
    missing = [name for name in declared if name not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    in_file_order = [declared.get(name, T.StructField(name, T.StringType())) for name in header]
    return reader.schema(T.StructType(in_file_order)).csv(path).select(*declared)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Read a CSV file with inferred types; for checks of exports only."""
    return spark.read.options(**READ_OPTIONS, multiLine="true", inferSchema="true").csv(path)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, without reading its rows."""
    return spark.read.options(**READ_OPTIONS).csv(path).columns


def write_csv(
    df: DataFrame, path: str, *, single_file: bool = False, rows_a_file: int = 0, compression: str = "none"
) -> None:
    """Write a headed CSV directory.

    ``single_file`` is for results of a fixed size, such as the marts;
    ``rows_a_file``, if not 0, is for free text, whose files are read by one
    task each. So are compressed ones.
    """
    out = df.coalesce(1) if single_file else df
    options = {**CSV_OPTIONS, "maxRecordsPerFile": rows_a_file, "compression": compression}
    with shuffles_dropped(df.sparkSession):
        out.write.mode("overwrite").options(**options).csv(path)


def file_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system it names."""
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()).exists(hadoop_path)


# ---- tables ---------------------------------------------------------------


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Replace a managed table with a frame and return the stored table.

    A table that is there is written anew beside itself and given up only when
    the new one is whole, by renaming both: a job that fails leaves the old
    rows, and the frame may read the very table that it replaces. Readers may
    find no table between the two renames.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.write.format("parquet").saveAsTable(name)
        return spark.table(name)
    mark = uuid.uuid4().hex
    beside, former = f"{name}_beside_{mark}", f"{name}_former_{mark}"
    try:
        df.write.format("parquet").saveAsTable(beside)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
        raise
    spark.sql(f"ALTER TABLE {name} RENAME TO {former}")
    try:
        spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {former} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {former}")
    return spark.table(name)


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def table_names(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the tables and views of a database; of the session's own views too if none is named."""
    listed = spark.catalog.listTables(database)
    return sorted(t.name for t in listed if not (database and t.isTemporary))


def require_table(spark: SparkSession, name: str, made_by: str) -> DataFrame:
    """A table, or an error that names the job that makes it."""
    if not spark.catalog.tableExists(name):
        raise RuntimeError(f"table {name} is missing; run {made_by} first")
    return spark.table(name)


def table_if_exists(spark: SparkSession, name: str) -> DataFrame | None:
    try:
        return spark.table(name) if spark.catalog.tableExists(name) else None
    except AnalysisException:
        return None
