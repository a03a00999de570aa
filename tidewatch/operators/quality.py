"""Checks on tables: one pass per table, results as rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas as S

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"

NOT_NULL, UNIQUE, ACCEPTED = "not_null", "unique", "accepted_values"


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def count_if(condition: Column) -> Column:
    """Rows for which the condition holds; unknown does not count."""
    return F.count_if(condition)


def outside(column: str, allowed: Sequence[str]) -> Column:
    """Whether a value is none of the allowed ones, NULL included."""
    return F.coalesce(~F.col(column).isin(list(allowed)), F.lit(True))


def nulls_in(*columns: str) -> Column:
    """Whether any of the columns is NULL."""
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def rate(condition: Column) -> Column:
    """Share of all rows for which the condition holds."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


# ---- declared column tests ------------------------------------------------


@dataclass(frozen=True)
class ColumnTest:
    relation: str
    column: str
    kind: str
    allowed: tuple[str, ...] = ()


def column_tests(relations: Mapping[str, DataFrame], tests: Sequence[ColumnTest]) -> DataFrame:
    """Offending rows (offending values, for ``unique``) and status of every test (Q1-Q3).

    Every relation is read once. A row gives one entry per key that is to be
    unique and one per test that it fails, (number of the test, key), the key
    NULL for tests of rows and NULL keys left out. All relations share one
    aggregate of these entries: copies of a key, and all rows that fail a
    test, meet on the map side, so only distinct keys move. Keys are of atomic
    types.
    """
    declared = [t for t in tests if t.relation in relations]
    frames = []
    for relation, df in relations.items():
        own = [_entry(i, t) for i, t in enumerate(declared) if t.relation == relation]
        if own:
            frames.append(df.select(F.explode(F.array(*own)).alias("e")).where("e IS NOT NULL").select("e.*"))
    spark = next(iter(relations.values())).sparkSession
    names = [(i, t.relation, t.column, t.kind) for i, t in enumerate(declared)]
    listed = spark.createDataFrame(names, "number int, relation string, column string, test string")
    if not frames:
        frames = [listed.limit(0).select("number", F.lit(None).cast("string").alias("key"))]
    copies = union_all(frames).groupBy("number", "key").agg(F.count("*").alias("n"))
    failed = F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise((F.col("n") > 1).cast("long")))
    counted = copies.groupBy("number").agg(failed.alias("found"))  # a row per test that any row has an entry of
    failures = F.coalesce("found", F.lit(0).cast("long"))
    return (
        listed.join(F.broadcast(counted), "number", "left")
        .withColumn("failures", failures)
        .select("relation", "column", "test", "failures", F.when(failures == 0, PASS).otherwise(FAIL).alias("status"))
    )


def _entry(number: int, test: ColumnTest) -> Column:
    """What a row says about a test: its key, or that it fails, or nothing."""
    column = F.col(test.column)
    key = column.cast("string") if test.kind == UNIQUE else F.lit(None).cast("string")
    says = {
        UNIQUE: column.isNotNull(),
        NOT_NULL: column.isNull(),
        ACCEPTED: ~column.isin(list(test.allowed)),
    }[test.kind]
    return F.when(says, F.struct(F.lit(number).alias("number"), key.alias("key")))


# ---- contract checks ------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A named condition over the figures of a table, with a text that tells them."""

    name: str
    passed: Column
    detail: Column
    warn_only: bool = False


def result_rows(phase: str, table: str, checks: Sequence[Check]) -> Column:
    """The results of checks as an array, to be built where their figures are."""
    rows = [
        F.struct(
            F.lit(phase).alias("phase"),
            F.lit(table).alias("table"),
            F.lit(check.name).alias("check"),
            F.when(F.coalesce(check.passed, F.lit(False)), PASS)
            .otherwise(WARN if check.warn_only else FAIL)
            .alias("status"),
            check.detail.alias("detail"),
        )
        for check in checks
    ]
    return F.array(*rows)


def results(figures: DataFrame, phase: str, table: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check from a one-row frame of figures (Q4)."""
    return figures.select(result_rows(phase, table, checks).alias("r")).select(F.inline("r"))


def plain_results(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Results that are known without reading any data."""
    return spark.createDataFrame(list(rows), S.CHECK_RESULTS)


def exists_result(spark: SparkSession, phase: str, table: str, found: bool) -> DataFrame:
    """Whether a table is there (Q5)."""
    return plain_results(spark, [(phase, table, "Table exists", PASS if found else FAIL, f"Found: {found}")])


def grouped_number(value: Column) -> Column:
    """15000 as '15,000'."""
    return F.format_number(value, 0)


def as_percent(share: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", share * 100)


def totals(checked: DataFrame) -> DataFrame:
    """Number of results per status, statuses that do not occur included (Q19)."""
    counts = [count_if(F.col("status") == s).alias(s.lower()) for s in (PASS, WARN, FAIL)]
    return checked.agg(F.count("*").alias("checks"), *counts)


def report_lines(checked: DataFrame) -> list[str]:
    """The report as text: every check, the totals, then failures and warnings (Q19)."""
    rows = checked.collect()  # a fixed list of checks, not data
    lines = [f"{r.phase:<14} {r.table:<32} {r.check:<44} {r.status:<6} {r.detail}" for r in rows]
    lines.append(f"{len(rows)} checks")
    for status in (PASS, WARN, FAIL):
        lines.append(f"{status}: {sum(r.status == status for r in rows)}")
    for status in (FAIL, WARN):
        lines += [f"{r.status} {r.phase} / {r.table}: {r.check}: {r.detail}" for r in rows if r.status == status]
    return lines


def require_no_failures(checked: DataFrame) -> None:
    failed = [f"{r.table}: {r.check} ({r.detail})" for r in checked.filter(F.col("status") == FAIL).collect()]
    if failed:
        raise RuntimeError("failed checks: " + "; ".join(failed))


# ---- profiles -------------------------------------------------------------


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """NULLs per column, and whether a column holds nothing else, in one pass."""
    rows = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(c).alias("column"),
            F.count("*").alias("rows"),
            count_if(F.col(c).isNull()).alias("nulls"),
            (F.count(c) == 0).alias("is_empty"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def duplicates(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows against distinct keys (Q15)."""
    return df.agg(
        F.lit(table).alias("table"),
        F.lit(key).alias("key"),
        F.count("*").alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
        (F.count("*") - F.count_distinct(key)).alias("duplicates"),
    )
