"""Running counts and exact quantiles of many groups at once.

Rows are counted per (group, value) first. These counts are dealt to tasks by
range of (group, value), so a group with very many values fills many tasks;
what comes before a value is the sum of its group's earlier ranges, of which
there is one row each, and of its own range before it. All ranks of all groups
are read off one pass over the stored counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.session import stage


def running(counts: DataFrame, groups: Sequence[str], value: str, n: str) -> DataFrame:
    """The counts, one row per (group, value), stored, with ``before``: the sum of ``n`` over the group's smaller values.

    NULL is a group like any other; a NULL value comes before all others.
    """
    # Stored, so that a row's range is the same in every pass and after a retry.
    ranged = stage(counts.repartitionByRange(*groups, value).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy(*groups, "_range").agg(F.sum(n).alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_range")) - F.col("_n")
    starts = totals.select(*[F.col(g).alias(f"_group_{g}") for g in groups], F.col("_range").alias("_of"), earlier.alias("_start"))
    within = F.sum(n).over(Window.partitionBy(*groups, "_range").orderBy(value)) - F.col(n)
    same = [F.col(g).eqNullSafe(F.col(f"_group_{g}")) for g in groups]
    placed = ranged.withColumn("_within", within).join(starts, [F.col("_range") == F.col("_of"), *same])
    return placed.select(*counts.columns, (F.col("_start") + F.col("_within")).cast(counts.schema[n].dataType).alias("before"))


def totals(placed: DataFrame, groups: Sequence[str], n: str) -> DataFrame:
    """``placed`` with the group's sum of ``n`` as ``total``."""
    sums = placed.groupBy(*[F.col(g).alias(f"_group_{g}") for g in groups]).agg(F.sum(n).alias("total"))
    same = [F.col(g).eqNullSafe(F.col(f"_group_{g}")) for g in groups]
    return placed.join(sums, same).drop(*[f"_group_{g}" for g in groups])


def quantile(q: float, value: str, n: str) -> Column:
    """Aggregate over a group's rows with ``before`` and ``total``: the interpolated quantile of its values."""
    position = (F.col("total") - 1) * F.lit(q)
    low, high = F.floor(position), F.ceil(position)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col(n)), F.col(value)))

    weight = F.max(position - low)
    return at(low) + (at(high) - at(low)) * weight


def grouped_quantiles(
    counts: DataFrame, groups: Sequence[str], value: str, n: str, quantiles: dict[str, float]
) -> DataFrame:
    """One row per group with the named quantiles of its non-NULL values, each counted ``n`` times."""
    known = counts.filter(F.col(value).isNotNull() & (F.col(n) > 0))
    placed = totals(running(known, groups, value, n), groups, n)
    return placed.groupBy(*groups).agg(*[quantile(q, value, n).alias(name) for name, q in quantiles.items()])
