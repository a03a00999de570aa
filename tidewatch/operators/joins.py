"""Left joins that hold up when a few keys carry much of the data."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.estimates import SMALL_SIDE_BYTES, is_row_local, is_small
from tidewatch.session import stage

# Bounds of the share of rows that makes a key hot.
_LEAST_HOT, _MOST_HOT = 0.0001, 0.01


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    small_side_bytes: int = SMALL_SIDE_BYTES,
    hot_share: float | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Left join on one key, fan-out kept.

    A right side whose estimated size stays under ``small_side_bytes`` is
    broadcast, which needs no shuffle and so cannot be skewed. If only the
    keys of the left side are that small, the right side is first cut down to
    them. Beyond that both sides are shuffled by the key, with the rows of hot
    keys spread over ``salts`` groups.
    """
    if not is_small(right, small_side_bytes):
        right = matching(right, left.select(key), key, small_side_bytes)
    if is_small(right, small_side_bytes):
        return left.join(F.broadcast(right), key, "left")
    return salted_left_join(left, right, key, hot_share=hot_share, salts=salts)


def matching(df: DataFrame, keys: DataFrame, key: str, small_side_bytes: int = SMALL_SIDE_BYTES) -> DataFrame:
    """The rows whose key occurs in ``keys``, stored, if the keys can be broadcast; else all rows."""
    if not is_small(keys, small_side_bytes):
        return df
    return stage(df.join(F.broadcast(keys.distinct()), key, "left_semi"), "matching")


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    hot_share: float | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Shuffled left join in which no task gets all rows of a hot key.

    A side on which the key is hot scatters that key's rows over as many salts
    as its rows fill shuffle partitions, ``salts`` at most, and the other side
    repeats its rows of that key once per salt, so a pair meets at exactly one
    combination of salts. Left rows that were repeated are known to have a
    partner, so their copies without one are dropped; left rows without a key
    are scattered too, as they meet nobody. By default a key is hot if it
    would fill a shuffle partition on its own (within 0.01% and 1% of the
    rows), and ``salts`` is the number of partitions.

    Rows are scattered by their position in the input files, which copies of
    a row do not share and a retried task finds again.
    """
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = salts or partitions
    hot_share = hot_share or min(max(1 / partitions, _LEAST_HOT), _MOST_HOT)
    left, right = _stable(left), _stable(right.filter(F.col(key).isNotNull()))
    hot_left = salts_of(left, key, hot_share, salts).withColumnRenamed("_salts", "_of_left")
    hot_right = salts_of(right, key, hot_share, salts).withColumnRenamed("_salts", "_of_right")
    # At most 1/hot_share rows each.
    hot = F.broadcast(hot_left.join(hot_right, key, "full"))
    others = [c for c in right.columns if c != key]

    # Rows are numbered before they are repeated, so that copies share a number.
    numbered_left, numbered_right = (
        df.withColumn("_position", F.monotonically_increasing_id()).join(hot, key, "left") for df in (left, right)
    )
    of_left = F.when(F.col(key).isNull(), salts).otherwise(F.col("_of_left"))
    salted_left = numbered_left.select(
        *left.columns,
        F.col("_of_right").isNotNull().alias("_repeated"),
        _scatter(of_left).alias("_salt_left"),
        F.explode(_repeat(F.col("_of_right"))).alias("_salt_right"),
    )
    salted_right = numbered_right.select(
        key,
        *others,
        F.lit(True).alias("_found"),
        _scatter(F.col("_of_right")).alias("_salt_right"),
        F.explode(_repeat(F.col("_of_left"))).alias("_salt_left"),
    )
    joined = salted_left.join(salted_right, [key, "_salt_left", "_salt_right"], "left")
    kept = joined.filter(F.col("_found").isNotNull() | ~F.col("_repeated"))
    return kept.select(key, *[c for c in left.columns if c != key], *others)


def hot_keys(df: DataFrame, key: str, share: float) -> dict:
    """The keys that hold at least ``share`` of the rows with a key, ``1/share`` at most, and the share of each."""
    return {k: held for k, (held, _) in _hot_rows(df, key, share).items()}


def _hot_rows(df: DataFrame, key: str, share: float) -> dict:
    """The hot keys with their share and their rows.

    A first pass with ``1/share`` counters per task names every such key and
    perhaps some others; a second one counts the named keys.
    """
    keys = df.select(key).filter(F.col(key).isNotNull())
    named = keys.stat.freqItems([key], share).first()[0] or []
    if not named:
        return {}
    counts = keys.groupBy(F.when(F.col(key).isin(list(named)), F.col(key)).alias(key)).count().collect()
    total = sum(r["count"] for r in counts)
    hot = [r for r in counts if r[key] is not None and r["count"] >= share * total]
    return {r[key]: (r["count"] / total, r["count"]) for r in hot}


def salts_of(df: DataFrame, key: str, share: float, most: int) -> DataFrame:
    """(key, _salts) of the hot keys: one salt for each ``share`` of the rows that a key holds, ``most`` at most.

    A key has no more salts than rows, and none if that leaves it one: the other side would be repeated for nothing,
    as with a short list of names, each of which holds a large share of it.
    """
    salts = {k: min(most, math.ceil(held / share), rows) for k, (held, rows) in _hot_rows(df, key, share).items()}
    found = [(k, n) for k, n in salts.items() if n > 1]
    fields = [T.StructField(key, df.schema[key].dataType), T.StructField("_salts", T.IntegerType())]
    return df.sparkSession.createDataFrame(found, T.StructType(fields))


def _scatter(salts: Column) -> Column:
    return F.coalesce(F.pmod("_position", salts).cast("int"), F.lit(0))


def _repeat(salts: Column) -> Column:
    return F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)) - 1)


def _stable(df: DataFrame) -> DataFrame:
    """The frame, staged unless it is a row-by-row reading of files.

    Numbering rows is repeatable on files only: the order of rows that come
    out of a shuffle may differ when a task is run again.
    """
    return df if is_row_local(df) else stage(df, "join-side")
