"""Exact samples, splits and quantiles without a global sort."""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewatch.functions.hashing import BITS, hash_rank
from tidewatch.functions.scalar import round_half_away

_BUCKET_BITS = 16
_VALUE_BUCKETS = 4096
_RANGE_ROWS = 100_000
_NUMBERED_ROWS = 1_000  # whole rows that are numbered together
_COPIES = 4096


def _narrowed(
    rows: DataFrame, group: str, fixed: list[str], digits: list[str], quota: Callable[[Column], Column] | None = None
) -> pa.Table:
    """Per group, the value of ``digits`` that holds the wanted row, how many rows are wanted of it, and its size.

    Without a quota, ``_take`` of the rows says how many of the group's rows are wanted. Rows are counted per value
    before they are shuffled, and only these counts pass a window. The result has one row per group and is brought to
    the driver, so that no step is computed twice.
    """
    wanted = [] if quota else [F.first("_take").alias("_take")]
    counts = rows.groupBy(group, *fixed, *digits).agg(F.count("*").alias("_n"), *wanted)
    per_group = Window.partitionBy(group)
    upto = F.sum("_n").over(per_group.orderBy(*digits))
    take = quota(F.sum("_n").over(per_group)).cast("long") if quota else F.col("_take")
    running = counts.select(group, *fixed, *digits, "_n", take.alias("_take"), upto.alias("_upto"))
    before = F.col("_upto") - F.col("_n")
    edges = running.filter((before < F.col("_take")) & (F.col("_take") <= F.col("_upto")))
    edges = edges.select(group, *fixed, *digits, (F.col("_take") - before).alias("_take"), "_n")
    return edges.toArrow()


def _refined(placed: DataFrame, edges: pa.Table, group: str, fixed: list[str], digits: list[str]) -> pa.Table:
    """The edges with further digits: one after the other, or all at once where no range has over ``_RANGE_ROWS`` rows."""
    while digits and edges.num_rows:
        step = digits if pc.max(edges["_n"]).as_py() <= _RANGE_ROWS else digits[:1]
        held = placed.sparkSession.createDataFrame(edges.drop_columns(["_n"]))
        rows = placed.select(group, *fixed, *step).join(F.broadcast(held), [group, *fixed])
        edges = _narrowed(rows, group, fixed, step)
        fixed, digits = [*fixed, *step], digits[len(step) :]
    return edges


def _placed(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows with the digits of their place in drawing order: a hash of the key, the key, a hash of all columns.

    A hash has no order of its own to keep, so its digits are compared as they are cut.
    """
    rank, content = hash_rank(df, key, seed), F.xxhash64(*_hashable(df))
    return df.withColumns(
        {
            "_high": F.coalesce(F.shiftright(rank, BITS - _BUCKET_BITS), F.lit(-1)).cast("long"),
            "_low": F.coalesce(rank % 2 ** (BITS - _BUCKET_BITS), F.lit(-1)).cast("long"),
            "_key": F.struct(F.col(key).alias("k")),
            "_first": F.shiftrightunsigned(content, 48),
            "_second": F.shiftrightunsigned(content, 32) % 2**16,
            "_rest": F.shiftrightunsigned(F.shiftleft(content, 32), 32),
        }
    )


_KEY_DIGITS = ["_high", "_low", "_key"]
_CONTENT_DIGITS = ["_first", "_second", "_rest"]
_DIGITS = [*_KEY_DIGITS, *_CONTENT_DIGITS]


def _hashable(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in df.columns if "map<" not in df.schema[c].dataType.simpleString()]


def rank_cuts(df: DataFrame, key: str, seed: int, group: str, quota: Callable[[Column], Column]) -> pa.Table:
    """Per group, the place of the last row among the first ``quota(group size)``, and ``_take`` rows of that place.

    The place is found digit by digit, as in a radix sort that follows one branch: counts per value of a digit show
    which value holds the row, and only rows with that value are counted by the next one, until few are left. The
    digits of the hashes have at most 65,536 values, the keys of one hash value are few, and no row passes a window.
    Where the cut falls between two keys, the place ends with the key, ``_take`` is NULL and no other column is read;
    else rows of that key, however many, are told apart by their content in the same way. Equal rows stay together:
    ``_take`` says how many of them are wanted.
    """
    placed = _placed(df, key, seed)
    edges = _narrowed(placed.select(group, "_high"), group, [], ["_high"], quota)
    edges = _refined(placed, edges, group, ["_high"], _KEY_DIGITS[1:])
    split = pc.less(edges["_take"], edges["_n"])
    inside = _refined(placed, edges.filter(split), group, _KEY_DIGITS, _CONTENT_DIGITS)
    whole = edges.filter(pc.invert(split)).drop_columns(["_take", "_n"])
    for name in (*_CONTENT_DIGITS, "_take"):
        whole = whole.append_column(name, pa.nulls(whole.num_rows, pa.int64()))
    if inside.num_rows:
        whole = pa.concat_tables([whole, inside.select(whole.column_names).cast(whole.schema)])
    return whole


def _with_cut(df: DataFrame, cuts: pa.Table, key: str, seed: int, group: str) -> DataFrame:
    """The rows with the mark ``_chosen``; a group without a cut has none.

    Only rows equal to the one at the cut move: they are counted, and as many come back as there were, in blocks that
    are dealt to tasks by their number.
    """
    if not cuts.num_rows:
        return df.withColumn("_chosen", F.lit(False))
    # One row per group: the strata of a class label, or a single one.
    has_ties = cuts["_take"].null_count < cuts.num_rows
    schema = _placed(df, key, seed).select(group, *_DIGITS, F.lit(0).cast("long").alias("_take")).schema
    places = df.sparkSession.createDataFrame(cuts, T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
    cuts = places.select(group, F.struct(*_DIGITS).alias("_cut"), "_take")
    placed = _placed(df, key, seed).join(F.broadcast(cuts), group, "left")

    def compared(digits: list[str]) -> tuple[Column, Column]:
        return F.struct(*digits), F.struct(*[F.col(f"_cut.{d}").alias(d) for d in digits])

    key_place, key_cut = compared(_KEY_DIGITS)
    by_key = F.coalesce(key_place <= key_cut, F.lit(False))
    if not has_ties:
        return placed.select(*df.columns, by_key.alias("_chosen"))
    place, cut = compared(_DIGITS)
    at_cut = F.coalesce(F.col("_take").isNotNull() & (place == cut), F.lit(False))
    chosen = F.when(F.col("_take").isNull(), by_key).otherwise(place < cut)
    clear = placed.filter(~at_cut).select(*df.columns, chosen.alias("_chosen"))
    tied = placed.filter(at_cut).groupBy(*df.columns).agg(F.count("*").alias("_n"), F.first("_take").alias("_take"))
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / _COPIES)))
    blocks = tied.withColumn("_block", block).repartition(F.col("_block"))
    first = F.col("_block") * _COPIES
    last = F.least(first + _COPIES, F.col("_n")) - 1
    copies = blocks.withColumn("_nth", F.explode(F.sequence(first, last)))
    return clear.unionByName(copies.select(*df.columns, (F.col("_nth") < F.col("_take")).alias("_chosen")))


def sample_exact(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), the same ones in every run."""
    whole = df.withColumn("_all", F.lit(0))
    cuts = rank_cuts(whole, key, seed, "_all", lambda size: F.least(F.lit(n), size))
    return _with_cut(whole, cuts, key, seed, "_all").filter("_chosen").select(df.columns)


def indexed(rows: DataFrame, key: str, seed: int = 42, name: str = "row_idx") -> DataFrame:
    """The rows numbered from 0 in drawing order, whatever their partitions.

    Rows are counted per hash range; each range starts where the ones before
    it end and is numbered by itself. Ranges hold about ``_NUMBERED_ROWS`` rows,
    so their number follows the table, and tasks have many of them each. Their counts are summed over groups of
    ranges first, so no window sees more than the root of that number. Rows
    that share a key are ordered by a hash of all their columns.
    """
    bits = min(BITS, max(0, rows.count() // min(_NUMBERED_ROWS, _RANGE_ROWS)).bit_length())
    ranked = rows.select("*", hash_rank(rows, key, seed).alias("_rank"), F.xxhash64(*_hashable(rows)).alias("_content"))
    ranked = ranked.withColumn("_range", F.shiftright("_rank", BITS - bits).cast("long"))
    counts = ranked.groupBy("_range").agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_upper", F.shiftright("_range", bits // 2))
    uppers = counts.groupBy("_upper").agg(F.sum("_n").alias("_upper_n"))
    ahead = F.sum("_upper_n").over(Window.partitionBy(F.lit(0)).orderBy("_upper")) - F.col("_upper_n")
    within = F.sum("_n").over(Window.partitionBy("_upper").orderBy("_range")) - F.col("_n")
    starts = counts.withColumn("_within", within).join(uppers.select("_upper", ahead.alias("_ahead")), "_upper")
    starts = starts.select("_range", (F.col("_ahead") + F.col("_within")).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("_range").orderBy("_rank", key, "_content"))
    placed = ranked.join(starts, "_range").withColumn(name, (F.col("_start") + nth - 1).cast("long"))
    return placed.select(*rows.columns, name)


def split_stratified(
    df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Adds ``is_test``: in each label exactly ``test_share`` of the rows, rounded.

    Labels are a handful of classes; the rows themselves are not moved.
    """
    cuts = rank_cuts(df, key, seed, label, lambda size: round_half_away(size * F.lit(test_share)))
    chosen = _with_cut(df, cuts, key, seed, label)
    return chosen.select(*df.columns, F.col("_chosen").alias("is_test"))


def exact_quantile(df: DataFrame, column: str, q: float) -> float | None:
    """The interpolated quantile of a column, exact at any size (M13); NaN counts as missing, like NULL.

    Each pass counts the rows in 4,096 slices of the value range and narrows
    the range to the slice that holds the wanted rank, until both neighbours
    of the rank are known. Every pass reads the one column, so the frame
    should be stored. At most 4,096 rows reach the driver.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    n, low, high = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    position = q * (n - 1)
    rank, weight = math.floor(position), position - math.floor(position)
    next_rank = min(rank + 1, n - 1)
    skipped = 0
    while low < high:
        slices = _slices(values, low, high)
        first = second = None
        upto = skipped
        for count, least, most in slices:
            before, upto = upto, upto + count
            if first is None and rank < upto:
                first = (before, least, most)
            if next_rank < upto:
                second = (before, least, most)
                break
        if first != second:
            # The two ranks are neighbours across a slice border.
            return _between(first[2], second[1], weight)
        skipped, low, high = first
    return low


def _slices(values: DataFrame, low: float, high: float) -> list[tuple[int, float, float]]:
    place = F.floor((F.col("v") - low) / F.lit(high - low) * _VALUE_BUCKETS)
    return [
        (row.n, row.least, row.most)
        for row in values.filter(F.col("v").between(low, high))
        .groupBy(F.least(place, F.lit(_VALUE_BUCKETS - 1)).alias("slice"))
        .agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
        .orderBy("slice")
        .collect()
    ]


def _between(a: float, b: float, weight: float) -> float:
    return a + (b - a) * weight
