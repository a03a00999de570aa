"""Figures of a binary classifier from weighted predictions (M4-M7).

A frame of predictions has a 0/1 label, a 0/1 prediction, a score and a whole
number of rows that each of its rows stands for. Everything is counted by
class or by distinct score first; nothing is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ranks import running

# The names of the two classes in reports.
CLASSES = ((0, "Normal CPU"), (1, "High CPU"))
_WIDE = "decimal(38,0)"


def roc_auc(df: DataFrame, score: str, label: str, weight: str) -> DataFrame:
    """One row: ``roc_auc``, exact, ties counting half; NULL without both classes (M5).

    Rows are counted per distinct score; the negatives below each score are
    running sums over ranges of scores.
    """
    is_high = F.col(label) == 1
    counts = (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        # Minus zero counts as zero.
        .groupBy((F.col(score).cast("double") + F.lit(0.0)).alias("score"))
        .agg(
            F.sum(F.when(is_high, F.col(weight)).otherwise(0)).cast(_WIDE).alias("high"),
            F.sum(F.when(is_high, 0).otherwise(F.col(weight))).cast(_WIDE).alias("low"),
        )
    )
    placed = running(counts.withColumn("all", F.lit(0)), ["all"], "score", "low")
    won = F.col("high").cast("double") * (2 * F.col("before") + F.col("low")).cast("double")
    sums = placed.agg(F.sum(won).alias("won"), F.sum("high").cast("double").alias("high"), F.sum("low").cast("double").alias("low"))
    return sums.select(F.try_divide("won", 2 * F.col("high") * F.col("low")).alias("roc_auc"))


def accuracy(label: str, predicted: str, weight: str) -> Column:
    """The weighted share of right predictions (M6)."""
    right = F.sum(F.when(F.col(label) == F.col(predicted), F.col(weight)).otherwise(0))
    return F.try_divide(right.cast("double"), F.sum(weight).cast("double"))


def confusion(df: DataFrame, label: str, predicted: str, weight: str) -> DataFrame:
    """Rows per actual (row) and predicted (column) class (M7)."""
    cells = df.groupBy(F.col(label).alias("actual")).pivot(predicted, [0, 1])
    return (
        cells.agg(F.sum(weight).cast("long"))
        .na.fill(0)
        .select("actual", F.col("0").alias("predicted_normal"), F.col("1").alias("predicted_high"))
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def class_report(df: DataFrame, label: str, predicted: str, weight: str) -> DataFrame:
    """Precision, recall, F1 and support per class and averaged (M4)."""

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0)).cast("long")

    sums = []
    for value, name in CLASSES:
        actual, said = F.col(label) == value, F.col(predicted) == value
        sums.append(
            F.struct(
                F.lit(name).alias("class"),
                total(actual & said).alias("hits"),
                total(said).alias("claimed"),
                total(actual).alias("support"),
            )
        )
    classes = df.agg(F.array(*sums).alias("classes")).select(F.inline("classes"))
    scored = classes.select(
        "class",
        _ratio(F.col("hits"), F.col("claimed")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        "support",
    ).withColumn(
        "f1",
        _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
    )
    measures = ["precision", "recall", "f1"]
    macro = scored.agg(*[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support"))
    weighted = scored.agg(
        *[_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    rows = scored.unionByName(macro.withColumn("class", F.lit("macro avg")))
    rows = rows.unionByName(weighted.withColumn("class", F.lit("weighted avg")))
    return rows.select("class", *measures, F.col("support").cast("long").alias("support"))
