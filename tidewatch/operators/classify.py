"""Batched text classification through an external model."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions.text import INSTRUCTIONS, REQUEST, label_at, parse_reply, prompt_line
from tidewatch.operators.estimates import spread
from tidewatch.operators.selection import indexed

BATCH = 10

# A provider takes (instructions, request) and returns the model's reply. It is
# called on the executors, so it must be picklable; a client with a connection
# should be opened inside the call.
Provider = Callable[[str, str], str]


def stem_provider(instructions: str, request: str) -> str:
    """A stand-in for a model: labels each numbered review by word stems."""
    _, *parts = re.split(r"^\[(\d+)\] ", request.removeprefix(REQUEST), flags=re.MULTILINE)
    numbered = zip(parts[::2], parts[1::2])
    return json.dumps([{"id": int(i), "sentiment": _stem_label(text)} for i, text in numbered])


def _stem_label(text: str) -> str:
    lowered = text.lower()
    for label, stems in (("Positive", S.POSITIVE_STEMS), ("Negative", S.NEGATIVE_STEMS)):
        if any(stem in lowered for stem in stems):
            return label
    return "Neutral"


def classify(
    df: DataFrame,
    provider: Provider = stem_provider,
    text: str = "review_comment_message",
    *,
    batch: int = BATCH,
    max_chars: int | None = None,
    tasks: int | None = None,
    key: str | None = None,
) -> DataFrame:
    """Adds ``sentiment`` and ``is_error`` to every row.

    Rows are sent in batches as they lie in their partition, so nothing is
    shuffled (unless a small file would keep all but one core idle) and only
    the text travels to Python. A batch whose call fails or
    whose reply cannot be used is Neutral with ``is_error`` set. ``max_chars``
    cuts long texts for models with a small context; ``tasks`` caps the calls
    in flight. Store the result before using it twice, or the calls repeat.

    With ``key`` the rows are numbered in drawing order first and a batch is
    ``batch`` neighbours in it, so labels do not depend on partitions; each
    batch is asked and its reply parsed once.
    """
    if key is not None:
        return _classify_numbered(df, provider, text, batch, max_chars, tasks, key)

    @F.pandas_udf("position int, reply string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.concat(
                [_ask_one(provider, texts.iloc[i : i + batch], max_chars) for i in range(0, len(texts), batch)],
                ignore_index=True,
            ) if len(texts) else pd.DataFrame({"position": [], "reply": []})

    rows = spread(df) if tasks is None else df.coalesce(tasks)
    asked = rows.withColumn("_asked", ask.asNondeterministic()(F.col(text)))
    parsed = asked.withColumn("_parsed", parse_reply(F.col("_asked.reply")))
    return labelled(parsed, "_parsed", "_asked.position").drop("_asked", "_parsed")


def _classify_numbered(
    df: DataFrame, provider: Provider, text: str, batch: int, max_chars: int | None, tasks: int | None, key: str
) -> DataFrame:
    @F.pandas_udf("string")
    def ask(batches: pd.Series) -> pd.Series:
        return pd.Series([_ask_one(provider, pd.Series(texts), max_chars)["reply"].iloc[0] for texts in batches], dtype=object)

    numbered = indexed(df, key, name="_at")
    rows = F.array_sort(F.collect_list(F.struct("_at", F.struct(*df.columns).alias("_row"))))
    # A batch holds ``batch`` rows at most, as numbers are unique and gapless.
    batches = numbered.groupBy(F.floor(F.col("_at") / batch).alias("_batch")).agg(rows.alias("_rows"))
    if tasks is not None:
        batches = batches.coalesce(tasks)
    asked = batches.withColumn("_reply", ask.asNondeterministic()(F.transform("_rows", lambda r: r["_row"][text])))
    parsed = asked.withColumn("_parsed", parse_reply(F.col("_reply")))
    placed = parsed.select("_parsed", F.posexplode("_rows").alias("_position", "_each"))
    return labelled(placed.select("_parsed", "_position", "_each._row.*"), "_parsed", "_position").drop("_parsed", "_position")


def _ask_one(provider: Provider, texts: pd.Series, max_chars: int | None) -> pd.DataFrame:
    try:
        lines = [f"[{i}] {t[:max_chars]}" for i, t in enumerate(texts)]
        reply = provider(INSTRUCTIONS, REQUEST + "\n".join(lines))
    except Exception:  # a failed call is data: its rows are marked, the job goes on
        reply = None
    if not isinstance(reply, str):
        reply = None
    return pd.DataFrame({"position": range(len(texts)), "reply": [reply] * len(texts)})


def labelled(df: DataFrame, parsed: str, position: str) -> DataFrame:
    """Label and error mark of each row from the parsed reply of its batch."""
    return df.withColumn("sentiment", label_at(F.col(parsed), F.col(position))).withColumn(
        "is_error", F.col(parsed).isNull()
    )


def requests(
    df: DataFrame, batch_id: str, order: str, text: str, max_chars: int | None = None, *, most: int = BATCH
) -> DataFrame:
    """The request of every batch (P35), which holds ``most`` rows at most.

    A batch of more is an error, found by counting per batch before any text
    is gathered, so no group of unbounded size is ever built.
    """
    counts = df.groupBy(batch_id).agg(F.count("*").alias("_n"))
    large = F.concat(F.lit("batch "), F.col(batch_id).cast("string"), F.lit(" has "), F.col("_n"), F.lit(f" rows, limit {most}"))
    checked = counts.select(
        F.col(batch_id).alias("_of"), F.when(F.col("_n") > most, F.raise_error(large)).otherwise(F.col("_n")).alias("_n")
    )
    bounded = df.join(checked, F.col(batch_id).eqNullSafe(F.col("_of")))
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(text).alias("text"))))
    lines = F.transform("_rows", lambda r, i: prompt_line(i, r["text"], max_chars))
    return (
        bounded.groupBy(batch_id)
        .agg(rows.alias("_rows"), F.max("_n").alias("_n"))
        .select(
            batch_id,
            F.col("_n").alias("reviews"),
            F.concat(F.lit(REQUEST), F.array_join(lines, "\n")).alias("request"),
        )
    )


def apply_replies(rows: DataFrame, replies: DataFrame, batch_id: str, position: str, reply: str) -> DataFrame:
    """Labels for rows from recorded replies, one per batch."""
    parsed = replies.select(batch_id, parse_reply(F.col(reply)).alias("_parsed"))
    return labelled(rows.join(parsed, batch_id, "left"), "_parsed", position).drop("_parsed")


def accepted(classified: DataFrame) -> DataFrame:
    """Rows with a real classification."""
    return classified.filter(~F.col("is_error")).drop("is_error")


def rejected(classified: DataFrame) -> DataFrame:
    """Rows whose batch failed."""
    return classified.filter("is_error")
