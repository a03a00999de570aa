"""Labels, prompts and model replies as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import schemas as S

# The wording of a request to the model.
INSTRUCTIONS = (
    "You are a sentiment classifier for Brazilian e-commerce reviews written in Portuguese.\n"
    "For each review, classify the sentiment as exactly one of: Positive, Neutral, or Negative.\n"
    "  Positive — customer is happy, satisfied, or recommending\n"
    "  Negative — customer is unhappy, complaining, or warning\n"
    "  Neutral  — mixed feelings, very short, or unclear text\n"
    "Respond ONLY with a JSON array — no markdown, no explanation:\n"
    '[{"id": 0, "sentiment": "Positive"}, {"id": 1, "sentiment": "Negative"}, ...]'
)
REQUEST = "Classify these reviews:\n\n"

def truncate(text: Column, length: int | None) -> Column:
    """The first ``length`` characters, or the whole text."""
    return text if length is None else F.substring(text, 1, length)


def normalise_label(label: Column) -> Column:
    """One of the three sentiments for any label.

    A valid label stays. Otherwise a positive stem anywhere in the label
    wins over a negative one, and a label with neither is Neutral.
    """
    lowered = F.lower(label)
    return (
        F.when(label.isin(S.SENTIMENTS), label)
        .when(lowered.rlike("|".join(S.POSITIVE_STEMS)), "Positive")
        .when(lowered.rlike("|".join(S.NEGATIVE_STEMS)), "Negative")
        .otherwise("Neutral")
    )


def strip_fence(reply: Column) -> Column:
    """Drop a Markdown fence around a reply.

    The characters of the opening fence are stripped as a set, like those of
    the closing one, and white space around both.
    """
    blank = F.lit(" \t\r\n\f\v")
    opened = F.ltrim(F.trim(reply, blank), F.lit("`json"))
    return F.trim(F.rtrim(opened, F.lit("`")), blank)


def parse_reply(reply: Column) -> Column:
    """Array of (id, sentiment) in a reply, NULL if it cannot be used.

    Ids are kept as JSON text, so a quoted id names no review. An element
    without an id or without a text as its sentiment spoils the whole reply,
    and so does anything after the array.
    """
    text = strip_fence(reply)
    value = F.when(text.endswith("]"), F.try_parse_json(text))
    elements = F.try_variant_get(value, "$", "array<variant>")
    parsed = F.transform(
        elements,
        lambda e: F.struct(
            F.to_json(F.try_variant_get(e, "$.id", "variant")).alias("id"),
            F.try_variant_get(e, "$.sentiment", "variant").alias("sentiment"),
        ),
    )
    sound = F.forall(parsed, lambda p: p["id"].isNotNull() & (F.schema_of_variant(p["sentiment"]) == "STRING"))
    named = F.transform(
        parsed, lambda p: F.struct(p["id"].alias("id"), p["sentiment"].cast("string").alias("sentiment"))
    )
    return F.when(sound, named)


def label_at(parsed: Column, position: Column) -> Column:
    """Sentiment of the review at a position; one that the reply skips is Neutral.

    If the reply names a position twice, the later label counts.
    """
    own = F.filter(parsed, lambda p: p["id"] == position.cast("string"))
    return F.coalesce(normalise_label(F.try_element_at(own, F.lit(-1))["sentiment"]), F.lit("Neutral"))


def prompt_line(position: Column, text: Column, max_chars: int | None = None) -> Column:
    return F.concat(F.lit("["), position.cast("string"), F.lit("] "), truncate(text, max_chars))
