"""Labels and model replies."""

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import text as X


@pytest.mark.parametrize(
    ("label", "wanted"),
    [
        ("Positive", "Positive"),
        ("Mixed", "Neutral"),
        ("Super recomendo", "Positive"),
        ("not recommended", "Positive"),
        ("ótimo", "Neutral"),
        ("OTIMO", "Positive"),
        ("", "Neutral"),
        ("bad but good", "Positive"),
        ("NEGATIVO", "Negative"),
        ("neutral", "Neutral"),
    ],
)
def test_normalise_label(spark, label, wanted):
    df = spark.createDataFrame([(label,)], "v string")
    assert df.select(X.normalise_label(F.col("v"))).first()[0] == wanted


def parsed(spark, reply):
    df = spark.createDataFrame([(reply,)], "r string")
    row = df.select(X.parse_reply(F.col("r")).alias("p")).first().p
    return None if row is None else [tuple(e) for e in row]


def test_plain_and_fenced_replies(spark):
    plain = '[{"id": 0, "sentiment": "Positive"}]'
    assert parsed(spark, plain) == [("0", "Positive")]
    assert parsed(spark, f"```json\n{plain}\n```") == [("0", "Positive")]
    assert parsed(spark, f"  ```\n{plain}```  \n") == [("0", "Positive")]
    assert parsed(spark, "[]") == []


@pytest.mark.parametrize(
    "reply",
    [
        "Sorry, I cannot do that.",
        '[{"id": 0, "sentiment": "Positive"}',
        '[{"id": 0}]',
        '[{"sentiment": "Positive"}]',
        '[{"id": 0, "sentiment": null}]',
        '[{"id": 0, "sentiment": 5}]',
        '{"id": 0, "sentiment": "Positive"}',
        '[{"id": 0, "sentiment": "Positive"}] as you asked',
        "[1, 2]",
        "",
        None,
    ],
)
def test_unusable_replies(spark, reply):
    assert parsed(spark, reply) is None


def label(spark, reply, position):
    df = spark.createDataFrame([(reply, position)], "r string, p int")
    return df.select(X.label_at(X.parse_reply(F.col("r")), F.col("p"))).first()[0]


def test_label_by_position(spark):
    reply = '[{"id": 1, "sentiment": "ruim"}, {"id": 0, "sentiment": "Positive"}]'
    assert [label(spark, reply, p) for p in (0, 1, 2)] == ["Positive", "Negative", "Neutral"]


def test_quoted_ids_name_nobody_and_later_labels_win(spark):
    assert label(spark, '[{"id": "0", "sentiment": "Positive"}]', 0) == "Neutral"
    twice = '[{"id": 0, "sentiment": "Positive"}, {"id": 0, "sentiment": "Negative"}]'
    assert label(spark, twice, 0) == "Negative"


def test_truncate(spark):
    df = spark.createDataFrame([("çãé" * 200,)], "v string")
    cut, whole = df.select(X.truncate(F.col("v"), 300), X.truncate(F.col("v"), None)).first()
    assert len(cut) == 300 and len(whole) == 600
