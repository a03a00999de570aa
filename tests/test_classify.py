"""Batched classification with working, failing and misbehaving providers."""

import json
import re
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidewatch.functions.text import INSTRUCTIONS, REQUEST
from tidewatch.operators import classify as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def ids_in(request):
    return [int(i) for i in re.findall(r"^\[(\d+)\] ", request.removeprefix(REQUEST), re.MULTILINE)]


def always_positive(instructions, request):
    assert instructions == INSTRUCTIONS and request.startswith(REQUEST)
    return json.dumps([{"id": i, "sentiment": "Positive"} for i in ids_in(request)])


def fails_on_bad_batches(instructions, request):
    if "poison" in request:
        raise RuntimeError("model is down")
    return always_positive(instructions, request)


def skips_the_first(instructions, request):
    return json.dumps([{"id": i, "sentiment": "ruim"} for i in ids_in(request)[1:]])


def counts_per_request(instructions, request):
    label = "Positive" if len(ids_in(request)) <= 10 else "Negative"
    return json.dumps([{"id": i, "sentiment": label} for i in ids_in(request)])


def tells_length(instructions, request):
    lines = request.removeprefix(REQUEST).split("\n")
    labels = ["Positive" if len(line) > 304 else "Negative" for line in lines]
    return json.dumps([{"id": i, "sentiment": label} for i, label in enumerate(labels)])


@pytest.fixture
def texts(spark):
    return spark.range(25).select("id", F.concat(F.lit("text "), "id").alias("review_comment_message")).coalesce(1)


def test_every_row_is_labelled(texts):
    rows = C.classify(texts, always_positive).collect()
    assert len(rows) == 25 and all(r.sentiment == "Positive" and not r.is_error for r in rows)
    assert {r.id for r in rows} == set(range(25))


def test_batches_hold_at_most_ten(texts):
    assert C.classify(texts, counts_per_request).filter("sentiment != 'Positive'").isEmpty()


def test_a_failed_call_marks_its_batch_only(texts):
    poisoned = texts.withColumn(
        "review_comment_message", F.when(F.col("id") == 12, "poison").otherwise(F.col("review_comment_message"))
    )
    classified = C.classify(poisoned, fails_on_bad_batches)
    rows = classified.collect()
    assert {r.id for r in rows if r.is_error} == set(range(10, 20))
    assert all(r.sentiment == "Neutral" for r in rows if r.is_error)
    assert C.accepted(classified).count() == 15 and C.rejected(classified).count() == 10


def test_a_skipped_review_is_neutral_without_a_mark(texts):
    rows = {r.id: r for r in C.classify(texts, skips_the_first).collect()}
    assert [i for i, r in rows.items() if r.sentiment == "Neutral"] == [0, 10, 20]
    assert not any(r.is_error for r in rows.values())
    assert rows[1].sentiment == "Negative"


def test_whole_texts_are_sent_unless_cut(spark):
    long = spark.createDataFrame([(0, "x" * 5000)], "id long, review_comment_message string")
    assert C.classify(long, tells_length).first().sentiment == "Positive"
    assert C.classify(long, tells_length, max_chars=300).first().sentiment == "Negative"


def no_text(instructions, request):
    return {"id": 0}


def test_a_reply_that_is_no_text_is_a_failed_call(texts):
    assert C.classify(texts, no_text).filter("NOT is_error").isEmpty()


def test_a_missing_text_fails_its_batch(spark):
    df = spark.createDataFrame([(0, None), (1, "bom")], "id long, review_comment_message string").coalesce(1)
    assert [r.is_error for r in C.classify(df, always_positive).collect()] == [True, True]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "id long, review_comment_message string")
    assert C.classify(empty, always_positive).collect() == []


def test_stem_provider_reads_several_lines():
    reply = C.stem_provider(INSTRUCTIONS, REQUEST + "[0] very\ngood\n[1] ruim mesmo\n[2] hm")
    assert [e["sentiment"] for e in json.loads(reply)] == ["Positive", "Negative", "Neutral"]


def test_requests_number_the_reviews_in_order(spark):
    df = spark.createDataFrame([(0, 2, "b"), (0, 1, "a"), (1, 3, "c")], "batch long, id long, text string")
    rows = {r.batch: r for r in C.requests(df, "batch", "id", "text").collect()}
    assert rows[0].request == REQUEST + "[0] a\n[1] b" and rows[0].reviews == 2
    assert rows[1].request == REQUEST + "[0] c"


def test_a_batch_above_its_size_is_an_error(spark):
    rows = spark.range(23).select((F.col("id") / 11).cast("long").alias("batch"), "id", F.lit("t").alias("text"))
    with pytest.raises(Exception, match="batch 0 has 11 rows, limit 10"):
        C.requests(rows, "batch", "id", "text").collect()
    found = C.requests(rows, "batch", "id", "text", most=11).collect()
    assert sorted((r.batch, r.reviews) for r in found) == [(0, 11), (1, 11), (2, 1)]
    nameless = rows.limit(2).withColumn("batch", F.lit(None).cast("long"))
    assert [(r.batch, r.reviews) for r in C.requests(nameless, "batch", "id", "text").collect()] == [(None, 2)]


def by_content(instructions, request):
    label = "Positive" if len(request) % 2 else "Negative"
    return json.dumps([{"id": i, "sentiment": label} for i in ids_in(request)])


def test_batches_by_number_do_not_depend_on_partitions(spark):
    rows = spark.range(203).select("id", F.expr("repeat('x', int(id * id % 37))").alias("review_comment_message"))
    one, three, seven = (C.classify(rows.repartition(n), by_content, key="id") for n in (1, 3, 7))
    assert one.count() == 203 and one.select("sentiment").distinct().count() == 2
    assert one.exceptAll(three).isEmpty() and one.exceptAll(seven).isEmpty()


def test_numbered_batches_hold_ten_and_fail_alone(spark):
    rows = spark.range(25).select("id", F.expr("if(id = 12, 'poison', 'text')").alias("review_comment_message"))
    assert C.classify(rows, counts_per_request, key="id").filter("sentiment != 'Positive'").isEmpty()
    failed = C.classify(rows, fails_on_bad_batches, key="id").filter("is_error")
    assert failed.count() in (5, 10) and failed.filter("id = 12").count() == 1
