"""Model calls by a ledger: counted calls, failures, a killed task, resumed runs."""

import os
import sys
from dataclasses import replace
from functools import partial

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.operators import ledger as L
from tidewatch.plans import jobs
from tidewatch.plans import reviews as R
from tidewatch.sources import files

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def answers(folder, down, killing, instructions, request):
    """Notes each call in a file; fails for requests that name ``down`` and dies once for one that names ``killing``."""
    with open(f"{folder}/calls", "a", encoding="utf-8") as file:
        file.write(request + "\n")
    if killing and killing in request and not os.path.exists(f"{folder}/killed"):
        open(f"{folder}/killed", "w").close()
        os._exit(1)
    if down and down in request:
        raise ConnectionError("model is down")
    return f"reply to {request}"


def calls(folder):
    return sorted(open(f"{folder}/calls", encoding="utf-8").read().split())


@pytest.fixture
def requests(spark):
    return spark.range(8).select(F.col("id").alias("batch_id"), F.concat(F.lit("request"), "id").alias("request"))


def replies(frame):
    return {r.batch_id: r.reply for r in frame.collect()}


def test_failed_requests_alone_are_sent_again(requests, tmp_path):
    path = f"{tmp_path}/ledger"
    found = replies(L.ask_once(requests, partial(answers, tmp_path, "request3", None), path, wave=5))
    assert found == {i: None if i == 3 else f"reply to request{i}" for i in range(8)}
    found = replies(L.ask_once(requests, partial(answers, tmp_path, None, None), path))
    assert found == {i: f"reply to request{i}" for i in range(8)}
    assert replies(L.ask_once(requests, partial(answers, tmp_path, None, None), path)) == found
    assert calls(tmp_path) == sorted([f"request{i}" for i in range(8)] + ["request3"])


def test_a_killed_task_costs_its_wave_only(requests, tmp_path):
    path, provider = f"{tmp_path}/ledger", partial(answers, tmp_path, None, "request5")
    with pytest.raises(Exception):
        L.ask_once(requests, provider, path, wave=2)
    recorded = {r.request_hash for r in L.recorded(requests.sparkSession, path).collect()}
    before = len(calls(tmp_path))
    found = replies(L.ask_once(requests, provider, path, wave=2))
    assert found == {i: f"reply to request{i}" for i in range(8)}
    # All waves before the killed one were kept; no call but those of that wave was made twice.
    assert len(calls(tmp_path)) - before == 8 - len(recorded) and before - len(recorded) <= 2
    assert len(set(calls(tmp_path))) == 8


def test_equal_requests_are_sent_once(requests, tmp_path):
    same = requests.withColumn("request", F.lit("same"))
    assert replies(L.ask_once(same, partial(answers, tmp_path, None, None), f"{tmp_path}/ledger")) == dict.fromkeys(range(8), "reply to same")
    assert calls(tmp_path) == ["same"]


def test_nothing_to_ask(requests, tmp_path):
    assert replies(L.ask_once(requests.limit(0), answers, f"{tmp_path}/ledger")) == {}


def test_a_stored_job_is_resumed(spark, tmp_path):
    rows = [(f"r{i}", f"o{i}", 5, "poison" if i == 4 else "bom", "2018-01-01 00:00:00") for i in range(25)]
    files.write_csv(spark.createDataFrame(rows, S.REVIEWS), f"{tmp_path}/reviews.csv")
    paths = dict.fromkeys(("orders_csv", "customers_csv", "items_csv", "products_csv", "translation_csv", "export_folder"), "")
    settings = jobs.Settings(**paths, reviews_csv=f"{tmp_path}/reviews.csv", database="ledger_test", ledger=f"{tmp_path}/ledger")
    files.create_database(spark, "ledger_test")
    first = jobs.make_sentiment(spark, replace(settings, provider=by_word)).count()
    assert first in (15, 20)
    assert jobs.make_sentiment(spark, replace(settings, provider=always)).count() == 25
    labels = {r.sentiment: r.n for r in spark.table("ledger_test.sentiment").groupBy("sentiment").agg(F.count("*").alias("n")).collect()}
    assert labels == {"Positive": first, "Neutral": 25 - first}


def always(instructions, request):
    return "[]"


def by_word(instructions, request):
    import json
    import re

    if "poison" in request:
        raise ConnectionError("model is down")
    return json.dumps([{"id": int(i), "sentiment": "Positive"} for i in re.findall(r"^\[(\d+)\] ", request, re.MULTILINE)])


def test_the_job_marks_the_batch_that_failed(spark, tmp_path):
    text = F.when(F.col("id") == 3, "poison").when(F.col("id") % 10 != 9, "bom")
    rows = spark.range(50).select("id", text.alias("review_comment_message"))
    done = R.sentiment_job(rows, by_word, f"{tmp_path}/ledger", "id")
    found = done.collect()
    assert len(found) == 45 and {(r.batch_id, r.position) for r in found} == {divmod(i, 10) for i in range(45)}
    (bad,) = {r.batch_id for r in found if r.id == 3}
    assert all(r.is_error == (r.batch_id == bad) and r.sentiment == ("Neutral" if r.is_error else "Positive") for r in found)


def test_a_wave_has_files_of_its_own(requests, tmp_path):
    from pathlib import Path

    from tidewatch.session import shared_dir

    before = set(Path(shared_dir(requests.sparkSession)).glob("pending-*/wave=*"))
    L.ask_once(requests, partial(answers, tmp_path, None, None), f"{tmp_path}/ledger", wave=3)
    made = set(Path(shared_dir(requests.sparkSession)).glob("pending-*/wave=*")) - before
    assert sorted(p.name for p in made) == ["wave=0", "wave=1", "wave=2"]
    assert calls(tmp_path) == sorted(f"request{i}" for i in range(8))
