"""Replies of an external model, kept in a ledger so that no answered request is sent again."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import INSTRUCTIONS
from tidewatch.operators.classify import Provider
from tidewatch.operators.selection import indexed
from tidewatch.session import fresh_path, stage

SCHEMA = "request_hash string, reply string"
FILES = 8  # that hold the requests of a wave


def recorded(spark, path: str) -> DataFrame:
    """All entries of a ledger, which is made if there is none: one per call, with a NULL reply for a failed one."""
    spark.createDataFrame([], SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def ask_once(
    requests: DataFrame, provider: Provider, path: str, *, batch_id: str = "batch_id", wave: int = 10_000, per_task: int = 1
) -> DataFrame:
    """(batch_id, reply) for every row of (batch_id, request); NULL where the last call failed.

    A request is known by its hash, so equal ones are sent once. Those without a reply in the ledger are stored,
    numbered, and sent in waves: each is one job that appends its replies to the ledger when it is done. A task that
    is run again repeats its own calls only, ``per_task`` on average; a run that breaks off loses at most the wave
    under way, and the next run on the same path sends only what has no reply yet, failed requests included.
    """
    spark = requests.sparkSession
    keyed = requests.select(batch_id, "request", F.sha2("request", 256).alias("request_hash"))
    answered = recorded(spark, path).filter("reply IS NOT NULL").select("request_hash").distinct()
    unanswered = keyed.join(answered, "request_hash", "left_anti").select("request_hash", "request").distinct()
    pending = indexed(stage(unanswered, "unanswered"), "request_hash", name="number")
    # A wave has folders of its own, so that its job reads no other's requests.
    pending = pending.withColumn("wave", F.floor(F.col("number") / wave))
    folder = fresh_path(spark, "pending")
    pending.repartition("wave", F.col("number") % FILES).write.partitionBy("wave").parquet(folder)
    pending = spark.read.schema(pending.schema).parquet(folder)

    @F.pandas_udf("string")
    def ask(texts: pd.Series) -> pd.Series:
        return pd.Series([_call(provider, text) for text in texts], dtype="object")

    total = pending.count()
    for first in range(0, total, wave):
        due = pending.filter(F.col("wave") == first // wave)
        tasks = -(-min(wave, total - first) // per_task)
        replies = due.repartition(tasks, "number").select("request_hash", ask.asNondeterministic()("request").alias("reply"))
        replies.write.mode("append").parquet(path)
    # A request that failed at first has several entries; equal requests have one.
    replies = spark.read.schema(SCHEMA).parquet(path).groupBy("request_hash").agg(F.max("reply").alias("reply"))
    return keyed.join(replies, "request_hash", "left").select(batch_id, "reply")


def _call(provider: Provider, request: str) -> str | None:
    try:
        reply = provider(INSTRUCTIONS, request)
    except Exception:  # a failed call is data: its batch is marked, the job goes on
        return None
    return reply if isinstance(reply, str) else None
