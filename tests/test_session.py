"""What staging leaves on the disk."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewatch import session


def _shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (blocks.apply(i).getName() for i in range(blocks.length())) if name.startswith("shuffle_")}


def test_no_shuffle_outlives_what_it_was_staged_for(spark):
    rows = spark.range(10_000).select((F.col("id") % 97).alias("k"), "id").repartition("k")
    kept = rows.groupBy("id").count()
    kept.collect()
    before = _shuffle_files(spark)
    staged = session.stage(rows.groupBy("k").agg(F.sum("id").alias("s")), "sums")
    ended = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < ended:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(session.DROP_SHUFFLES, None) is None
    assert staged.agg(F.sum("s")).first()[0] == sum(range(10_000)) and kept.count() == 10_000


def test_discard_deletes_the_files_of_its_frames_alone(spark):
    one, two = (session.stage(spark.range(10), label) for label in ("one", "two"))
    path = Path(one.inputFiles()[0].removeprefix("file:").replace("//", "/")).parent
    session.discard(one)
    assert not path.exists() and two.count() == 10
    with pytest.raises(KeyError):
        session.discard(spark.range(10))
