"""Session settings and the shared folder that staged data goes to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Spark's switch for dropping the shuffle files of an action as soon as it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_SCOPES: list[set[str]] = []


def local_session(cores: int | str = 8, name: str = "tidewatch", **extra: str) -> SparkSession:
    """A single-JVM session for tests and benches; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without; it gets a fresh folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewatch-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back.

    Cuts the lineage: later passes read the files, and a lost executor costs
    a re-read, not a recomputation. Once they are written nothing needs the
    shuffles behind them, so those leave the disk at once, not when the driver
    happens to collect its garbage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    if _SCOPES:
        _SCOPES[-1].add(path)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    _PATHS[staged] = path
    return staged


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes within drop their shuffles when they end."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def discard(*staged: DataFrame) -> None:
    """Delete the files of frames that ``stage`` gave. All that was to be read from them must be written by now:
    whoever still reads them fails."""
    for df in staged:
        _delete(df.sparkSession, _PATHS.pop(df))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what is staged within. What is read from that must be written before."""
    _SCOPES.append(set())
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            _delete(spark, path)


def stage_alone(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Stage the frame that ``make`` gives, and delete what it stages on its way there."""
    with scratch(spark):
        staged = stage(make(), label)
        _SCOPES[-1].remove(_PATHS[staged])
    if _SCOPES:
        _SCOPES[-1].add(_PATHS[staged])
    return staged


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()).delete(hadoop_path, True)
