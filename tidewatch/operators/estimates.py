"""What a plan tells about a frame before anything runs."""

from __future__ import annotations

from pyspark.sql import DataFrame

SMALL_SIDE_BYTES = 10 * 1024 * 1024

_ROW_LOCAL_NODES = {"Project", "Filter", "LogicalRelation", "LocalRelation"}


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame; no job runs."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def is_small(df: DataFrame, limit: int = SMALL_SIDE_BYTES) -> bool:
    return plan_bytes(df) <= limit


def is_row_local(df: DataFrame) -> bool:
    """Whether a frame is a row-by-row reading of files, without a shuffle."""
    nodes = [df._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() not in _ROW_LOCAL_NODES:
            return False
        children = node.children()
        nodes.extend(children.apply(i) for i in range(children.size()))
    return True


def spread(df: DataFrame) -> DataFrame:
    """The frame over at least as many partitions as there are cores.

    For work that costs far more per row than moving the row, such as a model:
    a small file is one partition, which one core would work through alone.
    Larger inputs have partitions enough and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if is_row_local(df) and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
