"""Generated query log with two planted faults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions.hashing import draw, pick, unit
from tidewatch.functions.scalar import round_half_away

# Fixed values of the generator.
N_LOGS = 15_000
START = "2024-01-01 00:00:00"
DAYS = 30
BASE_MS = (50, 300)
SLOW_ORDERS_SHARE = 0.15
SLOW_ORDERS_FACTOR = (5, 35)
EVENING_FACTOR = (1.5, 0.4)
JITTER_MS = (-20, 50)
FLOOR_MS = 10
CPU_BASE, CPU_PER_200_MS, CPU_MAX = 40, 30, 98
CPU_NOISE = (-5.0, 15.0)


def _between(drawn: Column, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    return pick(drawn, high - low + 1) + low


def logs_for(ids: DataFrame, id_column: str, seed: int = 42) -> DataFrame:
    """One log row per id, with the id kept as ``log_id``.

    Each value comes from a hash of (seed, id), so a row is the same in every
    run and under every partitioning.
    """
    names = [
        "second", "table", "type", "base", "fault", "fault_factor", "evening_factor", "jitter", "cpu",
    ]
    drawn = ids.select(F.col(id_column).cast("long").alias("log_id"))
    drawn = drawn.select("log_id", *[draw(seed, n, F.col("log_id")).alias(n) for n in names])

    start = F.unix_timestamp(F.lit(START).cast("timestamp"))
    rows = drawn.select(
        "log_id",
        F.timestamp_seconds(start + pick(F.col("second"), DAYS * 86_400)).alias("ts"),
        F.element_at(F.array(*map(F.lit, S.TARGET_TABLES)), (pick(F.col("table"), 5) + 1).cast("int"))
        .alias("target_table"),
        F.element_at(F.array(*map(F.lit, S.QUERY_TYPES)), (pick(F.col("type"), 4) + 1).cast("int"))
        .alias("query_type"),
        _between(F.col("base"), BASE_MS).alias("base"),
        (unit(F.col("fault")) < SLOW_ORDERS_SHARE).alias("fault"),
        _between(F.col("fault_factor"), SLOW_ORDERS_FACTOR).alias("fault_factor"),
        (F.lit(EVENING_FACTOR[0]) + unit(F.col("evening_factor")) * EVENING_FACTOR[1]).alias("evening_factor"),
        _between(F.col("jitter"), JITTER_MS).alias("jitter"),
        (F.lit(CPU_NOISE[0]) + unit(F.col("cpu")) * (CPU_NOISE[1] - CPU_NOISE[0])).alias("cpu_noise"),
    )
    run_time = (
        F.when((F.col("target_table") == "orders") & F.col("fault"), F.col("base") * F.col("fault_factor"))
        .when(F.hour("ts").between(*S.PEAK_HOURS), F.floor(F.col("base") * F.col("evening_factor")))
        .otherwise(F.col("base") + F.col("jitter"))
    )
    timed = rows.withColumn("execution_time_ms", F.greatest(F.lit(FLOOR_MS), run_time).cast("long"))
    ms = F.col("execution_time_ms")
    cpu = F.least(F.lit(float(CPU_MAX)), CPU_BASE + ms / F.lit(200.0) * CPU_PER_200_MS + F.col("cpu_noise"))
    return timed.select(
        "log_id",
        F.date_format("ts", S.TIMESTAMP_FORMAT).alias("timestamp"),
        "query_type",
        "target_table",
        "execution_time_ms",
        round_half_away(cpu, 2).alias("server_cpu_load"),
        status_of(ms).alias("status"),
    )


def status_of(ms: Column) -> Column:
    return F.when(ms > S.TIMEOUT_MS, "TIMEOUT").otherwise("SUCCESS")


def synthetic_logs(spark: SparkSession, n: int = N_LOGS, seed: int = 42) -> DataFrame:
    return logs_for(spark.range(n), "id", seed)
