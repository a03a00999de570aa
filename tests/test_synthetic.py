"""The generated log: reproducible, and with the faults it promises."""

from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.sources.synthetic import logs_for, synthetic_logs


def test_same_rows_under_any_partitioning(spark):
    a = logs_for(spark.range(0, 500, 1, 1), "id")
    b = logs_for(spark.range(0, 500, 1, 7), "id")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert not a.exceptAll(logs_for(spark.range(500), "id", seed=1)).isEmpty()


def test_values_and_planted_faults(spark):
    logs = synthetic_logs(spark, 40_000).cache()
    assert logs.select(S.RAW_LOGS.fieldNames()).schema.simpleString() == S.RAW_LOGS.simpleString()
    ms, cpu = F.col("execution_time_ms"), F.col("server_cpu_load")
    row = logs.agg(
        F.min(ms).alias("least"),
        F.max(ms).alias("most"),
        F.max(cpu).alias("cpu"),
        F.count_if((F.col("status") == "TIMEOUT") != (ms > 2000)).alias("wrong"),
        F.count_if((F.col("status") == "TIMEOUT") & (F.col("target_table") != "orders")).alias("elsewhere"),
        F.avg((F.col("status") == "TIMEOUT").cast("double")).alias("timeouts"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
        F.avg(F.when(F.col("target_table") == "orders", ms)).alias("orders"),
        F.avg(F.when(F.col("target_table") != "orders", ms)).alias("others"),
    ).first()
    assert row.least >= 10 and 5000 < row.most <= 10_500 and row.cpu <= 98
    assert row.wrong == row.elsewhere == 0
    assert 0.015 < row.timeouts < 0.026
    assert row.first >= "2024-01-01 00:00:00" and row.last <= "2024-01-30 23:59:59"
    assert 3.0 < row.orders / row.others < 3.7
    shares = logs.groupBy("target_table", "query_type").count().collect()
    assert len(shares) == 20 and all(1700 < r["count"] < 2300 for r in shares)
    evening = logs.filter(F.col("target_table") != "orders").groupBy(F.hour("timestamp").between(18, 22).alias("e"))
    means = {r.e: r.m for r in evening.agg(F.avg(ms).alias("m")).collect()}
    assert 1.4 < means[True] / means[False] < 1.7
