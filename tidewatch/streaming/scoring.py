"""Predict CPU spikes for queries as they are submitted.

The predictor uses only what is known before a query runs, so a submitted
query is scored on its own: no state, no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions import scalar as X
from tidewatch.operators.spike_model import Booster, predict


def score_submitted(queries: DataFrame, model: Booster) -> DataFrame:
    """Adds the predicted label and probability to a stream (or table) of submitted queries.

    Needs ``timestamp``, ``query_type`` and ``target_table``.
    """
    ts = F.col("timestamp").cast("timestamp")
    known = queries.withColumns(
        {
            "hour_of_day": F.hour(ts),
            "day_of_week": X.weekday_from_sunday(ts),
            "is_peak_hour": X.flag(X.is_peak(ts)),
            "is_orders_table": X.flag(F.col("target_table") == "orders"),
            "qt_code": X.code_of(F.col("query_type"), S.QUERY_CODES),
            "tbl_code": X.code_of(F.col("target_table"), S.TABLE_CODES),
        }
    )
    return predict(model, known)
