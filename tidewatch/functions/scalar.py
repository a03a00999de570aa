"""Scalar column expressions shared by the jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import schemas as S

SECONDS_PER_DAY = 86400.0


def round_half_away(value: Column, digits: int = 0) -> Column:
    """Round a double half away from zero on its binary value.

    ``F.round`` rounds the shortest decimal form instead, so it turns 1.005
    into 1.01 where the binary value lies just below the tie.
    """
    scale = F.lit(10.0**digits)
    return F.signum(value) * F.floor(F.abs(value) * scale + F.lit(0.5)) / scale


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0; an unknown condition is 0."""
    return F.when(condition, 1).otherwise(0).cast("int")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` of ``whole`` in percent, rounded (A5)."""
    return round_half_away(part.cast("double") * F.lit(100.0) / whole, digits)


# ---- time -----------------------------------------------------------------


def parse_strict(text: Column) -> Column:
    """Timestamp of a text; a text in another format is an error."""
    return F.to_timestamp(text, S.TIMESTAMP_FORMAT)


def parse_lenient(text: Column) -> Column:
    """Timestamp of a text; a text in another format is NULL."""
    return F.try_to_timestamp(text, F.lit(S.TIMESTAMP_FORMAT))


def weekday_iso(ts: Column) -> Column:
    """Monday=1 ... Sunday=7, as the feature table has it (P10)."""
    return (F.weekday(ts) + 1).cast("int")


def weekday_from_sunday(ts: Column) -> Column:
    """Sunday=0 ... Saturday=6, as the predictor has it (P10)."""
    return (F.dayofweek(ts) - 1).cast("int")


def is_peak(ts: Column) -> Column:
    """Whether the hour lies in the evening peak, both ends included."""
    return F.hour(ts).between(*S.PEAK_HOURS)


def period_label(ts: Column) -> Column:
    return F.when(is_peak(ts), "Evening (18-22h)").otherwise("Daytime")


def days_between(end: Column, start: Column) -> Column:
    """Whole seconds between two timestamps as days with one decimal."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return round_half_away(seconds / F.lit(SECONDS_PER_DAY), 1)


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def month_name(key: Column) -> Column:
    """'2018-01' as 'Jan 2018' (P23)."""
    return F.date_format(F.to_timestamp(key, "yyyy-MM"), "MMM yyyy")


def month_sort(key: Column) -> Column:
    """'2018-01' as 201801."""
    return F.replace(key, F.lit("-"), F.lit("")).cast("int")


# ---- lookups --------------------------------------------------------------


def lookup(key: Column, mapping: Mapping) -> Column:
    """Value of a small literal map, NULL for other keys."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def code_of(key: Column, codes: Mapping[str, int]) -> Column:
    """Integer code of a known value; another non-NULL value is an error."""
    unknown = F.raise_error(F.concat(F.lit("no code for value: "), key))
    return F.when(key.isin(*codes) | key.isNull(), lookup(key, codes)).otherwise(unknown).cast("int")


def state_name(state: Column) -> Column:
    """Full name of a state code; an unknown code stays as it is (P25)."""
    return F.coalesce(lookup(state, S.STATE_NAMES), state)


def region_of(state: Column) -> Column:
    """Region of a state code; an unknown code stays, only NULL is 'Other' (P26)."""
    return F.coalesce(lookup(state, S.STATE_REGIONS), state, F.lit(S.REGION_OTHER))


# ---- bands ----------------------------------------------------------------


def band(value: Column, limits: Sequence[tuple[float, str]], last: str) -> Column:
    """Label of the first upper limit that holds the value; NULL takes the last label."""
    (first_limit, first_label), *rest = limits
    start = F.when(value <= first_limit, first_label)
    return reduce(lambda acc, step: acc.when(value <= step[0], step[1]), rest, start).otherwise(last)


def estimate_label(days: Column) -> Column:
    return (
        F.when(days < -1, "Early")
        .when(days <= 0, "On time")
        .when(days <= 3, "1-3 days late")
        .otherwise("3+ days late")
    )


def at_least_zero(value: Column) -> Column:
    """Clip below at zero and keep NULL."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def risk_level(is_anomaly: Column, is_high_cpu: Column, is_slow: Column) -> Column:
    """CRITICAL when all three signs agree, WARNING on any of them."""
    signs = [c == 1 for c in (is_anomaly, is_high_cpu, is_slow)]
    return (
        F.when(reduce(Column.__and__, signs), "CRITICAL")
        .when(reduce(Column.__or__, signs), "WARNING")
        .otherwise("OK")
    )
