"""The registered queries in plain SQL, for an independent engine to run.

Each text restates the query from the raw tables on; nothing is shared with
the Spark code but the fixed values.
"""

from __future__ import annotations

from tidewatch import schemas as S
from tidewatch.functions.hashing import PRIME, coefficients
from tidewatch.operators.quality import ACCEPTED, NOT_NULL, UNIQUE, ColumnTest
from tidewatch.plans.column_tests import ALL_TESTS
from tidewatch.sources import adapters as A

FMT = "'%Y-%m-%d %H:%M:%S'"


def _case(column: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {_lit(v)}" for k, v in mapping.items())
    return f"CASE {column} {arms} END"


def _lit(value) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_lit(v) for v in values)


def _band(column: str, limits: list, last: str) -> str:
    arms = " ".join(f"WHEN {column} <= {limit} THEN '{label}'" for limit, label in limits)
    return f"CASE {arms} ELSE '{last}' END"


# ---- inputs ---------------------------------------------------------------

RAW_LOGS = f"""
timed AS (
  SELECT event_id AS log_id, strftime(ts, {FMT}) AS "timestamp",
         [{_list(S.QUERY_TYPES)}][user_id % 4 + 1] AS query_type,
         {_case("event_type", A.TABLE_OF_EVENT)} AS target_table,
         CAST(greatest(10, floor(value * 10)) AS BIGINT) AS execution_time_ms, user_id
  FROM events),
raw_logs AS (
  SELECT log_id, "timestamp", query_type, target_table, execution_time_ms,
         round(least(98::DOUBLE, 40::DOUBLE + 0.15::DOUBLE * execution_time_ms + user_id % 20 - 5::DOUBLE), 2)
           AS server_cpu_load,
         CASE WHEN execution_time_ms > 2000 THEN 'TIMEOUT' ELSE 'SUCCESS' END AS status
  FROM timed)"""

FEATURES = f"""{RAW_LOGS},
typed AS (
  SELECT CAST("timestamp" AS TIMESTAMP) AS ts, * FROM raw_logs),
features AS (
  SELECT log_id, ts AS "timestamp", query_type, target_table,
         CAST(execution_time_ms AS DOUBLE) AS execution_time_ms, server_cpu_load, status,
         CAST(hour(ts) AS INTEGER) AS hour_of_day,
         CAST(isodow(ts) AS INTEGER) AS day_of_week,
         CASE WHEN hour(ts) BETWEEN 18 AND 22 THEN 1 ELSE 0 END AS is_peak_hour,
         CASE WHEN execution_time_ms > 2000 THEN 1 ELSE 0 END AS is_slow_query,
         CASE WHEN server_cpu_load > 75 THEN 1 ELSE 0 END AS is_high_cpu,
         CASE WHEN target_table = 'orders' THEN 1 ELSE 0 END AS is_orders_table,
         {_case("query_type", S.QUERY_CODES)} AS qt_code,
         {_case("target_table", S.TABLE_CODES)} AS tbl_code,
         log10(CAST(execution_time_ms AS DOUBLE)) AS log_exec_time
  FROM typed)"""

PREDICTOR = f"""{RAW_LOGS},
predictor AS (
  SELECT log_id, CAST(hour(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS hour_of_day,
         CAST(dayofweek(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS day_of_week,
         CASE WHEN hour(CAST("timestamp" AS TIMESTAMP)) BETWEEN 18 AND 22 THEN 1 ELSE 0 END AS is_peak_hour,
         CASE WHEN target_table = 'orders' THEN 1 ELSE 0 END AS is_orders_table,
         {_case("query_type", S.QUERY_CODES)} AS qt_code,
         {_case("target_table", S.TABLE_CODES)} AS tbl_code,
         CASE WHEN server_cpu_load > 75 THEN 1 ELSE 0 END AS is_high_cpu
  FROM raw_logs)"""

CLEAN = f"""{FEATURES},
cut AS (SELECT quantile_cont(-execution_time_ms, 0.05) AS q FROM features),
flagged AS (
  SELECT features.* EXCLUDE (log_id), -execution_time_ms - q AS anomaly_score,
         CASE WHEN -execution_time_ms - q < 0 THEN 1 ELSE 0 END AS is_anomaly
  FROM features, cut),
clean AS (
  SELECT *, CASE WHEN is_anomaly = 1 AND is_high_cpu = 1 AND is_slow_query = 1 THEN 'CRITICAL'
                 WHEN is_anomaly = 1 OR is_high_cpu = 1 OR is_slow_query = 1 THEN 'WARNING'
                 ELSE 'OK' END AS risk_level
  FROM flagged)"""

ORDERS = f"""
orders_csv AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         o_orderstatus AS order_status,
         strftime(o_orderdate, {FMT}) AS order_purchase_timestamp,
         CASE WHEN o_totalprice < 5000 THEN NULL WHEN o_totalprice > 495000 THEN 'not recorded'
              ELSE strftime(o_orderdate + to_seconds(o_orderkey * 7919 % 3024000), {FMT}) END
           AS order_delivered_customer_date,
         strftime(o_orderdate + to_seconds((o_custkey % 20 + 25) * 86400), {FMT}) AS order_estimated_delivery_date
  FROM orders),
customers_csv AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         CASE WHEN c_acctbal < -900 THEN NULL WHEN c_acctbal > 9900 THEN 'XX'
              ELSE [{_list(S.STATE_NAMES)}][c_custkey % 27 + 1] END AS customer_state
  FROM customer)"""

DELIVERY = f"""{ORDERS},
joined AS (
  SELECT order_id, customer_state,
         try_strptime(order_purchase_timestamp, {FMT}) AS purchased,
         try_strptime(order_delivered_customer_date, {FMT}) AS delivered,
         try_strptime(order_estimated_delivery_date, {FMT}) AS estimated
  FROM orders_csv LEFT JOIN customers_csv USING (customer_id)
  WHERE order_status = 'F' AND order_delivered_customer_date IS NOT NULL
    AND order_estimated_delivery_date IS NOT NULL),
measured AS (
  SELECT order_id, customer_state,
         round((epoch(delivered) - epoch(purchased)) / 86400, 1) AS delivery_days,
         round((epoch(delivered) - epoch(estimated)) / 86400, 1) AS days_vs_estimate,
         strftime(purchased, '%Y-%m') AS purchase_month, strftime(purchased, '%b %Y') AS month_name
  FROM joined
  WHERE purchased IS NOT NULL AND delivered IS NOT NULL AND estimated IS NOT NULL),
delivery AS (
  SELECT order_id, customer_state,
         coalesce({_case("customer_state", S.STATE_NAMES)}, customer_state) AS state_name,
         'Brazil' AS country,
         coalesce({_case("customer_state", S.STATE_REGIONS)}, customer_state, 'Other') AS region,
         delivery_days, days_vs_estimate,
         CASE WHEN days_vs_estimate > 0 THEN 1 ELSE 0 END AS is_late,
         CASE WHEN days_vs_estimate < 0 THEN 1 ELSE 0 END AS is_early,
         CASE WHEN days_vs_estimate < 0 THEN 0::DOUBLE ELSE days_vs_estimate END AS days_late,
         {_band("delivery_days", S.DELIVERY_BUCKETS, S.DELIVERY_BUCKET_LAST)} AS delivery_bucket,
         CASE WHEN days_vs_estimate < -1 THEN 'Early' WHEN days_vs_estimate <= 0 THEN 'On time'
              WHEN days_vs_estimate <= 3 THEN '1-3 days late' ELSE '3+ days late' END AS estimate_label,
         {_band("delivery_days", S.PERFORMANCE_LIMITS, S.PERFORMANCE_LAST)} AS performance_flag,
         purchase_month, month_name, CAST(replace(purchase_month, '-', '') AS INTEGER) AS month_sort
  FROM measured)"""
# The last bit of a logarithm differs between math libraries.
LOG = "round(log_exec_time, 9)"
# Days hold one decimal, so a mean of whole tenths is exact where a floating sum may fall off a tie.
MEAN_DAYS = "CAST(sum(CAST(round({} * 10) AS BIGINT)) AS DOUBLE) / (count(*) * 10)"

_LABELS = " ".join(
    f"WHEN '{star}:{lang}' THEN {_lit(label)}"
    for star, labels in A.RAW_LABELS.items()
    for lang, label in labels.items()
)
NORMALISED = f"""CASE WHEN raw_label IN ({_list(S.SENTIMENTS)}) THEN raw_label
              WHEN regexp_matches(lower(raw_label), '{"|".join(S.POSITIVE_STEMS)}') THEN 'Positive'
              WHEN regexp_matches(lower(raw_label), '{"|".join(S.NEGATIVE_STEMS)}') THEN 'Negative'
              ELSE 'Neutral' END"""

REVIEWS = f"""
reviews AS (
  SELECT CAST(doc_id AS VARCHAR) AS review_id, CAST(doc_id AS VARCHAR) AS order_id,
         CAST(n_chars % 5 + 1 AS INTEGER) AS review_score,
         CASE WHEN n_chars >= 10 THEN coalesce(text, '') END AS review_comment_message,
         strftime(DATE '2018-01-01' + CAST(n_chars % 365 AS INTEGER), {FMT}) AS review_creation_date,
         CASE (n_chars % 5 + 1) || ':' || lang {_LABELS} ELSE 'unclear' END AS raw_label
  FROM documents),
sentiment AS (
  SELECT review_id, order_id, review_score, review_comment_message, review_creation_date,
         {NORMALISED} AS sentiment
  FROM reviews WHERE review_comment_message IS NOT NULL)"""

CATEGORIES = f"""{REVIEWS},
products AS (
  SELECT p_partkey, CASE WHEN p_size > 1 THEN p_brand END AS native FROM part),
translation AS (
  SELECT DISTINCT p_brand AS native, lower(replace(p_brand, '#', '_')) AS english
  FROM part WHERE p_brand NOT LIKE '%5'),
categories AS (
  SELECT s.review_id, s.order_id, s.review_score AS star_rating, s.sentiment,
         coalesce(t.english, p.native, 'Unknown') AS category, s.review_comment_message
  FROM sentiment s
  LEFT JOIN lineitem l ON CAST(l.l_orderkey AS VARCHAR) = s.order_id
  LEFT JOIN products p ON p.p_partkey = l.l_partkey
  LEFT JOIN translation t ON t.native = p.native)"""

STATS = f"""{CATEGORIES},
grouped AS (
  SELECT category, count(*) AS review_count, round(avg(star_rating), 2) AS avg_stars,
         round(avg(CASE WHEN sentiment = 'Positive' THEN 1::DOUBLE ELSE 0 END), 3) AS pct_positive,
         round(avg(CASE WHEN sentiment = 'Negative' THEN 1::DOUBLE ELSE 0 END), 3) AS pct_negative,
         round(avg(CASE WHEN sentiment = 'Neutral' THEN 1::DOUBLE ELSE 0 END), 3) AS pct_neutral
  FROM categories GROUP BY category),
stats AS (
  SELECT * FROM grouped
  WHERE category <> 'Unknown'
    AND review_count >= (SELECT greatest(3, least(20, count(*) // 100)) FROM categories))"""

def _draw(seed: int, stream: str, key: str) -> str:
    """Horner's rule modulo 2^31 - 1 over a key of up to 62 bits."""
    factor, acc, *rest = coefficients(seed, stream)
    x = f"((({key} >> 31) % {PRIME} * {factor} + ({key} & {PRIME})) % {PRIME})"
    for c in rest:
        acc = f"(({acc} * {x} + {c}) % {PRIME})"
    return acc


_NAMES = ["second", "table", "type", "base", "fault", "fault_factor", "evening_factor", "jitter", "cpu"]
_DRAWS = ", ".join(f"{_draw(42, name, 'event_id')} AS {'tab' if name == 'table' else name}" for name in _NAMES)
SYNTHETIC = f"""
drawn AS (SELECT event_id AS log_id, {_DRAWS} FROM events),
rows_ AS (
  SELECT log_id, TIMESTAMP '2024-01-01' + to_seconds((second * 2592000) >> 31) AS ts,
         [{_list(S.TARGET_TABLES)}][((tab * 5) >> 31) + 1] AS target_table,
         [{_list(S.QUERY_TYPES)}][((type * 4) >> 31) + 1] AS query_type,
         ((base * 251) >> 31) + 50 AS base, fault / 2147483648::DOUBLE < 0.15::DOUBLE AS fault,
         ((fault_factor * 31) >> 31) + 5 AS fault_factor,
         1.5::DOUBLE + evening_factor / 2147483648::DOUBLE * 0.4::DOUBLE AS evening_factor,
         ((jitter * 71) >> 31) - 20 AS jitter,
         -5::DOUBLE + cpu / 2147483648::DOUBLE * 20::DOUBLE AS cpu_noise
  FROM drawn),
timed_rows AS (
  SELECT *, CAST(greatest(10, CASE WHEN target_table = 'orders' AND fault THEN base * fault_factor
                                   WHEN hour(ts) BETWEEN 18 AND 22 THEN CAST(floor(base * evening_factor) AS BIGINT)
                                   ELSE base + jitter END) AS BIGINT) AS ms
  FROM rows_),
synthetic AS (
  SELECT log_id, strftime(ts, {FMT}) AS "timestamp", query_type, target_table, ms AS execution_time_ms,
         round(least(98::DOUBLE, 40 + ms / 200::DOUBLE * 30 + cpu_noise), 2) AS server_cpu_load,
         CASE WHEN ms > 2000 THEN 'TIMEOUT' ELSE 'SUCCESS' END AS status
  FROM timed_rows)"""


def _rank(key: str) -> str:
    return _draw(42, "rank", key)


_SPLIT = f"""
split AS (
  SELECT log_id, is_high_cpu,
         row_number() OVER (PARTITION BY is_high_cpu ORDER BY {_rank("log_id")}, log_id)
           <= round(0.2::DOUBLE * count(*) OVER (PARTITION BY is_high_cpu)) AS is_test
  FROM predictor)"""


# ---- the forest: 200 trees of 256 rows, eight levels ------------------------

# One run of 51,200 rows if there are more, else several runs over all rows.
_TREE_SAMPLES = f"""
sizes AS (SELECT count(*) AS n, least(count(*), 256) AS psi FROM events),
plan AS (SELECT *, greatest(1, least(n, 200 * psi) // psi) AS per_round FROM sizes),
pool AS (SELECT event_id AS log_id FROM events
         QUALIFY row_number() OVER (ORDER BY {_rank("event_id")}, event_id) <= (SELECT 200 * psi FROM sizes)),
offered AS (SELECT log_id, round, psi, per_round,
                   row_number() OVER (PARTITION BY round ORDER BY
                     {_draw(42, "order", "(log_id + round * 1000003000019)")}, log_id) - 1 AS spot
            FROM pool, plan, unnest(range(0, CAST(ceil(200 / per_round) AS BIGINT))) AS r(round)),
samples AS (
  SELECT CAST(round * per_round + spot // psi AS INTEGER) AS tree, CAST(spot % psi AS INTEGER) AS place, log_id
  FROM offered WHERE spot < per_round * psi AND round * per_round + spot // psi < 200)"""

_FOREST_FEATURES = ("log_exec_time", "server_cpu_load", "hour_of_day", "qt_code", "tbl_code", "is_peak_hour")
_DEPTH = 8
_EULER = 0.5772156649015329  # fixed value: Euler's constant


def _mean_path(n: str) -> str:
    return (
        f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + {_EULER}::DOUBLE) - 2 * ({n} - 1)::DOUBLE / {n} "
        f"WHEN {n} = 2 THEN 1::DOUBLE ELSE 0::DOUBLE END"
    )


def _forest() -> str:
    """Grown level by level: every node draws its feature and cut from (tree, slot); then all rows walk all trees."""
    standard = ", ".join(f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)" for c in _FOREST_FEATURES)
    lows, highs = (", ".join(f"{f}(x[{i}])" for i in range(1, len(_FOREST_FEATURES) + 1)) for f in ("min", "max"))
    parts = [f"scaled AS MATERIALIZED (SELECT log_id, [{standard}] AS x FROM features)", _TREE_SAMPLES.strip()]
    parts.append("level0 AS MATERIALIZED (SELECT tree, 0 AS slot, x FROM samples JOIN scaled USING (log_id))")
    for level in range(_DEPTH + 1):
        usable = "[i FOR i IN range(1, 7) IF highs[i] > lows[i]]" if level < _DEPTH else "[]::BIGINT[]"
        parts.append(f"""
node{level} AS MATERIALIZED (
  SELECT tree, slot, n, feature, lows[feature] + (highs[feature] - lows[feature])
           * ({_draw(42, "cut", "key")} / 2147483648::DOUBLE) AS cut
  FROM (SELECT *, usable[(({_draw(42, "feature", "key")} * len(usable)) >> 31) + 1] AS feature
        FROM (SELECT *, CAST(tree AS BIGINT) * 1048576 + slot AS key, {usable} AS usable
              FROM (SELECT tree, slot, count(*) AS n, [{lows}] AS lows, [{highs}] AS highs FROM level{level} GROUP BY ALL))))""")
        if level < _DEPTH:
            parts.append(f"""
level{level + 1} AS MATERIALIZED (
  SELECT tree, 2 * slot + CASE WHEN x[feature] <= cut THEN 1 ELSE 2 END AS slot, x
  FROM level{level} JOIN node{level} USING (tree, slot) WHERE feature IS NOT NULL)""")
    nodes = " UNION ALL ".join(f"SELECT *, {level} AS level FROM node{level}" for level in range(_DEPTH + 1))
    parts.append(f"""
nodes AS MATERIALIZED (
  SELECT tree, slot, feature, cut,
         CAST(floor(({_mean_path("n")} + level) / 1e-9::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS path
  FROM ({nodes}))""")
    walk = "(SELECT log_id, x, CAST(unnest(range(0, 200)) AS INTEGER) AS tree, 0 AS slot FROM scaled)"
    for _ in range(_DEPTH):
        walk = f"""(SELECT w.log_id, w.x, w.tree,
            CASE WHEN feature IS NULL THEN w.slot WHEN x[feature] <= cut THEN 2 * w.slot + 1 ELSE 2 * w.slot + 2 END AS slot
            FROM {walk} w JOIN nodes USING (tree, slot))"""
    parts.append(f"""
scored AS MATERIALIZED (
  SELECT log_id, -pow(2, -(CAST(sum(path) AS DOUBLE) / (200 / 1e-9::DOUBLE * any_value({_mean_path("psi")})))) AS raw_score
  FROM {walk} w JOIN nodes USING (tree, slot), sizes GROUP BY log_id)""")
    return ",\n".join(parts)


FOREST = f"""{FEATURES},
{_forest()},
offset_ AS (SELECT quantile_cont(raw_score, 0.05) AS q FROM scored),
flagged AS (
  SELECT features.* EXCLUDE (log_id), raw_score - q AS anomaly_score,
         CASE WHEN raw_score - q < 0 THEN 1 ELSE 0 END AS is_anomaly
  FROM features JOIN scored USING (log_id), offset_),
{CLEAN[CLEAN.index("clean AS ("):]}"""
_SCORE = "round(anomaly_score, 9) + 0 AS anomaly_score"


# ---- three rounds of boosting ------------------------------------------------

_PREDICTORS = ("hour_of_day", "day_of_week", "is_peak_hour", "is_orders_table", "qt_code", "tbl_code")


def _worth(side: str) -> str:
    g, h = f"({side}g / 16777216::DOUBLE)", f"({side}h / 16777216::DOUBLE)"
    return f"{g} * {g} / ({h} + 1::DOUBLE)"


def _boosting(rounds: int = 3, depth: int = 5) -> str:
    """Each level: sums of gradients and curvatures per (node, feature, value), the best cut of each node, one step down."""
    listed = ", ".join(f"coalesce({c}, -1)" for c in _PREDICTORS)
    parts = [f"""
margin0 AS MATERIALIZED (
  SELECT is_test, {", ".join(_PREDICTORS)}, is_high_cpu, weight, [{listed}] AS x, 0::DOUBLE AS margin
  FROM (SELECT is_test, {", ".join(_PREDICTORS)}, is_high_cpu, count(*) AS weight
        FROM predictor JOIN split USING (log_id, is_high_cpu) GROUP BY ALL))"""]
    for r in range(rounds):
        parts.append(f"""
r{r}level0 AS MATERIALIZED (
  SELECT *, 0 AS slot,
         CAST(floor((p - is_high_cpu) * 16777216 + 0.5::DOUBLE) AS BIGINT) * weight AS g,
         CAST(floor(p * (1 - p) * 16777216 + 0.5::DOUBLE) AS BIGINT) * weight AS h
  FROM (SELECT *, 1 / (1 + exp(-margin)) AS p FROM margin{r}))""")
        for level in range(depth):
            parts.append(f"""
r{r}cut{level} AS MATERIALIZED (
  SELECT slot, feature, threshold, gain
  FROM (SELECT *, {_worth("l")} + {_worth("r")} - {_worth("t")} AS gain
        FROM (SELECT *, tg - lg AS rg, th - lh AS rh
              FROM (SELECT slot, f AS feature, v AS threshold,
                           CAST(sum(g) OVER (PARTITION BY slot, f ORDER BY v) AS BIGINT) AS lg,
                           CAST(sum(h) OVER (PARTITION BY slot, f ORDER BY v) AS BIGINT) AS lh,
                           CAST(sum(g) OVER (PARTITION BY slot, f) AS BIGINT) AS tg,
                           CAST(sum(h) OVER (PARTITION BY slot, f) AS BIGINT) AS th
                    FROM (SELECT slot, f, x[f] AS v, sum(g) AS g, sum(h) AS h
                          FROM r{r}level{level}, unnest(range(1, 7)) AS u(f)
                          WHERE NOT is_test AND slot >= {2**level - 1} GROUP BY ALL)))
        WHERE lh >= 16777216 AND rh >= 16777216)
  WHERE gain > 1e-6::DOUBLE
  QUALIFY row_number() OVER (PARTITION BY slot ORDER BY gain DESC, feature, threshold) = 1),
r{r}level{level + 1} AS MATERIALIZED (
  SELECT l.* REPLACE (CASE WHEN feature IS NULL THEN slot WHEN x[feature] <= threshold THEN 2 * slot + 1
                           ELSE 2 * slot + 2 END AS slot)
  FROM r{r}level{level} l LEFT JOIN r{r}cut{level} USING (slot))""")
        parts.append(f"""
r{r}leaf AS MATERIALIZED (
  SELECT slot, -(CAST(sum(g) AS BIGINT) / 16777216::DOUBLE) / (CAST(sum(h) AS BIGINT) / 16777216::DOUBLE + 1::DOUBLE) * 0.05::DOUBLE AS value
  FROM r{r}level{depth} WHERE NOT is_test GROUP BY slot),
margin{r + 1} AS MATERIALIZED (
  SELECT l.* EXCLUDE (slot, g, h, p) REPLACE (margin + coalesce(value, 0) AS margin) FROM r{r}level{depth} l LEFT JOIN r{r}leaf USING (slot))""")
    nodes = []
    for r in range(rounds):
        nodes += [f"SELECT {r} AS tree, slot, feature - 1 AS feature, threshold, gain, 0::DOUBLE AS value FROM r{r}cut{k}" for k in range(depth)]
        nodes.append(f"SELECT {r} AS tree, slot, -1 AS feature, 0 AS threshold, 0::DOUBLE AS gain, value FROM r{r}leaf WHERE value <> 0")
    parts.append(f"boosted_nodes AS ({' UNION ALL '.join(nodes)})")
    return f"{PREDICTOR}, {_SPLIT}," + ",".join(parts)


_RULE = f"""{PREDICTOR},
ruled AS (
  SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS predicted
  FROM (SELECT is_high_cpu, (hour_of_day * 7 + day_of_week * 3 + qt_code * 5 + tbl_code * 11 + is_orders_table * 20
                             + is_peak_hour * 13) % 101 / 101::DOUBLE AS score FROM predictor)),
classes AS (
  SELECT class, CAST(count(*) FILTER (WHERE is_high_cpu = v AND predicted = v) AS DOUBLE) AS hits,
         count(*) FILTER (WHERE predicted = v) AS claimed, count(*) FILTER (WHERE is_high_cpu = v) AS support
  FROM ruled, (VALUES (0, 'Normal CPU'), (1, 'High CPU')) AS c(v, class) GROUP BY class),
shares AS (
  SELECT class, coalesce(hits / nullif(claimed, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall, support
  FROM classes),
measured AS (
  SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM shares)"""


def _q(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


# ---- queries --------------------------------------------------------------


def flows() -> dict[str, str]:
    pct = "round(100::DOUBLE * sum(CASE WHEN {} THEN 1 ELSE 0 END) / count(*), {})"
    health = f"""
        SELECT risk_level, count(*) AS query_count,
               round(count(*) * 100::DOUBLE / sum(count(*)) OVER (), 2) AS pct_of_total,
               round(avg(execution_time_ms), 1) AS avg_exec_ms, round(max(execution_time_ms), 1) AS max_exec_ms,
               round(avg(server_cpu_load), 1) AS avg_cpu_pct,
               count(*) FILTER (WHERE status = 'TIMEOUT') AS timeout_count,
               {pct.format("status = 'TIMEOUT'", 2)} AS timeout_rate_pct,
               count(*) FILTER (WHERE hour("timestamp") BETWEEN 18 AND 22) AS peak_hour_queries,
               count(*) FILTER (WHERE target_table = 'orders') AS orders_table_queries
        FROM clean GROUP BY risk_level"""
    state_means = f"""
      states AS (SELECT customer_state, count(*) AS orders, {MEAN_DAYS.format("delivery_days")} AS avg_days
                 FROM delivery GROUP BY 1 HAVING count(*) >= 100)"""
    return {
        "logs_by_table": _q(RAW_LOGS, """
            SELECT target_table, round(avg(execution_time_ms), 1) AS avg_ms, max(execution_time_ms) AS max_ms,
                   count(*) AS n FROM raw_logs GROUP BY 1"""),
        "logs_by_period": _q(RAW_LOGS, """
            SELECT CASE WHEN hour(CAST("timestamp" AS TIMESTAMP)) BETWEEN 18 AND 22 THEN 'Evening (18-22h)'
                        ELSE 'Daytime' END AS period,
                   round(avg(execution_time_ms), 1) AS avg_ms, count(*) AS n FROM raw_logs GROUP BY 1"""),
        "eda_hourly_ms": _q(RAW_LOGS, """
            SELECT CAST(hour(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS hour,
                   round(avg(execution_time_ms), 1) AS avg_ms,
                   hour(CAST("timestamp" AS TIMESTAMP)) BETWEEN 18 AND 22 AS is_peak
            FROM raw_logs GROUP BY 1, 3"""),
        "eda_hourly_cpu": _q(RAW_LOGS, """
            SELECT CAST(hour(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS hour,
                   round(avg(server_cpu_load), 2) AS avg_cpu,
                   hour(CAST("timestamp" AS TIMESTAMP)) BETWEEN 18 AND 22 AS is_peak
            FROM raw_logs GROUP BY 1, 3"""),
        "eda_timeouts_by_table": _q(RAW_LOGS, """
            SELECT target_table, count(*) AS timeouts FROM raw_logs WHERE status = 'TIMEOUT' GROUP BY 1"""),
        "eda_summary": _q(RAW_LOGS, """
            SELECT *, CAST(timeouts AS DOUBLE) / total AS timeout_share, orders_avg / others_avg AS orders_slowdown
            FROM (SELECT count(*) AS total, count(*) FILTER (WHERE status = 'TIMEOUT') AS timeouts,
                         round(avg(execution_time_ms), 1) AS avg_ms, max(execution_time_ms) AS max_ms,
                         round(avg(execution_time_ms) FILTER (WHERE target_table = 'orders'), 1) AS orders_avg,
                         round(avg(execution_time_ms) FILTER (WHERE target_table <> 'orders'), 1) AS others_avg
                  FROM raw_logs)"""),
        "eda_box_stats": _q(f"""{RAW_LOGS},
            v AS (SELECT target_table, CAST(execution_time_ms AS DOUBLE) AS ms FROM raw_logs),
            q AS (SELECT target_table, quantile_cont(ms, 0.25) AS q1, quantile_cont(ms, 0.5) AS median,
                         quantile_cont(ms, 0.75) AS q3, round(avg(ms), 1) AS avg_ms FROM v GROUP BY 1)""", """
            SELECT target_table, q1, median, q3,
                   min(ms) FILTER (WHERE ms BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
                   max(ms) FILTER (WHERE ms BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
                   count(*) FILTER (WHERE ms NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers,
                   avg_ms
            FROM v JOIN q USING (target_table) GROUP BY target_table, q1, median, q3, avg_ms"""),
        "log_features": _q(FEATURES, f"SELECT * REPLACE ({LOG} AS log_exec_time) FROM features"),
        "stg_server_logs": _q(RAW_LOGS, """
            SELECT CAST("timestamp" AS TIMESTAMP) AS logged_at, query_type, target_table,
                   CAST(execution_time_ms AS DOUBLE) AS execution_time_ms, server_cpu_load, status FROM raw_logs"""),
        "stg_clean_logs": _q(CLEAN, """
            SELECT "timestamp" AS logged_at, query_type, target_table, execution_time_ms, server_cpu_load, status,
                   anomaly_score, is_anomaly = 1 AS is_anomaly, risk_level FROM clean"""),
        "predictor_features": _q(PREDICTOR, "SELECT * FROM predictor"),
        "predictor_class_balance": _q(PREDICTOR, """
            SELECT count(*) AS n, CAST(sum(is_high_cpu) AS BIGINT) AS high_cpu,
                   CAST(sum(is_high_cpu) AS DOUBLE) / count(*) AS high_cpu_share FROM predictor"""),
        "split_stratified": _q(f"""{PREDICTOR}, {_SPLIT}""", "SELECT * FROM split"),
        "risk_level_rule_based": _q(CLEAN, f"SELECT * REPLACE ({LOG} AS log_exec_time) FROM clean"),
        "risk_distribution": _q(CLEAN, """
            SELECT risk_level, count(*) AS n, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS share
            FROM clean GROUP BY 1"""),
        "anomaly_share": _q(CLEAN, """
            SELECT count(*) AS n, CAST(sum(is_anomaly) AS BIGINT) AS anomalies,
                   avg(CAST(is_anomaly AS DOUBLE)) AS anomaly_share FROM clean"""),
        "fct_server_health": _q(CLEAN, health),
        "synthetic_logs": _q(SYNTHETIC, "SELECT * FROM synthetic"),
        "predictor_training_counts": _q(f"""{PREDICTOR}, {_SPLIT}""", """
            SELECT is_test, hour_of_day, day_of_week, is_peak_hour, is_orders_table, qt_code, tbl_code, is_high_cpu,
                   count(*) AS weight FROM predictor JOIN split USING (log_id, is_high_cpu)
            GROUP BY ALL"""),
        "split_class_balance": _q(f"""{PREDICTOR}, {_SPLIT}""", """
            SELECT is_test, count(*) AS n, CAST(sum(is_high_cpu) AS BIGINT) AS high_cpu,
                   CAST(sum(is_high_cpu) AS DOUBLE) / count(*) AS high_cpu_share FROM split GROUP BY 1"""),
        "gbt_trees": _q(_boosting(), """
            SELECT CAST(tree AS INTEGER) AS tree, CAST(slot AS INTEGER) AS slot, CAST(feature AS INTEGER) AS feature,
                   CAST(threshold AS INTEGER) AS threshold, round(gain, 9) + 0 AS gain, round(value, 9) + 0 AS value
            FROM boosted_nodes"""),
        "gbt_predictions": _q(_boosting(), f"""
            SELECT {", ".join(_PREDICTORS)}, is_high_cpu, weight, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS predicted,
                   round(p, 9) AS spike_probability
            FROM (SELECT *, 1 / (1 + exp(-margin)) AS p FROM margin3) WHERE is_test"""),
        "metrics_summary": _q(_RULE, """
            SELECT (SELECT count(*) FROM ruled) AS n,
                   (SELECT avg(CASE WHEN predicted = is_high_cpu THEN 1::DOUBLE ELSE 0 END) FROM ruled) AS accuracy,
                   round(sum(CASE WHEN a.score > b.score THEN 1::DOUBLE WHEN a.score = b.score THEN 0.5::DOUBLE ELSE 0 END * a.n * b.n)
                         / sum(a.n * b.n), 12) AS roc_auc
            FROM (SELECT score, count(*) AS n FROM ruled WHERE is_high_cpu = 1 GROUP BY 1) a,
                 (SELECT score, count(*) AS n FROM ruled WHERE is_high_cpu = 0 GROUP BY 1) b"""),
        "metrics_class_report": _q(_RULE, """
            SELECT class, round(precision, 12) AS precision, round(recall, 12) AS recall, round(f1, 12) AS f1, support FROM measured
            UNION ALL SELECT 'macro avg', round(avg(precision), 12), round(avg(recall), 12), round(avg(f1), 12), CAST(sum(support) AS BIGINT)
            FROM measured
            UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 12), round(sum(recall * support) / sum(support), 12),
                   round(sum(f1 * support) / sum(support), 12), CAST(sum(support) AS BIGINT) FROM measured"""),
        "metrics_confusion": _q(_RULE, """
            SELECT is_high_cpu AS actual, count(*) FILTER (WHERE predicted = 0) AS predicted_normal,
                   count(*) FILTER (WHERE predicted = 1) AS predicted_high FROM ruled GROUP BY 1"""),
        "iforest_tree_samples": _q(_TREE_SAMPLES, "SELECT tree, place, log_id FROM samples"),
        "clean_logs": _q(FOREST, f"SELECT * REPLACE ({LOG} AS log_exec_time, {_SCORE}) FROM clean"),
        "iforest_scores": _q(FOREST, f"""SELECT "timestamp", {_SCORE}, is_anomaly FROM clean"""),
        "iforest_flags": _q(FOREST, """
            SELECT count(*) AS n, CAST(sum(is_anomaly) AS BIGINT) AS anomalies,
                   avg(CAST(is_anomaly AS DOUBLE)) AS anomaly_share FROM clean"""),
        "fct_server_health_forest": _q(FOREST, health),
        "iforest_scaled_features": _q(FEATURES, "SELECT log_id, " + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0 AS {c}"
            for c in ("log_exec_time", "server_cpu_load", "hour_of_day", "qt_code", "tbl_code", "is_peak_hour"))
            + " FROM features"),
        "sample_indexed": _q(RAW_LOGS, f"""
            SELECT *, row_number() OVER (ORDER BY {_rank('log_id')}, log_id) - 1 AS row_idx
            FROM raw_logs QUALIFY row_idx < 500"""),
        "sample_exact": _q(RAW_LOGS, f"SELECT * FROM raw_logs ORDER BY {_rank('log_id')}, log_id LIMIT 3000"),
        "delivery_enriched": _q(DELIVERY, "SELECT * FROM delivery"),
        "delivery_date_audit": _q(DELIVERY, """
            SELECT count(*) AS delivered_orders, count(*) FILTER (WHERE purchased IS NULL) AS null_purchased,
                   count(*) FILTER (WHERE delivered IS NULL) AS null_delivered,
                   count(*) FILTER (WHERE estimated IS NULL) AS null_estimated,
                   count(*) FILTER (WHERE purchased IS NULL OR delivered IS NULL OR estimated IS NULL) AS dropped
            FROM joined"""),
        "delivery_summary": _q(f"{DELIVERY}, {state_means}", f"""
            SELECT count(*) AS orders, round({MEAN_DAYS.format("delivery_days")}, 1) AS avg_days,
                   quantile_cont(delivery_days, 0.5) AS median_days, CAST(sum(is_late) AS BIGINT) AS late_orders,
                   CAST(sum(is_late) AS DOUBLE) / count(*) AS late_rate,
                   count(*) FILTER (WHERE delivery_days <= 0 OR delivery_days > 365) AS outside_0_365,
                   (SELECT customer_state FROM states ORDER BY avg_days, customer_state LIMIT 1) AS fastest_state,
                   (SELECT round(min(avg_days), 1) FROM states) AS fastest_days,
                   (SELECT customer_state FROM states ORDER BY avg_days DESC, customer_state DESC LIMIT 1)
                     AS slowest_state,
                   (SELECT round(max(avg_days), 1) FROM states) AS slowest_days
            FROM delivery"""),
        "delivery_state_avg": _q(f"{DELIVERY}, {state_means}", """
            SELECT customer_state, avg_days, orders, avg_days > 15 AS is_slow FROM states"""),
        "delivery_late_rate": _q(DELIVERY, """
            SELECT *, late_rate * 100 AS late_pct, late_rate * 100 > 10 AS is_red
            FROM (SELECT customer_state, CAST(sum(is_late) AS DOUBLE) / count(*) AS late_rate, count(*) AS orders
                  FROM delivery GROUP BY 1 HAVING count(*) >= 100)"""),
        "delivery_histogram": _q(f"""{DELIVERY},
            v AS (SELECT delivery_days AS d FROM delivery WHERE delivery_days BETWEEN 0 AND 60),
            ends AS (SELECT min(d) AS low, (max(d) - min(d)) / 60 AS width FROM v),
            binned AS (SELECT CAST(least(floor((d - low) / width), 59) AS INTEGER) AS bin, low, width FROM v, ends)""", """
            SELECT bin, low + bin * width AS bin_start, low + (bin + 1) * width AS bin_end, count(*) AS orders
            FROM binned GROUP BY bin, low, width"""),
        "stg_delivery_orders": _q(DELIVERY, """
            SELECT * REPLACE (is_late = 1 AS is_late, is_early = 1 AS is_early) FROM delivery"""),
        "fct_delivery_by_state": _q(DELIVERY, f"""
            SELECT customer_state, state_name, region, count(*) AS total_orders,
                   round({MEAN_DAYS.format("delivery_days")}, 1) AS avg_delivery_days,
                   round(median(delivery_days), 1) AS median_delivery_days,
                   round({MEAN_DAYS.format("days_vs_estimate")}, 1) AS avg_days_vs_estimate,
                   {pct.format("is_late = 1", 1)} AS late_rate_pct, {pct.format("is_early = 1", 1)} AS early_rate_pct,
                   {pct.format("performance_flag = 'Fast'", 1)} AS pct_fast,
                   {pct.format("performance_flag = 'Normal'", 1)} AS pct_normal,
                   {pct.format("performance_flag = 'Slow'", 1)} AS pct_slow,
                   {pct.format("performance_flag = 'Critical'", 1)} AS pct_critical
            FROM delivery GROUP BY 1, 2, 3 HAVING count(*) >= 50"""),
        "reviews_sanitise": _q(REVIEWS, f"""
            SELECT review_id, raw_label, {NORMALISED} AS sentiment FROM reviews"""),
        "reviews_sentiment": _q(REVIEWS, "SELECT * FROM sentiment"),
        "stg_reviews": _q(REVIEWS, f"""
            SELECT review_id, order_id, review_score, sentiment, review_comment_message AS review_text
            FROM sentiment WHERE sentiment IN ({_list(S.SENTIMENTS)})"""),
        "sentiment_shares": _q(REVIEWS, """
            SELECT count(*) AS n, avg(CASE WHEN sentiment = 'Positive' THEN 1::DOUBLE ELSE 0 END) AS positive,
                   avg(CASE WHEN sentiment = 'Neutral' THEN 1::DOUBLE ELSE 0 END) AS neutral,
                   avg(CASE WHEN sentiment = 'Negative' THEN 1::DOUBLE ELSE 0 END) AS negative FROM sentiment"""),
        "sentiment_label_counts": _q(REVIEWS, """
            SELECT sentiment, count(*) AS n, count(*) * 100::DOUBLE / sum(count(*)) OVER () AS pct
            FROM sentiment GROUP BY 1"""),
        "sentiment_by_star": _q(REVIEWS, """
            SELECT review_score, count(*) FILTER (WHERE sentiment = 'Positive') AS "Positive",
                   count(*) FILTER (WHERE sentiment = 'Neutral') AS "Neutral",
                   count(*) FILTER (WHERE sentiment = 'Negative') AS "Negative" FROM sentiment GROUP BY 1"""),
        "sentiment_by_star_pct": _q(REVIEWS, """
            SELECT review_score,
                   CAST(count(*) FILTER (WHERE sentiment = 'Positive') AS DOUBLE) / count(*) * 100 AS "Positive",
                   CAST(count(*) FILTER (WHERE sentiment = 'Neutral') AS DOUBLE) / count(*) * 100 AS "Neutral",
                   CAST(count(*) FILTER (WHERE sentiment = 'Negative') AS DOUBLE) / count(*) * 100 AS "Negative"
            FROM sentiment GROUP BY 1"""),
        "category_join": _q(CATEGORIES, "SELECT * FROM categories"),
        "category_join_shuffled": _q(CATEGORIES, "SELECT * FROM categories"),
        "category_orphans": _q(CATEGORIES, """
            SELECT *, CAST(unknown_rows AS DOUBLE) / joined_rows AS unknown_share,
                   CAST(unknown_rows AS DOUBLE) / joined_rows > 0.2::DOUBLE AS is_poor
            FROM (SELECT count(*) AS joined_rows, count(*) FILTER (WHERE category = 'Unknown') AS unknown_rows
                  FROM categories)"""),
        "category_stats": _q(STATS, "SELECT * FROM stats"),
        "category_top5": _q(STATS, "SELECT *, left(category, 30) AS label FROM stats ORDER BY avg_stars DESC, category LIMIT 5"),
        "category_top10": _q(STATS, "SELECT *, left(category, 30) AS label FROM stats ORDER BY avg_stars DESC, category LIMIT 10"),
        "category_bottom10": _q(STATS, "SELECT *, left(category, 30) AS label FROM stats ORDER BY avg_stars, category DESC LIMIT 10"),
        "category_most_complained": _q(STATS, """
            SELECT category, left(category, 35) AS label, review_count, avg_stars, pct_negative,
                   pct_negative * 100 AS neg_pct, pct_negative * 100 > 20 AS is_red
            FROM stats ORDER BY pct_negative DESC, category LIMIT 15"""),
        "category_overall_avg": _q(STATS, """
            SELECT count(*) AS categories, CAST(sum(CAST(round(avg_stars * 100) AS BIGINT)) AS DOUBLE) / (count(*) * 100) AS avg_stars,
                   CAST(sum(CAST(round(pct_negative * 1000) AS BIGINT)) AS DOUBLE) / (count(*) * 1000) * 100
                     AS avg_negative_pct FROM stats"""),
        "dim_category_sentiment": _q(CATEGORIES, f"""
            SELECT category, count(*) AS review_count, round(avg(star_rating), 2) AS avg_stars,
                   {pct.format("sentiment = 'Positive'", 1)} AS pct_positive,
                   {pct.format("sentiment = 'Negative'", 1)} AS pct_negative,
                   {pct.format("sentiment = 'Neutral'", 1)} AS pct_neutral,
                   mode(sentiment ORDER BY sentiment) AS dominant_sentiment,
                   100::DOUBLE * count(*) FILTER (WHERE sentiment = 'Negative') / count(*) > 30
                     AS is_high_complaint_category
            FROM categories WHERE category <> 'Unknown' GROUP BY 1 HAVING count(*) >= 3"""),
    }


# ---- model requests and replies -------------------------------------------

PLACED = f"""{REVIEWS},
placed AS (
  SELECT review_id, raw_label, review_comment_message AS text,
         CAST(floor(CAST(review_id AS BIGINT) / 10) AS BIGINT) AS batch_id,
         row_number() OVER (PARTITION BY floor(CAST(review_id AS BIGINT) / 10)
                            ORDER BY CAST(review_id AS BIGINT)) - 1 AS position
  FROM reviews WHERE review_comment_message IS NOT NULL)"""


PARSED = f"""{PLACED},
kinds AS (SELECT batch_id, sum(length(text)) % 5 AS kind FROM placed GROUP BY 1),
parsed AS (
  SELECT review_id, batch_id, CAST(position AS INTEGER) AS position, raw_label,
         CASE WHEN kind IN (2, 3) OR (kind = 1 AND position = 2) THEN 'Neutral' ELSE {NORMALISED} END AS sentiment,
         kind = 2 AS is_error
  FROM placed JOIN kinds USING (batch_id))"""


# Half of the reviews in drawing order, ten to a request; requests of some lengths fail.
JOB = f"""{REVIEWS},
drawn AS (
  SELECT *, row_number() OVER (ORDER BY {_rank("CAST(review_id AS BIGINT)")}, CAST(review_id AS BIGINT)) - 1 AS row_idx
  FROM reviews WHERE review_comment_message IS NOT NULL
  QUALIFY row_idx < count(*) OVER () // 2),
batched AS (SELECT *, row_idx // 10 AS batch_id, row_idx % 10 AS position FROM drawn),
requests AS (
  SELECT batch_id, (length('Classify these reviews:') + 2 + length(
           string_agg('[' || position || '] ' || review_comment_message, chr(10)))) % 5 = 0 AS is_error
  FROM batched GROUP BY 1),
job AS (SELECT * FROM batched JOIN requests USING (batch_id))"""


def _stems(column: str, stems: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{stem}')" for stem in stems) + ")"


def model_calls() -> dict[str, str]:
    return {
        "review_requests": _q(PLACED, """
            SELECT batch_id, count(*) AS reviews,
                   'Classify these reviews:' || chr(10) || chr(10)
                     || string_agg('[' || position || '] ' || text, chr(10) ORDER BY position) AS request
            FROM placed GROUP BY 1"""),
        # The outcome each kind of reply must have, told from the kind alone.
        "provider_parse": _q(PARSED, "SELECT * FROM parsed"),
        "classification_audit": _q(PARSED, f"""
            SELECT count(*) AS n, count(*) FILTER (WHERE is_error) AS errors,
                   count(*) FILTER (WHERE sentiment NOT IN ({_list(S.SENTIMENTS)})) AS invalid_labels,
                   count(*) FILTER (WHERE NOT is_error) AS usable FROM parsed"""),
        "mart_csv_roundtrip": flows()["fct_delivery_by_state"],
        "provider_classify": _q(PLACED, f"""
            SELECT review_id, CASE WHEN {_stems("text", S.POSITIVE_STEMS)} THEN 'Positive'
                                   WHEN {_stems("text", S.NEGATIVE_STEMS)} THEN 'Negative'
                                   ELSE 'Neutral' END AS sentiment,
                   false AS is_error FROM placed"""),
        "sentiment_job_accepted": _q(JOB, f"""
            SELECT review_id, order_id, review_score, review_comment_message, review_creation_date,
                   CASE WHEN {_stems("review_comment_message", S.POSITIVE_STEMS)} THEN 'Positive'
                        WHEN {_stems("review_comment_message", S.NEGATIVE_STEMS)} THEN 'Negative'
                        ELSE 'Neutral' END AS sentiment
            FROM job WHERE NOT is_error"""),
        "sentiment_job_rejected": _q(JOB, """
            SELECT review_id, batch_id, CAST(position AS INTEGER) AS position FROM job WHERE is_error"""),
        "review_csv_roundtrip": _q(REVIEWS, "SELECT * EXCLUDE (raw_label) FROM reviews"),
        "table_roundtrip": _q(RAW_LOGS, """
            SELECT target_table, status, count(*) AS n, CAST(sum(execution_time_ms) AS BIGINT) AS total_ms
            FROM raw_logs GROUP BY 1, 2"""),
    }


# ---- quality --------------------------------------------------------------

# Later blocks open with the review tables, so every flow appears once.
_NAMED = (
    CLEAN
    + ","
    + DELIVERY
    + ","
    + STATS.replace("categories AS (", "category_sentiment AS (", 1).replace("FROM categories", "FROM category_sentiment")
)


def _marts() -> str:
    queries = flows()

    def body(name: str, ctes: str) -> str:
        return queries[name].removeprefix(f"WITH {ctes.strip()}\n")

    category = body("dim_category_sentiment", CATEGORIES).replace("FROM categories", "FROM category_sentiment")
    return f"""{_NAMED},
clean_logs AS (SELECT * FROM clean),
stg_server_logs AS ({body("stg_server_logs", RAW_LOGS)}),
stg_delivery_orders AS ({body("stg_delivery_orders", DELIVERY)}),
stg_reviews AS ({body("stg_reviews", REVIEWS)}),
fct_server_health AS ({body("fct_server_health", CLEAN)}),
fct_delivery_by_state AS ({body("fct_delivery_by_state", DELIVERY)}),
dim_category_sentiment AS ({category})"""


def _column_test(test: ColumnTest) -> str:
    column = f'"{test.column}"'
    failures = {
        NOT_NULL: f"SELECT count(*) FROM {test.relation} WHERE {column} IS NULL",
        ACCEPTED: f"SELECT count(*) FROM {test.relation} WHERE {column} NOT IN ({_list(test.allowed)})",
        UNIQUE: f"SELECT count(*) FROM (SELECT {column} FROM {test.relation} WHERE {column} IS NOT NULL "
        f"GROUP BY 1 HAVING count(*) > 1)",
    }[test.kind]
    return (
        f"SELECT '{test.relation}' AS relation, '{test.column}' AS \"column\", '{test.kind}' AS test, "
        f"({failures}) AS failures"
    )


def _not_in(relation: str, column: str, allowed: list[str]) -> str:
    return f"SELECT count(*) FROM {relation} WHERE {column} IS NULL OR {column} NOT IN ({_list(allowed)})"


def _contract_rows() -> list[tuple]:
    """(phase, table, check, figure, condition on x, detail from x, level)."""
    got, nulls = "format('Got {:,}', x)", "x || ' nulls'"
    pct, pct1 = "printf('%.2f%%', x * 100)", "printf('%.1f%%', x * 100)"
    other = "x || ' other values'"
    raw_nulls = " + ".join(f'count(*) FILTER (WHERE "{c}" IS NULL)' for c in S.RAW_LOGS.fieldNames())
    p1, p2, p3, cross = "Phase 1", "Phase 2", "Phase 3", "Cross-phase"
    exists = "'Found: True'"
    count = "SELECT count(*) FROM {} WHERE {}"

    def share(relation: str, condition: str) -> str:
        return f"SELECT avg(CASE WHEN {condition} THEN 1::DOUBLE ELSE 0 END) FROM {relation}"

    counts_match = "(SELECT count(*) FROM raw_logs) = (SELECT count(*) FROM clean_logs)"
    two = "format('{0}={{:,}}  {1}={{:,}}', (SELECT count(*) FROM {2}), ({3}))"
    orders = "SELECT count(DISTINCT order_id) FROM delivery"
    ids = "SELECT count(DISTINCT review_id) FROM sentiment"
    stars = "SELECT coalesce(avg(CASE WHEN sentiment IN ({}) THEN 1::DOUBLE ELSE 0 END), 0) FROM sentiment WHERE review_score = {}"
    return [
        *[(p, t, "Table exists", "SELECT 1", "true", exists, "FAIL") for p, t in (
            (p1, "raw_logs"), (p1, "clean_logs"), (p2, "delivery"), (p3, "sentiment"), (p3, "category_sentiment"))],
        (p1, "raw_logs", "Row count = 15,000", "SELECT count(*) FROM raw_logs", "x = 15000", got, "FAIL"),
        (p1, "raw_logs", "No nulls in any column", f"SELECT {raw_nulls} FROM raw_logs", "x = 0",
         "x || ' nulls found'", "FAIL"),
        (p1, "raw_logs", "execution_time_ms > 0", count.format("raw_logs", "execution_time_ms <= 0"), "x = 0",
         "x || ' invalid rows'", "FAIL"),
        (p1, "raw_logs", "server_cpu_load in [0, 100]",
         count.format("raw_logs", "server_cpu_load NOT BETWEEN 0 AND 100"), "x = 0", "x || ' out of range'", "FAIL"),
        (p1, "raw_logs", "status values valid", _not_in("raw_logs", "status", S.STATUSES), "x = 0", other, "FAIL"),
        (p1, "raw_logs", "query_type values valid", _not_in("raw_logs", "query_type", S.QUERY_TYPES), "x = 0", other,
         "FAIL"),
        (p1, "raw_logs", "target_table values valid", _not_in("raw_logs", "target_table", S.TARGET_TABLES), "x = 0",
         other, "FAIL"),
        (p1, "raw_logs", "Timeout rate in [1%, 10%]", share("raw_logs", "status = 'TIMEOUT'"),
         "x BETWEEN 0.01 AND 0.1", pct, "WARN"),
        (p1, "clean_logs", "Row count matches raw_logs", "SELECT 0", counts_match,
         two.format("clean", "raw", "clean_logs", "SELECT count(*) FROM raw_logs"), "FAIL"),
        (p1, "clean_logs", "risk_level values valid", _not_in("clean_logs", "risk_level", S.RISK_LEVELS), "x = 0",
         other, "FAIL"),
        (p1, "clean_logs", "is_anomaly is binary", count.format("clean_logs", "is_anomaly NOT IN (0, 1)"), "x = 0",
         "x || ' invalid values'", "FAIL"),
        (p1, "clean_logs", "No nulls in risk columns", count.format("clean_logs",
         "risk_level IS NULL OR is_anomaly IS NULL OR anomaly_score IS NULL"), "x = 0", nulls, "FAIL"),
        (p1, "clean_logs", "CRITICAL share < 15%", share("clean_logs", "risk_level = 'CRITICAL'"), "x < 0.15", pct,
         "WARN"),
        (p2, "delivery", "Row count > 90,000", "SELECT count(*) FROM delivery", "x > 90000", got, "FAIL"),
        (p2, "delivery", "No nulls in key columns", count.format("delivery",
         "customer_state IS NULL OR delivery_days IS NULL OR is_late IS NULL"), "x = 0", nulls, "FAIL"),
        (p2, "delivery", "delivery_days >= 0", count.format("delivery", "delivery_days < 0"), "x = 0",
         "x || ' negative values'", "FAIL"),
        (p2, "delivery", "delivery_days < 365 days", count.format("delivery", "delivery_days > 365"), "x = 0",
         "x || ' extreme rows'", "WARN"),
        (p2, "delivery", "is_late is binary", count.format("delivery", "is_late NOT IN (0, 1)"), "x = 0",
         "x || ' invalid values'", "FAIL"),
        (p2, "delivery", "Late rate in [2%, 20%]", "SELECT avg(CAST(is_late AS DOUBLE)) FROM delivery",
         "x BETWEEN 0.02 AND 0.2", pct, "WARN"),
        (p2, "delivery", "Avg delivery in [5, 30] days", "SELECT avg(delivery_days) FROM delivery",
         "x BETWEEN 5 AND 30", "printf('%.1f days', x)", "WARN"),
        (p2, "delivery", "state_name column present", "SELECT 0", "true", "'present'", "FAIL"),
        (p2, "delivery", "country column present", "SELECT 0", "true", "'present'", "FAIL"),
        (p2, "delivery", "country = Brazil only", _not_in("delivery", "country", ["Brazil"]),
         "x = 0 AND (SELECT count(*) FROM delivery) > 0", other, "FAIL"),
        (p2, "delivery", "No duplicate order_ids", "SELECT 0", f"(SELECT count(*) FROM delivery) = ({orders})",
         two.format("total", "unique", "delivery", orders), "WARN"),
        (p3, "sentiment", "Row count > 0", "SELECT count(*) FROM sentiment", "x > 0", got, "FAIL"),
        (p3, "sentiment", "sentiment values valid", _not_in("sentiment", "sentiment", S.SENTIMENTS), "x = 0", other,
         "FAIL"),
        (p3, "sentiment", "review_score in [1, 5]", count.format("sentiment", "review_score NOT BETWEEN 1 AND 5"),
         "x = 0", "x || ' out-of-range'", "FAIL"),
        (p3, "sentiment", "No nulls in sentiment/review_score", count.format("sentiment",
         "sentiment IS NULL OR review_score IS NULL"), "x = 0", nulls, "FAIL"),
        (p3, "sentiment", "5-star mostly Positive/Neutral (>60%)", stars.format("'Positive', 'Neutral'", 5),
         "x >= 0.6", pct1, "WARN"),
        (p3, "sentiment", "1-star mostly Negative/Neutral (>60%)", stars.format("'Negative', 'Neutral'", 1),
         "x >= 0.6", pct1, "WARN"),
        (p3, "category_sentiment", "Row count > 0", "SELECT count(*) FROM category_sentiment", "x > 0", got, "FAIL"),
        (p3, "category_sentiment", "No nulls in category/sentiment", count.format("category_sentiment",
         "category IS NULL OR sentiment IS NULL"), "x = 0", nulls, "FAIL"),
        (p3, "category_sentiment", "sentiment values valid",
         _not_in("category_sentiment", "sentiment", S.SENTIMENTS), "x = 0", other, "FAIL"),
        (p3, "category_sentiment", "star_rating in [1, 5]",
         count.format("category_sentiment", "star_rating NOT BETWEEN 1 AND 5"), "x = 0", "x || ' out-of-range'",
         "FAIL"),
        (p3, "category_sentiment", "At least 5 distinct categories",
         "SELECT count(DISTINCT category) FROM category_sentiment", "x >= 5", "'Found ' || x", "FAIL"),
        (cross, "raw_logs <-> clean_logs", "Row counts match", "SELECT 0", counts_match,
         two.format("raw", "clean", "raw_logs", "SELECT count(*) FROM clean_logs"), "FAIL"),
        (cross, "clean_logs", "All rows have a risk_level", count.format("clean_logs", "risk_level IS NULL"), "x = 0",
         "x || ' unclassified'", "FAIL"),
        (cross, "sentiment", "No duplicate review_ids", "SELECT 0", f"(SELECT count(*) FROM sentiment) = ({ids})",
         two.format("total", "unique", "sentiment", ids), "FAIL"),
    ]


def _contract_sql() -> str:
    rows = [
        f"SELECT '{phase}' AS phase, '{table}' AS \"table\", '{check}' AS \"check\", "
        f"CASE WHEN {condition} THEN 'PASS' ELSE '{level}' END AS status, {detail} AS detail FROM (SELECT ({figure}) AS x)"
        for phase, table, check, figure, condition, detail, level in _contract_rows()
    ]
    return "\nUNION ALL ".join(rows)


def _export_sql() -> str:
    """The outcome of the export checks, told from the tables that were exported."""
    relations = {
        "synthetic_sql_logs.csv": ("raw_logs", 14_000),
        "processed_logs.csv": ("clean_logs", 14_000),
        "delivery_analysis.csv": ("delivery", 90_000),
        "enriched_customer_sentiment.csv": ("sentiment", 100),
        "category_sentiment.csv": ("category_sentiment", 50),
        "category_stats.csv": ("stats", 3),
    }
    rows = []
    for file, (relation, least) in relations.items():
        head = f"SELECT 'Exports' AS phase, '{file}' AS \"table\", "
        rows += [
            f"{head} 'File exists' AS \"check\", 'PASS' AS status, '/{file}' AS detail",
            f"{head} 'Row count >= {least:,}', CASE WHEN count(*) >= {least} THEN 'PASS' ELSE 'FAIL' END, "
            f"format('Got {{:,}}', count(*)) FROM {relation}",
            f"{head} 'Required columns present', 'PASS', 'All present'",
            f"{head} 'No fully-null columns', 'PASS', 'None'",
        ]
    return "\nUNION ALL ".join(rows)


# Staging views by the relation above that has their rows.
_STAGED = {
    "server_logs": "raw_logs",
    "clean_logs": "clean_logs",
    "delivery_orders": "stg_delivery_orders",
    "reviews": "stg_reviews",
}

# The columns of the mart exports, in their order.
_MART_COLUMNS = {
    "fct_server_health": "risk_level query_count pct_of_total avg_exec_ms max_exec_ms avg_cpu_pct timeout_count "
    "timeout_rate_pct peak_hour_queries orders_table_queries",
    "fct_delivery_by_state": "customer_state state_name region total_orders avg_delivery_days median_delivery_days "
    "avg_days_vs_estimate late_rate_pct early_rate_pct pct_fast pct_normal pct_slow pct_critical",
    "dim_category_sentiment": "category review_count avg_stars pct_positive pct_negative pct_neutral "
    "dominant_sentiment is_high_complaint_category",
}


def quality() -> dict[str, str]:
    tests = "\nUNION ALL ".join(_column_test(t) for t in ALL_TESTS)
    contract = _contract_sql()
    profiled = {
        "raw_logs": (S.RAW_LOGS, "raw_logs"),
        "orders_csv": (S.ORDERS, "orders_csv"),
        "customers_csv": (S.CUSTOMERS, "customers_csv"),
        "delivery": (S.DELIVERY, "delivery"),
        "reviews_csv": (S.REVIEWS, "reviews"),
        "products_csv": (S.PRODUCTS, "products_csv"),
    }
    products = """
products_csv AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, CASE WHEN p_size > 1 THEN p_brand END AS product_category_name
  FROM part)"""
    profile = "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"table\", '{c}' AS \"column\", count(*) AS rows, "
        f'count(*) FILTER (WHERE "{c}" IS NULL) AS nulls, count("{c}") = 0 AS is_empty FROM {relation}'
        for name, (schema, relation) in profiled.items()
        for c in schema.fieldNames()
    )
    keys = [("delivery", "order_id"), ("sentiment", "review_id"), ("category_sentiment", "review_id")]
    copies = "\nUNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{k}' AS key, count(*) AS rows, count(DISTINCT {k}) AS distinct_keys, "
        f"count(*) - count(DISTINCT {k}) AS duplicates FROM {t}"
        for t, k in keys
    )
    stored = ["raw_logs", "clean_logs", "delivery", "sentiment", "category_sentiment", *_MART_COLUMNS]
    layers = [("table", t, t) for t in stored]
    layers += [("view", f"stg_{view}", table) for view, table in _STAGED.items()]
    listing = "\nUNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{name}' AS name, count(*) AS rows FROM {source}" for kind, name, source in layers
    )
    described = ", ".join(
        f"('{mart}.csv', CAST({i} AS INT), '{c}')" for mart, cs in _MART_COLUMNS.items() for i, c in enumerate(cs.split())
    )
    return {
        "layer_listing": _q(_marts(), listing),
        "layer_mart": flows()["fct_delivery_by_state"],
        "export_columns": f'SELECT * FROM (VALUES {described}) AS v(file, position, "column")',
        "dq_column_tests": _q(
            _marts(), f"SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({tests})"
        ),
        "dq_contract_report": _q(_marts(), contract),
        "dq_status_totals": _q(_marts(), f"""
            SELECT count(*) AS checks, count(*) FILTER (WHERE status = 'PASS') AS pass,
                   count(*) FILTER (WHERE status = 'WARN') AS warn, count(*) FILTER (WHERE status = 'FAIL') AS fail
            FROM ({contract})"""),
        "export_roundtrip": _q(_marts(), _export_sql()),
        "dq_null_profile": _q(f"{RAW_LOGS},{DELIVERY},{REVIEWS},{products}", profile),
        "dq_duplicates": _q(_NAMED, copies),
    }


def all_queries() -> dict[str, str]:
    return {**flows(), **model_calls(), **quality()}
