"""Table schemas, value domains and the fixed numbers of the jobs."""

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

# ---- inputs ---------------------------------------------------------------

RAW_LOGS = _schema(
    ("timestamp", _S),
    ("query_type", _S),
    ("target_table", _S),
    ("execution_time_ms", _L),
    ("server_cpu_load", _D),
    ("status", _S),
)
ORDERS = _schema(
    ("order_id", _S),
    ("customer_id", _S),
    ("order_status", _S),
    ("order_purchase_timestamp", _S),
    ("order_delivered_customer_date", _S),
    ("order_estimated_delivery_date", _S),
)
CUSTOMERS = _schema(("customer_id", _S), ("customer_state", _S))
REVIEWS = _schema(
    ("review_id", _S),
    ("order_id", _S),
    ("review_score", _I),
    ("review_comment_message", _S),
    ("review_creation_date", _S),
)
ITEMS = _schema(("order_id", _S), ("product_id", _S))
PRODUCTS = _schema(("product_id", _S), ("product_category_name", _S))
TRANSLATION = _schema(("product_category_name", _S), ("product_category_name_english", _S))

# ---- outputs --------------------------------------------------------------

CLEAN_LOGS = _schema(
    ("timestamp", T.TimestampType()),
    ("query_type", _S),
    ("target_table", _S),
    ("execution_time_ms", _D),
    ("server_cpu_load", _D),
    ("status", _S),
    ("hour_of_day", _I),
    ("day_of_week", _I),
    ("is_peak_hour", _I),
    ("is_slow_query", _I),
    ("is_high_cpu", _I),
    ("is_orders_table", _I),
    ("qt_code", _I),
    ("tbl_code", _I),
    ("log_exec_time", _D),
    ("anomaly_score", _D),
    ("is_anomaly", _I),
    ("risk_level", _S),
)
DELIVERY = _schema(
    ("order_id", _S),
    ("customer_state", _S),
    ("state_name", _S),
    ("country", _S),
    ("region", _S),
    ("delivery_days", _D),
    ("days_vs_estimate", _D),
    ("is_late", _I),
    ("is_early", _I),
    ("days_late", _D),
    ("delivery_bucket", _S),
    ("estimate_label", _S),
    ("performance_flag", _S),
    ("purchase_month", _S),
    ("month_name", _S),
    ("month_sort", _I),
)
SENTIMENT = _schema(*[(f.name, f.dataType) for f in REVIEWS.fields], ("sentiment", _S))
CATEGORY_SENTIMENT = _schema(
    ("review_id", _S),
    ("order_id", _S),
    ("star_rating", _I),
    ("sentiment", _S),
    ("category", _S),
    ("review_comment_message", _S),
)
CATEGORY_STATS = _schema(
    ("category", _S),
    ("review_count", _L),
    ("avg_stars", _D),
    ("pct_positive", _D),
    ("pct_negative", _D),
    ("pct_neutral", _D),
)
CHECK_RESULTS = _schema(("phase", _S), ("table", _S), ("check", _S), ("status", _S), ("detail", _S))

# ---- fixed values: domains, codes, thresholds and limits ------------------

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

QUERY_TYPES = ["SELECT", "INSERT", "UPDATE", "DELETE"]
TARGET_TABLES = ["orders", "customers", "products", "order_items", "order_reviews"]
QUERY_CODES = {"SELECT": 0, "INSERT": 1, "UPDATE": 2, "DELETE": 3}
TABLE_CODES = {"orders": 0, "customers": 1, "products": 2, "order_items": 3, "order_reviews": 4}
STATUSES = ["SUCCESS", "TIMEOUT"]
RISK_LEVELS = ["CRITICAL", "WARNING", "OK"]
PERFORMANCE_FLAGS = ["Fast", "Normal", "Slow", "Critical"]
SENTIMENTS = ["Positive", "Neutral", "Negative"]
COUNTRY = "Brazil"

TIMEOUT_MS = 2000
HIGH_CPU_PCT = 75
PEAK_HOURS = (18, 22)

STATE_NAMES = {
    "AC": "Acre",
    "AL": "Alagoas",
    "AP": "Amapá",
    "AM": "Amazonas",
    "BA": "Bahia",
    "CE": "Ceará",
    "DF": "Distrito Federal",
    "ES": "Espírito Santo",
    "GO": "Goiás",
    "MA": "Maranhão",
    "MT": "Mato Grosso",
    "MS": "Mato Grosso do Sul",
    "MG": "Minas Gerais",
    "PA": "Pará",
    "PB": "Paraíba",
    "PR": "Paraná",
    "PE": "Pernambuco",
    "PI": "Piauí",
    "RJ": "Rio de Janeiro",
    "RN": "Rio Grande do Norte",
    "RS": "Rio Grande do Sul",
    "RO": "Rondônia",
    "RR": "Roraima",
    "SC": "Santa Catarina",
    "SP": "São Paulo",
    "SE": "Sergipe",
    "TO": "Tocantins",
}
REGION_STATES = {
    "North": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"],
    "Northeast": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centre-West": ["DF", "GO", "MT", "MS"],
    "Southeast": ["ES", "MG", "RJ", "SP"],
    "South": ["PR", "RS", "SC"],
}
REGION_OTHER = "Other"

DELIVERY_BUCKETS = [
    (5, "1-5 days"),
    (10, "6-10 days"),
    (15, "11-15 days"),
    (20, "16-20 days"),
    (25, "21-25 days"),
]
DELIVERY_BUCKET_LAST = "25+ days"
PERFORMANCE_LIMITS = [(7, "Fast"), (14, "Normal"), (21, "Slow")]
PERFORMANCE_LAST = "Critical"

POSITIVE_STEMS = ["posit", "good", "great", "excel", "recommend", "bom", "otimo", "recomend"]
NEGATIVE_STEMS = ["negat", "bad", "poor", "terrible", "worst", "ruim", "pessim", "horrible"]

# ---- derived from the fixed values ----------------------------------------

REGIONS = [*REGION_STATES, REGION_OTHER]
STATE_REGIONS = {code: region for region, codes in REGION_STATES.items() for code in codes}
