"""Fixed values of the data contract: names, limits and thresholds."""

# The fields a wire event must carry, non-empty.
REQUIRED_FIELDS = ["event_id", "customer_id", "event_type", "timestamp"]

# Curation limits.
MAX_SESSION_SECONDS = 86400
MAX_TRANSACTION_AMOUNT = 100000.0
LOOKBACK_HOURS = 25

# Feature windows in days, and how far back the feature job reads.
WINDOW_DAYS = (7, 30, 90)
SOURCE_DAYS = 91
FEATURE_VERSION = "1.0"

# The model's numeric inputs, in model order.
NUMERIC_FEATURES = [
    "total_events_7d",
    "unique_sessions_7d",
    "avg_session_duration_7d",
    "std_session_duration_7d",
    "max_session_duration_7d",
    "total_transaction_amount_7d",
    "transaction_count_7d",
    "login_count_7d",
    "feature_usage_count_7d",
    "support_tickets_7d",
    "total_events_30d",
    "unique_sessions_30d",
    "avg_session_duration_30d",
    "transaction_count_30d",
    "total_transaction_amount_30d",
    "support_tickets_30d",
    "plan_downgrades_30d",
    "total_events_90d",
    "transaction_count_90d",
    "total_transaction_amount_90d",
    "days_since_last_login",
    "session_duration_trend",
    "transaction_trend",
    "feature_engagement_ratio_7d",
    "support_ticket_rate_30d",
]
CATEGORICAL_FEATURES = ["cohort", "current_plan"]
LABEL = "is_churned"
CUSTOMER = "customer_id"

# Columns a feature snapshot must have before anybody trains on it.
REQUIRED_COLUMNS = [
    "customer_id",
    "is_churned",
    "snapshot_date",
    "cohort",
    "current_plan",
    "total_events_7d",
    "total_events_30d",
    "avg_session_duration_7d",
    "days_since_last_login",
    "session_duration_trend",
    "transaction_trend",
]

# Columns of the published feature snapshot, in table order.
SNAPSHOT_COLUMNS = [
    "customer_id",
    "snapshot_date",
    "cohort",
    "current_plan",
    "customer_state",
    "is_churned",
    "last_seen_at",
    "first_seen_at",
    "total_events_all_time",
    "days_since_last_login",
    "session_duration_trend",
    "transaction_trend",
    "feature_engagement_ratio_7d",
    "support_ticket_rate_30d",
    "total_events_7d",
    "unique_sessions_7d",
    "avg_session_duration_7d",
    "std_session_duration_7d",
    "max_session_duration_7d",
    "total_transaction_amount_7d",
    "transaction_count_7d",
    "login_count_7d",
    "feature_usage_count_7d",
    "support_tickets_7d",
    "total_events_30d",
    "unique_sessions_30d",
    "avg_session_duration_30d",
    "transaction_count_30d",
    "total_transaction_amount_30d",
    "support_tickets_30d",
    "plan_downgrades_30d",
    "total_events_90d",
    "transaction_count_90d",
    "total_transaction_amount_90d",
    "_feature_version",
    "_computed_at",
]

# Gates a model must pass; the latency gate is an upper bound.
QUALITY_GATES = {
    "auc": 0.82,
    "precision": 0.75,
    "recall": 0.70,
    "p99_latency_ms": 200.0,
}

# Features whose drift weighs three times as much.
HIGH_IMPORTANCE_FEATURES = [
    "customer_tenure_months",
    "monthly_charges",
    "support_tickets_90d",
    "contract_type",
    "payment_method",
    "total_charges",
]
DRIFT_STEP = 0.05
CRITICAL_WEIGHT = 3.0
DISTRIBUTION_WEIGHT = 1.5
RETRAIN_SCORE = 0.3
RETRAIN_VIOLATIONS = 5

# Upper bounds in seconds of the request latency histogram.
LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]

# Canary limits.
CANARY_MAX_ERROR_RATE = 0.05
CANARY_MAX_P99_MS = 500.0
CANARY_MAX_RATE_DEVIATION = 0.50

# How long a stored prediction may be reused, and the key's prefix.
PREDICTION_TTL_SECONDS = 300
PREDICTION_KEY_PREFIX = "churn:pred:"
