"""Table contracts and reference values."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
MONEY_SUM = T.DecimalType(20, 2)

# ---- fixed values: the event contract, its domains and the plan catalog ----

EVENT_SCHEMA_VERSION = "1.0"

EVENT_TYPES = [
    "subscription_created",
    "subscription_renewed",
    "subscription_upgraded",
    "subscription_downgraded",
    "subscription_cancelled",
    "payment_failed",
]
BILLING_CYCLES = ["monthly"]
CURRENCIES = ["USD"]
STATUSES = ["active", "cancelled", "past_due"]
SOURCES = ["web", "mobile", "system"]

# plan, tier (lowest first), billing cycle, price
PLANS = [
    ("basic_monthly", 0, "monthly", "9.99"),
    ("pro_monthly", 1, "monthly", "29.99"),
    ("enterprise_monthly", 2, "monthly", "99.99"),
]
LOWEST_PLAN = "basic_monthly"
HIGHEST_PLAN = "enterprise_monthly"
TOP_TIER = 2

STATUS_AFTER = {
    "subscription_created": "active",
    "subscription_renewed": "active",
    "subscription_upgraded": "active",
    "subscription_downgraded": "active",
    "subscription_cancelled": "cancelled",
    "payment_failed": "past_due",
}

# events that may follow a status; upgrades and downgrades also depend on the plan
MAY_FOLLOW = {
    "active": [
        "subscription_renewed",
        "payment_failed",
        "subscription_cancelled",
        "subscription_upgraded",
        "subscription_downgraded",
    ],
    "past_due": ["subscription_renewed", "subscription_cancelled"],
    "cancelled": [],
}

KPI_CURRENCY = "USD"

# ---- tables ----

EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("schema_version", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("subscription_id", T.StringType()),
        T.StructField("plan_id", T.StringType()),
        T.StructField("billing_cycle", T.StringType()),
        T.StructField("price", MONEY),
        T.StructField("currency", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)
EVENT_COLUMNS = EVENT.fieldNames()

# the same record before parsing: every field as the text the producer sent
EVENT_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in EVENT_COLUMNS])

HISTORY_COLUMNS = [
    "event_id",
    "event_time",
    "subscription_id",
    "user_id",
    "plan_id",
    "billing_cycle",
    "price",
    "currency",
    "status",
    "event_type",
    "ingested_at",
]

CURRENT = T.StructType(
    [
        T.StructField("subscription_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("current_plan_id", T.StringType()),
        T.StructField("current_billing_cycle", T.StringType()),
        T.StructField("current_price", MONEY),
        T.StructField("currency", T.StringType()),
        T.StructField("current_status", T.StringType()),
        T.StructField("last_event_type", T.StringType()),
        T.StructField("last_event_time", T.TimestampType()),
        T.StructField("snapshot_time", T.TimestampType()),
    ]
)

# the stored snapshot also keeps its last event's place among events of equal time
STORED_CURRENT = T.StructType(
    [
        *CURRENT,
        T.StructField("last_ingested_at", T.TimestampType()),
        T.StructField("last_event_id", T.StringType()),
    ]
)

# fixed values: snapshot column -> history column it must agree with
CURRENT_FROM_HISTORY = {
    "current_plan_id": "plan_id",
    "current_billing_cycle": "billing_cycle",
    "current_price": "price",
    "current_status": "status",
    "last_event_type": "event_type",
    "last_event_time": "event_time",
}

KPI = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("new_subscriptions", T.LongType()),
        T.StructField("new_cancellations", T.LongType()),
        T.StructField("active_subscriptions", T.LongType()),
        T.StructField("mrr", MONEY_SUM),
        T.StructField("currency", T.StringType()),
        T.StructField("snapshot_time", T.TimestampType()),
    ]
)

# end-of-day states, one per subscription and date
DAY_STATE = T.StructType(
    [
        T.StructField("subscription_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("active", T.BooleanType()),
        T.StructField("price", MONEY),
        T.StructField("created", T.BooleanType()),
        T.StructField("cancelled", T.BooleanType()),
    ]
)

CONTROL = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("last_processed_ingested_at", T.TimestampType()),
        T.StructField("affected_start", T.DateType()),
        T.StructField("affected_dates", T.ArrayType(T.DateType())),
        T.StructField("upstream_sequence", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)

CHECK = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("violation_count", T.LongType()),
        T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    ]
)


def plan_catalog(spark: SparkSession) -> DataFrame:
    """The plan catalog as a table of three rows: safe to broadcast at any data size."""
    rows = ", ".join(
        f"('{plan}', {tier}, '{cycle}', CAST('{price}' AS DECIMAL(10,2)))"
        for plan, tier, cycle, price in PLANS
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(plan_id, tier, billing_cycle, price)")


def status_after_event(spark: SparkSession) -> DataFrame:
    """Event type -> resulting status, six rows."""
    rows = ", ".join(f"('{e}', '{s}')" for e, s in STATUS_AFTER.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(event_type, expected_status)")


def require_columns(df: DataFrame, columns, what: str) -> None:
    """Raise ``ValueError`` when ``df`` lacks a column; looks at the schema only, runs no job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns: {missing}")
