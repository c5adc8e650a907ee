"""Contracts of the streams and tables, as fixed schemas."""

from __future__ import annotations

from pyspark.sql import types as T

LOCATION = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])

PAYMENT_EVENT = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("amount", T.LongType()),
    T.StructField("currency", T.StringType()),
    T.StructField("location", LOCATION),
    T.StructField("ip_address", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("failure_reason", T.StringType()),
    T.StructField("txn_type", T.StringType()),
    T.StructField("original_txn_id", T.StringType()),
    T.StructField("experiment_group", T.StringType()),
])

USER_PROFILE = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("full_name", T.StringType()),
    T.StructField("kyc_status", T.StringType()),
    T.StructField("account_tier", T.StringType()),
    T.StructField("risk_score_baseline", T.DoubleType()),
    T.StructField("home_country", T.StringType()),
    T.StructField("updated_at", T.StringType()),
])

FRAUD_RULE = T.StructType([
    T.StructField("rule_id", T.StringType()),
    T.StructField("rule_type", T.StringType()),
    T.StructField("scope", T.MapType(T.StringType(), T.StringType())),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("action", T.StringType()),
    T.StructField("priority", T.LongType()),
    T.StructField("enabled", T.BooleanType()),
    T.StructField("effective_from", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("updated_at", T.StringType()),
])

REDEMPTION = T.StructType([
    T.StructField("redemption_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("points_spent", T.LongType()),
    T.StructField("reward_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

FRAUD_LABEL = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("is_fraud_confirmed", T.BooleanType()),
    T.StructField("label_source", T.StringType()),
    T.StructField("resolved_at", T.StringType()),
])

INJECTED_TRUTH = T.StructType([
    T.StructField("fraud_type", T.StringType()),
    T.StructField("transaction_ids", T.ArrayType(T.StringType())),
    T.StructField("detail", T.MapType(T.StringType(), T.StringType())),
    T.StructField("injected_at", T.StringType()),
])


def change_of(record: T.StructType) -> T.StructType:
    """Envelope of a change record: the row before, the row after and the operation."""
    return T.StructType([
        T.StructField("before", record),
        T.StructField("after", record),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ])


# Accepted values of the enumerated columns.
STATUSES = ("SUCCESS", "FAILED", "PENDING")
CHANNELS = ("POS", "WEB", "APP")
TIERS = ("BRONZE", "SILVER", "GOLD", "VIP")
LIFECYCLE_STATES = (
    "HIGH_RISK_SUSPENDED", "NEW", "CHURNED", "DORMANT", "AT_RISK", "HIGHLY_ACTIVE", "ACTIVE",
)
INDUSTRIES = ("F&B", "Retail", "Travel")
