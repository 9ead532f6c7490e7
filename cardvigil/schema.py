"""Table contracts: raw transactions, features, alerts, resolutions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

AMOUNT = T.DecimalType(18, 2)

# The column names and order of the three tables.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("card_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("amount", AMOUNT),
        T.StructField("currency", T.StringType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("merchant_city", T.StringType()),
        T.StructField("merchant_country", T.StringType()),
        T.StructField("transaction_timestamp", T.TimestampType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("card_present", T.BooleanType()),
        T.StructField("device_id", T.StringType()),
    ]
)

FEATURE_COLUMNS = [
    "transaction_id",
    "card_id",
    "customer_id",
    "amount",
    "merchant_country",
    "transaction_timestamp",
    "transaction_type",
    "txn_count_1h",
    "txn_count_24h",
    "txn_count_10min",
    "avg_amount_7d",
    "avg_amount_30d",
    "max_amount_24h",
    "sum_amount_24h",
    "zscore_amount",
    "txn_per_minute",
    "is_night_txn",
    "is_foreign_merchant",
    "is_high_amount",
    "is_velocity_spike",
    "is_amount_anomaly",
    "is_fraud",
]

FLAG_COLUMNS = [
    "is_night_txn",
    "is_foreign_merchant",
    "is_high_amount",
    "is_velocity_spike",
    "is_amount_anomaly",
]

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("card_id", T.StringType()),
        T.StructField("amount", AMOUNT),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("merchant_country", T.StringType()),
        T.StructField("transaction_timestamp", T.TimestampType()),
        T.StructField("fraud_score", T.DoubleType()),
        T.StructField("fraud_flags", T.ArrayType(T.StringType())),
        T.StructField("alert_severity", T.StringType()),
        T.StructField("is_resolved", T.BooleanType()),
        T.StructField("resolved_by", T.StringType()),
        T.StructField("resolved_at", T.TimestampType()),
        T.StructField("_created_at", T.TimestampType()),
    ]
)
ALERT_COLUMNS = ALERT_SCHEMA.names

RESOLUTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("resolved_by", T.StringType()),
        T.StructField("resolved_at", T.TimestampType()),
    ]
)

# What arrives in a JSON payload: the raw record with its time still as text,
# so that a malformed time costs the field and not the record.
CORRUPT = "_corrupt_record"
CORRUPT_FIELD = T.StructField(CORRUPT, T.StringType())
WIRE_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "transaction_timestamp" else f.dataType)
        for f in RAW_SCHEMA.fields
    ]
    + [CORRUPT_FIELD]
)


@dataclass(frozen=True)
class TableContract:
    """Where a table's day comes from, how its files are ordered, what may not be NULL.

    Columns in ``find_by`` get Parquet bloom filters, for lookups the order does not serve.
    """

    name: str
    date_column: str
    time_column: str
    cluster_by: tuple[str, ...]
    not_null: tuple[str, ...]
    find_by: tuple[str, ...] = ()


RAW_TABLE = TableContract(
    name="raw_transactions",
    date_column="date",
    time_column="transaction_timestamp",
    cluster_by=("card_id", "merchant_country"),
    not_null=("transaction_id", "card_id", "transaction_timestamp"),
)
FEATURE_TABLE = TableContract(
    name="transaction_features",
    date_column="_feature_date",
    time_column="transaction_timestamp",
    cluster_by=("card_id",),
    not_null=("transaction_id", "card_id"),
)
#: Totals per card and day, at the day's first second.
DAY_TOTALS_SCHEMA = T.StructType(
    [
        T.StructField("card_id", T.StringType()),
        T.StructField("_second", T.LongType()),
        T.StructField("_ids", T.LongType()),
        T.StructField("_amounts", T.LongType()),
        T.StructField("_cents", T.LongType()),
        T.StructField("_squares", T.DecimalType(38, 0)),
        T.StructField("_top", T.LongType()),
    ]
)
DAY_TOTALS = TableContract(
    name="day_totals",
    date_column="date",
    time_column="_second",
    cluster_by=("card_id",),
    not_null=("card_id",),
)
ALERT_TABLE = TableContract(
    name="fraud_alerts",
    date_column="_alert_date",
    time_column="transaction_timestamp",
    cluster_by=("alert_severity", "card_id"),
    not_null=("alert_id", "transaction_id", "card_id"),
    find_by=("transaction_id",),
)
