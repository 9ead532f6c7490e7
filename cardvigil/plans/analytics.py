"""The four analytical queries over the raw, feature and alert tables.

Dates are arguments, never the clock: a rerun of last month's report has to
give last month's numbers.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardvigil.functions.exact import cents, rounded_percent, rounded_ratio

# Fixed values of the queries; so are the names of their output columns.
SUMMARY_DAYS = 30
MIN_CARD_TXNS = 3
TOP_CARDS = 100


def daily_fraud_summary(raw: DataFrame, as_of: date, date_column: str | None = None) -> DataFrame:
    """Per day of the last 30 days and ``as_of``'s own: volume, fraud count, rate, amount.

    Name the table's partition column in ``date_column`` to read only those days.
    """
    first = F.lit(as_of - timedelta(days=SUMMARY_DAYS))
    day = F.col(date_column) if date_column else F.to_date("transaction_timestamp")
    is_fraud = F.col("is_fraud") == 1
    fraud_amount = F.sum(F.when(is_fraud, F.col("amount")).otherwise(F.lit(0).cast("decimal(18,2)")))
    return (
        raw.filter(day >= first)
        .groupBy(day.alias("txn_date"))
        .agg(
            F.count("*").alias("total_transactions"),
            F.sum("is_fraud").alias("fraud_count"),
            rounded_percent(F.sum("is_fraud"), F.count("*"), 2).alias("fraud_rate_pct"),
            F.round(fraud_amount, 2).alias("fraud_amount_inr"),
        )
        .orderBy(F.col("txn_date").desc())
    )


def high_risk_cards(
    features: DataFrame, as_of: date, date_column: str = "_feature_date"
) -> DataFrame:
    """The busiest cards of the day before ``as_of``, with their flag counts."""
    return (
        features.filter(F.col(date_column) == F.lit(as_of - timedelta(days=1)))
        .groupBy("card_id")
        .agg(
            F.count("*").alias("suspicious_txns"),
            F.sum("is_amount_anomaly").alias("amount_anomalies"),
            F.sum("is_velocity_spike").alias("velocity_spikes"),
            F.sum("is_foreign_merchant").alias("foreign_txns"),
            F.max("zscore_amount").alias("max_zscore"),
        )
        .filter(F.col("suspicious_txns") >= MIN_CARD_TXNS)
        .orderBy(F.col("suspicious_txns").desc(), "card_id")
        .limit(TOP_CARDS)
    )


def fraud_by_country(raw: DataFrame) -> DataFrame:
    """Per merchant country: volume, fraud count, rate, average amount."""
    # A country's cents may outgrow 64 bits.
    total_cents = F.sum(cents(F.col("amount")).cast("decimal(19,0)"))
    mean_cents = rounded_ratio(total_cents, F.count("amount"), 0)
    return (
        raw.groupBy("merchant_country")
        .agg(
            F.count("*").alias("total_txns"),
            F.sum("is_fraud").alias("fraud_count"),
            rounded_percent(F.sum("is_fraud"), F.count("*"), 2).alias("fraud_rate_pct"),
            (mean_cents / 100).alias("avg_txn_amount"),
        )
        .orderBy(F.col("fraud_rate_pct").desc(), "merchant_country")
    )


def alert_resolution_rate(alerts: DataFrame) -> DataFrame:
    """Per creation day and severity: alerts, resolved alerts, rate."""
    resolved = F.count_if("is_resolved")
    return (
        alerts.groupBy(F.to_date("_created_at").alias("alert_date"), "alert_severity")
        .agg(
            F.count("*").alias("total_alerts"),
            resolved.alias("resolved_alerts"),
            rounded_percent(resolved, F.count("*"), 1).alias("resolution_rate_pct"),
        )
        .orderBy(F.col("alert_date").desc(), "alert_severity")
    )
