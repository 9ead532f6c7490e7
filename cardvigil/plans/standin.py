"""Card transactions derived from the driver's ``events``, ``nation`` and ``customer`` tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardvigil.config import RiskConfig
from cardvigil.schema import RAW_SCHEMA

AS_OF = date(2024, 1, 31)
AS_OF_TIME = datetime(2024, 1, 31)
LAST_DAY = date(2024, 1, 30)
FIRST_DAY = date(2024, 1, 1)

# Thresholds scaled to the amounts and rates that occur in `events`.
# A day from which the 30-day report does not reach back to the first event.
SUMMARY_AS_OF = date(2024, 2, 14)
# Two years after the tenth event day.
RETENTION_AS_OF = date(2026, 1, 10)

CONFIG = RiskConfig(home_country="NATION_0", high_amount=150, velocity_per_min=0.15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as raw transactions."""
    return as_transactions(table(spark, sf_dir, "events"), table(spark, sf_dir, "nation"))


def as_transactions(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Works on a stream of events as well."""
    k = F.get_json_object("props", "$.k").cast("int")
    # 25 nations at every scale factor.
    country = F.broadcast(nation.select("n_nationkey", F.col("n_name").alias("merchant_country")))
    columns = {
        "transaction_id": F.col("event_id").cast("string"),
        "card_id": F.col("user_id").cast("string"),
        "customer_id": F.col("user_id").cast("string"),
        "amount": F.col("value").cast("decimal(18,2)"),
        "currency": F.lit("INR"),
        "merchant_name": F.concat(F.lit("M"), F.col("k").cast("string")),
        "merchant_city": F.concat(F.lit("C"), F.col("k").cast("string")),
        "merchant_country": F.col("merchant_country"),
        "transaction_timestamp": F.col("ts").cast("timestamp"),
        "transaction_type": F.col("event_type"),
        "is_fraud": F.when((F.col("event_type") == "error") & (F.col("k") < 15), 1).otherwise(0),
        "card_present": F.col("event_type") == "purchase",
        "device_id": F.concat(F.lit("DEV_"), F.col("user_id").cast("string")),
    }
    return (
        events.withColumn("k", k)
        .join(country, F.col("k") % 25 == F.col("n_nationkey"), "left")
        .select(*[columns[name].alias(name) for name in RAW_SCHEMA.names])
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with the name of the home country."""
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("n_name").alias("home_country"),
        )
    )


def resolutions(alerts: DataFrame) -> DataFrame:
    """An analyst closes the alerts of every third merchant an hour after the transaction.

    Each closing is preceded by an earlier, outdated one by another user, and
    accompanied by one for an id that has no alert.
    """
    number = F.substring("merchant_name", 2, 10).cast("int")
    closed = alerts.filter(number % 3 == 0)

    def event(transaction_id: Column, by: str, after: str) -> Column:
        return F.struct(
            transaction_id.alias("transaction_id"),
            F.lit(by).alias("resolved_by"),
            (F.col("transaction_timestamp") + F.expr(after)).alias("resolved_at"),
        )

    own = F.col("transaction_id")
    events = F.array(
        event(own, "trainee", "INTERVAL 10 MINUTES"),
        event(own, "analyst", "INTERVAL 1 HOUR"),
        event(F.concat(F.lit("none-"), own), "analyst", "INTERVAL 1 HOUR"),
    )
    return closed.select(F.inline(events))
