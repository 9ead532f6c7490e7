"""Column expressions for flags, scores and severities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardvigil.config import RiskConfig
from cardvigil.schema import FLAG_COLUMNS


def _bit(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def zscore(amount: Column, mean: Column, stddev: Column) -> Column:
    """Distance from the card's own mean; 0.0 where there is no spread to measure by."""
    return F.when(stddev > 0, (amount.cast("double") - mean) / stddev).otherwise(F.lit(0.0))


def per_minute(count_10min: Column) -> Column:
    return F.round(count_10min / F.lit(10.0), 2)


def flags(cfg: RiskConfig, home: Column | None = None) -> dict[str, Column]:
    """The five risk flags over a frame with amounts, counts and z-scores.

    ``home`` replaces the constant home country, e.g. with a joined column.
    """
    home = F.lit(cfg.home_country) if home is None else home
    hour = F.hour("transaction_timestamp")
    return {
        "is_night_txn": _bit(hour.between(cfg.night_from_hour, cfg.night_to_hour)),
        "is_foreign_merchant": _bit(F.col("merchant_country") != home),
        "is_high_amount": _bit(F.col("amount") > cfg.high_amount),
        "is_velocity_spike": _bit(F.col("txn_per_minute") > cfg.velocity_per_min),
        "is_amount_anomaly": _bit(F.col("zscore_amount") > cfg.zscore),
    }


# Points per raised flag. Integers, so that a score sitting on a threshold is
# exactly on it. No flag alerts alone; every severity can be reached.
POINTS = {
    "is_night_txn": 15,
    "is_foreign_merchant": 30,
    "is_high_amount": 35,
    "is_velocity_spike": 35,
    "is_amount_anomaly": 35,
}


def risk_score() -> Column:
    """Sum of points in [0, 1]."""
    points = sum((F.col(flag) * POINTS[flag] for flag in FLAG_COLUMNS), F.lit(0))
    return F.least(points, F.lit(100)) / F.lit(100.0)


def severity(score: Column, cfg: RiskConfig) -> Column:
    return (
        F.when(score > cfg.high_score, "HIGH")
        .when(score > cfg.medium_score, "MEDIUM")
        .otherwise("LOW")
    )


def raised_flags() -> Column:
    """Names of the flags that are 1, as an array."""
    return F.array_compact(F.array(*[F.when(F.col(f) == 1, F.lit(f)) for f in FLAG_COLUMNS]))


def alert_id(transaction_id: Column) -> Column:
    """The same transaction always yields the same alert id, so retries are harmless."""
    return F.sha2(F.concat(F.lit("alert:"), transaction_id), 256)
