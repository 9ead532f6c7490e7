"""Data-quality reports: each is one pass over its input and a small result."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardvigil.config import RiskConfig
from cardvigil.functions.exact import rounded_percent
from cardvigil.schema import TableContract
from cardvigil.sources.decode import rejected_rows


class QualityError(ValueError):
    """A blocking data-quality check failed."""


def feature_report(features: DataFrame) -> DataFrame:
    """One row: size, blocking defects, label rate, and defects of the features themselves."""
    fraud = F.count_if(F.col("is_fraud") == 1)
    return features.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("transaction_id").isNull()).alias("null_transaction_ids"),
        F.count_if(F.col("amount") < 0).alias("negative_amounts"),
        F.count_if(
            F.col("transaction_id").isNotNull()
            & (
                (F.col("txn_count_10min") < 1)
                | (F.col("txn_count_1h") < F.col("txn_count_10min"))
                | (F.col("txn_count_24h") < F.col("txn_count_1h"))
            )
        ).alias("inconsistent_counts"),
        F.count_if(F.col("zscore_amount").isNull()).alias("null_zscores"),
        fraud.alias("fraud_rows"),
        rounded_percent(fraud, F.count("*"), 2).alias("fraud_rate_pct"),
    )


def _assert_none(report: DataFrame, *defects: str) -> None:
    row = report.first()
    found = {name: row[name] for name in defects if row[name]}
    if found:
        raise QualityError(f"validation failed: {found}")


def assert_transactions(df: DataFrame) -> None:
    """Raises ``QualityError`` on a NULL transaction id or a negative amount.

    Features keep both columns, so this can be asked before they are computed.
    """
    report = df.agg(
        F.count_if(F.col("transaction_id").isNull()).alias("null_transaction_ids"),
        F.count_if(F.col("amount") < 0).alias("negative_amounts"),
    )
    _assert_none(report, "null_transaction_ids", "negative_amounts")


def assert_features(features: DataFrame) -> None:
    """The same for computed features, and for counts that contradict each other."""
    defects = ("null_transaction_ids", "negative_amounts", "inconsistent_counts")
    _assert_none(feature_report(features), *defects)


def reconcile_rows(raw: DataFrame, features: DataFrame) -> DataFrame:
    """One row: sizes of both sides and the rows of each that the other lacks.

    Rows are matched by transaction id with their multiplicity. Adding both
    sides up per id takes one shuffle with partial sums, so an id repeated a
    billion times costs no more than any other.
    """
    both = raw.select("transaction_id", F.lit(1).alias("r"), F.lit(0).alias("f")).unionAll(
        features.select("transaction_id", F.lit(0).alias("r"), F.lit(1).alias("f"))
    )
    per_id = both.groupBy("transaction_id").agg(F.sum("r").alias("r"), F.sum("f").alias("f"))
    zero = F.lit(0).cast("bigint")
    sizes = per_id.agg(
        F.coalesce(F.sum("r"), zero).alias("raw_rows"),
        F.coalesce(F.sum("f"), zero).alias("feature_rows"),
        F.coalesce(F.sum(F.greatest(F.col("r") - F.col("f"), zero)), zero).alias("missing_rows"),
        F.coalesce(F.sum(F.greatest(F.col("f") - F.col("r"), zero)), zero).alias("extra_rows"),
    )
    return sizes.withColumn(
        "is_reconciled", (F.col("missing_rows") == 0) & (F.col("extra_rows") == 0)
    )


def assert_reconciled(raw: DataFrame, features: DataFrame) -> None:
    sizes = reconcile_rows(raw, features).first()
    if not sizes["is_reconciled"]:
        raise QualityError(f"raw and feature rows differ: {sizes.asDict()}")


def fraud_rate_by_day(
    df: DataFrame, date_column: str, cfg: RiskConfig = RiskConfig()
) -> DataFrame:
    """Per day: labelled rows, rate, and whether the rate is within bounds, ends included."""
    rate = F.try_divide(F.col("fraud_rows"), F.col("total_rows"))
    return (
        df.groupBy(F.col(date_column).alias("run_date"))
        .agg(
            F.count("*").alias("total_rows"),
            F.count_if(F.col("is_fraud") == 1).alias("fraud_rows"),
        )
        .withColumn("fraud_rate", rate)
        .withColumn(
            "is_in_bounds", F.col("fraud_rate").between(cfg.min_fraud_rate, cfg.max_fraud_rate)
        )
    )


def assert_fraud_rate(
    df: DataFrame, date_column: str, run_date: date, cfg: RiskConfig = RiskConfig()
) -> None:
    day = df.filter(F.col(date_column) == F.lit(run_date))
    row = fraud_rate_by_day(day, date_column, cfg).first()
    if row is None or not row["is_in_bounds"]:
        rate = None if row is None else row["fraud_rate"]
        raise QualityError(
            f"fraud rate {rate} of {run_date} is outside "
            f"[{cfg.min_fraud_rate}, {cfg.max_fraud_rate}]"
        )


def raw_presence(raw: DataFrame, first: date, last: date, date_column: str = "date") -> DataFrame:
    """One row per calendar day from ``first`` to ``last``: rows and whether there are any."""
    spark = raw.sparkSession
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("run_date")
    )
    found = (
        raw.filter(F.col(date_column).between(F.lit(first), F.lit(last)))
        .groupBy(F.col(date_column).alias("_day"))
        .agg(F.count("*").alias("_rows"))
    )
    return days.join(found, F.col("run_date") == F.col("_day"), "left").select(
        "run_date",
        F.coalesce(F.col("_rows"), F.lit(0).cast("bigint")).alias("raw_rows"),
        F.col("_rows").isNotNull().alias("has_data"),
    )


def assert_raw_present(raw: DataFrame, run_date: date, date_column: str = "date") -> None:
    """Stops at the first row found; reads one partition at most."""
    if raw.filter(F.col(date_column) == F.lit(run_date)).limit(1).isEmpty():
        raise QualityError(f"no raw data for {run_date}")


def assert_not_null(df: DataFrame, contract: TableContract) -> None:
    """Raises ``QualityError`` if a required column of the table has a NULL."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in contract.not_null])
    _assert_none(counts, *contract.not_null)


def assert_all_valid(decoded: DataFrame) -> None:
    """Raises ``QualityError`` with the reasons if a decoded row is not valid."""
    reasons = rejected_rows(decoded).select(F.explode("reasons").alias("reason"))
    rejected = reasons.groupBy("reason").count().collect()
    if rejected:
        raise QualityError(f"rejected rows: { {r['reason']: r['count'] for r in rejected} }")


def not_null_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """One row per required column: how many of its values are NULL."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in contract.not_null])
    return counts.unpivot(
        [], list(contract.not_null), "column_name", "null_rows"
    ).withColumn("is_satisfied", F.col("null_rows") == 0)
