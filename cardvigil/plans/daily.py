"""The daily chain: presence, features, validation, reconciliation, rate check, load."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardvigil.config import RiskConfig
from cardvigil.operators import quality
from cardvigil.operators.alerts import build_alerts
from cardvigil.operators.features import LOOKBACK_DAYS, features, features_for_day
from cardvigil.schema import ALERT_SCHEMA, ALERT_TABLE, CORRUPT_FIELD, FEATURE_TABLE, RAW_SCHEMA, RAW_TABLE
from cardvigil.session import pin_utc, staging
from cardvigil.sources.publish import beside, publish_days
from cardvigil.sources.raw import read_day_totals, read_json, read_raw_day
from cardvigil.sources.tables import (
    conform_features,
    load_clustered,
    merge_alerts,
    read_alerts,
    with_partition_date,
    write_aside,
)


def run_features_on_json(
    spark: SparkSession, input_path: str, output_path: str, cfg: RiskConfig = RiskConfig()
) -> DataFrame:
    """Features of all transactions in JSON files, validated and then written by date."""
    pin_utc(spark)
    # JSON is parsed once into Parquet, of which the feature plan then reads the columns
    # it needs. Features are computed once, checked as staged, and only then published.
    day = FEATURE_TABLE.date_column
    with staging(spark, RAW_TABLE.name) as parsed, beside(spark, output_path) as made:
        read_json(spark, input_path).write.parquet(parsed)
        decoded = spark.read.schema(T.StructType([*RAW_SCHEMA.fields, CORRUPT_FIELD])).parquet(parsed)
        raw = decoded.select(*RAW_SCHEMA.names)
        quality.assert_transactions(raw)
        quality.assert_all_valid(decoded)
        rows = with_partition_date(features(raw, cfg), FEATURE_TABLE)
        write_aside(rows.hint("rebalance", F.col(day)), made, FEATURE_TABLE)
        _checked(raw, spark.read.parquet(made))
        publish_days(spark, made, output_path, day)
    return spark.read.parquet(output_path)


def _checked(raw: DataFrame, made: DataFrame) -> DataFrame:
    """``made``, if the features and the raw rows they come from keep their contracts."""
    quality.assert_transactions(raw)
    quality.assert_not_null(raw, RAW_TABLE)
    quality.assert_features(made)
    quality.assert_not_null(made, FEATURE_TABLE)
    quality.assert_reconciled(raw, made)
    return made


@contextmanager
def _checked_day(
    spark: SparkSession, raw_path: str, output_path: str, run_date: date, cfg: RiskConfig, totals_path: str | None = None
) -> Iterator[DataFrame]:
    """One day's features, written beside the output and checked, and published when the caller is done.

    Raises ``QualityError`` before anything is published.
    """
    pin_utc(spark)
    raw_day = read_raw_day(spark, raw_path, run_date)
    totals = read_day_totals(spark, totals_path) if totals_path else None
    with beside(spark, output_path) as made:
        raw = read_raw_day(spark, raw_path, run_date, LOOKBACK_DAYS)
        rows = features_for_day(raw, run_date, cfg, totals=totals)
        write_aside(with_partition_date(rows, FEATURE_TABLE), made, FEATURE_TABLE)
        yield _checked(raw_day, spark.read.parquet(made))
        publish_days(spark, made, output_path, FEATURE_TABLE.date_column)


def run_features(
    spark: SparkSession,
    raw_path: str,
    output_path: str,
    run_date: date,
    cfg: RiskConfig = RiskConfig(),
    totals_path: str | None = None,
) -> DataFrame:
    """One day's features from the raw table, checked and then written as that day's partition.

    ``totals_path``: the totals per card and day that :func:`cardvigil.plans.upkeep.compact_landed`
    keeps with that raw table.
    """
    pin_utc(spark)
    quality.assert_raw_present(read_raw_day(spark, raw_path, run_date), run_date)
    with _checked_day(spark, raw_path, output_path, run_date, cfg, totals_path):
        pass
    return _day(spark.read.parquet(output_path), run_date)


def refresh_day(
    spark: SparkSession,
    raw_path: str,
    output_path: str,
    table_path: str,
    run_date: date,
    loaded_at: datetime,
    cfg: RiskConfig = RiskConfig(),
    totals_path: str | None = None,
) -> DataFrame:
    """The whole chain for one day; raises ``QualityError`` before anything is replaced."""
    pin_utc(spark)
    quality.assert_raw_present(read_raw_day(spark, raw_path, run_date), run_date)
    with _checked_day(spark, raw_path, output_path, run_date, cfg, totals_path) as day:
        quality.assert_fraud_rate(day, FEATURE_TABLE.date_column, run_date, cfg)
        load_clustered(conform_features(day, loaded_at), table_path, FEATURE_TABLE)
    return _day(spark.read.parquet(table_path), run_date)


def score_day(
    spark: SparkSession,
    raw_path: str,
    features_path: str,
    alerts_path: str,
    run_date: date,
    created_at: datetime,
    cfg: RiskConfig = RiskConfig(),
) -> DataFrame:
    """Alerts of one loaded feature day, checked and then merged into the alert table.

    An alert that is stored already stays as it is, with its resolution, also in a repeated run.
    """
    pin_utc(spark)
    day = _day(spark.read.parquet(features_path), run_date)
    raw = read_raw_day(spark, raw_path, run_date)
    with staging(spark, ALERT_TABLE.name) as made:
        build_alerts(day, F.lit(created_at).cast("timestamp"), cfg, raw).write.parquet(made)
        alerts = spark.read.schema(ALERT_SCHEMA).parquet(made)
        quality.assert_not_null(alerts, ALERT_TABLE)
        merge_alerts(spark, alerts, alerts_path)
    return _day(read_alerts(spark, alerts_path), run_date, ALERT_TABLE.date_column)


def _day(df: DataFrame, run_date: date, date_column: str = FEATURE_TABLE.date_column) -> DataFrame:
    return df.filter(F.col(date_column) == F.lit(run_date))
