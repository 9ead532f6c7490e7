"""Writing the raw, feature and alert tables as date-partitioned Parquet."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardvigil.config import RiskConfig
from cardvigil.operators.alerts import resolve
from cardvigil.schema import (
    ALERT_SCHEMA,
    ALERT_TABLE,
    FEATURE_COLUMNS,
    FEATURE_TABLE,
    RAW_SCHEMA,
    RAW_TABLE,
    TableContract,
)
from cardvigil.session import listed, remove_folder, staging
from cardvigil.sources import batches
from cardvigil.sources.batches import days_listed
from cardvigil.sources.publish import beside, publish_days


def with_partition_date(df: DataFrame, contract: TableContract) -> DataFrame:
    return df.withColumn(contract.date_column, F.to_date(contract.time_column))


def write_by_date(df: DataFrame, path: str, contract: TableContract) -> None:
    """Job output: partitioned by day, not clustered.

    The rebalance lets AQE cut a big day into several files and merge small
    ones, whatever the days' sizes. Only days present in ``df`` are replaced.
    """
    write_dated(with_partition_date(df, contract), path, contract)


def write_dated(df: DataFrame, path: str, contract: TableContract) -> None:
    """The same for rows that have their day already."""
    _write(df.hint("rebalance", F.col(contract.date_column)), path, contract)


def load_clustered(df: DataFrame, path: str, contract: TableContract) -> None:
    """Table load: partitioned by day and ordered by the contract's cluster columns.

    Each file covers one narrow range of cards of a day, so a lookup by card
    skips nearly all files on their min/max. Time and id close the range key:
    they let Spark cut even one card of one day into several ranges. Choosing
    the ranges reads ``df`` twice, so give it a stored table, not a long plan.
    """
    order = [*contract.cluster_by, contract.time_column, "transaction_id"]
    dated = with_partition_date(df, contract)
    ranged = dated.repartitionByRange(contract.date_column, *order)
    _write(ranged.sortWithinPartitions(contract.date_column, *order), path, contract)


def _write(df: DataFrame, path: str, contract: TableContract) -> None:
    """Replaces the days that ``df`` has rows of; others stay, and all of them until the last file is written."""
    with beside(df.sparkSession, path) as made:
        write_aside(df, made, contract)
        publish_days(df.sparkSession, made, path, contract.date_column)


def write_aside(df: DataFrame, made: str, contract: TableContract) -> None:
    """Rows that have their day, below a new folder, to be published as they are."""
    writer = df.write
    for column in contract.find_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.partitionBy(contract.date_column).parquet(made)


def conform_raw(raw: DataFrame, loaded_at: datetime) -> DataFrame:
    """Raw rows as the raw table declares them, stamped with the load time."""
    return raw.select(*RAW_SCHEMA.names, F.lit(loaded_at).cast("timestamp").alias("_loaded_at"))


def conform_features(features: DataFrame, loaded_at: datetime) -> DataFrame:
    """Feature rows as the feature table declares them, stamped with the load time."""
    dated = with_partition_date(features, FEATURE_TABLE)
    return dated.select(*FEATURE_COLUMNS, FEATURE_TABLE.date_column).withColumn(
        "_loaded_at", F.lit(loaded_at).cast("timestamp")
    )


def days_of(spark: SparkSession, path: str, date_column: str) -> list[date]:
    """The days a table has partitions of, oldest first, from its folder listing; no file is opened."""
    return days_listed(spark, path, date_column)


def on_days(df: DataFrame, days: list[date], date_column: str) -> DataFrame:
    """Rows of these days; a partition filter on a stored table."""
    return df.filter(F.col(date_column).isin(days)) if days else df.limit(0)


def merge_alerts(spark: SparkSession, new: DataFrame, table: str) -> list[date]:
    """Merges alerts into the alert table by day and ``alert_id``; returns the days touched.

    What is stored takes part: of copies of an alert a resolved one wins, then the earliest
    created, so no stored alert goes and none is opened again. Only days that ``new`` has
    rows of are read and replaced.
    """
    day = ALERT_TABLE.date_column
    with staging(spark, ALERT_TABLE.name) as given, staging(spark, ALERT_TABLE.name) as merged:
        rows = with_partition_date(new.select(*ALERT_SCHEMA.names), ALERT_TABLE)
        rows.write.partitionBy(day).parquet(given)
        days = days_of(spark, given, day)
        everything = read_alerts(spark, given)
        if known := sorted(set(days) & set(days_of(spark, table, day))):
            everything = everything.unionByName(on_days(read_alerts(spark, table), known, day))
        rest = [c for c in ALERT_SCHEMA.names if c not in ("alert_id", "_created_at")]
        first = F.min_by(F.struct(*rest, "_created_at"), F.struct(~F.col("is_resolved"), "_created_at", *rest))
        unique = everything.groupBy(day, "alert_id").agg(first.alias("_row"))
        unique.select("alert_id", "_row.*").select(*ALERT_SCHEMA.names).write.parquet(merged)
        # A table that has never had an alert comes into being without any.
        if days or not listed(spark, table):
            load_clustered(spark.read.schema(ALERT_SCHEMA).parquet(merged), table, ALERT_TABLE)
    return days


def compact_alerts(spark: SparkSession, found: str, table: str) -> list[date]:
    """Merges what a scoring stream has found (:mod:`cardvigil.sources.batches`) into the alert table.

    Takes the complete batches that are there and removes them afterwards; returns the days touched.
    """
    taken = batches.finished(spark, found)
    if not taken:
        return []
    rows = batches.read_batches(spark, found, taken, ALERT_SCHEMA, ALERT_TABLE.date_column)
    days = merge_alerts(spark, rows, table)
    batches.forget(spark, found, taken)
    return days


def store_resolutions(spark: SparkSession, resolutions: DataFrame, table: str) -> list[date]:
    """Applies resolution events to the alert table; returns the days replaced.

    Of the whole table only ids and days are read, to find the days that hold a resolved
    transaction; only these days are read in full and replaced.
    """
    day = ALERT_TABLE.date_column
    stored = read_alerts(spark, table)
    closed = resolutions.select(F.col("transaction_id").alias("_id")).distinct()
    hit = stored.select("transaction_id", day).join(closed, F.col("transaction_id") == F.col("_id"), "left_semi")
    # One row for each day at most.
    days = sorted(r[0] for r in hit.select(day).distinct().collect())
    if days:
        with staging(spark, ALERT_TABLE.name) as made:
            resolve(on_days(stored, days, day), resolutions).write.parquet(made)
            load_clustered(spark.read.schema(ALERT_SCHEMA).parquet(made), table, ALERT_TABLE)
    return days


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alert table. Its schema is given, as a table without alerts has no files."""
    day = T.StructField(ALERT_TABLE.date_column, T.DateType())
    return spark.read.schema(T.StructType([*ALERT_SCHEMA.fields, day])).parquet(path)


def within_retention(
    df: DataFrame,
    as_of: date,
    days: int = RiskConfig.retention_days,
    contract: TableContract = RAW_TABLE,
) -> DataFrame:
    """Rows whose day has not expired; a partition filter on a stored table."""
    return df.filter(F.col(contract.date_column) >= F.lit(as_of - timedelta(days=days)))


#: Days for which an expired partition stays, so that readers that asked before it expired can finish.
GRACE_DAYS = 7


def drop_expired(
    spark: SparkSession,
    path: str,
    as_of: date,
    days: int = RiskConfig.retention_days,
    grace: int = GRACE_DAYS,
    contract: TableContract = RAW_TABLE,
) -> list[date]:
    """Removes the day folders of a table that have expired for longer than ``grace`` days; returns the days.

    Which ones is read from the folder listing; no file is opened. A reader that goes through
    :func:`within_retention` asks for none of them, also with a listing made before.
    """
    last_kept = as_of - timedelta(days=days + grace)
    gone = [day for day in days_of(spark, path, contract.date_column) if day < last_kept]
    for day in gone:
        remove_folder(spark, f"{path.rstrip('/')}/{contract.date_column}={day}")
    return gone
