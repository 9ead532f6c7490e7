"""Keeping the tables right while rows come late: compaction, totals per day, revision.

Landed micro-batches are merged into the raw table by day and transaction id. Only the days
that the batches touch are read and replaced, and with them the totals per card and day that
daily runs take for most of their history. Which cards have changed on which days is queued
for :func:`revise`, which computes the features of these cards anew, for the changed days and
for the 30 days after them whose frames reach back to a changed row, and nothing else.

Every step may be cut short and done again: changes are queued before a day is replaced, and
batches and queued changes are removed only when all that follows from them is published.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardvigil.config import RiskConfig
from cardvigil.operators.features import LOOKBACK_DAYS, features
from cardvigil.operators.rolling import day_totals
from cardvigil.schema import DAY_TOTALS, FEATURE_TABLE, RAW_SCHEMA, RAW_TABLE
from cardvigil.session import listed, new_folder, pin_utc, remove_folder, staging
from cardvigil.sources import batches
from cardvigil.sources.raw import read_raw
from cardvigil.sources.tables import (
    conform_features,
    days_of,
    load_clustered,
    on_days,
    with_partition_date,
    write_by_date,
    write_dated,
)

CHANGES = "card_id string, date date"
_DAY = RAW_TABLE.date_column


def _merged(new: DataFrame, stored: DataFrame | None) -> DataFrame:
    """One row for each day and transaction id, with the card it had before and whether it has changed.

    Of copies that differ the least by column order stays, as if all had been compacted at once.
    """
    keys = [_DAY, "transaction_id"]
    rest = [c for c in RAW_SCHEMA.names if c not in keys]
    rows = new.withColumn("_is_stored", F.lit(False))
    if stored is not None:
        rows = rows.unionByName(stored.withColumn("_is_stored", F.lit(True)))
    row = F.struct(*rest)
    least = rows.groupBy(*keys).agg(F.min(row).alias("_row"), F.min(F.when(F.col("_is_stored"), row)).alias("_before"))
    return least.select(
        "transaction_id",
        "_row.*",
        _DAY,
        F.col("_before.card_id").alias("_card_before"),
        (~F.col("_row").eqNullSafe(F.col("_before"))).alias("_is_changed"),
    ).select(*RAW_SCHEMA.names, _DAY, "_card_before", "_is_changed")


def compact_landed(
    spark: SparkSession, landed: str, table: str, totals: str | None = None, changes: str | None = None
) -> list[date]:
    """Merges the complete landed batches into the raw table; returns the days touched.

    ``totals`` is the table of totals per card and day, ``changes`` the queue for :func:`revise`.
    """
    pin_utc(spark)
    taken = batches.finished(spark, landed)
    days = batches.days_touched(spark, landed, taken, _DAY)
    if days:
        new = batches.read_batches(spark, landed, taken, RAW_SCHEMA, _DAY)
        known = sorted(set(days) & set(days_of(spark, table, _DAY)))
        stored = on_days(read_raw(spark, table), known, _DAY).select(*new.columns) if known else None
        with staging(spark, RAW_TABLE.name) as made:
            _merged(new, stored).write.parquet(made)
            merged = spark.read.parquet(made)
            if changes:
                changed = merged.filter("_is_changed").select(F.explode(F.array("card_id", "_card_before")).alias("card_id"), _DAY)
                changed.filter("card_id IS NOT NULL").distinct().write.parquet(_queued(spark, changes))
            rows = merged.select(*RAW_SCHEMA.names)
            if totals:
                write_dated(day_totals(merged, _DAY), totals, DAY_TOTALS)
            write_by_date(rows, table, RAW_TABLE)
    batches.forget(spark, landed, taken)
    return days


def _queued(spark: SparkSession, changes: str) -> str:
    """A folder of its own for each addition, so that a repeated one takes nothing from an earlier one."""
    return f"{changes.rstrip('/')}/{new_folder(spark, 'changed').rsplit('/', 1)[1]}"


def affected(changed: DataFrame, last: date) -> DataFrame:
    """(card_id, date) whose features a change may alter: that day and the 30 after it, up to ``last``."""
    until = F.least(F.date_add(_DAY, LOOKBACK_DAYS), F.lit(last))
    return changed.filter(F.col(_DAY) <= F.lit(last)).select("card_id", F.explode(F.sequence(_DAY, until)).alias(_DAY)).distinct()


def revise(
    spark: SparkSession,
    changes: str,
    raw: str,
    table: str,
    loaded_at: datetime,
    cfg: RiskConfig = RiskConfig(),
) -> list[date]:
    """Brings the feature table up to the queued changes of the raw table; returns the days replaced.

    Reads the raw rows of the cards concerned from 30 days before the first change on, and
    replaces the feature days concerned, whose other cards keep their rows.
    """
    pin_utc(spark)
    queue = [f"{changes.rstrip('/')}/{name}" for name in listed(spark, changes) if name.startswith("changed-")]
    known = days_of(spark, raw, _DAY)
    if not queue or not known:
        return []
    day = FEATURE_TABLE.date_column
    with staging(spark, "affected") as marked, staging(spark, "concerned") as concerned, staging(spark, FEATURE_TABLE.name) as made:
        affected(spark.read.schema(CHANGES).parquet(*queue), known[-1]).write.parquet(marked)
        pairs = spark.read.schema(CHANGES).parquet(marked)
        # One row for each day at most.
        days = sorted(set(known) & {r[0] for r in pairs.select(_DAY).distinct().collect()})
        if days:
            first = days[0] - timedelta(days=LOOKBACK_DAYS)
            cards = pairs.select(F.col("card_id").alias("_card")).distinct()
            within = read_raw(spark, raw).filter(F.col(_DAY).between(F.lit(first), F.lit(days[-1])))
            # Stored, as the features read them several times: in search of heavy cards, and for the windows.
            within.join(cards, F.col("card_id") == F.col("_card"), "left_semi").select(*RAW_SCHEMA.names).write.parquet(concerned)
            rows = spark.read.schema(RAW_SCHEMA).parquet(concerned)
            on = [F.col("card_id") == F.col("_card"), F.col(day) == F.col("_day")]
            which = pairs.select(F.col("card_id").alias("_card"), F.col(_DAY).alias("_day"))
            made_rows = conform_features(with_partition_date(features(rows, cfg), FEATURE_TABLE), loaded_at)
            fresh = made_rows.join(which, on, "left_semi")
            if kept := sorted(set(days) & set(days_of(spark, table, day))):
                old = on_days(spark.read.parquet(table), kept, day).join(which, on, "left_anti")
                fresh = fresh.unionByName(old)
            fresh.write.parquet(made)
            load_clustered(spark.read.schema(fresh.schema).parquet(made), table, FEATURE_TABLE)
    for folder in queue:
        remove_folder(spark, folder)
    return days
