"""The feature set: trailing aggregates, z-score, velocity and flags per transaction."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardvigil.config import RiskConfig
from cardvigil.functions import risk
from cardvigil.functions.exact import mean_money, money, sample_stddev_money
from cardvigil.operators.rolling import PARTS, SPANS, TRAILING, per_second, with_parts, with_trailing
from cardvigil.schema import FEATURE_COLUMNS

LOOKBACK_DAYS = SPANS["30d"] // 86400


def engineer(
    df: DataFrame,
    cfg: RiskConfig = RiskConfig(),
    home: Column | None = None,
    history: DataFrame | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """All columns of ``df`` plus every feature, and ``stddev_amount_30d`` besides.

    Selecting fewer columns prunes the windows behind the others. Earlier rows
    that count but are not wanted themselves go in ``history``, added up per second.
    ``at_most`` is a known bound on the rows of ``df``.
    """
    rolled = with_trailing(df, cfg, history, at_most)
    counts_and_amounts = {
        "txn_count_1h": F.col("ids_1h"),
        "txn_count_24h": F.col("ids_24h"),
        "txn_count_10min": F.col("ids_10min"),
        "avg_amount_7d": mean_money(F.col("amounts_7d"), F.col("cents_7d")),
        "avg_amount_30d": mean_money(F.col("amounts_30d"), F.col("cents_30d")),
        "stddev_amount_30d": sample_stddev_money(
            F.col("amounts_30d"), F.col("cents_30d"), F.col("squares_30d")
        ),
        "max_amount_24h": money(F.col("top_24h")),
        "sum_amount_24h": F.when(F.col("amounts_24h") > 0, money(F.col("cents_24h"))),
    }
    derived = {
        "zscore_amount": risk.zscore(
            F.col("amount"), F.col("avg_amount_30d"), F.col("stddev_amount_30d")
        ),
        "txn_per_minute": risk.per_minute(F.col("txn_count_10min")),
    }
    return (
        rolled.withColumns(counts_and_amounts)
        .drop(*TRAILING)
        .withColumns(derived)
        .withColumns(risk.flags(cfg, home))
    )


def features(df: DataFrame, cfg: RiskConfig = RiskConfig(), home: Column | None = None) -> DataFrame:
    """The feature table's columns, in order."""
    return engineer(df, cfg, home).select(*FEATURE_COLUMNS)


def features_for_day(
    raw: DataFrame,
    run_date: date,
    cfg: RiskConfig = RiskConfig(),
    date_column: str = "date",
    totals: DataFrame | None = None,
) -> DataFrame:
    """Features of one day's rows, with frames that reach back over the full 30 days.

    Filters are on the partition column, so 31 days are read, not the table, and of 30 of
    them four columns only. ``totals`` has totals per card and day, kept with the raw table:
    given these, raw rows are read of the day and of the 3 days in which a frame begins.
    """
    day = F.col(date_column)
    first, last = run_date - timedelta(days=LOOKBACK_DAYS), run_date - timedelta(days=1)
    today = raw.filter(day == F.lit(run_date))
    if totals is None or not _days_are_utc(raw):
        earlier = with_parts(raw.filter(day.between(F.lit(first), F.lit(last))))
    else:
        opened = [run_date - timedelta(days=n) for n in _frame_starts()]
        whole = totals.filter(day.between(F.lit(first), F.lit(last)) & ~day.isin(opened))
        columns = ["card_id", "_second", *PARTS]
        earlier = with_parts(raw.filter(day.isin(opened))).select(*columns).unionByName(whole.select(*columns))
    past = per_second(_in_whole_days(earlier, run_date))
    return engineer(today, cfg, history=past).select(*FEATURE_COLUMNS)


def _frame_starts() -> list[int]:
    """How many days back frames of whole days begin, somewhere within that day."""
    return sorted(span // 86400 for span in SPANS.values() if span % 86400 == 0)


def _days_are_utc(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC")


def _in_whole_days(history: DataFrame, run_date: date) -> DataFrame:
    """Moves seconds of the past to where no frame of ``run_date`` can tell the difference.

    A frame of n days starts within the day n days back. A stretch of days
    between two such days lies inside the longer frame and outside the shorter
    one, whatever the second, so all of it may be added up per card. That
    leaves 3 of 30 days in seconds. It takes days as UTC has them.
    """
    if not _days_are_utc(history):
        return history
    today = (run_date - date(1970, 1, 1)).days
    starts = _frame_starts()
    second = F.col("_second")
    moved = second
    for shorter, longer in zip(starts, starts[1:]):
        begin, end = (today - longer + 1) * 86400, (today - shorter) * 86400
        moved = F.when((second >= begin) & (second < end), F.lit(begin)).otherwise(moved)
    return history.withColumn("_second", moved.cast("bigint"))


def with_home_country(df: DataFrame, customers: DataFrame) -> DataFrame:
    """Adds ``home_country`` by customer; NULL where the customer is unknown.

    ``customers`` has one row per ``customer_id`` and grows with the data, so
    no broadcast is asked for: Spark picks one if its measured size allows.
    """
    home = customers.select(F.col("customer_id").alias("_customer"), "home_country")
    return df.join(home, F.col("customer_id") == F.col("_customer"), "left").drop("_customer")
