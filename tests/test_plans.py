"""Plan shapes the library promises: shuffles, pruning, pushdown, broadcasts."""

from __future__ import annotations

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cardvigil import RiskConfig
from cardvigil.operators import quality
from cardvigil.operators.alerts import (
    build_alerts,
    latest_features,
    list_alerts,
    list_stored_alerts,
    summarise,
)
from cardvigil.operators.features import engineer, features, features_for_day
from cardvigil.operators.rolling import IS_NEW, _roll_light, with_parts
from cardvigil.plans import analytics, catalog, standin
from cardvigil.schema import ALERT_TABLE, FEATURE_TABLE, RAW_TABLE
from cardvigil.sources.raw import read_raw
from cardvigil.sources.tables import days_of, read_alerts, write_by_date
from tests.plans import plan_of


@pytest.fixture
def stored(spark, sf_dir, folder):
    path = folder("features")
    write_by_date(features(standin.transactions(spark, sf_dir), standin.CONFIG), path, FEATURE_TABLE)
    return spark.read.parquet(path)


@pytest.fixture
def raw(spark, sf_dir, folder):
    path = folder("raw")
    standin.transactions(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def light(raw):
    return _roll_light(with_parts(raw).withColumn(IS_NEW, F.lit(True)))


def test_all_windows_of_a_card_share_one_shuffle(raw):
    plan = plan_of(light(raw))
    assert plan.count("Exchange hashpartitioning(card_id") == 1
    assert len(re.findall(r"Exchange ", plan)) == 1
    assert len(re.findall(r"\+- Sort ", plan)) == 2


def test_unused_windows_are_pruned(raw):
    plan = plan_of(light(raw).select("transaction_id", "ids_1h"))
    assert "max(" not in plan and "_squares" not in plan
    assert "ReadSchema: struct<transaction_id:string,card_id:string,transaction_timestamp:timestamp>" in plan
    assert len(re.findall(r"\+- Sort ", plan)) == 1


def test_card_filter_reaches_the_scan(raw):
    plan = plan_of(light(raw).filter(F.col("card_id") == "7"))
    assert "EqualTo(card_id,7)" in plan


def test_only_bucket_and_heavy_card_lists_are_broadcast_by_hint(spark, raw):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(engineer(raw))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    broadcasts = re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan)
    assert broadcasts and all("xxhash64" in keys or "coalesce(card_id" in keys for keys in broadcasts)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_heavy_cards_are_added_up_before_the_shuffle(raw):
    plan = plan_of(engineer(raw))
    assert "partial_sum(_cents" in plan and "partial_max(_top" in plan


def test_no_python_in_any_plan(raw):
    plan = plan_of(build_alerts(engineer(raw), F.col("transaction_timestamp")))
    assert "Python" not in plan and "Arrow" not in plan


def test_report_takes_one_pass(stored):
    plan = plan_of(quality.feature_report(stored))
    assert plan.count("FileScan") == 1 and plan.count("Exchange SinglePartition") == 1


def test_reconciliation_adds_up_before_the_shuffle(raw, stored):
    plan = plan_of(quality.reconcile_rows(raw, stored))
    assert plan.count("Exchange hashpartitioning(transaction_id") == 1
    assert "partial_sum(r" in plan
    assert "ReadSchema: struct<transaction_id:string>" in plan


def test_high_risk_cards_reads_one_partition_and_keeps_a_top_list(stored):
    plan = plan_of(analytics.high_risk_cards(stored, standin.AS_OF))
    assert "PartitionFilters: [isnotnull(_feature_date" in plan
    assert "TakeOrderedAndProject(limit=100" in plan


def test_newest_partition_comes_from_the_listing(spark, stored, folder):
    days = days_of(spark, folder("features"), "_feature_date")
    assert days[-1] == standin.LAST_DAY
    plan = plan_of(latest_features(stored, days))
    assert "PartitionFilters: [isnotnull(_feature_date" in plan and "Subquery" not in plan
    assert latest_features(stored, []).count() == 0


def test_only_raw_rows_of_alerts_are_moved(raw, stored):
    plan = plan_of(build_alerts(stored, F.col("transaction_timestamp"), standin.CONFIG, raw))
    below = plan[plan.index("LeftSemi") :]
    raw_side = below[: below.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in raw_side


def test_alert_list_is_a_top_list(raw):
    alerts = build_alerts(engineer(raw), F.col("transaction_timestamp"))
    assert "TakeOrderedAndProject(limit=10" in plan_of(list_alerts(alerts))


def test_point_lookup_is_pushed_to_the_files(stored):
    assert "EqualTo(transaction_id,5)" in plan_of(stored.filter(F.col("transaction_id") == "5"))


def test_a_hot_second_is_split_by_adaptive_execution(spark, folder):
    """Half of a heavy card's rows lack a time and share one join key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    rows = spark.range(0, 120_000, 1, 8).selectExpr(
        "CAST(id AS STRING) AS transaction_id",
        "'hot' AS card_id",
        "'C' AS customer_id",
        "CAST(id % 100 AS DECIMAL(18, 2)) AS amount",
        "'IN' AS merchant_country",
        "if(id % 2 = 0, NULL, timestamp_seconds(1700000000 + id)) AS transaction_timestamp",
        "'POS' AS transaction_type",
        "0 AS is_fraud",
    )
    rows.write.parquet(folder("hot"))
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        out = engineer(spark.read.parquet(folder("hot")), replace(RiskConfig(), heavy_rows=1000))
        found = out.filter("txn_count_24h = 60000 AND transaction_timestamp IS NULL")
        assert len(found.select("transaction_id").collect()) == 60_000
        out.collect()
        plan = plan_of(out)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "SortMergeJoin(skew=true)" in plan


def test_history_is_read_narrow_and_by_partition(spark, sf_dir, folder):
    write_by_date(standin.transactions(spark, sf_dir), folder("by-date"), RAW_TABLE)
    raw = read_raw(spark, folder("by-date"))
    out = features_for_day(raw, standin.LAST_DAY, standin.CONFIG)
    out.collect()
    scans = re.findall(r"PartitionFilters: \[([^\n]*?)\], PushedFilters[^\n]*ReadSchema: (struct<[^\n]*>)", plan_of(out))
    assert scans and all("(date#" in filters for filters, _ in scans)
    past = [schema for filters, schema in scans if ">=" in filters]
    assert past
    for schema in past:
        assert "customer_id" not in schema and "merchant_country" not in schema and "is_fraud" not in schema


@pytest.fixture
def stored_alerts(spark, sf_dir, folder):
    built = build_alerts(
        engineer(standin.transactions(spark, sf_dir), standin.CONFIG),
        F.col("transaction_timestamp"),
        standin.CONFIG,
    )
    write_by_date(built, folder("alerts"), ALERT_TABLE)
    return read_alerts(spark, folder("alerts"))


@pytest.mark.parametrize("severity", [None, "LOW", "HIGH", "URGENT"])
@pytest.mark.parametrize("limit", [1, 10, 100])
def test_list_reads_the_newest_days_first(spark, stored_alerts, folder, severity, limit):
    days = days_of(spark, folder("alerts"), ALERT_TABLE.date_column)
    plain = list_alerts(stored_alerts, severity, limit)
    pruned = list_stored_alerts(stored_alerts, days, severity, limit)
    assert pruned.collect() == plain.collect()
    if limit == 1 and severity is None:
        assert "PartitionFilters: [isnotnull(_alert_date" in plan_of(pruned)


def test_summary_reads_two_days(stored_alerts):
    plain = summarise(stored_alerts, standin.AS_OF_TIME)
    pruned = summarise(stored_alerts, standin.AS_OF_TIME, ALERT_TABLE.date_column)
    assert pruned.collect() == plain.collect()
    assert "PartitionFilters: [isnotnull(_alert_date" in plan_of(pruned)


def test_deliveries_ask_for_the_time_before_the_merchant(spark, sf_dir):
    for n, part in enumerate(catalog._deliveries(standin.transactions(spark, sf_dir))[:2]):
        edge = catalog.EDGES[n + 1].strftime("%Y-%m-%d")
        asked = [line for line in plan_of(part).splitlines() if "Filter" in line and edge in line]
        assert asked and all(line.index(edge) < line.index("get_json_object") for line in asked if "get_json_object" in line)
