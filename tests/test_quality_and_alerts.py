"""Quality checks, scores, the alert desk and the analytical queries."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardvigil import RiskConfig
from cardvigil.functions.exact import rounded_percent, rounded_ratio
from cardvigil.functions.risk import severity
from cardvigil.operators import alerts as desk
from cardvigil.operators import quality
from cardvigil.operators.features import features
from cardvigil.plans import analytics, catalog
from cardvigil.schema import ALERT_COLUMNS, ALERT_TABLE, FLAG_COLUMNS, RAW_TABLE
from tests.data import INPUT, golden_input, utc
from tests.plans import plan_of


# ---- quality ------------------------------------------------------------


def test_validation_passes_on_clean_data(spark):
    out = features(golden_input(spark))
    quality.assert_features(out)
    report = quality.feature_report(out).first()
    assert (report["total_rows"], report["fraud_rows"], report["fraud_rate_pct"]) == (5, 1, 20.0)


def test_validation_fails_on_null_transaction_id(spark):
    bad = spark.createDataFrame([(None, "red", "cy", 12.5, "DE", utc(2024, 5, 6, 7, 0, 0), "TAP", 0)], INPUT)
    with pytest.raises(quality.QualityError, match="null_transaction_ids"):
        quality.assert_features(features(bad))


def test_validation_fails_on_negative_amount(spark):
    bad = golden_input(spark).withColumn("amount", -F.col("amount"))
    with pytest.raises(quality.QualityError, match="negative_amounts"):
        quality.assert_features(features(bad))


def test_report_on_nothing_has_no_rate(spark):
    report = quality.feature_report(features(golden_input(spark).limit(0))).first()
    assert report["total_rows"] == 0 and report["fraud_rate_pct"] is None


def test_reconciliation_counts_both_sides(spark):
    raw = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "transaction_id string")
    made = spark.createDataFrame([("a",), ("c",), ("c",), (None,)], "transaction_id string")
    row = quality.reconcile_rows(raw, made).first()
    assert tuple(row) == (4, 4, 2, 2, False)
    assert quality.reconcile_rows(raw, raw).first()["is_reconciled"]


@pytest.mark.parametrize(
    "fraud, total, fine", [(1, 100, True), (5, 100, True), (0, 100, False), (6, 100, False), (3, 100, True)]
)
def test_fraud_rate_bounds_include_their_ends(spark, fraud, total, fine):
    df = spark.range(total).select(
        F.lit(date(2025, 3, 1)).alias("date"), (F.col("id") < fraud).cast("int").alias("is_fraud")
    )
    assert quality.fraud_rate_by_day(df, "date").first()["is_in_bounds"] is fine
    if fine:
        quality.assert_fraud_rate(df, "date", date(2025, 3, 1))
    else:
        with pytest.raises(quality.QualityError):
            quality.assert_fraud_rate(df, "date", date(2025, 3, 1))


def test_fraud_rate_of_a_missing_day_fails(spark):
    df = spark.createDataFrame([], "date date, is_fraud int")
    with pytest.raises(quality.QualityError):
        quality.assert_fraud_rate(df, "date", date(2025, 3, 1))


def test_every_contract_is_asserted(spark):
    fine = spark.createDataFrame([("t", "c", "x")], "transaction_id string, card_id string, alert_id string")
    quality.assert_not_null(fine, ALERT_TABLE)
    with pytest.raises(quality.QualityError, match="card_id"):
        quality.assert_not_null(fine.withColumn("card_id", F.lit(None).cast("string")), ALERT_TABLE)
    with pytest.raises(quality.QualityError, match="differ"):
        quality.assert_reconciled(fine, fine.limit(0))


def test_presence(spark):
    raw = spark.createDataFrame([(date(2025, 3, 1),), (date(2025, 3, 3),)], "date date")
    got = quality.raw_presence(raw, date(2025, 3, 1), date(2025, 3, 3)).orderBy("run_date").collect()
    assert [(r["raw_rows"], r["has_data"]) for r in got] == [(1, True), (0, False), (1, True)]
    quality.assert_raw_present(raw, date(2025, 3, 1))
    with pytest.raises(quality.QualityError):
        quality.assert_raw_present(raw, date(2025, 3, 2))


def test_not_null_contract(spark):
    df = spark.createDataFrame(
        [(None, "c", None), ("t", "c", None)],
        "transaction_id string, card_id string, transaction_timestamp timestamp",
    )
    got = {r["column_name"]: (r["null_rows"], r["is_satisfied"]) for r in quality.not_null_violations(df, RAW_TABLE).collect()}
    assert got == {
        "transaction_id": (1, False),
        "card_id": (0, True),
        "transaction_timestamp": (2, False),
    }


# ---- scores and alerts --------------------------------------------------


def flagged(spark, *rows):
    """Feature rows with the given flags raised."""
    schema = (
        "transaction_id string, card_id string, amount decimal(18,2), merchant_name string, "
        "merchant_country string, transaction_timestamp timestamp, "
        + ", ".join(f"{f} int" for f in FLAG_COLUMNS)
    )
    full = [
        (i, "C", Decimal("10.50"), "Shop", "US", when, *[int(f in up) for f in FLAG_COLUMNS])
        for i, when, up in rows
    ]
    return spark.createDataFrame(full, schema)


NOON = utc(2025, 3, 1, 12, 0, 0)
CASES = [
    ("none", NOON, ()),
    ("night", NOON, ("is_night_txn",)),
    ("foreign+night", NOON, ("is_foreign_merchant", "is_night_txn")),
    ("foreign+high", NOON, ("is_foreign_merchant", "is_high_amount")),
    ("high+spike", NOON, ("is_high_amount", "is_velocity_spike")),
    ("foreign+high+night", NOON, ("is_foreign_merchant", "is_high_amount", "is_night_txn")),
    ("high+spike+night", NOON, ("is_high_amount", "is_velocity_spike", "is_night_txn")),
    ("all", NOON, tuple(FLAG_COLUMNS)),
]


def test_scores_and_severities(spark):
    got = {r["transaction_id"]: (r["fraud_score"], r["alert_severity"]) for r in desk.score(flagged(spark, *CASES)).collect()}
    assert got == {
        "none": (0.0, "LOW"),
        "night": (0.15, "LOW"),
        "foreign+night": (0.45, "LOW"),
        "foreign+high": (0.65, "LOW"),
        "high+spike": (0.7, "LOW"),
        "foreign+high+night": (0.8, "MEDIUM"),
        "high+spike+night": (0.85, "MEDIUM"),
        "all": (1.0, "HIGH"),
    }


@pytest.mark.parametrize(
    "score, name", [(0.61, "LOW"), (0.70, "LOW"), (0.701, "MEDIUM"), (0.85, "MEDIUM"), (0.851, "HIGH")]
)
def test_severity_edges(spark, score, name):
    df = spark.range(1).select(severity(F.lit(score), RiskConfig()))
    assert df.first()[0] == name


@pytest.fixture
def alerts(spark):
    rows = [(i, when - timedelta(hours=n), up) for n, (i, when, up) in enumerate(CASES)]
    return desk.build_alerts(flagged(spark, *rows), F.col("transaction_timestamp"))


def test_alerts_are_above_the_threshold_and_open(alerts):
    rows = {r["transaction_id"]: r for r in alerts.collect()}
    assert set(rows) == {"foreign+high", "high+spike", "foreign+high+night", "high+spike+night", "all"}
    assert alerts.columns == ALERT_COLUMNS
    for r in rows.values():
        assert 0.6 < r["fraud_score"] <= 1.0 and len(r["fraud_flags"]) >= 1
        assert r["is_resolved"] is False and r["resolved_by"] is None and r["resolved_at"] is None
    assert rows["foreign+high"]["fraud_flags"] == ["is_foreign_merchant", "is_high_amount"]
    assert len({r["alert_id"] for r in rows.values()}) == 5


def test_alert_ids_are_repeatable(alerts):
    once = {r["transaction_id"]: r["alert_id"] for r in alerts.collect()}
    assert once == {r["transaction_id"]: r["alert_id"] for r in alerts.collect()}


def test_merchant_name_from_raw_survives_copies(spark):
    rows = flagged(spark, ("a", NOON, FLAG_COLUMNS)).drop("merchant_name")
    raw = spark.createDataFrame([("a", "Shop")] * 50 + [("b", "Other")], "transaction_id string, merchant_name string")
    got = desk.build_alerts(rows, F.col("transaction_timestamp"), raw=raw).collect()
    assert [r["merchant_name"] for r in got] == ["Shop"]


def test_alerts_without_a_raw_row_stay(spark):
    cases = [("a", NOON, FLAG_COLUMNS), ("b", NOON, FLAG_COLUMNS), (None, NOON, FLAG_COLUMNS)]
    rows = flagged(spark, *cases)
    raw = spark.createDataFrame([("a", "Shop"), (None, "Nobody")], "transaction_id string, merchant_name string")
    for few in (0, 10):
        found = desk.score(rows.drop("merchant_name")).filter("fraud_score > 0.6")
        named = desk.with_merchant_name(found, raw, few).select("transaction_id", "merchant_name").collect()
        assert sorted(map(tuple, named), key=str) == [("a", "Shop"), ("b", None), (None, None)]
    plain = desk.build_alerts(rows, F.col("transaction_timestamp")).collect()
    joined = desk.build_alerts(rows.drop("merchant_name"), F.col("transaction_timestamp"), raw=raw).collect()
    assert {r["transaction_id"]: r["merchant_name"] for r in plain}[None] is None
    assert {r["transaction_id"] for r in plain} == {r["transaction_id"] for r in joined}


def test_list_defaults_to_the_ten_newest(spark):
    rows = [(f"t{n:02}", NOON + timedelta(minutes=n), FLAG_COLUMNS) for n in range(30)]
    found = desk.build_alerts(flagged(spark, *rows), F.col("transaction_timestamp"))
    assert [r["transaction_id"] for r in desk.list_alerts(found).collect()] == [f"t{n:02}" for n in range(29, 19, -1)]
    assert desk.list_alerts(found, limit=5).count() == 5
    assert desk.list_alerts(found, limit=100).count() == 30


@pytest.mark.parametrize("limit", [0, -1, 101, 999])
def test_list_rejects_limits_out_of_bounds(alerts, limit):
    with pytest.raises(ValueError):
        desk.list_alerts(alerts, limit=limit)


@pytest.mark.parametrize("name, count", [("HIGH", 1), ("high", 1), ("Medium", 2), ("LOW", 2), ("", 5), (None, 5), ("URGENT", 0)])
def test_list_by_severity(alerts, name, count):
    got = desk.list_alerts(alerts, name, 50).collect()
    assert len(got) == count
    assert all(not name or r["alert_severity"] == name.upper() for r in got)


def test_severity_is_filtered_before_the_limit(alerts):
    assert [r["transaction_id"] for r in desk.list_alerts(alerts, "HIGH", 1).collect()] == ["all"]


def test_alert_by_transaction(alerts):
    got = desk.alert_by_transaction(alerts, "all").collect()
    assert len(got) == 1 and got[0]["transaction_id"] == "all"
    assert desk.alert_by_transaction(alerts, "test-txn-123").count() == 0


def test_summary_counts_the_last_day(spark, alerts):
    row = desk.summarise(alerts, NOON).first()
    assert row["total_alerts"] == 5 == row["high_severity"] + row["medium_severity"] + row["low_severity"]
    assert row["total_amount_at_risk"] == 52.5
    edges = [
        ("a day old", NOON - timedelta(hours=24), FLAG_COLUMNS),
        ("just inside", NOON - timedelta(hours=24) + timedelta(seconds=1), FLAG_COLUMNS),
        ("now", NOON, FLAG_COLUMNS),
        ("later", NOON + timedelta(seconds=1), FLAG_COLUMNS),
    ]
    found = desk.build_alerts(flagged(spark, *edges), F.col("transaction_timestamp"))
    assert desk.summarise(found, NOON).first()["total_alerts"] == 2
    nothing = desk.summarise(found.limit(0), NOON).first()
    assert tuple(nothing) == (0, 0, 0, 0, 0.0)


def test_resolving(spark, alerts):
    early, late = NOON, NOON + timedelta(hours=1)
    events = (
        desk.resolution(spark, "all", early, "zoe")
        .unionAll(desk.resolution(spark, "all", late))
        .unionAll(desk.resolution(spark, "high+spike", late, "anna"))
        .unionAll(desk.resolution(spark, "high+spike", late, "bob"))
        .unionAll(desk.resolution(spark, "unknown", late))
    )
    done = desk.resolve(alerts, events)
    got = {r["transaction_id"]: r for r in done.collect()}
    assert len(got) == 5
    assert (got["all"]["is_resolved"], got["all"]["resolved_by"], got["all"]["resolved_at"]) == (True, "analyst", late)
    assert got["high+spike"]["resolved_by"] == "bob"
    assert got["foreign+high"]["is_resolved"] is False

    again = {r["transaction_id"]: r for r in desk.resolve(done, desk.resolution(spark, "all", early, "zoe")).collect()}
    assert again["all"]["resolved_by"] == "analyst", "an older event does not undo a newer one"
    assert again["high+spike"]["is_resolved"] is True, "earlier resolutions stay"


# ---- exact numbers and analytics ----------------------------------------


@pytest.mark.parametrize(
    "num, den, digits, want",
    [(1, 8, 2, 0.13), (1, 3, 2, 0.33), (2, 3, 1, 0.7), (-1, 8, 2, -0.13), (0, 5, 2, 0.0), (1, 0, 2, None), (10**17, 3, 0, 33333333333333333.0)],
)
def test_rounded_ratio(spark, num, den, digits, want):
    n, d = F.lit(num).cast("bigint"), F.lit(den).cast("bigint")
    assert spark.range(1).select(rounded_ratio(n, d, digits)).first()[0] == want


def test_rounded_percent(spark):
    one, total = F.lit(1).cast("bigint"), F.lit(800).cast("bigint")
    assert spark.range(1).select(rounded_percent(one, total, 2)).first()[0] == 0.13


def test_daily_summary_covers_31_days(spark):
    as_of = date(2025, 3, 31)
    rows = [(datetime(2025, 3, 31, 12) - timedelta(days=n), Decimal("10.10"), n % 2) for n in range(40)]
    df = spark.createDataFrame(rows, "transaction_timestamp timestamp, amount decimal(18,2), is_fraud int")
    got = analytics.daily_fraud_summary(df, as_of).collect()
    assert len(got) == 31
    assert got[0]["txn_date"] == as_of and got[-1]["txn_date"] == date(2025, 3, 1)
    assert (got[1]["fraud_count"], got[1]["fraud_rate_pct"], got[1]["fraud_amount_inr"]) == (1, 100.0, Decimal("10.10"))


def test_high_risk_cards_order_and_threshold(spark):
    day = date(2025, 3, 30)
    rows = [(day, card, 1, 0, 1, float(n)) for card, count in (("b", 3), ("a", 3), ("c", 5), ("d", 2)) for n in range(count)]
    rows.append((date(2025, 3, 29), "d", 0, 0, 0, 9.0))
    df = spark.createDataFrame(
        rows,
        "_feature_date date, card_id string, is_amount_anomaly int, is_velocity_spike int, "
        "is_foreign_merchant int, zscore_amount double",
    )
    got = analytics.high_risk_cards(df, date(2025, 3, 31)).collect()
    assert [tuple(r) for r in got] == [("c", 5, 5, 0, 5, 4.0), ("a", 3, 3, 0, 3, 2.0), ("b", 3, 3, 0, 3, 2.0)]


def test_high_risk_cards_are_cut_at_100(spark):
    day = date(2025, 3, 30)
    rows = [(day, f"c{n:03}", 0, 0, 0, 1.0) for n in range(130) for _ in range(3 + n % 2)]
    df = spark.createDataFrame(
        rows,
        "_feature_date date, card_id string, is_amount_anomaly int, is_velocity_spike int, "
        "is_foreign_merchant int, zscore_amount double",
    )
    got = [r["card_id"] for r in analytics.high_risk_cards(df, date(2025, 3, 31)).collect()]
    odd, even = [f"c{n:03}" for n in range(1, 130, 2)], [f"c{n:03}" for n in range(0, 130, 2)]
    assert got == (odd + even)[:100]


def test_country_average_is_rounded_exactly(spark):
    rows = [("US", Decimal("0.01"), 1), ("US", Decimal("0.02"), 0), (None, Decimal("5.00"), 0)]
    df = spark.createDataFrame(rows, "merchant_country string, amount decimal(18,2), is_fraud int")
    got = {r["merchant_country"]: r for r in analytics.fraud_by_country(df).collect()}
    assert got["US"]["avg_txn_amount"] == 0.02 and got["US"]["fraud_rate_pct"] == 50.0
    assert got[None]["total_txns"] == 1


def test_resolution_rate(spark, alerts):
    done = desk.resolve(alerts, desk.resolution(spark, "high+spike", NOON))
    got = {(r["alert_date"], r["alert_severity"]): tuple(r)[2:] for r in analytics.alert_resolution_rate(done).collect()}
    assert got[(date(2025, 3, 1), "LOW")] == (2, 1, 50.0)
    assert got[(date(2025, 3, 1), "HIGH")] == (1, 0, 0.0)


class Seen(Exception):
    pass


@pytest.mark.parametrize("name", ["alerts_build", "stream_alerts_compacted"])
def test_features_are_computed_once_for_the_alert_table(spark, sf_dir, monkeypatch, name):
    """The load reads its rows twice, so it gets them stored."""

    def load(rows, path, contract):
        raise Seen(plan_of(rows))

    monkeypatch.setattr(catalog, "load_clustered", load)
    with pytest.raises(Seen) as seen:
        catalog.QUERIES[name](spark, sf_dir)
    assert "Window" not in str(seen.value) and "Scan" in str(seen.value)
