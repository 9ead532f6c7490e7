"""Features against golden values, boundary cases and a brute-force reading."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardvigil import RiskConfig
from cardvigil.operators.features import engineer, features, features_for_day, with_home_country
from cardvigil.operators.heavy import heavy_keys, split_heavy
from cardvigil.operators.rolling import SPANS
from cardvigil.schema import FEATURE_COLUMNS
from tests.data import INPUT, brute_force, frame, golden_input, utc

LIGHT = RiskConfig()
HEAVY = replace(LIGHT, heavy_rows=-1)
BOTH = pytest.mark.parametrize("cfg", [LIGHT, HEAVY], ids=["light", "heavy"])

NAMES = [
    "txn_count_10min",
    "txn_count_1h",
    "txn_count_24h",
    "avg_amount_7d",
    "avg_amount_30d",
    "stddev_amount_30d",
    "max_amount_24h",
    "sum_amount_24h",
    "zscore_amount",
]

GOLDEN = {
    # id: 1h, 24h, 10min, avg (7d and 30d), max, sum, zscore, per minute, night, foreign, high
    "g1": (1, 1, 1, 80.0, 80.0, 80.0, 0.0, 0.1, 1, 0, 0),
    "g2": (2, 2, 2, 100.25, 120.5, 200.5, 0.7071067811865475, 0.2, 0, 1, 0),
    "g3": (3, 3, 2, 16733.5, 50000.0, 50200.5, 1.1547002531370485, 0.2, 0, 0, 0),
    "g4": (2, 2, 2, 25003.63, 50000.01, 50007.26, 0.7071067811865476, 0.2, 0, 0, 1),
    "g5": (2, 2, 2, 25003.63, 50000.01, 50007.26, -0.7071067811865476, 0.2, 0, 0, 0),
}


@BOTH
def test_golden_table(spark, cfg):
    rows = {r["transaction_id"]: r for r in features(golden_input(spark), cfg).collect()}
    assert set(rows) == set(GOLDEN)
    for key, want in GOLDEN.items():
        r = rows[key]
        counts = (r["txn_count_1h"], r["txn_count_24h"], r["txn_count_10min"])
        assert counts == want[:3]
        assert r["avg_amount_7d"] == r["avg_amount_30d"] == want[3]
        assert (r["max_amount_24h"], r["sum_amount_24h"]) == want[4:6]
        assert r["zscore_amount"] == pytest.approx(want[6], abs=1e-12)
        assert r["txn_per_minute"] == want[7]
        assert (r["is_night_txn"], r["is_foreign_merchant"], r["is_high_amount"]) == want[8:11]
        assert (r["is_velocity_spike"], r["is_amount_anomaly"]) == (0, 0)


def test_columns_in_order(spark):
    assert features(golden_input(spark)).columns == FEATURE_COLUMNS


def compare(spark, rows, cfg):
    """Engineered rows equal brute force. Rows are told apart by customer_id."""
    df = frame(spark, rows).withColumn("customer_id", F.monotonically_increasing_id())
    df = spark.createDataFrame(df.collect(), df.schema)
    order = {r["customer_id"]: k for k, r in enumerate(df.collect())}
    got = engineer(df, cfg).collect()
    assert len(got) == len(rows)
    want = brute_force(rows)
    for r in got:
        expected = want[order[r["customer_id"]]]
        for name in NAMES:
            if expected[name] is None:
                assert r[name] is None, name
            else:
                assert r[name] == pytest.approx(expected[name], rel=1e-12, abs=1e-12), name


@BOTH
def test_frame_edges_and_missing_values(spark, cfg):
    hour = [("a", "X", None, 1.0), ("b", "X", None, 2.0), ("x", "X", 100, 5.0), ("y", "X", 100, 7.0)]
    compare(spark, [*hour, ("z", "X", 3700, 9.0), ("w", "X", 3701, 1.0)], cfg)
    got = {r["transaction_id"]: r for r in engineer(frame(spark, hour), cfg).collect()}
    assert [got[k]["txn_count_1h"] for k in "abxy"] == [2, 2, 2, 2]
    assert [got[k]["sum_amount_24h"] for k in "abxy"] == [3.0, 3.0, 12.0, 12.0]


@BOTH
def test_every_span_includes_both_ends(spark, cfg):
    start = 1_700_000_000
    rows = [("t", "X", start, 50.0)]
    for span, seconds in SPANS.items():
        rows.append((f"in-{span}", "X", start + seconds, 1.0))
        rows.append((f"out-{span}", "X", start + seconds + 1, 2.0))
    compare(spark, rows, cfg)


@BOTH
def test_null_amounts_ids_and_cards(spark, cfg):
    rows = [
        (None, "X", 1000, 5.0),
        ("b", "X", 1001, None),
        ("c", "X", 1002, 6.0),
        ("d", None, 1000, 7.0),
        ("e", None, 1600, 8.0),
        ("f", "Y", 1000, None),
        (None, None, None, None),
    ]
    compare(spark, rows, cfg)


@BOTH
def test_random_cards_match_brute_force(spark, cfg):
    rng = random.Random(7)
    rows = []
    for n in range(400):
        card = rng.choice(["A", "A", "A", "B", "C"])
        span = rng.choice([2_000, 200_000, 5_000_000])
        sec = None if rng.random() < 0.03 else 1_699_000_000 + rng.randrange(span)
        amount = None if rng.random() < 0.05 else round(rng.uniform(0, 900), 2)
        rows.append((f"t{n}", card, sec, amount))
    compare(spark, rows, cfg)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["A", "B"]),
            st.one_of(st.none(), st.sampled_from([0, 1, 600, 601, 86399, 86400, 86401, 172801, 2592000])),
            st.one_of(st.none(), st.integers(0, 10**7).map(lambda c: c / 100)),
        ),
        min_size=1,
        max_size=14,
    )
)
def test_light_and_heavy_agree_on_edges(spark, rows):
    numbered = [(f"t{n}", *row) for n, row in enumerate(rows)]
    compare(spark, numbered, LIGHT)
    compare(spark, numbered, HEAVY)


def test_many_transactions_in_one_second(spark):
    """A card with all rows in two seconds, and one with all times missing."""
    rows = [(f"t{n}", "hot", 1000 + n % 2, float(n % 9)) for n in range(300)]
    rows += [(f"n{n}", "lost", None, 1.0) for n in range(200)]
    got = {r["transaction_id"]: r for r in engineer(frame(spark, rows), HEAVY).collect()}
    assert len(got) == 500
    assert got["t0"]["txn_count_10min"] == 150 and got["t1"]["txn_count_10min"] == 300
    assert got["n7"]["txn_count_24h"] == 200


def test_only_heavy_cards_are_split(spark):
    rows = [(f"t{n}", "hot", 1000 + n, 1.0) for n in range(120)]
    rows += [(f"u{n}", f"card{n}", 1000 + n, 1.0) for n in range(60)]
    cfg = replace(LIGHT, heavy_rows=100)
    light, heavy = split_heavy(frame(spark, rows), "card_id", cfg)
    assert heavy.select("card_id").distinct().collect() == [("hot",)]
    assert light.count() == 60
    assert heavy_keys(frame(spark, rows), "card_id", LIGHT).count() == 0
    # The bound is per card, also of cards that share a bucket, and holds for rows without a card.
    one_bucket = replace(cfg, card_buckets=1)
    nameless = frame(spark, rows + [(f"n{n}", None, 1000 + n, 1.0) for n in range(101)])
    assert heavy_keys(nameless, "card_id", one_bucket).orderBy("heavy_key").collect() == [(None,), ("hot",)]
    assert split_heavy(nameless, "card_id", one_bucket)[1].count() == 221
    mixed = {r["transaction_id"]: r[7:] for r in features(frame(spark, rows), cfg).collect()}
    plain = {r["transaction_id"]: r[7:] for r in features(frame(spark, rows), LIGHT).collect()}
    assert mixed == plain


def test_flag_thresholds(spark):
    rows = [
        ("night", "A", "C", 1.0, "IN", utc(2025, 3, 1, 5, 59, 59), "POS", 0),
        ("day", "B", "C", 1.0, "IN", utc(2025, 3, 1, 6, 0, 0), "POS", 0),
        ("nowhere", "D", "C", 50000.0, None, utc(2025, 3, 1, 6, 0, 0), "POS", 0),
        ("high", "E", "C", 50000.01, "US", utc(2025, 3, 1, 6, 0, 0), "POS", 0),
    ]
    got = {r["transaction_id"]: r for r in features(spark.createDataFrame(rows, INPUT)).collect()}
    assert [got[k]["is_night_txn"] for k in ("night", "day")] == [1, 0]
    assert [got[k]["is_foreign_merchant"] for k in ("nowhere", "high")] == [0, 1]
    assert [got[k]["is_high_amount"] for k in ("nowhere", "high")] == [0, 1]


def test_velocity_spike_needs_31_events(spark):
    rows = [(f"t{n:02}", "A", 1000 + n, 1.0) for n in range(31)]
    got = {r["transaction_id"]: r for r in features(frame(spark, rows)).collect()}
    assert (got["t29"]["txn_per_minute"], got["t29"]["is_velocity_spike"]) == (3.0, 0)
    assert (got["t30"]["txn_per_minute"], got["t30"]["is_velocity_spike"]) == (3.1, 1)


def test_anomaly_needs_eleven_rows_and_spread(spark):
    flat = [(f"f{n}", "flat", 1000 + n, 10.0) for n in range(12)]
    ten = [(f"a{n}", "ten", 1000 + n, 10.0) for n in range(9)] + [("a9", "ten", 2000, 9999.0)]
    eleven = [(f"b{n}", "eleven", 1000 + n, 10.0) for n in range(10)] + [("b10", "eleven", 2000, 9999.0)]
    got = {r["transaction_id"]: r for r in features(frame(spark, flat + ten + eleven)).collect()}
    assert got["f11"]["zscore_amount"] == 0.0
    assert got["a9"]["is_amount_anomaly"] == 0
    assert got["b10"]["is_amount_anomaly"] == 1


def test_amounts_too_large_for_38_digits(spark):
    """Past 38 digits the spread is taken in doubles instead of failing."""
    big = 9_000_000_000_000_000.0
    rows = [("a", "X", 1000, big), ("b", "X", 1001, big / 2), ("c", "X", 1002, big / 4)]
    got = {r["transaction_id"]: r for r in engineer(frame(spark, rows)).collect()}
    assert got["b"]["stddev_amount_30d"] == pytest.approx(big / 4 * 2**0.5, rel=1e-9)


def test_row_count_and_order_of_counts(spark):
    rows = [(f"t{n}", f"c{n % 5}", 1000 + 97 * n, n / 4) for n in range(100)]
    out = features(frame(spark, rows))
    assert out.count() == 100
    assert (
        out.filter(
            "txn_count_10min < 1 OR txn_count_1h < txn_count_10min "
            "OR txn_count_24h < txn_count_1h OR max_amount_24h < amount"
        ).count()
        == 0
    )


@BOTH
def test_one_day_equals_full_history(spark, cfg):
    from datetime import date

    rng = random.Random(3)
    first = 1_735_689_600  # 2025-01-01
    rows = [
        (f"t{n}", f"c{n % 7}", first + rng.randrange(60 * 86400), round(rng.uniform(1, 99), 2))
        for n in range(600)
    ]
    rows.append(("edge", "c0", first + 9 * 86400, 77.0))
    rows.append(("midnight", "c0", first + 39 * 86400, 77.0))
    last_second = first + 40 * 86400 - 1  # of the day, and of the days its frames start in
    for days in (0, 1, 2, 6, 7, 8, 29, 30):
        for shift in (-1, 0, 1):
            if days or shift <= 0:
                rows.append((f"e{days}{shift}", "c1", last_second - days * 86400 + shift, 1.0 + days))
                rows.append((f"m{days}{shift}", "c2", first + (39 - days) * 86400 + shift * (days > 0), 2.0 + days))
    raw = frame(spark, rows).withColumn("date", F.to_date("transaction_timestamp"))
    day = date(2025, 2, 9)
    want = features(raw, cfg).filter(F.to_date("transaction_timestamp") == F.lit(day))
    got = features_for_day(raw, day, cfg)
    assert got.count() > 5
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_one_day_in_another_time_zone(spark):
    """Days of another zone do not start with UTC's; results must not notice."""
    from datetime import date

    rng = random.Random(5)
    first = 1_735_689_600
    rows = [
        (f"t{n}", f"c{n % 3}", first + rng.randrange(45 * 86400), round(rng.uniform(1, 99), 2))
        for n in range(400)
    ]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        raw = frame(spark, rows).withColumn("date", F.to_date("transaction_timestamp"))
        day = date(2025, 2, 9)
        want = features(raw).filter(F.to_date("transaction_timestamp") == F.lit(day)).collect()
        got = features_for_day(raw, day).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(got) > 3 and sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_home_country_of_the_customer(spark):
    customers = spark.createDataFrame([("ann", "FR")], "customer_id string, home_country string")
    rows = with_home_country(golden_input(spark), customers)
    got = {
        r["transaction_id"]: r["is_foreign_merchant"]
        for r in features(rows, LIGHT, F.col("home_country")).collect()
    }
    assert got == {"g1": 1, "g2": 0, "g3": 1, "g4": 0, "g5": 0}
