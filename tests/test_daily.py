"""The daily chain on a stored raw table, and the command line."""

from __future__ import annotations

import json
import os
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import cardvigil.__main__ as command
from cardvigil.operators.features import features
from cardvigil.operators.quality import QualityError
from cardvigil.plans import daily, standin
from cardvigil.schema import ALERT_COLUMNS, FEATURE_COLUMNS, FEATURE_TABLE, RAW_TABLE
from cardvigil.session import shared_folder
from cardvigil.sources.raw import read_raw
from cardvigil.sources.tables import write_by_date

DAY = date(2024, 1, 30)
NIGHT = datetime(2024, 1, 31, 2)


@pytest.fixture
def raw_path(spark, sf_dir, folder):
    write_by_date(standin.transactions(spark, sf_dir), folder("raw"), RAW_TABLE)
    return folder("raw")


def test_chain_and_scoring(spark, sf_dir, raw_path, folder):
    from dataclasses import replace

    cfg = replace(standin.CONFIG, min_fraud_rate=0.0, max_fraud_rate=1.0)
    loaded = daily.refresh_day(
        spark, raw_path, folder("features"), folder("table"), DAY, NIGHT, cfg
    )
    everything = features(standin.transactions(spark, sf_dir), cfg)
    want = everything.filter(F.to_date("transaction_timestamp") == F.lit(DAY))
    assert want.exceptAll(loaded.select(*FEATURE_COLUMNS)).count() == 0
    assert loaded.count() == want.count() > 0
    assert loaded.select("_loaded_at").distinct().collect() == [(NIGHT,)]

    alerts = daily.score_day(spark, raw_path, folder("table"), folder("alerts"), DAY, NIGHT, cfg)
    assert alerts.select(*ALERT_COLUMNS).filter("merchant_name IS NULL OR fraud_score <= 0.6").count() == 0


def test_chain_stops_without_raw_data(spark, raw_path, folder):
    with pytest.raises(QualityError, match="no raw data"):
        daily.refresh_day(spark, raw_path, folder("f"), folder("t"), date(2024, 2, 5), NIGHT)


def test_chain_stops_on_an_unusual_fraud_rate(spark, raw_path, folder):
    from dataclasses import replace

    cfg = replace(standin.CONFIG, min_fraud_rate=0.99, max_fraud_rate=1.0)
    with pytest.raises(QualityError, match="fraud rate"):
        daily.refresh_day(spark, raw_path, folder("f"), folder("t"), DAY, NIGHT, cfg)


def test_command_line_on_json(spark, folder, monkeypatch):
    record = {
        "transaction_id": "T1",
        "card_id": "C1",
        "amount": 60000,
        "merchant_country": "US",
        "transaction_timestamp": "2025-03-01T02:00:00",
        "is_fraud": 1,
    }
    with open(folder("in.json"), "w") as f:
        json.dump([record, {**record, "transaction_id": "T2"}], f)
    monkeypatch.setattr(sys, "argv", ["cardvigil", "--input", folder("in.json"), "--output", folder("out")])
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    command.main()
    got = spark.read.parquet(folder("out")).collect()
    assert [r["txn_count_10min"] for r in got] == [2, 2]
    assert all(r["is_high_amount"] == r["is_foreign_merchant"] == r["is_night_txn"] == 1 for r in got)


def test_invalid_json_writes_nothing(spark, folder):
    with open(folder("bad.json"), "w") as f:
        json.dump([{"card_id": "C1", "amount": 5, "transaction_timestamp": "2025-03-01T02:00:00"}], f)
    with pytest.raises(QualityError, match="null_transaction_ids"):
        daily.run_features_on_json(spark, folder("bad.json"), folder("out"))
    assert not os.path.exists(folder("out"))


def test_mistyped_json_writes_nothing(spark, folder):
    good = {"transaction_id": "T1", "card_id": "C1", "amount": 5, "transaction_timestamp": "2025-03-01T02:00:00"}
    for bad in ({"amount": "abc"}, {"transaction_timestamp": "soon"}):
        with open(folder("mixed.json"), "w") as f:
            json.dump([good, {**good, **bad}], f)
        with pytest.raises(QualityError):
            daily.run_features_on_json(spark, folder("mixed.json"), folder("out"))
    assert not os.path.exists(folder("out"))


def staged_folders(spark):
    return {n for n in os.listdir(shared_folder(spark).removeprefix("file:")) if n.startswith((RAW_TABLE.name, FEATURE_TABLE.name))}


def test_a_refused_day_leaves_the_old_output(spark, raw_path, folder, monkeypatch):
    def run():
        args = ["cardvigil", "--input", raw_path, "--output", folder("out"), "--run-date", "2024-01-30"]
        monkeypatch.setattr(sys, "argv", args)
        monkeypatch.setattr(type(spark), "stop", lambda self: None)
        before = staged_folders(spark)
        try:
            command.main()
        finally:
            assert staged_folders(spark) == before, "nothing staged is left behind"

    run()
    before = sorted(map(tuple, spark.read.parquet(folder("out")).collect()), key=str)
    good = read_raw(spark, raw_path)
    for broken in (
        good.withColumn("transaction_id", F.when(F.col("transaction_id") != "65", F.col("transaction_id"))),
        good.withColumn("amount", (-F.col("amount") - 5).cast("decimal(18,2)")),
        good.withColumn("card_id", F.lit(None).cast("string")),
    ):
        days = broken.filter(F.col("date") == F.lit(DAY))
        if days.filter("transaction_id IS NULL OR card_id IS NULL OR amount < 0").isEmpty():
            days = days.withColumn("transaction_id", F.lit(None).cast("string"))
        raw_path = folder(f"broken{len(os.listdir(folder('.')))}")
        write_by_date(days, raw_path, RAW_TABLE)
        with pytest.raises(QualityError):
            run()
        assert sorted(map(tuple, spark.read.parquet(folder("out")).collect()), key=str) == before


def test_command_line_on_a_day(spark, raw_path, folder, monkeypatch):
    args = ["cardvigil", "--input", raw_path, "--output", folder("out"), "--run-date", "2024-01-30"]
    monkeypatch.setattr(sys, "argv", args)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    command.main()
    days = spark.read.parquet(folder("out")).select("_feature_date").distinct().collect()
    assert days == [(DAY,)]
