"""Every registered query against its SQL in DuckDB, on all rows of the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from cardvigil.plans.catalog import QUERIES
from cardvigil.plans.oracle import ORACLES



@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("events", "nation", "customer"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


# Queries that promise an order, and the columns that show it.
ORDERED = {
    "q_daily_fraud_summary": ["txn_date"],
    "q_high_risk_cards": ["suspicious_txns", "card_id"],
    "q_fraud_by_country": ["fraud_rate_pct", "merchant_country"],
    "q_alert_resolution_rate": ["alert_date", "alert_severity"],
    "alerts_list": ["transaction_timestamp", "transaction_id"],
    "alerts_list_all": ["transaction_timestamp", "transaction_id"],
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_oracle(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    if name in ORDERED:
        assert [repr(tuple(r)) for r in got.select(*ORDERED[name]).collect()] == [
            repr(r) for r in want.select(*[duckdb.ColumnExpression(c) for c in ORDERED[name]]).fetchall()
        ]
    columns = sorted(got.columns)
    rows = sorted(repr(tuple(r)) for r in got.select(*columns).collect())
    expected = want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert rows == sorted(map(repr, expected))
