"""Small inputs and a brute-force reading of the trailing features."""

from __future__ import annotations

import math
from datetime import datetime, timezone
from decimal import Decimal

from cardvigil.operators.rolling import SPANS

INPUT = (
    "transaction_id string, card_id string, customer_id string, amount double, "
    "merchant_country string, transaction_timestamp timestamp, transaction_type string, is_fraud int"
)


def at(epoch):
    """A timestamp as Spark takes it: naive local time of the epoch second."""
    return None if epoch is None else datetime.fromtimestamp(epoch)


def utc(*parts):
    return at(datetime(*parts, tzinfo=timezone.utc).timestamp())


# Two cards of one day: the last second of the night and the first of the day, a purchase
# abroad, one at the high-amount bar and one a cent above, two in one second.
GOLDEN_ROWS = [
    ("g1", "blue", "ann", 80.0, "IN", utc(2024, 5, 6, 5, 59, 59), "CHIP", 0),
    ("g2", "blue", "ann", 120.5, "FR", utc(2024, 5, 6, 6, 0, 0), "WEB", 0),
    ("g3", "blue", "ann", 50000.0, "IN", utc(2024, 5, 6, 6, 10, 0), "WEB", 0),
    ("g4", "green", "bo", 50000.01, "IN", utc(2024, 5, 6, 23, 59, 58), "SWIPE", 1),
    ("g5", "green", "bo", 7.25, "IN", utc(2024, 5, 6, 23, 59, 58), "SWIPE", 0),
]


def golden_input(spark):
    return spark.createDataFrame(GOLDEN_ROWS, INPUT)


def frame(spark, rows):
    """Rows of (id, card, epoch second, amount); everything else is neutral."""
    full = [(i, card, "CUST", amount, "IN", at(sec), "POS", 0) for i, card, sec, amount in rows]
    return spark.createDataFrame(full, INPUT)


def brute_force(rows):
    """Trailing features of (id, card, epoch second, amount) rows, by comparing all pairs."""
    out = {}
    for key, (i, card, sec, amount) in enumerate(rows):

        def inside(span):
            for j, other, s, a in rows:
                if other != card:
                    continue
                if sec is None:
                    if s is None:
                        yield j, a
                elif s is not None and sec - SPANS[span] <= s <= sec:
                    yield j, a

        def cents(span):
            return [int(Decimal(str(a)) * 100) for _, a in inside(span) if a is not None]

        def mean(span):
            found = cents(span)
            return sum(found) / 100.0 / len(found) if found else None

        month = cents("30d")
        n = len(month)
        spread = None
        if n > 1:
            numerator = n * sum(c * c for c in month) - sum(month) ** 2
            spread = math.sqrt(float(numerator) / (n * (n - 1))) / 100.0
        day = cents("24h")
        zscore = 0.0
        if spread:
            zscore = None if amount is None else (amount - mean("30d")) / spread
        out[key] = {
            "txn_count_10min": sum(j is not None for j, _ in inside("10min")),
            "txn_count_1h": sum(j is not None for j, _ in inside("1h")),
            "txn_count_24h": sum(j is not None for j, _ in inside("24h")),
            "avg_amount_7d": mean("7d"),
            "avg_amount_30d": mean("30d"),
            "stddev_amount_30d": spread,
            "max_amount_24h": max(day) / 100.0 if day else None,
            "sum_amount_24h": sum(day) / 100.0 if day else None,
            "zscore_amount": zscore,
        }
    return [out[k] for k in range(len(rows))]
