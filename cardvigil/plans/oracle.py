"""The same queries in DuckDB's SQL, written from their definitions.

Features use plain sliding RANGE frames here, so agreement also checks the
running-total and block method of operators/rolling.py. Literals repeat the
thresholds of plans/standin.py.
"""

from __future__ import annotations

TXN = """
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CAST(user_id AS VARCHAR) AS card_id,
         CAST(user_id AS VARCHAR) AS customer_id,
         CAST(value AS DECIMAL(18,2)) AS amount,
         'INR' AS currency,
         'M' || k AS merchant_name,
         'C' || k AS merchant_city,
         n_name AS merchant_country,
         ts AS transaction_timestamp,
         event_type AS transaction_type,
         CASE WHEN event_type = 'error' AND k < 15 THEN 1 ELSE 0 END AS is_fraud,
         event_type = 'purchase' AS card_present,
         'DEV_' || user_id AS device_id,
         k,
         CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT) AS c,
         CAST(floor(epoch(ts)) AS BIGINT) AS sec
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
  LEFT JOIN nation ON n_nationkey = k % 25
)"""

HOT = TXN.replace(
    "CAST(user_id AS VARCHAR) AS card_id",
    "CASE WHEN k < 33 THEN 'hot' ELSE CAST(user_id AS VARCHAR) END AS card_id",
)

FEAT = """
win AS (
  SELECT *,
    count(transaction_id) OVER w10m AS txn_count_10min,
    count(transaction_id) OVER w1h AS txn_count_1h,
    count(transaction_id) OVER w24h AS txn_count_24h,
    count(amount) OVER w7d AS n7, sum(c) OVER w7d AS s7,
    count(amount) OVER w30d AS n30, sum(c) OVER w30d AS s30,
    sum(CAST(c AS HUGEINT) * c) OVER w30d AS ss30,
    max(c) OVER w24h AS m24, sum(c) OVER w24h AS s24
  FROM txn
  WINDOW w10m AS (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 600 PRECEDING AND CURRENT ROW),
         w1h AS (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW),
         w24h AS (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW),
         w7d AS (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW),
         w30d AS (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW)
),
stats AS (
  SELECT *,
    s7::DOUBLE / 100.0::DOUBLE / n7 AS avg_amount_7d,
    s30::DOUBLE / 100.0::DOUBLE / n30 AS avg_amount_30d,
    CASE WHEN n30 > 1 THEN
      sqrt((n30 * ss30 - s30 * s30)::DOUBLE / (n30::DOUBLE * (n30::DOUBLE - 1))) / 100.0::DOUBLE
    END AS stddev_amount_30d,
    m24::DOUBLE / 100.0::DOUBLE AS max_amount_24h,
    s24::DOUBLE / 100.0::DOUBLE AS sum_amount_24h,
    round(txn_count_10min / 10.0::DOUBLE, 2) AS txn_per_minute
  FROM win
),
scaled AS (
  SELECT *, CASE WHEN stddev_amount_30d > 0
                 THEN (amount::DOUBLE - avg_amount_30d) / stddev_amount_30d
                 ELSE 0.0::DOUBLE END AS zscore_amount
  FROM stats
),
feat AS (
  SELECT *,
    CASE WHEN hour(transaction_timestamp) BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS is_night_txn,
    CASE WHEN merchant_country <> 'NATION_0' THEN 1 ELSE 0 END AS is_foreign_merchant,
    CASE WHEN amount > 150 THEN 1 ELSE 0 END AS is_high_amount,
    CASE WHEN txn_per_minute > 0.15::DOUBLE THEN 1 ELSE 0 END AS is_velocity_spike,
    CASE WHEN zscore_amount > 3.0::DOUBLE THEN 1 ELSE 0 END AS is_amount_anomaly,
    CAST(CAST(transaction_timestamp AS DATE) AS VARCHAR) AS day
  FROM scaled
)"""

FEATURE_LIST = """transaction_id, card_id, customer_id, amount::DOUBLE AS amount, merchant_country,
  transaction_timestamp, transaction_type, txn_count_1h, txn_count_24h, txn_count_10min,
  avg_amount_7d, avg_amount_30d, max_amount_24h, sum_amount_24h, zscore_amount, txn_per_minute,
  is_night_txn, is_foreign_merchant, is_high_amount, is_velocity_spike, is_amount_anomaly, is_fraud"""

RAW_LIST = """transaction_id, card_id, customer_id, amount::DOUBLE AS amount, currency, merchant_name,
  merchant_city, merchant_country, transaction_timestamp, transaction_type, is_fraud, card_present,
  device_id"""

SCORED = """
scored AS (
  SELECT *,
    least(100, 35 * is_amount_anomaly + 35 * is_velocity_spike + 35 * is_high_amount
               + 30 * is_foreign_merchant + 15 * is_night_txn) / 100.0::DOUBLE AS fraud_score,
    concat_ws(',',
      CASE WHEN is_night_txn = 1 THEN 'is_night_txn' END,
      CASE WHEN is_foreign_merchant = 1 THEN 'is_foreign_merchant' END,
      CASE WHEN is_high_amount = 1 THEN 'is_high_amount' END,
      CASE WHEN is_velocity_spike = 1 THEN 'is_velocity_spike' END,
      CASE WHEN is_amount_anomaly = 1 THEN 'is_amount_anomaly' END) AS fraud_flags
  FROM feat
),
graded AS (
  SELECT *, CASE WHEN fraud_score > 0.85::DOUBLE THEN 'HIGH'
                 WHEN fraud_score > 0.70::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS alert_severity
  FROM scored
),
alerts AS (
  SELECT sha256('alert:' || transaction_id) AS alert_id, transaction_id, card_id,
         amount::DOUBLE AS amount, merchant_name, merchant_country, transaction_timestamp,
         fraud_score, fraud_flags, alert_severity, false AS is_resolved,
         CAST(NULL AS VARCHAR) AS resolved_by, CAST(NULL AS TIMESTAMP) AS resolved_at,
         transaction_timestamp AS _created_at, day, k, c
  FROM graded WHERE fraud_score > 0.6::DOUBLE
)"""

RESOLVED = """
resolved AS (
  SELECT * REPLACE (k % 3 = 0 AS is_resolved,
                    CASE WHEN k % 3 = 0 THEN 'analyst' END AS resolved_by,
                    CASE WHEN k % 3 = 0 THEN transaction_timestamp + INTERVAL 1 HOUR END AS resolved_at)
  FROM alerts
)"""

ALERT_LIST = """alert_id, transaction_id, card_id, amount, merchant_name, merchant_country,
  transaction_timestamp, fraud_score, fraud_flags, alert_severity, is_resolved, resolved_by,
  resolved_at, _created_at"""


def _feat(select: str) -> str:
    return f"WITH {TXN}, {FEAT} {select}"


def _alerts(select: str) -> str:
    return f"WITH {TXN}, {FEAT}, {SCORED}, {RESOLVED} {select}"


def _txn(select: str) -> str:
    return f"WITH {TXN} {select}"


def _half_up(part: str, total: str, factor: int) -> str:
    """round(part / total * factor) to a whole number, in integers; the caller scales back."""
    return f"((2 * {factor}::HUGEINT * {part} + {total}) // (2 * {total}))::DOUBLE"


REGULAR_DAY = """(SELECT max(day) FROM (
  SELECT CAST(CAST(transaction_timestamp AS DATE) AS VARCHAR) AS day FROM txn GROUP BY 1
  HAVING sum(is_fraud)::DOUBLE / count(*) BETWEEN 0.01::DOUBLE AND 0.05::DOUBLE))"""

ALL_FEATURES = _feat(f"SELECT {FEATURE_LIST} FROM feat")
ALL_ALERTS = _alerts(f"SELECT {ALERT_LIST}, day AS _alert_date FROM alerts")

ORACLES: dict[str, str] = {
    "features_rolling_counts": _feat(
        "SELECT transaction_id, txn_count_10min, txn_count_1h, txn_count_24h FROM feat"
    ),
    "features_rolling_amounts": _feat(
        "SELECT transaction_id, avg_amount_7d, avg_amount_30d, max_amount_24h, sum_amount_24h FROM feat"
    ),
    "features_zscore": _feat(
        "SELECT transaction_id, stddev_amount_30d, zscore_amount, is_amount_anomaly FROM feat"
    ),
    "features_velocity": _feat(
        "SELECT transaction_id, txn_count_10min, txn_per_minute, is_velocity_spike FROM feat"
    ),
    "features_flags": _feat(
        "SELECT transaction_id, is_night_txn, is_foreign_merchant, is_high_amount, "
        "is_velocity_spike, is_amount_anomaly FROM feat"
    ),
    "features_all": ALL_FEATURES,
    "features_per_second": ALL_FEATURES,
    "features_hot_card": f"WITH {HOT}, {FEAT} SELECT {FEATURE_LIST} FROM feat",
    "features_foreign_home": _txn(
        """SELECT transaction_id, merchant_country, h.n_name AS home_country,
             CASE WHEN merchant_country <> h.n_name THEN 1 ELSE 0 END AS is_foreign_merchant
           FROM txn LEFT JOIN customer ON customer_id = CAST(c_custkey AS VARCHAR)
           LEFT JOIN nation h ON h.n_nationkey = c_nationkey"""
    ),
    "features_incremental": _feat(f"SELECT {FEATURE_LIST} FROM feat WHERE day = '2024-01-30'"),
    "features_write_roundtrip": _feat(f"SELECT {FEATURE_LIST}, day AS _feature_date FROM feat"),
    "features_table_load": _feat(
        f"""SELECT {FEATURE_LIST}, day AS _feature_date,
            TIMESTAMP '2024-01-31 00:00:00' AS _loaded_at FROM feat"""
    ),
    "raw_table_load": _txn(
        f"""SELECT {RAW_LIST}, TIMESTAMP '2024-01-31 00:00:00' AS _loaded_at,
            CAST(CAST(transaction_timestamp AS DATE) AS VARCHAR) AS date FROM txn"""
    ),
    "q_daily_fraud_summary": _txn(
        f"""SELECT CAST(CAST(transaction_timestamp AS DATE) AS VARCHAR) AS txn_date,
             count(*) AS total_transactions,
             CAST(sum(is_fraud) AS BIGINT) AS fraud_count,
             {_half_up("sum(is_fraud)", "count(*)", 10000)} / 100.0::DOUBLE AS fraud_rate_pct,
             round(sum(CASE WHEN is_fraud = 1 THEN amount ELSE 0 END), 2)::DOUBLE AS fraud_amount_inr
           FROM txn WHERE CAST(transaction_timestamp AS DATE) >= DATE '2024-02-14' - INTERVAL 30 DAY
           GROUP BY 1 ORDER BY 1 DESC"""
    ),
    "q_high_risk_cards": _feat(
        """SELECT card_id, count(*) AS suspicious_txns,
             CAST(sum(is_amount_anomaly) AS BIGINT) AS amount_anomalies,
             CAST(sum(is_velocity_spike) AS BIGINT) AS velocity_spikes,
             CAST(sum(is_foreign_merchant) AS BIGINT) AS foreign_txns,
             max(zscore_amount) AS max_zscore
           FROM feat WHERE day = '2024-01-30'
           GROUP BY card_id HAVING count(*) >= 3
           ORDER BY suspicious_txns DESC, card_id LIMIT 100"""
    ),
    "q_fraud_by_country": _txn(
        f"""SELECT merchant_country, count(*) AS total_txns,
             CAST(sum(is_fraud) AS BIGINT) AS fraud_count,
             {_half_up("sum(is_fraud)", "count(*)", 10000)} / 100.0::DOUBLE AS fraud_rate_pct,
             {_half_up("sum(c)", "count(amount)", 1)} / 100.0::DOUBLE AS avg_txn_amount
           FROM txn GROUP BY merchant_country ORDER BY fraud_rate_pct DESC, merchant_country"""
    ),
    "q_alert_resolution_rate": _alerts(
        f"""SELECT CAST(CAST(_created_at AS DATE) AS VARCHAR) AS alert_date, alert_severity,
             count(*) AS total_alerts,
             count(*) FILTER (WHERE is_resolved) AS resolved_alerts,
             {_half_up("count(*) FILTER (WHERE is_resolved)", "count(*)", 1000)} / 10.0::DOUBLE
               AS resolution_rate_pct
           FROM resolved GROUP BY 1, 2 ORDER BY 1 DESC, 2"""
    ),
    "dq_feature_report": _feat(
        f"""SELECT count(*) AS total_rows,
             count(*) FILTER (WHERE last = 3) AS null_transaction_ids,
             count(*) FILTER (WHERE last = 6 AND amount >= 0 OR last <> 6 AND amount < 0) AS negative_amounts,
             count(*) FILTER (WHERE last <> 3 AND (last = 5 AND txn_count_10min > 0 OR last <> 5 AND (
               txn_count_10min < 1 OR txn_count_1h < txn_count_10min OR txn_count_24h < txn_count_1h)))
               AS inconsistent_counts,
             count(*) FILTER (WHERE last = 4 OR zscore_amount IS NULL) AS null_zscores,
             count(*) FILTER (WHERE is_fraud = 1) AS fraud_rows,
             {_half_up("count(*) FILTER (WHERE is_fraud = 1)", "count(*)", 10000)} / 100.0::DOUBLE
               AS fraud_rate_pct
           FROM (SELECT *, CAST(transaction_id AS BIGINT) % 10 AS last FROM feat)"""
    ),
    "dq_row_reconciliation": _txn(
        """SELECT count(*) AS raw_rows,
             count(*) - count(*) FILTER (WHERE last = 1) + count(*) FILTER (WHERE last = 2) AS feature_rows,
             count(*) FILTER (WHERE last = 1) AS missing_rows,
             count(*) FILTER (WHERE last = 2) AS extra_rows,
             count(*) FILTER (WHERE last IN (1, 2)) = 0 AS is_reconciled
           FROM (SELECT *, CAST(transaction_id AS BIGINT) % 10 AS last FROM txn)"""
    ),
    "dq_fraud_rate_bounds": _txn(
        """SELECT CAST(CAST(transaction_timestamp AS DATE) AS VARCHAR) AS run_date,
             count(*) AS total_rows, CAST(sum(is_fraud) AS BIGINT) AS fraud_rows,
             sum(is_fraud)::DOUBLE / count(*) AS fraud_rate,
             sum(is_fraud)::DOUBLE / count(*) BETWEEN 0.01::DOUBLE AND 0.05::DOUBLE AS is_in_bounds
           FROM txn GROUP BY 1"""
    ),
    "dq_raw_presence": _txn(
        """SELECT CAST(CAST(d.day AS DATE) AS VARCHAR) AS run_date, count(t.transaction_id) AS raw_rows,
             count(t.transaction_id) > 0 AS has_data
           FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) d(day)
           LEFT JOIN txn t ON CAST(t.transaction_timestamp AS DATE) = CAST(d.day AS DATE)
           GROUP BY d.day"""
    ),
    "dq_not_null_contract": _alerts(
        """, f AS (SELECT *, CAST(transaction_id AS BIGINT) % 10 AS last FROM feat),
           a AS (SELECT *, CAST(transaction_id AS BIGINT) % 10 AS last FROM alerts)
           SELECT table_name, column_name, null_rows, null_rows = 0 AS is_satisfied FROM (
             SELECT 'raw_transactions' AS table_name, 'transaction_id' AS column_name,
               count(*) FILTER (WHERE k = 3) AS null_rows FROM txn
             UNION ALL SELECT 'raw_transactions', 'card_id', count(*) FILTER (WHERE k IN (3, 4)) FROM txn
             UNION ALL SELECT 'raw_transactions', 'transaction_timestamp',
               count(*) FILTER (WHERE transaction_timestamp IS NULL) FROM txn
             UNION ALL SELECT 'transaction_features', 'transaction_id', count(*) FILTER (WHERE last = 3) FROM f
             UNION ALL SELECT 'transaction_features', 'card_id', count(*) FILTER (WHERE last = 4) FROM f
             UNION ALL SELECT 'fraud_alerts', 'alert_id', 0 FROM (SELECT 1)
             UNION ALL SELECT 'fraud_alerts', 'transaction_id', count(*) FILTER (WHERE last = 3) FROM a
             UNION ALL SELECT 'fraud_alerts', 'card_id', count(*) FILTER (WHERE last = 4) FROM a)"""
    ),
    "raw_retention": _txn(
        f"""SELECT {RAW_LIST}, CAST(CAST(transaction_timestamp AS DATE) AS VARCHAR) AS date
            FROM txn WHERE CAST(transaction_timestamp AS DATE) >= DATE '2024-01-11'"""
    ),
    "score_transactions": _alerts(
        "SELECT transaction_id, fraud_score, alert_severity, fraud_flags FROM graded"
    ),
    "score_latest_day": _alerts(
        """SELECT transaction_id, day AS _feature_date, fraud_score, alert_severity
           FROM graded WHERE day = (SELECT max(day) FROM graded)"""
    ),
    "alerts_build": ALL_ALERTS,
    "alerts_missing_raw": _alerts(
        f"""SELECT * REPLACE (CASE WHEN k % 5 <> 0 THEN merchant_name END AS merchant_name)
            FROM (SELECT {ALERT_LIST}, k FROM alerts)"""
    ).replace("SELECT * REPLACE (CASE WHEN k % 5", "SELECT * EXCLUDE (k) REPLACE (CASE WHEN k % 5"),
    "alerts_list": _alerts(
        f"""SELECT {ALERT_LIST} FROM alerts WHERE alert_severity = 'MEDIUM'
            ORDER BY transaction_timestamp DESC, transaction_id LIMIT 50"""
    ),
    "alerts_list_all": _alerts(
        f"""SELECT {ALERT_LIST} FROM alerts
            ORDER BY transaction_timestamp DESC, transaction_id LIMIT 10"""
    ),
    "alerts_by_transaction": _alerts(
        f"SELECT {ALERT_LIST} FROM alerts WHERE transaction_id = '65'"
    ),
    "alerts_summary_24h": _alerts(
        """SELECT count(*) AS total_alerts,
             count(*) FILTER (WHERE alert_severity = 'HIGH') AS high_severity,
             count(*) FILTER (WHERE alert_severity = 'MEDIUM') AS medium_severity,
             count(*) FILTER (WHERE alert_severity = 'LOW') AS low_severity,
             coalesce(sum(c), 0)::DOUBLE / 100.0::DOUBLE AS total_amount_at_risk
           FROM alerts WHERE transaction_timestamp > TIMESTAMP '2024-01-30'
             AND transaction_timestamp <= TIMESTAMP '2024-01-31'"""
    ),
    "alerts_resolve": _alerts(f"SELECT {ALERT_LIST} FROM resolved"),
    "daily_refresh": _feat(
        f"""SELECT {FEATURE_LIST}, day AS _feature_date,
            TIMESTAMP '2024-01-31 00:00:00' AS _loaded_at FROM feat WHERE day = {REGULAR_DAY}"""
    ),
    "daily_scoring": _alerts(
        f"""SELECT {ALERT_LIST}, day AS _alert_date FROM (
              SELECT * REPLACE (TIMESTAMP '2024-01-31 00:00:00' AS _created_at) FROM alerts)
            WHERE day = {REGULAR_DAY}"""
    ),
    "daily_refused": _feat(
        f"""SELECT {FEATURE_LIST}, day AS _feature_date,
            TIMESTAMP '2024-01-31 00:00:00' AS _loaded_at, true AS is_refused FROM feat WHERE day = {REGULAR_DAY}"""
    ),
    "ingest_json_decode": _txn(f"SELECT {RAW_LIST} FROM txn"),
    "ingest_json_files": _txn(f"SELECT {RAW_LIST} FROM txn"),
    "ingest_json_array": _txn(
        """SELECT transaction_id,
             CASE WHEN k >= 3 THEN amount::DOUBLE END AS amount,
             CASE WHEN k <> 5 THEN transaction_timestamp END AS transaction_timestamp,
             k >= 3 AND k <> 5 AS is_valid,
             CASE WHEN k < 3 THEN 'unreadable_payload' WHEN k = 5 THEN 'missing_timestamp' ELSE '' END AS reasons
           FROM txn"""
    ),
    "ingest_route": _txn(
        """SELECT CAST(transaction_id AS BIGINT) AS event_id,
             CASE WHEN k <= 6 THEN 'rejected' ELSE 'valid' END AS route,
             CASE WHEN k < 3 THEN 'unreadable_payload'
                  WHEN k = 3 THEN 'missing_transaction_id,missing_card_id'
                  WHEN k = 4 THEN 'missing_card_id'
                  WHEN k = 5 THEN 'missing_timestamp'
                  WHEN k = 6 THEN 'negative_amount' ELSE '' END AS reasons
           FROM txn"""
    ),
    "stream_ingest_dedup": _txn(
        f"""SELECT {RAW_LIST}, CAST(CAST(transaction_timestamp AS DATE) AS VARCHAR) AS date FROM txn"""
    ),
    "late_rows_repaired": _feat(
        f"SELECT {FEATURE_LIST}, day AS _feature_date FROM feat WHERE day = '2024-01-30'"
    ),
    "late_rows_revised": _feat(
        f"""SELECT {FEATURE_LIST}, day AS _feature_date, TIMESTAMP '2024-01-31 00:00:00' AS _loaded_at FROM feat"""
    ),
    "day_totals_kept": _txn(
        """SELECT card_id, CAST(CAST(transaction_timestamp AS DATE) AS VARCHAR) AS date, count(transaction_id) AS ids,
             count(amount) AS amounts, CAST(coalesce(sum(c), 0) AS BIGINT) AS cents,
             coalesce(sum(CAST(c AS HUGEINT) * c), 0)::DOUBLE AS squares, max(c) AS top
           FROM txn GROUP BY 1, 2"""
    ),
    "stream_dead_letters": _txn(
        """SELECT CASE WHEN k < 3 THEN 'unreadable_payload'
                       WHEN k = 3 THEN 'missing_transaction_id,missing_card_id'
                       WHEN k = 4 THEN 'missing_card_id'
                       WHEN k = 5 THEN 'missing_timestamp'
                       WHEN k = 6 THEN 'negative_amount' ELSE 'future_timestamp' END AS reasons,
             count(*) AS letters
           FROM txn WHERE k <= 6 OR k = 8 GROUP BY 1"""
    ),
    "stream_velocity_10min": _txn(
        """SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, card_id,
             count(transaction_id) AS txn_count_10min,
             round(count(transaction_id) / 10.0::DOUBLE, 2) AS txn_per_minute
           FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, transaction_timestamp)
                             - step * INTERVAL 5 MINUTE AS window_start
                 FROM txn, (VALUES (0), (1)) steps(step))
           GROUP BY window_start, card_id"""
    ),
    "stream_velocity_sealed": _txn(
        """SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, card_id,
             count(transaction_id) AS txn_count_10min,
             round(count(transaction_id) / 10.0::DOUBLE, 2) AS txn_per_minute
           FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, transaction_timestamp)
                             - step * INTERVAL 5 MINUTE AS window_start
                 FROM txn, (VALUES (0), (1)) steps(step))
           WHERE CAST(window_start AS DATE) = DATE '2024-01-21'
           GROUP BY window_start, card_id"""
    ),
    "stream_score_alerts": ALL_ALERTS,
    "stream_score_hot_card": ALL_ALERTS.replace(TXN, HOT),
    "stream_too_late": _txn(
        """SELECT CAST(CAST(transaction_timestamp AS DATE) AS VARCHAR) AS date, count(*) AS late_rows
           FROM (SELECT *, CASE WHEN k = 7 OR transaction_timestamp >= TIMESTAMP '2024-01-21' THEN TIMESTAMP '2025-01-01'
                                WHEN transaction_timestamp < TIMESTAMP '2024-01-11' THEN TIMESTAMP '2024-01-11'
                                ELSE TIMESTAMP '2024-01-21' END AS arrival FROM txn)
           WHERE transaction_timestamp < arrival - INTERVAL 1 DAY GROUP BY 1"""
    ),
    "stream_alerts_compacted": _alerts(
        f"""SELECT {ALERT_LIST}, day AS _alert_date FROM (
              SELECT * REPLACE (CASE WHEN transaction_timestamp < TIMESTAMP '2024-01-11' THEN is_resolved ELSE false END AS is_resolved,
                                CASE WHEN transaction_timestamp < TIMESTAMP '2024-01-11' THEN resolved_by END AS resolved_by,
                                CASE WHEN transaction_timestamp < TIMESTAMP '2024-01-11' THEN resolved_at END AS resolved_at)
              FROM resolved)"""
    ),
}
