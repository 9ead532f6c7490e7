"""Every query by name, over the stand-in transactions. Oracles are in plans/oracle.py."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardvigil.operators import alerts as desk
from cardvigil.operators import quality
from cardvigil.operators.features import engineer, features, features_for_day, with_home_country
from cardvigil.plans import analytics, daily, standin, upkeep
from cardvigil.plans.standin import (
    AS_OF,
    AS_OF_TIME,
    CONFIG,
    FIRST_DAY,
    LAST_DAY,
    RETENTION_AS_OF,
    SUMMARY_AS_OF,
)
from cardvigil.schema import ALERT_SCHEMA, ALERT_TABLE, DAY_TOTALS, FEATURE_TABLE, RAW_SCHEMA, RAW_TABLE
from cardvigil.session import new_folder, pin_utc, staging, stream_state
from cardvigil.sources import decode
from cardvigil.sources.raw import read_day_totals, read_json, read_raw
from cardvigil.sources.batches import BATCH
from cardvigil.sources.tables import (
    compact_alerts,
    conform_features,
    conform_raw,
    days_of,
    drop_expired,
    load_clustered,
    read_alerts,
    store_resolutions,
    with_partition_date,
    within_retention,
    write_by_date,
)
from cardvigil.streaming import ingest, memory, scoring, velocity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ONCE = {"availableNow": True}


def present(df: DataFrame) -> DataFrame:
    """Plain column types, which any reader of the result compares alike."""

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        return column.alias(field.name)

    return df.select(*[plain(field) for field in df.schema.fields])


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(pin_utc(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


# ---- features -----------------------------------------------------------


@query
def features_rolling_counts(spark, sf_dir):
    return engineer(standin.transactions(spark, sf_dir), CONFIG).select(
        "transaction_id", "txn_count_10min", "txn_count_1h", "txn_count_24h"
    )


@query
def features_rolling_amounts(spark, sf_dir):
    return engineer(standin.transactions(spark, sf_dir), CONFIG).select(
        "transaction_id", "avg_amount_7d", "avg_amount_30d", "max_amount_24h", "sum_amount_24h"
    )


@query
def features_zscore(spark, sf_dir):
    return engineer(standin.transactions(spark, sf_dir), CONFIG).select(
        "transaction_id", "stddev_amount_30d", "zscore_amount", "is_amount_anomaly"
    )


@query
def features_velocity(spark, sf_dir):
    return engineer(standin.transactions(spark, sf_dir), CONFIG).select(
        "transaction_id", "txn_count_10min", "txn_per_minute", "is_velocity_spike"
    )


@query
def features_flags(spark, sf_dir):
    return engineer(standin.transactions(spark, sf_dir), CONFIG).select(
        "transaction_id",
        "is_night_txn",
        "is_foreign_merchant",
        "is_high_amount",
        "is_velocity_spike",
        "is_amount_anomaly",
    )


@query
def features_all(spark, sf_dir):
    return features(standin.transactions(spark, sf_dir), CONFIG)


@query
def features_per_second(spark, sf_dir):
    """All cards taken the way of heavy cards."""
    return features(standin.transactions(spark, sf_dir), replace(CONFIG, heavy_rows=-1))


@query
def features_hot_card(spark, sf_dir):
    """A third of all transactions moved to one card, which alone is heavy."""
    return features(_one_hot_card(standin.transactions(spark, sf_dir)), replace(CONFIG, heavy_rows=200))


#: Slots over which the stream's memory of a heavy card is spread.
HOT_SLOTS = 4


def _one_hot_card(raw: DataFrame) -> DataFrame:
    moved = F.substring("merchant_name", 2, 10).cast("int") < 33
    return raw.withColumn("card_id", F.when(moved, F.lit("hot")).otherwise(F.col("card_id")))


@query
def features_foreign_home(spark, sf_dir):
    rows = with_home_country(standin.transactions(spark, sf_dir), standin.customers(spark, sf_dir))
    return engineer(rows, CONFIG, F.col("home_country")).select(
        "transaction_id", "merchant_country", "home_country", "is_foreign_merchant"
    )


def _raw_table(spark, sf_dir) -> DataFrame:
    return with_partition_date(standin.transactions(spark, sf_dir), RAW_TABLE)


@query
def features_incremental(spark, sf_dir):
    return features_for_day(_raw_table(spark, sf_dir), LAST_DAY, CONFIG)


def _raw_folder(spark, sf_dir) -> str:
    path = new_folder(spark, RAW_TABLE.name)
    write_by_date(standin.transactions(spark, sf_dir), path, RAW_TABLE)
    return path


def _stored_raw(spark, sf_dir) -> DataFrame:
    return read_raw(spark, _raw_folder(spark, sf_dir))


def _features_folder(spark, sf_dir) -> str:
    path = new_folder(spark, "features")
    write_by_date(features(standin.transactions(spark, sf_dir), CONFIG), path, FEATURE_TABLE)
    return path


def _written_features(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(_features_folder(spark, sf_dir))


@query
def features_write_roundtrip(spark, sf_dir):
    return _written_features(spark, sf_dir)


@query
def features_table_load(spark, sf_dir):
    path = new_folder(spark, FEATURE_TABLE.name)
    load_clustered(conform_features(_written_features(spark, sf_dir), AS_OF_TIME), path, FEATURE_TABLE)
    return spark.read.parquet(path)


@query
def raw_table_load(spark, sf_dir):
    path = new_folder(spark, RAW_TABLE.name)
    load_clustered(conform_raw(standin.transactions(spark, sf_dir), AS_OF_TIME), path, RAW_TABLE)
    return spark.read.parquet(path)


# ---- analytics ----------------------------------------------------------


@query
def q_daily_fraud_summary(spark, sf_dir):
    """From the stored table, of which only the report's days are read."""
    raw = _stored_raw(spark, sf_dir)
    return analytics.daily_fraud_summary(raw, SUMMARY_AS_OF, RAW_TABLE.date_column)


@query
def q_high_risk_cards(spark, sf_dir):
    """From the stored table, of which one day is read."""
    return analytics.high_risk_cards(_written_features(spark, sf_dir), AS_OF)


@query
def q_fraud_by_country(spark, sf_dir):
    return analytics.fraud_by_country(standin.transactions(spark, sf_dir))


@query
def q_alert_resolution_rate(spark, sf_dir):
    return analytics.alert_resolution_rate(_resolved_alerts(spark, sf_dir))


# ---- data quality -------------------------------------------------------


def _ending(digit: int):
    return F.col("transaction_id").cast("bigint") % 10 == digit


@query
def dq_feature_report(spark, sf_dir):
    """Of features of which some have lost their id, their sign or their z-score."""
    rows = features(standin.transactions(spark, sf_dir), CONFIG)
    damaged = {
        "amount": F.when(_ending(6), -F.col("amount") - 1).otherwise(F.col("amount")).cast("decimal(18,2)"),
        "zscore_amount": F.when(~_ending(4), F.col("zscore_amount")),
        "txn_count_1h": F.when(_ending(5), F.lit(0)).otherwise(F.col("txn_count_1h")),
        "transaction_id": F.when(~_ending(3), F.col("transaction_id")),
    }
    return quality.feature_report(rows.withColumns(damaged))


@query
def dq_row_reconciliation(spark, sf_dir):
    """Against features of which some are missing and some are there twice."""
    rows = _written_features(spark, sf_dir)
    damaged = rows.filter(~_ending(1)).unionByName(rows.filter(_ending(2)))
    return quality.reconcile_rows(standin.transactions(spark, sf_dir), damaged)


@query
def dq_fraud_rate_bounds(spark, sf_dir):
    return quality.fraud_rate_by_day(_raw_table(spark, sf_dir), RAW_TABLE.date_column, CONFIG)


@query
def dq_raw_presence(spark, sf_dir):
    return quality.raw_presence(_raw_table(spark, sf_dir), FIRST_DAY, AS_OF)


@query
def dq_not_null_contract(spark, sf_dir):
    """The required columns of all three tables, each table damaged."""
    raw = _damaged(standin.transactions(spark, sf_dir))
    lost = {"card_id": F.when(~_ending(4), F.col("card_id")), "transaction_id": F.when(~_ending(3), F.col("transaction_id"))}
    tables = (
        (RAW_TABLE, raw),
        (FEATURE_TABLE, features(standin.transactions(spark, sf_dir), CONFIG).withColumns(lost)),
        (ALERT_TABLE, _alerts(spark, sf_dir).withColumns(lost)),
    )
    found = [
        quality.not_null_violations(rows, contract).select(F.lit(contract.name).alias("table_name"), "*")
        for contract, rows in tables
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def raw_retention(spark, sf_dir):
    """What two years of retention, the contract's default, leave of the stored table.

    The table is listed before expired days are dropped from it, and read afterwards.
    """
    path = _raw_folder(spark, sf_dir)
    rows = read_raw(spark, path)
    drop_expired(spark, path, RETENTION_AS_OF, grace=2)
    return within_retention(rows, RETENTION_AS_OF)


# ---- scores and alerts --------------------------------------------------


@query
def score_transactions(spark, sf_dir):
    scored = desk.score(features(standin.transactions(spark, sf_dir), CONFIG), CONFIG)
    return scored.select("transaction_id", "fraud_score", "alert_severity", "fraud_flags")


@query
def score_latest_day(spark, sf_dir):
    """The newest partition of the feature table, scored."""
    path = _features_folder(spark, sf_dir)
    days = days_of(spark, path, FEATURE_TABLE.date_column)
    newest = desk.latest_features(spark.read.parquet(path), days)
    return desk.score(newest, CONFIG).select(
        "transaction_id", "_feature_date", "fraud_score", "alert_severity"
    )


def _alerts(spark, sf_dir) -> DataFrame:
    """Alerts straight from the feature computation, whose rows still carry the merchant."""
    rows = engineer(standin.transactions(spark, sf_dir), CONFIG)
    return desk.build_alerts(rows, F.col("transaction_timestamp"), CONFIG)


def _load_alerts(spark, alerts: DataFrame, path: str) -> None:
    """Stored first, as the load reads its rows twice and the features must be computed once."""
    with staging(spark, ALERT_TABLE.name) as made:
        alerts.write.parquet(made)
        load_clustered(spark.read.schema(ALERT_SCHEMA).parquet(made), path, ALERT_TABLE)


def _alerts_folder(spark, sf_dir) -> str:
    path = new_folder(spark, ALERT_TABLE.name)
    write_by_date(_alerts(spark, sf_dir), path, ALERT_TABLE)
    return path


def _stored_alerts(spark, sf_dir) -> DataFrame:
    return read_alerts(spark, _alerts_folder(spark, sf_dir))


def _resolved_alerts(spark, sf_dir) -> DataFrame:
    alerts = _stored_alerts(spark, sf_dir)
    return desk.resolve(alerts, standin.resolutions(alerts))


@query
def alerts_build(spark, sf_dir):
    """From the feature table, with the merchant name joined back, written and read."""
    path = new_folder(spark, ALERT_TABLE.name)
    rows, raw = _written_features(spark, sf_dir), standin.transactions(spark, sf_dir)
    built = desk.build_alerts(rows, F.col("transaction_timestamp"), CONFIG, raw)
    _load_alerts(spark, built, path)
    return read_alerts(spark, path)


@query
def alerts_missing_raw(spark, sf_dir):
    """From the feature table and a raw table that lacks a fifth of the merchants."""
    rows, raw = _written_features(spark, sf_dir), standin.transactions(spark, sf_dir)
    known = raw.filter(F.substring("merchant_name", 2, 10).cast("int") % 5 != 0)
    return desk.build_alerts(rows, F.col("transaction_timestamp"), CONFIG, known)


@query
def alerts_list(spark, sf_dir):
    """From the stored table, of which only the newest days are read."""
    path = _alerts_folder(spark, sf_dir)
    days = days_of(spark, path, ALERT_TABLE.date_column)
    return desk.list_stored_alerts(read_alerts(spark, path), days, "medium", 50)


@query
def alerts_list_all(spark, sf_dir):
    return desk.list_alerts(_alerts(spark, sf_dir))


@query
def alerts_by_transaction(spark, sf_dir):
    return desk.alert_by_transaction(_stored_alerts(spark, sf_dir), "65")


@query
def alerts_summary_24h(spark, sf_dir):
    alerts = _stored_alerts(spark, sf_dir)
    return desk.summarise(alerts, AS_OF_TIME, ALERT_TABLE.date_column)


@query
def alerts_resolve(spark, sf_dir):
    return _resolved_alerts(spark, sf_dir)


# ---- the daily chain ----------------------------------------------------


def _regular_day(raw: DataFrame) -> date:
    """The newest day whose fraud rate is within the bounds; a month has at most 31 to choose from."""
    rates = quality.fraud_rate_by_day(raw, RAW_TABLE.date_column, CONFIG).filter("is_in_bounds")
    return rates.agg(F.max("run_date")).first()[0]


def _refreshed(spark, sf_dir) -> tuple[str, str, date, DataFrame]:
    """A stored raw table, the feature table after one day's run, the day, and that day of it."""
    raw, output, loaded = (
        new_folder(spark, name) for name in (RAW_TABLE.name, "features", FEATURE_TABLE.name)
    )
    write_by_date(standin.transactions(spark, sf_dir), raw, RAW_TABLE)
    run_date = _regular_day(read_raw(spark, raw))
    day = daily.refresh_day(spark, raw, output, loaded, run_date, AS_OF_TIME, CONFIG)
    return raw, loaded, run_date, day


@query
def daily_refresh(spark, sf_dir):
    """Presence, features with lookback, validation, reconciliation, rate check, load."""
    return _refreshed(spark, sf_dir)[3]


@query
def daily_scoring(spark, sf_dir):
    """Alerts of the day just loaded."""
    raw, loaded, run_date, _ = _refreshed(spark, sf_dir)
    found = new_folder(spark, ALERT_TABLE.name)
    return daily.score_day(spark, raw, loaded, found, run_date, AS_OF_TIME, CONFIG)


@query
def daily_refused(spark, sf_dir):
    """A second run meets a raw table that has lost card ids: refused, the first run's day stays."""
    raw, loaded, run_date, _ = _refreshed(spark, sf_dir)
    worse = new_folder(spark, RAW_TABLE.name)
    lost = F.when(~_ending(0), F.col("card_id"))
    write_by_date(read_raw(spark, raw).withColumn("card_id", lost), worse, RAW_TABLE)
    later = AS_OF_TIME + timedelta(days=1)
    try:
        daily.refresh_day(spark, worse, new_folder(spark, "features"), loaded, run_date, later, CONFIG)
        refused = False
    except quality.QualityError:
        refused = True
    return spark.read.parquet(loaded).withColumn("is_refused", F.lit(refused))


# ---- ingest -------------------------------------------------------------


@query
def ingest_json_decode(spark, sf_dir):
    payloads = decode.encode_payload(standin.transactions(spark, sf_dir))
    return decode.valid_rows(decode.decode_payload(payloads))


@query
def ingest_json_files(spark, sf_dir):
    path = new_folder(spark, "json")
    decode.encode_payload(standin.transactions(spark, sf_dir)).write.text(path)
    return read_json(spark, path, one_array_per_file=False).select(*RAW_SCHEMA.names)


@query
def ingest_json_array(spark, sf_dir):
    """Files of one JSON array each, in which some records have a wrong type or a garbled time."""
    path = new_folder(spark, "json")
    payloads = decode.encode_payload(_numbered(standin.transactions(spark, sf_dir)))
    text, number = F.col("value"), F.col("number")
    mistyped = F.regexp_replace(text, '"amount":', '"amount":"about ').substr(F.lit(1), F.length(text) + 7)
    mistyped = F.regexp_replace(mistyped, '("about [0-9.-]+)', '$1"')
    garbled = F.regexp_replace(text, '"transaction_timestamp":"', '"transaction_timestamp":"on ')
    value = F.when(number < 3, mistyped).when(number == 5, garbled).otherwise(text)
    arrays = payloads.groupBy(F.floor(F.col("event_id") / 500).alias("file")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(value), ",\n"), F.lit("]")).alias("value")
    )
    arrays.write.partitionBy("file").text(path)
    rows = decode.with_route(read_json(spark, f"{path}/*"))
    return rows.select(
        "transaction_id",
        "amount",
        "transaction_timestamp",
        "is_valid",
        F.array_join("reasons", ",").alias("reasons"),
    )


def _numbered(raw: DataFrame) -> DataFrame:
    return raw.withColumn("event_id", F.col("transaction_id").cast("bigint")).withColumn(
        "number", F.substring("merchant_name", 2, 10).cast("int")
    )


def _damaged(raw: DataFrame) -> DataFrame:
    """All transactions, each broken in the way its merchant's number says, or not at all."""
    return (
        _numbered(raw)
        .withColumns(
            {
                "transaction_id": F.when(F.col("number") != 3, F.col("transaction_id")),
                "card_id": F.when(~F.col("number").between(3, 4), F.col("card_id")),
                "amount": F.when(F.col("number") == 6, -F.col("amount") - 1)
                .otherwise(F.col("amount"))
                .cast("decimal(18,2)"),
            }
        )
    )


def _damaged_payloads(raw: DataFrame) -> DataFrame:
    """The same as JSON, of which some is cut off or has a garbled time or one a century ahead."""
    text = F.col("value")
    cut = F.substring(text, F.lit(1), F.length(text) - 5)
    garbled = F.regexp_replace(text, '"transaction_timestamp":"', '"transaction_timestamp":"on ')
    ahead = F.regexp_replace(text, '"transaction_timestamp":"20', '"transaction_timestamp":"21')
    number = F.col("number")
    value = F.when(number < 3, cut).when(number == 5, garbled).when(number == 8, ahead).otherwise(text)
    return decode.encode_payload(_damaged(raw)).select("event_id", value.alias("value"))


@query
def ingest_route(spark, sf_dir):
    payloads = _damaged_payloads(standin.transactions(spark, sf_dir))
    return decode.with_route(decode.decode_payload(payloads)).select(
        "event_id",
        F.when(F.col("is_valid"), "valid").otherwise("rejected").alias("route"),
        F.array_join("reasons", ",").alias("reasons"),
    )


# ---- streams ------------------------------------------------------------


def _transaction_stream(spark, sf_dir) -> DataFrame:
    schema = standin.table(spark, sf_dir, "events").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    return standin.as_transactions(events, standin.table(spark, sf_dir, "nation"))


EDGES = [datetime(2023, 1, 1), datetime(2024, 1, 11), datetime(2024, 1, 21), datetime(2025, 1, 1)]


def _dealt(raw: DataFrame) -> DataFrame:
    """Rows of a part over enough tasks: one of few row groups, or one day of them, would be few tasks' work."""
    return raw.repartition(2 * raw.sparkSession.sparkContext.defaultParallelism)


def _deliveries(raw: DataFrame) -> list[DataFrame]:
    """The payloads in three parts, each with its time of arrival.

    Every event is sent twice, those of one merchant come in the last part whatever
    their time, and those of another come once more, dated a century ahead.
    """
    time, number = F.col("transaction_timestamp"), F.substring("merchant_name", 2, 10).cast("int")
    part = F.when(number == 7, F.lit(2))
    for n, edge in enumerate(EDGES[1:-1]):
        part = part.when(time < F.lit(edge), F.lit(n))
    ahead = raw.filter(number == 8).withColumn("transaction_timestamp", time + F.expr("INTERVAL 100 YEARS"))
    ahead = ahead.withColumn("transaction_id", F.concat(F.lit("ahead-"), "transaction_id"))
    sent = raw.withColumn("part", part.otherwise(F.lit(2)))

    def arriving(n: int, edge: datetime) -> DataFrame:
        own = F.col("part") == n
        if n < len(EDGES) - 2:
            # Part of `own`, and asked first: rows of other times need not tell their merchant.
            own = (time < F.lit(edge)) & own
        # Each payload is made once and then sent twice.
        once = decode.encode_payload(_dealt(sent.filter(own))).select("value")
        payloads = once.select("value", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).select("value")
        if n == 0:
            payloads = payloads.unionByName(decode.encode_payload(ahead))
        return payloads.select("value", F.lit(edge).cast("timestamp").alias("arrival"))

    return [arriving(n, edge) for n, edge in enumerate(EDGES[1:])]


def _payload_stream(spark, inbox: str) -> DataFrame:
    return spark.readStream.schema("value string, arrival timestamp").parquet(inbox)


def _land_and_compact(spark, raw: DataFrame, after_each: Callable[[str], object] = str, **queues: str) -> str:
    """The raw table after three parts have landed, each compacted as it came."""
    inbox, landed, checkpoint, table = (
        new_folder(spark, name) for name in ("inbox", "landed", "checkpoint", RAW_TABLE.name)
    )
    for part in _deliveries(raw):
        part.write.mode("append").parquet(inbox)
        valid = ingest.valid_transactions(_payload_stream(spark, inbox))
        ingest.land(valid, landed, checkpoint, ONCE).awaitTermination()
        upkeep.compact_landed(spark, landed, table, **queues)
        after_each(table)
    return table


@query
def stream_ingest_dedup(spark, sf_dir):
    """Events that came twice, late, or dated ahead: every valid one is in the raw table, once."""
    return read_raw(spark, _land_and_compact(spark, standin.transactions(spark, sf_dir)))


@query
def late_rows_repaired(spark, sf_dir):
    """The daily features after late rows have landed, most of their history from totals per day."""
    totals = new_folder(spark, DAY_TOTALS.name)
    table = _land_and_compact(spark, standin.transactions(spark, sf_dir), totals=totals)
    return daily.run_features(spark, table, new_folder(spark, "features"), LAST_DAY, CONFIG, totals)


@query
def late_rows_revised(spark, sf_dir):
    """The feature table of all days, revised after each part for the cards and days it changes.

    The first part fills the table; the last one brings rows of every day.
    """
    changes, features_table = new_folder(spark, "changes"), new_folder(spark, FEATURE_TABLE.name)
    _land_and_compact(
        spark,
        standin.transactions(spark, sf_dir),
        lambda table: upkeep.revise(spark, changes, table, features_table, AS_OF_TIME, CONFIG),
        changes=changes,
    )
    return spark.read.parquet(features_table)


@query
def day_totals_kept(spark, sf_dir):
    """Totals per card and day, kept up to date while rows come late."""
    totals = new_folder(spark, DAY_TOTALS.name)
    _land_and_compact(spark, standin.transactions(spark, sf_dir), totals=totals)
    kept = read_day_totals(spark, totals)
    return kept.select("card_id", "date", *(F.col(f"_{name}").alias(name) for name in ("ids", "amounts", "cents", "squares", "top")))


@query
def stream_dead_letters(spark, sf_dir):
    """Rejected events by reason."""
    path = new_folder(spark, "rejected")
    payloads = _damaged_payloads(_transaction_stream(spark, sf_dir)).withColumn(
        "arrival", F.lit(AS_OF_TIME).cast("timestamp")
    )
    ingest.land_rejected(payloads, path, new_folder(spark, "checkpoint"), ONCE).awaitTermination()
    return spark.read.parquet(path).groupBy("reasons").agg(F.count("*").alias("letters"))


@query
def stream_velocity_10min(spark, sf_dir):
    """All windows of the replay, those still open at its end included."""
    path = new_folder(spark, "velocity")
    windows = velocity.velocity_windows(_transaction_stream(spark, sf_dir))
    with stream_state(spark):
        velocity.start_velocity(windows, path, new_folder(spark, "checkpoint"), ONCE).awaitTermination()
    return velocity.read_velocity(spark, path, windows.schema)


@query
def stream_velocity_sealed(spark, sf_dir):
    """Windows of one day, from the table into which the batches were moved, with what came since."""
    inbox, path, checkpoint, table = (new_folder(spark, name) for name in ("inbox", "velocity", "checkpoint", "windows"))
    for n, part in enumerate(_as_they_happen(standin.transactions(spark, sf_dir))):
        part.write.mode("append").parquet(inbox)
        windows = velocity.velocity_windows(ingest.valid_transactions(_payload_stream(spark, inbox)))
        with stream_state(spark):
            velocity.start_velocity(windows, path, checkpoint, ONCE).awaitTermination()
        if n < 2:
            velocity.seal(spark, path, table, windows.schema)
    return velocity.read_velocity(spark, path, windows.schema, table, EDGES[2].date())


def _as_they_happen(raw: DataFrame) -> list[DataFrame]:
    """Payloads in three parts, each two seconds old when it arrives; one in part two is dated ahead."""
    time = F.col("transaction_timestamp")
    parts = []
    for n, (start, end) in enumerate(zip(EDGES, EDGES[1:])):
        part = raw.filter((time >= F.lit(start)) & (time < F.lit(end)))
        arrival = time + F.expr("INTERVAL 2 SECONDS")
        part = part.withColumn(ingest.ARRIVAL, arrival)
        if n == 1:
            ahead = {"transaction_id": F.concat(F.lit("ahead-"), "transaction_id"), "transaction_timestamp": F.lit(datetime(2099, 1, 1)).cast("timestamp")}
            part = part.unionByName(part.filter(F.substring("merchant_name", 2, 10).cast("int") == 8).withColumns(ahead))
        parts.append(decode.encode_payload(_dealt(part)))
    return parts


def _scored_stream(spark, raw: DataFrame, cfg=CONFIG, heavy: DataFrame | None = None) -> str:
    """The folder of alerts after all events have arrived in three parts."""
    inbox, scratch, found, checkpoint = (
        new_folder(spark, name) for name in ("inbox", "staging", "alerts", "checkpoint")
    )
    for part in _as_they_happen(raw):
        part.write.mode("append").parquet(inbox)
        valid = ingest.in_time(ingest.valid_transactions(_payload_stream(spark, inbox)))
        scoring.start_scoring(
            ingest.without_redelivered(valid), scratch, found, checkpoint, F.col("transaction_timestamp"), cfg, ONCE, heavy, on_disk=True
        ).awaitTermination()
    return found


@query
def stream_score_alerts(spark, sf_dir):
    """All events arriving in three parts; each run of the stream scores what is new.

    Some events of part two are dated 2099: they are rejected and change nothing.
    """
    return read_alerts(spark, _scored_stream(spark, standin.transactions(spark, sf_dir))).drop(BATCH)


@query
def stream_score_hot_card(spark, sf_dir):
    """The same where a third of all transactions are one card's, whose memory is spread over slots."""
    raw = _one_hot_card(standin.transactions(spark, sf_dir))
    cfg = replace(CONFIG, heavy_rows=200)
    named = new_folder(spark, "heavy")
    # Stored, as every micro-batch reads the list.
    memory.heavy_cards(raw, HOT_SLOTS, cfg).write.parquet(named)
    heavy = spark.read.parquet(named)
    return read_alerts(spark, _scored_stream(spark, raw, cfg, heavy)).drop(BATCH)


@query
def stream_too_late(spark, sf_dir):
    """Events that arrive later than the scoring stream takes them, by day: left to the daily run."""
    inbox, late, checkpoint = (new_folder(spark, name) for name in ("inbox", "late", "checkpoint"))
    for part in _deliveries(standin.transactions(spark, sf_dir)):
        part.write.mode("append").parquet(inbox)
        valid = ingest.too_late(ingest.valid_transactions(_payload_stream(spark, inbox)))
        ingest.land(valid, late, checkpoint, ONCE).awaitTermination()
    unique = read_raw(spark, late).select("transaction_id", "date").distinct()
    return unique.groupBy("date").agg(F.count("*").alias("late_rows"))


@query
def stream_alerts_compacted(spark, sf_dir):
    """The stream's alerts merged into an alert table that has days of alerts already, some resolved.

    Neither the merge nor a daily run that finds the same alerts again opens one or changes it.
    """
    table = new_folder(spark, ALERT_TABLE.name)
    earlier = _alerts(spark, sf_dir).filter(F.col("transaction_timestamp") < F.lit(EDGES[1]))
    _load_alerts(spark, earlier, table)
    store_resolutions(spark, standin.resolutions(read_alerts(spark, table)), table)
    compact_alerts(spark, _scored_stream(spark, standin.transactions(spark, sf_dir)), table)
    raw, loaded, run_date, _ = _refreshed(spark, sf_dir)
    daily.score_day(spark, raw, loaded, table, run_date, AS_OF_TIME + timedelta(days=400), CONFIG)
    return read_alerts(spark, table)
