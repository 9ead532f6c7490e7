"""Reading raw transactions: JSON files, the raw table, one day, streams."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardvigil.schema import CORRUPT, DAY_TOTALS, DAY_TOTALS_SCHEMA, RAW_SCHEMA, WIRE_SCHEMA
from cardvigil.sources.arrays import elements
from cardvigil.sources.decode import decode_payload, from_wire


def read_json(spark: SparkSession, path: str, one_array_per_file: bool = True) -> DataFrame:
    """Transactions from JSON files, typed by the fixed schema and without an inference pass.

    Each element of an array is a payload of its own: a broken one keeps its text in
    ``_corrupt_record`` and the others are read. Arrays of flat records are read in parallel
    also within a file, however large (:mod:`cardvigil.sources.arrays`).
    """
    if one_array_per_file:
        return decode_payload(elements(spark, path))
    wire = (
        spark.read.schema(WIRE_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    return from_wire(wire)


def read_raw(spark: SparkSession, path: str, date_column: str = "date") -> DataFrame:
    """The raw table: Parquet below ``date=...`` folders, without a footer read for the schema."""
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(date_column, T.DateType())])
    return spark.read.schema(schema).parquet(path)


def read_day_totals(spark: SparkSession, path: str) -> DataFrame:
    """Totals per card and day, by day."""
    day = T.StructField(DAY_TOTALS.date_column, T.DateType())
    return spark.read.schema(T.StructType([*DAY_TOTALS_SCHEMA.fields, day])).parquet(path)


def read_raw_day(
    spark: SparkSession, path: str, run_date: date, lookback_days: int = 0, date_column: str = "date"
) -> DataFrame:
    """One day's partition, and those of the days before it on request."""
    first = run_date - timedelta(days=lookback_days)
    return read_raw(spark, path, date_column).filter(
        F.col(date_column).between(F.lit(first), F.lit(run_date))
    )


def kafka_payloads(
    spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None
) -> DataFrame:
    """A stream of JSON payloads in ``value`` and the time the broker took them in, ``arrival``.

    Needs the Kafka connector on the classpath.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**(options or {}))
        .load()
        .select("value", F.col("timestamp").alias("arrival"))
    )


def text_payloads(spark: SparkSession, path: str, options: dict[str, str] | None = None) -> DataFrame:
    """The same stream from files with one JSON record per line, which arrive when their file is written."""
    lines = spark.readStream.format("text").options(**(options or {})).load(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("arrival"))
