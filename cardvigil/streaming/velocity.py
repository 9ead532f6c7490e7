"""Per-card velocity on a stream."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cardvigil.functions.risk import per_minute
from cardvigil.schema import TableContract
from cardvigil.session import staging
from cardvigil.sources.batches import days_touched, finished, forget, read_batches, write_batch
from cardvigil.sources.decode import FUTURE_SECONDS
from cardvigil.sources.tables import days_of, on_days, with_partition_date, write_dated

# Fixed value: the velocity span. The step is the grid it is approximated on.
SPAN = "10 minutes"
STEP = "5 minutes"
#: Beyond how far a valid event may be ahead of its arrival, so that the watermark stays behind arrivals.
DELAY = f"{FUTURE_SECONDS + 600} seconds"


def velocity_windows(transactions: DataFrame, delay: str = DELAY) -> DataFrame:
    """Transactions per card in sliding windows; state is one counter per card and window.

    In update mode a window comes out whenever its count has grown, the still open ones too.
    """
    return (
        transactions.withWatermark("transaction_timestamp", delay)
        .groupBy(F.window("transaction_timestamp", SPAN, STEP), "card_id")
        .agg(F.count("transaction_id").alias("txn_count_10min"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "card_id",
            "txn_count_10min",
            per_minute(F.col("txn_count_10min")).alias("txn_per_minute"),
        )
    )


KEYS = ["window_start", "window_end", "card_id"]
DAY = "window_date"
VELOCITY_TABLE = TableContract(
    name="velocity_windows", date_column=DAY, time_column="window_start", cluster_by=("card_id",), not_null=tuple(KEYS)
)


def start_velocity(
    windows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Writes what each micro-batch has changed to its folder in a zone of batches, by day."""

    def keep(batch: DataFrame, number: int) -> None:
        write_batch(with_partition_date(batch, VELOCITY_TABLE), path, number, DAY)

    writer = windows.writeStream.outputMode("update").foreachBatch(keep)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).start()


def _newest(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Every window once, as it was last written: counts only grow."""
    last = [F.max(c).alias(c) for c in schema.names if c not in KEYS]
    return rows.groupBy(DAY, *KEYS).agg(*last).select(*schema.names, DAY)


def _sealed(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])).parquet(table)


def seal(spark: SparkSession, path: str, table: str, schema: T.StructType) -> list[date]:
    """Moves the complete batches into the table of windows; returns the days it has rewritten.

    A window's day is replaced by what the table and the batches say of it together, so windows
    that are still open are there too and grow with the next call. Batches are removed
    afterwards: the zone holds those since the last call only.
    """
    taken = finished(spark, path)
    days = days_touched(spark, path, taken, DAY)
    if days:
        rows = read_batches(spark, path, taken, schema, DAY)
        if known := sorted(set(days) & set(days_of(spark, table, DAY))):
            rows = rows.unionByName(on_days(_sealed(spark, table, schema), known, DAY))
        with staging(spark, VELOCITY_TABLE.name) as made:
            _newest(rows, schema).write.parquet(made)
            write_dated(spark.read.schema(rows.schema).parquet(made), table, VELOCITY_TABLE)
    forget(spark, path, taken)
    return days


def read_velocity(
    spark: SparkSession, path: str, schema: T.StructType, table: str | None = None, day: date | None = None
) -> DataFrame:
    """Every window once, of the table and of the batches since it was sealed; of one day if given."""
    rows = read_batches(spark, path, finished(spark, path), schema, DAY)
    if table and days_of(spark, table, DAY):
        rows = rows.unionByName(_sealed(spark, table, schema))
    if day:
        rows = rows.filter(F.col(DAY) == F.lit(day))
    return _newest(rows, schema).select(*schema.names)
