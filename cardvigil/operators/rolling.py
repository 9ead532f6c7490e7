"""Trailing per-card aggregates over time spans, linear in the number of rows.

A span of ``s`` seconds ending at a row covers every row of the card with an
epoch second in ``[t - s, t]``, the row's own second included in full.

*Counts and sums* are differences of two running totals, one up to ``t`` and
one up to ``t - s - 1``. Spark keeps running totals in one step per row, while
a frame bounded on both sides re-adds its whole content for each row. The
totals are integers, so the difference is exact.

*Maxima* cannot be subtracted. Time is cut into blocks of ``s + 1`` seconds; a
span then touches at most two blocks, and its maximum is the larger of "start
of this block up to t" and "t - s up to the end of the block before". Both are
running maxima, one forwards and one backwards in time.

*Heavy cards.* A window runs each card in one task. Cards too big for that are
first added up per second, with partial sums before the shuffle, which leaves
at most one row per card and second however many transactions there are. Those
rows are cut into slices of 30 days, each with a copy of the slice before as
its history, so that a task meets at most 60 days of seconds. The result is
joined back on card and second, a key Spark can spread and AQE can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardvigil.config import RiskConfig
from cardvigil.functions.exact import cents, squared_cents
from cardvigil.operators.heavy import split_heavy

# The trailing spans in seconds.
SPANS = {
    "10min": 600,
    "1h": 3600,
    "24h": 86400,
    "7d": 604800,
    "30d": 2592000,
}

# Which totals are wanted over which spans.
TOTALS = {
    "ids": ["10min", "1h", "24h"],
    "amounts": ["24h", "7d", "30d"],
    "cents": ["24h", "7d", "30d"],
    "squares": ["30d"],
}
MAX_SPAN = "24h"

SLICE_SECONDS = SPANS["30d"]

PARTS = ["_ids", "_amounts", "_cents", "_squares", "_top"]
IS_NEW = "_is_new"
TRAILING = [f"{total}_{span}" for total, spans in TOTALS.items() for span in spans] + [
    f"top_{MAX_SPAN}"
]


def epoch_second(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def with_parts(df: DataFrame) -> DataFrame:
    """Each transaction as a total of one row, in ``_second`` and the ``PARTS``."""
    amount = F.col("amount")
    parts = {
        "_second": epoch_second(F.col("transaction_timestamp")),
        "_top": cents(amount),
        "_squares": F.coalesce(squared_cents(amount), F.lit(0).cast("decimal(38,0)")),
    }
    return df.withColumns(parts).selectExpr(
        "*",
        "CAST(transaction_id IS NOT NULL AS BIGINT) AS _ids",
        "CAST(_top IS NOT NULL AS BIGINT) AS _amounts",
        "coalesce(_top, 0L) AS _cents",
    )


def per_second(rows: DataFrame) -> DataFrame:
    """Totals of one or more rows added up per card and second."""
    return rows.groupBy("card_id", "_second").agg(
        *[F.sum(part).alias(part) for part in ("_ids", "_amounts", "_cents")],
        F.sum("_squares").cast("decimal(38,0)").alias("_squares"),
        F.max("_top").alias("_top"),
    )


def day_totals(rows: DataFrame, date_column: str) -> DataFrame:
    """Totals per card and day, at the day's first second, with the day."""
    start = F.unix_timestamp(F.col(date_column).cast("timestamp"))
    return (
        per_second(with_parts(rows).withColumn("_second", start))
        .withColumn(date_column, F.to_date(F.timestamp_seconds("_second")))
        .select("card_id", "_second", *PARTS, date_column)
    )


def _trailing_totals(keys: str) -> list[str]:
    over = f"OVER (PARTITION BY {keys} ORDER BY _second RANGE BETWEEN UNBOUNDED PRECEDING AND"
    return [
        # Rows without a time are a group of their own with nothing before it.
        f"sum(_{total}) {over} CURRENT ROW)"
        f" - if(_second IS NULL, 0, coalesce(sum(_{total}) {over} {SPANS[span] + 1} PRECEDING), 0))"
        f" AS {total}_{span}"
        for total, spans in TOTALS.items()
        for span in spans
    ]


def _roll(df: DataFrame, keys: str) -> DataFrame:
    span = SPANS[MAX_SPAN]
    block = f"floor(_second / {span + 1})"
    forward = f"OVER (PARTITION BY {keys} ORDER BY _second RANGE BETWEEN UNBOUNDED PRECEDING AND"
    backward = f"OVER (PARTITION BY {keys} ORDER BY _second DESC RANGE BETWEEN UNBOUNDED PRECEDING AND"
    return (
        # Running maxima of (block, cents): the current block outranks all passed ones.
        df.selectExpr(
            "*",
            f"max(struct(-{block} AS minus_block, _top AS top)) {backward} CURRENT ROW) AS _block_tail",
        )
        # Read backwards, the last row met within the span is its first in time.
        .selectExpr("*", f"last(_block_tail) {backward} {span} FOLLOWING) AS _span_start")
        .selectExpr(
            "*",
            f"max(struct({block} AS block, _top AS top)) {forward} CURRENT ROW) AS _block_head",
            *_trailing_totals(keys),
        )
        .withColumn(
            f"top_{MAX_SPAN}",
            F.expr(
                "greatest(_block_head.top, "
                f"if(_span_start.minus_block = 1 - {block}, _span_start.top, NULL))"
            ),
        )
        .drop("_block_tail", "_span_start", "_block_head")
    )


def _roll_light(rows: DataFrame) -> DataFrame:
    return _roll(rows, "card_id").filter(IS_NEW)


def _roll_heavy(rows: DataFrame) -> DataFrame:
    own = F.floor(F.col("_second") / SLICE_SECONDS)
    slices = F.when(own.isNull(), F.array(own)).otherwise(F.array(own, own + 1))
    sliced = per_second(rows).select("*", F.posexplode(slices).alias("_copy", "_slice"))
    rolled = (
        _roll(sliced, "card_id, _slice")
        .filter(F.col("_copy") == 0)
        .select(F.col("card_id").alias("_card"), F.col("_second").alias("_at"), *TRAILING)
    )
    same = F.col("card_id").eqNullSafe(F.col("_card")) & F.col("_second").eqNullSafe(F.col("_at"))
    return rows.filter(IS_NEW).join(rolled, same, "inner").drop("_card", "_at")


def with_trailing(
    df: DataFrame,
    cfg: RiskConfig,
    history: DataFrame | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """``df`` with the ``TRAILING`` columns, one output row per row of ``df``.

    ``history`` has earlier rows ``per_second``, a number bounded by time for any
    card. They count towards the totals and get none themselves. ``at_most``
    bounds the rows of ``df``, where known: if not even all of them would make
    a heavy card, none is looked for.
    """
    rows = with_parts(df).withColumn(IS_NEW, F.lit(True))
    if history is not None:
        past = history.select("card_id", "_second", *PARTS, F.lit(False).alias(IS_NEW))
        rows = rows.unionByName(past, allowMissingColumns=True)
    if at_most is not None and at_most <= cfg.heavy_rows:
        rolled = _roll_light(rows)
    else:
        light, heavy = split_heavy(rows, "card_id", cfg, counted=df)
        rolled = _roll_light(light).unionByName(_roll_heavy(heavy))
    return rolled.drop("_second", IS_NEW, *PARTS)
