"""Finding cards that hold too much of the data for one task.

Counting every card would shuffle as many rows as there are cards. Cards are
counted in a fixed number of hash buckets first: each map task sends at most one
small row per bucket. Only the cards of buckets over the bound are then counted
themselves. A card over the bound has more than ``heavy_rows`` rows, so there are
at most rows / ``heavy_rows`` of them, and the list is safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardvigil.config import RiskConfig


def bucket_of(key: str, cfg: RiskConfig) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(cfg.card_buckets))


def heavy_keys(df: DataFrame, key: str, cfg: RiskConfig) -> DataFrame:
    """The keys, NULL included, with more than ``cfg.heavy_rows`` rows."""
    buckets = df.groupBy(bucket_of(key, cfg).alias("_bucket")).agg(F.count("*").alias("rows"))
    full = F.broadcast(buckets.filter(F.col("rows") > cfg.heavy_rows).select("_bucket"))
    inside = df.select(key).join(full, bucket_of(key, cfg) == F.col("_bucket"), "left_semi")
    counts = inside.groupBy(F.col(key).alias("heavy_key")).agg(F.count("*").alias("rows"))
    return counts.filter(F.col("rows") > cfg.heavy_rows).select("heavy_key")


def split_heavy(
    df: DataFrame, key: str, cfg: RiskConfig, counted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``df`` in two parts by card: (light, heavy), by the counts in ``counted`` if given."""
    heavy = F.broadcast(heavy_keys(df if counted is None else counted, key, cfg))
    on = F.col(key).eqNullSafe(F.col("heavy_key"))
    return df.join(heavy, on, "left_anti"), df.join(heavy, on, "left_semi")
