"""Thresholds and sizing knobs, passed explicitly to every operator."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RiskConfig:
    # The business thresholds results must agree with.
    home_country: str = "IN"
    high_amount: float = 50000
    velocity_per_min: float = 3
    zscore: float = 3.0
    night_from_hour: int = 0
    night_to_hour: int = 5
    alert_score: float = 0.6
    medium_score: float = 0.70
    high_score: float = 0.85
    min_fraud_rate: float = 0.01
    max_fraud_rate: float = 0.05
    retention_days: int = 730

    # Sizing. These change how work is split, never a result.
    #
    # A card with more than `heavy_rows` rows is rolled up per second before any
    # window sees it (see operators/rolling.py). Cards are counted in
    # `card_buckets` hash buckets first, and by themselves in full buckets only.
    card_buckets: int = 65_536
    heavy_rows: int = 2_000_000
    # A scoring stream keeps its cards in so many groups (see streaming/memory.py). More
    # cards in a group make large micro-batches cheaper and small ones dearer; about 20 do
    # well. The number holds for the life of a checkpoint.
    memory_groups: int = 4_096
