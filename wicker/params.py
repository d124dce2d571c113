"""Parameters of the operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    """Fixed values of the price-basket method; every operator takes what it needs."""

    version: str = "v1"
    outlier_factor: float = 10.0
    outlier_mad: float = 5.0
    outlier_mad_factor: float = 3.0
    outlier_min_rows: int = 30
    previous_weeks: int = 1
    index_base_weeks: int = 8
    recent_weeks: int = 8
    publish_weeks: int = 52
    cost_tolerance: float = 0.011
    #: A side of a join is broadcast only with at most this many rows.
    broadcast_rows: int = 200_000
