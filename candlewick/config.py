"""Run parameters shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone


@dataclass(frozen=True)
class Config:
    """One immutable bag of thresholds; pass a changed copy with ``dataclasses.replace``."""

    run_ts: datetime
    run_id: str = "manual"

    # Load grading.
    expected_entities: int = 20
    warn_ratio: float = 0.80
    critical_ratio: float = 0.50
    abort_ratio: float = 0.10

    # Candle grid and indicator windows (days).
    candle_hours: int = 4
    lookback_days: int = 30
    short_days: int = 7
    mid_days: int = 14
    long_days: int = 30
    momentum_clamp_pct: float = 50.0

    # Rounding digits of published columns.
    price_digits: int = 4
    pct_digits: int = 3
    ratio_digits: int = 6
    score_digits: int = 4

    reference_id: str = "bitcoin"

    # Sums of whole groups (rolling windows need no setting): None adds doubles; a number of decimals
    # adds exact decimals instead, so that results do not depend on how rows were partitioned.
    exact_scale: int | None = None

    # Quantiles are exact at any size, in three passes. False: one sketch pass everywhere, with a
    # rank error of rows / accuracy.
    exact_quantiles: bool = True
    quantile_accuracy: int = 10_000

    # Histories longer than this many rows per key are cut into overlapping chunks. None: the
    # series is known to be bounded by its calendar grid and is not cut.
    series_chunk_rows: int | None = None
    # The same for landed candles, whose timestamps need not lie on the grid.
    landed_chunk_rows: int = 1_000_000

    @property
    def candles_per_day(self) -> int:
        return 24 // self.candle_hours

    def lag_rows(self, days: int) -> int:
        """Rows before the current one that complete a window of so many days."""
        return self.candles_per_day * days - 1

    @property
    def run_date(self) -> date:
        return self.run_ts.date()


def default_config(**changes) -> Config:
    """Config stamped with the current UTC time unless ``run_ts`` is given."""
    changes.setdefault("run_ts", datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0))
    return Config(**changes)
