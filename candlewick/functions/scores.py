"""Composite scores in [0, 1]. The weights and class values are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.config import Config

# Fixed values.
WEIGHT_MOMENTUM, WEIGHT_TREND, WEIGHT_LEVEL = 0.50, 0.35, 0.15
WEIGHT_CANDLE, WEIGHT_MARKET = 0.60, 0.40
TREND_VALUE = {
    "STRONG_BULL": 1.00,
    "BULL": 0.70,
    "NEUTRAL": 0.50,
    "BEAR": 0.30,
    "STRONG_BEAR": 0.00,
}
LEVEL_VALUE = {"AT_SUPPORT": 0.70, "AT_RESISTANCE": 0.30, "MID_RANGE": 0.50}
MARKET_TREND_VALUE = {"BULLISH": 0.70, "BEARISH": 0.30, "NEUTRAL": 0.50}
NEUTRAL_VALUE = 0.50


def encode(label: Column, values: dict[str, float]) -> Column:
    """Label to number; unknown and NULL labels are neutral."""
    pairs = [F.lit(part) for item in values.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), F.lit(NEUTRAL_VALUE))


def unit_momentum(momentum_pct: Column, cfg: Config) -> Column:
    """Scale ±clamp percent onto [0, 1]. ``least``/``greatest`` skip NULL, hence the guard."""
    scaled = (momentum_pct + cfg.momentum_clamp_pct) / (2.0 * cfg.momentum_clamp_pct)
    return F.when(
        momentum_pct.isNotNull(), F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0))
    )


def recommendation_score(momentum_pct: Column, trend: Column, level: Column, cfg: Config) -> Column:
    """Weighted blend; NULL while the momentum window is not filled yet."""
    blend = (
        unit_momentum(momentum_pct, cfg) * WEIGHT_MOMENTUM
        + encode(trend, TREND_VALUE) * WEIGHT_TREND
        + encode(level, LEVEL_VALUE) * WEIGHT_LEVEL
    )
    return F.round(blend, cfg.score_digits)


def blended_score(candle_score: Column, market_trend: Column, cfg: Config) -> Column:
    """Candle score blended with the market trend; the trend alone where there is no candle score."""
    trend = encode(market_trend, MARKET_TREND_VALUE)
    both = candle_score * WEIGHT_CANDLE + trend * WEIGHT_MARKET
    return F.round(F.coalesce(both, trend), cfg.score_digits)
