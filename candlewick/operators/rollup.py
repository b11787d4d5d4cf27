"""Candles from ticks, and days from candles, each in one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.functions import labels
from candlewick.functions.numeric import mean_of, pct_of, ratio

# Indicator columns a day takes over from its last candle.
CLOSING_SIGNALS = (
    "ma_7d", "ma_14d", "ma_30d", "volatility_7d", "volatility_14d", "volatility_30d",
    "volatility_cluster", "momentum_7d", "trend_strength", "price_level_signal",
    "support_14d", "resistance_14d", "support_30d", "resistance_30d",
)


def candles_from_ticks(
    ticks: DataFrame, key: str, ts: str, price: str, cfg: Config
) -> DataFrame:
    """Ticks to candles on the calendar grid. Only mergeable aggregates on primitive columns, so
    each input task sends one row per candle."""
    slot = F.window(ts, f"{cfg.candle_hours} hours")["start"]
    return (
        ticks.groupBy(F.col(key).alias("coin_id"), slot.alias("candle_datetime"))
        .agg(
            F.min_by(price, ts).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, ts).alias("close"),
            F.count("*").alias("ticks"),
        )
        .withColumns(
            {
                "candle_date": F.to_date("candle_datetime"),
                "timestamp_ms": F.unix_timestamp("candle_datetime") * 1000,
            }
        )
    )


def daily_candles(candles: DataFrame) -> DataFrame:
    """Open of the first, close of the last candle, extremes and counts per (coin, day)."""
    return candles.groupBy("coin_id", "candle_date").agg(
        F.min_by("open", "candle_datetime").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "candle_datetime").alias("close"),
        *_counts(),
    )


def _counts():
    direction = labels.candle_direction(F.col("open"), F.col("close"))
    return [
        F.count("*").alias("candle_count"),
        F.count_if(direction == "BULL").alias("bull_candles"),
        F.count_if(direction == "BEAR").alias("bear_candles"),
    ]


def with_day_shape(days: DataFrame) -> DataFrame:
    opened, closed = F.col("open"), F.col("close")
    return days.withColumns(
        {
            "daily_candle_direction": labels.candle_direction(opened, closed),
            "daily_body_pct": pct_of(F.abs(closed - opened), opened),
            "daily_range_pct": pct_of(F.col("high") - F.col("low"), opened),
            "bull_bear_ratio": ratio(F.col("bull_candles"), F.col("bear_candles")),
        }
    )


def daily_scores(candles: DataFrame, cfg: Config) -> DataFrame:
    """Score distribution per (coin, day)."""
    return candles.groupBy("coin_id", "candle_date").agg(*_scores(cfg))


def _scores(cfg: Config):
    score, digits = F.col("recommendation_score"), cfg.score_digits

    def share(p: float):
        return F.round(F.percentile_approx(score, F.lit(p), F.lit(cfg.quantile_accuracy)), digits)

    return [
        F.round(mean_of(score, cfg), digits).alias("avg_recommendation_score"),
        share(0.25).alias("p25_recommendation_score"),
        share(0.75).alias("p75_recommendation_score"),
    ]


def daily_history(candles: DataFrame, cfg: Config) -> DataFrame:
    """Daily roll-up of featured candles: prices, counts, closing signals and scores together."""
    closing = F.max_by(
        F.struct("close", *CLOSING_SIGNALS, "recommendation_score"), "candle_datetime"
    )
    days = candles.groupBy("coin_id", "candle_date").agg(
        F.min_by("open", "candle_datetime").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        closing.alias("_last"),
        mean_of(F.col("daily_range_pct"), cfg).alias("avg_range_pct"),
        *_counts(),
        F.count("anomaly_flag").alias("anomaly_candle_count"),
        *_scores(cfg),
    )
    return with_day_shape(
        days.select(
            "*",
            F.col("_last.close").alias("close"),
            *[F.col(f"_last.{c}").alias(c) for c in CLOSING_SIGNALS],
            F.col("_last.recommendation_score").alias("close_recommendation_score"),
        ).drop("_last")
    )
