"""Candle indicators. Windows count rows: "7 days" is 42 candles, the current one included."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.functions import labels
from candlewick.functions.numeric import pct_change
from candlewick.functions.scores import recommendation_score
from candlewick.operators.quality import body_pct
from candlewick.operators.rolling import with_rolling
from candlewick.operators.series import over_series

KEY, TIME = "coin_id", "candle_datetime"


def _series(candles: DataFrame, cfg: Config, add, days: int | None = None) -> DataFrame:
    reach = cfg.lag_rows(days or cfg.long_days)
    return over_series(candles, KEY, TIME, reach, cfg.series_chunk_rows, add)


def _spans(cfg: Config) -> tuple[int, ...]:
    return cfg.short_days, cfg.mid_days, cfg.long_days


def candle_shape(candles: DataFrame) -> DataFrame:
    """Direction, body and range of each candle."""
    opened, high, low, closed = (F.col(c) for c in ("open", "high", "low", "close"))
    return candles.withColumns(
        {
            "candle_direction": labels.candle_direction(opened, closed),
            "candle_body_pct": F.round(body_pct(), 3),
            "daily_range_usd": F.round(high - low, 4),
            "daily_range_pct": F.round(F.when(opened > 0, (high - low) / opened * 100), 3),
        }
    )


def _average_frames(cfg: Config) -> dict:
    return {f"ma_{d}d": ("mean", "close", cfg.lag_rows(d)) for d in _spans(cfg)}


def _volatility_frames(cfg: Config) -> dict:
    deviations = {f"volatility_{d}d": ("std", "close", cfg.lag_rows(d)) for d in _spans(cfg)}
    return deviations | {"_usual": ("mean", "daily_range_usd", cfg.lag_rows(cfg.mid_days))}


def _band_frames(cfg: Config) -> dict:
    out = {}
    for days in (cfg.mid_days, cfg.long_days):
        out[f"support_{days}d"] = ("min", "low", cfg.lag_rows(days))
        out[f"resistance_{days}d"] = ("max", "high", cfg.lag_rows(days))
    return out


def _rounded(df: DataFrame, frames: dict, cfg: Config) -> DataFrame:
    return df.withColumns(
        {
            name: F.round(name, cfg.ratio_digits if kind == "std" else cfg.price_digits)
            for name, (kind, *_) in frames.items()
            if name != "_usual"
        }
    )


def _cluster():
    wide = F.col("daily_range_usd") > F.col("_usual") * 1.5
    return F.when(wide, "HIGH").otherwise("NORMAL")


def _with_momentum(df: DataFrame, w: WindowSpec, cfg: Config) -> DataFrame:
    # the one-step momentum looks one candle back, not one day
    steps = {1: 1, cfg.short_days: cfg.lag_rows(cfg.short_days), cfg.mid_days: cfg.lag_rows(cfg.mid_days)}
    before = {f"_close_{d}": F.lag("close", rows).over(w) for d, rows in steps.items()}
    return (
        df.withColumns(before)
        .withColumns(
            {
                f"momentum_{d}d": F.round(pct_change(F.col("close"), F.col(f"_close_{d}")), 2)
                for d in steps
            }
        )
        .drop(*before)
    )


def moving_averages(candles: DataFrame, cfg: Config) -> DataFrame:
    frames = _average_frames(cfg)
    out = _series(candles, cfg, lambda df, w: with_rolling(df, w, frames))
    return _rounded(out, frames, cfg)


def volatility(shaped: DataFrame, cfg: Config) -> DataFrame:
    frames = _volatility_frames(cfg)
    out = _series(shaped, cfg, lambda df, w: with_rolling(df, w, frames))
    return _rounded(out.withColumn("volatility_cluster", _cluster()), frames, cfg).drop("_usual")


def momentum(candles: DataFrame, cfg: Config) -> DataFrame:
    return _series(candles, cfg, lambda df, w: _with_momentum(df, w, cfg), cfg.mid_days)


def support_resistance(candles: DataFrame, cfg: Config) -> DataFrame:
    frames = _band_frames(cfg)
    out = _series(candles, cfg, lambda df, w: with_rolling(df, w, frames))
    return _rounded(out, frames, cfg).withColumn("price_level_signal", _level(cfg))


def _level(cfg: Config):
    days = cfg.mid_days
    return labels.price_level(
        F.col("close"), F.col(f"support_{days}d"), F.col(f"resistance_{days}d")
    )


def candle_features(candles: DataFrame, cfg: Config) -> DataFrame:
    """Every indicator in one pass: one shuffle by coin and one sort serve all windows."""

    frames = _average_frames(cfg) | _volatility_frames(cfg) | _band_frames(cfg)

    def add(df: DataFrame, w: WindowSpec) -> DataFrame:
        return with_rolling(_with_momentum(df, w, cfg), w, frames)

    long_average = F.col(f"ma_{cfg.long_days}d")
    featured = _series(candle_shape(candles), cfg, add).withColumn("volatility_cluster", _cluster())
    return (
        _rounded(featured, frames, cfg)
        .drop("_usual")
        .withColumns(
            {
                "trend_strength": labels.trend_strength(F.col("close"), long_average),
                "price_level_signal": _level(cfg),
            }
        )
        .withColumn(
            "recommendation_score",
            recommendation_score(
                F.col(f"momentum_{cfg.short_days}d"),
                F.col("trend_strength"),
                F.col("price_level_signal"),
                cfg,
            ),
        )
    )


def flag_candles(shaped: DataFrame, body_limit, cfg: Config) -> DataFrame:
    """Anomaly flag from the body limit, and hours since ingestion."""
    out = shaped.withColumn(
        "anomaly_flag", F.when(F.col("candle_body_pct") > body_limit, "HIGH_BODY_PCT")
    )
    if "ingestion_timestamp" in out.columns:
        out = out.withColumn("data_latency_hours", hours_since("ingestion_timestamp", cfg))
    return out


def hours_since(column: str, cfg: Config):
    seconds = F.unix_timestamp(F.lit(cfg.run_ts)) - F.unix_timestamp(column)
    return F.round(seconds / 3600, 2)


def bollinger(candles: DataFrame, cfg: Config, days: int | None = None, width: float = 2.0):
    """Middle band and ``width`` deviations around it."""
    days = days or cfg.short_days

    rows = cfg.lag_rows(days)
    frames = {"_mid": ("mean", "close", rows), "_dev": ("std", "close", rows)}

    def add(df: DataFrame, w: WindowSpec) -> DataFrame:
        middle, reach = F.col("_mid"), F.col("_dev") * width
        return (
            with_rolling(df, w, frames)
            .withColumns(
                {
                    "bb_middle": F.round(middle, cfg.price_digits),
                    "bb_upper": F.round(middle + reach, cfg.price_digits),
                    "bb_lower": F.round(middle - reach, cfg.price_digits),
                }
            )
            .drop("_mid", "_dev")
        )

    return _series(candles, cfg, add, days)


def average_true_range(candles: DataFrame, cfg: Config, rows: int = 14) -> DataFrame:
    """Rolling mean of the true range (simple average)."""

    def add(df: DataFrame, w: WindowSpec) -> DataFrame:
        high, low, before = F.col("high"), F.col("low"), F.lag("close").over(w)
        spread = F.greatest(high - low, F.abs(high - before), F.abs(low - before))
        ranged = df.withColumn("true_range", F.round(spread, cfg.price_digits))
        mean = {"atr": ("mean", "true_range", rows - 1)}
        return with_rolling(ranged, w, mean).withColumn(
            "atr", F.round("atr", cfg.price_digits)
        )

    # the first row of an averaged window needs its own predecessor too
    return over_series(candles, KEY, TIME, rows, cfg.series_chunk_rows, add)


def relative_strength(candles: DataFrame, cfg: Config, rows: int = 14) -> DataFrame:
    """RSI from simple rolling means; 100 without losses, NULL without any move."""

    def add(df: DataFrame, w: WindowSpec) -> DataFrame:
        move = F.round(F.col("close") - F.lag("close").over(w), 8)
        moved = df.withColumn("_move", move).withColumns(
            {
                "_up": F.greatest(F.col("_move"), F.lit(0.0)),
                "_down": F.greatest(-F.col("_move"), F.lit(0.0)),
            }
        )
        means = {"_gain": ("mean", "_up", rows - 1), "_loss": ("mean", "_down", rows - 1)}
        gain, loss = F.col("_gain"), F.col("_loss")
        return (
            with_rolling(moved, w, means)
            .withColumn(
                "rsi",
                F.round(F.when(gain + loss > 0, gain * 100 / (gain + loss)), cfg.pct_digits),
            )
            .drop("_move", "_up", "_down", "_gain", "_loss")
        )

    return over_series(candles, KEY, TIME, rows, cfg.series_chunk_rows, add)
