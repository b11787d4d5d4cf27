"""The two fact tables: daily market metrics and candle metrics."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.functions import labels
from candlewick.operators import asof, clean, indicators, market, quality
from candlewick.staging import stage


@dataclass(frozen=True)
class Facts:
    """A fact table and what was kept out of it."""

    clean: DataFrame
    quarantine: DataFrame
    stale: DataFrame


def market_metrics(
    bronze: DataFrame, dim: DataFrame, dates: DataFrame, universe: DataFrame, cfg: Config
) -> Facts:
    fresh, stale = clean.split_fresh_stale(clean.normalise_names(bronze))
    rows = clean.prepare_market(fresh)
    rows = asof.asof_join(rows, asof.require_versions(dim), "id", "ingestion_date")
    rows = asof.with_dates(rows, dates, "ingestion_date")
    # limits, ranks, flags and the rejected rows all start from the looked-up rows: stored once
    rows = stage(market.with_maturity(rows, universe), "market_rows")
    good, bad = quality.split_market(rows, cfg)
    flagged = quality.flag_market_anomalies(clean.fill_market_gaps(good), cfg)
    return Facts(market.market_features(flagged, cfg), bad, stale)


def candle_metrics(
    bronze: DataFrame,
    dim: DataFrame,
    dates: DataFrame,
    hours: DataFrame,
    cfg: Config,
    source: str = "bronze_ohlc_data",
) -> Facts:
    fresh, stale = clean.split_fresh_stale(bronze)
    # the limits come first and every row is held against them
    bounds = stage(quality.candle_limits(fresh, cfg), "candle_limits")
    tagged = quality.tag_candles(fresh, bounds.select("extreme_mult").scalar())
    good, bad = quality.split_candles(tagged, source, cfg)
    if "load_status" in good.columns:
        good = good.withColumn("data_quality_flag", labels.data_quality_flag(F.col("load_status")))
    rows = clean.within_lookback(good, "candle_datetime", cfg)
    # landed timestamps need not lie on the grid, so long histories are cut
    cfg = replace(cfg, series_chunk_rows=cfg.series_chunk_rows or cfg.landed_chunk_rows)
    rows = asof.asof_join(rows, asof.require_versions(dim), "coin_id", "candle_date")
    rows = asof.with_dates(rows, dates, "candle_date")
    rows = asof.with_hours(rows, hours, "candle_datetime")
    featured = indicators.candle_features(rows, cfg)
    out = indicators.flag_candles(featured, bounds.select("p99_body").scalar(), cfg)
    return Facts(out, bad, stale)


def silver_rules() -> list[quality.Rule]:
    """Readiness checks of the candle table."""
    r = quality.Rule
    return [
        r("has_ohlc", present=("open", "high", "low", "close")),
        r("has_daily_range_pct", present=("daily_range_pct",)),
        r("has_momentum_7d", present=("momentum_7d",)),
        r("has_ma_30d", present=("ma_30d",)),
        r("has_trend_strength", present=("trend_strength",)),
        r("has_price_level", present=("price_level_signal",)),
        r("has_support_resist", present=("support_14d", "resistance_14d")),
        r("has_recommendation_score", present=("recommendation_score",)),
        r("score_in_range", failing="recommendation_score < 0 OR recommendation_score > 1"),
        r("has_anomaly_flag", present=("anomaly_flag",)),
        r("has_volatility_30d", present=("volatility_30d",)),
        r("has_data_latency", present=("data_latency_hours",)),
        r("has_date_id", present=("date_id",)),
        r("has_trading_session", present=("trading_session",)),
        r("has_market_segment", present=("market_segment",)),
        r("has_coin_sk", present=("coin_sk",)),
        r("has_data_quality_flag", present=("data_quality_flag",)),
        r("no_trading_signal_col", absent=("trading_signal",)),
        r("no_stale_in_main", failing=f"load_status = '{labels.STALE}'"),
    ]


def validate_candles(table: DataFrame) -> DataFrame:
    rules = silver_rules()
    if "load_status" not in table.columns:
        table = table.withColumn("load_status", F.lit(None).cast("string"))
    return quality.validate(table, rules)
