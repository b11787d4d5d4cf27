"""Per-entity and per-day features of daily market rows (one row per id and day)."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.functions import labels
from candlewick.functions.numeric import pct_change, pct_of, ratio
from candlewick.operators.indicators import hours_since
from candlewick.operators.quality import flag_changes
from candlewick.operators.ranking import add_ranks
from candlewick.operators.rolling import with_rolling
from candlewick.operators.series import over_series
from candlewick.operators.tenure import days_in_universe, member_months


def price_features(df: DataFrame, cfg: Config) -> DataFrame:
    """Lags, returns, the three-row trend and range, liquidity, rank movement, freshness."""

    def add(frame: DataFrame, w: WindowSpec) -> DataFrame:
        price = F.col("current_price")
        lagged = frame.withColumns(
            {
                "prev_price": F.lag(price).over(w),
                "price_lag_2": F.lag(price, 2).over(w),
                "prev_rank": F.lag("market_cap_rank").over(w),
            }
        )
        frames = {
            "ma_3": ("mean", "current_price", 2),
            "_top": ("max", "current_price", 2),
            "_bottom": ("min", "current_price", 2),
        }
        return with_rolling(lagged, w, frames)

    price = F.col("current_price")
    out = over_series(df, "id", "ingestion_timestamp", 2, cfg.series_chunk_rows, add)
    out = out.withColumns(
        {
            "daily_return_pct": F.when(
                F.col("prev_price") > 0, pct_change(price, F.col("prev_price"))
            ).otherwise(F.col("price_change_pct_24h_capped")),
            "price_3d_change_pct": pct_change(price, F.col("price_lag_2")),
            "trend_strength_ratio": ratio(price, F.col("ma_3")),
            "price_range_volatility": pct_of(F.col("_top") - F.col("_bottom"), F.col("_bottom")),
            "liquidity_strength": F.round(ratio(F.col("total_volume"), F.col("market_cap")), 4),
            "rank_movement": F.col("prev_rank") - F.col("market_cap_rank"),
            "data_freshness_hours": hours_since("ingestion_timestamp", cfg),
        }
    )
    daily, three_days = F.col("daily_return_pct"), F.col("price_3d_change_pct")
    return out.withColumns(
        {
            "price_movement_metric": F.when(
                three_days.isNotNull(), (daily + three_days) / 2
            ).otherwise(daily),
            "short_term_trend_signal": labels.short_term_trend(F.col("trend_strength_ratio")),
            "liquidity_strength_pct": F.round(F.col("liquidity_strength") * 100, 2),
        }
    ).drop("_top", "_bottom")


def rank_by_cap(df: DataFrame, cfg: Config, hot: bool = True) -> DataFrame:
    return add_ranks(
        df, "ingestion_date", {"market_cap_rank_computed": ("market_cap", "desc")}, cfg, hot
    )


def market_features(df: DataFrame, cfg: Config, hot: bool = True) -> DataFrame:
    """All features, the cap rank within the day and change detection, with gaps filled."""
    out = flag_changes(rank_by_cap(price_features(df, cfg), cfg, hot), cfg)
    return out.drop("prev_price").fillna(
        {"price_3d_change_pct": 0.0, "price_range_volatility": 0.0, "rank_movement": 0}
    )


def tenure(universe: DataFrame) -> DataFrame:
    """Days each entity has been an active member."""
    return days_in_universe(member_months(universe))


def with_maturity(facts: DataFrame, universe: DataFrame) -> DataFrame:
    days = F.col("days_in_universe")
    return facts.join(tenure(universe), "id", "left").withColumns(
        {
            "signals_reliable": labels.signals_reliable(days),
            "data_maturity": labels.data_maturity(days),
        }
    )
