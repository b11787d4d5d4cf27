"""Published tables: snapshot, daily history, performance, summary, trending."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.functions import labels
from candlewick.functions.numeric import mean_of, pct_change, round_by_category
from candlewick.functions.scores import blended_score
from candlewick.operators.pick import latest_per_key
from candlewick.operators.quality import Rule, validate
from candlewick.operators.quantiles import quantiles, sketched
from candlewick.operators.ranking import add_ranks
from candlewick.operators.rollup import daily_history
from candlewick.operators.series import streaks

# Column order and rounding classes of the published tables.
LATEST_CANDLE = (
    "candle_direction", "ma_7d", "ma_14d", "ma_30d", "volatility_7d", "volatility_14d",
    "volatility_30d", "volatility_cluster", "momentum_7d", "trend_strength",
    "price_level_signal", "recommendation_score", "support_14d", "resistance_14d",
    "support_30d", "resistance_30d",
)
SNAPSHOT_COLUMNS = (
    "id", "symbol", "name", "market_cap_rank", "market_segment",
    "current_price", "high_24h", "low_24h", "price_change_24h",
    "price_change_percentage_24h", "price_change_pct_24h_capped",
    "market_cap", "fully_diluted_valuation", "total_volume",
    "circulating_supply", "total_supply", "max_supply",
    "price_movement_metric", "daily_return_pct", "price_3d_change_pct",
    "short_term_trend_signal", "price_range_volatility", "liquidity_strength",
    "rank_movement", "ma_3",
    "ath", "ath_change_percentage", "ath_drawdown_pct", "atl", "atl_change_percentage",
    "ohlc_open", "ohlc_close", "candle_direction", "latest_candle_date",
    "ma_7d", "ma_14d", "ma_30d", "price_vs_ma30_pct",
    "volatility_7d", "volatility_14d", "volatility_30d", "volatility_cluster",
    "momentum_7d", "support_14d", "resistance_14d", "trend_strength", "price_level_signal",
    "recommendation_score", "gold_recommendation_score", "performance_label",
    "anomaly_flag", "anomaly_reason",
    "data_freshness_hours", "ingestion_date", "snapshot_date", "gold_updated_at",
)
HISTORY_COLUMNS = (
    "coin_id", "candle_date", "open", "high", "low", "close",
    "daily_candle_direction", "daily_body_pct", "daily_range_pct", "avg_range_pct",
    "candle_count", "bull_candles", "bear_candles", "bull_bear_ratio", "anomaly_candle_count",
    "ma_7d", "ma_14d", "ma_30d", "volatility_7d", "volatility_14d", "volatility_30d",
    "volatility_cluster", "momentum_7d",
    "support_14d", "resistance_14d", "support_30d", "resistance_30d",
    "price_level_signal", "trend_strength",
    "avg_recommendation_score", "p25_recommendation_score", "p75_recommendation_score",
    "close_recommendation_score", "gold_updated_at",
)
PERFORMANCE_COLUMNS = (
    "id", "symbol", "name", "ingestion_date", "market_cap_rank", "market_segment",
    "current_price", "market_cap", "total_volume",
    "price_change_24h", "price_change_percentage_24h", "price_change_pct_24h_capped",
    "price_movement_metric", "daily_return_pct", "price_3d_change_pct",
    "short_term_trend_signal", "price_range_volatility", "liquidity_strength", "rank_movement",
    "gainer_rank", "loser_rank", "volume_rank", "performance_percentile", "performance_label",
    "streak_days", "streak_direction", "avg_recommendation_score",
    "anomaly_flag", "gold_updated_at",
)
SUMMARY_COLUMNS = (
    "ingestion_date", "total_market_cap", "total_volume", "total_coins",
    "gainers_count", "losers_count", "stable_count",
    "avg_price_change_pct", "median_price_change_pct", "max_gain_pct", "max_loss_pct",
    "avg_liquidity_strength", "avg_price_range_volatility", "anomaly_coins_count",
    "btc_dominance_pct", "market_sentiment", "avg_recommendation_score", "pct_high_signal",
    "top_gainer_coin", "top_gainer_name", "top_gainer_pct",
    "top_loser_coin", "top_loser_name", "top_loser_pct",
    "highest_volume_coin", "highest_volume_usd", "most_liquid_coin", "top_liquidity_ratio",
    "gold_updated_at",
)
TRENDING_COLUMNS = (
    "trending_rank", "coin_id", "name", "symbol", "market_cap_rank", "current_price",
    "market_cap", "total_volume", "price_change_percentage_24h", "performance_label",
    "trading_signal", "ingestion_date", "gold_updated_at",
)
SNAPSHOT_PRICES = (
    "current_price", "high_24h", "low_24h", "price_change_24h", "ath", "atl",
    "ohlc_open", "ohlc_close", "ma_7d", "ma_14d", "ma_30d", "ma_3",
    "support_14d", "resistance_14d", "support_30d", "resistance_30d",
)
HISTORY_PRICES = (
    "open", "high", "low", "close", "ma_7d", "ma_14d", "ma_30d",
    "support_14d", "resistance_14d", "support_30d", "resistance_30d",
)
VOLATILITY_RATIOS = ("volatility_7d", "volatility_14d", "volatility_30d")


def market_snapshot(market: DataFrame, candles: DataFrame, cfg: Config) -> DataFrame:
    """Latest state per entity with its latest candle's signals."""
    latest = latest_per_key(market, ["id"], ["ingestion_date"])
    candle = latest_per_key(candles, ["coin_id"], ["candle_datetime"]).select(
        F.col("coin_id").alias("_coin"),
        F.col("open").alias("ohlc_open"),
        F.col("close").alias("ohlc_close"),
        F.col("candle_date").alias("latest_candle_date"),
        *LATEST_CANDLE,
    )
    joined = latest.drop(*LATEST_CANDLE).join(candle, F.col("id") == F.col("_coin"), "left")
    price = F.col("current_price")
    out = joined.withColumns(
        {
            "ath_drawdown_pct": pct_change(price, F.col("ath")),
            "price_vs_ma30_pct": pct_change(price, F.col("ma_30d")),
            "performance_label": labels.performance_label(F.col("price_change_percentage_24h")),
            "gold_recommendation_score": blended_score(
                F.col("recommendation_score"), F.col("short_term_trend_signal"), cfg
            ),
            "snapshot_date": F.lit(cfg.run_date),
            "gold_updated_at": F.lit(cfg.run_ts),
        }
    )
    # scores and everything not listed are rounded to the pct digits
    return round_by_category(
        out.select(*SNAPSHOT_COLUMNS),
        cfg,
        price=SNAPSHOT_PRICES,
        ratios=("liquidity_strength", *VOLATILITY_RATIOS),
    )


def ohlc_history(candles: DataFrame, cfg: Config) -> DataFrame:
    """Daily candles with closing signals and score distribution."""
    days = daily_history(candles, cfg).withColumn("gold_updated_at", F.lit(cfg.run_ts))
    return round_by_category(
        days.select(*HISTORY_COLUMNS), cfg, price=HISTORY_PRICES, ratios=VOLATILITY_RATIOS
    )


def daily_entity_scores(candles: DataFrame, cfg: Config) -> DataFrame:
    """Average score per entity and ingestion date."""
    return candles.groupBy(F.col("coin_id").alias("id"), "ingestion_date").agg(
        F.round(mean_of(F.col("recommendation_score"), cfg), cfg.score_digits).alias(
            "avg_recommendation_score"
        )
    )


def performance_metrics(
    market: DataFrame, candles: DataFrame, cfg: Config, hot: bool = True
) -> DataFrame:
    """Leaderboard ranks, percentile, label and streak per entity and day."""
    change = "price_change_percentage_24h"
    ranked = add_ranks(
        market,
        "ingestion_date",
        {
            "gainer_rank": (change, "desc"),
            "loser_rank": (change, "asc"),
            "_share": (change, "percent"),
            "volume_rank": ("total_volume", "desc"),
        },
        cfg,
        hot,
    )
    gaining = F.coalesce(F.col("daily_return_pct") > 0, F.lit(False))
    run = streaks(ranked.withColumn("_gaining", gaining), "id", "ingestion_date", "_gaining")
    out = run.withColumns(
        {
            "performance_percentile": F.round(F.col("_share") * 100, 1),
            "performance_label": labels.performance_label(F.col(change)),
            "streak_direction": F.when(F.col("_gaining"), "GAINING").otherwise("LOSING"),
            "gold_updated_at": F.lit(cfg.run_ts),
        }
    ).join(daily_entity_scores(candles, cfg), ["id", "ingestion_date"], "left")
    return round_by_category(
        out.select(*PERFORMANCE_COLUMNS),
        cfg,
        price=("current_price", "price_change_24h"),
        ratios=("liquidity_strength",),
    )


def market_leaders(market: DataFrame, cfg: Config) -> DataFrame:
    """Top gainer, loser, volume and liquidity per date in one aggregation; ties go to the
    smallest id, dates without any value have no leader."""
    return market.groupBy("ingestion_date").agg(*_leader_aggregates(cfg)).select(
        "ingestion_date", *_leader_columns(cfg)
    )


def _leader_aggregates(cfg: Config):
    """The highest value with the smallest id: a minimum over (negated value, id)."""
    change, volume, liquid = (
        F.col(c) for c in ("price_change_percentage_24h", "total_volume", "liquidity_strength")
    )

    def top(value, name: str, *extra: str):
        entry = F.struct((-value).alias("k"), "id", value.alias("v"), *extra)
        return F.min(F.when(value.isNotNull(), entry)).alias(name)

    lowest = F.struct(change.alias("k"), "id", change.alias("v"), "name")
    return [
        top(change, "_gain", "name"),
        F.min(F.when(change.isNotNull(), lowest)).alias("_loss"),
        top(volume, "_vol"),
        top(liquid, "_liq"),
    ]


def _leader_columns(cfg: Config):
    return [
        F.col("_gain.id").alias("top_gainer_coin"),
        F.col("_gain.name").alias("top_gainer_name"),
        F.round("_gain.v", cfg.pct_digits).alias("top_gainer_pct"),
        F.col("_loss.id").alias("top_loser_coin"),
        F.col("_loss.name").alias("top_loser_name"),
        F.round("_loss.v", cfg.pct_digits).alias("top_loser_pct"),
        F.col("_vol.id").alias("highest_volume_coin"),
        F.round("_vol.v", 0).alias("highest_volume_usd"),
        F.col("_liq.id").alias("most_liquid_coin"),
        F.round("_liq.v", cfg.ratio_digits).alias("top_liquidity_ratio"),
    ]


def score_levels(candles: DataFrame, cfg: Config) -> DataFrame:
    """Per ingestion date: average score, its p75, and the share of coins whose own average lies
    above that p75. Coins without a score stay in the denominator."""
    day, digits = "ingestion_date", cfg.score_digits
    score = F.col("recommendation_score")
    means = _with_quantile(
        candles,
        day,
        [F.round(mean_of(score, cfg), digits).alias("avg_recommendation_score")],
        ("_p75", score, 0.75),
        cfg,
    ).withColumn("p75_score", F.round("_p75", digits))
    coins = candles.groupBy(day, "coin_id").agg(mean_of(score, cfg).alias("_own"))
    share = (
        coins.join(means.select(day, "p75_score"), day, "left")
        .groupBy(day)
        .agg(
            F.round(
                F.count_if(F.col("_own") > F.col("p75_score")) / F.count("*") * 100,
                cfg.pct_digits,
            ).alias("pct_high_signal")
        )
    )
    return means.drop("_p75").join(share, day)


def _with_quantile(df: DataFrame, day: str, aggregates: list, wanted: tuple, cfg: Config):
    """Aggregates and one quantile per day: in the same pass where a sketch will do."""
    name, value, p = wanted
    if not cfg.exact_quantiles:
        return df.groupBy(day).agg(*aggregates, sketched(value, p, cfg).alias(name))
    exact = quantiles(df, {name: (value, p)}, cfg, by=(day,))
    return df.groupBy(day).agg(*aggregates).join(exact, day, "left")


def market_summary(market: DataFrame, candles: DataFrame, cfg: Config) -> DataFrame:
    """Market-wide figures per date: totals, leaders, dominance and median in one aggregation;
    the score levels join by date."""
    day, change = "ingestion_date", F.col("price_change_percentage_24h")
    own_cap = F.when(F.col("id") == cfg.reference_id, F.col("market_cap"))
    aggregates = [
        F.round(_total("market_cap", cfg), 0).alias("total_market_cap"),
        F.max(own_cap).alias("_own_cap"),
        F.round(_total("total_volume", cfg), 0).alias("total_volume"),
        F.round(mean_of(change, cfg), cfg.pct_digits).alias("avg_price_change_pct"),
        F.count_if(change > 0).alias("gainers_count"),
        F.count_if(change < 0).alias("losers_count"),
        F.count_if(change == 0).alias("stable_count"),
        F.round(F.max(change), cfg.pct_digits).alias("max_gain_pct"),
        F.round(F.min(change), cfg.pct_digits).alias("max_loss_pct"),
        F.round(mean_of(F.col("liquidity_strength"), cfg), cfg.ratio_digits).alias(
            "avg_liquidity_strength"
        ),
        F.round(mean_of(F.col("price_range_volatility"), cfg), cfg.pct_digits).alias(
            "avg_price_range_volatility"
        ),
        F.count_if("anomaly_flag").alias("anomaly_coins_count"),
        F.count("id").alias("total_coins"),
        *_leader_aggregates(cfg),
    ]
    return (
        _with_quantile(market, day, aggregates, ("_median", change, 0.5), cfg)
        .join(score_levels(candles, cfg), day, "left")
        .withColumns(
            {
                "median_price_change_pct": F.round("_median", cfg.pct_digits),
                "btc_dominance_pct": F.when(
                    F.col("total_market_cap") > 0,
                    F.round(F.col("_own_cap") / F.col("total_market_cap") * 100, cfg.pct_digits),
                ),
                "market_sentiment": labels.market_sentiment(
                    F.col("gainers_count"), F.col("losers_count")
                ),
                "gold_updated_at": F.lit(cfg.run_ts),
            }
        )
        .select("*", *_leader_columns(cfg))
        .select(*SUMMARY_COLUMNS)
    )


def _total(column: str, cfg: Config):
    if cfg.exact_scale is None:
        return F.sum(column)
    return F.sum(F.col(column).cast(f"decimal(28,{cfg.exact_scale})")).cast("double")


def trending_enriched(trending: DataFrame, snapshot: DataFrame, cfg: Config) -> DataFrame:
    """Trending entities with snapshot prices; label and signal stay open (typed NULLs)."""
    prices = snapshot.select(
        F.col("id").alias("_id"),
        "current_price",
        "market_cap",
        "total_volume",
        "price_change_percentage_24h",
    )
    return (
        trending.join(prices, F.col("coin_id") == F.col("_id"), "left")
        .withColumns(
            {
                "trending_rank": F.col("trending_rank").cast("int"),
                "market_cap_rank": F.col("market_cap_rank").cast("int"),
                "performance_label": F.lit(None).cast("string"),
                "trading_signal": F.lit(None).cast("string"),
                "gold_updated_at": F.lit(cfg.run_ts),
            }
        )
        .select(*TRENDING_COLUMNS)
    )


def gold_rules() -> dict[str, list[Rule]]:
    """The thirteen checks, by published table."""
    return {
        "snapshot": [
            Rule(
                "snapshot_required_cols",
                present=(
                    "id", "name", "current_price", "market_cap", "total_volume",
                    "market_cap_rank", "market_segment", "performance_label",
                    "trend_strength", "ma_7d", "ma_14d", "ma_30d", "momentum_7d",
                    "support_14d", "resistance_14d", "recommendation_score",
                    "gold_recommendation_score",
                ),
            ),
            Rule("snapshot_unique_coin", unique=("id",)),
            Rule("snapshot_score_in_range", failing="gold_recommendation_score < 0 OR gold_recommendation_score > 1"),
            Rule("snapshot_no_trading_signal", absent=("trading_signal",)),
            Rule("snapshot_no_combined_signal", absent=("combined_signal",)),
        ],
        "history": [
            Rule(
                "ohlc_required_cols",
                present=(
                    "coin_id", "candle_date", "open", "high", "low", "close",
                    "daily_candle_direction", "daily_range_pct", "ma_7d", "ma_14d",
                    "ma_30d", "trend_strength", "avg_recommendation_score",
                ),
            ),
            Rule("ohlc_unique_grain", unique=("coin_id", "candle_date")),
            Rule("ohlc_hl_valid", failing="high < low"),
            Rule("ohlc_no_trading_signal", absent=("trading_signal",)),
        ],
        "performance": [
            Rule(
                "perf_required_cols",
                present=(
                    "id", "name", "ingestion_date", "price_change_percentage_24h",
                    "gainer_rank", "loser_rank", "performance_label",
                    "performance_percentile", "streak_days", "streak_direction",
                    "avg_recommendation_score",
                ),
            ),
            Rule("perf_unique_grain", unique=("id", "ingestion_date")),
        ],
        "summary": [
            Rule(
                "summary_required_cols",
                present=(
                    "ingestion_date", "total_market_cap", "total_volume", "gainers_count",
                    "losers_count", "market_sentiment", "btc_dominance_pct",
                    "top_gainer_coin", "top_loser_coin", "avg_recommendation_score",
                    "pct_high_signal",
                ),
            ),
            Rule("summary_unique_date", unique=("ingestion_date",)),
        ],
    }


def validate_gold(
    snapshot: DataFrame, history: DataFrame, performance: DataFrame, summary: DataFrame
) -> DataFrame:
    """The thirteen checks of the four published tables, each evaluated once."""
    found = {"snapshot": snapshot, "history": history, "performance": performance, "summary": summary}
    checks = [validate(found[table], rules) for table, rules in gold_rules().items()]
    out = checks[0]
    for part in checks[1:]:
        out = out.unionByName(part)
    return out
