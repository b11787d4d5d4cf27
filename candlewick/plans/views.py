"""Ready-made queries over the published tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.functions.labels import display_label
from candlewick.functions.numeric import mean_of


def chart_series(history: DataFrame, coin: str) -> DataFrame:
    """Daily prices of one entity in date order; the entity is a bound parameter, never spliced
    into the text."""
    return history.sparkSession.sql(
        "SELECT candle_date, open, high, low, close FROM {history} "
        "WHERE coin_id = :coin ORDER BY candle_date",
        args={"coin": coin},
        history=history,
    )


def entity_picker(history: DataFrame) -> DataFrame:
    return (
        history.select("coin_id")
        .distinct()
        .withColumn("coin_label", display_label(F.col("coin_id")))
        .orderBy("coin_id")
    )


def top_by_rank(snapshot: DataFrame, n: int = 5) -> DataFrame:
    return snapshot.orderBy(F.col("market_cap_rank").asc_nulls_last(), "id").limit(n)


def top_by_score(snapshot: DataFrame, n: int = 5) -> DataFrame:
    score = F.col("gold_recommendation_score")
    return snapshot.where(score.isNotNull()).orderBy(score.desc(), "id").limit(n)


def top_movers(performance: DataFrame, day: date, rank: str, n: int = 5) -> DataFrame:
    """Best ``gainer_rank`` or ``loser_rank`` of one day."""
    return performance.where(F.col("ingestion_date") == F.lit(day)).orderBy(rank, "id").limit(n)


def latest_of_entity(table: DataFrame, key: str, value: str, by: str, k: int) -> DataFrame:
    return table.where(F.col(key) == value).orderBy(F.col(by).desc()).limit(k)


def latest_rows(table: DataFrame, by: str, k: int = 3) -> DataFrame:
    return table.orderBy(F.col(by).desc()).limit(k)


def session_counts(candles: DataFrame) -> DataFrame:
    return frequency(candles, "trading_session")


def session_volatility(candles: DataFrame, cfg: Config) -> DataFrame:
    return (
        candles.groupBy("trading_session")
        .agg(
            F.round(mean_of(F.col("daily_range_pct"), cfg), cfg.pct_digits).alias("avg_range_pct"),
            F.count("*").alias("candle_count"),
        )
        .orderBy(F.col("avg_range_pct").desc())
    )


def score_by_trend(candles: DataFrame, cfg: Config) -> DataFrame:
    score, digits = F.col("recommendation_score"), cfg.score_digits
    return (
        candles.where(score.isNotNull())
        .groupBy("trend_strength")
        .agg(
            F.round(mean_of(score, cfg), digits).alias("avg_score"),
            F.round(F.min(score), digits).alias("min_score"),
            F.round(F.max(score), digits).alias("max_score"),
            F.count("*").alias("candle_count"),
        )
        .orderBy(F.col("avg_score").desc())
    )


def frequency(table: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        table.groupBy(column)
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.col("row_count").desc(), F.col(column).asc_nulls_last())
    )


def duplicate_grain(table: DataFrame, keys: list[str]) -> DataFrame:
    return table.groupBy(*keys).agg(F.count("*").alias("cnt")).where("cnt > 1")
