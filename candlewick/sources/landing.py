"""Landed payload files to typed rows with lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.functions import labels
from candlewick.operators.clean import MARKET_NUMERIC, tidy_types

# Payload layouts.
MARKET_SCHEMA = (
    "id string, symbol string, name string, image string, market_cap_rank int, "
    + ", ".join(f"{c} double" for c in MARKET_NUMERIC)
    + ", roi struct<times: double, currency: string, percentage: double>"
)
OHLC_SCHEMA = "coin_id string, ohlc array<array<double>>"
TRENDING_SCHEMA = (
    "struct<coins: array<struct<item: struct<id: string, name: string, symbol: string, "
    "market_cap_rank: int, thumb: string, score: int>>>>"
)


def read_market(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per entity. The schema is given, so nothing is scanned to infer it."""
    return spark.read.schema(MARKET_SCHEMA).json(path)


def read_ohlc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OHLC_SCHEMA).json(path)


def with_lineage(df: DataFrame, cfg: Config, source_api: str) -> DataFrame:
    return df.withColumns(
        {
            "ingestion_timestamp": F.lit(cfg.run_ts),
            "ingestion_date": F.lit(cfg.run_date),
            "source_api": F.lit(source_api),
            "pipeline_run_id": F.lit(cfg.run_id),
        }
    )


def land_market(records: DataFrame, cfg: Config) -> DataFrame:
    """A market batch with lineage and its load grade; NaN counts as missing."""
    typed = tidy_types(records, dict.fromkeys(MARKET_NUMERIC, "double"))
    received = records.select(F.countDistinct("id")).scalar()
    return with_lineage(typed, cfg, "/coins/markets").withColumns(
        {
            "api_vs_currency": F.lit("usd"),
            "load_status": labels.load_grade(received, cfg.expected_entities, cfg),
            "coins_expected": F.lit(cfg.expected_entities),
            "coins_received": received,
            "is_fallback": F.lit(False),
        }
    )


def explode_ohlc(payloads: DataFrame) -> DataFrame:
    """``(coin_id, [[ts, open, high, low, close], ...])`` to one typed row per candle."""
    row = F.explode("ohlc")
    return payloads.select("coin_id", row.alias("r")).select(
        "coin_id",
        F.element_at("r", 1).cast("long").alias("timestamp_ms"),
        *[
            F.element_at("r", place).alias(name)
            for place, name in ((2, "open"), (3, "high"), (4, "low"), (5, "close"))
        ],
    )


def with_candle_time(candles: DataFrame) -> DataFrame:
    """Epoch millis to a UTC timestamp and its date."""
    return candles.withColumn("candle_datetime", F.timestamp_millis("timestamp_ms")).withColumn(
        "candle_date", F.to_date("candle_datetime")
    )


def land_ohlc(payloads: DataFrame, cfg: Config) -> DataFrame:
    received = payloads.where(F.size("ohlc") > 0).select(F.countDistinct("coin_id")).scalar()
    rows = with_lineage(with_candle_time(explode_ohlc(payloads)), cfg, "")
    return rows.withColumns(
        {
            "source_api": F.concat(F.lit("/coins/"), F.col("coin_id"), F.lit("/ohlc")),
            "days_requested": F.lit(cfg.lookback_days),
            "load_status": labels.load_grade(received, cfg.expected_entities, cfg),
            "coins_expected": F.lit(cfg.expected_entities),
            "coins_received": received,
        }
    )


def parse_trending(payloads: DataFrame, column: str) -> DataFrame:
    """Nested trending JSON to rows; a missing score counts as 0, ranks start at 1."""
    item = F.explode(F.from_json(column, TRENDING_SCHEMA)["coins"]["item"])
    others = [c for c in payloads.columns if c != column]
    return payloads.select(*others, item.alias("i")).select(
        *others,
        F.col("i.id").alias("coin_id"),
        "i.name",
        "i.symbol",
        "i.market_cap_rank",
        "i.thumb",
        "i.score",
        (F.coalesce("i.score", F.lit(0)) + 1).alias("trending_rank"),
    )
