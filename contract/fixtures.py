"""Logical inputs derived from the given tables; each has a twin in ``sql.py``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DateType,
    DecimalType,
    IntegerType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

from candlewick.config import Config
from candlewick.functions import labels
from candlewick.functions.numeric import pct_change
from candlewick.operators import clean, dims, indicators, load, market, quality, rollup
from candlewick.staging import stage

CFG = Config(
    run_ts=datetime(2024, 1, 31), run_id="contract", reference_id="7", exact_scale=4
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def edge(df: DataFrame) -> DataFrame:
    """Published types: dates and timestamps as text, integers as long, decimals as double."""

    def cast(field):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, (IntegerType, ShortType, ByteType)):
            c = c.cast("long")
        elif isinstance(field.dataType, DecimalType):
            c = c.cast("double")
        return c.alias(field.name)

    return df.select(*[cast(f) for f in df.schema.fields])


# --- candles ---------------------------------------------------------------------------------


def group() -> Column:
    """Twenty user groups."""
    return (F.col("user_id") % 20).cast("string")


def candles(spark: SparkSession, sf: str, key: Column | None = None) -> DataFrame:
    """Four-hour candles of the event values, per event type unless another key is given."""
    ticks = table(spark, sf, "events").withColumn(
        "_key", F.col("event_type") if key is None else key
    )
    return rollup.candles_from_ticks(ticks, "_key", "ts", "value", CFG)


def group_candles(spark: SparkSession, sf: str) -> DataFrame:
    return candles(spark, sf, group())


def slot_number() -> Column:
    """Running number of a candle slot since the first of January, spread by coin."""
    first = F.lit("2024-01-01").cast("timestamp")
    slots = (F.col("timestamp_ms") / 1000 - F.unix_timestamp(first)) / 14400
    return (slots.cast("long") * 5 + F.length("coin_id")).cast("long")


def dirty_candles(spark: SparkSession, sf: str, key: Column | None = None) -> DataFrame:
    """Candles with every kind of fault at fixed slot numbers; some rows twice."""
    k = F.col("k")
    rows = candles(spark, sf, key).withColumn("k", slot_number())
    # every rule reads the sound values
    rows = rows.withColumns(
        {
            "open": F.when(k % 61 == 0, F.lit(None).cast("double"))
            .when(k % 59 == 0, F.col("high") + 1)
            .otherwise(F.col("open")),
            "close": F.when(k % 43 == 0, F.lit(0.0))
            .when(k % 41 == 0, F.col("high") + 2)
            .otherwise(F.col("close")),
            "low": F.when(k % 47 == 0, -F.col("low") - 1).otherwise(F.col("low")),
            "high": F.when(k % 53 == 0, F.col("low") - 1).otherwise(F.col("high")),
        }
    )
    copies = F.when(k % 37 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("copy", F.explode(copies)).drop("copy")


def bronze_candles(spark: SparkSession, sf: str) -> DataFrame:
    """Faulty candles of the user groups with lineage; some rows are carried forward."""
    status = (
        F.when(F.col("k") % 29 == 0, "STALE")
        .when(F.dayofmonth("candle_date") % 4 == 0, "PARTIAL_LOAD")
        .when(F.dayofmonth("candle_date") % 4 == 1, "PARTIAL_LOAD_CRITICAL")
        .otherwise("SUCCESS")
    )
    return dirty_candles(spark, sf, group()).withColumns(
        {"load_status": status, "ingestion_timestamp": F.col("candle_datetime")}
    )


def bronze_market(spark: SparkSession, sf: str) -> DataFrame:
    """Market days, some carried forward and some without a price."""
    return market_days(spark, sf).withColumns(
        {
            "load_status": F.when(F.col("n") % 17 == 0, "STALE").otherwise("SUCCESS"),
            "current_price": F.when(F.col("n") % 13 != 0, F.col("current_price")),
        }
    )


def shaped(spark: SparkSession, sf: str) -> DataFrame:
    return indicators.candle_shape(candles(spark, sf))


def featured(spark: SparkSession, sf: str, key: Column | None = None) -> DataFrame:
    """Candles with every indicator, the anomaly flag and their ingestion date."""
    base = candles(spark, sf, key)
    out = indicators.candle_features(base, CFG)
    bound = quality.candle_limits(base, CFG).select("p99_body").scalar()
    return indicators.flag_candles(out, bound, CFG).withColumn(
        "ingestion_date", F.col("candle_date")
    )


# --- market days -----------------------------------------------------------------------------


def ieee_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` of doubles as the oracle divides: by zero it is infinite, and 0 / 0 is NaN."""
    endless = F.when(top > 0, float("inf")).when(top < 0, float("-inf"))
    endless = F.when(top.isNotNull(), endless.otherwise(float("nan")))
    return F.when(bottom == 0, endless).otherwise(top / bottom)


def market_days(spark: SparkSession, sf: str) -> DataFrame:
    """One market record per user and day."""
    n = F.col("id").cast("long")
    # a double, so that no id is too large for the products below
    units = n.cast("double") + 1
    price = F.col("current_price")
    days = (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").cast("string").alias("id"), F.to_date("ts").alias("ingestion_date"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total_volume"),
            F.max("value").alias("high_24h"),
            F.min("value").alias("low_24h"),
            F.max("ts").alias("ingestion_timestamp"),
        )
        .withColumn("current_price", F.round(F.col("total_volume") / F.col("n"), 2))
    )
    history = Window.partitionBy("id").orderBy("ingestion_date")
    ranked = Window.partitionBy("ingestion_date").orderBy(F.col("total_volume").desc(), "id")
    before = F.lag(price).over(history)
    # the all-time high lies close to the price or far above it
    above = F.when(n % 5 == 0, 1.0).when(n % 5 == 1, 1.15).when(n % 5 == 2, 1.6).when(n % 5 == 3, 3.0)
    above = above.otherwise(10.0)
    return days.withColumns(
        {
            "symbol": F.concat(F.lit("c"), F.col("id")),
            "name": F.concat(F.lit("Coin "), F.col("id")),
            "market_cap": price * units * 997,
            "market_cap_rank": F.row_number().over(ranked),
            "price_change_24h": price - before,
            "price_change_percentage_24h": ieee_ratio(price - before, before) * 100,
            "circulating_supply": units * (800 + F.col("n") % 10 * 20),
            "total_supply": units * 1000,
            "max_supply": F.when(n % 7 != 0, units * 1000),
            "ath": F.round(F.col("high_24h") * above, 2),
            "atl": F.round(F.col("low_24h") * 0.9, 2),
            "market_cap_change_24h": F.lit(None).cast("double"),
            "market_cap_change_percentage_24h": F.lit(None).cast("double"),
            "pipeline_run_id": F.lit("r1"),
            "load_status": F.lit("SUCCESS"),
        }
    ).withColumns(
        {
            "ath_change_percentage": pct_change(price, F.col("ath")),
            "atl_change_percentage": pct_change(price, F.col("atl")),
            "fully_diluted_valuation": price * F.col("total_supply"),
        }
    )


def partial_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Market days of which some batches are cut to every grade."""
    size = (
        F.when(F.dayofmonth("ingestion_date") % 5 == 0, 20)
        .when(F.dayofmonth("ingestion_date") % 5 == 1, 17)
        .when(F.dayofmonth("ingestion_date") % 5 == 2, 12)
        .when(F.dayofmonth("ingestion_date") % 5 == 3, 5)
        .otherwise(1)
    )
    return market_days(spark, sf).where(F.col("id").cast("long") < size)


def graded(spark: SparkSession, sf: str) -> DataFrame:
    return load.with_grade(partial_batches(spark, sf), CFG)


def attributes(spark: SparkSession, sf: str) -> DataFrame:
    return dims.dim_attributes(market_days(spark, sf))


def dim(spark: SparkSession, sf: str) -> DataFrame:
    return dims.scd2_history(attributes(spark, sf))


def members(spark: SparkSession, sf: str) -> DataFrame:
    """Entities (one per user) seen on each day."""
    return (
        table(spark, sf, "events")
        .select(F.col("user_id").cast("string").alias("id"), F.to_date("ts").alias("ingestion_date"))
        .distinct()
        .select(
            "id",
            F.concat(F.lit("Coin "), F.col("id")).alias("name"),
            F.concat(F.lit("c"), F.col("id")).alias("symbol"),
            F.col("id").cast("int").alias("market_cap_rank"),
            "ingestion_date",
        )
    )


def member_dim(spark: SparkSession, sf: str) -> DataFrame:
    return (
        members(spark, sf)
        .select("id", "name", "symbol", "market_cap_rank")
        .distinct()
        .withColumn("is_current", F.lit(True))
    )


def universe(spark: SparkSession, sf: str) -> DataFrame:
    return dims.universe_history(members(spark, sf), member_dim(spark, sf))


def market_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Market days with segment, anomaly flags and features."""
    rows = market_days(spark, sf).withColumn(
        "market_segment", labels.market_segment(F.col("market_cap_rank"))
    )
    flagged = quality.flag_market_anomalies(clean.fill_market_gaps(rows), CFG)
    return market.market_features(flagged, CFG, hot=False)


def market_table(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The market facts stored, for plans that read them more than once."""
    rows = market_silver(spark, sf)
    return stage(rows.select(*columns) if columns else rows, "market")


def candle_table(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The candle facts of the user groups stored, likewise."""
    rows = featured(spark, sf, group())
    return stage(rows.select(*columns) if columns else rows, "candles")


SCORE_COLUMNS = ("coin_id", "ingestion_date", "recommendation_score")


def days(spark: SparkSession, sf: str) -> DataFrame:
    return dims.calendar_days(table(spark, sf, "events"), "ts", CFG)


# --- merge sides -----------------------------------------------------------------------------


def merge_target(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where(F.col("o_orderkey") % 3 != 0)


def merge_source(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .where(F.col("o_orderkey") % 2 == 0)
        .withColumn("o_totalprice", F.col("o_totalprice") + 1)
    )
