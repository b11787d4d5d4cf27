"""Versioned entity dimension, calendars and daily universe membership."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.functions import labels
from candlewick.operators.clean import normalise_names, tidy_types
from candlewick.operators.pick import first_per_key

# Fixed values.
TRACKED = (
    "market_cap_rank", "market_segment", "supply_utilisation_pct", "ath_distance_bucket",
    "is_scarce",
)
DIM_COLUMNS = (
    "coin_sk", "id", "symbol", "name", "market_cap_rank", "market_segment",
    "circulating_supply", "total_supply", "max_supply", "supply_utilisation_pct", "is_scarce",
    "ath_distance_bucket", "confidentiality_score", "data_transparency_tier",
    "effective_from", "effective_to", "is_current", "scd_version",
)
UNIVERSE_COLUMNS = (
    "coin_id", "name", "symbol", "market_cap_rank", "universe_date", "is_active", "entry_reason",
)
FORWARD_DAYS = 90


# --- entity dimension ------------------------------------------------------------------------


def dim_attributes(snapshots: DataFrame, universe: DataFrame | None = None, cfg: Config | None = None):
    """Typed rows with the derived attributes; optional universe columns degrade to NULL."""
    casts = dict.fromkeys(
        ("circulating_supply", "total_supply", "max_supply", "ath_change_percentage"), "double"
    ) | {"market_cap_rank": "int", "ingestion_date": "date"}
    out = tidy_types(normalise_names(snapshots), casts)
    out = out.withColumns(
        {
            "market_segment": labels.market_segment(F.col("market_cap_rank")),
            "supply_utilisation_pct": labels.supply_utilisation_pct(
                F.col("circulating_supply"), F.col("max_supply")
            ),
            "ath_distance_bucket": labels.ath_distance_bucket(F.col("ath_change_percentage")),
            "effective_from": F.col("ingestion_date"),
        }
    ).withColumn("is_scarce", labels.is_scarce(F.col("supply_utilisation_pct")))
    optional = {"confidentiality_score": "int", "data_transparency_tier": "string"}
    offered = [c for c in optional if universe is not None and c in universe.columns]
    if offered and cfg is not None:
        today = universe.where(F.col("universe_date") == F.lit(cfg.run_date)).select(
            F.col("coin_id").alias("id"), *offered
        )
        out = out.join(today, "id", "left")
    return out.withColumns(
        {c: F.lit(None).cast(t) for c, t in optional.items() if c not in out.columns}
    )


def dim_source(bronze: DataFrame, universe: DataFrame | None = None, cfg: Config | None = None):
    """The latest row of every entity, as the next dimension batch."""
    latest = first_per_key(
        normalise_names(bronze),
        ["id"],
        [F.col("ingestion_date").desc(), F.col("ingestion_timestamp").desc_nulls_last()],
    )
    return dim_attributes(latest, universe, cfg)


def _surrogate() -> Column:
    """Stable across runs, unlike a running number."""
    return F.xxhash64("id", "scd_version")


def _differs(left: str, right: str) -> Column:
    test = F.lit(False)
    for c in TRACKED:
        test = test | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return test


def scd2_init(source: DataFrame) -> DataFrame:
    return (
        source.withColumns(
            {
                "effective_to": F.lit(None).cast("date"),
                "is_current": F.lit(True),
                "scd_version": F.lit(1),
            }
        )
        .withColumn("coin_sk", _surrogate())
        .select(*DIM_COLUMNS)
    )


def scd2_step(dim: DataFrame, source: DataFrame) -> DataFrame:
    """The dimension after one batch: changed rows expire, changed and new entities get the next
    version, the rest (also absent entities) stays as it is."""
    compared = source.select("id", "effective_from", *TRACKED).alias("s")
    aged = dim.alias("t").join(compared, F.col("t.id") == F.col("s.id"), "left")
    expires = F.col("t.is_current") & F.col("s.id").isNotNull() & _differs("t", "s")
    kept = aged.select(
        *[
            F.when(expires, F.lit(False)).otherwise(F.col("t.is_current")).alias(c)
            if c == "is_current"
            else F.when(expires, F.col("s.effective_from")).otherwise(F.col("t.effective_to")).alias(c)
            if c == "effective_to"
            else F.col(f"t.{c}")
            for c in DIM_COLUMNS
        ]
    )
    open_rows = dim.where("is_current").select("id", *TRACKED).alias("t")
    last_version = dim.groupBy("id").agg(F.max("scd_version").alias("_last")).alias("v")
    fresh = (
        source.alias("s")
        .join(open_rows, F.col("s.id") == F.col("t.id"), "left")
        .where(F.col("t.id").isNull() | _differs("t", "s"))
        .join(last_version, F.col("s.id") == F.col("v.id"), "left")
        .select("s.*", (F.coalesce(F.col("v._last"), F.lit(0)) + 1).alias("scd_version"))
        .withColumns({"effective_to": F.lit(None).cast("date"), "is_current": F.lit(True)})
        .withColumn("coin_sk", _surrogate())
        .select(*DIM_COLUMNS)
    )
    return kept.unionByName(fresh)


def scd2_history(attributes: DataFrame) -> DataFrame:
    """All versions from all daily snapshots at once: equal to the initial load followed by one
    step per day. Rows are one per (id, day), so each id's window is bounded by the calendar."""
    w = Window.partitionBy("id").orderBy("effective_from")
    same = F.lit(True)
    for c in TRACKED:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(w))
    first = F.row_number().over(w) == 1
    versions = attributes.withColumn("_new", first | ~same).where("_new").drop("_new")
    return (
        versions.withColumns(
            {
                "scd_version": F.row_number().over(w),
                "effective_to": F.lead("effective_from").over(w),
            }
        )
        .withColumns({"is_current": F.col("effective_to").isNull(), "coin_sk": _surrogate()})
        .select(*DIM_COLUMNS)
    )


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.where("is_current")


def version_history(dim: DataFrame) -> DataFrame:
    return dim.orderBy("id", "scd_version")


# --- calendars -------------------------------------------------------------------------------


def calendar_days(facts: DataFrame, day: str, cfg: Config) -> DataFrame:
    """One row per day from the first fact to 90 days past the run date."""
    end = F.lit(cfg.run_date + timedelta(days=FORWARD_DAYS))
    return facts.agg(F.min(F.col(day).cast("date")).alias("_first")).select(
        F.explode(F.sequence("_first", end)).alias("d")
    )


def _monday_week(day: Column) -> Column:
    """Week of the year, weeks start on Monday, days before the first Monday are week 0."""
    return F.floor((F.dayofyear(day) + 7 - (F.weekday(day) + 1)) / 7).cast("int")


def dim_date(days: DataFrame, cfg: Config) -> DataFrame:
    d = F.col("d")
    year, month, weekday = F.year(d), F.month(d), F.weekday(d) + 1
    quarter, week, today = F.quarter(d), _monday_week(d), F.lit(cfg.run_date)
    quarter_label = F.concat(F.lit("Q"), quarter.cast("string"))
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
        F.date_format(d, "yyyy-MM-dd").alias("date_actual"),
        year.alias("year"),
        quarter.alias("quarter"),
        quarter_label.alias("quarter_label"),
        month.alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_abbr"),
        week.alias("week_of_year"),
        F.dayofyear(d).alias("day_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_abbr"),
        (weekday >= 6).alias("is_weekend"),
        (weekday <= 5).alias("is_weekday"),
        F.lit(True).alias("is_trading_day"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat_ws("-", year.cast("string"), quarter_label).alias("year_quarter"),
        F.concat(
            year.cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0")
        ).alias("year_week"),
        (d == today).alias("is_today"),
        (d < today).alias("is_past"),
        (d > today).alias("is_future"),
    )


def dim_date_hour(days: DataFrame, cfg: Config) -> DataFrame:
    d, h = F.col("d"), F.col("hour")
    date_id = F.date_format(d, "yyyyMMdd").cast("int")
    weekday = F.weekday(d) + 1
    step = cfg.candle_hours
    return days.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23)))).select(
        (date_id * 100 + h).alias("date_hour_id"),
        date_id.alias("date_id"),
        F.date_format(d, "yyyy-MM-dd").alias("date_actual"),
        "hour",
        F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":00")).alias("hour_label"),
        (F.floor(h / step) * step).cast("int").alias("candle_block"),
        (h % step == 0).alias("is_candle_open"),
        labels.trading_session(h).alias("trading_session"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        weekday.alias("day_of_week"),
        (weekday >= 6).alias("is_weekend"),
    )


def today_row(dates: DataFrame) -> DataFrame:
    return dates.where("is_today")


def candle_open_hours(hours: DataFrame) -> DataFrame:
    return hours.where("is_candle_open")


# --- universe --------------------------------------------------------------------------------


def _members(market: DataFrame) -> DataFrame:
    """Active members by day; rows merely carried forward do not count."""
    if "load_status" in market.columns:
        market = market.where(~F.col("load_status").eqNullSafe(labels.STALE))
    return market.select(
        F.col("id").alias("coin_id"),
        "name",
        "symbol",
        "market_cap_rank",
        F.col("ingestion_date").cast("date").alias("universe_date"),
        F.lit(True).alias("is_active"),
        F.lit("in_top_n").alias("entry_reason"),
    )


def _exits(gone: DataFrame, dim: DataFrame) -> DataFrame:
    """Exit rows enriched from the current dimension versions (one per id)."""
    known = current_versions(dim).select(
        F.col("id").alias("coin_id"), "name", "symbol", "market_cap_rank"
    )
    return (
        gone.withColumns(
            {"is_active": F.lit(False), "entry_reason": F.lit("exited_top_n")}
        )
        .join(known, "coin_id", "left")
        .select(*UNIVERSE_COLUMNS)
    )


def universe_day(market: DataFrame, universe: DataFrame, dim: DataFrame, cfg: Config) -> DataFrame:
    """Rows of the run date: today's members, and yesterday's that are gone."""
    today = _members(market).where(F.col("universe_date") == F.lit(cfg.run_date))
    before = universe.where(
        (F.col("universe_date") == F.lit(cfg.run_date - timedelta(days=1))) & F.col("is_active")
    ).select("coin_id")
    gone = before.join(today.select("coin_id"), "coin_id", "left_anti").withColumn(
        "universe_date", F.lit(cfg.run_date)
    )
    return today.unionByName(_exits(gone, dim), allowMissingColumns=True)


def universe_history(market: DataFrame, dim: DataFrame) -> DataFrame:
    """All days at once. An exit needs a batch on the day itself, and the day before."""
    members = _members(market)
    due = members.select("coin_id", F.date_add("universe_date", 1).alias("universe_date"))
    days = members.select("universe_date").distinct()
    gone = due.join(
        members.select("coin_id", "universe_date"), ["coin_id", "universe_date"], "left_anti"
    ).join(days, "universe_date", "left_semi")
    return members.unionByName(_exits(gone, dim), allowMissingColumns=True)


def universe_summary(universe: DataFrame) -> DataFrame:
    return universe.groupBy("is_active", "entry_reason").agg(F.count("*").alias("row_count"))


def empty_universe(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [],
        "coin_id string, name string, symbol string, market_cap_rank int, universe_date date, "
        "is_active boolean, entry_reason string",
    )
