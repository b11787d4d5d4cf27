"""Lookups of facts in versioned and calendar dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators.merge import require_unique

# The attributes facts take from the entity dimension and the calendar.
ENTITY_ATTRIBUTES = (
    "coin_sk", "market_segment", "supply_utilisation_pct", "ath_distance_bucket", "is_scarce",
    "confidentiality_score", "data_transparency_tier",
)
DATE_ATTRIBUTES = (
    "date_id", "year_month", "year_quarter", "year_week", "day_name", "is_weekend",
)


def asof_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    day: str,
    attributes: tuple[str, ...] = ENTITY_ATTRIBUTES,
) -> DataFrame:
    """Attributes of the version valid on each fact's day: from inclusive, to exclusive.

    Linear in facts and versions: a closed version is listed once for each month it touches, so a
    fact meets the versions of its own (entity, month) only; the one open version of an entity is
    met by entity. A hot entity's facts are split by the adaptive skew join. Versions must not
    overlap (``require_versions``), or a fact would come back twice.
    """
    on_day: Column = F.col(day).cast("date")
    versions = dim.select(
        F.col("id").alias("_id"),
        F.col("effective_from").cast("date").alias("_from"),
        F.col("effective_to").cast("date").alias("_to"),
        F.struct(*attributes).alias("_found"),
    )
    # the last day is the one before ``effective_to``; an empty interval is valid on no day
    months = F.sequence(
        F.trunc("_from", "month"), F.trunc(F.date_sub("_to", 1), "month"), F.expr("INTERVAL 1 MONTH")
    )
    closed = versions.where("_to > _from").withColumn("_month", F.explode(months))
    still_open = versions.where("_to IS NULL").select(
        F.col("_id").alias("_open_id"), F.col("_from").alias("_open_from"), F.col("_found").alias("_open")
    )
    in_month = (F.col(key) == F.col("_id")) & (F.trunc(on_day, "month") == F.col("_month"))
    inside = (on_day >= F.col("_from")) & (on_day < F.col("_to"))
    since = (F.col(key) == F.col("_open_id")) & (on_day >= F.col("_open_from"))
    joined = (
        facts.drop(*attributes).join(closed, in_month & inside, "left").join(still_open, since, "left")
    )
    found = F.coalesce("_found", "_open")
    return joined.select(
        *[c for c in facts.columns if c not in attributes],
        *[found[a].alias(a) for a in attributes],
    )


def overlapping_versions(dim: DataFrame) -> DataFrame:
    """Versions that start before their predecessor ended; must be empty for ``asof_join`` to
    keep the fact's grain."""
    w = Window.partitionBy("id").orderBy("scd_version")
    before = F.lag("effective_to").over(w)
    started = F.row_number().over(w) > 1
    return (
        dim.withColumn(
            "_clash", started & (before.isNull() | (before > F.col("effective_from")))
        )
        .where("_clash")
        .drop("_clash")
    )


def with_dates(facts: DataFrame, dates: DataFrame, day: str) -> DataFrame:
    """Calendar columns by date. The calendar has one row per day (some 37 thousand a century),
    which bounds what is broadcast."""
    lookup = dates.select(F.col("date_actual").alias("_day"), *DATE_ATTRIBUTES)
    return facts.join(
        F.broadcast(lookup), F.date_format(day, "yyyy-MM-dd") == F.col("_day"), "left"
    ).drop("_day")


def with_hours(facts: DataFrame, hours: DataFrame, ts: str) -> DataFrame:
    """Session columns by (date_id, hour); the side is 24 rows per calendar day."""
    lookup = hours.select(
        F.col("date_id").alias("_date"),
        F.col("hour").alias("_hour"),
        "trading_session",
        "candle_block",
        "is_candle_open",
    )
    return facts.join(
        F.broadcast(lookup),
        (F.col("date_id") == F.col("_date")) & (F.hour(ts) == F.col("_hour")),
        "left",
    ).drop("_date", "_hour")


def require_versions(dim: DataFrame) -> DataFrame:
    """Fail where versions of an entity overlap; returns the dimension unchanged."""
    clash = overlapping_versions(dim).select("id", "scd_version").first()
    if clash:
        raise ValueError(f"overlapping versions: {clash.asDict()}")
    return dim


def require_grain(dim: DataFrame, keys: list[str]) -> DataFrame:
    """A lookup keeps the fact's row count only if its side is unique; fail early otherwise."""
    return require_unique(dim, keys)
