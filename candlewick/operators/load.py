"""Load grading, fallback, carry-forward and gap detection over any number of daily batches."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from candlewick.config import Config
from candlewick.functions import labels
from candlewick.operators.merge import merge_insert_only
from candlewick.operators.pick import first_per_key

DAY = "ingestion_date"
DIVERTED = (labels.SEVERE, labels.FAILURE)
PARTIALS = (labels.PARTIAL, labels.CRITICAL)


def grade_batches(batches: DataFrame, cfg: Config, entity: str = "id", day: str = DAY) -> DataFrame:
    """Distinct entities received per day and the resulting grade."""
    return (
        batches.groupBy(day)
        .agg(F.countDistinct(entity).alias("coins_received"))
        .withColumn("coins_expected", F.lit(cfg.expected_entities))
        .withColumn(
            "load_status", labels.load_grade(F.col("coins_received"), F.col("coins_expected"), cfg)
        )
    )


def with_grade(batches: DataFrame, cfg: Config, entity: str = "id", day: str = DAY) -> DataFrame:
    """Stamp every row with its batch's grade; rows without a day are one batch of their own.

    The join side is bounded by the calendar where ``day`` is a date, and is broadcast only then."""
    grades = grade_batches(batches, cfg, entity, day).withColumnRenamed(day, "_graded_day")
    if isinstance(batches.schema[day].dataType, DateType):
        grades = F.broadcast(grades)
    rows = batches.drop("coins_received", "coins_expected", "load_status")
    stamped = rows.join(grades, F.col(day).eqNullSafe(F.col("_graded_day")), "left")
    rest = [c for c in rows.columns if c != day]
    return stamped.select(day, *rest, "coins_received", "coins_expected", "load_status")


def last_snapshot(table: DataFrame, day: str = DAY) -> DataFrame:
    """Rows of the newest date; on a date-partitioned table only that partition is read."""
    return table.where(F.col(day) == table.select(F.max(day)).scalar())


def stamp_fallback(snapshot: DataFrame, status: str, cfg: Config) -> DataFrame:
    return snapshot.withColumns(
        {
            DAY: F.lit(cfg.run_date),
            "ingestion_timestamp": F.lit(cfg.run_ts),
            "pipeline_run_id": F.lit(cfg.run_id),
            "is_fallback": F.lit(True),
            "load_status": F.lit(status),
        }
    )


def reconcile_stale(
    incoming: DataFrame, known: DataFrame, expected: DataFrame, cfg: Config
) -> DataFrame:
    """One batch: the latest known row of every expected id the batch lacks, stamped STALE.

    The last day of each missing id comes from two columns of the stored table; whole rows are
    then read for those (id, day) pairs only.
    """
    missing = expected.select("id").join(incoming.select("id"), "id", "left_anti")
    last = (
        known.select("id", DAY)
        .join(missing, "id", "left_semi")
        .groupBy("id")
        .agg(F.max(DAY).alias(DAY))
    )
    latest = first_per_key(
        known.join(last, ["id", DAY], "left_semi"), ["id"], [F.col("ingestion_timestamp").desc()]
    )
    received = incoming.select(F.countDistinct("id")).scalar()
    return stamp_fallback(latest, labels.STALE, cfg).withColumns(
        {"coins_expected": F.lit(cfg.expected_entities), "coins_received": received}
    )


def carry_forward(graded: DataFrame, expected: DataFrame, cfg: Config) -> DataFrame:
    """All batches at once: STALE rows for every expected id missing on a partially loaded day.

    A row stands in for the days until the id's next row, so one window per id (one row per day,
    bounded by the calendar) replaces a lookup per batch.
    """
    accepted = graded.where(~F.col("load_status").isin(*DIVERTED))
    last_day = accepted.select(F.max(DAY)).scalar()
    partial_days = (
        accepted.where(F.col("load_status").isin(*PARTIALS))
        .groupBy(DAY)
        .agg(
            F.first("coins_received").alias("coins_received"),
            F.first("coins_expected").alias("coins_expected"),
        )
    )
    # all partially loaded days as one array, bounded by the calendar: a gap of years costs its
    # partial days only, not a row per day
    listed = partial_days.select(
        F.array_sort(F.collect_list(F.struct(DAY, "coins_received", "coins_expected")))
    ).scalar()
    w = Window.partitionBy("id").orderBy(DAY)
    upto = F.coalesce(F.date_sub(F.lead(DAY).over(w), 1), last_day)
    held = (
        accepted.join(expected.select("id"), "id", "left_semi")
        .withColumns({"_upto": upto, "_partial": listed})
        .drop("load_status", "coins_received", "coins_expected")
        .withColumn("known_date", F.col(DAY))
        .withColumn(
            "_due",
            F.explode(F.filter("_partial", lambda d: (d[DAY] > F.col(DAY)) & (d[DAY] <= F.col("_upto")))),
        )
    )
    return held.withColumns(
        {
            DAY: F.col(f"_due.{DAY}"),
            "coins_received": F.col("_due.coins_received"),
            "coins_expected": F.col("_due.coins_expected"),
            "load_status": F.lit(labels.STALE),
            "is_fallback": F.lit(True),
            "pipeline_run_id": F.lit(cfg.run_id),
            "ingestion_timestamp": F.lit(cfg.run_ts),
        }
    ).drop("_due", "_upto", "_partial")


def route_severe(graded: DataFrame, mode: str = "divert") -> tuple[DataFrame, DataFrame]:
    """(main, quarantine). ``divert`` keeps severe batches out of main, ``keep`` stores them in
    both places (the candle table's rule)."""
    severe = F.col("load_status").isin(*DIVERTED)
    if mode == "keep":
        return graded, graded.where(F.col("load_status") == labels.SEVERE)
    return graded.where(~severe), graded.where(severe)


def fallback_days(graded: DataFrame, cfg: Config) -> DataFrame:
    """For every diverted day the rows of the last accepted day before it, re-dated.

    Day-level bookkeeping is one row per day; only its result meets the data, joined by day.
    """
    days = graded.groupBy(DAY).agg(F.first("load_status").alias("batch_status"))
    good = ~F.col("batch_status").isin(*DIVERTED)
    # one row per calendar day: some 37 thousand a century, ordered in one task
    along = Window.orderBy(DAY)
    sources = (
        days.withColumn(
            "_source", F.last(F.when(good, F.col(DAY)), ignorenulls=True).over(along)
        )
        .where(~good & F.col("_source").isNotNull())
        .select("_source", F.col(DAY).alias("_day"), "batch_status")
    )
    accepted, _ = route_severe(graded)
    return (
        accepted.join(F.broadcast(sources), F.col(DAY) == F.col("_source"))
        .withColumns(
            {
                "known_date": F.col(DAY),
                DAY: F.col("_day"),
                "load_status": F.col("batch_status"),
                "is_fallback": F.lit(True),
                "pipeline_run_id": F.lit(cfg.run_id),
                "ingestion_timestamp": F.lit(cfg.run_ts),
            }
        )
        .drop("_source", "_day", "batch_status")
    )


def archived_candles(archive: DataFrame, failed: DataFrame, cfg: Config) -> DataFrame:
    """Candles of failed entities from their newest archived run, stamped as fallback."""
    newest = first_per_key(
        archive.join(failed.select("coin_id").distinct(), "coin_id", "left_semi"),
        ["coin_id", "timestamp_ms"],
        [F.col("archive_run_id").desc()],
    )
    return newest.withColumns(
        {
            DAY: F.lit(cfg.run_date),
            "ingestion_timestamp": F.lit(cfg.run_ts),
            "pipeline_run_id": F.lit(cfg.run_id),
            "is_fallback": F.lit(True),
        }
    )


def archive_fallback(
    current: DataFrame, archive: DataFrame, failed: DataFrame, cfg: Config
) -> DataFrame:
    """The current candles, completed with archived ones of failed entities where still absent."""
    stamped = archived_candles(archive, failed, cfg)
    extra = [c for c in stamped.columns if c not in current.columns and c != "is_fallback"]
    return merge_insert_only(current, stamped.drop(*extra), ["coin_id", "timestamp_ms"])


def missing_days(table: DataFrame, day: str, first: Column, last: Column) -> DataFrame:
    """Calendar days in ``[first, last]`` without any row."""
    present = table.select(F.col(day).cast("date").alias("missing_date")).distinct()
    calendar = table.sparkSession.range(1).select(
        F.explode(F.sequence(first, last)).alias("missing_date")
    )
    return calendar.join(present, "missing_date", "left_anti")


def missing_recent_days(table: DataFrame, day: str, lookback: int, cfg: Config) -> DataFrame:
    first = cfg.run_date - timedelta(days=lookback)
    last = cfg.run_date - timedelta(days=1)
    recent = table.where(F.col(day).cast("date").between(F.lit(first), F.lit(last)))
    return missing_days(recent, day, F.lit(first), F.lit(last))


def missing_entity_days(
    table: DataFrame, entities: DataFrame, key: str, day: str, lookback: int, cfg: Config
) -> DataFrame:
    """(entity, day) pairs of the look-back without a row."""
    first = F.lit(cfg.run_date - timedelta(days=lookback))
    last = F.lit(cfg.run_date - timedelta(days=1))
    due = entities.select(key).distinct().withColumn(
        "missing_date", F.explode(F.sequence(first, last))
    )
    seen = (
        table.select(key, F.col(day).cast("date").alias("missing_date"))
        .where(F.col("missing_date").between(first, last))
        .distinct()
    )
    return due.join(seen, [key, "missing_date"], "left_anti")
