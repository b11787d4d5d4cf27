"""Storing what the other plans compute: facts, dimensions, universe, published tables, gaps.

Every step is audited (its grade and row count, or its failure, become a log row) and idempotent:
merges are keyed, and appended rows belong to a run that a repetition replaces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.operators import limits, load, tenure
from candlewick.plans import gold
from candlewick.plans.silver import Facts
from candlewick.sources import tables

# Keys and partitions of the published tables.
GOLD = {
    "snapshot": (["id"], None),
    "history": (["coin_id", "candle_date"], "candle_date"),
    "performance": (["id", "ingestion_date"], "ingestion_date"),
    "summary": (["ingestion_date"], None),
    "trending": (["coin_id", "ingestion_date"], "ingestion_date"),
}
MARKET_KEYS = (["id", "ingestion_date"], "ingestion_date")
CANDLE_KEYS = (["coin_id", "candle_datetime"], "candle_date")
BACKFILL = "BACKFILL_REQUIRED"


def store_facts(facts: Facts, table: str, keys: tuple[list[str], str], log: str, cfg: Config) -> int:
    """Merge clean facts; append rejected and carried-forward rows to tables of their own."""
    spark, (key, partition) = facts.clean.sparkSession, keys

    def step() -> None:
        tables.publish_merge(facts.clean, table, key, cfg, partition)
        tables.append_run(facts.quarantine, f"{table}_quarantine", cfg, "quarantine_run_id")
        tables.append_run(facts.stale, f"{table}_stale", cfg, "stale_run_id")

    return tables.audited(spark, table, log, cfg, step)


def store_dimension(dim: DataFrame, table: str, log: str, cfg: Config) -> int:
    """Replace a dimension, which may have been read from the very table: the old version stays until
    the new one is written."""
    return tables.audited(dim.sparkSession, table, log, cfg, lambda: tables.create_table(dim, table))


def store_universe(members: DataFrame, table: str, log: str, cfg: Config) -> int:
    """Upsert a day's members; earlier days stay."""
    keys = ["coin_id", "universe_date"]
    step = lambda: tables.publish_merge(members, table, keys, cfg, "universe_date")
    return tables.audited(members.sparkSession, table, log, cfg, step)


def store_tenure(members: DataFrame, table: str, log: str, cfg: Config) -> int:
    """Or a day's members into the bitmaps of their month; only that month is read and rewritten.
    ``tenure.days_in_universe`` counts the stored bitmaps."""
    months = tenure.member_months(members)
    step = lambda: tables.publish_merge(months, table, ["coin_id", "month"], cfg, "month", folds=tenure.FOLDS)
    return tables.audited(members.sparkSession, table, log, cfg, step)


def store_clustered(spark: SparkSession, table: str, columns: list[str], log: str, cfg: Config, files: int | None = None) -> int:
    """Rewrite a stored table clustered by several columns; the old layout stays until the new one is written."""
    step = lambda: tables.write_clustered(spark.table(table), table, columns, files=files)
    return tables.audited(spark, table, log, cfg, step)


def store_counts(rows: DataFrame, values: limits.Values, table: str, day: str, log: str, cfg: Config) -> int:
    """Store a day's counts for ``limits.limits``, replacing that day's; the first days' rows decide the
    cuts, which stay in ``<table>_cuts``."""
    spark, cuts = rows.sparkSession, f"{table}_cuts"

    def step() -> None:
        if not spark.catalog.tableExists(cuts):
            tables.create_table(limits.cut_points(rows, values), cuts)
        tables.replace_days(limits.day_counts(rows, values, spark.table(cuts), day), table, "day")

    return tables.audited(spark, table, log, cfg, step)


def store_gold(df: DataFrame, kind: str, table: str, log: str, cfg: Config) -> int:
    """Merge one published table (a key of ``GOLD``) by its key."""
    keys, partition = GOLD[kind]
    step = lambda: tables.publish_merge(df, table, keys, cfg, partition)
    return tables.audited(df.sparkSession, table, log, cfg, step)


def store_all_gold(market: DataFrame, candles: DataFrame, prefix: str, log: str, cfg: Config) -> dict[str, int]:
    """The four published tables of a run from stored facts; returns their row counts."""
    made: dict[str, Callable[[], DataFrame]] = {
        "snapshot": lambda: gold.market_snapshot(market, candles, cfg),
        "history": lambda: gold.ohlc_history(candles, cfg),
        "performance": lambda: gold.performance_metrics(market, candles, cfg),
        "summary": lambda: gold.market_summary(market, candles, cfg),
    }
    return {kind: store_gold(make(), kind, f"{prefix}_{kind}", log, cfg) for kind, make in made.items()}


def log_gaps(spark: SparkSession, table: str, day: str, lookback: int, log: str, cfg: Config) -> list[str]:
    """Log the days of the look-back without rows as one BACKFILL_REQUIRED row; returns them."""
    gaps = load.missing_recent_days(spark.table(table), day, lookback, cfg)
    days = [r[0] for r in gaps.select(F.date_format("missing_date", "yyyy-MM-dd")).orderBy(F.col("missing_date")).collect()]
    if days:
        tables.append_log(tables.log_row(spark, table, BACKFILL, len(days), cfg, ", ".join(days)), log)
    return days
