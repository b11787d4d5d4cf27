"""Landing a market or candle batch: schema check, grading, routing, merge, carry-forward, archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.functions import labels
from candlewick.operators import load
from candlewick.operators.pick import first_per_key
from candlewick.operators.schema import reconcile_schema
from candlewick.sources import tables


FALLBACK = "FALLBACK"


def _log(rows: DataFrame, names: dict[str, str], status: str, cfg: Config, why: str = "") -> None:
    """One row of the ingestion log, if ``names`` has a ``log``: what was stored and by which grade."""
    if "log" in names and (stored := rows.count()):
        row = tables.log_row(rows.sparkSession, names["main"], status, stored, cfg, why)
        tables.append_log(row, names["log"])


def _grade_of(batch: DataFrame) -> str:
    """The batch's grade: one value per batch, read from one row."""
    row = batch.select("load_status").first()
    return row[0] if row else labels.FAILURE


def store_market(
    batch: DataFrame, expected: DataFrame, names: dict[str, str], cfg: Config
) -> str:
    """Store one landed batch in ``names[main|archive|quarantine|schema_log]``; returns its grade.

    Severe and failed batches go to quarantine and the last snapshot stands in for them; partial
    ones are completed with stale rows for the expected entities they lack. The latest row of
    every entity is kept in ``<main>_latest``, so that completing a batch does not read history.
    With ``names[log]``, the rows stored are logged by grade, rows that stand in as FALLBACK.
    """
    spark, main = batch.sparkSession, names["main"]
    exists = spark.catalog.tableExists(main)
    tables.log_schema_changes(batch, main, names["schema_log"], cfg)
    fitted = reconcile_schema(batch, spark.table(main).schema if exists else None)
    with tables.staged(fitted, f"{main}-landed") as landed:
        grade = _grade_of(landed)
        keys, day, latest = ["id", "ingestion_date"], "ingestion_date", f"{main}_latest"
        arriving = landed
        if grade in load.DIVERTED:
            tables.append_run(landed, names["quarantine"], cfg, day=day)
            if not exists:
                return grade
            arriving = load.stamp_fallback(load.last_snapshot(spark.table(main)), grade, cfg)
        arriving = first_per_key(arriving, keys, [F.col("ingestion_timestamp").desc()])
        with tables.staged(arriving, f"{main}-arriving") as arriving:
            if not spark.catalog.tableExists(latest) and exists:
                newest = first_per_key(spark.table(main), ["id"], [F.col(day).desc()])
                tables.publish_merge(newest, latest, ["id"], cfg)
            known = spark.table(latest) if spark.catalog.tableExists(latest) else arriving
            tables.publish_merge(arriving, main, keys, cfg, day)
            if grade not in (labels.SUCCESS, labels.FAILURE):
                stale = load.reconcile_stale(arriving, known, expected, cfg)
                tables.publish_merge(stale, main, keys, cfg, day, how="insert_only")
            newest = first_per_key(arriving, ["id"], [F.col(day).desc()])
            tables.publish_merge(newest, latest, ["id"], cfg, guard=day)
            tables.append_run(arriving, names["archive"], cfg, day=day, cluster_by="id")
            stands_in = grade in load.DIVERTED
            _log(arriving, names, FALLBACK if stands_in else grade, cfg, grade if stands_in else "")
    return grade


def store_ohlc(
    batch: DataFrame, failed: DataFrame, names: dict[str, str], cfg: Config
) -> str:
    """Store one candle batch. A severe batch is quarantined and stored as well; failed entities
    are completed from the archive, in the partitions that lack their candles. With ``names[log]``, the
    candles landed are logged by grade and the archived ones as FALLBACK."""
    spark, main = batch.sparkSession, names["main"]
    exists = spark.catalog.tableExists(main)
    tables.log_schema_changes(batch, main, names["schema_log"], cfg)
    fitted = reconcile_schema(batch, spark.table(main).schema if exists else None)
    with tables.staged(fitted, f"{main}-landed") as landed:
        grade = _grade_of(landed)
        keys, day = ["coin_id", "timestamp_ms"], "ingestion_date"
        if grade == labels.SEVERE:
            tables.append_run(landed, names["quarantine"], cfg, day=day)
        arriving = first_per_key(landed, keys, [F.col("ingestion_timestamp").desc()])
        tables.publish_merge(arriving, main, keys, cfg, "candle_date")
        if spark.catalog.tableExists(names["archive"]):
            held = tables.runs_holding(spark, names["archive"], failed, "coin_id")
            filled = load.archived_candles(held, failed, cfg)
            filled = filled.drop("archive_run_id")
            with tables.staged(filled, f"{main}-filled") as filled:
                tables.publish_merge(filled, main, keys, cfg, "candle_date", how="insert_only")
                _log(filled, names, FALLBACK, cfg, "archived candles")
        tables.list_run_keys(landed, names["archive"], "coin_id", cfg, day)
        tables.append_run(landed, names["archive"], cfg, day=day, cluster_by="coin_id")
        _log(arriving, names, grade, cfg)
    return grade
