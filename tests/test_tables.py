"""Merges, schema drift, stored tables, landing and the stream."""

import json
from dataclasses import replace
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from candlewick.operators import merge, schema
from candlewick.plans import bronze
from candlewick.sources import landing, tables
from candlewick.streaming.landing import drain_landing


def table(spark, *entries, layout="k int, d date, v string"):
    return spark.createDataFrame(list(entries), layout)


D1, D2, D3 = (date(2024, 1, d) for d in (1, 2, 3))


def test_two_source_rows_for_one_key_fail(spark):
    source = table(spark, (1, D1, "a"), (1, D1, "b"), (2, D1, "c"))
    with pytest.raises(ValueError, match="several source rows"):
        merge.require_unique(source, ["k", "d"])
    assert rows(merge.ambiguous_keys(source, ["k"])) == [(1, 2)]


def test_upsert_is_idempotent(spark):
    target = table(spark, (1, D1, "a"), (2, D1, "b"))
    source = table(spark, (2, D1, "B"), (3, D2, "C"))
    once = merge.merge_upsert(target, source, ["k", "d"])
    assert rows(once) == [(1, D1, "a"), (2, D1, "B"), (3, D2, "C")]
    assert rows(merge.merge_upsert(once, source, ["k", "d"])) == rows(once)


def test_schema_changes_and_reconciliation(spark, cfg):
    stored = table(spark, layout="a int, b double, gone string").schema
    batch = table(spark, (1, "x", 2), layout="a int, b string, fresh int")
    assert sorted(schema.schema_changes(stored, batch.schema)) == [
        ("COLUMN_ADDED", "fresh", "", "int"), ("COLUMN_DROPPED", "gone", "string", ""),
        ("TYPE_CHANGED", "b", "double", "string")]
    fitted = schema.reconcile_schema(batch, stored)
    assert fitted.dtypes == [("a", "int"), ("b", "string"), ("fresh", "int"), ("gone", "string")]
    log = schema.schema_diff(spark, "t", None, batch.schema, cfg)
    assert rows(log, "change_type", "column_name") == [
        ("SCHEMA_INITIALISED", "a"), ("SCHEMA_INITIALISED", "b"), ("SCHEMA_INITIALISED", "fresh")]
    nested = table(spark, layout="a array<int>").schema
    assert schema.schema_changes(nested, table(spark, layout="a array<long>").schema)


def test_publish_rewrites_only_touched_partitions(spark, cfg, names):
    main = names["main"]
    tables.publish_merge(table(spark, (1, D1, "a"), (2, D2, "b")), main, ["k", "d"], cfg, "d")
    kept = {f for f in spark.table(main).where(F.col("d") == D1).inputFiles()}
    update = table(spark, (2, D2, "B"), (3, D3, "C")).withColumn("_work", F.lit(1))
    for _ in range(2):
        tables.publish_merge(update, main, ["k", "d"], cfg, "d")
        assert rows(spark.table(main), "k", "d", "v") == [(1, D1, "a"), (2, D2, "B"), (3, D3, "C")]
    assert set(spark.table(main).where(F.col("d") == D1).inputFiles()) == kept
    assert tables.partitions_of(spark, main).count() == 3
    late = table(spark, (2, D2, "ignored"), (4, D2, "D"))
    tables.publish_merge(late, main, ["k", "d"], cfg, "d", how="insert_only")
    assert rows(spark.table(main).where(F.col("d") == D2), "k", "v") == [(2, "B"), (4, "D")]


def test_publish_common_and_synced(spark, cfg, names):
    main = names["main"]
    tables.publish_merge(table(spark, (1, "a", "x"), layout="k int, v string, own string"), main, ["k"], cfg)
    source = table(spark, (1, "A", 1.0), (2, "B", 2.0), layout="k int, v string, extra double")
    tables.publish_merge(source, main, ["k"], cfg, how="common_columns")
    assert rows(spark.table(main)) == [(1, "A", "x"), (2, "B", None)]
    tables.publish_merge(source.where("k = 2"), main, ["k"], cfg, how="synced")
    assert rows(spark.table(main), "k", "v", "extra") == [(1, "A", None), (2, "B", 2.0)]
    assert "own" not in spark.table(main).columns
    tables.publish_merge(
        table(spark, (3, "C", None, "n"), layout="k int, v string, extra double, more string"),
        main, ["k"], cfg,
    )
    assert rows(spark.table(main), "k", "more") == [(1, None), (2, None), (3, "n")]


def test_append_once_per_run(spark, cfg, names):
    log = names["archive"]
    tables.append_run(table(spark, (1, D1, "a")), log, cfg)
    tables.append_run(table(spark, (1, D1, "a"), (2, D1, "b")), log, cfg)
    wider = table(spark, (3, D1, "c", 1), layout="k int, d date, v string, x int")
    tables.append_run(wider, log, replace(cfg, run_id="r2"))
    assert rows(spark.table(log), "archive_run_id", "k", "x") == [
        ("r1", 1, None), ("r1", 2, None), ("r2", 3, 1)]


def test_clustered_layout(spark, names):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit(D1).alias("d"))
    tables.write_clustered(df, names["main"], ["k"], files=4)
    spans = (
        spark.table(names["main"]).groupBy(F.input_file_name()).agg(F.min("k"), F.max("k")).collect()
    )
    ordered = sorted((r[1], r[2]) for r in spans)
    assert len(ordered) == 4
    assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:], strict=False))


def test_audited_steps(spark, cfg, names):
    log, main = names["log"], names["main"]
    count = tables.audited(
        spark, main, log, cfg, lambda: tables.create_table(table(spark, (1, D1, "a")), main)
    )

    def broken():
        raise RuntimeError("x" * 5000)

    with pytest.raises(RuntimeError):
        tables.audited(spark, main, log, cfg, broken)
    logged = spark.table(log).orderBy("status").collect()
    assert count == 1
    assert [(r["status"], r["rows_written"]) for r in logged] == [("FAILURE", 0), ("SUCCESS", 1)]
    assert logged[0]["error_message"].rstrip().endswith("RuntimeError: " + "x" * 5000)
    tables.append_log(tables.log_row(spark, "big", "SUCCESS", 3_000_000_000, cfg), log)
    assert spark.table(log).agg(F.max("rows_written")).first()[0] == 3_000_000_000


def test_merge_keeps_rows_without_partition_value(spark, cfg, names):
    main = names["main"]
    tables.publish_merge(table(spark, (1, None, "a"), (2, None, "b"), (3, D1, "c")), main, ["k"], cfg, "d")
    tables.publish_merge(table(spark, (4, None, "d"), (2, None, "B")), main, ["k"], cfg, "d")
    assert rows(spark.table(main), "k", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_merge_prunes_any_number_of_partitions(spark, cfg, names):
    main = names["main"]
    days = spark.range(1500).select(F.col("id").alias("k"), F.date_add(F.lit(D1), F.col("id").cast("int")).alias("d"))
    with tables.staged(days, "many") as batch:
        target = batch.where("k < 1499")
        assert tables.touched_partitions(target, batch.where("k > 3"), "d").count() == 1495
    tables.create_table(days.limit(3), main, "d")


def test_merge_with_a_changed_type(spark, cfg, names):
    main = names["main"]
    tables.publish_merge(table(spark, (1, D1, 1.5), layout="k int, d date, x double"), main, ["k"], cfg, "d")
    odd = table(spark, (2, D1, "n/a"), (3, D1, "2.5"), layout="k int, d date, x string")
    tables.publish_merge(odd, main, ["k"], cfg, "d")
    assert rows(spark.table(main), "k", "x") == [(1, 1.5), (3, 2.5)]
    assert rows(spark.table(f"{main}_unreadable"), "k", "x", "archive_run_id") == [(2, "n/a", "r1")]


def test_staging_is_empty_after_a_merge(spark, cfg, names, tmp_path):
    from pathlib import Path

    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "staging"
    before = set(folder.glob("*")) if folder.exists() else set()
    main = names["main"]
    for day in (D1, D2):
        tables.publish_merge(table(spark, (1, day, "a"), (2, None, "b")), main, ["k"], cfg, "d")
    with pytest.raises(ValueError):
        tables.publish_merge(table(spark, (1, D1, "a"), (1, D1, "b")), main, ["k"], cfg, "d")
    assert set(folder.glob("*")) == before


def market_file(tmp_path, name, *entries):
    path = tmp_path / name
    path.mkdir()
    lines = [json.dumps({"id": i, "current_price": p, "market_cap": 1.0, "image": "u"}) for i, p in entries]
    (path / "part.json").write_text("\n".join(lines))
    return str(path)


def test_landed_market(spark, cfg, tmp_path):
    path = market_file(tmp_path, "m", ("a", 1.5), ("b", None))
    got = landing.land_market(landing.read_market(spark, path), replace(cfg, expected_entities=3))
    assert rows(got, "id", "current_price", "load_status", "coins_received", "ingestion_date") == [
        ("a", 1.5, "PARTIAL_LOAD_CRITICAL", 2, cfg.run_date),
        ("b", None, "PARTIAL_LOAD_CRITICAL", 2, cfg.run_date)]


def test_landed_candles(spark, cfg, tmp_path):
    (tmp_path / "o.json").write_text(
        json.dumps({"coin_id": "a", "ohlc": [[1704067200000, 1, 2, 0.5, 1.5], [1704081600000, 1, 1, 1, 1]]})
    )
    got = landing.land_ohlc(landing.read_ohlc(spark, str(tmp_path)), replace(cfg, expected_entities=1))
    assert rows(got, "timestamp_ms", "candle_datetime", "candle_date", "close", "load_status") == [
        (1704067200000, datetime(2024, 1, 1), D1, 1.5, "SUCCESS"),
        (1704081600000, datetime(2024, 1, 1, 4), D1, 1.0, "SUCCESS")]


def test_trending_without_score_ranks_first(spark):
    payload = json.dumps({"coins": [{"item": {"id": "a", "score": 3}}, {"item": {"id": "b"}}]})
    df = spark.createDataFrame([(payload,), ("{}",), (None,)], "payload string")
    got = landing.parse_trending(df, "payload")
    assert rows(got, "coin_id", "trending_rank") == [("a", 4), ("b", 1)]


def batch(spark, tmp_path, cfg, name, *entries):
    path = market_file(tmp_path, name, *entries)
    return landing.land_market(landing.read_market(spark, path), cfg)


def test_market_runs(spark, cfg, tmp_path, names):
    """Three days: complete, partial (completed with a stale row), failed (snapshot stands in)."""
    cfg = replace(cfg, expected_entities=5)
    ids = ["a", "b", "c", "d", "e"]
    expected = spark.createDataFrame([(i,) for i in ids], "id string")
    days = [replace(cfg, run_ts=datetime(2024, 1, d), run_id=f"r{d}") for d in (1, 2, 3)]

    def run(day, entries):
        return bronze.store_market(
            batch(spark, tmp_path, day, day.run_id, *entries), expected, names, day
        )

    assert run(days[0], [(i, 1.0) for i in ids]) == "SUCCESS"
    assert run(days[1], [(i, 2.0) for i in ids[:4]]) == "PARTIAL_LOAD"
    assert run(days[2], [("a", 3.0)]) == "PARTIAL_LOAD_SEVERE"
    main = spark.table(names["main"])
    assert rows(main.where("id IN ('a', 'e')"), "id", "ingestion_date", "current_price", "load_status") == [
        ("a", D1, 1.0, "SUCCESS"), ("a", D2, 2.0, "PARTIAL_LOAD"),
        ("a", D3, 2.0, "PARTIAL_LOAD_SEVERE"),
        ("e", D1, 1.0, "SUCCESS"), ("e", D2, 1.0, "STALE"),
        ("e", D3, 1.0, "PARTIAL_LOAD_SEVERE")]
    assert main.count() == 15
    assert rows(spark.table(names["quarantine"]), "id", "archive_run_id") == [("a", "r3")]
    assert spark.table(names["archive"]).count() == 14
    assert rows(spark.table(names["log"]), "ingestion_date", "status", "rows_written", "error_message") == [
        (D1, "SUCCESS", 5, ""), (D2, "PARTIAL_LOAD", 4, ""), (D3, "FALLBACK", 5, "PARTIAL_LOAD_SEVERE")]
    kinds = spark.table(names["schema_log"]).select("change_type").distinct()
    assert rows(kinds) == [("SCHEMA_INITIALISED",)]


def test_candle_runs(spark, cfg, names):
    cfg = replace(cfg, expected_entities=2)
    none = spark.createDataFrame([], "coin_id string")

    def candles(day, *entries):
        payload = [(c, [[float(t), p, p, p, p] for t, p in ps]) for c, ps in entries]
        return landing.land_ohlc(spark.createDataFrame(payload, landing.OHLC_SCHEMA), day)

    h = 14_400_000
    first = candles(cfg, ("a", [(0, 1.0), (h, 2.0)]), ("b", [(0, 5.0)]))
    assert bronze.store_ohlc(first, none, names, cfg) == "SUCCESS"
    spark.sql(f"SELECT 1 FROM {names['main']}")
    later = replace(cfg, run_id="r2", run_ts=datetime(2024, 2, 1))
    second = candles(later, ("a", [(h, 9.0), (2 * h, 3.0)]))
    failed = spark.createDataFrame([("b",)], "coin_id string")
    assert bronze.store_ohlc(second, failed, names, later) == "PARTIAL_LOAD_CRITICAL"
    assert rows(spark.table(names["main"]), "coin_id", "timestamp_ms", "close") == [
        ("a", 0, 1.0), ("a", h, 9.0), ("a", 2 * h, 3.0), ("b", 0, 5.0)]
    assert rows(spark.table(names["log"]), "status", "rows_written", "error_message") == [
        ("FALLBACK", 1, "archived candles"), ("PARTIAL_LOAD_CRITICAL", 2, ""), ("SUCCESS", 3, "")]


def test_stream_drains_landed_files(spark, cfg, tmp_path, names):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "1.json").write_text(json.dumps({"id": "a", "current_price": 1.0}))
    expected = spark.createDataFrame([("a",)], "id string")
    one = replace(cfg, expected_entities=1)

    def store(part, run):
        bronze.store_market(landing.land_market(part, run), expected, names, run)

    def drain():
        drain_landing(
            spark, str(folder), landing.MARKET_SCHEMA, str(tmp_path / "ck"), store, one
        ).awaitTermination(60)

    drain()
    (folder / "2.json").write_text(json.dumps({"id": "a", "current_price": 2.0}))
    drain()
    drain()
    assert rows(spark.table(names["main"]), "id", "current_price") == [("a", 2.0)]
    assert spark.table(names["archive"]).count() == 2


def test_publishing_is_idempotent_and_logs_gaps(spark, cfg, names):
    from candlewick.operators import dims
    from candlewick.plans import publish
    from candlewick.plans.silver import Facts

    main, log = names["main"], names["log"]
    clean = spark.createDataFrame([("a", D1, 1.0), ("b", None, 2.0)], "id string, ingestion_date date, x double")
    bad, stale = clean.where("id = 'a'"), clean.where("id = 'b'")
    for run in ("r1", "r1", "r2"):
        publish.store_facts(Facts(clean, bad, stale), main, publish.MARKET_KEYS, log, replace(cfg, run_id=run))
    assert rows(spark.table(main), "id", "x") == [("a", 1.0), ("b", 2.0)]
    assert rows(spark.table(f"{main}_quarantine"), "id", "quarantine_run_id") == [("a", "r1"), ("a", "r2")]
    assert spark.table(f"{main}_stale").count() == 2
    for _ in range(2):
        publish.store_dimension(clean, f"{main}_dim", log, cfg)
        publish.store_dimension(spark.table(f"{main}_dim"), f"{main}_dim", log, cfg)
    assert spark.table(f"{main}_dim").count() == 2
    members = dims.empty_universe(spark).unionByName(
        spark.createDataFrame([("a", D1)], "coin_id string, universe_date date"), allowMissingColumns=True
    )
    for _ in range(2):
        publish.store_universe(members, f"{main}_universe", log, cfg)
    assert spark.table(f"{main}_universe").count() == 1
    gaps = publish.log_gaps(spark, main, "ingestion_date", 30, log, cfg)
    logged = spark.table(log).where("status = 'BACKFILL_REQUIRED'").collect()
    assert len(gaps) == 29 and [(r["rows_written"], r["error_message"][:10]) for r in logged] == [(29, gaps[0])]


def test_use_database(spark):
    before = spark.catalog.currentDatabase()
    tables.use_database(spark, "candles_db")
    assert spark.catalog.currentDatabase() == "candles_db"
    spark.catalog.setCurrentDatabase(before)
