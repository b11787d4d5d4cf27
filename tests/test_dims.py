from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from candlewick.operators import asof, dims, market, merge

SNAP = (
    "id string, symbol string, name string, market_cap_rank int, circulating_supply double, "
    "total_supply double, max_supply double, ath_change_percentage double, ingestion_date date, "
    "ingestion_timestamp timestamp"
)

D1 = date(2024, 1, 1)


def snaps(spark, *entries):
    """(id, day of January, rank)"""
    return spark.createDataFrame(
        [
            (i, "s", "n", rank, 95.0, 100.0, 100.0, -1.0, date(2024, 1, d), datetime(2024, 1, d))
            for i, d, rank in entries
        ],
        SNAP,
    )


HISTORY = (("a", 1, None), ("a", 2, 5), ("a", 3, 5), ("a", 4, None), ("a", 5, 60),
           ("b", 1, 1), ("b", 2, 2), ("b", 3, 1), ("c", 4, 300))


def test_attributes(spark):
    got = dims.dim_attributes(snaps(spark, ("a", 1, 10), ("b", 1, 11), ("c", 1, 201), ("d", 1, None)))
    assert rows(got, "id", "market_segment", "is_scarce", "ath_distance_bucket") == [
        ("a", "Top_10", True, "AT_ATH"), ("b", "Top_50", True, "AT_ATH"),
        ("c", "Long_Tail", True, "AT_ATH"), ("d", "Long_Tail", True, "AT_ATH")]


def test_supply_without_maximum_is_unknown(spark):
    df = spark.createDataFrame(
        [(5.0, None), (5.0, 0.0), (5.0, 10.0), (9.0, 10.0)], "c double, m double"
    )
    from candlewick.functions import labels

    used = labels.supply_utilisation_pct(F.col("c"), F.col("m"))
    assert rows(df.select(used, labels.is_scarce(used))) == [
        (50.0, False), (90.0, True), (None, False), (None, False)]


def test_history_equals_daily_steps(spark):
    everything = dims.dim_attributes(snaps(spark, *HISTORY))
    whole = dims.scd2_history(everything)
    stepped = None
    for day in range(1, 6):
        batch = dims.dim_source(snaps(spark, *[h for h in HISTORY if h[1] == day]))
        stepped = dims.scd2_init(batch) if stepped is None else dims.scd2_step(stepped, batch)
    assert rows(whole, *dims.DIM_COLUMNS) == rows(stepped, *dims.DIM_COLUMNS)
    assert asof.overlapping_versions(whole).count() == 0
    assert whole.select("coin_sk").distinct().count() == whole.count()
    assert rows(dims.current_versions(whole), "id", "scd_version") == [("a", 4), ("b", 3), ("c", 1)]


def test_same_day_rerun_and_absent_entity(spark):
    first = dims.scd2_init(dims.dim_source(snaps(spark, ("a", 1, 1), ("b", 1, 2))))
    rerun = dims.scd2_step(first, dims.dim_source(snaps(spark, ("a", 1, 1))))
    assert rows(rerun, *dims.DIM_COLUMNS) == rows(first, *dims.DIM_COLUMNS)
    changed = dims.scd2_step(first, dims.dim_source(snaps(spark, ("a", 1, 7))))
    assert rows(changed, "id", "scd_version", "effective_from", "effective_to", "is_current") == [
        ("a", 1, date(2024, 1, 1), date(2024, 1, 1), False),
        ("a", 2, date(2024, 1, 1), None, True), ("b", 1, date(2024, 1, 1), None, True)]


def test_asof_keeps_one_row_per_fact_over_months(spark):
    versions = [("a", date(2023, 12, 30), date(2024, 1, 2), 1), ("a", date(2024, 1, 2), date(2024, 3, 1), 2), ("a", date(2024, 3, 1), None, 3)]
    dim = spark.createDataFrame([(i, f, t, n, n) for i, f, t, n in versions], "id string, effective_from date, effective_to date, scd_version int, coin_sk int")
    facts = spark.createDataFrame([("a", date(2023, 12, 29)), ("a", date(2023, 12, 31)), ("a", date(2024, 1, 2)), ("a", date(2024, 2, 29)), ("a", date(2030, 1, 1)), ("b", D1)], "id string, d date")
    got = asof.asof_join(facts, asof.require_versions(dim), "id", "d", ("coin_sk",))
    assert rows(got, "d", "coin_sk") == sorted([(date(2023, 12, 29), None), (date(2023, 12, 31), 1), (date(2024, 1, 2), 2), (date(2024, 2, 29), 2), (date(2030, 1, 1), 3), (D1, None)], key=lambda r: tuple(map(str, r)))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_month" in plan and plan.count("Join LeftOuter") == 2
    clash = dim.union(spark.createDataFrame([("a", date(2024, 2, 1), None, 4, 4)], dim.schema))
    with pytest.raises(ValueError, match="overlapping"):
        asof.require_versions(clash)


def test_asof_bounds(spark):
    dim = dims.scd2_history(dims.dim_attributes(snaps(spark, ("a", 10, 1), ("a", 20, 40))))
    facts = spark.createDataFrame([("a", date(2024, 1, d)) for d in (9, 10, 19, 20, 31)], "id string, d date")
    got = asof.asof_join(facts, dim, "id", "d")
    assert rows(got.select(F.dayofmonth("d"), "market_segment")) == [
        (10, "Top_10"), (19, "Top_10"), (20, "Top_50"), (31, "Top_50"), (9, None)]
    asof.require_grain(dim, ["id", "scd_version"])
    with pytest.raises(ValueError):
        asof.require_grain(dim, ["id"])


@pytest.mark.parametrize("start", [date(2020, 1, 1), date(2023, 1, 1), date(2021, 1, 3)])
def test_calendar_matches_the_standard_library(spark, cfg, start):
    facts = spark.createDataFrame([(start,)], "d date")
    end = replace(cfg, run_ts=datetime(2024, 12, 30))
    got = {r["date_id"]: r for r in dims.dim_date(dims.calendar_days(facts, "d", end), end).collect()}
    assert len(got) == (end.run_date + timedelta(days=90) - start).days + 1
    for offset in range(0, len(got), 17):
        d = start + timedelta(days=offset)
        row = got[int(d.strftime("%Y%m%d"))]
        assert (row["week_of_year"], row["year_week"]) == (int(d.strftime("%W")), d.strftime("%Y-W%W"))
        assert (row["day_name"], row["month_abbr"], row["day_of_year"]) == (
            d.strftime("%A"), d.strftime("%b"), d.timetuple().tm_yday)
        assert row["is_weekend"] == (d.isoweekday() >= 6)


def test_hours(spark, cfg):
    facts = spark.createDataFrame([(date(2024, 4, 30),)], "d date")
    hours = dims.dim_date_hour(dims.calendar_days(facts, "d", cfg), cfg)
    by_session = dict(rows(hours.groupBy("trading_session").count()))
    assert by_session == {"ASIA": 8, "LONDON": 5, "NY": 8, "OFF": 3}
    assert rows(dims.candle_open_hours(hours), "hour") == [(0,), (12,), (16,), (20,), (4,), (8,)]


def test_universe_day_and_history(spark, cfg):
    status = F.when(F.col("id") == "s", "STALE").otherwise("SUCCESS")
    bronze = snaps(spark, ("a", 30, 1), ("b", 30, 2), ("a", 31, 1), ("s", 31, 3)).withColumn(
        "load_status", status
    )
    dim = dims.scd2_history(dims.dim_attributes(snaps(spark, ("b", 1, 9), ("b", 2, 2))))
    day_before = dims.universe_history(bronze.where("ingestion_date < '2024-01-31'"), dim)
    today = dims.universe_day(bronze, day_before, dim, cfg)
    assert rows(today, "coin_id", "is_active", "entry_reason", "market_cap_rank") == [
        ("a", True, "in_top_n", 1), ("b", False, "exited_top_n", 2)]
    whole = dims.universe_history(bronze, dim)
    assert rows(whole.where("universe_date = '2024-01-31'"), *dims.UNIVERSE_COLUMNS) == rows(
        today, *dims.UNIVERSE_COLUMNS
    )
    upserted = merge.merge_upsert(day_before, today, ["coin_id", "universe_date"])
    assert rows(upserted, *dims.UNIVERSE_COLUMNS) == rows(whole, *dims.UNIVERSE_COLUMNS)
    assert rows(market.tenure(whole)) == [("a", 2), ("b", 1)]


def test_optional_universe_columns(spark, cfg):
    universe = spark.createDataFrame(
        [("a", cfg.run_date, 7)], "coin_id string, universe_date date, confidentiality_score int"
    )
    got = dims.dim_source(snaps(spark, ("a", 1, 1), ("b", 1, 2)), universe, cfg)
    assert rows(got, "id", "confidentiality_score", "data_transparency_tier") == [
        ("a", 7, None), ("b", None, None)]
