from dataclasses import replace
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from candlewick.functions import labels
from candlewick.operators import clean, load, pick

MARKET = (
    "id string, ingestion_date date, ingestion_timestamp timestamp, current_price double, "
    "pipeline_run_id string, load_status string, is_fallback boolean, coins_expected int, "
    "coins_received int"
)


def market(spark, *entries):
    """(id, day of January, price, status)"""
    return spark.createDataFrame(
        [
            (i, date(2024, 1, d), datetime(2024, 1, d, 12), p, "r0", s, False, 2, 2)
            for i, d, p, s in entries
        ],
        MARKET,
    )


@pytest.mark.parametrize(
    ("received", "grade"),
    [(21, "SUCCESS"), (20, "SUCCESS"), (16, "PARTIAL_LOAD"), (15, "PARTIAL_LOAD_CRITICAL"),
     (10, "PARTIAL_LOAD_CRITICAL"), (9, "PARTIAL_LOAD_SEVERE"), (2, "PARTIAL_LOAD_SEVERE"),
     (1, "FAILURE"), (0, "FAILURE")],
)
def test_grades(spark, cfg, received, grade):
    got = spark.range(1).select(labels.load_grade(F.lit(received), 20, cfg)).first()[0]
    assert got == grade


def test_keep_first_and_conflicts(spark):
    listed = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 7.0), ("b", 4, 1.0), ("b", 5, 1.0), ("c", 6, None),
         ("c", 7, 2.0), ("d", 8, None), ("d", 9, None), ("e", 10, 3.0)],
        "id string, arrival int, price double",
    )
    kept = pick.first_per_key(listed, ["id"], [F.col("arrival")])
    assert rows(kept, "id", "arrival") == [("a", 1), ("b", 4), ("c", 6), ("d", 8), ("e", 10)]
    report = pick.dedup_conflicts(listed, ["id"], ["arrival"], "price")
    assert rows(report, "id", "kept_price", "is_conflict") == [
        ("a", 5.0, True), ("b", 1.0, False), ("c", None, True), ("d", None, False)]


def test_fill_slots_takes_the_missing_count_in_order(spark, cfg):
    kept = spark.createDataFrame([(1, "a", 1)], "batch int, id string, place int")
    more = spark.createDataFrame(
        [(1, "a", 1), (1, "x", 2), (1, "y", 3), (1, "z", 4)], "batch int, id string, place int"
    )
    got = pick.fill_slots(kept, more, "batch", "id", "place", replace(cfg, expected_entities=3))
    assert rows(got, "id") == [("a",), ("x",), ("y",)]


def test_stale_reconcile_single_batch(spark, cfg):
    known = market(spark, ("a", 28, 1.0, "SUCCESS"), ("b", 28, 2.0, "SUCCESS"),
                   ("b", 29, 3.0, "STALE"), ("c", 29, 9.0, "SUCCESS"))
    incoming = market(spark, ("a", 30, 4.0, "PARTIAL_LOAD"))
    expected = spark.createDataFrame([("a",), ("b",), ("never-seen",)], "id string")
    got = load.reconcile_stale(incoming, known, expected, cfg)
    assert rows(got, "id", "current_price", "load_status", "is_fallback", "coins_received",
                "ingestion_date", "pipeline_run_id") == [
        ("b", 3.0, "STALE", True, 1, date(2024, 1, 31), "r1")]


def test_carry_forward_equals_batch_by_batch(spark, cfg):
    graded = market(
        spark, ("a", 1, 1.0, "SUCCESS"), ("b", 1, 2.0, "SUCCESS"), ("a", 2, 3.0, "PARTIAL_LOAD"),
        ("b", 3, 9.0, "FAILURE"), ("a", 4, 5.0, "PARTIAL_LOAD_CRITICAL"),
    )
    expected = spark.createDataFrame([("a",), ("b",)], "id string")
    got = load.carry_forward(graded, expected, cfg)
    day = F.dayofmonth("ingestion_date")
    assert rows(got.select("id", day, "current_price", F.dayofmonth("known_date"))) == [
        ("b", 2, 2.0, 1), ("b", 4, 2.0, 1)]


def test_fallback_uses_the_last_good_day(spark, cfg):
    graded = market(spark, ("a", 1, 1.0, "SUCCESS"), ("a", 2, 2.0, "PARTIAL_LOAD_SEVERE"),
                    ("a", 3, 3.0, "FAILURE"), ("a", 4, 4.0, "SUCCESS"))
    got = load.fallback_days(graded, cfg)
    assert rows(got.select(F.dayofmonth("ingestion_date"), "current_price", "load_status")) == [
        (2, 1.0, "PARTIAL_LOAD_SEVERE"), (3, 1.0, "FAILURE")]
    main, quarantine = load.route_severe(graded)
    assert (main.count(), quarantine.count()) == (2, 2)
    main, quarantine = load.route_severe(graded, mode="keep")
    assert (main.count(), quarantine.count()) == (4, 1)


def test_recent_gaps(spark, cfg):
    table = market(spark, ("a", 30, 1.0, "S"), ("a", 28, 1.0, "S"), ("a", 1, 1.0, "S"))
    got = load.missing_recent_days(table, "ingestion_date", 3, cfg)
    assert rows(got) == [(date(2024, 1, 29),)]


def test_missing_status_is_fresh(spark):
    df = spark.createDataFrame([(1, None), (2, "STALE"), (3, "SUCCESS")], "k int, load_status string")
    fresh, stale = clean.split_fresh_stale(df)
    assert rows(fresh, "k") == [(1,), (3,)]
    assert rows(stale, "k", "stale_reason") == [(2, "bronze_partial_load")]
    fresh, stale = clean.split_fresh_stale(df.drop("load_status"))
    assert (fresh.count(), stale.count()) == (3, 0)


def test_quality_flag_per_grade(spark):
    grades = ["SUCCESS", "PARTIAL_LOAD", "PARTIAL_LOAD_CRITICAL", "PARTIAL_LOAD_SEVERE", None]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(grades)], "i int, g string")
    got = df.orderBy("i").select(labels.data_quality_flag(F.col("g"))).collect()
    assert [r[0] for r in got] == [None, "WARN_PARTIAL", "WARN_CRITICAL", None, None]


def test_rows_without_a_day_are_graded(spark, cfg):
    rows_in = spark.createDataFrame([("a", date(2024, 1, 1)), ("b", None)], "id string, ingestion_date date")
    got = load.with_grade(rows_in, replace(cfg, expected_entities=1))
    assert rows(got, "id", "coins_received", "load_status") == [("a", 1, "SUCCESS"), ("b", 1, "SUCCESS")]


def test_fallback_across_a_century(spark, cfg):
    graded = spark.createDataFrame(
        [("a", date(2099, 12, 31), "SUCCESS"), ("a", date(2100, 1, 1), "FAILURE")],
        "id string, ingestion_date date, load_status string",
    )
    got = load.fallback_days(graded, cfg)
    assert rows(got, "id", "ingestion_date", "known_date") == [("a", date(2100, 1, 1), date(2099, 12, 31))]
