"""Every query of market days on rows after a day whose price is zero, against values worked out by hand."""

from datetime import datetime
from math import inf

import pytest

from candlewick.functions.numeric import mean_of
from contract.fixtures import CFG
from contract.queries import REGISTRY

DAYS = [f"2024-01-{day}" for day in range(26, 31)]
VALUES = [4.0, 0.0, 0.0, 2.0, 3.0]
# of user 1: day 28 has 0 / 0, day 29 follows a zero price
RETURNS = [0.0, -100.0, 0.0, inf, 50.0]
STREAKS = [(1, "LOSING"), (2, "LOSING"), (3, "LOSING"), (1, "GAINING"), (2, "GAINING")]
SOUND = [("1", DAYS[0]), ("1", DAYS[3]), ("1", DAYS[4]), *[(user, day) for user in "23" for day in DAYS]]


@pytest.fixture
def zero_days(spark, tmp_path):
    rows = [
        (day, datetime(2024, 1, 26 + day, 6), user, "view", value if user == 1 else value + user, "{}")
        for user in (1, 2, 3)
        for day, value in enumerate(VALUES)
    ]
    return rows, str(tmp_path)


def found(spark, zero_days, name, *columns, more=()):
    rows, path = zero_days
    types = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame([*rows, *more], types).coalesce(1).write.parquet(f"{path}/events.parquet")
    return [tuple(r) for r in REGISTRY[name][0](spark, path).select(*columns).collect()]


def of_first(rows):
    return [r[2:] for r in sorted(rows) if r[0] == "1"]


def test_mean_of_infinite_values_is_that_of_doubles(spark):
    for values, want in (([1.0, 2.0, None], 1.5), ([1.0, inf, None], inf), ([inf, -inf], None)):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        got = df.agg(mean_of(df.x, CFG)).first()[0]
        assert got == want or want is None and got != got


def test_market_summary(spark, zero_days):
    columns = "ingestion_date", "avg_price_change_pct", "max_gain_pct", "gainers_count", "losers_count"
    assert sorted(found(spark, zero_days, "market_summary", *columns))[1:] == [
        (DAYS[1], -74.603, -57.143, 0, 3),
        (DAYS[2], 0.0, 0.0, 0, 0),
        (DAYS[3], inf, inf, 3, 0),
        (DAYS[4], 31.667, 50.0, 3, 0),
    ]


def test_landed_market(spark, zero_days):
    columns = "id", "ingestion_date", "current_price", "coins_received"
    rows = found(spark, zero_days, "landed_market", *columns)
    assert len(rows) == 15 and sorted(r[2] for r in rows if r[0] == "1") == sorted(VALUES)
    assert {r[3] for r in rows} == {3}


def test_leaderboard(spark, zero_days):
    columns = "gainer_rank", "loser_rank", "streak_days", "streak_direction"
    rows = of_first(found(spark, zero_days, "leaderboard", "id", "ingestion_date", *columns))
    assert rows == [r + s for r, s in zip([(1, 1), (3, 1), (1, 1), (1, 3), (1, 3)], STREAKS, strict=True)]


def test_latest_summary_days(spark, zero_days):
    columns = "ingestion_date", "market_sentiment", "top_gainer_coin", "top_loser_coin"
    assert sorted(found(spark, zero_days, "latest_summary_days", *columns)) == [
        (DAYS[2], "NEUTRAL", "1", "1"), (DAYS[3], "VERY_BULLISH", "1", "3"), (DAYS[4], "VERY_BULLISH", "1", "3"),
    ]


def test_leaderboard_hot_day(spark, zero_days):
    columns = "gainer_rank", "loser_rank", "streak_days", "streak_direction"
    rows = of_first(found(spark, zero_days, "leaderboard_hot_day", "id", "ingestion_date", *columns))
    assert rows == [r + s for r, s in zip([(1, 1), (3, 1), (1, 1), (1, 3), (1, 3)], STREAKS, strict=True)]


def test_market_leaders(spark, zero_days):
    columns = "ingestion_date", "top_gainer_coin", "top_gainer_pct", "top_loser_coin", "top_loser_pct"
    assert sorted(found(spark, zero_days, "market_leaders", *columns))[1:] == [
        (DAYS[1], "3", -57.143, "1", -100.0),
        (DAYS[2], "1", 0.0, "1", 0.0),
        (DAYS[3], "1", inf, "3", 66.667),
        (DAYS[4], "1", 50.0, "3", 20.0),
    ]


def test_market_features(spark, zero_days):
    rows = found(spark, zero_days, "market_features", "id", "ingestion_date", "daily_return_pct", "price_lag_2")
    assert len(rows) == 15
    assert of_first(rows) == list(zip(RETURNS, [None, None, *VALUES[:3]], strict=True))


def test_market_snapshot(spark, zero_days):
    columns = "id", "current_price", "price_change_percentage_24h", "daily_return_pct", "ma_3"
    assert sorted(found(spark, zero_days, "market_snapshot", *columns)) == [
        ("1", 3.0, 50.0, 50.0, 1.6667), ("2", 5.0, 25.0, 25.0, 3.6667), ("3", 6.0, 20.0, 20.0, 4.6667),
    ]


def test_price_winsor(spark, zero_days):
    columns = "id", "ingestion_date", "price_change_percentage_24h", "price_change_pct_24h_capped"
    rows = found(spark, zero_days, "price_winsor", *columns)
    assert len(rows) == 15 and of_first(rows) == [(r, r) for r in RETURNS]


def test_published_quarantine(spark, zero_days):
    rows = found(spark, zero_days, "published_quarantine", "id", "ingestion_date")
    assert sorted((i, str(day)) for i, day in rows) == [("1", DAYS[1]), ("1", DAYS[2])]


def test_published_performance(spark, zero_days):
    columns = "gainer_rank", "loser_rank", "streak_days", "streak_direction"
    rows = of_first(found(spark, zero_days, "published_performance", "id", "ingestion_date", *columns))
    assert rows == [r + s for r, s in zip([(1, 1), (3, 1), (1, 1), (1, 3), (1, 3)], STREAKS, strict=True)]


def test_published_silver_market(spark, zero_days):
    rows = found(spark, zero_days, "published_silver_market", "id", "ingestion_date", "current_price")
    assert sorted(r[:2] for r in rows) == SOUND and of_first(rows) == [(4.0,), (2.0,), (3.0,)]


def test_published_snapshot(spark, zero_days):
    columns = "id", "current_price", "price_change_percentage_24h", "daily_return_pct", "ma_3"
    assert sorted(found(spark, zero_days, "published_snapshot", *columns)) == [
        ("1", 3.0, 50.0, 50.0, 1.6667), ("2", 5.0, 25.0, 25.0, 3.6667), ("3", 6.0, 20.0, 20.0, 4.6667),
    ]


def test_published_stale(spark, zero_days):
    # seventeen events a day: carried forward
    more = [(100 + i, datetime(2024, 1, 26 + i // 17, 6), 4, "view", float(i // 17), "{}") for i in range(34)]
    rows = found(spark, zero_days, "published_stale", "id", "ingestion_date", more=more)
    assert sorted((i, str(day)) for i, day in rows) == [("4", DAYS[0]), ("4", DAYS[1])]


def test_published_summary(spark, zero_days):
    columns = "ingestion_date", "avg_price_change_pct", "top_gainer_coin", "top_loser_coin"
    assert sorted(found(spark, zero_days, "published_summary", *columns))[1:] == [
        (DAYS[1], -74.603, "3", "1"), (DAYS[2], 0.0, "1", "1"), (DAYS[3], inf, "1", "3"), (DAYS[4], 31.667, "1", "3"),
    ]


def test_silver_market(spark, zero_days):
    rows = found(spark, zero_days, "silver_market", "id", "ingestion_date", "current_price")
    assert sorted(r[:2] for r in rows) == SOUND and of_first(rows) == [(4.0,), (2.0,), (3.0,)]


def test_streaks_long_series(spark, zero_days):
    rows = found(spark, zero_days, "streaks_long_series", "id", "ingestion_date", "streak_days", "streak_direction")
    assert len(rows) == 15 and of_first(rows) == STREAKS


def test_streaks(spark, zero_days):
    rows = found(spark, zero_days, "streaks", "id", "ingestion_date", "streak_days", "streak_direction")
    assert len(rows) == 15 and of_first(rows) == STREAKS


def test_top_by_rank(spark, zero_days):
    assert found(spark, zero_days, "top_by_rank", "id", "market_cap_rank") == [("3", 1), ("2", 2), ("1", 3)]


def test_top_movers(spark, zero_days):
    rows = found(spark, zero_days, "top_movers", "board", "id", "price_change_percentage_24h", "streak_days")
    assert sorted(rows) == sorted(
        (board, *row) for board in ("gainer_rank", "loser_rank") for row in (("1", 50.0, 2), ("2", 25.0, 2), ("3", 20.0, 2))
    )


def test_top_by_score(spark, zero_days):
    assert sorted(found(spark, zero_days, "top_by_score", "id")) == [("1",), ("2",), ("3",)]
