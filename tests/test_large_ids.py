"""User ids are longs: queries of market days on ids that no int holds, and on ids whose products it cannot hold."""

from datetime import datetime

import pytest

from contract import fixtures as fx
from contract.queries import REGISTRY

# multiples of 5, 7 and 20, by which the inputs tell users apart
FIRST = (3_500_000_000, 7_000_000, 9_223_372_036_854_775_660)
VALUES = [4.0, 0.0, 0.0, 2.0, 3.0]
# rows of five days of three users, of which one has two days at price zero
ROWS = {
    "landed_market": 15, "leaderboard": 15, "latest_summary_days": 3, "leaderboard_hot_day": 15, "market_leaders": 5,
    "market_features": 15, "market_snapshot": 3, "price_winsor": 15, "published_quarantine": 2,
    "published_performance": 15, "published_silver_market": 13, "published_snapshot": 3, "published_stale": 0,
    "published_summary": 5, "silver_market": 13, "streaks_long_series": 15, "streaks": 15, "top_by_rank": 3,
    "top_movers": 6, "top_by_score": 3,
}


def events(spark, path, first):
    rows = [
        (day, datetime(2024, 1, 26 + day, 6), first + user, "view", value if user == 1 else value + user, "{}")
        for user in (1, 2, 3)
        for day, value in enumerate(VALUES)
    ]
    types = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, types).coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    return events(spark, tmp_path_factory.mktemp("large"), FIRST[0])


@pytest.mark.parametrize("name", ROWS)
def test_query_of_large_ids(spark, large, name):
    rows = REGISTRY[name][0](spark, large).collect()
    assert len(rows) == ROWS[name]
    users = {1} if name == "published_quarantine" else {1, 2, 3}
    if rows and "id" in rows[0]:
        assert {r.id for r in rows} == {str(FIRST[0] + user) for user in users}


@pytest.mark.parametrize("first", FIRST)
def test_market_days_of_large_ids(spark, tmp_path, first):
    days = fx.market_days(spark, events(spark, tmp_path, first)).where(f"id = '{first + 2}'").collect()
    assert len(days) == len(VALUES)
    for row in days:
        units = float(first + 2) + 1
        assert row.total_supply == units * 1000
        assert row.max_supply == (units * 1000 if (first + 2) % 7 else None)
        assert row.circulating_supply == units * 820
        assert row.market_cap == row.current_price * units * 997
