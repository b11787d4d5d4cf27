"""Market days whose price is zero: the change from them is infinite, as the oracle divides."""

import math
from datetime import datetime

import duckdb
import pytest

from contract import fixtures as fx
from contract.queries import REGISTRY

VALUES = [4.0, 0.0, 0.0, 2.0, 3.0]


@pytest.fixture
def zero_days(spark, tmp_path):
    rows = [
        (day, datetime(2024, 1, day, 6), user, "view", value if user == 1 else value + user, "{}")
        for user in (1, 2, 3)
        for day, value in enumerate(VALUES, 1)
    ]
    types = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, types).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_change_from_a_zero_price(spark, zero_days):
    days = fx.market_days(spark, zero_days).where("id = '1'").orderBy("ingestion_date")
    got = [r.price_change_percentage_24h for r in days.select("price_change_percentage_24h").collect()]
    assert got[0] is None and got[1] == -100.0 and math.isnan(got[2])
    assert got[3] == math.inf and got[4] == 50.0


@pytest.mark.parametrize("name", ["price_winsor", "change_flag"])
def test_every_day_is_returned(spark, zero_days, name):
    assert REGISTRY[name][0](spark, zero_days).count() == 3 * len(VALUES)


def test_landed_days_equal_the_oracle(spark, zero_days):
    run, sql = REGISTRY["landed_market"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{zero_days}/events.parquet/*.parquet'")
    df = run(spark, zero_days)
    names = sorted(df.columns)
    res = con.execute(sql)
    at = [[d[0] for d in res.description].index(n) for n in names]
    want = sorted(str([row[i] for i in at]) for row in res.fetchall())
    assert sorted(str([row[n] for n in names]) for row in df.collect()) == want
