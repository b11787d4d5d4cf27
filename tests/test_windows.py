"""Series, ranks, quantiles and indicators, plain against the paths for large groups."""

import math
import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from conftest import rows

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.operators import indicators, ranking, series
from candlewick.operators.quantiles import quantiles
from candlewick.operators.rolling import with_rolling
from candlewick.plans import gold

START = datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def candles(spark):
    """One coin with two thirds of all rows, gaps, and short histories."""
    draw = random.Random(7)
    out = []
    for coin, slots, share in (("hot", 3000, 0.9), ("thin", 3000, 0.05), ("new", 90, 1.0)):
        for slot in range(slots):
            if draw.random() < share:
                o, c = round(draw.uniform(5, 50), 2), round(draw.uniform(5, 50), 2)
                out.append((coin, START + timedelta(hours=4 * slot), o, max(o, c) + 1, min(o, c) - 1, c))
    return spark.createDataFrame(
        out, "coin_id string, candle_datetime timestamp, open double, high double, low double, close double"
    ).cache()


@pytest.mark.parametrize("chunk", [180, 400, 1000])
def test_chunked_series_equal_whole_series(candles, cfg, chunk):
    exact = replace(cfg, exact_scale=4)
    plain = indicators.candle_features(candles, exact)
    cut = indicators.candle_features(candles, replace(exact, series_chunk_rows=chunk))
    assert rows(cut, *plain.columns) == rows(plain)


def test_chunks_hold_every_row_once_and_stay_small(candles):
    parts = series.split_series(candles, "coin_id", "candle_datetime", 100, 400)
    own = parts.where("NOT _halo")
    assert own.count() == candles.count()
    biggest = parts.groupBy("coin_id", "_chunk").count().agg(F.max("count")).first()[0]
    assert biggest < 400 + 2 * 31 * 6 + 100
    with pytest.raises(ValueError):
        series.split_series(candles, "coin_id", "candle_datetime", 100, 99)


def test_other_indicators_chunked(candles, cfg):
    exact = replace(cfg, exact_scale=4)
    small = replace(exact, series_chunk_rows=200)
    for step in (indicators.average_true_range, indicators.relative_strength, indicators.bollinger):
        plain = step(candles, exact)
        assert rows(step(candles, small), *plain.columns) == rows(plain)


@pytest.mark.parametrize("scale", [1.0, 1e-6, 1e-11, 1e9])
def test_rolling_statistics_equal_sliding_frames(spark, candles, scale):
    values = candles.select(
        "coin_id", "candle_datetime",
        F.when(F.dayofmonth("candle_datetime") != 3, F.col("close") * scale).alias("x"),
    )
    w = Window.partitionBy("coin_id").orderBy("candle_datetime")
    plain = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wanted = {f"{kind}_{rows}": (kind, "x", rows) for kind in plain for rows in (0, 2, 15, 41, 300)}
    both = with_rolling(values, w, wanted).withColumns(
        {f"want_{n}": plain[kind]("x").over(w.rowsBetween(-rows, 0)) for n, (kind, _, rows) in wanted.items()}
    )
    worse = [
        F.sum(F.when(F.abs(F.col(n) - F.col(f"want_{n}")) <= scale * 1e-7, 0).when(
            F.col(n).isNull() & F.col(f"want_{n}").isNull(), 0).otherwise(1)).alias(n)
        for n in wanted
    ]
    assert both.agg(*worse).first().asDict() == dict.fromkeys(wanted, 0)


def test_rolling_sums_of_decimals_are_exact(spark):
    """Sixteen prices whose mean lies half way between two published values."""
    prices = [59.3, 59.4, 59.27, 59.31] * 3 + [59.29, 59.28, 59.33, 59.4]
    assert sum(round(p * 100) for p in prices) * 10 % 16 != 0
    df = spark.createDataFrame([("a", i, p) for i, p in enumerate(prices)], "k string, t int, x double")
    w = Window.partitionBy("k").orderBy("t")
    got = with_rolling(df, w, {"m": ("mean", "x", 41)}).orderBy(F.desc("t")).first()["m"]
    assert got == sum(round(p * 100) for p in prices) / 100 / 16


def test_rolling_of_odd_values(spark):
    rows_in = [("a", 0, None), ("a", 1, float("inf")), ("a", 2, 1e300), ("b", 0, 1e-300), ("b", 1, None), ("b", 2, 3e-300)]
    df = spark.createDataFrame(rows_in, "k string, t int, x double")
    w = Window.partitionBy("k").orderBy("t")
    found = with_rolling(df, w, {"m": ("mean", "x", 41), "d": ("std", "x", 41)}).orderBy("k", "t").collect()
    assert [r["m"] for r in found] == [None, math.inf, math.inf, 1e-300, 1e-300, 2e-300]
    assert found[0]["d"] is None and found[3]["d"] is None and found[4]["d"] is None
    assert with_rolling(df.limit(0), w, {"m": ("mean", "x", 41)}).count() == 0


def test_one_row_has_no_deviation(spark, cfg):
    one = spark.createDataFrame(
        [("a", START, 1.0, 2.0, 1.0, 2.0)],
        "coin_id string, candle_datetime timestamp, open double, high double, low double, close double",
    )
    for c in (cfg, replace(cfg, exact_scale=4)):
        row = indicators.candle_features(one, c).first()
        assert row["volatility_7d"] is None
        assert row["ma_7d"] == 2.0
        assert row["recommendation_score"] is None


def test_momentum_reaches_41_rows_back(spark, cfg):
    df = spark.createDataFrame(
        [("a", START + timedelta(hours=4 * i), float(i + 1)) for i in range(43)],
        "coin_id string, candle_datetime timestamp, close double",
    )
    got = indicators.momentum(df, cfg).orderBy("candle_datetime").collect()
    assert [r["momentum_7d"] for r in got[:41]] == [None] * 41
    assert got[41]["momentum_7d"] == 4100.0
    assert got[1]["momentum_1d"] == 100.0


@pytest.mark.parametrize("period", ["day", "hour"])
def test_streaks_of_a_long_history_equal_the_plain_form(spark, period):
    """All rows of a key in one month; runs that fill several periods, NULL flags, a NULL key."""
    draw = random.Random(3)
    data = []
    for k, stay in (("hot", 0.995), ("calm", 1.0), ("wild", 0.5), (None, 0.98)):
        gain = True
        for i in range(2500):
            gain = gain if draw.random() < stay else not gain
            data.append((k, START + timedelta(minutes=17 * i), None if draw.random() < 0.01 else gain))
    df = spark.createDataFrame(data, "k string, t timestamp, gain boolean")
    plain = series.streaks(df, "k", "t", "gain")
    cut = series.streaks(df, "k", "t", "gain", period=period)
    assert cut.columns == plain.columns
    assert rows(cut) == rows(plain)


def test_streaks(spark, cfg):
    returns = [1.0, 2.0, -1.0, 0.0, None, 1.0, 1.0]
    df = spark.createDataFrame(
        [("a", date(2024, 1, i + 1), r) for i, r in enumerate(returns)], "id string, d date, r double"
    ).withColumn("gain", F.coalesce(F.col("r") > 0, F.lit(False)))
    got = series.streaks(df, "id", "d", "gain").orderBy("d").collect()
    assert [r["streak_days"] for r in got] == [1, 2, 1, 2, 3, 1, 2]


RANKS = {"down": ("v", "desc"), "up": ("v", "asc"), "share": ("v", "percent"), "other": ("w", "desc")}


def test_bucketed_ranks_equal_window_ranks(spark, cfg):
    draw = random.Random(3)
    entries = [
        (draw.choice(["hot"] * 8 + ["cold"]), draw.choice([0.0, 0.0, None, round(draw.gauss(0, 9), 1)]),
         draw.gauss(0, 1)) for _ in range(4000)
    ] + [("single", 5.0, None), (None, 1.0, 1.0)]
    df = spark.createDataFrame(entries, "d string, v double, w double").cache()
    plain = ranking.add_ranks(df, "d", RANKS, cfg, hot=False)
    bucketed = ranking.add_ranks(df, "d", RANKS, cfg, hot=True)
    assert rows(bucketed, *plain.columns) == rows(plain)
    assert bucketed.where("d IS NULL").count() == 1


def test_plan_of_ranks_does_not_grow_with_metrics(spark, cfg):
    """As many scans and shuffles for eight metrics as for one."""
    values = [(F.col("id") * (3 + 2 * i) % 97).alias(f"m{i}") for i in range(8)]
    df = spark.range(500).select((F.col("id") % 3).alias("d"), *values)

    def plan(n):
        ranked = ranking.add_ranks(df, "d", {f"r{i}": (f"m{i}", "desc") for i in range(n)}, cfg)
        text = ranked._jdf.queryExecution().executedPlan().toString()
        return text.count("FileScan"), text.count("Exchange ")

    assert plan(8) == plan(1)


def test_ranks_of_a_day_with_many_rows(spark, cfg):
    df = spark.range(120_000).select(F.lit("one").alias("d"), (F.col("id") * 7919 % 60_000).cast("double").alias("v"))
    got = ranking.add_ranks(df, "d", {"up": ("v", "asc"), "down": ("v", "desc")}, cfg)
    wrong = got.where((F.col("up") != 2 * F.col("v") + 1) | (F.col("down") != 119_999 - 2 * F.col("v")))
    assert got.count() == 120_000 and wrong.count() == 0


@pytest.mark.parametrize("accuracy", [10, 100, 10_000])
def test_exact_quantiles_against_brute_force(spark, cfg, accuracy):
    draw = random.Random(11)
    data = {"hot": [], "cold": [], "flat": [3.0] * 50}
    for _ in range(5000):
        data["hot"].append(draw.choice([0.0, round(draw.expovariate(0.1), 2)]))
    data["cold"] = [draw.gauss(0, 1) for _ in range(7)]
    entries = [(k, v) for k, vs in data.items() for v in vs] + [("hot", None), ("cold", None)]
    df = spark.createDataFrame(entries, "k string, v double").repartition(4)
    shares = {"a": 0.01, "b": 0.07, "c": 0.5, "d": 0.9, "e": 0.9999}
    wanted = {n: (F.col("v"), p) for n, p in shares.items()}
    exact = replace(cfg, exact_quantiles=True, quantile_accuracy=accuracy)
    got = {r["k"]: r for r in quantiles(df, wanted, exact, by=("k",)).collect()}
    everything = quantiles(df, wanted, exact).first()
    for key, values in [*data.items(), (None, [v for vs in data.values() for v in vs])]:
        values = sorted(values)
        row = everything if key is None else got[key]
        for name, p in shares.items():
            place = max(math.ceil(round(p * len(values), 9)), 1)
            assert row[name] == values[place - 1], (key, name)


def test_leaders_break_ties_by_id(spark, cfg):
    df = spark.createDataFrame(
        [("b", "B", 5.0, 1.0, None), ("a", "A", 5.0, 1.0, None), ("c", "C", None, 0.5, None)],
        "id string, name string, price_change_percentage_24h double, total_volume double, "
        "liquidity_strength double",
    ).withColumn("ingestion_date", F.lit(date(2024, 1, 1)))
    row = gold.market_leaders(df, cfg).first()
    assert (row["top_gainer_coin"], row["top_loser_coin"], row["highest_volume_coin"]) == ("a", "a", "a")
    assert row["most_liquid_coin"] is None


def test_latest_rows_are_limited_before_the_shuffle(spark, candles):
    from candlewick.operators.pick import latest_per_key

    plan = latest_per_key(candles, ["coin_id"], ["candle_datetime"])._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("WindowGroupLimit") == 2
    assert physical.rindex("WindowGroupLimit") > physical.index("Exchange")


def test_windows_share_one_shuffle_and_one_sort(candles, cfg):
    plan = indicators.candle_features(candles, replace(cfg, exact_scale=4))
    physical = plan._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning") == 1
    assert physical.count("+- Sort [") == 1


