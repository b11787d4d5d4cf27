"""Limits from stored counts equal limits of the whole history."""

import math

import pytest
from pyspark.sql import functions as F

from candlewick.operators import limits
from candlewick.plans import publish
from conftest import rows

SHARES = {f"p{i}": ("v", p) for i, p in enumerate((0.0, 0.001, 0.07, 0.25, 0.5, 0.9, 0.99, 1.0))}


def _values():
    return {"v": F.col("v")}


def _lowest(values, p):
    known = sorted(v for v in values if v is not None)
    return known[max(math.ceil(round(p * len(known), 9)), 1) - 1] if known else None


@pytest.mark.parametrize("most", [10**6, 20])
def test_days_stored_one_by_one(spark, cfg, names, most):
    names = {k: f"{v}_{most}" for k, v in names.items()}
    # a third of the rows is one value; later days differ from those the cuts come from
    v = F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 50 == 1, None).otherwise((F.col("id") * 7919 % 10_007) / 16 + F.col("day") * 100)
    df = spark.range(12_000).withColumn("day", (F.col("id") / 4_000).cast("int")).withColumn("v", v).drop("id")
    df.write.saveAsTable(names["archive"])
    history = spark.table(names["archive"])
    for day in (0, 1, 2, 1):
        publish.store_counts(history.where(F.col("day") == day), _values(), names["main"], "day", names["log"], cfg)
    cuts, counts = spark.table(f"{names['main']}_cuts"), spark.table(names["main"])
    assert counts.agg(F.sum("n")).first()[0] == history.where("v IS NOT NULL").count()
    found = limits.limits(history, _values(), SHARES, cuts, counts, most).first()
    plain = [r[0] for r in history.select("v").collect()]
    assert tuple(found) == tuple(_lowest(plain, p) for _, p in SHARES.values())


def test_no_rows_and_no_values(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "day int, v double")
    for rows_ in (df, df.limit(0)):
        cuts = limits.cut_points(rows_, _values())
        counts = limits.day_counts(rows_, _values(), cuts, "day")
        assert rows(counts) == []
        assert set(limits.limits(rows_, _values(), SHARES, cuts, counts).first()) == {None}


def test_ranges_reach_the_scan(spark, names):
    spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS v").write.saveAsTable(names["main"])
    found = limits._inside(spark.table(names["main"]), _values(), SHARES, {"p3": (10.0, 20.0, 1, 9), "p4": (50.0, None, 1, 9)})
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "GreaterThan(v,10.0)" in plan and "LessThan(v,20.0)" in plan
    assert found.count() == 9 + 949
