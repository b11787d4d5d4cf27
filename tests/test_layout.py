"""Layouts, bitmaps of days, and checks that read their table once."""

from datetime import date, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from candlewick.operators import layout, tenure
from candlewick.operators.quality import Rule, validate
from candlewick.plans import publish
from candlewick.sources import tables
from conftest import rows


def _spans(spark, table, column):
    """Least and greatest value of a column in every row group of a table."""
    out = []
    for path in spark.table(table).inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file://").removeprefix("file:")).metadata
        at = meta.schema.names.index(column)
        out += [(s.min, s.max) for g in range(meta.num_row_groups) if (s := meta.row_group(g).column(at).statistics)]
    return out


@pytest.fixture
def points(spark):
    return spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("a"), (F.col("id") * 104_729 % 19_997).alias("b"), F.col("id").alias("c"))


def test_a_filter_on_any_column_skips_row_groups(spark, points, names):
    tables.write_clustered(points, names["main"], ["a", "b"], files=16)
    for column in ("a", "b"):
        spans = _spans(spark, names["main"], column)
        read = [s for s in spans if s[0] <= 5_300 and s[1] >= 5_000]
        assert len(spans) == 16
        assert len(read) <= 8, (column, spans)  # four cells of the curve, each cut by file borders at most once
    # ranges of the first column alone leave the second one everywhere
    points.repartitionByRange(16, "a", "b").sortWithinPartitions("a", "b").write.saveAsTable(names["archive"])
    assert sum(s[0] <= 5_300 and s[1] >= 5_000 for s in _spans(spark, names["archive"], "b")) == 16
    assert rows(spark.table(names["main"])) == rows(points)


def test_a_value_that_most_rows_have_is_dealt_on(spark, names):
    df = spark.range(0, 20_000, 1, 8).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("a"), F.lit(1).alias("b"))
    sizes = layout.clustered(df, ["a", "b"], files=8).groupBy(F.spark_partition_id()).count().select("count")
    assert max(r[0] for r in sizes.collect()) < 6_000


def test_every_type_and_null_has_a_place(spark, names):
    data = [(None, None, None, None, None), ("x", 1.5, date(2024, 1, 1), True, 1), ("", float("nan"), date(1960, 1, 1), False, 2)] * 4
    df = spark.createDataFrame(data, "s string, d double, t date, f boolean, n int")
    text = df.columns[:1] + [F.col("d").cast("string")] + df.columns[2:]  # NaN differs from itself
    for columns in (["s", "d"], ["t", "f", "n"], ["s"]):
        assert rows(layout.clustered(df, columns, files=3), *text) == rows(df, *text)
    assert layout.clustered(df.limit(0), ["s", "d"]).count() == 0
    assert rows(layout.clustered(df.where("s IS NULL"), ["s"])) == rows(df.where("s IS NULL"))
    with pytest.raises(ValueError):
        layout.clustered(df, [])


def test_text_is_placed_in_its_order(spark):
    words = ["", "a", "aa", "ab", "b", "coin", "coin 10", "zz", "é", "日"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    placed = df.select("w", layout._measure("w", df.schema["w"].dataType).alias("m")).collect()
    assert [r[0] for r in sorted(placed, key=lambda r: r[1])] == sorted(words, key=lambda w: w.encode())


def _members(spark, days):
    return spark.createDataFrame(days, "coin_id string, universe_date date, is_active boolean")


def test_bitmaps_count_each_day_once(spark):
    first = date(2023, 12, 1)
    days = [("a", first + timedelta(i), True) for i in range(70)] * 2 + [("b", date(2024, 1, 31), True), ("b", date(2024, 2, 1), False)]
    found = tenure.days_in_universe(tenure.member_months(_members(spark, [*days, ("c", None, True)])))
    assert rows(found) == [("a", 70), ("b", 1), ("c", 0)]


def test_a_new_day_reads_its_month_only(spark, cfg, names):
    january = _members(spark, [("a", date(2024, 1, d), True) for d in range(1, 32)] + [("b", date(2024, 1, 5), True)])
    publish.store_tenure(january, names["main"], names["log"], cfg)
    publish.store_tenure(_members(spark, [("a", date(2024, 2, 1), True)]), names["main"], names["log"], cfg)
    kept = {f for f in spark.table(names["main"]).inputFiles() if "month=2024-01-01" in f}
    for _ in range(2):  # the same day twice
        publish.store_tenure(_members(spark, [("a", date(2024, 2, 2), True), ("b", date(2024, 2, 2), True)]), names["main"], names["log"], cfg)
    assert kept == {f for f in spark.table(names["main"]).inputFiles() if "month=2024-01-01" in f}
    assert rows(tenure.days_in_universe(spark.table(names["main"]))) == [("a", 33), ("b", 2)]


def test_checks_read_their_table_once(spark, names):
    spark.range(100).selectExpr("id % 40 AS a", "id % 30 AS b", "CAST(id AS DOUBLE) AS v").write.saveAsTable(names["main"])
    rules = [
        Rule("a", unique=("a",)), Rule("ab", unique=("a", "b")), Rule("ba", unique=("b", "a")),
        Rule("large", failing="v > 89"), Rule("own_key", failing="a = 3 AND b = 3"), Rule("has", present=("a", "z")),
    ]
    found = validate(spark.table(names["main"]), rules)
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
    assert rows(found) == [("a", False, 60), ("ab", True, 0), ("ba", True, 0), ("has", False, 1), ("large", False, 10), ("own_key", False, 1)]
    nothing = validate(spark.table(names["main"]).limit(0), rules[:5])
    assert [r[2] for r in rows(nothing)] == [0] * 5
