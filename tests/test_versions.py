"""Stored tables keep all their rows: in a session with Spark's default overwrite mode, and when a write fails."""

from dataclasses import replace
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from candlewick.sources import tables
from candlewick.staging import shared_dir

D1, D2, D3 = (date(2024, 1, d) for d in (1, 2, 3))


@pytest.fixture(params=["static", "dynamic"])
def mode(spark, request):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", request.param)
    yield request.param
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def frame(spark, *entries, layout="k int, d date, v string"):
    return spark.createDataFrame(list(entries), layout)


def failing(df):
    """The same rows, one of which cannot be computed."""
    return df.withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("no such row"))).otherwise(F.col("v")))


def folder(spark, table):
    root = tables._location(spark, table)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {x.getPath().getName() for x in fs.listStatus(path.getParent()) if x.getPath().getName().startswith(table)}


def test_merge_keeps_other_partitions(spark, cfg, names, mode):
    main = f"{names['main']}_{mode}"
    odd = "a'b/c=%d\\"
    first = frame(spark, (1, odd, "a"), (2, "x", "b"), (3, None, "c"), (5, "", "e"), layout="k int, p string, v string")
    tables.publish_merge(first, main, ["k"], cfg, "p")
    second = frame(spark, (1, odd, "A"), (4, None, "d"), (6, "new", "f"), layout="k int, p string, v string")
    for _ in range(2):
        tables.publish_merge(second, main, ["k"], cfg, "p")
        assert rows(spark.table(main), "k", "p", "v") == [
            (1, odd, "A"), (2, "x", "b"), (3, None, "c"), (4, None, "d"), (5, None, "e"), (6, "new", "f")]
    assert spark.table(main).where(F.col("p") == odd).count() == 1
    tables.drop_table(spark, main)


def test_archive_keeps_other_runs(spark, cfg, names, mode):
    log = f"{names['archive']}_{mode}"
    for run, day, value in (("r1", D1, "a"), ("r2", D2, "b"), ("r3", D2, "c"), ("r2", D3, "B")):
        tables.append_run(frame(spark, (1, day, value), (2, day, value)), log, replace(cfg, run_id=run), day="d")
    assert rows(spark.table(log), "archive_run_id", "d", "v") == [
        *[("r1", D1, "a")] * 2, *[("r2", D3, "B")] * 2, *[("r3", D2, "c")] * 2]
    late = frame(spark, (1, D1, "n/a"), (2, D1, "3"), layout="k int, d date, v string").withColumn("k", F.when(F.col("k") == 1, "one").otherwise("2"))
    tables.append_run(late, log, replace(cfg, run_id="r4"), day="d")
    assert rows(spark.table(log).where("archive_run_id = 'r4'"), "k", "v") == [(2, "3")]
    assert rows(spark.table(f"{log}_unreadable"), "k", "v") == [("one", "n/a")]


def test_failing_writes_leave_the_old_table(spark, cfg, names):
    main, plain = names["main"], names["archive"]
    old = frame(spark, (1, D1, "a"), (2, D2, "b"))
    tables.publish_merge(old, main, ["k"], cfg, "d")
    tables.create_table(old, plain)
    before = folder(spark, plain)
    with pytest.raises(Exception, match="no such row"):
        tables.publish_merge(failing(old), main, ["k"], cfg, "d")
    with pytest.raises(Exception, match="no such row"):
        tables.create_table(failing(old), plain)
    with pytest.raises(Exception, match="no such row"):
        tables.create_table(failing(old).withColumn("more", F.lit(1)), plain)
    with pytest.raises(Exception, match="no such row"):
        tables._replace_partitions(failing(old), main, ["d"])
    assert rows(spark.table(main), "k", "v") == [(1, "a"), (2, "b")]
    assert rows(spark.table(plain), "k", "v") == [(1, "a"), (2, "b")]
    assert folder(spark, plain) == before


def test_replacing_a_table_read_from(spark, names):
    """Its own rows, other columns, partitions: one folder is left, and no ``__next``."""
    main = names["main"]
    tables.create_table(frame(spark, (1, D1, "a")), main)
    for _ in range(2):
        tables.create_table(spark.table(main).union(frame(spark, (2, D2, "b"))).distinct(), main)
    assert rows(spark.table(main), "k", "v") == [(1, "a"), (2, "b")]
    tables.create_table(spark.table(main).select("v", "d", F.col("k").cast("string")), main, "d")
    assert rows(spark.table(main), "k", "d") == [("1", D1), ("2", D2)] and tables.partitions_of(spark, main).count() == 2
    tables.create_table(spark.table(main).select("v"), main)
    assert rows(spark.table(main)) == [("a",), ("b",)]
    assert len(folder(spark, main)) == 1 and not spark.catalog.tableExists(f"{main}__next")


@pytest.mark.parametrize("gone", [False, True])
def test_killed_switch_is_completed(spark, cfg, names, gone):
    """Killed after the new version was declared, before or after the old table went."""
    main = f"{names['main']}_{int(gone)}"
    tables.create_table(frame(spark, (1, D1, "a")), main)
    new = f"{tables._location(spark, main)}__vnext"
    frame(spark, (1, D1, "a"), (2, D2, "b")).write.partitionBy("d").parquet(new)
    tables._declare(spark, f"{main}__next", "k int, v string, d date", ["d"], new)
    if gone:
        tables.drop_table(spark, main)
    tables.publish_merge(frame(spark, (3, D3, "c")).select("k", "v", "d"), main, ["k"], cfg, "d")
    assert rows(spark.table(main), "k", "v") == [(1, "a"), (2, "b"), (3, "c")]
    assert not spark.catalog.tableExists(f"{main}__next")


def test_late_batches_do_not_go_back(spark, cfg, names):
    latest = names["main"]
    days = [(D2, "two"), (D1, "one"), (None, "none"), (D2, "again")]
    want = ["two", "two", "two", "again"]
    for (day, value), held in zip(days, want, strict=True):
        tables.publish_merge(frame(spark, (1, day, value), (9, None, value)), latest, ["k"], cfg, guard="d")
        assert rows(spark.table(latest).where("k = 1"), "v") == [(held,)]
    assert rows(spark.table(latest).where("k = 9"), "v") == [("again",)]


def test_staging_is_empty_after_storing(spark, cfg, names):
    main = names["main"]
    tables.publish_merge(frame(spark, (1, D1, "a")), main, ["k"], cfg, "d")
    tables.publish_merge(frame(spark, (1, D1, "b")), main, ["k"], cfg, "d")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/staging")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert not [x for x in (fs.listStatus(path) if fs.exists(path) else []) if x.getPath().getName().startswith(main)]


def test_only_runs_that_hold_a_wanted_key_are_read(spark, cfg, names):
    archive = names["archive"]
    runs = {"r1": ["a", "b"], "r2": ["a"], "r3": ["c", None], "r4": ["b"]}
    for run, coins in runs.items():
        batch = spark.createDataFrame([(c, "2024-01-01", i) for i, c in enumerate(coins)], "coin_id string, day string, n int")
        own = replace(cfg, run_id=run)
        if run != "r4":  # a run from before keys were listed
            tables.list_run_keys(batch, archive, "coin_id", own, "day")
        tables.append_run(batch, archive, own, day="day")
    wanted = spark.createDataFrame([("b",), ("z",)], "coin_id string")
    held = tables.runs_holding(spark, archive, wanted, "coin_id")
    assert {r[0] for r in held.select("archive_run_id").distinct().collect()} == {"r1", "r4"}
    assert all("archive_run_id=r1" in f or "archive_run_id=r4" in f for f in held.inputFiles())
    full = spark.table(archive).join(wanted, "coin_id", "left_semi")
    assert rows(held.join(wanted, "coin_id", "left_semi")) == rows(full)
    # a repeated run replaces its list
    again = spark.createDataFrame([("b", "2024-01-01", 5)], "coin_id string, day string, n int")
    tables.list_run_keys(again, archive, "coin_id", replace(cfg, run_id="r2"), "day")
    tables.append_run(again, archive, replace(cfg, run_id="r2"), day="day")
    held = tables.runs_holding(spark, archive, wanted, "coin_id")
    assert {r[0] for r in held.select("archive_run_id").distinct().collect()} == {"r1", "r2", "r4"}
