"""Ranks within a group (a day), also when one group holds much of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.staging import stage

# 2^8 buckets per group
BUCKET_BITS = 8


def _slot(cuts: Column, value: Column) -> Column:
    """Twice the number of cuts below the value, plus one where the value is itself a cut. A value
    that fills more than one bucket's worth of rows is always a cut, so it has a slot to itself;
    NULLs have the first slot."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(BUCKET_BITS))])
    below = F.aggregate(
        steps,
        F.lit(0),
        lambda found, step: found
        + F.when(F.get(cuts, found + step - 1) < value, step).otherwise(F.lit(0)),
    )
    on_cut = F.array_contains(cuts, value).cast("int")
    return F.when(value.isNull(), F.lit(-1)).otherwise(below * 2 + on_cut)


def _tables(one: DataFrame) -> DataFrame:
    """One row per group and metric: the cuts, the rows before and in each slot, and all rows.

    Cuts are approximate quantiles, stored: slots are counted and rows are placed with the very same
    cuts, also where tasks are run again. Slots are at most two to a cut.
    """
    shares = F.array(*[F.lit(i / (1 << BUCKET_BITS)) for i in range(1, 1 << BUCKET_BITS)])
    near = F.percentile_approx("_value", shares, F.lit(20 << BUCKET_BITS)).alias("_cuts")
    cuts = stage(one.groupBy("_group", "_metric").agg(near), "cuts")
    along = Window.partitionBy("_group", "_metric").orderBy("_slot")
    sizes = (
        _with(one, cuts)
        .groupBy("_group", "_metric", _slot(F.col("_cuts"), F.col("_value")).alias("_slot"))
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(along) - F.col("_rows"))
    )
    listed = F.collect_list(F.struct("_slot", F.struct("_before", "_rows")))
    slots = sizes.groupBy("_group", "_metric").agg(
        F.map_from_entries(listed).alias("_slots"), F.sum("_rows").alias("_total")
    )
    return stage(_with(slots, cuts), "slots")


def _with(rows: DataFrame, per_group: DataFrame) -> DataFrame:
    """Join what is known of a group and metric. No hint: the stored size decides on a broadcast, and
    a hot group is split otherwise."""
    named = per_group.withColumnsRenamed({"_group": "_of", "_metric": "_by"})
    same = F.col("_group").eqNullSafe(F.col("_of")) & (F.col("_metric") == F.col("_by"))
    return rows.join(named, same).drop("_of", "_by")


def _positions(one: DataFrame) -> DataFrame:
    """Add ``_before`` (rows of the group with a lower value, NULLs lowest), ``_peers`` (rows with
    this value) and ``_total``, for all metrics in one pass.

    Rows on a cut read their position off the slot table; the rest is sorted bucket by bucket, each
    bucket of a group and metric a task.
    """
    placed = (
        _with(one, _tables(one))
        .withColumn("_slot", _slot(F.col("_cuts"), F.col("_value")))
        .withColumn("_entry", F.element_at("_slots", F.col("_slot")))
        .drop("_cuts", "_slots")
    )
    single = F.col("_slot") % 2 != 0
    on_cut = placed.where(single).withColumns(
        {"_before": F.col("_entry._before"), "_peers": F.col("_entry._rows")}
    )
    inside = Window.partitionBy("_group", "_metric", "_slot").orderBy("_value")
    between = placed.where(~single).withColumns(
        {
            "_before": F.col("_entry._before") + F.rank().over(inside) - 1,
            "_peers": F.count("*").over(inside.rangeBetween(Window.currentRow, Window.currentRow)),
        }
    )
    return on_cut.unionByName(between)


def add_ranks(
    df: DataFrame,
    group: str,
    ranks: dict[str, tuple[str, str]],
    cfg: Config,
    hot: bool = True,
) -> DataFrame:
    """Add rank columns ``name -> (metric, how)`` with how in ``desc``, ``asc``, ``percent``.

    ``desc`` puts NULLs last, ``asc`` and ``percent`` put them first. Groups of any size are ranked in
    buckets: rows are stored once with a number, turned into one row for each metric, placed among
    their group's values, and their ranks are brought back by that number. Reads and shuffles do not
    grow with the number of metrics. Metrics of different types are compared as their common type.
    ``hot=False`` is for callers who know that a group fits one task.
    """
    if not hot:
        return df.withColumns(
            {name: _window_rank(group, metric, how) for name, (metric, how) in ranks.items()}
        )
    metrics = list(dict.fromkeys(metric for metric, _ in ranks.values()))
    numbered = stage(df.withColumn("_row", F.monotonically_increasing_id()), "ranked")
    one = numbered.select(
        "_row", F.col(group).alias("_group"), F.posexplode(F.array(*metrics)).alias("_metric", "_value")
    )
    found = _positions(one).groupBy("_row").agg(
        *[
            F.max(F.when(F.col("_metric") == metrics.index(metric), _position_rank(how))).alias(name)
            for name, (metric, how) in ranks.items()
        ]
    )
    return numbered.join(found, "_row").drop("_row")


def _window_rank(group: str, metric: str, how: str):
    w = Window.partitionBy(group)
    if how == "desc":
        return F.rank().over(w.orderBy(F.col(metric).desc_nulls_last()))
    rising = w.orderBy(F.col(metric).asc_nulls_first())
    return F.rank().over(rising) if how == "asc" else F.percent_rank().over(rising)


def _position_rank(how: str):
    if how == "desc":
        return (F.col("_total") - F.col("_before") - F.col("_peers") + 1).cast("int")
    if how == "asc":
        return (F.col("_before") + 1).cast("int")
    return F.when(F.col("_total") > 1, F.col("_before") / (F.col("_total") - 1)).otherwise(0.0)
