"""Windows over one entity's history, also when that history is too long for one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def split_series(
    df: DataFrame,
    key: str,
    order_by: str,
    lookback: int,
    chunk_rows: int,
    period: str = "month",
) -> DataFrame:
    """Cut each key's history into chunks of about ``chunk_rows`` rows.

    Every chunk also receives the (at least) ``lookback`` rows before it, marked ``_halo``, so a
    window of that reach gives the same values as over the whole history. Row positions come from
    counts per (key, period), which are small next to the data.
    """
    if chunk_rows < lookback:
        raise ValueError("a chunk must hold at least the rows a window looks back on")
    span = F.date_trunc(period, F.col(order_by))
    history = Window.partitionBy(key).orderBy("_period")
    spans = (
        df.groupBy(key, span.alias("_period"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_end", F.sum("_n").over(history))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn("_own", F.floor(F.col("_start") / chunk_rows))
    )
    chunks = Window.partitionBy(key).orderBy("_own")
    following = (
        spans.groupBy(key, "_own")
        .agg(F.min("_start").alias("_first"))
        .select(
            key,
            "_own",
            # a chunk holds more rows than the look-back, so only two later chunks can need it
            *[
                F.lead(F.struct("_own", "_first"), step).over(chunks).alias(f"_next{step}")
                for step in (1, 2)
            ],
        )
    )
    wanted = [F.struct(F.col("_own").alias("chunk"), F.lit(False).alias("halo"))] + [
        F.when(
            F.col(f"_next{step}._first") - F.col("_end") < lookback,
            F.struct(F.col(f"_next{step}._own").alias("chunk"), F.lit(True).alias("halo")),
        )
        for step in (1, 2)
    ]
    homes = spans.join(following, [key, "_own"]).select(
        key, "_period", F.array_compact(F.array(*wanted)).alias("_homes")
    )
    return (
        df.withColumn("_period", span)
        .join(homes, [key, "_period"])
        .withColumn("_home", F.explode("_homes"))
        .select(*df.columns, F.col("_home.chunk").alias("_chunk"), F.col("_home.halo").alias("_halo"))
    )


def over_series(
    df: DataFrame,
    key: str,
    order_by: str,
    lookback: int,
    chunk_rows: int | None,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
) -> DataFrame:
    """Apply ``add(frame, window)`` per key in time order.

    ``chunk_rows=None`` is right when (key, order_by) is unique on a calendar grid: a key's group
    is then bounded by the calendar. Otherwise give a chunk size and hot keys are cut.
    """
    if chunk_rows is None:
        return add(df, Window.partitionBy(key).orderBy(order_by))
    parts = split_series(df, key, order_by, lookback, chunk_rows)
    out = add(parts, Window.partitionBy(key, "_chunk").orderBy(order_by))
    return out.filter(~F.col("_halo")).drop("_chunk", "_halo")


def streaks(
    df: DataFrame, key: str, order_by: str, flag: str, name: str = "streak_days", period: str | None = None
) -> DataFrame:
    """Length so far of the current run of equal flags.

    Position minus the position of the latest flag change: both come from one sort per key. That is
    right for rows that are one per (key, day), whose groups are bounded by the calendar. For longer
    histories name a ``period`` (``"day"``, ``"hour"``): every period of a key is a task of its own, its
    runs are summed up in one row, and what reaches over its start is carried in from the rows before.
    The result is the same. A NULL flag, or a NULL before it, changes nothing.
    """
    if period is None:
        out = _runs(df, Window.partitionBy(key).orderBy(order_by), flag, name)
        return out.drop("_pos", "_turns")
    parts = df.withColumn("_period", F.date_trunc(period, order_by))
    own = _runs(parts, Window.partitionBy(key, "_period").orderBy(order_by), flag, name)
    along = Window.partitionBy(key).orderBy("_period")
    sums = own.groupBy(key, "_period").agg(
        F.max("_pos").alias("_n"),
        (F.max("_turns") > 1).alias("_turned"),
        F.max_by(name, "_pos").alias("_tail"),
        F.min_by(flag, "_pos").alias("_first"),
        F.max_by(flag, "_pos").alias("_last"),
    )
    broken = F.coalesce(F.lag("_last").over(along) != F.col("_first"), F.lit(False))
    carried = (
        sums.withColumns({"_broken": broken, "_upto": F.sum("_n").over(along)})
        # rows before the run that is open at a period's end
        .withColumn("_closed", F.when(F.col("_broken") | F.col("_turned"), F.col("_upto") - F.col("_tail")))
        .withColumn("_open", F.col("_upto") - F.coalesce(F.max("_closed").over(along), F.lit(0)))
        .withColumn("_carry", F.when(~F.col("_broken"), F.lag("_open").over(along)))
        .select(F.col(key).alias("_key"), F.col("_period").alias("_of"), "_carry")
    )
    same = own[key].eqNullSafe(carried["_key"]) & own["_period"].eqNullSafe(carried["_of"])
    reaching = F.when(F.col("_turns") == 1, F.coalesce("_carry", F.lit(0))).otherwise(0)
    return own.join(carried, same, "left").withColumn(name, F.col(name) + reaching).select(*df.columns, name)


def _runs(df: DataFrame, w: WindowSpec, flag: str, name: str) -> DataFrame:
    """Row positions, where the current run began, and its length so far."""
    turn = F.when(F.col(flag) != F.lag(flag).over(w), F.col("_pos"))
    return (
        df.withColumn("_pos", F.row_number().over(w))
        .withColumn("_turn", turn)
        .withColumn("_turns", F.coalesce(F.max("_turn").over(w), F.lit(1)))
        .withColumn(name, (F.col("_pos") - F.col("_turns") + 1).cast("long"))
        .drop("_turn")
    )
