"""Quantiles of columns or expressions, whole table or per group, without one big sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.staging import stage

Wanted = dict[str, tuple[Column, float]]


def quantiles(df: DataFrame, wanted: Wanted, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per group: for each name the lowest value whose cumulative share reaches the
    fraction. NULLs do not count.

    Exact at any size, in three passes. With ``exact_quantiles`` off it is one pass with mergeable
    sketches, whose rank error is at most ``rows / accuracy``.
    """
    rows = df.select(
        *by, *[value.cast("double").alias(f"_v{i}") for i, (value, _) in enumerate(wanted.values())]
    )
    if cfg.exact_quantiles:
        return _exact(rows, {n: p for n, (_, p) in wanted.items()}, cfg, by)
    return rows.groupBy(*by).agg(
        *[_near(i, p, cfg).alias(n) for i, (n, (_, p)) in enumerate(wanted.items())]
    )


def sketched(value: Column, p: float, cfg: Config) -> Column:
    """The sketch as an aggregate expression, to share a pass with other aggregates."""
    return F.percentile_approx(value.cast("double"), F.lit(p), F.lit(cfg.quantile_accuracy))


def _near(i: int, p: float, cfg: Config) -> Column:
    if p <= 0:
        return F.min(f"_v{i}")
    if p >= 1:
        return F.max(f"_v{i}")
    return sketched(F.col(f"_v{i}"), p, cfg)


def _exact(rows: DataFrame, shares: dict[str, float], cfg: Config, by: tuple[str, ...]) -> DataFrame:
    """Bracket every quantile with the sketch, count the rows below the bracket, and order only
    the values inside it: about ``10 / accuracy`` of the rows."""
    margin = 5 / cfg.quantile_accuracy
    places = list(enumerate(shares.values()))
    brackets = rows.groupBy(*by).agg(
        F.struct(
            *[_near(i, p - margin, cfg).alias(f"lo{i}") for i, p in places],
            *[_near(i, p + margin, cfg).alias(f"hi{i}") for i, p in places],
        ).alias("_b")
    )
    # stored: rows are counted and ordered against the very same brackets
    brackets = stage(brackets, "brackets")
    framed = rows.join(brackets, list(by)) if by else rows.withColumn("_b", brackets.scalar())

    totals = framed.groupBy(*by).agg(
        *[F.count(f"_v{i}").alias(f"total{i}") for i, _ in places],
        *[F.count_if(F.col(f"_v{i}") < F.col(f"_b.lo{i}")).alias(f"below{i}") for i, _ in places],
    )
    targets = F.array(
        *[
            F.struct(
                F.lit(i).alias("_q"),
                F.col(f"below{i}").alias("_below"),
                # an exact decimal product: 0.07 of 100 rows must not become 8 rows
                F.greatest(
                    F.ceil(F.lit(str(p)).cast("decimal(18,12)") * F.col(f"total{i}")), F.lit(1)
                ).alias("_target"),
            )
            for i, p in places
        ]
    )
    sought = totals.select(*by, F.explode(targets).alias("_s")).select(*by, "_s.*")

    inside = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f"_v{i}").between(F.col(f"_b.lo{i}"), F.col(f"_b.hi{i}")),
                    F.struct(F.lit(i).alias("_q"), F.col(f"_v{i}").alias("_v")),
                )
                for i, _ in places
            ]
        )
    )
    values = (
        framed.select(*by, F.explode(inside).alias("_c"))
        .groupBy(*by, F.col("_c._q").alias("_q"), F.col("_c._v").alias("_v"))
        .agg(F.count("*").alias("_n"))
    )
    rising = Window.partitionBy(*by, "_q").orderBy("_v")
    reached = (
        values.join(sought, [*by, "_q"])
        .withColumn("_upto", F.col("_below") + F.sum("_n").over(rising))
        .groupBy(*by, "_q")
        .agg(
            F.min(F.when(F.col("_upto") >= F.col("_target"), F.col("_v"))).alias("_value"),
            F.max(F.col("_below") >= F.col("_target")).alias("_missed"),
        )
        # the sketch's error bound rules this out; never return a wrong value silently
        .withColumn(
            "_value",
            F.when(
                F.col("_missed") | F.col("_value").isNull(),
                F.raise_error(F.lit("quantile fell outside its bracket")).cast("double"),
            ).otherwise(F.col("_value")),
        )
    )
    return reached.groupBy(*by).agg(
        *[F.max(F.when(F.col("_q") == i, F.col("_value"))).alias(n) for i, n in enumerate(shares)]
    )


def as_scalar(df: DataFrame, columns: list[str]) -> Column:
    """A one-row frame as a scalar subquery: evaluated once, no join, nothing on the driver."""
    return df.select(F.struct(*columns)).scalar()
