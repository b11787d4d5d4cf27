"""First or latest rows per key, de-duplication and slot filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.config import Config


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key. Spark limits each key before the shuffle, so a hot key sends
    ``n`` rows per input task. ``order`` must be total for a repeatable result."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in by])


def dedup_conflicts(df: DataFrame, keys: list[str], arrival: list[str], price: str) -> DataFrame:
    """Keys listed more than once, with the kept price and whether any copy disagrees.

    "Some copy differs from the first" is the same as "not all copies are equal", which needs only
    mergeable aggregates.
    """
    value = F.col(price)
    return (
        df.groupBy(*keys)
        .agg(
            F.count("*").alias("row_count"),
            F.min_by(value, F.struct(*arrival)).alias("kept_price"),
            F.min(value).alias("min_price"),
            F.max(value).alias("max_price"),
            F.count(value).alias("_priced"),
        )
        .where("row_count > 1")
        .withColumn(
            "is_conflict",
            (F.coalesce(F.col("min_price") < F.col("max_price"), F.lit(False)))
            | ((F.col("_priced") > 0) & (F.col("_priced") < F.col("row_count"))),
        )
        .drop("_priced")
    )


def first_ids(df: DataFrame, key: str, arrival: str, n: int) -> DataFrame:
    """The first ``n`` distinct ids in order of first arrival."""
    return df.groupBy(key).agg(F.min(arrival).alias(arrival)).orderBy(arrival, key).limit(n)


def trim_batches(df: DataFrame, batch: str, order: list[Column], n: int) -> DataFrame:
    return first_per_key(df, [batch], order, n)


def fill_slots(
    kept: DataFrame, candidates: DataFrame, batch: str, key: str, position: str, cfg: Config
) -> DataFrame:
    """Top batches up to the expected size from a second list, in that list's order."""
    want = cfg.expected_entities
    short = (
        kept.groupBy(batch)
        .agg(F.count("*").alias("_have"))
        .select(F.col(batch).alias("_batch"), (F.lit(want) - F.col("_have")).alias("_missing"))
        .where("_missing > 0")
    )
    unused = candidates.join(kept.select(batch, key), [batch, key], "left_anti")
    order = Window.partitionBy(batch).orderBy(position, key)
    fills = (
        unused.withColumn("_rn", F.row_number().over(order))
        # the constant bound lets Spark limit each batch before the shuffle
        .where(F.col("_rn") <= want)
        .join(short, F.col(batch) == F.col("_batch"))
        .where(F.col("_rn") <= F.col("_missing"))
        .drop("_rn", "_batch", "_missing")
    )
    return kept.unionByName(fills, allowMissingColumns=True)
