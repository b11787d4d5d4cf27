"""Keyed merges of a source batch into a target, as pure ``(target, source) -> result``.

Reading the target is the cost of a merge, so callers narrow it to the touched partitions first
(``sources.tables.publish_merge``). Joins are on the full key; the plan broadcasts the source only
where its measured size allows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ambiguous_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several source rows claim."""
    return source.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def require_unique(source: DataFrame, keys: list[str]) -> DataFrame:
    """Fail when a key appears twice; returns the source unchanged."""
    clash = ambiguous_keys(source, keys).first()
    if clash:
        raise ValueError(f"several source rows for one key: {clash.asDict()}")
    return source


def _without(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the other frame lacks. A NULL in a key is a value like any other, so that
    repeating a batch does not add its rows without, say, a day once more."""
    named = other.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return df.join(named, same, "left_anti")


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows win, other target rows stay, new keys are added."""
    return _without(target, source, keys).unionByName(source)


def merge_newest(target: DataFrame, source: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Upsert guarded by ``by``: a source row older than the target's row of its key changes nothing.
    Equal values update; a NULL is older than any value."""
    later = target.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col(by).alias("_held"))
    held = F.coalesce(F.col("_held") > F.col(by), F.col("_held").isNotNull() & F.col(by).isNull())
    for k in keys:
        held = held & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return merge_upsert(target, source.join(later, held, "left_anti"), keys)


def merge_folded(
    target: DataFrame, source: DataFrame, keys: list[str], folds: dict[str, Callable[[str], Column]]
) -> DataFrame:
    """Rows of one key become one, each other column by its aggregate in ``folds`` (a sum, a bitwise or,
    a merge of sketches). One shuffle, combined before it; a NULL in a key is a value like any other."""
    both = target.unionByName(source.select(*target.columns))
    folded = both.groupBy(*keys).agg(*[fold(c).alias(c) for c, fold in folds.items()])
    return folded.select(*target.columns)


def merge_insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Only keys unknown to the target are added."""
    return target.unionByName(_without(source, target, keys), allowMissingColumns=True)


def merge_common_columns(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Update and insert the columns both sides have; columns only the target has keep their
    value on a match and are NULL on an insert; columns only the source has are ignored."""
    shared = [c for c in target.columns if c in source.columns]
    s = source.select(*shared, F.lit(True).alias("_hit")).alias("s")
    t = target.alias("t")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    return t.join(s, on, "full_outer").select(
        *[
            F.when(F.col("s._hit"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            if c in shared
            else F.col(f"t.{c}").alias(c)
            for c in target.columns
        ]
    )


def merge_synced(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert after the target took over the source's columns: new ones are NULL on old rows,
    dropped ones disappear."""
    known = set(target.columns)
    synced = target.select(
        *[
            F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name)
            for f in source.schema.fields
        ]
    )
    return merge_upsert(synced, source, keys)


#: Working columns start with this.
INTERNAL = "_"


def drop_internal(df: DataFrame) -> DataFrame:
    """What is published: all columns but the working ones, whose names start with ``INTERNAL``."""
    hidden = [name for name in df.columns if name.startswith(INTERNAL)]
    return df.drop(*hidden)
