"""Clustered layouts: rows ordered along a space-filling curve over several columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

#: Ranges of a column are numbered with so many bits; their cuts are the only thing collected.
BITS = 8
#: Text is compared by its first bytes, as many as a double holds exactly.
PREFIX = 6


def _measure(name: str, kind: DataType) -> Column:
    """A number that rises with the column's values."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (NumericType, BooleanType)):
        return c.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, StringType):
        lead = F.hex(F.substring(F.encode(c, "UTF-8"), 1, PREFIX))
        return F.conv(F.rpad(lead, 2 * PREFIX, "0"), 16, 10).cast("double")
    raise TypeError(f"no order for clustering by {name}: {kind.simpleString()}")


def _place(value: Column, cuts: list[float]) -> Column:
    """How many cuts lie below the value, by halving; NULL is placed first."""
    held = F.array(*map(F.lit, cuts))
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(BITS))])
    further = lambda at, step: F.when(F.element_at(held, at + step) < value, at + step).otherwise(at)
    return F.aggregate(steps, F.lit(0), further)


def curve_key(df: DataFrame, columns: list[str]) -> Column:
    """The place of a row on the Z curve: the range numbers of its columns, their bits interleaved.

    Ranges hold about as many rows each (cuts are quantile sketches, one pass), so a column whose
    values crowd together is cut as finely as any other. Starts a job; ``2 ** BITS - 1`` cuts a
    column come to the driver.
    """
    if not 1 <= len(columns) <= 63 // BITS:
        raise ValueError(f"one to {63 // BITS} columns to cluster by, not {len(columns)}")
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    values = [_measure(c, df.schema[c].dataType) for c in columns]
    found = df.agg(*[F.percentile_approx(v, shares).alias(f"c{i}") for i, v in enumerate(values)]).first()
    key = F.lit(0).cast("long")
    for i, (value, cuts) in enumerate(zip(values, found, strict=True)):
        if cuts is None:  # nothing but NULL
            continue
        place = _place(value, cuts)
        for bit in range(BITS):
            to = bit * len(columns) + len(columns) - 1 - i
            key = key.bitwiseOR(F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long"), to))
    return key


def clustered(df: DataFrame, columns: list[str], files: int | None = None, within: str | None = None) -> DataFrame:
    """Rows dealt to files by ranges of the curve, sorted inside, below the partitions of ``within``.

    Inside a cell of the curve rows are ordered by the columns. Rows with equal values, say one that a third
    of all rows have, are dealt on by a hash of the whole row and by the task that read them, so no task
    gets them all.
    """
    comparable = [f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = F.pmod(F.xxhash64(*comparable) + F.spark_partition_id(), F.lit(1 << 20))
    placed = df.withColumns({"_curve": curve_key(df, columns), "_spread": spread})
    ranges = [*([within] if within else []), "_curve", *columns, "_spread"]
    dealt = placed.repartitionByRange(files, *ranges) if files else placed.repartitionByRange(*ranges)
    return dealt.sortWithinPartitions(*ranges).drop("_curve", "_spread")
