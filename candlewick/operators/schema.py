"""Schema drift between a stored table and an incoming batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlewick.config import Config

CHANGE_LOG = (
    "event_timestamp timestamp, run_id string, table_name string, change_type string, "
    "column_name string, old_dtype string, new_dtype string"
)


def schema_changes(stored: StructType | None, incoming: StructType) -> list[tuple[str, str, str, str]]:
    """(change type, column, old type, new type); full types are compared, metadata only."""
    new = {f.name: f.dataType for f in incoming.fields}
    if stored is None:
        return [("SCHEMA_INITIALISED", n, "", t.simpleString()) for n, t in new.items()]
    old = {f.name: f.dataType for f in stored.fields}
    added = [("COLUMN_ADDED", n, "", t.simpleString()) for n, t in new.items() if n not in old]
    dropped = [("COLUMN_DROPPED", n, t.simpleString(), "") for n, t in old.items() if n not in new]
    changed = [
        ("TYPE_CHANGED", n, old[n].simpleString(), "string")
        for n, t in new.items()
        if n in old and old[n] != t
    ]
    return added + dropped + changed


def schema_diff(
    spark: SparkSession, table: str, stored: StructType | None, incoming: StructType, cfg: Config
) -> DataFrame:
    """The changes as rows of the schema log."""
    rows = [
        (cfg.run_ts, cfg.run_id, table, kind, column, old, new)
        for kind, column, old, new in schema_changes(stored, incoming)
    ]
    return spark.createDataFrame(rows, CHANGE_LOG)


def reconcile_schema(batch: DataFrame, stored: StructType | None) -> DataFrame:
    """Fit a batch to the stored table: absent columns become typed NULLs, columns whose type
    changed become strings, new columns pass through."""
    if stored is None:
        return batch
    changes = schema_changes(stored, batch.schema)
    widened = {column for kind, column, *_ in changes if kind == "TYPE_CHANGED"}
    absent = {column for kind, column, *_ in changes if kind == "COLUMN_DROPPED"}
    return batch.select(
        *[F.col(c).cast("string").alias(c) if c in widened else F.col(c) for c in batch.columns],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in stored.fields if f.name in absent],
    )
