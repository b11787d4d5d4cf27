"""Stored tables: create, append, merge, clustered layout and the run log. Plain parquet.

Nothing is overwritten in place. New files are written beside the old ones, in a folder of their own;
when they are complete, the catalog is pointed at them: a table by its location, a partition by the
partition's. A run that fails or is killed before that leaves the table as it was. Several partitions
are switched one after the other, each whole before and after; repeating the run, which is keyed,
completes the rest. None of this depends on the session's overwrite mode.
"""

from __future__ import annotations

import traceback
import uuid
from collections.abc import Callable
from functools import partial
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.operators.layout import clustered
from candlewick.operators.merge import (
    drop_internal,
    merge_common_columns,
    merge_folded,
    merge_insert_only,
    merge_newest,
    merge_synced,
    merge_upsert,
    require_unique,
)
from candlewick.operators.schema import schema_diff
from candlewick.staging import remove, staged

MERGES = {
    "upsert": merge_upsert,
    "insert_only": merge_insert_only,
    "common_columns": merge_common_columns,
    "synced": merge_synced,
}
LOG_COLUMNS = (
    "log_timestamp timestamp, ingestion_date date, source string, status string, "
    "rows_written long, retry_count int, error_message string"
)


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.sql(f"USE `{name}`")


def partitions_of(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def _location(spark: SparkSession, table: str, partition: str = "") -> str:
    """A table's folder, or that of one of its partitions; the partition's is told before the table's."""
    told = spark.sql(f"DESCRIBE FORMATTED {table} {partition}").collect()
    return next(r["data_type"] for r in told if r["col_name"].strip() == "Location")


def _write(df: DataFrame, folder: str, layout: list[str]) -> None:
    """Write a version; what a failing write leaves is removed."""
    try:
        df.write.partitionBy(*layout).parquet(folder) if layout else df.write.parquet(folder)
    except Exception:
        remove(df.sparkSession, folder)
        raise


def create_table(df: DataFrame, table: str, *partition_by: str | None) -> None:
    """Create a table, or replace one by a new version; the old one stays until the new one is written.

    With the same columns and no partitions the switch is the table's location, one step in the catalog.
    Otherwise the new version is first declared as ``<table>__next``; then the old table goes, the new one
    is declared under its name, and ``__next`` is dropped. Killed in between, the next call completes it.
    """
    spark, layout = df.sparkSession, [c for c in partition_by if c]
    _complete(spark, table)
    if not spark.catalog.tableExists(table):
        writer = df.write.format("parquet")
        (writer.partitionBy(*layout) if layout else writer).saveAsTable(table)
        return
    old = _location(spark, table)
    folder = f"{old.rstrip('/').rsplit('__v', 1)[0]}__v{uuid.uuid4().hex}"
    _write(df, folder, layout)
    if not layout and spark.table(table).dtypes == df.dtypes:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.sql(f"REFRESH TABLE {table}")
        remove(spark, old)
        return
    columns = [*[c for c in df.columns if c not in layout], *layout]
    _declare(spark, f"{table}__next", ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns), layout, folder)
    _complete(spark, table)


def _declare(spark: SparkSession, table: str, columns: str, layout: list[str], folder: str) -> None:
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in layout)})" if layout else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parts} LOCATION '{folder}'")
    if layout:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def _complete(spark: SparkSession, table: str) -> None:
    """Finish a replacement that has its new version declared."""
    if not spark.catalog.tableExists(f"{table}__next"):
        return
    folder = _location(spark, f"{table}__next")
    schema = spark.table(f"{table}__next").schema
    layout = [c.name for c in spark.catalog.listColumns(f"{table}__next") if c.isPartition]
    if spark.catalog.tableExists(table) and _location(spark, table) != folder:
        drop_table(spark, table)
    if not spark.catalog.tableExists(table):
        _declare(spark, table, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), layout, folder)
    spark.sql(f"DROP TABLE {table}__next")  # external: its files stay


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table with its files, whether the catalog owns them or not."""
    if spark.catalog.tableExists(table):
        folder = _location(spark, table)
        spark.sql(f"DROP TABLE {table}")
        remove(spark, folder)


def append_run(
    df: DataFrame,
    table: str,
    cfg: Config,
    run_column: str = "archive_run_id",
    day: str | None = None,
    cluster_by: str | None = None,
) -> None:
    """Append one run's rows. The table is partitioned by run, below its ``day`` if one is named,
    so repeating a run replaces its rows instead of adding them twice, and readers can skip days.
    ``cluster_by`` sorts a run's files, so that filters on it skip row groups."""
    spark = df.sparkSession
    stamped = drop_internal(df).withColumn(run_column, F.lit(cfg.run_id))
    layout = [*([day] if day else []), run_column]
    if cluster_by:
        stamped = stamped.repartitionByRange(cluster_by).sortWithinPartitions(cluster_by)
    if not spark.catalog.tableExists(table):
        create_table(stamped, table, *layout)
        return
    fitting, lost = _aligned(stamped, table)
    if lost is not None:
        _keep_unreadable(lost, f"{table}_unreadable", cfg)
    held = _replace_partitions(fitting, table, layout)
    # partitions of an earlier attempt of this run that it no longer has
    mine = f"{run_column}={cfg.run_id}"
    stale = [p for p in _partitions(spark, table) if p not in held and unquote(p.split("/")[-1]) == mine]
    for path in stale:
        old = _location(spark, table, _named(path))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_named(path)}")
        remove(spark, old)


def list_run_keys(df: DataFrame, table: str, key: str, cfg: Config, day: str) -> None:
    """Keep the distinct keys of a run in ``<table>_keys``, for ``runs_holding``. To be called before the
    run is appended: a run that is not listed yet is always read."""
    append_run(df.select(day, key).distinct(), f"{table}_keys", cfg, day=day)


def runs_holding(
    spark: SparkSession, table: str, wanted: DataFrame, key: str, run_column: str = "archive_run_id"
) -> DataFrame:
    """A table appended by runs, without the partitions of runs that hold none of the ``wanted`` keys.

    The lists of keys are read instead of the rows; runs without a list stay. The runs' names are
    literals that prune the scan: no more of them than the catalog lists for the table.
    """
    rows = spark.table(table)
    if not spark.catalog.tableExists(f"{table}_keys"):
        return rows
    listed = spark.table(f"{table}_keys")
    holding = listed.join(wanted.select(key).distinct(), key, "left_semi").select(run_column).distinct()
    idle = {r[0] for r in listed.select(run_column).distinct().collect()} - {r[0] for r in holding.collect()}
    return rows.where(~F.col(run_column).isin(sorted(idle))) if idle else rows


def _keep_unreadable(lost: DataFrame, table: str, cfg: Config) -> None:
    if not lost.isEmpty():
        append_run(lost, table, cfg)


def _aligned(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame | None]:
    """Columns in the table's order; absent ones NULL, new ones added to the table first.

    Values that the stored type cannot hold do not fail the run: the second frame has the rows
    with such a value, as text where types differ, and the first one the rest. It is None if all types agree."""
    spark = df.sparkSession
    known = {f.name: f.dataType for f in spark.table(table).schema.fields}
    extra = [f for f in df.schema.fields if f.name not in known]
    if extra:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    stored = spark.table(table).schema.fields
    changed = [f for f in stored if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    lost = F.lit(False)
    for f in changed:
        lost = lost | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    fitting = df.where(~lost).select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f in changed else F.col(f.name)).alias(f.name)
            if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in stored
        ]
    )
    as_text = {f.name: F.col(f.name).cast("string") for f in changed}
    return fitting, df.where(lost).withColumns(as_text) if changed else None


def _partitions(spark: SparkSession, table: str) -> set[str]:
    return {r[0] for r in partitions_of(spark, table).collect()}


def _named(path: str) -> str:
    """A partition's folder ``a=1/b=2`` as SQL names it."""
    parts = []
    for one in path.split("/"):
        column, value = one.split("=", 1)
        value = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"`{unquote(column)}`=" + ("NULL" if value == "__HIVE_DEFAULT_PARTITION__" else f"'{value}'"))
    return f"PARTITION ({', '.join(parts)})"


def _replace_partitions(df: DataFrame, table: str, layout: list[str]) -> set[str]:
    """Replace exactly the partitions that ``df`` has rows of; all others stay. Returns their names.

    The new files lie in a folder of their own below the table's, which plain listing ignores. Partitions
    the table lacks are added in one step; then each of the others is pointed at its new folder and its
    old files are removed.
    """
    spark = df.sparkSession
    root = _location(spark, table)
    folder = f"{root.rstrip('/')}/_v{uuid.uuid4().hex}"
    _write(df, folder, layout)
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(folder + "/*=*" * len(layout))
    listed = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    made = {"/".join(str(x.getPath()).split("/")[-len(layout) :]) for x in listed}
    known = _partitions(spark, table)
    place = lambda path: f"LOCATION '{folder}/{path}'"
    if fresh := sorted(made - known):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"{_named(p)} {place(p)}" for p in fresh))
    for path in sorted(made & known):
        old = _location(spark, table, _named(path))
        spark.sql(f"ALTER TABLE {table} {_named(path)} SET {place(path)}")
        remove(spark, old)
    spark.sql(f"REFRESH TABLE {table}")
    return made


def replace_days(df: DataFrame, table: str, day: str) -> None:
    """Replace the partitions of the days that ``df`` has rows of; other days stay."""
    if not df.sparkSession.catalog.tableExists(table):
        create_table(df, table, day)
        return
    _replace_partitions(df.select(*df.sparkSession.table(table).columns), table, [day])


def touched_partitions(target: DataFrame, batch: DataFrame, partition_by: str) -> DataFrame:
    """The part of a table whose partitions a batch touches, the NULL partition included.

    The values are literals, so they prune the scan whatever their number. A batch touches no more
    partitions than the catalog lists for its table, which the overwrite has to name anyway.
    """
    values = [row[0] for row in batch.select(partition_by).distinct().collect()]
    named = F.col(partition_by).isin([v for v in values if v is not None])
    return target.where(named | F.col(partition_by).isNull() if None in values else named)


def publish_merge(
    source: DataFrame,
    table: str,
    keys: list[str],
    cfg: Config,
    partition_by: str | None = None,
    how: str = "upsert",
    unreadable: str | None = None,
    guard: str | None = None,
    folds: dict[str, Callable[[str], Column]] | None = None,
) -> None:
    """Merge a batch into a table. With a partition column that the key determines, only the
    partitions the batch touches are read and rewritten; the rest is left alone.

    Rows with a value that the stored column's type cannot hold are kept as they came in the
    table ``unreadable`` (by default ``<table>_unreadable``); the others are merged.

    With ``guard``, a column such as a day, a row that is older than the stored one of its key
    changes nothing: late batches do not take a table of latest rows back in time.

    With ``folds``, an aggregate for every column besides the keys, stored and arriving rows of a key
    are combined instead of replaced."""
    spark = source.sparkSession
    # checked, pruned by and merged: evaluated once
    with staged(drop_internal(source), f"{table}-{cfg.run_id}") as batch:
        require_unique(batch, keys)
        _complete(spark, table)
        if not spark.catalog.tableExists(table):
            create_table(batch, table, partition_by)
            return
        known = spark.table(table).columns
        if how == "synced" and set(known) != set(batch.columns):
            create_table(merge_synced(spark.table(table), batch, keys), table, partition_by)
            return
        if how != "common_columns":
            batch, lost = _aligned(batch, table)
            if lost is not None:
                _keep_unreadable(lost, unreadable or f"{table}_unreadable", cfg)
        target = spark.table(table)
        if partition_by:
            target = touched_partitions(target, batch, partition_by)
        merge = partial(merge_newest, by=guard) if guard else MERGES[how]
        if folds:
            merge = partial(merge_folded, folds=folds)
        merged = merge(target, batch, keys).select(*target.columns)
        if partition_by:
            _replace_partitions(merged, table, [partition_by])
        else:
            create_table(merged, table)


def write_clustered(
    df: DataFrame, table: str, cluster_by: list[str], partition_by: str | None = None,
    files: int | None = None,
) -> None:
    """Lay a table out so that filters on any of the cluster columns skip files and row groups: the
    first column alone decides no more than the others do."""
    create_table(clustered(df, cluster_by, files, partition_by), table, partition_by)


# --- logs ------------------------------------------------------------------------------------


def log_row(
    spark: SparkSession, source: str, status: str, rows: int, cfg: Config,
    error: str = "", retries: int = 0,
) -> DataFrame:
    row = (cfg.run_ts, cfg.run_date, source, status, rows, retries, error)
    return spark.createDataFrame([row], LOG_COLUMNS)


def append_log(rows: DataFrame, table: str) -> None:
    rows.coalesce(1).write.format("parquet").mode("append").saveAsTable(table)


def log_schema_changes(batch: DataFrame, table: str, log: str, cfg: Config) -> None:
    """All changes of a batch in one append."""
    spark = batch.sparkSession
    stored = spark.table(table).schema if spark.catalog.tableExists(table) else None
    append_log(schema_diff(spark, table, stored, batch.schema, cfg), log)


def audited(
    spark: SparkSession, table: str, log: str, cfg: Config, step: Callable[[], None],
    status: str = "SUCCESS",
) -> int:
    """Run a publishing step; log its grade and the table's rows, or FAILURE and raise again."""
    try:
        step()
        rows = spark.table(table).count()
    except Exception:
        append_log(log_row(spark, table, "FAILURE", 0, cfg, traceback.format_exc()), log)
        raise
    append_log(log_row(spark, table, status, rows, cfg), log)
    return rows
