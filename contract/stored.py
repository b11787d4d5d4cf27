"""Queries on stored tables, their logs and layouts, and on lists that only fail where they are not empty."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from candlewick.operators import asof, dims, limits, load, merge, pick, quality, tenure
from candlewick.plans import publish, silver
from candlewick.sources import landing, tables
from candlewick.staging import stage
from contract import fixtures as fx
from contract.fixtures import CFG, table
from contract.queries import (
    REGISTRY,
    VERSION,
    VERSION_DATES,
    _market_facts,
    _read_back,
    _read_back_runs,
    register,
)
from contract.sql import build

# --- tenure and layout -------------------------------------------------------------------------


@register(
    "published_tenure",
    build("SELECT coin_id AS id, count(DISTINCT universe_date) AS days_in_universe FROM universe WHERE is_active GROUP BY 1", "universe"),
)
def _(spark, sf):
    """Members stored in three runs, of which the second brings days of the first again."""
    members = stage(fx.universe(spark, sf), "universe")
    bounds = members.agg(F.min("universe_date").alias("a"), F.datediff(F.max("universe_date"), F.min("universe_date")).alias("n"))
    at = lambda share: bounds.select(F.date_add("a", (F.col("n") * share).cast("int"))).scalar()
    day = F.col("universe_date")
    parts = day <= at(0.5), day.between(at(0.3), at(0.7)), day > at(0.7)
    store = lambda rows: lambda t: publish.store_tenure(rows, t, f"{t}_log", CFG)
    found = _read_back_runs(spark, "tenure", *[store(members.where(part)) for part in parts])
    return tenure.days_in_universe(found)


@register(
    "published_clustered",
    """SELECT o_custkey, o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
      WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1995-04-01'""",
)
def _(spark, sf):
    """Orders clustered by customer, day and price, read by a range of the second column."""
    orders = table(spark, sf, "orders")

    def first(name):
        tables.create_table(orders, name)

    def again(name):
        publish.store_clustered(spark, name, ["o_custkey", "o_orderdate", "o_totalprice"], f"{name}_log", CFG, files=16)

    found = _read_back_runs(spark, "clustered", first, again)
    quarter = found.where("o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1995-04-01'")
    return quarter.select("o_custkey", "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@register(
    "published_limits",
    """SELECT quantile_disc(value, 0.01) AS value_p01, quantile_disc(value, 0.5) AS value_p50, quantile_disc(value, 0.9) AS value_p90,
        quantile_disc(value, 0.99) AS value_p99, CAST(quantile_disc(hour(ts), 0.75) AS DOUBLE) AS hour_p75 FROM events""",
)
def _(spark, sf):
    """Limits over all events from counts of the first half and then of the rest, with the middle day twice."""
    events = table(spark, sf, "events").select(F.to_date("ts").alias("day"), "value", F.hour("ts").alias("hour"))
    bounds = events.agg(F.expr("date_add(min(day), CAST(datediff(max(day), min(day)) / 2 AS INT))").alias("middle"))
    middle, name = bounds.select("middle").scalar(), f"counts_{uuid.uuid4().hex[:12]}"
    values = {"value": F.col("value"), "hour": F.col("hour")}
    for rows in (events.where(F.col("day") <= middle), events.where(F.col("day") >= middle)):
        publish.store_counts(rows, values, name, "day", f"{name}_log", CFG)
    shares = {"value_p01": ("value", 0.01), "value_p50": ("value", 0.5), "value_p90": ("value", 0.9), "value_p99": ("value", 0.99), "hour_p75": ("hour", 0.75)}
    found = limits.limits(events, values, shares, spark.table(f"{name}_cuts"), spark.table(name), most_rows=1_000)
    for suffix in ("", "_cuts", "_log"):
        tables.drop_table(spark, f"{name}{suffix}")
    return found


# --- logs, catalog, quarantine -----------------------------------------------------------------


@register(
    "published_log",
    """WITH runs AS (SELECT row_number() OVER (ORDER BY o_orderstatus) AS run, count(*) AS n FROM orders GROUP BY o_orderstatus),
      doubled AS (SELECT count(*) AS n FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1))
    SELECT run, 'SUCCESS' AS status, CAST(sum(n) OVER (ORDER BY run) AS BIGINT) AS rows_written, false AS failed, '2024-01-31' AS ingestion_date FROM runs
    UNION ALL SELECT max(run) + 1, 'FAILURE', 0, true, '2024-01-31' FROM runs, doubled WHERE doubled.n > 0 GROUP BY ALL""",
)
def _(spark, sf):
    """The log of one audited run for each status, and of a merge whose key several rows claim."""
    orders = table(spark, sf, "orders")
    name = f"audited_{uuid.uuid4().hex[:12]}"
    log = f"{name}_log"
    states = [r[0] for r in orders.select("o_orderstatus").distinct().orderBy("o_orderstatus").collect()]
    for i, state in enumerate(states):
        rows, cfg = orders.where(F.col("o_orderstatus") == state), replace(CFG, run_id=state, run_ts=CFG.run_ts.replace(hour=i + 1))
        tables.audited(spark, name, log, cfg, lambda rows=rows, cfg=cfg: tables.append_run(rows, name, cfg))
    late = replace(CFG, run_ts=CFG.run_ts.replace(hour=len(states) + 1))
    try:
        tables.audited(spark, name, log, late, lambda: tables.publish_merge(orders, name, ["o_custkey"], late))
    except ValueError:
        pass  # what the log is to show
    found = stage(spark.table(log), log)
    for made in (name, log):
        tables.drop_table(spark, made)
    failed = F.col("error_message").contains("several source rows")
    return found.select(F.hour("log_timestamp").alias("run"), "status", "rows_written", failed.alias("failed"), "ingestion_date")


@register(
    "published_schema_log",
    """SELECT 'SCHEMA_INITIALISED' AS change_type, column_name, '' AS old_dtype,
        CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
          WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date' ELSE 'timestamp_ntz' END AS new_dtype
      FROM information_schema.columns WHERE table_name = 'customer'
    UNION ALL SELECT 'TYPE_CHANGED', column_name, 'bigint', 'string' FROM information_schema.columns
      WHERE table_name = 'customer' AND column_name = 'c_custkey' AND data_type = 'BIGINT'
    UNION ALL SELECT 'COLUMN_ADDED', 'c_region', '', 'string'""",
)
def _(spark, sf):
    """The schema log of a first batch of customers and of one with a region and keys as text."""
    first = table(spark, sf, "customer")
    second = first.withColumns({"c_custkey": F.col("c_custkey").cast("string"), "c_region": F.col("c_mktsegment")})
    name = f"drifting_{uuid.uuid4().hex[:12]}"
    log = f"{name}_schema"
    tables.log_schema_changes(first, name, log, CFG)
    tables.publish_merge(first, name, ["c_custkey"], CFG)
    tables.log_schema_changes(second, name, log, CFG)
    found = stage(spark.table(log), log)
    for made in (name, log):
        tables.drop_table(spark, made)
    return found.select("change_type", "column_name", "old_dtype", "new_dtype")


@register(
    "catalog_partitions",
    "SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS partition, true AS table_found FROM orders",
)
def _(spark, sf):
    """A table in a database of its own, made current for the time, and what the catalog tells of it."""
    before, database = spark.catalog.currentDatabase(), f"catalog_{uuid.uuid4().hex[:12]}"
    tables.use_database(spark, database)
    try:
        tables.create_table(table(spark, sf, "orders"), "orders_by_status", "o_orderstatus")
        listed = stage(tables.partitions_of(spark, "orders_by_status"), database)
        found = spark.catalog.tableExists(f"{database}.orders_by_status")
        tables.drop_table(spark, "orders_by_status")
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
    return listed.select("partition", F.lit(found).alias("table_found"))


def _facts_table(suffix: str, *columns: str):
    def query(spark, sf):
        facts = _market_facts(spark, sf)
        held = silver.Facts(*(stage(x, "facts") for x in (facts.clean, facts.quarantine, facts.stale)))
        kept = []

        def store(name):
            publish.store_facts(held, name, publish.MARKET_KEYS, f"{name}_log", CFG)
            kept.append(stage(spark.table(f"{name}_{suffix}"), suffix))

        _read_back(spark, suffix, store)
        return kept[-1].select(*columns)

    return query


register(
    "published_quarantine",
    build(
        """SELECT id, ingestion_date, 'contract' AS quarantine_run_id FROM bronze_days WHERE n % 13 = 0""",
        "bronze_days",
        dates=("ingestion_date",),
    ),
)(_facts_table("quarantine", "id", "ingestion_date", "quarantine_run_id"))

register(
    "published_stale",
    build(
        "SELECT id, ingestion_date, 'contract' AS stale_run_id FROM mdays WHERE n % 17 = 0", "mdays", dates=("ingestion_date",)
    ),
)(_facts_table("stale", "id", "ingestion_date", "stale_run_id"))


# --- landing -----------------------------------------------------------------------------------


@register(
    "landed_market",
    build(
        """SELECT id, symbol, current_price, total_volume, market_cap_rank, max_supply, received AS coins_received,
             40 AS coins_expected, CASE WHEN received >= 40 THEN 'SUCCESS' WHEN received >= 32 THEN 'PARTIAL_LOAD'
               WHEN received >= 20 THEN 'PARTIAL_LOAD_CRITICAL' WHEN received >= 4 THEN 'PARTIAL_LOAD_SEVERE' ELSE 'FAILURE' END AS load_status,
             '/coins/markets' AS source_api, '2024-01-31' AS ingestion_date
           FROM mdays, (SELECT count(DISTINCT id) AS received FROM mdays)""",
        "mdays",
    ),
)
def _(spark, sf):
    """Payloads of all market days, parsed by the declared schema, typed, graded and stamped."""
    records = fx.market_days(spark, sf).drop("ingestion_date", "load_status", "pipeline_run_id", "ingestion_timestamp", "n")
    text = stage(records.select(F.to_json(F.struct("*")).alias("value")), "payloads")
    parsed = text.select(F.from_json("value", landing.MARKET_SCHEMA).alias("r")).select("r.*")
    landed = landing.land_market(parsed, replace(CFG, expected_entities=40))
    return landed.select(
        "id", "symbol", "current_price", "total_volume", "market_cap_rank", "max_supply", "coins_received",
        "coins_expected", "load_status", "source_api", "ingestion_date",
    )


# --- lists that guards read --------------------------------------------------------------------


@register(
    "merge_ambiguous",
    "SELECT l_orderkey, l_suppkey, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(spark, sf):
    return merge.ambiguous_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"])


@register(
    "missing_recent_days",
    """SELECT strftime(d, '%Y-%m-%d') AS missing_date
      FROM (SELECT CAST(unnest(generate_series(DATE '1990-01-01', DATE '1999-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
      WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
)
def _(spark, sf):
    return load.missing_recent_days(table(spark, sf, "orders"), "o_orderdate", 3652, replace(CFG, run_ts=datetime(2000, 1, 1)))


@register(
    "overlapping_versions",
    build("SELECT id, scd_version FROM dim WHERE scd_version > 1", "dim"),
)
def _(spark, sf):
    """Every version ends a day late, so each successor starts before its predecessor's end."""
    late = fx.dim(spark, sf).withColumn("effective_to", F.date_add("effective_to", 1))
    return asof.overlapping_versions(late).select("id", "scd_version")


@register(
    "scd2_initial",
    build(
        f"""SELECT * REPLACE (CAST(NULL AS DATE) AS effective_to, true AS is_current)
        FROM (SELECT {', '.join(VERSION)} FROM dim WHERE scd_version = 1)""",
        "dim",
        dates=VERSION_DATES,
    ),
)
def _(spark, sf):
    """The initial load from every entity's first day."""
    first = pick.first_per_key(fx.attributes(spark, sf), ["id"], [F.col("effective_from")])
    return dims.scd2_init(first).select(*VERSION)


@register("dim_history", REGISTRY["scd2_history"][1])
def _(spark, sf):
    return dims.version_history(fx.dim(spark, sf)).select(*VERSION)


@register(
    "checks_by_keys",
    """SELECT 'line_unique' AS "check", f = 0 AS passed, f AS failing_rows FROM (SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS f FROM lineitem)
      UNION ALL SELECT 'supply_unique', f = 0, f FROM (SELECT count(*) - count(DISTINCT (l_orderkey, l_suppkey)) AS f FROM lineitem)
      UNION ALL SELECT 'discounted', f = 0, f FROM (SELECT count(*) FILTER (WHERE l_discount > 0.05 AND l_linenumber > 2) AS f FROM lineitem)""",
)
def _(spark, sf):
    """Two keys and a row rule, counted while the lines are read once."""
    rule = quality.Rule
    rules = [
        rule("line_unique", unique=("l_orderkey", "l_linenumber")),
        rule("supply_unique", unique=("l_orderkey", "l_suppkey")),
        rule("discounted", failing="l_discount > 0.05 AND l_linenumber > 2"),
    ]
    return quality.validate(table(spark, sf, "lineitem"), rules)
