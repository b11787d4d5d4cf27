"""Every registered query with its oracle: ``REGISTRY[name] = (callable, sql or None)``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions import labels
from candlewick.operators import (
    asof,
    clean,
    dims,
    indicators,
    load,
    market,
    merge,
    pick,
    quality,
    rollup,
    series,
)
from candlewick.operators.quantiles import quantiles
from candlewick.operators.schema import reconcile_schema, schema_diff
from candlewick.plans import gold, publish, silver, views
from candlewick.session import shared_dir
from candlewick.sources import landing, tables
from candlewick.staging import remove, stage
from contract import fixtures as fx
from contract import sql as s
from contract.fixtures import CFG, edge, table
from contract.sql import build, mean, rnd

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}
MADE: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def keep(fn: Query) -> Query:
        MADE[name] = fn
        REGISTRY[name] = (lambda spark, sf: edge(fn(spark, sf)), sql)
        return fn

    return keep


CANDLE = ["coin_id", "candle_datetime"]
KEYED = "coin_id, candle_datetime"
EXACT = replace(CFG, exact_quantiles=True)


# --- sources ---------------------------------------------------------------------------------


@register(
    "candles_4h",
    build("SELECT * FROM candles", "candles", dates=("candle_date",), stamps=("candle_datetime",)),
)
def _(spark, sf):
    return fx.candles(spark, sf)


@register(
    "ohlc_payload_rows",
    build(
        "SELECT * EXCLUDE (ticks) FROM candles",
        "candles",
        dates=("candle_date",),
        stamps=("candle_datetime",),
    ),
)
def _(spark, sf):
    """Payload arrays (one per coin and day, six candles) back to typed candle rows."""
    row = F.array(F.col("timestamp_ms").cast("double"), "open", "high", "low", "close")
    payloads = (
        fx.candles(spark, sf)
        .groupBy("coin_id", "candle_date")
        .agg(F.collect_list(row).alias("ohlc"))
    )
    return landing.with_candle_time(landing.explode_ohlc(payloads))


HOT_GROUPS = """hourly AS (
  SELECT CAST(ts AS DATE) AS ingestion_date, event_type || '-' || hour(ts) AS coin_id,
         count(*) AS n FROM events GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ingestion_date ORDER BY n DESC, coin_id) - 1
             AS place FROM hourly)"""


def _trending_payloads(spark, sf):
    """Per day the seven busiest (type, hour) groups as one nested JSON document."""
    hourly = (
        table(spark, sf, "events")
        .groupBy(
            F.to_date("ts").alias("ingestion_date"),
            F.concat_ws("-", "event_type", F.hour("ts").cast("string")).alias("id"),
        )
        .agg(F.count("*").alias("n"))
    )
    top = pick.first_per_key(hourly, ["ingestion_date"], [F.col("n").desc(), F.col("id")], n=7)
    items = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "id", "n")))
    listed = F.transform(
        items,
        lambda x, i: F.struct(
            F.struct(
                x["id"].alias("id"),
                F.concat(F.lit("Coin "), x["id"]).alias("name"),
                x["id"].alias("symbol"),
                x["n"].cast("int").alias("market_cap_rank"),
                F.when(i > 0, i).alias("score"),
            ).alias("item")
        ),
    )
    return top.groupBy("ingestion_date").agg(
        F.to_json(F.struct(listed.alias("coins"))).alias("payload")
    )


@register(
    "trending_rows",
    f"""WITH {HOT_GROUPS}
    SELECT strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date, coin_id,
      'Coin ' || coin_id AS name, coin_id AS symbol, n AS market_cap_rank,
      CAST(NULL AS VARCHAR) AS thumb, nullif(place, 0) AS score, place + 1 AS trending_rank
    FROM ranked WHERE place < 7""",
)
def _(spark, sf):
    return landing.parse_trending(_trending_payloads(spark, sf), "payload")


@register(
    "trending",
    build(
        """SELECT place + 1 AS trending_rank, r.coin_id, 'Coin ' || r.coin_id AS name,
             r.coin_id AS symbol, n AS market_cap_rank, p.current_price, p.market_cap,
             p.total_volume, p.price_change_percentage_24h,
             CAST(NULL AS VARCHAR) AS performance_label, CAST(NULL AS VARCHAR) AS trading_signal,
             strftime(r.ingestion_date, '%Y-%m-%d') AS ingestion_date,
             '2024-01-31 00:00:00' AS gold_updated_at
           FROM ranked r LEFT JOIN prices p USING (coin_id) WHERE place < 7""",
        extra={
            "hourly": HOT_GROUPS.split("hourly AS (")[1].split("),\nranked")[0],
            "ranked": "SELECT *, row_number() OVER (PARTITION BY ingestion_date "
            "ORDER BY n DESC, coin_id) - 1 AS place FROM hourly",
            "prices": """SELECT event_type || '-' || hour(ts) AS coin_id,
                max(value) AS current_price, CAST(count(*) AS DOUBLE) AS market_cap,
                min(value) AS total_volume, CAST(NULL AS DOUBLE) AS price_change_percentage_24h
                FROM events GROUP BY 1 QUALIFY count(*) * count(*) OVER () >= sum(count(*)) OVER ()""",
        },
    ),
)
def _(spark, sf):
    rows = landing.parse_trending(_trending_payloads(spark, sf), "payload")
    busy = (
        table(spark, sf, "events")
        .groupBy(F.concat_ws("-", "event_type", F.hour("ts").cast("string")).alias("id"))
        .agg(
            F.max("value").alias("current_price"),
            F.count("*").alias("n"),
            F.min("value").alias("total_volume"),
            F.lit(None).cast("double").alias("price_change_percentage_24h"),
        )
    )
    # the snapshot lists the entities that are as busy as the average one; the others have no price
    usual = busy.agg(F.sum("n").alias("all_n"), F.count("*").alias("entities"))
    snapshot = busy.join(F.broadcast(usual), F.col("n") * F.col("entities") >= F.col("all_n"))
    return gold.trending_enriched(rows, snapshot.withColumn("market_cap", F.col("n").cast("double")), CFG)


# --- daily roll-up ---------------------------------------------------------------------------

DAILY = f"""SELECT coin_id, candle_date, arg_min(open, candle_datetime) AS open, max(high) AS high,
  min(low) AS low, arg_max(close, candle_datetime) AS close, count(*) AS candle_count,
  count(*) FILTER (WHERE {s.DIRECTION} = 'BULL') AS bull_candles,
  count(*) FILTER (WHERE {s.DIRECTION} = 'BEAR') AS bear_candles
  FROM {{0}} GROUP BY 1, 2"""
DAY_SHAPE = f"""{s.DIRECTION} AS daily_candle_direction, {rnd(s.BODY, 3)} AS daily_body_pct,
  {rnd('CASE WHEN open > 0 THEN (high - low) / open * 100 END', 3)} AS daily_range_pct,
  {rnd('CASE WHEN bear_candles > 0 THEN CAST(bull_candles AS DOUBLE) / bear_candles END', 3)}
    AS bull_bear_ratio"""


@register(
    "ohlc_daily",
    build(
        f"SELECT *, {DAY_SHAPE} FROM daily",
        "candles",
        extra={"daily": DAILY.format("candles")},
        dates=("candle_date",),
    ),
)
def ohlc_daily(spark, sf):
    days = rollup.with_day_shape(rollup.daily_candles(fx.candles(spark, sf)))
    return gold.round_by_category(days, CFG, price=("open", "high", "low", "close"))


SCORES = f"""{rnd(mean('recommendation_score'), 4)} AS avg_recommendation_score,
  {rnd('quantile_disc(recommendation_score, 0.25)', 4)} AS p25_recommendation_score,
  {rnd('quantile_disc(recommendation_score, 0.75)', 4)} AS p75_recommendation_score"""


@register(
    "ohlc_daily_scores",
    build(
        f"SELECT coin_id, candle_date, {SCORES} FROM featured GROUP BY 1, 2",
        "featured",
        dates=("candle_date",),
    ),
)
def _(spark, sf):
    return rollup.daily_scores(fx.featured(spark, sf), CFG)


_closing = ", ".join(
    f"arg_max_null({c}, candle_datetime) AS {c}" for c in rollup.CLOSING_SIGNALS
)


def history_sql(source: str) -> dict[str, str]:
    """Blocks of the daily history over a featured candle block."""
    rounded = [
        f"{rnd(c, 6 if c.startswith('vola') else 4)} AS {c}"
        for c in (
            "ma_7d", "ma_14d", "ma_30d", "volatility_7d", "volatility_14d", "volatility_30d",
            "support_14d", "resistance_14d", "support_30d", "resistance_30d",
        )
    ]
    scores = [
        f"{rnd(c, 3)} AS {c}"
        for c in (
            "momentum_7d", "avg_range_pct", "avg_recommendation_score",
            "p25_recommendation_score", "p75_recommendation_score", "close_recommendation_score",
        )
    ]
    return {
        "hday": DAILY.format(source).replace(
            "count(*) AS candle_count",
            f"count(*) AS candle_count, {_closing}, {mean('daily_range_pct')} AS avg_range_pct, "
            f"count(anomaly_flag) AS anomaly_candle_count, {SCORES}, "
            "arg_max_null(recommendation_score, candle_datetime) AS close_recommendation_score",
        ),
        "history": f"SELECT *, {DAY_SHAPE} FROM hday",
        "history_r": f"SELECT * REPLACE ({', '.join(rounded + scores)}) FROM history",
    }


@register(
    "ohlc_history",
    build(
        "SELECT *, '2024-01-31 00:00:00' AS gold_updated_at FROM history_r",
        "featured",
        extra=history_sql("featured"),
        dates=("candle_date",),
    ),
)
def _(spark, sf):
    return gold.ohlc_history(fx.featured(spark, sf), CFG)


# --- load quality ----------------------------------------------------------------------------


@register("load_grade", build("SELECT * FROM grades", "grades", dates=("ingestion_date",)))
def _(spark, sf):
    return load.grade_batches(fx.partial_batches(spark, sf), CFG)


@register(
    "load_grade_candles",
    build(
        f"""SELECT candle_date, count(DISTINCT coin_id) AS coins_received, 8 AS coins_expected,
            {s.grade('count(DISTINCT coin_id)', '8')} AS load_status FROM candles GROUP BY 1""",
        "candles",
        dates=("candle_date",),
    ),
)
def _(spark, sf):
    wanted = replace(CFG, expected_entities=8)
    return load.grade_batches(fx.candles(spark, sf), wanted, "coin_id", "candle_date")


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount",
              "l_tax"]


@register(
    "dedup_keep_first",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY {', '.join(LINE_ORDER)}) = 1""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    kept = pick.first_per_key(lines, LINE_KEY, [F.col(c).asc_nulls_last() for c in LINE_ORDER])
    return kept.select(*LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


@register(
    "dedup_conflicts",
    f"""WITH kept AS (SELECT *, first_value(l_extendedprice) OVER (PARTITION BY l_orderkey,
      l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS kept_price FROM lineitem)
    SELECT l_orderkey, l_linenumber, count(*) AS row_count, min(kept_price) AS kept_price,
      min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
      bool_or(l_extendedprice IS DISTINCT FROM kept_price) AS is_conflict
    FROM kept GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(spark, sf):
    return pick.dedup_conflicts(
        table(spark, sf, "lineitem"), LINE_KEY, LINE_ORDER, "l_extendedprice"
    )


@register(
    "dedup_ids",
    """SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1
    ORDER BY 2, 1 LIMIT 20""",
)
def _(spark, sf):
    return pick.first_ids(table(spark, sf, "events"), "user_id", "event_id", 20)


@register(
    "fill_slots",
    build(
        """SELECT id, ingestion_date, current_price FROM partial
           UNION ALL
           SELECT u.id, u.ingestion_date, u.current_price FROM (
             SELECT m.*, row_number() OVER (PARTITION BY m.ingestion_date
               ORDER BY m.market_cap_rank, m.id) AS rn
             FROM mdays m ANTI JOIN partial p USING (ingestion_date, id)) u
           JOIN (SELECT ingestion_date, 20 - count(*) AS missing FROM partial GROUP BY 1) h
             USING (ingestion_date)
           WHERE rn <= missing""",
        "partial",
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    kept, extra = fx.partial_batches(spark, sf), fx.market_days(spark, sf)
    filled = pick.fill_slots(kept, extra, "ingestion_date", "id", "market_cap_rank", CFG)
    return filled.select("id", "ingestion_date", "current_price")


@register(
    "trim_batches",
    build(
        """SELECT ingestion_date, id, market_cap_rank FROM mdays
        QUALIFY row_number() OVER (PARTITION BY ingestion_date ORDER BY market_cap_rank, id) <= 10""",
        "mdays",
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    days = fx.market_days(spark, sf)
    top = pick.trim_batches(days, "ingestion_date", [F.col("market_cap_rank"), F.col("id")], 10)
    return top.select("ingestion_date", "id", "market_cap_rank")


@register(
    "last_snapshot",
    build(
        """SELECT id, '2024-01-31' AS ingestion_date, '2024-01-31 00:00:00' AS ingestion_timestamp,
             current_price, 'FAILURE' AS load_status, true AS is_fallback,
             'contract' AS pipeline_run_id
           FROM mdays WHERE ingestion_date = (SELECT max(ingestion_date) FROM mdays)""",
        "mdays",
    ),
)
def _(spark, sf):
    snapshot = load.last_snapshot(fx.market_days(spark, sf))
    return load.stamp_fallback(snapshot, labels.FAILURE, CFG).select(
        "id", "ingestion_date", "ingestion_timestamp", "current_price", "load_status",
        "is_fallback", "pipeline_run_id",
    )


CARRIED = ("id", "ingestion_date", "known_date", "current_price", "load_status",
           "coins_received")


@register(
    "stale_reconcile",
    build(
        """SELECT e.id, g.ingestion_date, k.ingestion_date AS known_date, k.current_price,
             'STALE' AS load_status, g.coins_received
           FROM (SELECT DISTINCT id FROM mdays) e
           JOIN grades g ON g.load_status IN ('PARTIAL_LOAD', 'PARTIAL_LOAD_CRITICAL')
           JOIN graded k ON k.id = e.id AND k.ingestion_date = (
             SELECT max(x.ingestion_date) FROM graded x WHERE x.id = e.id
               AND x.ingestion_date <= g.ingestion_date
               AND x.load_status NOT IN ('PARTIAL_LOAD_SEVERE', 'FAILURE'))
           WHERE k.ingestion_date < g.ingestion_date""",
        "graded",
        dates=("ingestion_date", "known_date"),
    ),
)
def _(spark, sf):
    expected = fx.market_days(spark, sf).select("id").distinct()
    return load.carry_forward(fx.graded(spark, sf), expected, CFG).select(*CARRIED)


@register(
    "severe_route",
    build(
        """SELECT 'main' AS destination, ingestion_date, id, ingestion_date AS known_date,
             load_status FROM graded WHERE load_status NOT IN ('PARTIAL_LOAD_SEVERE', 'FAILURE')
           UNION ALL
           SELECT 'quarantine', ingestion_date, id, ingestion_date, load_status FROM graded
             WHERE load_status IN ('PARTIAL_LOAD_SEVERE', 'FAILURE')
           UNION ALL
           SELECT 'main', d.ingestion_date, k.id, k.ingestion_date, d.load_status
           FROM (SELECT b.ingestion_date, b.load_status, max(a.ingestion_date) AS source
                 FROM grades b JOIN grades a ON a.ingestion_date < b.ingestion_date
                   AND a.load_status NOT IN ('PARTIAL_LOAD_SEVERE', 'FAILURE')
                 WHERE b.load_status IN ('PARTIAL_LOAD_SEVERE', 'FAILURE') GROUP BY 1, 2) d
           JOIN graded k ON k.ingestion_date = d.source""",
        "graded",
        dates=("ingestion_date", "known_date"),
    ),
)
def _(spark, sf):
    graded = fx.graded(spark, sf)
    kept, diverted = load.route_severe(graded)

    def to(rows: DataFrame, destination: str, known: str) -> DataFrame:
        return rows.select(
            F.lit(destination).alias("destination"),
            "ingestion_date",
            "id",
            F.col(known).alias("known_date"),
            "load_status",
        )

    return (
        to(kept, "main", "ingestion_date")
        .unionByName(to(diverted, "quarantine", "ingestion_date"))
        .unionByName(to(load.fallback_days(graded, CFG), "main", "known_date"))
    )


@register(
    "severe_route_candles",
    build(
        """SELECT destination, load_status, count(*) AS row_count FROM (
             SELECT 'main' AS destination, load_status FROM graded
             UNION ALL
             SELECT 'quarantine', load_status FROM graded
             WHERE load_status = 'PARTIAL_LOAD_SEVERE') GROUP BY 1, 2""",
        "graded",
    ),
)
def _(spark, sf):
    main, quarantine = load.route_severe(fx.graded(spark, sf), mode="keep")
    both = main.withColumn("destination", F.lit("main")).unionByName(
        quarantine.withColumn("destination", F.lit("quarantine"))
    )
    return both.groupBy("destination", "load_status").agg(F.count("*").alias("row_count"))


@register(
    "archive_fallback",
    build(
        """SELECT coin_id, timestamp_ms, close, false AS filled FROM candles
             WHERE coin_id NOT IN ('click', 'view') OR timestamp_ms % 3 = 0
           UNION ALL
           SELECT coin_id, timestamp_ms, close + 1, true FROM candles
             WHERE coin_id IN ('click', 'view') AND timestamp_ms % 3 <> 0""",
        extra={
            "candles": "SELECT * REPLACE (timestamp_ms // 14400000 AS timestamp_ms) FROM base",
        },
    ).replace("WITH candles", f"WITH base AS ({s.BLOCKS['candles'][1]}), candles"),
)
def _(spark, sf):
    slots = fx.candles(spark, sf).withColumn(
        "timestamp_ms", F.floor(F.col("timestamp_ms") / 14400000)
    )
    base = slots.select("coin_id", "timestamp_ms", "close")
    failed_coin = F.col("coin_id").isin("click", "view")
    current = base.where(~failed_coin | (F.col("timestamp_ms") % 3 == 0)).withColumns(
        {
            "pipeline_run_id": F.lit("r0"),
            "ingestion_date": F.lit(date(2024, 1, 30)),
            "ingestion_timestamp": F.lit(CFG.run_ts),
        }
    )
    archive = base.withColumn("archive_run_id", F.lit("r1")).unionByName(
        base.withColumn("close", F.col("close") + 1).withColumn("archive_run_id", F.lit("r2"))
    )
    failed = base.where(failed_coin).select("coin_id").distinct()
    merged = load.archive_fallback(current, archive, failed, CFG)
    filled = F.coalesce(F.col("is_fallback"), F.lit(False))
    return merged.select("coin_id", "timestamp_ms", "close", filled.alias("filled"))


@register(
    "missing_days",
    """WITH cal AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate),
      INTERVAL 1 DAY)) AS DATE) AS missing_date FROM orders)
    SELECT strftime(missing_date, '%Y-%m-%d') AS missing_date FROM cal
    WHERE missing_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    bounds = orders.agg(
        F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")
    )
    first, last = bounds.select("a").scalar(), bounds.select("b").scalar()
    return load.missing_days(orders, "o_orderdate", first, last)


@register(
    "missing_entity_days",
    """SELECT user_id, strftime(d, '%Y-%m-%d') AS missing_date
    FROM (SELECT user_id, CAST(unnest(generate_series(DATE '2024-01-24', DATE '2024-01-30',
        INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT DISTINCT user_id FROM events)) u
    ANTI JOIN (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events) x USING (user_id, d)""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    return load.missing_entity_days(events, events, "user_id", "ts", 7, CFG)


@register(
    "schema_reconcile",
    """SELECT o_orderkey, o_custkey, o_orderstatus,
      CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice,
      CAST(NULL AS VARCHAR) AS o_orderpriority, o_orderstatus || '!' AS o_note
    FROM orders""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    batch = (
        orders.drop("o_orderpriority", "o_orderdate")
        .withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(15,2)"))
        .withColumn("o_note", F.concat("o_orderstatus", F.lit("!")))
    )
    return reconcile_schema(batch, orders.drop("o_orderdate").schema)


# --- merges ----------------------------------------------------------------------------------

ORDER_OUT = "o_orderkey, o_custkey, o_totalprice, o_orderpriority"


@register(
    "merge_upsert",
    build(
        f"""SELECT {ORDER_OUT} FROM source UNION ALL
        SELECT {ORDER_OUT} FROM target ANTI JOIN source USING (o_orderkey)""",
        "target",
        "source",
    ),
)
def _(spark, sf):
    out = merge.merge_upsert(fx.merge_target(spark, sf), fx.merge_source(spark, sf), ["o_orderkey"])
    return out.select(*ORDER_OUT.split(", "))


@register(
    "merge_insert_only",
    build(
        f"""SELECT {ORDER_OUT} FROM target UNION ALL
        SELECT {ORDER_OUT} FROM source ANTI JOIN target USING (o_orderkey)""",
        "target",
        "source",
    ),
)
def _(spark, sf):
    out = merge.merge_insert_only(
        fx.merge_target(spark, sf), fx.merge_source(spark, sf), ["o_orderkey"]
    )
    return out.select(*ORDER_OUT.split(", "))


@register(
    "merge_common_cols",
    build(
        """SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
             CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END
               AS o_totalprice, t.o_orderpriority
           FROM target t FULL JOIN source s ON t.o_orderkey = s.o_orderkey""",
        "target",
        "source",
    ),
)
def _(spark, sf):
    target = fx.merge_target(spark, sf).select("o_orderkey", "o_totalprice", "o_orderpriority")
    source = fx.merge_source(spark, sf).select(
        "o_orderkey", "o_totalprice", F.lit("ignored").alias("o_extra")
    )
    return merge.merge_common_columns(target, source, ["o_orderkey"])


@register(
    "merge_sync_cols",
    build(
        """SELECT o_orderkey, o_totalprice, 'new' AS o_note FROM source UNION ALL
           SELECT o_orderkey, o_totalprice, NULL FROM target ANTI JOIN source USING (o_orderkey)""",
        "target",
        "source",
    ),
)
def _(spark, sf):
    target = fx.merge_target(spark, sf).select("o_orderkey", "o_totalprice", "o_orderpriority")
    source = fx.merge_source(spark, sf).select(
        "o_orderkey", "o_totalprice", F.lit("new").alias("o_note")
    )
    return merge.merge_synced(target, source, ["o_orderkey"])


@register(
    "dup_check",
    """SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(spark, sf):
    return views.duplicate_grain(table(spark, sf, "lineitem"), LINE_KEY)


# --- cleaning --------------------------------------------------------------------------------


@register(
    "fresh_stale_split",
    build(
        """SELECT CASE WHEN n % 5 = 0 THEN 'stale' ELSE 'fresh' END AS side, id, ingestion_date,
             CASE WHEN n % 5 = 0 THEN 'bronze_partial_load' END AS stale_reason
           FROM mdays""",
        "mdays",
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    n = F.col("n")
    status = F.when(n % 5 == 0, "STALE").when(n % 5 != 1, "SUCCESS")
    fresh, stale = clean.split_fresh_stale(fx.market_days(spark, sf).withColumn("load_status", status))
    both = fresh.withColumn("side", F.lit("fresh")).unionByName(
        stale.withColumn("side", F.lit("stale")), allowMissingColumns=True
    )
    return both.select("side", "id", "ingestion_date", "stale_reason")


@register(
    "lookback",
    build(
        "SELECT coin_id, candle_datetime, close FROM candles "
        "WHERE candle_datetime >= TIMESTAMP '2024-01-21'",
        "candles",
        stamps=("candle_datetime",),
    ),
)
def _(spark, sf):
    recent = clean.within_lookback(
        fx.candles(spark, sf), "candle_datetime", replace(CFG, lookback_days=10)
    )
    return recent.select("coin_id", "candle_datetime", "close")


@register(
    "round_by_category",
    build(
        f"""SELECT id, ingestion_date, {rnd('ath', 4)} AS ath,
          {rnd('ath_change_percentage', 3)} AS ath_change_percentage,
          {rnd('atl_change_percentage', 6)} AS atl_change_percentage,
          {rnd('fully_diluted_valuation', 3)} AS fully_diluted_valuation FROM mdays""",
        "mdays",
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    cols = ("ath", "ath_change_percentage", "atl_change_percentage", "fully_diluted_valuation")
    rows = fx.market_days(spark, sf).select("id", "ingestion_date", *cols)
    return gold.round_by_category(rows, CFG, price=("ath",), ratios=("atl_change_percentage",))


@register(
    "market_clean",
    """WITH raw AS (SELECT CAST(user_id AS VARCHAR) AS id, CAST(ts AS DATE) AS ingestion_date,
        ts AS ingestion_timestamp, event_type AS symbol, event_id,
        CASE WHEN event_id % 9 <> 0 THEN value END AS current_price
      FROM events)
    SELECT id, strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date, symbol, current_price,
      weekofyear(ingestion_date) AS processing_week, month(ingestion_date) AS processing_month,
      year(ingestion_date) AS processing_year
    FROM raw QUALIFY row_number() OVER (PARTITION BY id, ingestion_date
      ORDER BY ingestion_timestamp DESC) = 1""",
)
def _(spark, sf):
    """Raw text rows: padded strings, spaced upper-case names, unreadable numbers, several a day."""
    price = F.when(F.col("event_id") % 9 == 0, "n/a").otherwise(F.col("value").cast("string"))
    raw = table(spark, sf, "events").select(
        F.concat(F.lit(" "), F.col("user_id").cast("string")).alias("ID"),
        F.concat("event_type", F.lit("  ")).alias("Symbol"),
        F.date_format("ts", "yyyy-MM-dd").alias("ingestion date"),
        F.col("ts").cast("string").alias(" Ingestion_Timestamp"),
        price.alias("current price"),
        F.lit("x").alias("Image"),
    )
    rows = clean.prepare_market(clean.normalise_names(raw))
    return rows.select(
        "id", "ingestion_date", "symbol", "current_price", "processing_week",
        "processing_month", "processing_year",
    )


SPOILED = """SELECT CASE WHEN n % 13 = 0 THEN NULL ELSE id END AS id, ingestion_date,
  CASE WHEN n % 11 = 0 THEN NULL WHEN n % 11 = 1 THEN 0e0 ELSE current_price END AS current_price,
  CASE WHEN n % 7 = 0 THEN NULL WHEN n % 7 = 1 THEN -1e0 ELSE market_cap END AS market_cap,
  CASE WHEN n % 5 = 0 THEN NULL WHEN n % 5 = 1 THEN -1e0 ELSE total_volume END AS total_volume
  FROM mdays"""
REASON = """CASE WHEN id IS NULL THEN 'missing_id' WHEN current_price IS NULL THEN 'missing_price'
  WHEN current_price <= 0 THEN 'invalid_price' WHEN market_cap IS NULL THEN 'missing_market_cap'
  WHEN market_cap <= 0 THEN 'invalid_market_cap' WHEN total_volume IS NULL THEN 'missing_volume'
  WHEN total_volume < 0 THEN 'invalid_volume' END"""


def _spoiled(spark, sf):
    n, null = F.col("n"), F.lit(None).cast("double")
    return fx.market_days(spark, sf).select(
        F.when(n % 13 != 0, F.col("id")).alias("id"),
        "ingestion_date",
        F.when(n % 11 == 0, null).when(n % 11 == 1, 0.0).otherwise(F.col("current_price")).alias(
            "current_price"
        ),
        F.when(n % 7 == 0, null).when(n % 7 == 1, -1.0).otherwise(F.col("market_cap")).alias(
            "market_cap"
        ),
        F.when(n % 5 == 0, null).when(n % 5 == 1, -1.0).otherwise(F.col("total_volume")).alias(
            "total_volume"
        ),
    )


@register(
    "market_quarantine",
    build(
        f"SELECT *, {REASON} AS quarantine_reason FROM spoiled",
        "mdays",
        extra={"spoiled": SPOILED},
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    good, bad = quality.split_market(_spoiled(spark, sf), CFG)
    return good.unionByName(bad, allowMissingColumns=True).drop("quarantine_timestamp")


def _tagged(spark, sf):
    rows = fx.dirty_candles(spark, sf)
    return quality.tag_candles(rows, quality.candle_limits(rows, CFG).select("extreme_mult").scalar())


@register(
    "candle_quarantine",
    build(
        """SELECT *, 'bronze_ohlc_data' AS source_table, 'ABC_VALIDATION' AS pipeline_stage,
             '2024-01-31 00:00:00' AS quarantine_timestamp
           FROM tagged WHERE quarantine_reasons <> ''""",
        "tagged",
        dates=("candle_date",),
        stamps=("candle_datetime",),
    ),
)
def _(spark, sf):
    return quality.split_candles(_tagged(spark, sf), "bronze_ohlc_data", CFG)[1]


@register(
    "candle_clean",
    build(
        "SELECT * EXCLUDE (quarantine_reasons) FROM tagged WHERE quarantine_reasons = ''",
        "tagged",
        dates=("candle_date",),
        stamps=("candle_datetime",),
    ),
)
def _(spark, sf):
    return quality.split_candles(_tagged(spark, sf), "bronze_ohlc_data", CFG)[0]


@register(
    "quarantine_hist",
    build(
        f"""SELECT quarantine_reasons, count(*) AS row_count,
          {rnd('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM tagged) * 100', 1)} AS row_pct
        FROM tagged GROUP BY 1""",
        "tagged",
    ),
)
def _(spark, sf):
    return quality.reason_histogram(_tagged(spark, sf))


@register(
    "quantile_limits",
    build(
        f"""SELECT quantile_disc({s.BODY}, 0.99) AS p99_body, quantile_disc({s.BODY}, 0.9) AS p90_body,
          quantile_disc(CASE WHEN open > 0 THEN close / open END, 0.9999) AS p9999_ratio,
          {s.EXTREME} AS extreme_mult FROM gcandles""",
        "gcandles",
    ),
)
def _(spark, sf):
    return quality.candle_limits(fx.group_candles(spark, sf), EXACT)


@register(
    "quantiles_by_type",
    """SELECT event_type, quantile_disc(value, 0.01) AS p1, quantile_disc(value, 0.5) AS p50,
      quantile_disc(value, 0.99) AS p99 FROM events GROUP BY 1""",
)
def _(spark, sf):
    value = F.col("value")
    wanted = {"p1": (value, 0.01), "p50": (value, 0.5), "p99": (value, 0.99)}
    return quantiles(table(spark, sf, "events"), wanted, EXACT, by=("event_type",))


ANOMALY = ("id", "ingestion_date", "price_change_percentage_24h", "price_change_pct_24h_capped",
           "anomaly_flag", "anomaly_reason")


@register(
    "price_winsor",
    build(f"SELECT {', '.join(ANOMALY)} FROM mflag", "mflag", dates=("ingestion_date",)),
)
def _(spark, sf):
    rows = clean.fill_market_gaps(fx.market_days(spark, sf))
    return quality.flag_market_anomalies(rows, CFG).select(*ANOMALY)


SHAPED = ("coin_id", "candle_datetime", "candle_direction", "candle_body_pct", "daily_range_usd",
          "daily_range_pct", "anomaly_flag")


@register(
    "candle_anomaly",
    build(f"SELECT {', '.join(SHAPED)} FROM featured", "featured", stamps=("candle_datetime",)),
)
def _(spark, sf):
    rows = fx.candles(spark, sf)
    bound = quality.candle_limits(rows, CFG).select("p99_body").scalar()
    return indicators.flag_candles(indicators.candle_shape(rows), bound, CFG).select(*SHAPED)


@register(
    "change_flag",
    build(
        "SELECT id, ingestion_date, daily_return_pct, is_changed FROM msilver",
        "msilver",
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    return fx.market_silver(spark, sf).select(
        "id", "ingestion_date", "daily_return_pct", "is_changed"
    )


# --- dimensions ------------------------------------------------------------------------------


@register("dim_date", build("SELECT * FROM ddate", "ddate"))
def _(spark, sf):
    return dims.dim_date(fx.days(spark, sf), CFG)


@register("dim_date_hour", build("SELECT * FROM dhour", "dhour"))
def _(spark, sf):
    return dims.dim_date_hour(fx.days(spark, sf), CFG)


@register(
    "calendar_slices",
    build(
        """SELECT 'today' AS slice, date_actual, CAST(NULL AS BIGINT) AS hour FROM ddate WHERE is_today
           UNION ALL SELECT 'open_hours', date_actual, hour FROM dhour WHERE is_candle_open""",
        "ddate",
        "dhour",
    ),
)
def _(spark, sf):
    days = fx.days(spark, sf)
    today = dims.today_row(dims.dim_date(days, CFG)).select(
        F.lit("today").alias("slice"), "date_actual", F.lit(None).cast("int").alias("hour")
    )
    hours = dims.candle_open_hours(dims.dim_date_hour(days, CFG)).select(
        F.lit("open_hours").alias("slice"), "date_actual", "hour"
    )
    return today.unionByName(hours)


VERSION = ("id", "scd_version", "market_cap_rank", "market_segment", "supply_utilisation_pct",
           "ath_distance_bucket", "is_scarce", "effective_from", "effective_to",
           "is_current")
VERSION_DATES = ("effective_from", "effective_to")


@register(
    "dim_attributes",
    build(
        """SELECT id, ingestion_date, market_segment, supply_utilisation_pct, is_scarce,
             ath_distance_bucket, CAST(NULL AS BIGINT) AS confidentiality_score FROM attrs""",
        "attrs",
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    return fx.attributes(spark, sf).select(
        "id", "ingestion_date", "market_segment", "supply_utilisation_pct", "is_scarce",
        "ath_distance_bucket", "confidentiality_score",
    )


@register(
    "scd2_history", build(f"SELECT {', '.join(VERSION)} FROM dim", "dim", dates=VERSION_DATES)
)
def _(spark, sf):
    return fx.dim(spark, sf).select(*VERSION)


@register(
    "scd2_step",
    build(
        f"""SELECT {', '.join(VERSION)} FROM dim_before WHERE NOT is_current
        UNION ALL
        SELECT {', '.join('b.' + c for c in VERSION if c not in ('effective_to', 'is_current'))},
          CASE WHEN {s.CHANGED.format('b', 'a')} THEN a.effective_from END AS effective_to,
          NOT ({s.CHANGED.format('b', 'a')}) AS is_current
        FROM dim_before b JOIN newest a USING (id) WHERE b.is_current
        UNION ALL
        SELECT {', '.join('b.' + c for c in VERSION)} FROM dim_before b
        WHERE b.is_current AND b.id NOT IN (SELECT id FROM newest)
        UNION ALL
        SELECT a.id, b.scd_version + 1, {', '.join('a.' + c for c in s.TRACKED)}, a.effective_from,
          NULL, true
        FROM dim_before b JOIN newest a USING (id)
        WHERE b.is_current AND ({s.CHANGED.format('b', 'a')})
        UNION ALL
        SELECT a.id, 1, {', '.join('a.' + c for c in s.TRACKED)}, a.effective_from, NULL, true
        FROM newest a WHERE a.id NOT IN (SELECT id FROM dim_before)""".replace(
            ", effective_to, is_current FROM dim_before", ", effective_to, is_current FROM dim_before"
        ),
        "attrs",
        extra={
            "before": "SELECT * FROM attrs WHERE ingestion_date <= DATE '2024-01-20' "
            "AND id <> '19' AND NOT (id = '18' AND ingestion_date > DATE '2024-01-10')",
            "marks_b": "SELECT *, "
            + " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER h" for c in s.TRACKED)
            + " OR row_number() OVER h = 1 AS is_new FROM before "
            "WINDOW h AS (PARTITION BY id ORDER BY effective_from)",
            "dim_before": "SELECT *, row_number() OVER h AS scd_version, "
            "lead(effective_from) OVER h AS effective_to, "
            "lead(effective_from) OVER h IS NULL AS is_current FROM marks_b WHERE is_new "
            "WINDOW h AS (PARTITION BY id ORDER BY effective_from)",
            "newest": "SELECT * FROM attrs WHERE id <> '18' QUALIFY row_number() "
            "OVER (PARTITION BY id ORDER BY ingestion_date DESC) = 1",
        },
        dates=VERSION_DATES,
    ),
)
def _(spark, sf):
    """The stored versions up to the 20th and one more batch: the latest row of each entity.
    Entity 18 vanishes, 19 is new."""
    rows, day = fx.attributes(spark, sf), F.col("ingestion_date")
    cut, gone = F.lit(date(2024, 1, 20)), F.lit(date(2024, 1, 10))
    before = rows.where(
        (day <= cut) & (F.col("id") != "19") & ~((F.col("id") == "18") & (day > gone))
    )
    newest = dims.dim_source(fx.market_days(spark, sf).where("id <> '18'"))
    return dims.scd2_step(dims.scd2_history(before), newest).select(*VERSION)


@register(
    "dim_current",
    build(
        f"SELECT {', '.join(VERSION)} FROM dim WHERE is_current", "dim", dates=VERSION_DATES
    ),
)
def _(spark, sf):
    return dims.current_versions(fx.dim(spark, sf)).select(*VERSION)


ASOF_SQL = """SELECT f.{key}, f.{stamp}, d.market_segment, d.supply_utilisation_pct,
  d.ath_distance_bucket, d.is_scarce
  FROM {facts} f LEFT JOIN dim d ON f.{key} = d.id AND f.{day} >= d.effective_from
    AND (d.effective_to IS NULL OR f.{day} < d.effective_to)"""
ASOF_OUT = ("market_segment", "supply_utilisation_pct", "ath_distance_bucket", "is_scarce")


@register(
    "asof_market",
    build(
        ASOF_SQL.format(
            key="id", stamp="ingestion_date", day="ingestion_date", facts="mdays"
        ),
        "mdays",
        "dim",
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    out = asof.asof_join(fx.market_days(spark, sf), fx.dim(spark, sf), "id", "ingestion_date")
    return out.select("id", "ingestion_date", *ASOF_OUT)


@register(
    "asof_candle",
    build(
        ASOF_SQL.format(
            key="coin_id", stamp="candle_datetime", day="candle_date", facts="gcandles"
        ),
        "gcandles",
        "dim",
        stamps=("candle_datetime",),
    ),
)
def _(spark, sf):
    out = asof.asof_join(fx.group_candles(spark, sf), fx.dim(spark, sf), "coin_id", "candle_date")
    return out.select("coin_id", "candle_datetime", *ASOF_OUT)


SESSIONS = """SELECT c.*, d.date_id, d.year_month, d.year_quarter, d.year_week, d.day_name,
  d.is_weekend, h.trading_session, h.candle_block, h.is_candle_open
  FROM {0} c LEFT JOIN ddate d ON strftime(c.candle_date, '%Y-%m-%d') = d.date_actual
  LEFT JOIN dhour h ON d.date_id = h.date_id AND hour(c.candle_datetime) = h.hour"""


def _sessions(spark, sf, rows):
    days = fx.days(spark, sf)
    dated = asof.with_dates(rows, dims.dim_date(days, CFG), "candle_date")
    return asof.with_hours(dated, dims.dim_date_hour(days, CFG), "candle_datetime")


@register(
    "date_hour_lookup",
    build(
        "SELECT * EXCLUDE (open, high, low, close) FROM sessions",
        "gcandles",
        "ddate",
        "dhour",
        extra={"sessions": SESSIONS.format("gcandles")},
        dates=("candle_date",),
        stamps=("candle_datetime",),
    ),
)
def _(spark, sf):
    rows = _sessions(spark, sf, fx.group_candles(spark, sf))
    return rows.drop("open", "high", "low", "close")


@register("universe_day", build("SELECT * FROM universe", "universe", dates=("universe_date",)))
def _(spark, sf):
    return fx.universe(spark, sf)


@register(
    "universe_summary",
    build("SELECT is_active, entry_reason, count(*) AS row_count FROM universe GROUP BY 1, 2", "universe"),
)
def _(spark, sf):
    return dims.universe_summary(fx.universe(spark, sf))


@register(
    "tenure_maturity",
    build(
        """SELECT m.id, m.ingestion_date, days_in_universe,
             coalesce(days_in_universe >= 30, false) AS signals_reliable,
             CASE WHEN days_in_universe >= 30 THEN 'full' WHEN days_in_universe >= 14 THEN 'partial'
                  WHEN days_in_universe >= 7 THEN 'early' ELSE 'new_entry' END AS data_maturity
           FROM members m LEFT JOIN (SELECT coin_id AS id, count(*) AS days_in_universe
             FROM universe WHERE is_active GROUP BY 1) u USING (id)""",
        "members",
        "universe",
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    facts = fx.members(spark, sf).select("id", "ingestion_date")
    return market.with_maturity(facts, fx.universe(spark, sf))


# --- features --------------------------------------------------------------------------------

MARKET_FEATURES = (
    "id", "ingestion_date", "price_lag_2", "prev_rank", "ma_3", "daily_return_pct",
    "price_3d_change_pct", "price_movement_metric", "trend_strength_ratio",
    "short_term_trend_signal", "price_range_volatility", "liquidity_strength",
    "liquidity_strength_pct", "rank_movement", "data_freshness_hours",
    "market_cap_rank_computed",
)


@register(
    "market_features",
    build(
        f"SELECT {', '.join(MARKET_FEATURES)} FROM msilver", "msilver", dates=("ingestion_date",)
    ),
)
def _(spark, sf):
    return fx.market_silver(spark, sf).select(*MARKET_FEATURES)


AVERAGE_NAMES = ("ma_7d", "ma_14d", "ma_30d")
VOLATILITY_NAMES = ("volatility_7d", "volatility_14d", "volatility_30d", "volatility_cluster")
MOMENTUM_NAMES = ("momentum_1d", "momentum_7d", "momentum_14d")
BAND_NAMES = ("support_14d", "resistance_14d", "support_30d", "resistance_30d",
              "price_level_signal")


def _indicator(name: str, columns: tuple[str, ...], run, block: str = "featured") -> None:
    text = build(
        f"SELECT {KEYED}, {', '.join(columns)} FROM {block}", block, stamps=("candle_datetime",)
    )
    register(name, text)(lambda spark, sf: run(spark, sf).select(*CANDLE, *columns))


_indicator(
    "moving_avgs", AVERAGE_NAMES, lambda sp, sf: indicators.moving_averages(fx.candles(sp, sf), CFG)
)
_indicator(
    "moving_avgs_long_series",
    AVERAGE_NAMES,
    # the same windows with every history cut into overlapping chunks
    lambda sp, sf: indicators.moving_averages(
        fx.candles(sp, sf),
        replace(CFG, series_chunk_rows=400),
    ),
)
_indicator(
    "volatility", VOLATILITY_NAMES, lambda sp, sf: indicators.volatility(fx.shaped(sp, sf), CFG)
)
_indicator("momentum", MOMENTUM_NAMES, lambda sp, sf: indicators.momentum(fx.candles(sp, sf), CFG))
_indicator(
    "support_resistance",
    BAND_NAMES,
    lambda sp, sf: indicators.support_resistance(fx.candles(sp, sf), CFG),
)
_indicator(
    "trend_class",
    ("candle_direction", "ma_30d", "trend_strength"),
    lambda sp, sf: indicators.candle_features(fx.group_candles(sp, sf), CFG),
    "gfeatured",
)
_indicator(
    "recommendation_score",
    ("momentum_7d", "trend_strength", "price_level_signal", "recommendation_score"),
    lambda sp, sf: indicators.candle_features(fx.candles(sp, sf), CFG),
)

BB_MID, BB_DEV = mean("close", s.frame(41)), "(" + s.stddev("close", s.frame(41)) + ")"


@register(
    "bollinger",
    build(
        f"""SELECT {KEYED}, {rnd(BB_MID, 4)} AS bb_middle,
          {rnd(f'{BB_MID} + {BB_DEV} * 2', 4)} AS bb_upper,
          {rnd(f'{BB_MID} - {BB_DEV} * 2', 4)} AS bb_lower FROM candles""",
        "candles",
        stamps=("candle_datetime",),
    ),
)
def _(spark, sf):
    out = indicators.bollinger(fx.candles(spark, sf), CFG)
    return out.select(*CANDLE, "bb_middle", "bb_upper", "bb_lower")


PRIOR = s.lagged(1)


@register(
    "atr",
    build(
        f"""SELECT {KEYED}, true_range, {rnd(mean('true_range', s.frame(13)), 4)} AS atr
        FROM ranged""",
        "candles",
        extra={
            "ranged": f"""SELECT *, {rnd(
                f'greatest(high - low, abs(high - {PRIOR}), abs(low - {PRIOR}))', 4)}
                AS true_range FROM candles"""
        },
        stamps=("candle_datetime",),
    ),
)
def _(spark, sf):
    return indicators.average_true_range(fx.candles(spark, sf), CFG).select(
        *CANDLE, "true_range", "atr"
    )


GAIN = mean("greatest(move, 0e0)", s.frame(13)).replace("count(greatest(move, 0e0))", "count(move)")
LOSS = mean("greatest(-move, 0e0)", s.frame(13)).replace(
    "count(greatest(-move, 0e0))", "count(move)"
)


@register(
    "rsi",
    build(
        f"""SELECT {KEYED}, {rnd('CASE WHEN g + l > 0 THEN g * 100 / (g + l) END', 3)} AS rsi
        FROM means""",
        "candles",
        extra={
            "moves": f"SELECT *, {rnd(f'close - {PRIOR}', 8)} AS move FROM candles",
            "means": f"""SELECT *, {mean('CASE WHEN move > 0 THEN move ELSE 0e0 END', s.frame(13))} AS g,
              {mean('CASE WHEN move < 0 THEN -move ELSE 0e0 END', s.frame(13))} AS l FROM moves""",
        },
        stamps=("candle_datetime",),
    ),
)
def _(spark, sf):
    return indicators.relative_strength(fx.candles(spark, sf), CFG).select(*CANDLE, "rsi")


# --- fact tables end to end ------------------------------------------------------------------

CANDLE_FACTS = (
    "coin_id", "candle_datetime", "load_status", "data_quality_flag", "market_segment",
    "supply_utilisation_pct", "is_scarce", "date_id", "year_week", "trading_session",
    "candle_block", "candle_direction", "daily_range_pct", *AVERAGE_NAMES, *VOLATILITY_NAMES,
    *MOMENTUM_NAMES, *BAND_NAMES, "trend_strength", "recommendation_score", "anomaly_flag",
    "data_latency_hours",
)


@register(
    "silver_candles",
    build(
        f"SELECT {', '.join(CANDLE_FACTS)} FROM facts",
        "sfeatured",
        extra={
            "facts": f"""SELECT * REPLACE (CASE WHEN candle_body_pct >
                (SELECT quantile_disc({s.BODY}, 0.99) FROM gfresh) THEN 'HIGH_BODY_PCT' END
                AS anomaly_flag),
              {rnd("(epoch(TIMESTAMP '2024-01-31') - epoch(candle_datetime)) / 3600", 2)}
                AS data_latency_hours FROM sfeatured"""
        },
        stamps=("candle_datetime",),
    ),
)
def _(spark, sf):
    days = fx.days(spark, sf)
    facts = silver.candle_metrics(
        fx.bronze_candles(spark, sf),
        fx.dim(spark, sf),
        dims.dim_date(days, CFG),
        dims.dim_date_hour(days, CFG),
        CFG,
    )
    return facts.clean.select(*CANDLE_FACTS)


MARKET_FACTS = (
    "id", "ingestion_date", "current_price", "market_segment", "supply_utilisation_pct",
    "is_scarce", "ath_distance_bucket", "date_id", "year_month", "days_in_universe",
    "price_change_pct_24h_capped", "anomaly_flag", "anomaly_reason", "daily_return_pct",
    "price_3d_change_pct", "price_movement_metric", "ma_3", "short_term_trend_signal",
    "price_range_volatility", "liquidity_strength", "rank_movement", "data_freshness_hours",
    "market_cap_rank_computed", "is_changed",
)


@register(
    "silver_market",
    build(f"SELECT {', '.join(MARKET_FACTS)} FROM fsilver", "fsilver", dates=("ingestion_date",)),
)
def _(spark, sf):
    return _market_facts(spark, sf).clean.select(*MARKET_FACTS)


def _market_facts(spark, sf) -> silver.Facts:
    universe = fx.partial_batches(spark, sf).select(
        F.col("id").alias("coin_id"), F.lit(True).alias("is_active"), F.col("ingestion_date").alias("universe_date")
    )
    dates = dims.dim_date(fx.days(spark, sf), CFG)
    return silver.market_metrics(
        fx.bronze_market(spark, sf), fx.dim(spark, sf), dates, universe, CFG
    )


# --- published tables ------------------------------------------------------------------------

STREAKS = {
    "gains": "SELECT *, coalesce(daily_return_pct > 0, false) AS gaining FROM msilver",
    "turns": """SELECT *, sum(CASE WHEN gaining <> prev THEN 1 ELSE 0 END)
        OVER (PARTITION BY id ORDER BY ingestion_date) AS island
        FROM (SELECT *, lag(gaining) OVER (PARTITION BY id ORDER BY ingestion_date) AS prev
              FROM gains)""",
    "runs": """SELECT *, row_number() OVER (PARTITION BY id, island ORDER BY ingestion_date)
        AS streak_days, CASE WHEN gaining THEN 'GAINING' ELSE 'LOSING' END AS streak_direction
        FROM turns""",
}


@register(
    "streaks",
    build(
        "SELECT id, ingestion_date, streak_days, streak_direction FROM runs",
        "msilver",
        extra=STREAKS,
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    return _streaks(spark, sf)


@register(
    "streaks_long_series",
    # the same runs, every month of an entity on its own
    build(
        "SELECT id, ingestion_date, streak_days, streak_direction FROM runs",
        "msilver",
        extra=STREAKS,
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    return _streaks(spark, sf, "month")


def _streaks(spark, sf, period=None):
    rows = fx.market_silver(spark, sf).withColumn(
        "gaining", F.coalesce(F.col("daily_return_pct") > 0, F.lit(False))
    )
    direction = F.when(F.col("gaining"), "GAINING").otherwise("LOSING")
    return series.streaks(rows, "id", "ingestion_date", "gaining", period=period).select(
        "id", "ingestion_date", "streak_days", direction.alias("streak_direction")
    )


PERFORMANCE = {
    **STREAKS,
    "day_scores": f"""SELECT coin_id AS id, ingestion_date,
        {rnd(mean('recommendation_score'), 4)} AS avg_recommendation_score
        FROM gfeatured GROUP BY 1, 2""",
    "perf": f"""SELECT id, symbol, name, ingestion_date, market_cap_rank, market_segment,
        {rnd('current_price', 4)} AS current_price, {rnd('market_cap', 3)} AS market_cap,
        {rnd('total_volume', 3)} AS total_volume, {rnd('price_change_24h', 4)} AS price_change_24h,
        {rnd('price_change_percentage_24h', 3)} AS price_change_percentage_24h,
        {rnd('price_change_pct_24h_capped', 3)} AS price_change_pct_24h_capped,
        {rnd('price_movement_metric', 3)} AS price_movement_metric,
        {rnd('daily_return_pct', 3)} AS daily_return_pct,
        {rnd('price_3d_change_pct', 3)} AS price_3d_change_pct, short_term_trend_signal,
        {rnd('price_range_volatility', 3)} AS price_range_volatility, liquidity_strength,
        rank_movement,
        rank() OVER (d ORDER BY r.price_change_percentage_24h DESC) AS gainer_rank,
        rank() OVER (d ORDER BY r.price_change_percentage_24h) AS loser_rank,
        rank() OVER (d ORDER BY r.total_volume DESC) AS volume_rank,
        {rnd('percent_rank() OVER (d ORDER BY r.price_change_percentage_24h) * 100', 1)}
          AS performance_percentile, {s.LABEL.replace('price_change', 'r.price_change')}
          AS performance_label, streak_days, streak_direction,
        {rnd('avg_recommendation_score', 3)} AS avg_recommendation_score, anomaly_flag,
        '2024-01-31 00:00:00' AS gold_updated_at
      FROM runs r LEFT JOIN day_scores USING (id, ingestion_date)
      WINDOW d AS (PARTITION BY ingestion_date)""",
}
LEADERBOARD = build(
    "SELECT * FROM perf", "msilver", "gfeatured", extra=PERFORMANCE, dates=("ingestion_date",)
)


def _performance(spark, sf):
    return gold.performance_metrics(
        fx.market_silver(spark, sf), fx.featured(spark, sf, fx.group()), CFG, hot=False
    )


@register("leaderboard", LEADERBOARD)
def _(spark, sf):
    # twenty entities a day: no group is large
    return _performance(spark, sf)


@register("leaderboard_hot_day", LEADERBOARD)
def _(spark, sf):
    # ranks by value buckets, as for days of any size
    made_here = ("gainer_rank", "loser_rank", "volume_rank", "performance_percentile",
                 "performance_label", "streak_days", "streak_direction",
                 "avg_recommendation_score", "gold_updated_at")
    used = [c for c in gold.PERFORMANCE_COLUMNS if c not in made_here]
    market_rows = fx.market_table(spark, sf, *used)
    return gold.performance_metrics(
        market_rows, fx.featured(spark, sf, fx.group()), CFG, hot=True
    )


SNAPSHOT = {
    "mlast": "SELECT * FROM msilver QUALIFY row_number() OVER "
    "(PARTITION BY id ORDER BY ingestion_date DESC) = 1",
    "clast": "SELECT * FROM gfeatured QUALIFY row_number() OVER "
    "(PARTITION BY coin_id ORDER BY candle_datetime DESC) = 1",
    "scored": f"""SELECT m.*, c.open AS ohlc_open, c.close AS ohlc_close, c.candle_direction,
        strftime(c.candle_date, '%Y-%m-%d') AS latest_candle_date, c.ma_7d, c.ma_14d, c.ma_30d,
        c.volatility_7d, c.volatility_14d, c.volatility_30d, c.volatility_cluster, c.momentum_7d,
        c.support_14d, c.resistance_14d, c.trend_strength, c.price_level_signal,
        c.recommendation_score AS candle_score,
        CASE short_term_trend_signal WHEN 'BULLISH' THEN 0.7e0 WHEN 'BEARISH' THEN 0.3e0
          ELSE 0.5e0 END AS trend_value
      FROM mlast m LEFT JOIN clast c ON m.id = c.coin_id""",
    "snap": "SELECT "
    + ", ".join(
        ["id", "symbol", "name", "market_cap_rank", "market_segment"]
        + [f"{rnd(c, 4)} AS {c}" for c in (
            "current_price", "high_24h", "low_24h", "price_change_24h", "ma_3", "ath", "atl",
            "ohlc_open", "ohlc_close", "ma_7d", "ma_14d", "ma_30d", "support_14d",
            "resistance_14d")]
        + [f"{rnd(c, 3)} AS {c}" for c in (
            "price_change_percentage_24h", "price_change_pct_24h_capped", "market_cap",
            "fully_diluted_valuation", "total_volume", "circulating_supply", "total_supply",
            "max_supply", "price_movement_metric", "daily_return_pct", "price_3d_change_pct",
            "price_range_volatility", "ath_change_percentage", "atl_change_percentage",
            "momentum_7d", "data_freshness_hours")]
        + [f"{rnd(c, 6)} AS {c}" for c in (
            "liquidity_strength", "volatility_7d", "volatility_14d", "volatility_30d")]
        + [
            "short_term_trend_signal", "rank_movement", "candle_direction", "latest_candle_date",
            "volatility_cluster", "trend_strength", "price_level_signal", "anomaly_flag",
            "anomaly_reason", "ingestion_date",
            f"{rnd('(current_price - ath) / ath * 100', 3)} AS ath_drawdown_pct",
            f"{rnd('CASE WHEN ma_30d > 0 THEN (current_price - ma_30d) / ma_30d * 100 END', 3)} "
            "AS price_vs_ma30_pct",
            f"{rnd('candle_score', 3)} AS recommendation_score",
            rnd(rnd("coalesce(candle_score * 0.6e0 + trend_value * 0.4e0, trend_value)", 4), 3)
            + " AS gold_recommendation_score",
            f"{s.LABEL} AS performance_label",
            "'2024-01-31' AS snapshot_date", "'2024-01-31 00:00:00' AS gold_updated_at",
        ]
    )
    + " FROM scored",
}


def _snapshot(spark, sf):
    return gold.market_snapshot(
        fx.market_silver(spark, sf), fx.featured(spark, sf, fx.group()), CFG
    )


@register(
    "market_snapshot",
    build("SELECT * FROM snap", "msilver", "gfeatured", extra=SNAPSHOT, dates=("ingestion_date",)),
)
def _(spark, sf):
    return _snapshot(spark, sf)


TOP = ", ".join(
    f"arg_min({v}, struct_pack(k := {k}, i := id)) AS {name}"
    for k, v, name in (
        ("-price_change_percentage_24h", "id", "top_gainer_coin"),
        ("-price_change_percentage_24h", "name", "top_gainer_name"),
        ("-price_change_percentage_24h", "price_change_percentage_24h", "g"),
        ("price_change_percentage_24h", "id", "top_loser_coin"),
        ("price_change_percentage_24h", "name", "top_loser_name"),
        ("price_change_percentage_24h", "price_change_percentage_24h", "l"),
        ("-total_volume", "id", "highest_volume_coin"),
        ("-total_volume", "total_volume", "v"),
        ("-liquidity_strength", "id", "most_liquid_coin"),
        ("-liquidity_strength", "liquidity_strength", "q"),
    )
)
TOP_OUT = f"""top_gainer_coin, top_gainer_name, {rnd('g', 3)} AS top_gainer_pct, top_loser_coin,
  top_loser_name, {rnd('l', 3)} AS top_loser_pct, highest_volume_coin,
  {rnd('v', 0)} AS highest_volume_usd, most_liquid_coin, {rnd('q', 6)} AS top_liquidity_ratio"""


@register(
    "market_leaders",
    build(
        f"SELECT ingestion_date, {TOP_OUT} FROM tops",
        "msilver",
        extra={"tops": f"SELECT ingestion_date, {TOP} FROM msilver GROUP BY 1"},
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    return gold.market_leaders(fx.market_silver(spark, sf), CFG)


LEVELS = {
    "day_p75": f"""SELECT ingestion_date,
        {rnd(mean('recommendation_score'), 4)} AS avg_recommendation_score,
        {rnd('quantile_disc(recommendation_score, 0.75)', 4)} AS p75_score
        FROM gfeatured GROUP BY 1""",
    "coin_avg": f"""SELECT ingestion_date, coin_id, {mean('recommendation_score')} AS own
        FROM gfeatured GROUP BY 1, 2""",
    "levels": f"""SELECT ingestion_date, avg_recommendation_score, p75_score, {rnd(
        "CAST(count(*) FILTER (WHERE own > p75_score) AS DOUBLE) / count(*) * 100", 3)}
        AS pct_high_signal
        FROM coin_avg JOIN day_p75 USING (ingestion_date) GROUP BY 1, 2, 3""",
}


@register(
    "pct_high_signal",
    build("SELECT * FROM levels", "gfeatured", extra=LEVELS, dates=("ingestion_date",)),
)
def _(spark, sf):
    return gold.score_levels(fx.candle_table(spark, sf, *fx.SCORE_COLUMNS), CFG)


CHANGE = "price_change_percentage_24h"


def total(column: str) -> str:
    return f"CAST(sum({s.dec(column)}) AS DOUBLE)"


SUMMARY = {
    **LEVELS,
    "tops": f"""SELECT ingestion_date, {TOP},
        {rnd(total('market_cap'), 0)} AS total_market_cap,
        max(CASE WHEN id = '7' THEN market_cap END) AS own_cap,
        {rnd(total('total_volume'), 0)} AS total_volume, count(id) AS total_coins,
        count(*) FILTER (WHERE {CHANGE} > 0) AS gainers_count,
        count(*) FILTER (WHERE {CHANGE} < 0) AS losers_count,
        count(*) FILTER (WHERE {CHANGE} = 0) AS stable_count,
        {rnd(mean(CHANGE), 3)} AS avg_price_change_pct,
        {rnd(f'quantile_disc({CHANGE}, 0.5)', 3)} AS median_price_change_pct,
        {rnd(f'max({CHANGE})', 3)} AS max_gain_pct, {rnd(f'min({CHANGE})', 3)} AS max_loss_pct,
        {rnd(mean('liquidity_strength'), 6)} AS avg_liquidity_strength,
        {rnd(mean('volatility_in'), 3)} AS avg_price_range_volatility,
        count(*) FILTER (WHERE anomaly_flag) AS anomaly_coins_count
      FROM (SELECT *, price_range_volatility AS volatility_in FROM msilver) GROUP BY 1""",
    "summary": f"""SELECT ingestion_date, total_market_cap, total_volume, total_coins,
        gainers_count, losers_count, stable_count, avg_price_change_pct, median_price_change_pct,
        max_gain_pct, max_loss_pct, avg_liquidity_strength, avg_price_range_volatility,
        anomaly_coins_count,
        {rnd('own_cap / total_market_cap * 100', 3)} AS btc_dominance_pct,
        CASE WHEN gainers_count > losers_count * 2 THEN 'VERY_BULLISH'
             WHEN gainers_count > losers_count THEN 'BULLISH'
             WHEN losers_count > gainers_count * 2 THEN 'VERY_BEARISH'
             WHEN losers_count > gainers_count THEN 'BEARISH' ELSE 'NEUTRAL' END
          AS market_sentiment, avg_recommendation_score, pct_high_signal, {TOP_OUT},
        '2024-01-31 00:00:00' AS gold_updated_at
      FROM tops LEFT JOIN levels USING (ingestion_date)""",
}


def _summary(spark, sf):
    return gold.market_summary(
        fx.market_silver(spark, sf), fx.candle_table(spark, sf, *fx.SCORE_COLUMNS), CFG
    )


@register(
    "market_summary",
    build(
        "SELECT * FROM summary", "msilver", "gfeatured", extra=SUMMARY, dates=("ingestion_date",)
    ),
)
def _(spark, sf):
    return _summary(spark, sf)


# --- stored tables, read back after two runs ---------------------------------------------------


def _read_back(spark, name: str, store) -> DataFrame:
    """Run a storing step twice on fresh tables, keep a copy of the result, drop the tables."""
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    for _ in range(2):
        store(table)
    return _copy_and_drop(spark, table)


def _copy_and_drop(spark, table: str) -> DataFrame:
    out = stage(spark.table(table), table)
    for suffix in ("", "_log", "_quarantine", "_stale", "_unreadable"):
        tables.drop_table(spark, f"{table}{suffix}")
    return out


def _read_back_runs(spark, name: str, *steps) -> DataFrame:
    """Run several storing steps, each a run of its own, on one fresh table."""
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    for step in steps:
        step(table)
    return _copy_and_drop(spark, table)


def _published(name: str, kind: str, source: str):
    run, sql = REGISTRY[source]

    def query(spark, sf):
        # the published rows with their own types, not the contract's
        df = stage(MADE[source](spark, sf), kind)
        found = _read_back(spark, kind, lambda t: publish.store_gold(df, kind, t, f"{t}_log", CFG))
        return found.select(*df.columns)

    register(name, sql)(query)


for _kind, _source in (
    ("snapshot", "market_snapshot"),
    ("history", "ohlc_history"),
    ("performance", "leaderboard"),
    ("summary", "market_summary"),
    ("trending", "trending"),
):
    _published(f"published_{_kind}", _kind, _source)


@register("published_silver_market", REGISTRY["silver_market"][1])
def _(spark, sf):
    facts = _market_facts(spark, sf)
    held = silver.Facts(*(stage(x, "facts") for x in (facts.clean, facts.quarantine, facts.stale)))
    store = lambda t: publish.store_facts(held, t, publish.MARKET_KEYS, f"{t}_log", CFG)
    return _read_back(spark, "silver_market", store).select(*MARKET_FACTS)


@register(
    "published_merge",
    """WITH one AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 <> 0 THEN date_trunc('month', o_orderdate) END AS m,
             o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderkey % 3 <> 0),
      two AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 <> 0 THEN date_trunc('month', o_orderdate) END AS m,
             o_orderstatus AS status, o_totalprice AS price, o_orderpriority AS priority
             FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 10 <> 0)
    SELECT k, strftime(m, '%Y-%m-%d') AS month, status, price, priority FROM two
    UNION ALL SELECT k, strftime(m, '%Y-%m-%d'), status, price, NULL FROM one WHERE k NOT IN (SELECT k FROM two)""",
)
def _(spark, sf):
    """A first batch with rows without partition; a second one with a changed type, values that
    cannot be read and a new column."""
    orders = table(spark, sf, "orders")
    month = F.when(F.col("o_orderkey") % 11 != 0, F.trunc("o_orderdate", "month"))
    rows = orders.select(
        F.col("o_orderkey").alias("k"), month.alias("month"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"),
    )
    first = rows.where("k % 3 <> 0").drop("priority")
    text = F.when(F.col("k") % 10 == 0, "n/a").otherwise(F.col("price").cast("string"))
    second = rows.where("k % 2 = 0").withColumn("price", text)

    def store(name):
        for batch in (first, second):
            tables.publish_merge(batch, name, ["k"], CFG, "month")

    return _read_back(spark, "merged", store).select("k", "month", "status", "price", "priority")


@register(
    "published_archive",
    """SELECT o_orderkey AS k, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, o_orderstatus AS status,
        CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS price, o_orderstatus AS archive_run_id
      FROM orders WHERE o_orderstatus <> 'O' OR o_orderdate < DATE '1997-01-01'""",
)
def _(spark, sf):
    """One run for each status; that of the open orders again, with other prices and fewer months."""
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.trunc("o_orderdate", "month").alias("month"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), "o_orderdate",
    )

    def run(status, batch):
        cfg = replace(CFG, run_id=status)
        return lambda name: tables.append_run(batch.where(F.col("status") == status).drop("o_orderdate"), name, cfg, day="month")

    again = rows.where("o_orderdate < DATE '1997-01-01'").withColumn("price", F.col("price") * 2)
    found = _read_back_runs(spark, "archive", run("F", rows), run("O", rows), run("P", rows), run("O", again))
    return found.select("k", F.date_format("month", "yyyy-MM-dd").alias("month"), "status", "price", "archive_run_id")


@register("published_dimension", REGISTRY["scd2_history"][1])
def _(spark, sf):
    """A dimension of first versions, replaced by one of all versions that was read beside it."""
    dim = stage(MADE["scd2_history"](spark, sf), "dim")
    first = dim.where("scd_version = 1")
    store = lambda rows: lambda t: publish.store_dimension(rows, t, f"{t}_log", CFG)
    rest = lambda t: publish.store_dimension(spark.table(t).union(dim.where("scd_version > 1")), t, f"{t}_log", CFG)
    return _read_back_runs(spark, "dim", store(first), rest).select(*dim.columns)


@register("published_universe", REGISTRY["universe_day"][1])
def _(spark, sf):
    """Days one after the other: the first half, then all from its last day on."""
    members = stage(fx.universe(spark, sf), "universe")
    middle = members.agg(F.expr("date_add(min(universe_date), CAST(datediff(max(universe_date), min(universe_date)) / 2 AS INT))")).first()[0]
    store = lambda rows: lambda t: publish.store_universe(rows, t, f"{t}_log", CFG)
    parts = members.where(F.col("universe_date") <= middle), members.where(F.col("universe_date") >= middle)
    return _read_back_runs(spark, "universe", *map(store, parts)).select(*members.columns)


@register(
    "published_latest",
    """WITH marks AS (SELECT o_custkey, max((o_orderdate, o_orderkey)) AS last, min((o_orderdate, o_orderkey)) AS first FROM orders GROUP BY 1)
    SELECT o_custkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey AS k, o_totalprice AS price
    FROM marks JOIN orders USING (o_custkey)
    WHERE o_orderkey = CASE WHEN first[1] >= last[1] THEN first[2] ELSE last[2] END""",
)
def _(spark, sf):
    """Each customer's last order, then a late batch of their first orders, which only equals replace."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("day"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"))
    row, place = F.struct("day", "k", "price"), F.struct("day", "k")
    each = orders.groupBy("id").agg(F.max_by(row, place).alias("last"), F.min_by(row, place).alias("first"))
    merge = lambda rows: lambda t: tables.publish_merge(rows, t, ["id"], CFG, guard="day")
    found = _read_back_runs(spark, "latest", merge(each.select("id", "last.*")), merge(each.select("id", "first.*")))
    return found.select("id", F.date_format("day", "yyyy-MM-dd").alias("day"), "k", "price")


@register(
    "schema_diff",
    """WITH seen AS (SELECT count(*) FILTER (WHERE o_orderstatus = 'P') AS unpriced, count(*) AS n,
        count(*) FILTER (WHERE o_orderpriority LIKE '1%') AS rushed, count(*) FILTER (WHERE o_totalprice < 0) AS refunded FROM orders)
    SELECT 'TYPE_CHANGED' AS change_type, 'price' AS column_name, 'double' AS old_dtype, 'string' AS new_dtype FROM seen WHERE unpriced > 0
    UNION ALL SELECT 'COLUMN_ADDED', 'rush', '', 'boolean' FROM seen WHERE rushed > 0
    UNION ALL SELECT 'COLUMN_DROPPED', 'refund', 'double', '' FROM seen WHERE refunded = 0
    UNION ALL SELECT 'TYPE_CHANGED', 'day', 'date', 'string' FROM seen WHERE n > 0""",
)
def _(spark, sf):
    """The stored columns of orders against those that payloads of all orders turn out to have."""
    orders = table(spark, sf, "orders")
    price, partial = F.col("o_totalprice"), F.col("o_orderstatus") == "P"
    stored = orders.select(
        F.col("o_orderkey").cast("long").alias("k"), price.alias("price"), F.to_date("o_orderdate").alias("day"), price.alias("refund")
    )
    payload = F.struct(
        F.col("o_orderkey").alias("k"),
        F.when(~partial, price).alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.when(price < 0, -price).alias("refund"),
        F.when(F.col("o_orderpriority").startswith("1"), F.lit(True)).alias("rush"),
    )
    unpriced = F.regexp_replace(F.to_json(payload), "^\\{", '{"price":"open",')
    files = f"{shared_dir(spark)}/payloads-{uuid.uuid4().hex}"
    orders.select(F.when(partial, unpriced).otherwise(F.to_json(payload))).write.text(files)
    batch = spark.read.json(files)
    remove(spark, files)
    diff = schema_diff(spark, "orders", stored.schema, batch.schema, CFG)
    return diff.select("change_type", "column_name", "old_dtype", "new_dtype")


# --- ready-made queries ----------------------------------------------------------------------


def _daily(spark, sf):
    return ohlc_daily(spark, sf)


DAILY_BLOCKS = {"daily": DAILY.format("candles")}


@register(
    "chart_series",
    build(
        "SELECT candle_date, open, high, low, close FROM daily WHERE coin_id = 'click'",
        "candles",
        extra=DAILY_BLOCKS,
        dates=("candle_date",),
    ),
)
def _(spark, sf):
    return views.chart_series(_daily(spark, sf), "click")


@register(
    "entity_picker",
    build(
        """SELECT DISTINCT coin_id || '-' || hour(candle_datetime) AS coin_id,
             upper(coin_id[1]) || coin_id[2:] || ' ' || hour(candle_datetime) AS coin_label
           FROM candles""",
        "candles",
    ),
)
def _(spark, sf):
    hour = F.hour("candle_datetime").cast("string")
    return views.entity_picker(
        fx.candles(spark, sf).withColumn("coin_id", F.concat_ws("-", "coin_id", hour))
    )


@register(
    "session_stats",
    build(
        f"""SELECT trading_session, {rnd(mean('daily_range_pct'), 3)} AS avg_range_pct,
          count(*) AS candle_count FROM sessions GROUP BY 1""",
        "gshaped",
        "ddate",
        "dhour",
        extra={"sessions": SESSIONS.format("gshaped")},
    ),
)
def _(spark, sf):
    rows = indicators.candle_shape(fx.group_candles(spark, sf))
    return views.session_volatility(_sessions(spark, sf, rows), CFG)


@register(
    "session_counts",
    build(
        "SELECT trading_session, count(*) AS row_count FROM sessions GROUP BY 1",
        "gcandles",
        "ddate",
        "dhour",
        extra={"sessions": SESSIONS.format("gcandles")},
    ),
)
def _(spark, sf):
    return views.session_counts(_sessions(spark, sf, fx.group_candles(spark, sf)))


@register(
    "bucket_counts",
    build(
        """SELECT 'year_month' AS grouping, strftime(candle_date, '%Y-%m') AS bucket,
             count(*) AS row_count FROM gcandles GROUP BY 2
           UNION ALL SELECT 'market_segment', market_segment, count(*) FROM attrs GROUP BY 2""",
        "gcandles",
        "attrs",
    ),
)
def _(spark, sf):
    candles = fx.group_candles(spark, sf).withColumn(
        "year_month", F.date_format("candle_date", "yyyy-MM")
    )

    def counted(rows: DataFrame, column: str) -> DataFrame:
        return views.frequency(rows, column).select(
            F.lit(column).alias("grouping"), F.col(column).alias("bucket"), "row_count"
        )

    return counted(candles, "year_month").unionByName(
        counted(fx.attributes(spark, sf), "market_segment")
    )


@register(
    "score_by_trend",
    build(
        f"""SELECT trend_strength, {rnd(mean('recommendation_score'), 4)} AS avg_score,
          {rnd('min(recommendation_score)', 4)} AS min_score,
          {rnd('max(recommendation_score)', 4)} AS max_score, count(*) AS candle_count
        FROM gfeatured WHERE recommendation_score IS NOT NULL GROUP BY 1""",
        "gfeatured",
    ),
)
def _(spark, sf):
    return views.score_by_trend(fx.featured(spark, sf, fx.group()), CFG)


def checks_sql(rules: list[quality.Rule], relation: str) -> str:
    """Each rule's outcome from the relation's rows, or from its columns as the engine describes them."""

    def failing(rule: quality.Rule) -> str:
        if rule.failing:
            return f"(SELECT count(*) FILTER (WHERE {rule.failing}) FROM {relation})"
        if rule.unique:
            return f"(SELECT count(*) - count(DISTINCT ({', '.join(rule.unique)})) FROM {relation})"
        named = ", ".join(f"'{c}'" for c in rule.present or rule.absent)
        found = f"count(*) FILTER (WHERE column_name IN ({named}))"
        found = f"{len(set(rule.present))} - {found}" if rule.present else found
        return f"(SELECT {found} FROM (DESCRIBE SELECT * FROM {relation}))"

    outcomes = " UNION ALL ".join(f"SELECT '{r.name}' AS \"check\", {failing(r)} AS f" for r in rules)
    return f'SELECT "check", f = 0 AS passed, CAST(f AS BIGINT) AS failing_rows FROM ({outcomes})'


@register(
    "validate_silver",
    build(
        checks_sql(silver.silver_rules(), "marked"),
        "featured",
        extra={"marked": "SELECT *, CASE WHEN anomaly_flag IS NOT NULL THEN 'STALE' ELSE 'SUCCESS' END AS load_status FROM featured"},
    ),
)
def _(spark, sf):
    """Checks over the featured candles, which lack the dimension columns; flagged candles carry
    the STALE status here so that a failing row check shows."""
    status = F.when(F.col("anomaly_flag").isNotNull(), "STALE").otherwise("SUCCESS")
    return silver.validate_candles(fx.featured(spark, sf).withColumn("load_status", status))


GOLD_RELATIONS = {"snapshot": "snap", "history": "history_r", "performance": "perf", "summary": "summary"}


@register(
    "validate_gold",
    build(
        " UNION ALL ".join(checks_sql(rules, GOLD_RELATIONS[kind]) for kind, rules in gold.gold_rules().items()),
        "msilver",
        "gfeatured",
        extra={**SNAPSHOT, **history_sql("gfeatured"), **PERFORMANCE, **SUMMARY},
    ),
)
def _(spark, sf):
    market, candles = fx.market_table(spark, sf), fx.candle_table(spark, sf)
    return gold.validate_gold(
        gold.market_snapshot(market, candles, CFG),
        gold.ohlc_history(candles, CFG),
        gold.performance_metrics(market, candles, CFG, hot=False),
        gold.market_summary(market, candles, CFG),
    )


METRICS = ("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")


@register(
    "dq_metrics",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count,
        count(*) FILTER (WHERE {c} IS NULL) AS null_count,
        {f'count(*) FILTER (WHERE {c} < 0)' if c != 'c_mktsegment' else '0'} AS negative_count,
        count(DISTINCT {c}) AS distinct_count FROM customer"""
        for c in METRICS
    ),
)
def _(spark, sf):
    return quality.column_metrics(table(spark, sf, "customer"), list(METRICS))


TOP_SCORE = ("id", "name", "gold_recommendation_score", "recommendation_score", "trend_strength",
             "price_level_signal", "short_term_trend_signal")


@register(
    "top_by_score",
    build(
        f"""SELECT {', '.join(TOP_SCORE)} FROM snap WHERE gold_recommendation_score IS NOT NULL
        ORDER BY gold_recommendation_score DESC, id LIMIT 5""",
        "msilver",
        "gfeatured",
        extra=SNAPSHOT,
    ),
)
def _(spark, sf):
    return views.top_by_score(_snapshot(spark, sf)).select(*TOP_SCORE)


@register(
    "top_by_rank",
    build(
        """SELECT id, name, market_cap_rank, performance_label FROM snap
        ORDER BY market_cap_rank, id LIMIT 5""",
        "msilver",
        "gfeatured",
        extra=SNAPSHOT,
    ),
)
def _(spark, sf):
    return views.top_by_rank(_snapshot(spark, sf)).select(
        "id", "name", "market_cap_rank", "performance_label"
    )


MOVER = ("id", "name", "price_change_percentage_24h", "gainer_rank", "loser_rank",
         "performance_percentile", "performance_label", "streak_days",
         "streak_direction")


@register(
    "top_movers",
    build(
        " UNION ALL ".join(
            f"""SELECT * FROM (SELECT '{rank}' AS board, {', '.join(MOVER)} FROM perf
            WHERE ingestion_date = DATE '2024-01-30' ORDER BY {rank}, id LIMIT 5)"""
            for rank in ("gainer_rank", "loser_rank")
        ),
        "msilver",
        "gfeatured",
        extra=PERFORMANCE,
    ),
)
def _(spark, sf):
    board = _performance(spark, sf)

    def top(rank: str) -> DataFrame:
        rows = views.top_movers(board, date(2024, 1, 30), rank)
        return rows.select(F.lit(rank).alias("board"), *MOVER)

    return top("gainer_rank").unionByName(top("loser_rank"))


@register(
    "latest_k",
    build(
        """SELECT coin_id, candle_date, open, high, low, close FROM daily WHERE coin_id = 'view'
        ORDER BY candle_date DESC LIMIT 5""",
        "candles",
        extra=DAILY_BLOCKS,
        dates=("candle_date",),
    ),
)
def _(spark, sf):
    out = views.latest_of_entity(_daily(spark, sf), "coin_id", "view", "candle_date", 5)
    return out.select("coin_id", "candle_date", "open", "high", "low", "close")


@register(
    "latest_summary_days",
    build(
        """SELECT ingestion_date, total_market_cap, market_sentiment, top_gainer_coin, top_loser_coin
        FROM summary ORDER BY ingestion_date DESC LIMIT 3""",
        "msilver",
        "gfeatured",
        extra=SUMMARY,
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    return views.latest_rows(_summary(spark, sf), "ingestion_date").select(
        "ingestion_date", "total_market_cap", "market_sentiment", "top_gainer_coin",
        "top_loser_coin",
    )


@register(
    "latest_partition",
    build(
        """SELECT id, ingestion_date, current_price FROM mdays
        WHERE ingestion_date = (SELECT max(ingestion_date) FROM mdays)""",
        "mdays",
        dates=("ingestion_date",),
    ),
)
def _(spark, sf):
    return load.last_snapshot(fx.market_days(spark, sf)).select(
        "id", "ingestion_date", "current_price"
    )


# --- more queries on stored tables, in a module of their own ------------------------------------

from contract import stored  # noqa: E402, F401
