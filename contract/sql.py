"""Building blocks of the oracle SQL: twins of ``fixtures.py`` and of the shared derivations."""

from __future__ import annotations


def rnd(x: str, k: int) -> str:
    """Half-up rounding of the shortest decimal form of a double."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {k}) AS DOUBLE)"


def dec(x: str) -> str:
    """Four exact decimals of a double."""
    return (
        f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), 4) AS DECIMAL(18,4))"
    )


def mean(x: str, over: str = "") -> str:
    return f"(CAST(sum({dec(x)}){over} AS DOUBLE) / nullif(count({x}){over}, 0))"


def stddev(x: str, over: str) -> str:
    n, s = f"count({x}){over}", f"CAST(sum({dec(x)}){over} AS DOUBLE)"
    q = f"CAST(sum({dec(x)} * {dec(x)}){over} AS DOUBLE)"
    return f"CASE WHEN {n} > 1 THEN sqrt(greatest(({q} - {s} * {s} / {n}) / ({n} - 1), 0e0)) END"


def quantile(p: float, x: str) -> str:
    return f"quantile_disc({x}, {p})"


def grade(received: str, expected: str) -> str:
    r = f"(CAST({received} AS DOUBLE) / {expected})"
    return (
        f"CASE WHEN {r} >= 1 THEN 'SUCCESS' WHEN {r} >= 0.8e0 THEN 'PARTIAL_LOAD' "
        f"WHEN {r} >= 0.5e0 THEN 'PARTIAL_LOAD_CRITICAL' "
        f"WHEN {r} >= 0.1e0 THEN 'PARTIAL_LOAD_SEVERE' ELSE 'FAILURE' END"
    )


SEGMENT = (
    "CASE WHEN market_cap_rank <= 10 THEN 'Top_10' WHEN market_cap_rank <= 50 THEN 'Top_50' "
    "WHEN market_cap_rank <= 200 THEN 'Top_200' ELSE 'Long_Tail' END"
)
LABEL = (
    "CASE WHEN {c} >= 5 THEN 'TOP_GAINER' WHEN {c} <= -5 THEN 'TOP_LOSER' "
    "WHEN {c} BETWEEN -1 AND 1 THEN 'STABLE' ELSE 'MOVER' END"
).format(c="price_change_percentage_24h")
DIRECTION = "CASE WHEN close > open THEN 'BULL' WHEN close < open THEN 'BEAR' ELSE 'DOJI' END"
BODY = "CASE WHEN open > 0 THEN abs(close - open) / open * 100 END"
EXTREME = "greatest(quantile_disc(CASE WHEN open > 0 THEN close / open END, 0.9999) * 3, 10e0)"
SLOT = "time_bucket(INTERVAL '4 hours', ts)"
W = "PARTITION BY coin_id ORDER BY candle_datetime"


def frame(rows: int) -> str:
    return f" OVER ({W} ROWS BETWEEN {rows} PRECEDING AND CURRENT ROW)"


def lagged(rows: int) -> str:
    return f"lag(close, {rows}) OVER ({W})"


def momentum(rows: int) -> str:
    before = lagged(rows)
    return rnd(f"CASE WHEN {before} > 0 THEN (close - {before}) / {before} * 100 END", 2)


def candles(key: str) -> str:
    return f"""
  SELECT {key} AS coin_id, {SLOT} AS candle_datetime, CAST({SLOT} AS DATE) AS candle_date,
         CAST(epoch_ms({SLOT}) AS BIGINT) AS timestamp_ms,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, count(*) AS ticks
  FROM events GROUP BY ALL"""


AVERAGES = ", ".join(
    f"{rnd(mean('close', frame(n)), 4)} AS ma_{d}d" for d, n in ((7, 41), (14, 83), (30, 179))
)
VOLATILITY = ", ".join(
    f"{rnd(stddev('close', frame(n)), 6)} AS volatility_{d}d"
    for d, n in ((7, 41), (14, 83), (30, 179))
) + (
    f", CASE WHEN daily_range_usd > {mean('daily_range_usd', frame(83))} * 1.5e0 "
    "THEN 'HIGH' ELSE 'NORMAL' END AS volatility_cluster"
)
MOMENTUM = ", ".join(
    f"{momentum(n)} AS momentum_{d}d" for d, n in ((1, 1), (7, 41), (14, 83))
)
BANDS = ", ".join(
    f"{rnd('min(low)' + frame(n), 4)} AS support_{d}d, "
    f"{rnd('max(high)' + frame(n), 4)} AS resistance_{d}d"
    for d, n in ((14, 83), (30, 179))
)
LEVEL = (
    "CASE WHEN close >= resistance_14d THEN 'AT_RESISTANCE' "
    "WHEN close <= support_14d THEN 'AT_SUPPORT' ELSE 'MID_RANGE' END AS price_level_signal"
)
TREND = (
    "CASE WHEN ma_30d > 0 THEN CASE WHEN close > ma_30d * 1.05e0 THEN 'STRONG_BULL' "
    "WHEN close > ma_30d THEN 'BULL' WHEN close < ma_30d * 0.95e0 THEN 'STRONG_BEAR' "
    "WHEN close < ma_30d THEN 'BEAR' ELSE 'NEUTRAL' END ELSE 'NEUTRAL' END AS trend_strength"
)
SCORE = rnd(
    "CASE WHEN momentum_7d IS NOT NULL THEN "
    "least(greatest((momentum_7d + 50e0) / 100e0, 0e0), 1e0) * 0.5e0 "
    "+ CASE trend_strength WHEN 'STRONG_BULL' THEN 1e0 WHEN 'BULL' THEN 0.7e0 "
    "WHEN 'BEAR' THEN 0.3e0 WHEN 'STRONG_BEAR' THEN 0e0 ELSE 0.5e0 END * 0.35e0 "
    "+ CASE price_level_signal WHEN 'AT_SUPPORT' THEN 0.7e0 WHEN 'AT_RESISTANCE' THEN 0.3e0 "
    "ELSE 0.5e0 END * 0.15e0 END",
    4,
)
SHAPE = (
    f"{DIRECTION} AS candle_direction, {rnd(BODY, 3)} AS candle_body_pct, "
    f"{rnd('high - low', 4)} AS daily_range_usd, "
    f"{rnd('CASE WHEN open > 0 THEN (high - low) / open * 100 END', 3)} AS daily_range_pct"
)
TRACKED = (
    "market_cap_rank", "market_segment", "supply_utilisation_pct", "ath_distance_bucket",
    "is_scarce",
)
CHANGED = " OR ".join(f"{{0}}.{c} IS DISTINCT FROM {{1}}.{c}" for c in TRACKED)


def featured(source: str, shape: str, wide: str, out: str) -> dict[str, tuple]:
    return {
        shape: ((source,), f"SELECT *, {SHAPE} FROM {source}"),
        wide: ((shape,), f"SELECT *, {AVERAGES}, {VOLATILITY}, {MOMENTUM}, {BANDS} FROM {shape}"),
        wide + "_l": ((wide,), f"SELECT *, {TREND}, {LEVEL} FROM {wide}"),
        out: (
            (wide + "_l",),
            f"""SELECT *, {SCORE} AS recommendation_score,
                CASE WHEN candle_body_pct > (SELECT quantile_disc({BODY}, 0.99) FROM {source})
                     THEN 'HIGH_BODY_PCT' END AS anomaly_flag,
                candle_date AS ingestion_date FROM {wide}_l""",
        ),
    }


def faulty(source: str, numbered: str, out: str) -> dict[str, tuple]:
    return {
        numbered: (
            (source,),
            "SELECT *, (timestamp_ms // 1000 - epoch(TIMESTAMP '2024-01-01')::BIGINT) // 14400 * 5 "
            f"+ length(coin_id) AS k FROM {source}",
        ),
        out: (
            (numbered,),
            f"""SELECT coin_id, candle_datetime, candle_date, timestamp_ms, ticks, k,
             CASE WHEN k % 61 = 0 THEN NULL WHEN k % 59 = 0 THEN high + 1 ELSE open END AS open,
             CASE WHEN k % 53 = 0 THEN low - 1 ELSE high END AS high,
             CASE WHEN k % 47 = 0 THEN -low - 1 ELSE low END AS low,
             CASE WHEN k % 43 = 0 THEN 0e0 WHEN k % 41 = 0 THEN high + 2 ELSE close END AS close
           FROM {numbered}, LATERAL (SELECT unnest(CASE WHEN k % 37 = 0 THEN [1, 2] ELSE [1] END))""",
        ),
    }


def tagged(source: str) -> str:
    return f"""SELECT *, concat_ws(' | ',
             CASE WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL
                    OR candle_datetime IS NULL OR coin_id IS NULL THEN 'C:null_ohlc_field' END,
             CASE WHEN open < 0 OR high < 0 OR low < 0 OR close < 0 THEN 'A:negative_price' END,
             CASE WHEN close = 0 THEN 'A:zero_close' END,
             CASE WHEN CASE WHEN open > 0 THEN close / open END > (SELECT {EXTREME} FROM {source})
                  THEN 'A:extreme_candle' END,
             CASE WHEN high < low THEN 'B:high_lt_low' END,
             CASE WHEN open < low OR open > high THEN 'B:open_outside_hl' END,
             CASE WHEN close < low OR close > high THEN 'B:close_outside_hl' END,
             CASE WHEN count(*) OVER (PARTITION BY coin_id, timestamp_ms) > 1
                  THEN 'B:duplicate_candle' END) AS quarantine_reasons
           FROM {source}"""


def market_chain(base: str, p: str, extra: str = "") -> dict[str, tuple]:
    """The market facts from a base of typed days."""
    return {
        p + "clean": (
            (base,),
            f"""SELECT * REPLACE (coalesce(price_change_24h, 0e0) AS price_change_24h,
                   coalesce(price_change_percentage_24h, 0e0) AS price_change_percentage_24h),
                 total_volume / market_cap AS volume_share{extra}
               FROM {base}""",
        ),
        p + "bound": (
            (p + "clean",),
            f"""SELECT quantile_disc(price_change_percentage_24h, 0.01) AS price_lower,
                 quantile_disc(price_change_percentage_24h, 0.99) AS price_upper,
                 quantile_disc(volume_share, 0.99) AS volume_upper FROM {p}clean""",
        ),
        p + "flag": (
            (p + "clean", p + "bound"),
            f"""SELECT m.*,
                 CASE WHEN price_change_percentage_24h > price_upper THEN price_upper
                      WHEN price_change_percentage_24h < price_lower THEN price_lower
                      ELSE price_change_percentage_24h END AS price_change_pct_24h_capped,
                 price_change_percentage_24h < price_lower OR price_change_percentage_24h > price_upper
                   OR volume_share > volume_upper AS anomaly_flag,
                 concat_ws(',', CASE WHEN price_change_percentage_24h < price_lower
                        OR price_change_percentage_24h > price_upper THEN 'PRICE_OUTLIER' END,
                      CASE WHEN volume_share > volume_upper THEN 'VOLUME_SPIKE' END) AS anomaly_reason
               FROM {p}clean m, {p}bound""",
        ),
        p + "lags": (
            (p + "flag",),
            f"""SELECT *, lag(current_price) OVER h AS prev_price,
                 lag(current_price, 2) OVER h AS price_lag_2,
                 lag(market_cap_rank) OVER h AS prev_rank,
                 {mean('current_price', ' OVER t')} AS ma_3,
                 max(current_price) OVER t AS top3, min(current_price) OVER t AS bottom3
               FROM {p}flag WINDOW h AS (PARTITION BY id ORDER BY ingestion_timestamp),
                 t AS (PARTITION BY id ORDER BY ingestion_timestamp ROWS 2 PRECEDING)""",
        ),
        p + "ret": (
            (p + "lags",),
            f"""SELECT *,
                 CASE WHEN prev_price > 0 THEN (current_price - prev_price) / prev_price * 100
                      ELSE price_change_pct_24h_capped END AS daily_return_pct,
                 CASE WHEN price_lag_2 > 0
                      THEN (current_price - price_lag_2) / price_lag_2 * 100 END AS change3,
                 current_price / ma_3 AS trend_strength_ratio,
                 (top3 - bottom3) / bottom3 * 100 AS price_range_volatility,
                 {rnd('total_volume / market_cap', 4)} AS liquidity_strength,
                 coalesce(prev_rank - market_cap_rank, 0) AS rank_movement,
                 {rnd("(epoch(TIMESTAMP '2024-01-31')::BIGINT - floor(epoch(ingestion_timestamp))::BIGINT) / 3600", 2)}
                   AS data_freshness_hours
               FROM {p}lags""",
        ),
        p + "silver": (
            (p + "ret",),
            f"""SELECT *,
                 coalesce((daily_return_pct + change3) / 2, daily_return_pct) AS price_movement_metric,
                 coalesce(change3, 0e0) AS price_3d_change_pct,
                 CASE WHEN trend_strength_ratio > 1 THEN 'BULLISH'
                      WHEN trend_strength_ratio < 1 THEN 'BEARISH' ELSE 'NEUTRAL' END
                   AS short_term_trend_signal,
                 {rnd('liquidity_strength * 100', 2)} AS liquidity_strength_pct,
                 rank() OVER (PARTITION BY ingestion_date ORDER BY market_cap DESC)
                   AS market_cap_rank_computed,
                 coalesce(abs(daily_return_pct) >
                   (SELECT quantile_disc(daily_return_pct, 0.9) FROM {p}ret), false) AS is_changed
               FROM {p}ret""",
        ),
    }


UTILISATION = rnd(
    "CASE WHEN max_supply > 0 THEN circulating_supply / max_supply * 100 END", 2
)

BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {
    "candles": ((), candles("event_type")),
    "gcandles": ((), candles("CAST(user_id % 20 AS VARCHAR)")),
    **featured("candles", "shaped", "wide", "featured"),
    **featured("gcandles", "gshaped", "gwide", "gfeatured"),
    **faulty("candles", "numbered", "dirty"),
    **faulty("gcandles", "gnumbered", "gdirty"),
    "tagged": (("dirty",), tagged("dirty")),
    "mbase": (
        (),
        """SELECT CAST(user_id AS VARCHAR) AS id, CAST(ts AS DATE) AS ingestion_date,
             count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_volume,
             max(value) AS high_24h, min(value) AS low_24h, max(ts) AS ingestion_timestamp
           FROM events GROUP BY ALL""",
    ),
    "mprice": (
        ("mbase",),
        f"SELECT *, {rnd('total_volume / n', 2)} AS current_price, CAST(id AS INT) AS i FROM mbase",
    ),
    "mdays0": (
        ("mprice",),
        f"""SELECT * EXCLUDE (i), 'c' || id AS symbol, 'Coin ' || id AS name,
             current_price * (i + 1) * 997 AS market_cap,
             row_number() OVER (PARTITION BY ingestion_date ORDER BY total_volume DESC, id)
               AS market_cap_rank,
             current_price - lag(current_price) OVER h AS price_change_24h,
             (current_price - lag(current_price) OVER h) / lag(current_price) OVER h * 100
               AS price_change_percentage_24h,
             CAST((i + 1) * (800 + n % 10 * 20) AS DOUBLE) AS circulating_supply,
             CAST((i + 1) * 1000 AS DOUBLE) AS total_supply,
             CASE WHEN i % 7 <> 0 THEN CAST((i + 1) * 1000 AS DOUBLE) END AS max_supply,
             {rnd("high_24h * CASE i % 5 WHEN 0 THEN 1.0e0 WHEN 1 THEN 1.15e0 WHEN 2 THEN 1.6e0 WHEN 3 THEN 3.0e0 ELSE 10.0e0 END", 2)} AS ath, {rnd('low_24h * 0.9e0', 2)} AS atl
           FROM mprice WINDOW h AS (PARTITION BY id ORDER BY ingestion_date)""",
    ),
    "mdays": (
        ("mdays0",),
        """SELECT *, CASE WHEN ath > 0 THEN (current_price - ath) / ath * 100 END
               AS ath_change_percentage,
             CASE WHEN atl > 0 THEN (current_price - atl) / atl * 100 END AS atl_change_percentage,
             current_price * total_supply AS fully_diluted_valuation
           FROM mdays0""",
    ),
    "partial": (
        ("mdays",),
        """SELECT * FROM mdays WHERE CAST(id AS INT) <
             CASE day(ingestion_date) % 5 WHEN 0 THEN 20 WHEN 1 THEN 17 WHEN 2 THEN 12
                  WHEN 3 THEN 5 ELSE 1 END""",
    ),
    "grades": (
        ("partial",),
        f"""SELECT ingestion_date, count(DISTINCT id) AS coins_received,
             20 AS coins_expected, {grade('count(DISTINCT id)', '20')} AS load_status
           FROM partial GROUP BY 1""",
    ),
    "graded": (("partial", "grades"), "SELECT * FROM partial JOIN grades USING (ingestion_date)"),
    "attrs": (
        ("mdays",),
        f"""SELECT *, {SEGMENT} AS market_segment, {UTILISATION} AS supply_utilisation_pct,
             coalesce({UTILISATION} >= 90, false) AS is_scarce,
             CASE WHEN ath_change_percentage IS NULL THEN 'UNKNOWN'
                  WHEN ath_change_percentage >= -5 THEN 'AT_ATH'
                  WHEN ath_change_percentage >= -20 THEN 'NEAR_ATH'
                  WHEN ath_change_percentage >= -50 THEN 'MID_RANGE'
                  ELSE 'DEEP_CORRECTION' END AS ath_distance_bucket,
             ingestion_date AS effective_from
           FROM mdays""",
    ),
    "marks": (
        ("attrs",),
        "SELECT *, "
        + " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER h" for c in TRACKED)
        + " OR row_number() OVER h = 1 AS is_new "
        "FROM attrs WINDOW h AS (PARTITION BY id ORDER BY effective_from)",
    ),
    "dim": (
        ("marks",),
        """SELECT *, row_number() OVER h AS scd_version, lead(effective_from) OVER h AS effective_to,
             lead(effective_from) OVER h IS NULL AS is_current
           FROM marks WHERE is_new WINDOW h AS (PARTITION BY id ORDER BY effective_from)""",
    ),
    "members": (
        (),
        """SELECT DISTINCT CAST(user_id AS VARCHAR) AS id, CAST(ts AS DATE) AS ingestion_date
           FROM events""",
    ),
    "universe": (
        ("members",),
        """SELECT id AS coin_id, 'Coin ' || id AS name, 'c' || id AS symbol,
             CAST(id AS INT) AS market_cap_rank, ingestion_date AS universe_date,
             true AS is_active, 'in_top_n' AS entry_reason FROM members
           UNION ALL
           SELECT id, 'Coin ' || id, 'c' || id, CAST(id AS INT),
             CAST(ingestion_date + INTERVAL 1 DAY AS DATE), false, 'exited_top_n'
           FROM members m
           WHERE NOT EXISTS (SELECT 1 FROM members x WHERE x.id = m.id
                             AND x.ingestion_date = m.ingestion_date + INTERVAL 1 DAY)
             AND EXISTS (SELECT 1 FROM members x
                         WHERE x.ingestion_date = m.ingestion_date + INTERVAL 1 DAY)""",
    ),
    **market_chain("mdays", "m", f", {SEGMENT} AS market_segment"),
    "gfresh": (
        ("gdirty",),
        """SELECT *, CASE day(candle_date) % 4 WHEN 0 THEN 'PARTIAL_LOAD'
             WHEN 1 THEN 'PARTIAL_LOAD_CRITICAL' ELSE 'SUCCESS' END AS load_status
           FROM gdirty WHERE k % 29 <> 0""",
    ),
    "gtagged": (("gfresh",), tagged("gfresh")),
    "sjoined": (
        ("gtagged", "dim", "ddate", "dhour"),
        """SELECT c.*, CASE load_status WHEN 'PARTIAL_LOAD' THEN 'WARN_PARTIAL'
             WHEN 'PARTIAL_LOAD_CRITICAL' THEN 'WARN_CRITICAL' END AS data_quality_flag,
             v.market_segment, v.supply_utilisation_pct, v.is_scarce, d.date_id, d.year_week,
             h.trading_session, h.candle_block
           FROM gtagged c
           LEFT JOIN dim v ON c.coin_id = v.id AND c.candle_date >= v.effective_from
             AND (v.effective_to IS NULL OR c.candle_date < v.effective_to)
           LEFT JOIN ddate d ON strftime(c.candle_date, '%Y-%m-%d') = d.date_actual
           LEFT JOIN dhour h ON d.date_id = h.date_id AND hour(c.candle_datetime) = h.hour
           WHERE quarantine_reasons = ''""",
    ),
    **featured("sjoined", "sshaped", "swide", "sfeatured"),
    "bronze_days": (("mdays",), "SELECT * FROM mdays WHERE n % 17 <> 0"),
    "sound_days": (
        ("bronze_days", "dim", "ddate", "partial"),
        """SELECT m.*, v.market_segment, v.supply_utilisation_pct, v.is_scarce,
             v.ath_distance_bucket, d.date_id, d.year_month, t.days_in_universe
           FROM bronze_days m
           LEFT JOIN dim v ON m.id = v.id AND m.ingestion_date >= v.effective_from
             AND (v.effective_to IS NULL OR m.ingestion_date < v.effective_to)
           LEFT JOIN ddate d ON strftime(m.ingestion_date, '%Y-%m-%d') = d.date_actual
           LEFT JOIN (SELECT id, count(*) AS days_in_universe FROM partial GROUP BY 1) t
             ON m.id = t.id
           WHERE m.n % 13 <> 0""",
    ),
    **market_chain("sound_days", "f"),
    "ddays": (
        (),
        """SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)),
             DATE '2024-04-30', INTERVAL 1 DAY)) AS DATE) AS d FROM events""",
    ),
    "ddate": (
        ("ddays",),
        """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id,
             strftime(d, '%Y-%m-%d') AS date_actual, year(d) AS year, quarter(d) AS quarter,
             'Q' || quarter(d) AS quarter_label, month(d) AS month,
             monthname(d) AS month_name, strftime(d, '%b') AS month_abbr,
             CAST(strftime(d, '%W') AS BIGINT) AS week_of_year, dayofyear(d) AS day_of_year,
             day(d) AS day_of_month, isodow(d) AS day_of_week, dayname(d) AS day_name,
             strftime(d, '%a') AS day_abbr, isodow(d) >= 6 AS is_weekend,
             isodow(d) <= 5 AS is_weekday, true AS is_trading_day,
             strftime(d, '%Y-%m') AS year_month, year(d) || '-Q' || quarter(d) AS year_quarter,
             strftime(d, '%Y-W%W') AS year_week, d = DATE '2024-01-31' AS is_today,
             d < DATE '2024-01-31' AS is_past, d > DATE '2024-01-31' AS is_future
           FROM ddays""",
    ),
    "dhour": (
        ("ddays",),
        """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) * 100 + h AS date_hour_id,
             CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id,
             strftime(d, '%Y-%m-%d') AS date_actual, h AS hour,
             lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS hour_label, h // 4 * 4 AS candle_block,
             h % 4 = 0 AS is_candle_open,
             CASE WHEN h < 8 THEN 'ASIA' WHEN h < 13 THEN 'LONDON' WHEN h < 21 THEN 'NY'
                  ELSE 'OFF' END AS trading_session,
             year(d) AS year, month(d) AS month, isodow(d) AS day_of_week,
             isodow(d) >= 6 AS is_weekend
           FROM (SELECT d, unnest(range(24)) AS h FROM ddays)""",
    ),
    "target": ((), "SELECT * FROM orders WHERE o_orderkey % 3 <> 0"),
    "source": (
        (),
        "SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders WHERE o_orderkey % 2 = 0",
    ),
}


def build(
    select: str,
    *needs: str,
    dates: tuple[str, ...] = (),
    stamps: tuple[str, ...] = (),
    extra: dict[str, str] | None = None,
) -> str:
    """A statement with the blocks it needs, in order; ``dates`` and ``stamps`` become text."""
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in BLOCKS[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    ctes = [f"{n} AS ({BLOCKS[n][1]})" for n in order]
    ctes += [f"{n} AS ({s})" for n, s in (extra or {}).items()]
    head = "WITH " + ",\n".join(ctes) + "\n" if ctes else ""
    if dates or stamps:
        swaps = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates]
        swaps += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in stamps]
        return f"{head}SELECT * REPLACE ({', '.join(swaps)}) FROM ({select})"
    return head + select
