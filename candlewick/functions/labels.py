"""Classifications: every label column of the published tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.config import Config
from candlewick.functions.numeric import pct_of

SUCCESS = "SUCCESS"
PARTIAL = "PARTIAL_LOAD"
CRITICAL = "PARTIAL_LOAD_CRITICAL"
SEVERE = "PARTIAL_LOAD_SEVERE"
FAILURE = "FAILURE"
STALE = "STALE"


def _first_match(value: Column, steps, default) -> Column:
    """CASE over ``(predicate on value, label)`` pairs, in order."""
    out = None
    for test, label in steps:
        out = F.when(test(value), label) if out is None else out.when(test(value), label)
    return out.otherwise(default)


def load_grade(received: Column, expected: Column | int, cfg: Config) -> Column:
    want = F.lit(expected) if isinstance(expected, int) else expected
    return _first_match(
        F.when(want > 0, received / want),
        [
            (lambda r: r >= 1.0, SUCCESS),
            (lambda r: r >= cfg.warn_ratio, PARTIAL),
            (lambda r: r >= cfg.critical_ratio, CRITICAL),
            (lambda r: r >= cfg.abort_ratio, SEVERE),
        ],
        FAILURE,
    )


def market_segment(rank: Column) -> Column:
    return _first_match(
        rank,
        [
            (lambda r: r <= 10, "Top_10"),
            (lambda r: r <= 50, "Top_50"),
            (lambda r: r <= 200, "Top_200"),
        ],
        "Long_Tail",
    )


def supply_utilisation_pct(circulating: Column, maximum: Column) -> Column:
    return F.round(pct_of(circulating, maximum), 2)


def is_scarce(utilisation_pct: Column) -> Column:
    return F.coalesce(utilisation_pct >= 90, F.lit(False))


def ath_distance_bucket(change_pct: Column) -> Column:
    return _first_match(
        change_pct,
        [
            (lambda c: c.isNull(), "UNKNOWN"),
            (lambda c: c >= -5, "AT_ATH"),
            (lambda c: c >= -20, "NEAR_ATH"),
            (lambda c: c >= -50, "MID_RANGE"),
        ],
        "DEEP_CORRECTION",
    )


def data_maturity(days: Column) -> Column:
    return _first_match(
        days,
        [
            (lambda d: d >= 30, "full"),
            (lambda d: d >= 14, "partial"),
            (lambda d: d >= 7, "early"),
        ],
        "new_entry",
    )


def signals_reliable(days: Column) -> Column:
    return F.coalesce(days >= 30, F.lit(False))


def candle_direction(opened: Column, closed: Column) -> Column:
    return F.when(closed > opened, "BULL").when(closed < opened, "BEAR").otherwise("DOJI")


def short_term_trend(strength: Column) -> Column:
    return F.when(strength > 1, "BULLISH").when(strength < 1, "BEARISH").otherwise("NEUTRAL")


def trend_strength(closed: Column, average: Column) -> Column:
    """Five classes against the long average, with a 5 % band; NULL or non-positive: neutral."""
    inside = (
        F.when(closed > average * 1.05, "STRONG_BULL")
        .when(closed > average, "BULL")
        .when(closed < average * 0.95, "STRONG_BEAR")
        .when(closed < average, "BEAR")
    )
    return F.coalesce(F.when(average > 0, inside), F.lit("NEUTRAL"))


def price_level(closed: Column, support: Column, resistance: Column) -> Column:
    return (
        F.when(closed >= resistance, "AT_RESISTANCE")
        .when(closed <= support, "AT_SUPPORT")
        .otherwise("MID_RANGE")
    )


def performance_label(change_pct: Column) -> Column:
    return _first_match(
        change_pct,
        [
            (lambda c: c >= 5, "TOP_GAINER"),
            (lambda c: c <= -5, "TOP_LOSER"),
            (lambda c: c.between(-1, 1), "STABLE"),
        ],
        "MOVER",
    )


def market_sentiment(up: Column, down: Column) -> Column:
    return (
        F.when(up > down * 2, "VERY_BULLISH")
        .when(up > down, "BULLISH")
        .when(down > up * 2, "VERY_BEARISH")
        .when(down > up, "BEARISH")
        .otherwise("NEUTRAL")
    )


def data_quality_flag(load_status: Column) -> Column:
    """Warns for the two upper partial tiers; the lower tiers carry no flag."""
    return F.when(load_status == PARTIAL, "WARN_PARTIAL").when(
        load_status == CRITICAL, "WARN_CRITICAL"
    )


def display_label(identifier: Column) -> Column:
    return F.initcap(F.replace(identifier, F.lit("-"), F.lit(" ")))


def trading_session(hour: Column) -> Column:
    return _first_match(
        hour,
        [
            (lambda h: h < 8, "ASIA"),
            (lambda h: h < 13, "LONDON"),
            (lambda h: h < 21, "NY"),
        ],
        "OFF",
    )
