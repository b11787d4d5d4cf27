"""Arithmetic helpers: guarded ratios, category rounding, averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.config import Config


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` where the divisor is positive, else NULL (never raises under ANSI)."""
    return F.when(bottom > 0, top / bottom)


def pct_of(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom * 100)


def pct_change(now: Column, before: Column) -> Column:
    return F.when(before > 0, (now - before) / before * 100)


def round_by_category(
    df: DataFrame,
    cfg: Config,
    price: tuple[str, ...] = (),
    pct: tuple[str, ...] = (),
    ratios: tuple[str, ...] = (),
) -> DataFrame:
    """Round every floating column in one projection; uncategorised ones get the pct digits."""
    digits = dict.fromkeys(pct, cfg.pct_digits)
    digits |= dict.fromkeys(ratios, cfg.ratio_digits)
    digits |= dict.fromkeys(price, cfg.price_digits)
    return df.select(
        *[
            F.round(name, digits.get(name, cfg.pct_digits)).alias(name)
            if kind in ("double", "float")
            else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def _exact(column: Column, scale: int) -> Column:
    return column.cast(f"decimal(18,{scale})")


def mean_of(column: Column, cfg: Config) -> Column:
    """Average as a plain aggregate expression (exact decimal sum when configured)."""
    if cfg.exact_scale is None:
        return F.avg(column)
    exact = _exact(column, cfg.exact_scale)
    mean = F.sum(exact).cast("double") / F.nullif(F.count(column), F.lit(0))
    # infinite values and NaN have no decimal: their mean is that of doubles
    return F.when(F.count(exact) < F.count(column), F.avg(column)).otherwise(mean)
