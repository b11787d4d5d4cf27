"""Statistics over the last rows of a history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

# name -> (mean | std | min | max, column, rows before the current one)
Wanted = dict[str, tuple[str, str, int]]
EXTREMES = {"min": F.least, "max": F.greatest}
#: Windows grow by this factor from level to level.
GROWTH = 16
#: Sums are exact whole numbers of this unit wherever all values of a window are; else they are doubles.
UNITS = 1e8


def with_rolling(df: DataFrame, w: WindowSpec, wanted: Wanted) -> DataFrame:
    """Add the wanted statistics. NULLs do not count; the start of a history has shorter windows;
    the deviation is that of a sample, NULL for a single row.

    A sliding frame would visit all 180 rows for every row. Here windows of 1, 16, 256, ... rows are
    put together from 16 of the level below (``lag``), and a window of any width from disjoint ones of
    all levels, newest first: 42 rows are ten single rows and two windows of 16. All statistics share
    one pass of windows a level. A row's result depends on the rows of its window alone, not on how
    a history was cut or partitioned.
    """
    if not wanted:
        return df
    states = {_state(kind, column): (kind, column) for kind, column, _ in wanted.values()}
    needed: dict[str, set[int]] = {}
    for kind, column, rows in wanted.values():
        needed.setdefault(_state(kind, column), set()).add(rows + 1)
    out = df.withColumns({s: F.col(c) if k in EXTREMES else _one(c) for s, (k, c) in states.items()})
    size, done = 1, set()
    while any(size <= max(widths) for widths in needed.values()):
        # new name -> (state, offsets of its windows, name of what newer rows have gathered)
        parts: dict[str, tuple[str, list[int], str | None]] = {}
        for state, widths in needed.items():
            for width in sorted(widths):
                offsets = [width % size + size * k for k in range(width // size % GROWTH)]
                if offsets:
                    name = f"{state}_of_{width}"
                    parts[name] = (state, offsets, name if name in done else None)
                    done.add(name)
            if size * GROWTH <= max(widths):
                parts[f"{state}_next"] = (state, [size * k for k in range(GROWTH)], None)
        lags = {
            f"{state}_{rows}": F.lag(state, rows).over(w)
            for state, offsets, _ in parts.values()
            for rows in offsets
            if rows
        }
        out = out.withColumns(lags)
        pieces = {
            name: [*([held] if held else []), *[f"{state}_{rows}" if rows else state for rows in offsets]]
            for name, (state, offsets, held) in parts.items()
        }
        kinds = {name: states[state][0] for name, (state, _, _) in parts.items()}
        totals = {f"{n}_total": _totals(pieces[n]) for n, kind in kinds.items() if kind not in EXTREMES}
        out = out.withColumns(totals).withColumns(
            {n: _extreme(kind, pieces[n]) if kind in EXTREMES else _moments(f"{n}_total", pieces[n]) for n, kind in kinds.items()}
        )
        grown = [s for s in needed if f"{s}_next" in parts]
        out = out.drop(*lags, *totals, *needed).withColumnsRenamed({f"{s}_next": s for s in grown})
        needed = {s: widths for s, widths in needed.items() if s in grown}
        size *= GROWTH
    results = {}
    for name, (kind, column, rows) in wanted.items():
        found = f"{_state(kind, column)}_of_{rows + 1}"
        results[name] = F.col(found) if kind in EXTREMES else _result(kind, found)
    return out.withColumns(results).drop(*done)


def _state(kind: str, column: str) -> str:
    return f"_{kind if kind in EXTREMES else 'moments'}_{column}"


def _extreme(kind: str, pieces: list[str]) -> Column:
    return EXTREMES[kind](*pieces) if len(pieces) > 1 else F.col(pieces[0])


# --- mergeable moments -----------------------------------------------------------------------


def _one(column: str) -> Column:
    """The moments of one value: count, sum as a whole number and as a double, squared deviations from
    the mean; NULL for no value. The whole number is NULL for a value with more digits, or too large."""
    known = F.col(column).cast("double")
    units = F.when(F.abs(known) < 1e9, F.round(known * UNITS).cast("long"))
    one = F.struct(
        F.lit(1).cast("long").alias("n"),
        F.when(units / UNITS == known, units).alias("exact"),
        known.alias("sum"),
        F.lit(0.0).alias("m2"),
    )
    return F.when(known.isNotNull(), one)


def _totals(pieces: list[str]) -> Column:
    """Count and sums of several windows. A whole number that no longer fits is NULL; so is one with
    a part that lacks it."""
    zero = F.lit(0).cast("long")
    exact = [F.when(F.col(p).isNull(), zero).otherwise(F.col(f"{p}.exact")) for p in pieces]
    return F.struct(
        reduce(Column.__add__, [F.coalesce(f"{p}.n", zero) for p in pieces]).alias("n"),
        reduce(F.try_add, exact).alias("exact"),
        reduce(Column.__add__, [F.coalesce(f"{p}.sum", F.lit(0.0)) for p in pieces]).alias("sum"),
    )


def _moments(total: str, pieces: list[str]) -> Column:
    """Deviations of several windows are merged around the common mean: large prices do not cancel
    small ones, as differences of squares would."""
    mean = F.col(f"{total}.sum") / F.greatest(f"{total}.n", F.lit(1))
    terms = []
    for p in pieces:
        apart = F.col(f"{p}.sum") / F.col(f"{p}.n") - mean
        terms.append(F.coalesce(F.col(f"{p}.m2") + apart * apart * F.col(f"{p}.n"), F.lit(0.0)))
    m2 = reduce(Column.__add__, terms).alias("m2")
    merged = F.struct(*[F.col(f"{total}.{x}").alias(x) for x in ("n", "exact", "sum")], m2)
    return F.when(F.col(f"{total}.n") > 0, merged)


def _result(kind: str, found: str) -> Column:
    n = F.col(f"{found}.n")
    if kind == "std":
        return F.when(n > 1, F.sqrt(F.col(f"{found}.m2") / (n - 1)))
    return F.coalesce(F.col(f"{found}.exact") / UNITS, F.col(f"{found}.sum")) / n
