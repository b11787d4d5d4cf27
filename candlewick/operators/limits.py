"""Exact quantiles over a growing history, from counts that are stored day by day.

The values of a column are cut into cells once: one for every cut value itself, one between each two
neighbours. A day adds its rows' counts per cell, so history is not read to count it. The cell that holds
a wanted rank follows from the added-up counts; a cut value is the answer itself, and between two cuts only
the history's rows inside that range are read, by a filter that reaches the scan. Cuts decide how much is
read, never what comes out: days that differ from those the cuts were taken from only make cells uneven.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

Values = dict[str, Column]
#: label of a limit -> (value it is a limit of, share of the rows at or below it)
Shares = dict[str, tuple[str, float]]

#: Cuts of a value; its cells are at most twice as many and one more.
CUTS = 1023
#: Ranges with more rows are cut again before their values are put in order.
MOST_ROWS = 1_000_000


def _cuts(value: Column) -> Column:
    """Cut values by a mergeable quantile sketch; none if there is no value."""
    known = F.nullif(value, F.lit(float("nan")))
    shares = F.array(*[F.lit(i / (CUTS + 1)) for i in range(1, CUTS + 1)])
    found = F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(known), shares)
    return F.when(F.count(known) > 0, F.array_distinct(found)).otherwise(F.array().cast("array<double>"))


def _cell(value: Column, cuts: Column) -> Column:
    """Twice the number of cuts below the value, and one more where it equals the next; NULL without value."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(CUTS.bit_length()))])
    further = lambda at, step: F.when(F.get(cuts, at + step - 1) < value, at + step).otherwise(at)
    below = F.aggregate(steps, F.lit(0), further)
    cell = F.transform(F.array(below), lambda at: 2 * at + F.coalesce(F.get(cuts, at) == value, F.lit(False)).cast("int"))
    return F.when(value.isNotNull(), F.get(cell, F.lit(0)))


def cut_points(rows: DataFrame, values: Values) -> DataFrame:
    """``name, cuts`` for each value, to be stored once; one pass."""
    found = rows.agg(*[F.struct(F.lit(n).alias("name"), _cuts(v.cast("double")).alias("cuts")).alias(f"c{i}") for i, (n, v) in enumerate(values.items())])
    return found.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(values))])).alias("c")).select("c.*")


def day_counts(rows: DataFrame, values: Values, cuts: DataFrame, day: str) -> DataFrame:
    """``day, name, cell, n``: a day's rows in each cell of each value; NULLs do not count."""
    told = [F.struct(F.lit(n).alias("name"), v.cast("double").alias("v")) for n, v in values.items()]
    each = rows.select(F.col(day).alias("day"), F.explode(F.array(*told)).alias("c")).where("c.v IS NOT NULL")
    # ``CUTS`` numbers a value at most
    placed = each.select("day", "c.*").join(F.broadcast(cuts), "name").withColumn("cell", _cell(F.col("v"), F.col("cuts")))
    return placed.groupBy("day", "name", "cell").agg(F.count("*").alias("n"))


def _reached(totals: DataFrame, cuts: DataFrame, aims: DataFrame) -> list[Row]:
    """The cell of each limit: ``label, exact`` where it is a cut, else ``lo, hi, rank, n`` of a range.

    One row a limit comes to the driver, so that ranges can be literals of a pushed filter.
    """
    rising, whole = Window.partitionBy("label").orderBy("cell"), Window.partitionBy("label")
    placed = totals.join(aims, "label").withColumns({"upto": F.sum("n").over(rising), "total": F.sum("n").over(whole)})
    aim = F.coalesce("rank", F.greatest(F.ceil(F.col("share") * F.col("total")), F.lit(1)))
    first = placed.withColumn("aim", aim).where("upto >= aim").groupBy("label").agg(
        F.min_by(F.struct("cell", "n", (F.col("aim") - F.col("upto") + F.col("n")).cast("long").alias("rank")), "cell").alias("s")
    )
    at = F.shiftright("s.cell", 1)
    own = F.col("s.cell") % 2 == 1
    return (
        first.join(cuts, "label")
        .select(
            "label", "s.n", "s.rank", F.when(own, F.get("cuts", at)).alias("exact"),
            F.get("cuts", at - 1).alias("lo"), F.get("cuts", at).alias("hi"),
        )
        .collect()
    )


def limits(
    history: DataFrame, values: Values, shares: Shares, cuts: DataFrame, counts: DataFrame, most_rows: int = MOST_ROWS
) -> DataFrame:
    """One row, one column a limit: the lowest value whose cumulative share reaches the share, NULL without
    values. ``counts`` must cover ``history``; that is where ``cut_points`` and ``day_counts`` belong.

    Ranges with more than ``most_rows`` rows are cut again, each time into a thousandth or less.
    """
    spark = history.sparkSession
    # an exact decimal product: 0.07 of 100 rows must not become 8 rows
    wanted = spark.createDataFrame([(lb, n, str(p)) for lb, (n, p) in shares.items()], "label string, name string, share string")
    aims = wanted.select("label", F.col("share").cast("decimal(18,12)").alias("share"), F.lit(None).cast("long").alias("rank"))
    totals = counts.groupBy("name", "cell").agg(F.sum("n").alias("n")).join(wanted, "name").select("label", "cell", "n")
    found = _reached(totals, cuts.join(wanted, "name").select("label", "cuts"), aims)
    answers: dict[str, float] = {r.label: r.exact for r in found if r.exact is not None}
    ranges = {r.label: (r.lo, r.hi, r.rank, r.n) for r in found if r.exact is None}
    while ranges:
        inside = _inside(history, values, shares, ranges)
        ranks = spark.createDataFrame([(lb, r[2]) for lb, r in ranges.items()], "label string, rank long")
        if max(r[3] for r in ranges.values()) <= most_rows:
            rising = Window.partitionBy("label").orderBy("v")
            upto = inside.groupBy("label", "v").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(rising))
            reached = upto.join(ranks, "label").where("upto >= rank").groupBy("label").agg(F.min("v").alias("v"))
            answers |= {r.label: r.v for r in reached.collect()}
            break
        again = inside.groupBy("label").agg(_cuts(F.col("v")).alias("cuts"))
        cells = inside.join(F.broadcast(again), "label").groupBy("label", _cell(F.col("v"), F.col("cuts")).alias("cell")).agg(F.count("*").alias("n"))
        found = _reached(cells, again, ranks.withColumn("share", F.lit(None).cast("decimal(18,12)")))
        answers |= {r.label: r.exact for r in found if r.exact is not None}
        outer = lambda new, old: old if new is None else new
        ranges = {
            r.label: (outer(r.lo, ranges[r.label][0]), outer(r.hi, ranges[r.label][1]), r.rank, r.n)
            for r in found
            if r.exact is None
        }
    return spark.range(1).select(*[F.lit(answers.get(lb)).cast("double").alias(lb) for lb in shares])


def _inside(history: DataFrame, values: Values, shares: Shares, ranges: dict) -> DataFrame:
    """``label, v``: the history's values strictly inside each limit's range, in one filtered scan."""
    tests, cells = [], []
    for label, (lo, hi, *_) in ranges.items():
        value = values[shares[label][0]]
        test = value.isNotNull()
        test = test if lo is None else test & (value > lo)
        test = test if hi is None else test & (value < hi)
        tests.append(test)
        cells.append(F.when(test, F.struct(F.lit(label).alias("label"), value.cast("double").alias("v"))))
    rows = history.where(reduce(or_, tests)).select(F.explode(F.array_compact(F.array(*cells))).alias("c"))
    return rows.select("c.*")
