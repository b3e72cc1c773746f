"""Exact quantiles, quantile classes and outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import group_thousands
from ..session import cut_lineage
from .positions import join_on, with_running_total

# Approximate quantiles are within one in so many rows of the exact ones.
ACCURACY = 1000
# Distinct values of a bracket that one task may put in order.
NEAR = 100_000
_VALUE, _ZONE = "_value", "_zone"


def small_domain_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], by: Sequence[str] = (), name: str = "quantiles"
) -> DataFrame:
    """Exact linear quantiles as an array, for columns with a known small set of values.

    Meant for whole kilometres, ages or years: the aggregate holds one entry
    per distinct value, so its size does not grow with the rows.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    levels = F.array(*[F.lit(float(p)) for p in probabilities])
    return counts.groupBy(*by).agg(F.percentile(column, levels, F.col("_n")).alias(name))


def quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], by: Sequence[str] = (), name: str = "quantiles"
) -> DataFrame:
    """Exact linear quantiles as an array, for columns with any number of distinct values.

    Selection by bracketing, without an order of all rows. A first pass brackets every quantile between two approximate
    ones. A second one counts the rows below, between and inside the brackets, and keeps distinct values inside only, a
    few thousandths of the rows. Each quantile is then read from the values of its bracket around its rank. A quantile
    that its bracket missed, or whose bracket still holds more than ``NEAR`` distinct values, is read from the ordered values
    of that stretch, spread over all tasks. Null values are left out; a group of nulls only has no row, but without ``by`` there is
    always one. NaN counts as the largest value.
    """
    rows = df.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias(_VALUE))
    reach = 2 / ACCURACY
    ends = {p: (max(0.0, p - reach), min(1.0, p + reach)) for p in map(float, probabilities) if 0 < p < 1}
    levels = sorted({end for pair in ends.values() for end in pair}) or [0.5]
    approximate = F.percentile_approx(_VALUE, F.array(*[F.lit(x) for x in levels]), F.lit(ACCURACY))
    brackets = cut_lineage(
        rows.groupBy(*by).agg(
            F.count(F.lit(1)).alias("_total"),
            approximate.alias("_edges"),
            F.min(_VALUE).alias("_least"),
            F.max(_VALUE).alias("_greatest"),
        )
    )
    if not ends:
        pick = [F.col("_least") if p == 0 else F.col("_greatest") for p in probabilities]
        return brackets.select(*by, F.array(*pick).alias(name))

    if by:
        bracketed = join_on(rows, brackets.select(*by, "_edges"), by)
    else:
        bracketed = rows.withColumn("_edges", brackets.select("_edges").scalar())
    value, edge = F.col(_VALUE), [F.col("_edges")[i] for i in range(len(levels))]
    # Zones are the stretches between neighbouring edges and the edges themselves, in their order.
    zone = reduce(add, [(value > e).cast("int") + (value >= e).cast("int") for e in edge])
    inside = reduce(
        or_, [value.between(edge[levels.index(low)], edge[levels.index(high)]) for low, high in ends.values()]
    )
    zoned = bracketed.select(*by, zone.alias(_ZONE), _VALUE, inside.alias("_inside"))
    counted = cut_lineage(
        zoned.groupBy(*by, _ZONE, F.when(F.col("_inside"), value).alias("_shown")).agg(
            F.count(F.lit(1)).alias("_n"), F.min(_VALUE).alias("_low"), F.max(_VALUE).alias("_high")
        )
    )
    earlier = Window.partitionBy(*by).orderBy(_ZONE).rowsBetween(Window.unboundedPreceding, -1)
    zones = (
        counted.groupBy(*by, _ZONE)
        .agg(
            F.sum("_n").alias("_n"),
            F.count("_shown").alias("_size"),
            F.min("_low").alias("_low"),
            F.max("_high").alias("_high"),
        )
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    )
    ranks = []
    for i, p in enumerate(map(float, probabilities)):
        if p not in ends:
            continue
        position = (F.col("_total") - 1) * F.lit(p)
        for side, rank in (("low", F.floor(position)), ("high", F.ceil(position))):
            ranks.append(F.struct(F.lit(f"_{side}_{i}").alias("_pick"), rank.alias("_rank")))
    asked = brackets.where("_total > 0").select(*by, F.explode(F.array(*ranks)).alias("_a")).select(*by, "_a.*")
    holds = (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n"))
    rank = (F.col("_rank") - F.col("_before")).alias("_rank")
    picks = join_on(asked, zones, by).where(holds).select(*by, _ZONE, "_pick", rank, "_low", "_high", "_size")
    settled = F.col("_low").eqNullSafe(F.col("_high"))
    near = ~settled & F.col("_size").between(1, NEAR)
    keys = [*by, _ZONE]

    def within(running: DataFrame, wanted: DataFrame) -> DataFrame:
        """Values at the wanted ranks of a zone; ``running`` has its distinct values, their rows and the rows before."""
        holds = (F.col("before__n") <= F.col("_rank")) & (F.col("_rank") < F.col("before__n") + F.col("_n"))
        return join_on(wanted.select(*keys, "_pick", "_rank"), running, keys).where(holds).select(*by, "_pick", _VALUE)

    def of_zones(values: DataFrame, wanted: DataFrame) -> DataFrame:
        return join_on(values, wanted.select(*keys).distinct(), keys)

    shown = counted.where(F.col("_shown").isNotNull()).select(*keys, F.col("_shown").alias(_VALUE), "_n")
    ahead = Window.partitionBy(*keys).orderBy(_VALUE).rowsBetween(Window.unboundedPreceding, -1)
    close = of_zones(shown, picks.where(near)).withColumn("before__n", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    found = picks.where(settled).select(*by, "_pick", F.col("_low").alias(_VALUE)).unionByName(within(close, picks.where(near)))
    far = picks.where(~settled & ~near)
    if not far.isEmpty():
        missed = of_zones(zoned.where(~F.col("_inside")).select(*keys, _VALUE), far)
        rest = of_zones(shown, far).unionByName(missed.groupBy(*keys, _VALUE).agg(F.count(F.lit(1)).alias("_n")))
        found = found.unionByName(within(with_running_total(rest, [_VALUE], ["_n"], by=keys), far))

    def picked(side: str, i: int) -> Column:
        return F.max(F.when(F.col("_pick") == f"_{side}_{i}", F.col(_VALUE))).alias(f"_{side}_{i}")

    places = [i for i, p in enumerate(map(float, probabilities)) if p in ends]
    gathered = found.groupBy(*by).agg(*[picked(side, i) for i in places for side in ("low", "high")])
    whole = ["_total", "_least", "_greatest"]
    if by:
        gathered = join_on(gathered, brackets.select(*by, *whole), by)
    else:
        gathered = gathered.withColumns({c: brackets.select(c).scalar() for c in whole})
    results = []
    for i, p in enumerate(map(float, probabilities)):
        if p not in ends:
            results.append(F.col("_least") if p == 0 else F.col("_greatest"))
            continue
        position = (F.col("_total") - 1) * F.lit(p)
        low, high = F.col(f"_low_{i}"), F.col(f"_high_{i}")
        results.append(F.when(low == high, low).otherwise(low + (high - low) * (position - F.floor(position))))
    return gathered.select(*by, F.array(*results).alias(name))


def with_quantile_classes(df: DataFrame, classes: Mapping[str, int], labels: Mapping[str, str]) -> DataFrame:
    """Put columns into equally frequent classes ``]low,high]`` (lowest value included).

    ``classes`` gives the number of classes of each column, ``labels`` the name
    of its class column. A label shows whole numbers with a space between
    thousands; ``<label>_ordre`` holds the number of the class. The edges of
    all columns come from one pass.
    """
    levels = sorted({i / n for n in classes.values() for i in range(n + 1)})
    long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in classes], "variable", "value")
    found = quantiles(long, "value", levels, by=["variable"])
    # Edges and labels are made once, in one row; each row looks its class up.
    most = {}
    for column, n in classes.items():
        edge = [F.col("quantiles")[levels.index(i / n)] for i in range(n + 1)]
        shown = [group_thousands(e) for e in edge]
        names = [F.concat(F.lit("]"), shown[i], F.lit(","), shown[i + 1], F.lit("]")) for i in range(n)]
        of_column = F.struct(F.array(*edge[1:]).alias("high"), F.array(*names).alias("label"))
        most[column] = F.max(F.when(F.col("variable") == column, of_column)).alias(column)
    table = found.agg(F.struct(*most.values()).alias("table")).scalar()
    result = df.withColumn("_table", table)
    for column, n in classes.items():
        high, number = F.col("_table")[column]["high"], F.lit(None).cast("int")
        for i in reversed(range(1, n + 1)):
            number = F.when(F.col(column) <= high[i - 1], i).otherwise(number)
        result = result.withColumn(f"{labels[column]}_ordre", number)
        name = F.get(F.col("_table")[column]["label"], F.col(f"{labels[column]}_ordre") - 1)
        result = result.withColumn(labels[column], name)
    names = [c for c in df.columns if c not in labels.values()]
    ordered = [n for label in labels.values() for n in (label, f"{label}_ordre")]
    return result.select(*names, *ordered)


def with_quantile_class(df: DataFrame, column: str, classes: int, label: str) -> DataFrame:
    """One column of :func:`with_quantile_classes`."""
    return with_quantile_classes(df, {column: classes}, {column: label})


def iqr_outliers(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Rows outside the quartiles by more than ``factor`` times their distance."""
    quartiles = quantiles(df, column, [0.25, 0.75]).scalar()
    low, high = F.element_at("_quartiles", 1), F.element_at("_quartiles", 2)
    reach = (high - low) * factor
    value = F.col(column)
    outside = (value > high + reach) | (value < low - reach)
    return df.withColumn("_quartiles", quartiles).where(outside).drop("_quartiles")


def with_zscore(df: DataFrame, column: str, name: str = "zscore") -> DataFrame:
    """Standard score with the population deviation."""
    moments = df.agg(F.struct(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std")).alias("m")).scalar()
    return (
        df.withColumn("_moments", moments)
        .withColumn(name, F.try_divide(F.col(column) - F.col("_moments.mean"), F.col("_moments.std")))
        .drop("_moments")
    )


def reference_lines(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Quantile levels of several columns, one row per column and level."""
    long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in columns], "variable", "value")
    found = quantiles(long, "value", probabilities, by=["variable"])
    levels = F.array(*[F.lit(float(p)) for p in probabilities])
    pairs = F.arrays_zip(levels.alias("probability"), F.col("quantiles").alias("value"))
    return found.select("variable", F.explode(pairs).alias("q")).select("variable", "q.probability", "q.value")


