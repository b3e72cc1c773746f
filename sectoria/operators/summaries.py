"""Descriptions of columns: describe, missing values, counts, histograms, pivots and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import all_present
from ..functions.numeric import rate
from .quantiles import quantiles


def _long(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """(variable, value) rows of some columns, all cast to one type."""
    return df.unpivot([], [F.col(f"`{c}`").cast(kind).alias(c) for c in columns], "variable", "value")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each listed column, missing values left out."""
    counted = _long(df, columns, "string").where(F.col("value").isNotNull())
    return counted.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("effectif"))


def describe(df: DataFrame, numeric: Sequence[str], text: Sequence[str] = ()) -> DataFrame:
    """One row per column: counts, moments and quartiles of numbers; distinct values and the top one of texts."""
    values = _long(df, numeric, "double").where(F.col("value").isNotNull())
    moments = values.groupBy("variable").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = quantiles(values, "value", [0.25, 0.5, 0.75], by=["variable"])
    numbers = moments.join(quartiles, "variable").select(
        "variable",
        "count",
        F.lit(None).cast("bigint").alias("unique"),
        F.lit(None).cast("string").alias("top"),
        F.lit(None).cast("bigint").alias("freq"),
        "mean",
        "std",
        "min",
        *[F.element_at("quantiles", i).alias(f"q{q}") for i, q in enumerate((25, 50, 75), start=1)],
        "max",
    )
    if not text:
        return numbers
    missing = F.lit(None).cast("double")
    texts = (
        value_counts(df, text)
        .groupBy("variable")
        .agg(
            F.sum("effectif").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            F.min_by("value", F.struct((-F.col("effectif")).alias("n"), "value")).alias("top"),
            F.max("effectif").alias("freq"),
        )
    )
    names = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    return numbers.unionByName(texts.select("*", *[missing.alias(n) for n in names]))


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing and present values of every column, from one pass over the rows."""
    names = df.columns
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m_{c}") for c in names]
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`m_{c}`").alias("manquants")) for c in names])
    return row.select("_rows", F.explode(pairs).alias("p")).select(
        "p.variable", "p.manquants", (F.col("_rows") - F.col("p.manquants")).alias("presents")
    )


def automatic_bins(df: DataFrame, column: str) -> Column:
    """Number of equal-width bins that suits the values, as a one-row scalar.

    The smaller width of two rules: Sturges' (range / (log2 n + 1)) and that of Freedman and Diaconis (twice the distance of
    the quartiles / cube root of n), the latter only if the quartiles differ. At least one bin; null without values.
    """
    value = F.col(column).cast("double")
    ends = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n")).alias("e")).scalar()
    quartiles = quantiles(df, column, [0.25, 0.75]).withColumn("e", ends)
    reach, n = F.col("e.high") - F.col("e.low"), F.col("e.n")
    sturges = reach / (F.log2(n.cast("double")) + 1)
    between = 2 * (F.col("quantiles")[1] - F.col("quantiles")[0]) / F.cbrt(n.cast("double"))
    width = F.when(between > 0, F.least(between, sturges)).otherwise(sturges)
    bins = F.when(reach > 0, F.ceil(F.try_divide(reach, width))).when(n > 0, F.lit(1))
    return quartiles.select(F.greatest(bins, F.lit(1)).cast("long").alias("bins")).scalar()


def histogram(df: DataFrame, column: str, bins: int | None = 10) -> DataFrame:
    """Equal-width bins from the least to the greatest value, the last one closed; empty bins count 0.

    Without a number of ``bins`` it is :func:`automatic_bins`; a single far value then makes many of them. If all values are
    equal, all fall in the first bin, of width 0; without values there are no bins.
    """
    value = F.col(column).cast("double")
    number = automatic_bins(df, column) if bins is None else F.lit(bins).cast("long")
    ends = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("e")).scalar()
    # One row with the ends and the number of bins, that every row sees.
    layout = df.sparkSession.range(1).select(F.struct(ends.alias("e"), number.alias("bins")).alias("l")).scalar()
    width = (F.col("l.e.high") - F.col("l.e.low")) / F.col("l.bins")
    place = F.when(width == 0, F.lit(0).cast("long")).otherwise(
        F.least(F.floor(F.try_divide(F.col("v") - F.col("l.e.low"), width)), F.col("l.bins") - 1)
    )
    placed = df.where(value.isNotNull()).select(value.alias("v"), layout.alias("l"))
    counts = placed.select(place.alias("classe")).groupBy("classe").agg(F.count(F.lit(1)).alias("effectif"))
    every = df.sparkSession.range(1).select(layout.alias("l")).where(F.col("l.e.low").isNotNull())
    return (
        every.select("l", F.explode(F.sequence(F.lit(0).cast("long"), F.col("l.bins") - 1)).alias("classe"))
        .join(counts, "classe", "left")
        .select(
            (F.col("classe") + 1).cast("int").alias("classe"),
            (F.col("l.e.low") + F.col("classe") * width).alias("debut"),
            (F.col("l.e.low") + (F.col("classe") + 1) * width).alias("fin"),
            F.coalesce("effectif", F.lit(0)).alias("effectif"),
        )
    )


def density_curve(df: DataFrame, column: str, points: int = 200, cells: int = 4096) -> DataFrame:
    """Gaussian density at ``points`` equally spaced places from the least to the greatest value: ``x``, ``densite``.

    The bandwidth is Scott's (standard deviation / fifth root of n). The values are counted once in ``cells`` narrow cells,
    and the curve is the sum of the cells' counts under the kernel; so its work does not grow with the rows. No curve for less than
    two values, or equal ones.
    """
    value = F.col(column).cast("double")
    moments = df.agg(
        F.struct(F.min(value).alias("low"), F.max(value).alias("high"), F.stddev_samp(value).alias("std"), F.count(value).alias("n")).alias("m")
    ).scalar()
    reach = F.col("m.high") - F.col("m.low")
    placed = df.where(value.isNotNull()).select(value.alias("v"), moments.alias("m")).where(reach > 0)
    cell = F.least(F.floor((F.col("v") - F.col("m.low")) / (reach / cells)), F.lit(cells - 1))
    counts = placed.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("c"))
    centre = F.col("m.low") + (F.col("cell") + 0.5) * (reach / cells)
    x = F.col("m.low") + F.col("point") * (reach / (points - 1))
    width = F.col("m.std") / F.pow(F.col("m.n").cast("double"), F.lit(0.2))
    seen = counts.select("cell", "c", moments.alias("m"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    height = F.col("c") * F.exp(-F.pow((x - centre) / width, F.lit(2.0)) / 2)
    scaled = height / (F.col("m.n") * width * F.sqrt(2 * F.pi()))
    return seen.groupBy("point", x.alias("x")).agg(F.sum(scaled).alias("densite")).select("x", "densite")


def pivot_table(
    df: DataFrame,
    index: Sequence[str],
    category: str,
    categories: Sequence[str],
    value: Column,
    fill: float | None = None,
) -> DataFrame:
    """One column per listed category holding the aggregate ``value``; the list fixes the schema."""
    table = df.where(all_present(index)).groupBy(*index).pivot(category, list(categories)).agg(value)
    return table if fill is None else table.fillna(fill, subset=list(categories))


def contingency(df: DataFrame, rows: str, column: str, categories: Sequence[str]) -> DataFrame:
    """Counts of ``rows`` by ``column`` as a table, absent combinations as 0."""
    complete = df.where(all_present([rows, column]))
    return pivot_table(complete, [rows], column, categories, F.count(F.lit(1)), fill=0)


def share_in_category(df: DataFrame, category: str, part: str) -> DataFrame:
    """Share of each ``part`` among the rows of its category."""
    counts = df.where(all_present([category, part])).groupBy(category, part).agg(F.count(F.lit(1)).alias("n"))
    totals = df.where(all_present([category])).groupBy(category).agg(F.count(F.lit(1)).alias("total"))
    return counts.join(totals, category).select(category, part, "n", rate(F.col("n"), F.col("total")).alias("part"))


def distinct_values(df: DataFrame, column: str, order: Sequence[str] | None = None) -> DataFrame:
    """Distinct values in ascending order, or only those of an ordered list, in its order."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    if order is None:
        return values.orderBy(column)
    listed = F.array(*[F.lit(v) for v in order])
    return values.where(F.col(column).isin(*order)).orderBy(F.array_position(listed, F.col(column)))


def top_groups(df: DataFrame, key: str, measure: Column, n: int, name: str = "valeur") -> DataFrame:
    """The ``n`` groups with the largest measure, ties by key."""
    return df.groupBy(key).agg(measure.alias(name)).orderBy(F.desc(name), F.asc(key)).limit(n)


def group_summary(df: DataFrame, keys: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """Group aggregates without the groups whose key is missing."""
    return df.where(all_present(keys)).groupBy(*keys).agg(*measures)
