"""Lookups of values in tables of distinct values and in tables of ranges, without a crowded task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .positions import with_running_total

# A value that more than one in so many rows holds is sent to every task; there are fewer than so many of them.
FREQUENT = 1000
_SPREAD = 1 << 16


def look_up(rows: DataFrame, key: Column, values: DataFrame, found: Sequence[str], rare: bool = True) -> DataFrame:
    """``rows`` with the columns ``found`` of the row of ``values`` whose ``value`` is the key; null if there is none.

    ``values`` has each value once and tells by ``frequent`` which go to every task (fewer than FREQUENT, or all of a small
    table). The others are joined; rows whose value was found, or is null, are spread over all tasks there. With ``rare`` false
    there are no others, which the caller has counted, and no row is moved.
    """
    payload = F.struct(*found)
    frequent = values.where("frequent").select(F.col("value").alias("_value"), payload.alias("_frequent"))
    met = rows.withColumn("_looked", key)
    met = met.join(F.broadcast(frequent), F.col("_looked") == F.col("_value"), "left")
    if not rare:
        return met.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col("_frequent")[c].alias(c) for c in found])
    # Always 0 here, but not a literal: the optimizer would take an equality with a literal out of the keys of the join,
    # and all rows without a rare value would meet in one task.
    others = values.where("NOT frequent").select(
        F.col("value").alias("_key"), payload.alias("_rare"), F.col("frequent").cast("long").alias("_zero")
    )
    asked = F.when(F.col("_frequent").isNull(), F.col("_looked"))
    spread = F.when(asked.isNull(), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(_SPREAD)) + 1)
    met = met.withColumns({"_asked": asked, "_spread": F.coalesce(spread, F.lit(0))}).join(
        others, (F.col("_asked") == F.col("_key")) & (F.col("_spread") == F.col("_zero")), "left"
    )
    value = F.coalesce("_frequent", "_rare")
    return met.select(*[F.col(f"`{c}`") for c in rows.columns], *[value[c].alias(c) for c in found])


def _range_nodes(classes: DataFrame) -> DataFrame:
    """The segments ``first`` to ``last`` of every class as a few aligned blocks of 2^level segments."""
    stop = F.col("last") + 1
    levels = F.sequence(F.lit(0), F.floor(F.log2((stop - F.col("first")).cast("double"))).cast("int") + 1)
    each = classes.withColumn("level", F.explode(levels)).withColumns(
        {
            "low": F.expr("shiftright(first + shiftleft(1L, level) - 1, level)"),
            "high": F.expr("shiftright(last + 1, level)"),
        }
    )
    open_ = F.col("low") < F.col("high")
    ends = F.array_compact(
        F.array(
            F.when(open_ & (F.col("low") % 2 == 1), F.col("low")),
            F.when(open_ & (F.col("high") % 2 == 1), F.col("high") - 1),
        )
    )
    return each.select("level", F.explode(ends).alias("node"), "winner")


def class_of_values(values: DataFrame, classes: DataFrame) -> DataFrame:
    """Class of every distinct ``value`` whose range ``]low, high]`` holds it; the largest (class, low, high) wins.

    ``values`` keeps its other columns; values in no range are left out. The bounds of all ranges cut the line into disjoint
    segments; bounds and values together are put in one order, which gives every value its segment. A range is a few aligned
    blocks of segments, a segment lies in one block of every size, so both meet by equality however ranges overlap.
    """
    ranges = classes.select(
        F.col("la_borne"), F.col("borne_inf_strict").cast("double").alias("low"), F.col("borne_sup_egale").cast("double").alias("high")
    ).where("low < high")
    bounds = ranges.select(F.explode(F.array("low", "high")).alias("value")).distinct()
    # A value equal to a bound stands before it: it belongs to the segment that ends there.
    marked = values.select(F.col("value").alias("value"), F.lit(0).alias("bound"))
    placed = with_running_total(marked.unionByName(bounds.withColumn("bound", F.lit(1))), ["value", "bound"], ["bound"])
    segments = placed.select("value", "bound", F.col("before_bound").cast("long").alias("segment"))
    of_bounds = segments.where("bound = 1").select(F.col("value"), "segment")
    covered = (
        ranges.join(of_bounds.withColumnsRenamed({"value": "low", "segment": "first"}), "low")
        .join(of_bounds.withColumnsRenamed({"value": "high", "segment": "last"}), "high")
        .select((F.col("first") + 1).alias("first"), "last", F.struct("la_borne", "low", "high").alias("winner"))
    )
    blocks = _range_nodes(covered).groupBy("level", "node").agg(F.max("winner").alias("winner"))
    asked = segments.where("bound = 0").select("value", "segment")
    last = of_bounds.agg(F.max("segment")).scalar()
    levels = F.sequence(F.lit(0), F.ceil(F.log2(F.coalesce(last, F.lit(0)) + 2.0)).cast("int"))
    above = asked.select("segment").distinct().select("segment", F.explode(levels).alias("level"))
    winners = (
        above.withColumn("node", F.expr("shiftright(segment, level)"))
        .join(blocks, ["level", "node"])
        .groupBy("segment")
        .agg(F.max("winner")["la_borne"].alias("classe"))
    )
    return values.join(asked.join(winners, "segment").select("value", "classe"), "value")
