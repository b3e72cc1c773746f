"""Global row numbers and running totals without a single-task window.

The rows are range-partitioned, sorted, and stamped with the number of their
slice (partition) and their place in it. The stamped rows are stored, so every
later pass sees the same slices. Only the totals per slice, one row each, are
brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_STAMP, _SLICE, _OFFSET, _FIRST = "_stamp", "_slice", "_offset", "_first"
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def _as_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _sorted_slices(df: DataFrame, order: Sequence[str | Column], once: Sequence[str] | None = None) -> DataFrame:
    columns = _as_columns(order)
    ranged = df.repartitionByRange(*columns)
    if once is not None:
        # Equal rows are in one slice already: they are dropped there, without a second exchange.
        ranged = ranged.dropDuplicates().drop(*once)
    ordered = (
        ranged.sortWithinPartitions(*columns)
        .withColumn(_STAMP, F.monotonically_increasing_id())
        .withColumn(_SLICE, F.shiftright(_STAMP, _ROW_BITS).cast("int"))
    )
    return cut_lineage(ordered)


def _slice_offsets(slices: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Totals of all earlier slices; as many rows as there are slices."""
    totals = slices.groupBy(_SLICE).agg(*[m.alias(name) for name, m in measures.items()])
    earlier = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(_SLICE, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in measures])


def with_position(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "position",
    by: Sequence[str] = (),
    once: Sequence[str] | None = None,
) -> DataFrame:
    """Number the rows from 1 in ``order``; with ``by``, from 1 inside each group.

    With ``once``, rows that are equal in all columns are kept and numbered once; the columns it names only serve to tell
    rows apart and are left out. ``order`` and ``by`` must then be names of columns.

    A group may be of any size: groups are neighbouring ranges of the same
    global order. List enough columns to tell the rows apart: rows equal on
    all of them are numbered in an arbitrary order and stay in one slice.
    """
    slices = _sorted_slices(df, [*by, *order], once)
    if by:
        parts = _group_parts(slices, by, {_OFFSET: F.count(F.lit(1))})
        return (
            join_on(slices, parts, [_SLICE, *by])
            .withColumn(name, F.col(_STAMP) - F.col(_FIRST) + F.col(_OFFSET) + 1)
            .drop(_STAMP, _SLICE, _OFFSET, _FIRST, *_names(_OFFSET))
        )
    offsets = _slice_offsets(slices, {_OFFSET: F.count(F.lit(1))})
    local = F.col(_STAMP) - F.shiftleft(F.col(_SLICE).cast("bigint"), _ROW_BITS)
    return (
        slices.join(F.broadcast(offsets), _SLICE)
        .withColumn(name, F.col(_OFFSET) + local + 1)
        .drop(_STAMP, _SLICE, _OFFSET)
    )


def with_running_total(
    df: DataFrame,
    order: Sequence[str | Column],
    weights: Sequence[str],
    by: Sequence[str] = (),
    totals: bool = False,
) -> DataFrame:
    """Add ``before_<weight>``: the sum of the weight over all earlier rows (of the group, with ``by``).

    ``totals=True`` also adds ``total_<weight>``. Rows should be
    pre-aggregated so that ``by + order`` is unique.
    """
    slices = _sorted_slices(df, [*by, *order])
    inside = Window.partitionBy(_SLICE).orderBy(_STAMP).rowsBetween(Window.unboundedPreceding, -1)
    running = slices.withColumns({f"before_{w}": F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights})
    if by:
        parts = _group_parts(slices, by, {f"_{w}": F.sum(w) for w in weights})
        result = join_on(running, parts, [_SLICE, *by])
        for w in weights:
            # In the slice, since the group began there; and in the slices before.
            before = F.col(f"before_{w}") - F.col(f"_{w}_start") + F.col(f"_{w}")
            result = result.withColumn(f"before_{w}", before)
            if totals:
                result = result.withColumn(f"total_{w}", F.col(f"_{w}_total"))
        return result.drop(_STAMP, _SLICE, _FIRST, *[c for w in weights for c in (f"_{w}", *_names(f"_{w}"))])
    offsets = _slice_offsets(slices, {f"_{w}": F.sum(w) for w in weights})
    result = running.join(F.broadcast(offsets), _SLICE)
    result = result.withColumns({f"before_{w}": F.col(f"before_{w}") + F.col(f"_{w}") for w in weights}).drop(
        _STAMP, _SLICE, *[f"_{w}" for w in weights]
    )
    for weight in weights if totals else ():
        result = result.withColumn(f"total_{weight}", slices.agg(F.sum(weight)).scalar())
    return result


def _names(measure: str) -> tuple[str, str]:
    return f"{measure}_start", f"{measure}_total"


def _group_parts(slices: DataFrame, by: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """For every group in every slice: its first stamp there, and of each measure the sum over the group's earlier slices,
    over the groups before it in the slice (``_start``) and over the whole group (``_total``).

    A slice holds whole neighbouring groups and parts of two, so there are at most as many rows as slices and groups
    together; rows find theirs by slice and group, which no large group can crowd. They are stored: taken for as large as the
    rows they were counted from, few of them would make all rows move to meet them.
    """
    parts = slices.groupBy(_SLICE, *by).agg(
        F.min(_STAMP).alias(_FIRST), *[m.alias(f"{n}_part") for n, m in measures.items()]
    )
    group = Window.partitionBy(*by)
    earlier = group.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(_SLICE).orderBy(_FIRST).rowsBetween(Window.unboundedPreceding, -1)
    columns = []
    for name in measures:
        own = F.sum(f"{name}_part")
        columns += [
            F.coalesce(own.over(earlier), F.lit(0)).alias(name),
            F.coalesce(own.over(ahead), F.lit(0)).alias(f"{name}_start"),
            own.over(group).alias(f"{name}_total"),
        ]
    return cut_lineage(parts.select(_SLICE, *by, _FIRST, *columns))


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Equi join in which a null key matches a null key."""
    renamed = right.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    return left.join(renamed, condition).drop(*[f"_key_{k}" for k in keys])
