"""Row conditions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_present(columns: Iterable[str]) -> Column:
    """Every column has a value; written as single null checks, which reach the scan (``dropna`` does not)."""
    condition = F.lit(True)
    for column in columns:
        condition = condition & F.col(f"`{column}`").isNotNull()
    return condition
