"""Dashboard results for a selection of persons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import imd, log_distance
from ..operators.profiles import statistic_cells, statistics_of_cells
from ..operators.scores import log_moments, pages, sector_scores


def sector_pages(
    df: DataFrame,
    level: str,
    by_age: bool = False,
    max_pages: int | None = None,
    baseline: DataFrame | None = None,
) -> DataFrame:
    """Scores of a level in pages of ranked sectors; ``baseline`` as in :func:`sector_scores`."""
    return pages(sector_scores(df, level, baseline, by_age), max_pages=max_pages)


def with_sector_imd(df: DataFrame, flag: str, by: list[str]) -> DataFrame:
    """Statistics of each group with its mobility index against all of ``df``, from one count of the persons."""
    cells = statistic_cells(df, flag, by)
    moments = cells.agg(*log_moments(F.col("n"))).select(F.struct("moy_distance", "std_distance").alias("m")).scalar()
    return (
        statistics_of_cells(cells, flag, by)
        .withColumn("_m", moments)
        .withColumn("ind_IMD", imd(F.col("_m.moy_distance"), F.col("_m.std_distance"), F.col("log_distance_moy"), 2))
        .drop("_m")
    )


def with_person_imd(df: DataFrame, baseline: DataFrame) -> DataFrame:
    """Mobility index of each person."""
    moments = baseline.select(F.struct("moy_distance", "std_distance").alias("m")).scalar()
    return (
        df.withColumn("_m", moments)
        .withColumn(
            "IMD", imd(F.col("_m.moy_distance"), F.col("_m.std_distance"), log_distance(F.col("distance")), 2)
        )
        .drop("_m")
    )
