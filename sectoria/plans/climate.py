"""Weather files to city-days, selected cities, classes and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import all_present
from ..operators.association import chi_squares
from ..operators.coverage import (
    city_days,
    city_year_coverage,
    longest_run,
    rows_of_cities,
    select_cities,
    with_city_details,
    with_date_parts,
    without_population_gaps,
    yearly_coverage,
)
from ..operators.quantiles import with_quantile_classes
from ..session import cut_lineage

UNUSED = ["PARNAME", "TX", "DATE", "Q_TX", "TIME", "STAID_num", "SOUID", "NB_HAB_BRUT"]

# Number of quantile classes of each measure.
CLASSES = {"NB_HAB": 3, "LAT_degre": 3, "LON_degre": 3, "TEMPERATURE": 2, "HGHT_num": 4}


def city_measurements(raw: DataFrame) -> DataFrame:
    """One row per city and day, cities without population left out."""
    detailed = with_city_details(with_date_parts(raw)).drop(*UNUSED)
    day = ["Saison", "DATE_dt", "DATE_str_YEAR", "DATE_str_MONTH", "DATE_str_DAY"]
    return without_population_gaps(city_days(detailed, day=day))


def coverage_runs(days: DataFrame) -> DataFrame:
    """Longest run of well-covered years by rows, cities and countries; the rows are read once, for the years."""
    years = cut_lineage(yearly_coverage(days))
    runs = [longest_run(years, "Annee", c) for c in ("nb_enreg", "nb_City", "nb_CN")]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


def selected_measurements(days: DataFrame, lower: str, upper: str, years: int = 10, months: int = 120) -> DataFrame:
    chosen = select_cities(city_year_coverage(days, lower, upper), lower, upper, years, months)
    return rows_of_cities(days, chosen, lower, upper)


def city_classes(days: DataFrame) -> DataFrame:
    """One row per city with the quantile class of each measure; stored, since every test reads it."""
    keys = ["CITY", "CN", "CN_NAME", "CAPITALE", "LAT_degre", "LON_degre", "HGHT_num"]
    cities = (
        days.where(all_present(keys))
        .groupBy(*keys)
        .agg(F.avg("TEMPERATURE").alias("TEMPERATURE"), F.avg("NB_HAB").alias("NB_HAB"))
    )
    labels = {c: "classe_HAB" if c == "NB_HAB" else f"classe_{c}" for c in CLASSES}
    return cut_lineage(with_quantile_classes(cut_lineage(cities), CLASSES, labels))


def population_tests(cities: DataFrame) -> DataFrame:
    """Independence of the population class and the temperature, latitude and longitude classes."""
    measures = ("classe_TEMPERATURE", "classe_LAT_degre", "classe_LON_degre")
    tests = chi_squares(cities, [(column, "classe_HAB") for column in measures])
    return tests.withColumnRenamed("variable_x", "variable").drop("variable_y")
