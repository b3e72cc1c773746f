"""Measurement series: sensors, coverage, longest runs and city selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conditions import all_present
from ..functions.dates import season
from ..functions.numeric import round_even
from ..functions.text import dms_to_degrees
from ..session import cut_lineage
from .lookups import FREQUENT, class_of_values, look_up

CITY = ["CITY", "CN_NAME", "CN", "CAPITALE"]

# Studied countries and their names, and the capitals among the studied cities.
COUNTRY_NAMES = {
    "FR": "France",
    "GB": "Royaume-Uni",
    "IT": "Italie",
    "LV": "Lettonie",
    "EE": "Estonie",
    "LT": "Lituanie",
    "NL": "Pays-Bas",
    "HU": "Hongrie",
    "SE": "Suede",
    "NO": "Norvege",
    "RO": "Roumanie",
    "PL": "Pologne",
    "ES": "Espagne",
    "AT": "Autriche",
    "DE": "Allemagne",
    "TR": "Turquie",
}
CAPITALS = [
    "PARIS",
    "LONDON",
    "RIGA",
    "TALLINN",
    "VILNIUS",
    "AMSTERDAM",
    "BUDAPEST",
    "STOCKHOLM",
    "OSLO",
    "WARSZAWA",
    "MADRID",
    "WIEN",
    "BERLIN",
]


def with_date_parts(df: DataFrame, date: str = "DATE", tenths: str = "TX") -> DataFrame:
    """Date, year, month and day texts, season and temperature of raw weather rows."""
    text = F.col(date).cast("string")
    month = F.substring(text, 5, 2)
    return (
        df.withColumn("DATE_dt", F.to_date(text, "yyyyMMdd"))
        .withColumn("DATE_str_YEAR", F.substring(text, 1, 4))
        .withColumn("DATE_str_MONTH", month)
        .withColumn("DATE_str_DAY", F.substring(text, 7, 2))
        .withColumn("TEMPERATURE", F.col(tenths) * 0.1)
        .withColumn("Saison", season(month))
    )


def with_lookup(df: DataFrame, key: str, values: Mapping[str, str], name: str, default: str) -> DataFrame:
    """Value of a small fixed table by key, ``default`` for other keys."""
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return df.withColumn(name, F.coalesce(F.create_map(*pairs)[F.col(key)], F.lit(default)))


def with_city_details(df: DataFrame) -> DataFrame:
    """Decimal degrees, country name and capital flag."""
    df = df.withColumn("LAT_degre", dms_to_degrees(F.col("LAT"))).withColumn("LON_degre", dms_to_degrees(F.col("LON")))
    df = with_lookup(df, "CN", COUNTRY_NAMES, "CN_NAME", "inconnu")
    return with_lookup(df, "CITY", {c: "O" for c in CAPITALS}, "CAPITALE", "N")


def city_days(df: DataFrame, city: Sequence[str] = CITY, day: Sequence[str] = ("DATE_dt",)) -> DataFrame:
    """Collapse the sensors: place means over all rows of a city, measure means over a city-day.

    The city table is built from sums per city-day, so the measurements are
    shuffled once; rows without a key are left out. A city's days stay spread
    over the tasks.
    """
    place = ["LAT_degre", "LON_degre", "HGHT_num"]
    keys = [*city, *day]
    daily = (
        df.where(all_present(keys))
        .groupBy(*keys)
        .agg(
            *[F.sum(c).alias(f"_s_{c}") for c in place],
            *[F.count(c).alias(f"_n_{c}") for c in place],
            F.avg("TEMPERATURE").alias("TEMPERATURE"),
            F.avg("NB_HAB").alias("NB_HAB"),
        )
    )
    means = daily.groupBy(*city).agg(
        *[round_even(F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_n_{c}")), 9).alias(c) for c in place]
    )
    return daily.select(*keys, "TEMPERATURE", "NB_HAB").join(means, list(city))


def without_population_gaps(days: DataFrame, key: Sequence[str] = ("CITY", "CN", "CN_NAME"), population: str = "NB_HAB") -> DataFrame:
    """Drop every city that has a day without population; round the degrees to 5."""
    gaps = days.where(F.col(population).isNull()).select(*key).distinct()
    kept = days.join(gaps, list(key), "left_anti")
    return kept.withColumn("LAT_degre", round_even(F.col("LAT_degre"), 5)).withColumn(
        "LON_degre", round_even(F.col("LON_degre"), 5)
    )


def yearly_coverage(df: DataFrame) -> DataFrame:
    """Rows, months, cities and countries of each year.

    Rows are first counted per year, month and city, so the distinct counts
    run on that small table.
    """
    cells = df.groupBy("DATE_str_YEAR", "DATE_str_MONTH", "CITY", "CN").agg(F.count("DATE_dt").alias("n"))
    return (
        cells.where(F.col("DATE_str_YEAR").isNotNull())
        .groupBy(F.col("DATE_str_YEAR").alias("Annee"))
        .agg(
            F.sum("n").alias("nb_enreg"),
            F.count_distinct("DATE_str_MONTH").alias("nb_Mois"),
            F.count_distinct("CITY").alias("nb_City"),
            F.count_distinct("CN").alias("nb_CN"),
        )
    )


def longest_run(periods: DataFrame, label: str, measure: str) -> DataFrame:
    """First and last label of the longest unbroken run with ``measure`` at or above its median.

    The input has one row per period (a year or month), so one ordered window
    over it is small. The earliest run wins a tie.
    """
    median = periods.agg(F.percentile(measure, 0.5)).scalar()
    ordered = Window.orderBy(label)
    numbered = periods.select(
        F.col(label).alias("label"),
        (F.col(measure) >= median).alias("above"),
        F.row_number().over(ordered).alias("position"),
    ).where("above")
    islands = numbered.withColumn("island", F.col("position") - F.row_number().over(Window.orderBy("position")))
    runs = islands.groupBy("island").agg(
        F.min("label").alias("debut"), F.max("label").alias("fin"), F.count(F.lit(1)).alias("longueur")
    )
    best = F.min_by(F.struct("debut", "fin", "longueur"), F.struct((-F.col("longueur")).alias("l"), "debut")).alias("r")
    return runs.agg(best).select(F.lit(measure).alias("variable"), "r.debut", "r.fin", "r.longueur")


def city_year_coverage(df: DataFrame, lower: str, upper: str, city: Sequence[str] = CITY) -> DataFrame:
    """Per city: first and last year, years with all 12 months, and months and rows of those years."""
    window = df.where(F.col("DATE_str_YEAR").between(lower, upper)).where(all_present(city))
    years = (
        window.groupBy(*city, "DATE_str_YEAR", "DATE_str_MONTH")
        .agg(F.count("DATE_dt").alias("n"))
        .groupBy(*city, "DATE_str_YEAR")
        .agg(F.count("DATE_str_MONTH").alias("nb_mois"), F.sum("n").alias("nb_enreg"))
    )
    whole = F.col("nb_mois") == 12
    return (
        years.groupBy(*city)
        .agg(
            F.min("DATE_str_YEAR").alias("Annee_min"),
            F.max("DATE_str_YEAR").alias("Annee_max"),
            F.count_if(whole).alias("nb_annee"),
            F.sum(F.when(whole, F.col("nb_mois"))).alias("nb_mois"),
            F.sum(F.when(whole, F.col("nb_enreg"))).alias("nb_enreg"),
        )
        .where(F.col("nb_annee") > 0)
    )


def select_cities(coverage: DataFrame, lower: str, upper: str, years: int = 10, months: int = 120) -> DataFrame:
    return coverage.where(
        (F.col("Annee_min") == lower)
        & (F.col("Annee_max") == upper)
        & (F.col("nb_annee") >= years)
        & (F.col("nb_mois") >= months)
    )


def rows_of_cities(df: DataFrame, selected: DataFrame, lower: str, upper: str, key: Sequence[str] = ("CITY", "CN")) -> DataFrame:
    """Rows of the selected cities (by city and country) inside the years."""
    return df.where(F.col("DATE_str_YEAR").between(lower, upper)).join(
        selected.select(*key).distinct(), list(key), "left_semi"
    )


def class_from_table(df: DataFrame, value: str, classes: DataFrame, name: str = "classe") -> DataFrame:
    """Class whose range ``]low, high]`` holds the value, 0 if none.

    The class table (``borne_inf_strict``, ``borne_sup_egale``, ``la_borne``) may hold any number of ranges; of overlapping
    ones the last class wins. Distinct values are looked up, then brought back to the rows. Empty ranges, and those without a
    bound, hold nothing.
    """
    number = F.col(value).cast("double")
    counted = df.where(number.isNotNull()).groupBy(number.alias("value")).agg(F.count(F.lit(1)).alias("_t"))
    counted = cut_lineage(counted)
    total = F.coalesce(counted.agg(F.sum("_t")).scalar(), F.lit(0))
    found = class_of_values(counted, classes).withColumn("frequent", F.col("_t") * FREQUENT > total)
    found = found.select("value", F.col("classe").alias("_classe"), "frequent")
    looked = look_up(df, number, found, ["_classe"])
    return looked.withColumn(name, F.coalesce("_classe", F.lit(0))).drop("_classe")
