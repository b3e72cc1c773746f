"""From yearly death lines to located persons and yearly place profiles, all years in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import all_present
from ..functions.classes import AGE_CLASSES_7, age_class, national_flag
from ..functions.dates import age_in_years
from ..functions.numeric import haversine_km, round_even
from ..operators.cleaning import (
    PERSON_CONTRACT,
    dated_rows,
    located_only,
    rejected_rows,
    repaired_places,
    valid_rows,
    with_contract,
    with_yearly_ids,
)
from ..operators.places import analysis_view, locate_persons
from ..operators.profiles import commune_year_profile
from ..session import cut_lineage
from ..sources.files import parse_death_lines

# Columns of the person table, in the order of its source.
PERSON_COLUMNS = [
    "idligne",
    "nom",
    "prenom",
    "sex",
    "date_naissance_dt",
    "num_insee_naissance",
    "ville_naissance",
    "pays_naissance",
    "date_deces_dt",
    "num_insee_deces",
    "ville_deces",
    "age",
    "annee",
    "pays_deces",
]


def checked_records(lines: DataFrame, year: str = "annee") -> DataFrame:
    """Parsed records with the list of contract failures; ``lines`` has ``value`` and the year of its file."""
    return with_contract(parse_death_lines(lines, keep=(year,)), PERSON_CONTRACT)


def death_people(lines: DataFrame, year: str = "annee") -> DataFrame:
    """Clean person table of all years: valid rows, date gates per year, repairs, ages and ids.

    The valid records are stored, so the text is parsed once and the gates read only the date columns.
    """
    return people_of(cut_lineage(valid_rows(parse_death_lines(lines, keep=(year,)), PERSON_CONTRACT)), year)


def refresh(lines: DataFrame, year: str = "annee") -> tuple[DataFrame, DataFrame]:
    """Clean person table and the rejected records with their failures (``erreurs``), both from one stored parse."""
    records = cut_lineage(checked_records(lines, year))
    return people_of(records.where(F.size("erreurs") == 0).drop("erreurs"), year), rejected_rows(records)


def people_of(records: DataFrame, year: str = "annee") -> DataFrame:
    """Persons from valid records, which should be stored: date gates per year, no duplicates, repairs, ages and ids.

    Duplicates are records with the same text. They are dropped where the ids are given, in the one exchange of the records;
    so that a repair makes no two records equal, the places that it replaced go along till there.
    """
    place = ["num_insee_naissance", "pays_naissance"]
    read = dated_rows(records, F.col(year), by=[year]).withColumn("_lu", F.struct(*place))
    repaired = repaired_places(read)
    replaced = ~F.col("_lu").eqNullSafe(F.struct(*place))
    dated = repaired.withColumn("_lu", F.when(replaced, F.col("_lu")))
    aged = dated.withColumn("age", age_in_years(F.col("date_naissance_dt"), F.col("date_deces_dt")))
    order = ["date_deces_dt", "nom", "prenom", "date_naissance_dt", "num_insee_naissance", "num_insee_deces"]
    texts = [c for c in aged.columns if c not in (*PERSON_COLUMNS, year)]
    numbered = with_yearly_ids(aged, year, [*order, "sex", "ville_naissance", "pays_naissance"], once=texts)
    return (
        numbered.withColumn("pays_deces", F.lit("FRANCE"))
        .withColumn("ville_deces", F.lit(""))
        .withColumnRenamed(year, "annee")
        .select(*PERSON_COLUMNS)
    )


def with_distance(df: DataFrame) -> DataFrame:
    """Birth-to-death distance in whole kilometres."""
    km = haversine_km(
        F.col("latitude_naissance"), F.col("longitude_naissance"), F.col("latitude_deces"), F.col("longitude_deces")
    )
    return df.withColumn("distance", round_even(km))


def yearly_profiles(people: DataFrame, search: DataFrame) -> DataFrame:
    """Yearly profile of every death place."""
    view = analysis_view(locate_persons(people, search))
    usable = located_only(view).where(all_present(["nom_departement_deces"]))
    return commune_year_profile(with_distance(usable))


def dashboard_persons(view: DataFrame) -> DataFrame:
    """Persons as the dashboard uses them: relaxed place filter, national flag, distance and age class."""
    usable = located_only(view, strict=False).where(all_present(["nom_departement_deces"]))
    return (
        with_distance(usable)
        .withColumn("origine_nationale", national_flag(F.col("pays_naissance")))
        .withColumn("classe_age", age_class(F.col("age"), AGE_CLASSES_7))
        .withColumn("pays_deces", F.lit("FRANCE"))
    )
