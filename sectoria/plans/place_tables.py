"""Raw code lists to clean place tables and the search table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    COUNTRY_NAMES,
    OVERSEAS_PLACES,
    drop_parentheses,
    fold_accents,
    pad_code,
    parenthesised_year,
    strip_decimal_suffix,
)
from ..operators.cleaning import arranged, with_overrides
from ..operators.places import all_places, latest_of_changes, merge_place_lists, search_table
from ..operators.positions import with_position
from ..session import small_table

# The three agglomerations that the yearly list names without district.
AGGLOMERATIONS = [
    ("75056", 48.86, 2.35, "11", "ILE-DE-FRANCE", "PARIS"),
    ("69123", 45.75, 4.85, "84", "AUVERGNE-RHONE-ALPES", "RHONE"),
    ("13055", 43.3, 5.4, "93", "PROVENCE-ALPES-COTE D'AZUR", "BOUCHES-DU-RHONE"),
]
AGGLOMERATION_SCHEMA = (
    "num_insee string, latitude double, longitude double, code_region string, nom_region string, nom_departement string"
)

# Place of New Caledonia, used for all its communes.
OVERSEAS = {
    "latitude": -21.123889,
    "longitude": 165.846901,
    "code_departement": "988",
    "nom_departement": "NOUVELLE-CALEDONIE",
    "code_region": "98",
    "nom_region": "NOUVELLE-CALEDONIE",
}

MAIN_COLUMNS = [
    "num_insee",
    "nom_commune_postal",
    "code_postal",
    "latitude",
    "longitude",
    "code_commune",
    "code_departement",
    "nom_departement",
    "code_region",
    "nom_region",
]


def main_places(raw: DataFrame) -> DataFrame:
    """Postal list: padded codes, plain letters, no duplicates."""
    widths = {"num_insee": 5, "code_postal": 5, "code_commune": 3, "code_departement": 3, "code_region": 2}
    places = arranged(raw, {"code_commune_INSEE": "num_insee"}, MAIN_COLUMNS)
    for column in ("code_commune", "code_region"):
        places = places.withColumn(column, strip_decimal_suffix(F.col(column)))
    for column, width in widths.items():
        places = places.withColumn(column, pad_code(F.col(column), width))
    for column in ("nom_region", "nom_departement"):
        places = places.withColumn(column, fold_accents(F.col(column)))
    return places.dropDuplicates()


def yearly_places(raw: DataFrame) -> DataFrame:
    """Yearly list: renamed, padded, coordinates only for the agglomerations (0 elsewhere)."""
    names = {
        "com": "num_insee",
        "typecom": "typecommune",
        "reg": "code_region",
        "dep": "code_departement",
        "arr": "num_arrondissement",
        "ncc": "nom_commune",
        "nccenr": "nom_commune_officiel",
        "can": "code_arr_national",
    }
    places = (
        arranged(raw.select(*names), names)
        .withColumn("code_departement", pad_code(F.col("code_departement"), 3))
        .withColumn("code_commune", F.col("num_insee").substr(3, 10))
        .withColumn("latitude", F.lit(0.0))
        .withColumn("longitude", F.lit(0.0))
    )
    overrides = small_table(raw.sparkSession, AGGLOMERATIONS, AGGLOMERATION_SCHEMA)
    return with_overrides(places, "num_insee", overrides).dropDuplicates()


def code_changes(raw: DataFrame) -> DataFrame:
    """Change list: lower-case names, dates and row numbers."""
    names = {
        "MOD": "type_event_commune",
        "TNCC_AVANT": "type_nom_en_clair_avant",
        "NCC_AVANT": "nom_commune_en_clair_avant",
        "NCCENR_AVANT": "nom_commune_riche_en_clair_avant",
        "TNCC_APRES": "type_nom_en_clair_apres",
        "NCC_APRES": "nom_commune_en_clair_apres",
        "NCCENR_APRES": "nom_commune_riche_en_clair_apres",
        "ID_COMMUNE_AVANT": "num_insee_avant",
        "ID_COMMUNE_APRES": "num_insee_apres",
    }
    changes = arranged(raw, names, lower=True).withColumn("date_eff", F.col("date_eff").cast("date")).dropDuplicates()
    numbered = with_position(changes, ["date_eff", "num_insee_avant", "num_insee_apres"], name="idligne")
    return numbered.withColumn("idligne", F.col("idligne") - 1)


def overseas_places(rows: DataFrame) -> DataFrame:
    """Commune, code and population texts to the overseas place table."""
    places = (
        rows.withColumn("annee", parenthesised_year(F.col("population")))
        .withColumn("population", drop_parentheses(F.col("population")))
        .withColumn("commune", fold_accents(F.col("commune"), OVERSEAS_PLACES))
        .withColumn("commune_valide", F.upper("commune"))
    )
    for column, value in OVERSEAS.items():
        places = places.withColumn(column, F.lit(value))
    columns = ["num_insee", "commune", "population", "annee", "commune_valide", *OVERSEAS]
    return places.select(*columns).dropDuplicates()


def countries(codes: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Country codes joined with their coordinates on the two-letter code."""
    french = F.upper(fold_accents(F.trim("LIBCOG"), COUNTRY_NAMES))
    # Two-letter codes that the source lists lack or misread.
    fixes = F.when(french == "NAMIBIE", "NA").when(french == "KOSOVO", "XK").otherwise(F.col("CODEISO2"))
    listed = codes.select(
        F.col("COG").cast("string").alias("num_insee"), fixes.alias("codeiso_2"), french.alias("nom_pays_fr")
    ).where(F.col("codeiso_2").isNotNull())
    english = F.upper(F.trim("name"))
    placed = coordinates.select(
        F.when(english == "NAMIBIA", "NA").otherwise(F.col("country")).alias("codeiso_2"),
        "latitude",
        "longitude",
        F.trim("name").alias("name"),
        english.alias("nom_pays_en"),
    )
    return listed.join(placed, "codeiso_2").select(
        "num_insee", "codeiso_2", "nom_pays_fr", "latitude", "longitude", "name", "nom_pays_en"
    )


def searchable_codes(
    main: DataFrame, yearly: DataFrame, changes: DataFrame, overseas: DataFrame, country_table: DataFrame
) -> DataFrame:
    """All codes, current and obsolete, with their valid place."""
    places = all_places(merge_place_lists(main, yearly), overseas, country_table)
    return search_table(places, latest_of_changes(changes))
