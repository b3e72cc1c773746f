"""Animal-behaviour observations: cleaning and the summary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import all_present
from ..functions.classes import harmonise
from ..functions.numeric import round_even
from ..functions.text import clock_hour, clock_label
from ..operators.cleaning import arranged, to_number

# Spellings brought together, and texts that mark an unusable row.
BEHAVIOURS = {"Sociabilization": "Sociabilisation"}
BOATS = {"Tourism": "Tourisme", "Crevetier": "Crevettier"}
BAD_BOATS = ["Crevettier + Tourisme", "None", "Aucun"]
BAD_NUMBERS = ["NONE"]
NEW_NAMES = {"Vitesse de nage Km/h": "Vitesse de nage (m/s)", "Distance": "Distance (m)"}


def clean_observations(raw: DataFrame) -> DataFrame:
    """Numbers read, columns renamed, times labelled, spellings harmonised, unusable rows removed."""
    boat = "Categorie Type Bateau"
    rows = arranged(to_number(raw, "Indice de Linearite", BAD_NUMBERS), NEW_NAMES)
    rows = (
        rows.withColumn("Instant_h_m", clock_label(F.col("Instant")))
        .withColumn("Instant_h", clock_hour(F.col("Instant")))
        .withColumn("Comportement", harmonise(F.col("Comportement"), BEHAVIOURS))
        .withColumn(boat, harmonise(F.col(boat), BOATS))
    )
    return rows.where(F.col(boat).isNull() | ~F.col(boat).isin(*BAD_BOATS))


def groups_per_day(rows: DataFrame, size: str = "Nombre d'individus") -> DataFrame:
    """Groups, individuals and mean group size of each day."""
    return rows.where(all_present(["Jour"])).groupBy("Jour").agg(
        F.sum(f"`{size}`").alias("individus"),
        F.count(f"`{size}`").alias("groupes"),
        round_even(F.try_divide(F.sum(f"`{size}`"), F.count(f"`{size}`"))).alias("individus_par_groupe"),
    )
