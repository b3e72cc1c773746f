"""Profiles and statistics of places: yearly profile, dominant profile, sector statistics, map and treemap tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conditions import all_present
from ..functions.classes import AGE_CLASSES_4, age_class, mobility_class
from ..functions.dates import MONTHS
from ..functions.numeric import log_distance, rate, round_even

CUBE_KEYS = [
    "nom_region_deces",
    "nom_departement_deces",
    "ville_deces",
    "code_region_deces",
    "code_departement_deces",
    "age",
    "sex",
    "classe_age",
    "origine_nationale",
    "origine_region",
    "origine_departement",
    "origine_ville",
    "month_deces",
]

# Column suffix of each of the four age classes.
CLASS_SUFFIXES = {"0-30": "0_30", "30-60": "30_60", "60-90": "60_90", "90+": "plus_90"}


def most_frequent(value: Column, count: Column, where: Column) -> Column:
    """Aggregate over counted values: the most frequent one, the smallest on ties."""
    counted = F.when(where & value.isNotNull(), F.struct((-count).alias("n"), value.alias("v")))
    return F.min_by(value, counted)


def commune_year_profile(df: DataFrame, keys: Sequence[str] = ("annee", "num_insee_deces")) -> DataFrame:
    """One row per year and death code: counts, distances, age classes, months and top first names.

    Rows are first counted per first name, so the second grouping neither
    holds a list of names nor sees more than one row per name, however large
    the place is. Rows without a key are left out; missing counts are 0.
    """
    label = age_class(F.col("age"), AGE_CLASSES_4)
    one = {
        "nb_deces": F.col("idligne").isNotNull(),
        "nb_origine_ville": F.col("origine_ville") == "O",
        "nb_origine_departement": F.col("origine_departement") == "O",
        "nb_origine_region": F.col("origine_region") == "O",
        "nb_woman": F.col("sex") == "2",
    }
    for _, _, name in AGE_CLASSES_4:
        one[f"nb_deces_{CLASS_SUFFIXES[name]}"] = F.col("classe_4") == name
    for number, month in enumerate(MONTHS, start=1):
        one[month] = F.month("date_deces_dt") == number
    counts = [F.count_if((c) & F.col("idligne").isNotNull()).alias(name) for name, c in one.items()]
    lengths = {"distance_tot": F.lit(True)}
    for _, _, name in AGE_CLASSES_4:
        lengths[f"distance_tot_{CLASS_SUFFIXES[name]}"] = F.col("classe_4") == name
    sums = [F.sum(F.when(c, F.col("distance"))).alias(name) for name, c in lengths.items()]
    per_name = (
        df.where(all_present(keys))
        .withColumn("classe_4", label)
        .groupBy(*keys, "sex", "prenom")
        .agg(F.count("prenom").alias("_n"), *counts, *sums)
    )
    totals = [F.sum(name).alias(name) for name in one]
    distances = [round_even(F.coalesce(F.sum(name), F.lit(0.0)), 1).alias(name) for name in lengths]
    names = [
        most_frequent(F.col("prenom"), F.col("_n"), F.col("sex") == code).alias(name)
        for name, code in (("name_woman", "2"), ("name_man", "1"))
    ]
    return per_name.groupBy(*keys).agg(*totals, *distances, *names)


def month_pivot(df: DataFrame, keys: Sequence[str], day: str = "date_deces_dt", measured: str = "idligne") -> DataFrame:
    """Counts per month as twelve columns; the labels are fixed, so the schema is too."""
    label = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(day))
    return (
        df.where(all_present(keys))
        .groupBy(*keys)
        .agg(*[F.count(F.when(label == m, F.col(measured))).alias(m) for m in MONTHS])
    )


def cube_base(df: DataFrame) -> DataFrame:
    """Dashboard base: mean place, deaths and mean distance of each combination of the filter columns."""
    return df.groupBy(*CUBE_KEYS).agg(
        F.avg("latitude_deces").alias("lat"),
        F.avg("longitude_deces").alias("lon"),
        F.count("idligne").alias("nb_deces"),
        F.avg("distance").alias("distance_moy"),
    )


def select_persons(
    df: DataFrame,
    region: str | None = None,
    department: str | None = None,
    city: str | None = None,
    agglomeration: str | None = None,
    sex: str | None = None,
    ages: tuple[int, int] | None = None,
) -> DataFrame:
    """The dashboard filters; all given conditions hold together (ages inclusive)."""
    conditions = {"nom_region_deces": region, "nom_departement_deces": department, "ville_deces": city, "sex": sex}
    for column, value in conditions.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    if agglomeration is not None:
        df = df.where(F.col("ville_deces").contains(agglomeration))
    if ages is not None:
        df = df.where(F.col("age").between(*ages))
    return df


def dominant_profile(df: DataFrame, sector: str, flag: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean age, modal sex, first name and places, and dominant origin of each group (one row without ``by``).

    Every person is turned into four (variable, value) pairs, which are
    counted before they meet; ties take the smallest value, an origin tie ``O``.
    """
    birth = sector.replace("deces", "naissance")
    pairs = F.array(
        F.struct(F.lit("sexe").alias("variable"), F.col("sex").alias("value")),
        F.struct(F.concat(F.lit("prenom"), F.col("sex")).alias("variable"), F.col("prenom").alias("value")),
        F.struct(F.lit("naissance").alias("variable"), F.col(birth).alias("value")),
        F.struct(F.lit("deces").alias("variable"), F.col(sector).alias("value")),
    )
    long = df.select(*by, F.col(flag).alias("_flag"), "age", "distance", F.explode(pairs).alias("p")).select(
        *by, "_flag", "age", "distance", "p.*"
    )
    native, outsider = F.col("_flag") == "O", F.col("_flag") == "N"
    counted = long.groupBy(*by, "variable", "value").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("age").alias("age_sum"),
        F.count("age").alias("age_n"),
        F.count_if(native).alias("nb_o"),
        F.count_if(outsider).alias("nb_n"),
        F.sum(F.when(native, F.col("distance"))).alias("km_o"),
        F.sum(F.when(outsider, F.col("distance"))).alias("km_n"),
        F.count(F.when(native, F.col("distance"))).alias("km_o_n"),
        F.count(F.when(outsider, F.col("distance"))).alias("km_n_n"),
    )

    def once(name: str) -> Column:
        return F.sum(F.when(F.col("variable") == "sexe", F.col(name)))

    def mode(variable: str) -> Column:
        return most_frequent(F.col("value"), F.col("n"), F.col("variable") == variable)

    found = counted.groupBy(*by).agg(
        rate(once("age_sum"), once("age_n"), 0).alias("age_moyen"),
        mode("sexe").alias("sex"),
        mode("prenom1").alias("_prenom1"),
        mode("prenom2").alias("_prenom2"),
        mode("naissance").alias("lieu_naissance"),
        mode("deces").alias("lieu_deces"),
        F.when(once("nb_o") >= once("nb_n"), "O").otherwise("N").alias("origine_dominante"),
        rate(once("km_o"), once("km_o_n"), 0).alias("_km_o"),
        rate(once("km_n"), once("km_n_n"), 0).alias("_km_n"),
    )
    return found.select(
        *by,
        "age_moyen",
        F.when(F.col("sex") == "2", "F").otherwise("H").alias("sexe"),
        F.when(F.col("sex") == "2", F.col("_prenom2")).otherwise(F.col("_prenom1")).alias("prenom"),
        "lieu_naissance",
        "lieu_deces",
        "origine_dominante",
        F.when(F.col("origine_dominante") == "O", F.col("_km_o")).otherwise(F.col("_km_n")).alias("distance_moy"),
    )


def statistic_cells(df: DataFrame, flag: str, by: Sequence[str] = ()) -> DataFrame:
    """Persons and ages counted per group, flag and whole kilometre."""
    return df.groupBy(*by, flag, "distance").agg(
        F.count(F.lit(1)).alias("n"), F.sum("age").alias("age_sum"), F.count("age").alias("age_n")
    )


def sector_statistics(df: DataFrame, flag: str, by: Sequence[str] = ()) -> DataFrame:
    """Shares, rate, median distances, mean ages and mean ln(1+distance) of each group."""
    return statistics_of_cells(statistic_cells(df, flag, by), flag, by)


def statistics_of_cells(cells: DataFrame, flag: str, by: Sequence[str] = ()) -> DataFrame:
    """:func:`sector_statistics` of persons already counted by :func:`statistic_cells`."""
    native, outsider = F.col(flag) == "O", F.col(flag) == "N"
    n, km = F.col("n"), F.col("distance")

    def total(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(name))), F.lit(0))

    nb_o, nb_n, everyone = total(native, "n"), total(outsider, "n"), F.sum("n")
    return cells.groupBy(*by).agg(
        rate(100 * nb_o, everyone, 2).alias("pct_originaire"),
        rate(100 * nb_n, everyone, 2).alias("pct_exogene"),
        rate(nb_o, nb_o + nb_n, 1).alias("ind_TAFV"),
        rate(F.sum(n * log_distance(km)), everyone).alias("log_distance_moy"),
        rate(total(native, "age_sum"), total(native, "age_n"), 0).alias("age_moy_originaire"),
        rate(total(outsider, "age_sum"), total(outsider, "age_n"), 0).alias("age_moy_exogene"),
        F.percentile(F.when(native, km), 0.5, n).alias("distance_med_originaire"),
        F.percentile(F.when(outsider, km), 0.5, n).alias("distance_med_exogene"),
    )


def class_shares(df: DataFrame, column: str, by: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """Share in percent of each class among the rows that have one."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("effectif"))
    if by:
        totals = counts.groupBy(*by).agg(F.sum("effectif").alias("_total"))
        counts = counts.join(totals, list(by))
    else:
        counts = counts.withColumn("_total", counts.agg(F.sum("effectif")).scalar())
    share = rate(100 * F.col("effectif"), F.col("_total"), digits)
    return counts.withColumn("pourcentage", share).drop("_total")


def share_difference(local: DataFrame, national: DataFrame, column: str) -> DataFrame:
    """National minus local share of each class, matched by class; a class missing locally has a null difference."""
    reference = national.select(column, F.col("pourcentage").alias("pourcentage_national"))
    return local.join(reference, column, "left").withColumn(
        "delta", round_even(F.col("pourcentage_national") - F.col("pourcentage"), 2)
    )


def map_rollup(cube: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean place over the cube rows and deaths of each map unit."""
    return cube.groupBy(*keys).agg(
        F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.sum("nb_deces").alias("nb_deces")
    )


def treemap(df: DataFrame, top_n: int = 5, city: str = "ville_deces", origin: str = "nom_departement_naissance") -> DataFrame:
    """Per city: natives, the outsiders of the ``top_n`` birth departments, and all other outsiders as ``Autres``.

    The ranking works on departments counted per city, never on persons.
    """
    counts = df.groupBy(city, origin).agg(
        F.count_if(F.col("origine_ville") == "O").alias("nb_o"), F.count_if(F.col("origine_ville") == "N").alias("nb_n")
    )
    place = Window.partitionBy(city).orderBy(F.desc("nb_n"), F.asc(origin))
    inside = F.row_number().over(place) <= top_n

    def part(status: str, label: Column, value: Column, listed: Column) -> Column:
        return F.struct(
            F.lit(status).alias("statut"), label.alias("origine"), value.alias("valeur"), listed.alias("listed")
        )

    parts = F.array(
        part("Originaire", F.col(city), F.col("nb_o"), F.lit(0)),
        part(
            "Exogene",
            F.when(F.col("inside"), F.col(origin)).otherwise(F.lit("Autres")),
            F.col("nb_n"),
            F.when(F.col("inside"), 1).otherwise(2),
        ),
        part("Exogene", F.lit("Autres"), F.lit(0).cast("bigint"), F.lit(2)),
    )
    return (
        counts.withColumn("inside", inside)
        .select(F.col(city), F.explode(parts).alias("p"))
        .groupBy(city, "p.statut", "p.origine", "p.listed")
        .agg(F.sum("p.valeur").alias("valeur"))
        .drop("listed")
    )


def top_origin_ages(df: DataFrame, tree: DataFrame, city: str = "ville_deces") -> DataFrame:
    """Persons of the treemap's listed birth departments by age class."""
    origin = "nom_departement_naissance"
    listed = tree.where((F.col("statut") == "Exogene") & (F.col("origine") != "Autres")).select(
        city, F.col("origine").alias(origin), F.lit("O").alias("top_dep")
    )
    counted = df.groupBy(city, origin, "classe_age").agg(F.count("idligne").alias("nb"))
    marked = counted.join(listed, [city, origin], "left").withColumn("top_dep", F.coalesce("top_dep", F.lit("N")))
    return marked.where(F.col("top_dep") == "O").drop("top_dep")


def mobility_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    label = mobility_class(*[F.col(f"origine_{level}") for level in ("ville", "departement", "region", "nationale")])
    return df.withColumn("mobility", label).groupBy(*by, "classe_age", "mobility").agg(
        F.count("idligne").alias("nb_deces")
    )


def selection_summary(cube: DataFrame, abroad: Column, low: int = 50) -> DataFrame:
    """Size of a selection, warning when it is low, share of deaths abroad and map centre."""
    return cube.agg(
        F.coalesce(F.sum("nb_deces"), F.lit(0)).alias("selection"),
        F.avg("lat").alias("centre_lat"),
        F.avg("lon").alias("centre_lon"),
    ).select(
        "selection",
        (F.col("selection") <= low).alias("selection_faible"),
        rate(100 * abroad, F.col("selection"), 0).alias("proportion_hors_france"),
        "centre_lat",
        "centre_lon",
    )
