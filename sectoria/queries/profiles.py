"""Profiles of places and the dashboard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.classes import AGE_CLASSES_4, age_class, class_rank, label_of
from ..functions.dates import MONTHS
from ..functions.text import agglomeration
from ..operators import profiles as P
from ..operators.places import merge_all
from .base import PERSONS, persons, rounded, table
from .registry import query

_CLASS4 = "CASE WHEN age < 30 THEN '0_30' WHEN age < 60 THEN '30_60' WHEN age < 90 THEN '60_90' WHEN age < 130 THEN 'plus_90' END"
_SUFFIXES = ["0_30", "30_60", "60_90", "plus_90"]


def _top_name(sex: str) -> str:
    return f"""SELECT annee, num_insee_deces, prenom FROM (SELECT annee, num_insee_deces, prenom,
    row_number() OVER (PARTITION BY annee, num_insee_deces ORDER BY count(*) DESC, prenom) AS k
    FROM persons WHERE sex = '{sex}' GROUP BY annee, num_insee_deces, prenom) WHERE k = 1"""


@query(
    "A2 A3 A4 P22 J13",
    PERSONS
    + f""", p AS (SELECT *, {_CLASS4} AS c4 FROM persons),
  g AS (SELECT annee, num_insee_deces, count(idligne) AS nb_deces,
    round_even(sum(distance), 1) AS distance_tot,
    {", ".join(f"count(*) FILTER (WHERE origine_{x} = 'O') AS nb_origine_{x}" for x in ("ville", "departement", "region"))},
    count(*) FILTER (WHERE sex = '2') AS nb_woman,
    {", ".join(f"count(*) FILTER (WHERE c4 = '{s}') AS nb_deces_{s}" for s in _SUFFIXES)},
    {", ".join(f"round_even(coalesce(sum(distance) FILTER (WHERE c4 = '{s}'), 0), 1) AS distance_tot_{s}" for s in _SUFFIXES)},
    {", ".join(f"count(*) FILTER (WHERE month_deces = '{m}') AS {chr(34)}{m}{chr(34)}" for m in MONTHS)}
    FROM p GROUP BY annee, num_insee_deces)
  SELECT g.*, w.prenom AS name_woman, m.prenom AS name_man FROM g
  LEFT JOIN ({_top_name("2")}) w USING (annee, num_insee_deces)
  LEFT JOIN ({_top_name("1")}) m USING (annee, num_insee_deces)""",
)
def commune_year_profile(spark, folder):
    return P.commune_year_profile(persons(spark, folder, first_names=True))


@query(
    "A4",
    f"""SELECT o_custkey, {", ".join(f"count(*) FILTER (WHERE strftime(o_orderdate, '%b') = '{m}') AS {chr(34)}{m}{chr(34)}" for m in MONTHS)}
  FROM orders GROUP BY o_custkey""",
)
def month_pivot(spark, folder):
    return P.month_pivot(table(spark, folder, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey")


@query(
    "J13",
    """SELECT coalesce(a.o_custkey, b.o_custkey, c.o_custkey) AS o_custkey, coalesce(nb_urgent, 0) AS nb_urgent,
  coalesce(nb_open, 0) AS nb_open, coalesce(nb_early, 0) AS nb_early FROM
  (SELECT o_custkey, count(*) AS nb_urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) a
  FULL JOIN (SELECT o_custkey, count(*) AS nb_open FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b
    ON a.o_custkey = b.o_custkey
  FULL JOIN (SELECT o_custkey, count(*) AS nb_early FROM orders WHERE year(o_orderdate) = 1995 GROUP BY 1) c
    ON coalesce(a.o_custkey, b.o_custkey) = c.o_custkey""",
)
def merged_counts(spark, folder):
    orders = table(spark, folder, "orders")
    conditions = {
        "nb_urgent": F.col("o_orderpriority") == "1-URGENT",
        "nb_open": F.col("o_orderstatus") == "O",
        "nb_early": F.year("o_orderdate") == 1995,
    }
    parts = [
        orders.where(c).groupBy("o_custkey").agg(F.count(F.lit(1)).alias(name)) for name, c in conditions.items()
    ]
    return merge_all(parts, ["o_custkey"])


_CUBE_KEYS = ", ".join(P.CUBE_KEYS)
_CUBE = f"""SELECT {_CUBE_KEYS}, avg(latitude_deces) AS lat, avg(longitude_deces) AS lon,
  count(idligne) AS nb_deces, avg(distance) AS distance_moy FROM persons GROUP BY ALL"""


@query(
    "A6",
    PERSONS
    + f"""SELECT {_CUBE_KEYS}, round_even(lat, 6) AS lat, round_even(lon, 6) AS lon, nb_deces,
  round_even(distance_moy, 4) AS distance_moy FROM ({_CUBE})""",
)
def cube_base(spark, folder):
    cube = P.cube_base(persons(spark, folder))
    return cube.select(*P.CUBE_KEYS, rounded("lat", 6), rounded("lon", 6), "nb_deces", rounded("distance_moy", 4))


def _map_sql(keys: str) -> str:
    return f"""SELECT {keys}, round_even(avg(lat), 4) AS lat, round_even(avg(lon), 4) AS lon,
  CAST(sum(nb_deces) AS BIGINT) AS nb_deces FROM cube GROUP BY ALL"""


_LEVELS = ["nom_region_deces", "nom_departement_deces", "ville_deces"]


@query(
    "A16",
    PERSONS
    + f", cube AS ({_CUBE}) "
    + " UNION ALL ".join(
        "SELECT '{}' AS niveau, {}, lat, lon, nb_deces FROM ({})".format(
            level,
            ", ".join(c if i <= depth else f"CAST(NULL AS VARCHAR) AS {c}" for i, c in enumerate(_LEVELS)),
            _map_sql(", ".join(_LEVELS[: depth + 1])),
        )
        for depth, level in enumerate(_LEVELS)
    ),
)
def map_rollup(spark, folder):
    cube = P.cube_base(persons(spark, folder))
    parts = []
    for depth, level in enumerate(_LEVELS):
        part = P.map_rollup(cube, _LEVELS[: depth + 1])
        names = [F.col(c) if i <= depth else F.lit(None).cast("string").alias(c) for i, c in enumerate(_LEVELS)]
        parts.append(part.select(F.lit(level).alias("niveau"), *names, rounded("lat", 4), rounded("lon", 4), "nb_deces"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _mode(value: str, condition: str = "TRUE") -> str:
    return f"""(SELECT nom_region_deces, v FROM (SELECT nom_region_deces, {value} AS v,
    row_number() OVER (PARTITION BY nom_region_deces ORDER BY count(*) DESC, {value}) AS k
    FROM persons WHERE {condition} GROUP BY nom_region_deces, {value}) WHERE k = 1)"""


@query(
    "A9",
    PERSONS
    + f"""SELECT g.nom_region_deces, age_moyen, CASE WHEN s.v = '2' THEN 'F' ELSE 'H' END AS sexe,
  CASE WHEN s.v = '2' THEN p2.v ELSE p1.v END AS prenom, n.v AS lieu_naissance, d.v AS lieu_deces, origine_dominante,
  CASE WHEN origine_dominante = 'O' THEN km_o ELSE km_n END AS distance_moy
  FROM (SELECT nom_region_deces, round_even(avg(age), 0) AS age_moyen,
    CASE WHEN count(*) FILTER (WHERE origine_departement = 'O') >= count(*) FILTER (WHERE origine_departement = 'N')
      THEN 'O' ELSE 'N' END AS origine_dominante,
    round_even(avg(distance) FILTER (WHERE origine_departement = 'O'), 0) AS km_o,
    round_even(avg(distance) FILTER (WHERE origine_departement = 'N'), 0) AS km_n
    FROM persons GROUP BY nom_region_deces) g
  JOIN {_mode("sex")} s USING (nom_region_deces)
  JOIN {_mode("prenom", "sex = '1'")} p1 USING (nom_region_deces)
  JOIN {_mode("prenom", "sex = '2'")} p2 USING (nom_region_deces)
  JOIN {_mode("nom_departement_naissance")} n USING (nom_region_deces)
  JOIN {_mode("nom_departement_deces")} d USING (nom_region_deces)""",
)
def dominant_profile(spark, folder):
    people = persons(spark, folder, first_names=True)
    return P.dominant_profile(people, "nom_departement_deces", "origine_departement", by=["nom_region_deces"])


_SHARES = """SELECT {by} classe_age, count(*) AS effectif,
  round_even(100.0 * count(*) / sum(count(*)) OVER ({part}), 3) AS pourcentage FROM persons
  WHERE classe_age IS NOT NULL GROUP BY {by} classe_age"""
_NATIONAL_SHARES = _SHARES.format(by="", part="")
_LOCAL_SHARES = _SHARES.format(by="nom_region_deces,", part="PARTITION BY nom_region_deces")


@query(
    "A11 P19",
    PERSONS
    + f"""SELECT *, CAST(list_position(['0-1', '1-20', '20-35', '35-50', '50-65', '65-90', '90+'], classe_age) AS INTEGER)
  AS ordre FROM ({_NATIONAL_SHARES})""",
)
def class_shares(spark, folder):
    shares = P.class_shares(persons(spark, folder), "classe_age")
    return shares.withColumn("ordre", class_rank(F.col("classe_age")))


@query(
    "A12 A11",
    PERSONS
    + f"""SELECT l.*, n.pourcentage AS pourcentage_national, round_even(n.pourcentage - l.pourcentage, 2) AS delta
  FROM ({_LOCAL_SHARES}) l LEFT JOIN ({_NATIONAL_SHARES}) n USING (classe_age)""",
)
def share_difference(spark, folder):
    people = persons(spark, folder)
    local = P.class_shares(people, "classe_age", by=["nom_region_deces"])
    return P.share_difference(local, P.class_shares(people, "classe_age"), "classe_age")


_TREEMAP = """, deps AS (SELECT ville_deces, nom_departement_naissance AS dep,
    count(*) FILTER (WHERE origine_ville = 'O') AS nb_o, count(*) FILTER (WHERE origine_ville = 'N') AS nb_n
    FROM persons GROUP BY ALL),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY ville_deces ORDER BY nb_n DESC, dep) AS k FROM deps),
  tree AS (SELECT ville_deces, 'Originaire' AS statut, ville_deces AS origine, CAST(sum(nb_o) AS BIGINT) AS valeur
      FROM deps GROUP BY ville_deces
    UNION ALL SELECT ville_deces, 'Exogene', dep, nb_n FROM ranked WHERE k <= 5
    UNION ALL SELECT ville_deces, 'Exogene', 'Autres', CAST(coalesce(sum(nb_n) FILTER (WHERE k > 5), 0) AS BIGINT)
      FROM ranked GROUP BY ville_deces)
"""


@query("A21 U1 O2", PERSONS + _TREEMAP + "SELECT * FROM tree")
def treemap(spark, folder):
    return P.treemap(persons(spark, folder))


@query(
    "A27 J17",
    PERSONS
    + _TREEMAP
    + """SELECT p.ville_deces, p.nom_departement_naissance, p.classe_age, count(*) AS nb FROM persons p
  JOIN tree t ON p.ville_deces = t.ville_deces AND p.nom_departement_naissance = t.origine AND t.statut = 'Exogene'
  GROUP BY ALL""",
)
def top_origin_ages(spark, folder):
    people = persons(spark, folder)
    return P.top_origin_ages(people, P.treemap(people))


@query(
    "A27 P31",
    PERSONS
    + """SELECT nom_region_deces, classe_age, CASE WHEN origine_ville = 'O' THEN 'Urbaine'
    WHEN origine_departement = 'O' THEN 'Départementale' WHEN origine_region = 'O' THEN 'Régionale'
    WHEN origine_nationale = 'O' THEN 'Nationale' ELSE 'Internationale' END AS mobility, count(*) AS nb_deces
  FROM persons GROUP BY ALL""",
)
def mobility_counts(spark, folder):
    return P.mobility_counts(persons(spark, folder), by=["nom_region_deces"])


@query(
    "A34 J9",
    PERSONS
    + f""", cube AS ({_CUBE})
  SELECT CAST(sum(nb_deces) AS BIGINT) AS selection, sum(nb_deces) <= 50 AS selection_faible,
  round_even(100.0 * (SELECT count(*) FILTER (WHERE nom_region_naissance <> nom_region_deces) FROM persons)
    / CAST(sum(nb_deces) AS DOUBLE), 0) AS proportion_hors_france,
  round_even(avg(lat), 4) AS centre_lat, round_even(avg(lon), 4) AS centre_lon FROM cube
  WHERE nom_region_deces = 'ASIA'""",
)
def selection_summary(spark, folder):
    """Size and centre of one region's persons against the persons who died outside their birth region."""
    people = persons(spark, folder)
    moved = people.agg(F.count_if(F.col("nom_region_naissance") != F.col("nom_region_deces"))).scalar()
    chosen = P.select_persons(P.cube_base(people), region="ASIA")
    return P.selection_summary(chosen, moved).withColumns(
        {c: rounded(c, 4) for c in ("centre_lat", "centre_lon")}
    )


@query(
    "P32 A1 U3",
    PERSONS
    + """SELECT ville_deces, sex, count(*) AS nb_deces, min(age) AS age_min, max(age) AS age_max FROM persons
  WHERE nom_region_deces = 'EUROPE' AND sex = '2' AND age BETWEEN 20 AND 85 GROUP BY ALL""",
)
def filtered_persons(spark, folder):
    """Dashboard filters: one region, women aged 20 to 85."""
    chosen = P.select_persons(persons(spark, folder), region="EUROPE", sex="2", ages=(20, 85))
    return chosen.groupBy("ville_deces", "sex").agg(
        F.count(F.lit(1)).alias("nb_deces"), F.min("age").alias("age_min"), F.max("age").alias("age_max")
    )


@query(
    "P33 P32",
    """SELECT CASE WHEN p_name LIKE 'red%' OR p_name LIKE 'blue%' THEN split_part(p_name, ' ', 1) ELSE p_name END AS place,
  count(*) AS nb FROM part GROUP BY 1""",
)
def agglomerations(spark, folder):
    place = agglomeration(F.col("p_name"), ("red", "blue"))
    return table(spark, folder, "part").groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("nb"))


@query(
    "P19 P22",
    """SELECT CASE WHEN p_size < 30 THEN '0-30' WHEN p_size < 60 THEN '30-60' END AS classe,
  CASE p_type WHEN 'SMALL' THEN 'Petit' WHEN 'LARGE' THEN 'Grand' END AS libelle, count(*) AS nb FROM part GROUP BY ALL""",
)
def labelled_classes(spark, folder):
    part = table(spark, folder, "part")
    return part.groupBy(
        age_class(F.col("p_size"), AGE_CLASSES_4).alias("classe"),
        label_of(F.col("p_type"), {"SMALL": "Petit", "LARGE": "Grand"}).alias("libelle"),
    ).agg(F.count(F.lit(1)).alias("nb"))
