"""Territory scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.classes import mobility_class
from ..functions.numeric import log_distance
from ..operators import scores as S
from ..plans.dashboard import sector_pages, with_person_imd, with_sector_imd
from ..session import cut_lineage
from .base import BASELINE, PERSONS, indices_sql, persons, rounded, scored_sql, sector_sql
from .registry import query

LEVELS = S.LEVELS
DEP = LEVELS[:3]
CITY = LEVELS[:4]


def _tidy(df):
    return df.withColumn("moy_distance", rounded("moy_distance", 6)).withColumn(
        "std_distance", rounded("std_distance", 6)
    )


def _rank_sql(source: str, partition: str = "") -> str:
    return f"""SELECT *, CAST(floor(rank() OVER ({partition} ORDER BY deces DESC)
  + (count(*) OVER ({(partition + ', ') if partition else 'PARTITION BY '}deces) - 1) / 2.0) AS BIGINT) AS rang_deces
  FROM ({source})"""


def _level_sql(keys: list[str], flag: str) -> str:
    inner = f"SELECT s.*, {indices_sql()} FROM ({sector_sql(keys, flag)}) s CROSS JOIN baseline b"
    return scored_sql(", ".join(keys), inner)


_ALL_LEVELS = " UNION ALL ".join(
    "SELECT '{level}' AS niveau, {names}, * EXCLUDE ({keys}) FROM ({sql})".format(
        level=level,
        names=", ".join(k if i < depth else f"CAST(NULL AS VARCHAR) AS {k}" for i, k in enumerate(LEVELS)),
        keys=", ".join(LEVELS[:depth]),
        sql=_level_sql(LEVELS[:depth], S.LEVEL_FLAGS[level]),
    )
    for depth, level in enumerate(LEVELS[1:], start=2)
)


@query("A14 A7 W1 P29 P30 J15", PERSONS + BASELINE + _rank_sql(_ALL_LEVELS, "PARTITION BY niveau"))
def territory_scores(spark, folder):
    """Flagship: scores and ranks of the sectors of every level."""
    people = persons(spark, folder)
    return _tidy(S.all_level_scores(people))


@query(
    "A7",
    PERSONS
    + """SELECT round_even(avg(ln(1 + distance)), 6) AS moy_distance,
  round_even(stddev_samp(ln(1 + distance)), 6) AS std_distance,
  min(distance) FILTER (WHERE origine_departement = 'O') AS distance_dep_min,
  max(distance) FILTER (WHERE origine_departement = 'O') AS distance_dep_max,
  max(distance) FILTER (WHERE origine_nationale = 'O') AS distance_nat_max FROM persons""",
)
def national_baseline(spark, folder):
    return _tidy(S.national_baseline(persons(spark, folder)))


@query(
    "A8 P19",
    PERSONS
    + """SELECT classe_age, round_even(avg(ln(1 + distance)), 6) AS moy_distance,
  round_even(stddev_samp(ln(1 + distance)), 6) AS std_distance FROM persons GROUP BY classe_age""",
)
def age_baseline(spark, folder):
    return _tidy(S.age_baseline(persons(spark, folder)))


_AGE_SECTORS = f"""SELECT s.*, {indices_sql("a.moy", "a.std")} FROM ({sector_sql([*DEP, "classe_age"], "origine_departement")}) s
  LEFT JOIN (SELECT classe_age, avg(ln(1 + distance)) AS moy, stddev_samp(ln(1 + distance)) AS std
    FROM persons GROUP BY classe_age) a USING (classe_age)"""
_AGE_SCORES = f"""SELECT x.*, r.rang_deces FROM ({scored_sql(", ".join([*DEP, "classe_age"]), _AGE_SECTORS)}) x
  JOIN ({_rank_sql(f"SELECT {', '.join(DEP)}, count(idligne) AS deces FROM persons GROUP BY ALL")}) r
  USING ({", ".join(DEP)})"""


@query("A14 J14 J15 W1", PERSONS + _AGE_SCORES)
def age_scores(spark, folder):
    """Department scores split by age class, each class against its own baseline."""
    people = persons(spark, folder)
    return _tidy(S.sector_scores(people, "nom_departement_deces", by_age=True))


_CITY_RANKED = _rank_sql(_level_sql(CITY, "origine_ville"))


@query(
    "W2 A14 O1",
    PERSONS
    + BASELINE
    + f"SELECT *, CAST(ceil(rang_deces / 20.0) AS INTEGER) AS page FROM ({_CITY_RANKED})",
)
def city_pages(spark, folder):
    return _tidy(sector_pages(persons(spark, folder), "ville_deces"))


_MATRIX = f"""SELECT nom_departement_deces, classe_age, "TAFV", "IMD", CAST(ceil(rang_deces / 20.0) AS INTEGER) AS page
  FROM ({_AGE_SCORES})"""
_CLASS_ORDER = "list_position(['0-1', '1-20', '20-35', '35-50', '50-65', '65-90', '90+'], classe_age)"


@query(
    "O3",
    PERSONS
    + f""", matrix AS ({_MATRIX}), ranked AS (SELECT *, row_number() OVER (PARTITION BY page
    ORDER BY "TAFV" DESC, nom_departement_deces, {_CLASS_ORDER}) AS rang FROM matrix WHERE "TAFV" IS NOT NULL),
  room AS (SELECT page, count(DISTINCT nom_departement_deces) * count(DISTINCT classe_age) - 2 AS room
    FROM matrix GROUP BY page)
  SELECT page, nom_departement_deces, classe_age, "TAFV", CAST(rang AS INTEGER) AS rang
  FROM ranked JOIN room USING (page) WHERE rang <= least(5, room)""",
)
def extreme_cells(spark, folder):
    matrix = sector_pages(persons(spark, folder), "nom_departement_deces", by_age=True, max_pages=None)
    return S.extreme_cells(matrix, "nom_departement_deces", "TAFV")


@query(
    "O4",
    PERSONS
    + f""", matrix AS ({_MATRIX}),
  classes AS (SELECT page, classe_age, round_even(coalesce(sum("IMD"), 0), 6) AS s FROM matrix GROUP BY ALL),
  sectors AS (SELECT page, nom_departement_deces, round_even(avg("IMD"), 6) AS s FROM matrix GROUP BY ALL
    HAVING avg("IMD") IS NOT NULL),
  c AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY s, {_CLASS_ORDER}) AS k FROM classes),
  d AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY s, nom_departement_deces) AS k FROM sectors)
  SELECT page, c.classe_age AS classe_extreme, c.s AS classe_extreme_valeur,
    d.nom_departement_deces AS secteur_extreme, d.s AS secteur_extreme_valeur
  FROM c JOIN d USING (page) WHERE c.k = 1 AND d.k = 1""",
)
def extreme_lines(spark, folder):
    matrix = sector_pages(persons(spark, folder), "nom_departement_deces", by_age=True, max_pages=None)
    return S.extreme_lines(matrix, "nom_departement_deces", "IMD", largest=False)


def _ratio_sql(variant: str) -> str:
    if variant == "distance":
        ratio = """CASE WHEN distance_natif = 0 THEN 0
          ELSE round_even(distance_natif / (distance_exogene + distance_natif), 2) END"""
        tafv, missing = "nb_natif", "NULL"
    else:
        ratio = """CASE WHEN med_distance_natif <> 0
          THEN round_even(med_distance_exogene / med_distance_natif, 2) END"""
        tafv, missing = "nb_exogene", "1"

    def scaled(c: str) -> str:
        return f"({c} - min({c}) OVER ()) / nullif(CAST(max({c}) OVER () - min({c}) OVER () AS DOUBLE), 0)"

    return f"""SELECT * EXCLUDE (log_distance, deces, imd_raw, n1, n2, n3, n4), imd_raw AS "IMD",
      CASE WHEN imd_raw IS NULL THEN {missing} ELSE round_even(n1, 9) END AS "IMD_nor",
      round_even(n2, 9) AS exogene_nor, round_even(n3, 9) AS natif_nor, round_even(n4, 9) AS distance_exogene_nor,
      round_even(0.6 * n3 + 0.2 * n2 + 0.1 * (1 - n4), 9) AS score
    FROM (SELECT *, {scaled("imd_raw")} AS n1, {scaled("nb_exogene")} AS n2, {scaled("nb_natif")} AS n3,
      {scaled("distance_exogene")} AS n4
      FROM (SELECT *, round_even({tafv} / CAST(nb_natif + nb_exogene AS DOUBLE), 3) AS "TAFV",
        CAST({ratio} AS DOUBLE) AS imd_raw FROM ({sector_sql(CITY, "origine_ville")})))"""


def _ratio(spark, folder, variant):
    scored = S.ratio_scores(persons(spark, folder), "ville_deces", variant)
    for name in ("IMD_nor", "exogene_nor", "natif_nor", "distance_exogene_nor", "score"):
        scored = scored.withColumn(name, rounded(name, 9))
    return scored


@query("A22 A23 A24", PERSONS + _ratio_sql("distance"))
def distance_ratio_scores(spark, folder):
    return _ratio(spark, folder, "distance")


@query("A22 A23 A24", PERSONS + _ratio_sql("mediane"))
def median_ratio_scores(spark, folder):
    return _ratio(spark, folder, "mediane")


_SCORED = f", scored AS ({_ALL_LEVELS})\n"


@query(
    "A25",
    PERSONS
    + BASELINE
    + _SCORED
    + " UNION ALL ".join(
        f"""SELECT '{measure}' AS indicateur, niveau, nb_sup, nb_inf, nb_neutre,
  CASE WHEN (nb_neutre > nb_sup AND nb_neutre > nb_inf) OR nb_inf = nb_sup THEN 'neutre'
    WHEN nb_sup > nb_inf THEN '{high}' ELSE '{low}' END AS etat
  FROM (SELECT niveau, count(*) FILTER (WHERE "{measure}" > {mid}) AS nb_sup,
    count(*) FILTER (WHERE "{measure}" < {mid}) AS nb_inf, count(*) FILTER (WHERE "{measure}" = {mid}) AS nb_neutre
    FROM scored GROUP BY niveau)"""
        for measure, mid, high, low in (("TAFV", 0.5, "originaire", "exogene"), ("IMD", 0, "inertie", "mobile"))
    ),
)
def overall_states(spark, folder):
    people = persons(spark, folder)
    scored = cut_lineage(S.all_level_scores(people))
    parts = [
        S.overall_state(scored, m, by=["niveau"]).select(F.lit(m).alias("indicateur"), "*") for m in ("TAFV", "IMD")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "A26",
    PERSONS
    + f"SELECT count(*) FILTER (WHERE nb_natif = 0) AS nb_secteurs_sans_natif FROM ({sector_sql(CITY, 'origine_ville')})",
)
def sectors_without_natives(spark, folder):
    people = persons(spark, folder)
    return S.sectors_without_natives(S.sector_scores(people, "ville_deces"))


_STATS = """SELECT nom_departement_deces,
  round_even(100.0 * count(*) FILTER (WHERE origine_departement = 'O') / CAST(count(*) AS DOUBLE), 2) AS pct_originaire,
  round_even(100.0 * count(*) FILTER (WHERE origine_departement = 'N') / CAST(count(*) AS DOUBLE), 2) AS pct_exogene,
  round_even(count(*) FILTER (WHERE origine_departement = 'O') / CAST(count(*) AS DOUBLE), 1) AS "ind_TAFV",
  avg(ln(1 + distance)) AS l,
  round_even(avg(age) FILTER (WHERE origine_departement = 'O'), 0) AS age_moy_originaire,
  round_even(avg(age) FILTER (WHERE origine_departement = 'N'), 0) AS age_moy_exogene,
  median(distance) FILTER (WHERE origine_departement = 'O') AS distance_med_originaire,
  median(distance) FILTER (WHERE origine_departement = 'N') AS distance_med_exogene
  FROM persons GROUP BY nom_departement_deces"""


@query(
    "A10 A13",
    PERSONS
    + BASELINE
    + f"""SELECT s.* EXCLUDE (l), round_even(l, 6) AS log_distance_moy,
  round_even((b.moy - l) / b.std, 2) AS "ind_IMD" FROM ({_STATS}) s CROSS JOIN baseline b""",
)
def sector_statistics(spark, folder):
    result = with_sector_imd(persons(spark, folder), "origine_departement", ["nom_departement_deces"])
    return result.withColumn("log_distance_moy", rounded("log_distance_moy", 6))


@query(
    "P30 P31 A13",
    PERSONS
    + BASELINE
    + """SELECT mobility, count(*) AS nb, round_even(sum(ln(1 + distance)), 2) AS log_distance,
  round_even(avg(round_even((b.moy - ln(1 + distance)) / b.std, 2)), 6) AS "IMD"
  FROM (SELECT *, CASE WHEN origine_ville = 'O' THEN 'Urbaine' WHEN origine_departement = 'O' THEN 'Départementale'
    WHEN origine_region = 'O' THEN 'Régionale' WHEN origine_nationale = 'O' THEN 'Nationale'
    ELSE 'Internationale' END AS mobility FROM persons) CROSS JOIN baseline b GROUP BY mobility""",
)
def person_mobility(spark, folder):
    """Mobility index of every person, summed up by mobility class."""
    people = persons(spark, folder)
    label = mobility_class(*[F.col(f"origine_{x}") for x in ("ville", "departement", "region", "nationale")])
    indexed = with_person_imd(people, S.national_baseline(people)).withColumn("mobility", label)
    return indexed.groupBy("mobility").agg(
        F.count(F.lit(1)).alias("nb"),
        F.sum(log_distance(F.col("distance"))).alias("log_distance"),
        F.avg("IMD").alias("IMD"),
    ).select("mobility", "nb", rounded("log_distance", 2), rounded("IMD", 6))


