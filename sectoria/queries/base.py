"""The given tables in the roles of the domain: persons, places, measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classes import age_class, national_flag
from ..functions.dates import month_label
from ..functions.numeric import round_even
from ..functions.text import first_word
from ..operators.places import with_native_flags
from ..plans.mortality import with_distance


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(name: str, digits: int, alias: str | None = None) -> Column:
    return round_even(F.col(name), digits).alias(alias or name)


def iso(name: str) -> Column:
    """Date as text, which both engines print alike."""
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def persons(spark: SparkSession, folder: str, first_names: bool = False) -> DataFrame:
    """One person per order line: born at the supplier's place, died at the customer's."""
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )

    def located(df: DataFrame, key: str, nation: str, side: str) -> DataFrame:
        """``df`` with the place of a key of a nation."""
        district = F.col(key) % 5
        return df.join(places, F.col(nation) == F.col("n_nationkey")).select(
            *[F.col(c) for c in df.columns],
            F.lpad((F.col(nation) * 5 + district).cast("string"), 5, "0").alias(f"num_insee_{side}"),
            F.concat_ws(" ", "n_name", district.cast("string")).alias(f"ville_{side}"),
            F.col("n_nationkey").cast("string").alias(f"code_departement_{side}"),
            F.col("n_name").alias(f"nom_departement_{side}"),
            F.col("r_regionkey").cast("string").alias(f"code_region_{side}"),
            F.col("r_name").alias(f"nom_region_{side}"),
            ((F.col(key) * 37) % 140 - 70).cast("double").alias(f"latitude_{side}"),
            ((F.col(key) * 53) % 360 - 180).cast("double").alias(f"longitude_{side}"),
        )

    # Only keys go through the large joins; the texts of the places are added to their result.
    dated = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderdate", "c_custkey", "c_nationkey")
    )
    lines = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "s_suppkey", "s_nationkey")
    )
    if first_names:
        lines = lines.join(
            table(spark, folder, "part").select("p_partkey", first_word(F.col("p_name")).alias("prenom")),
            F.col("l_partkey") == F.col("p_partkey"),
        )
    met = lines.join(dated, F.col("l_orderkey") == F.col("o_orderkey"))
    born = located(met, "s_suppkey", "s_nationkey", "naissance")
    sides = [
        f"{name}_{side}"
        for side in ("naissance", "deces")
        for name in (
            "num_insee ville code_departement nom_departement code_region nom_region latitude longitude".split()
        )
    ]
    people = located(born, "c_custkey", "c_nationkey", "deces").select(
        *sides,
        *(["prenom"] if first_names else []),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("idligne"),
        F.when(F.col("l_linenumber") % 2 == 1, "1").otherwise("2").alias("sex"),
        (F.col("l_quantity") * 2).cast("int").alias("age"),
        F.year("o_orderdate").cast("string").alias("annee"),
        F.col("o_orderdate").cast("date").alias("date_deces_dt"),
        F.col("nom_departement_naissance").alias("pays_naissance"),
        F.lit("FRANCE").alias("pays_deces"),
    )
    return with_native_flags(with_distance(people)).withColumns(
        {
            "origine_nationale": national_flag(F.col("nom_region_naissance"), home="EUROPE"),
            "classe_age": age_class(F.col("age")),
            "month_deces": month_label(F.col("date_deces_dt")),
        }
    )


def _side(key: str, nation: str, alias: str, place: str, side: str) -> str:
    return f"""
  lpad(CAST({alias}.{nation} * 5 + {alias}.{key} % 5 AS VARCHAR), 5, '0') AS num_insee_{side},
  {place}n.n_name || ' ' || CAST({alias}.{key} % 5 AS VARCHAR) AS ville_{side},
  CAST({place}n.n_nationkey AS VARCHAR) AS code_departement_{side},
  {place}n.n_name AS nom_departement_{side},
  CAST({place}r.r_regionkey AS VARCHAR) AS code_region_{side},
  {place}r.r_name AS nom_region_{side},
  CAST(({alias}.{key} * 37) % 140 - 70 AS DOUBLE) AS latitude_{side},
  CAST(({alias}.{key} * 53) % 360 - 180 AS DOUBLE) AS longitude_{side}"""


HAVERSINE = """2 * 6371 * asin(least(sqrt(
    power(sin((radians(latitude_deces) - radians(latitude_naissance)) / 2), 2)
    + cos(radians(latitude_naissance)) * cos(radians(latitude_deces))
      * power(sin((radians(longitude_deces) - radians(longitude_naissance)) / 2), 2)), 1.0))"""

AGE_CLASS = """CASE WHEN age >= 0 AND age < 1 THEN '0-1' WHEN age >= 1 AND age < 20 THEN '1-20'
    WHEN age >= 20 AND age < 35 THEN '20-35' WHEN age >= 35 AND age < 50 THEN '35-50'
    WHEN age >= 50 AND age < 65 THEN '50-65' WHEN age >= 65 AND age < 90 THEN '65-90'
    WHEN age >= 90 AND age < 130 THEN '90+' END"""

# Common table expressions for the checks; ``persons`` mirrors persons() above.
PERSONS = f"""WITH joined AS (SELECT
  l.l_orderkey * 10 + l.l_linenumber AS idligne,
  split_part(p.p_name, ' ', 1) AS prenom,
  CASE WHEN l.l_linenumber % 2 = 1 THEN '1' ELSE '2' END AS sex,
  CAST(l.l_quantity * 2 AS INTEGER) AS age,
  CAST(year(o.o_orderdate) AS VARCHAR) AS annee,
  CAST(o.o_orderdate AS DATE) AS date_deces_dt,
  strftime(o.o_orderdate, '%b') AS month_deces,
  bn.n_name AS pays_naissance, 'FRANCE' AS pays_deces,
  {_side("s_suppkey", "s_nationkey", "s", "b", "naissance")},
  {_side("c_custkey", "c_nationkey", "c", "d", "deces")}
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey
  JOIN nation bn ON s.s_nationkey = bn.n_nationkey JOIN region br ON bn.n_regionkey = br.r_regionkey
  JOIN nation dn ON c.c_nationkey = dn.n_nationkey JOIN region dr ON dn.n_regionkey = dr.r_regionkey
), persons AS (SELECT *,
  CASE WHEN ville_naissance = ville_deces THEN 'O' ELSE 'N' END AS origine_ville,
  CASE WHEN nom_departement_naissance = nom_departement_deces THEN 'O' ELSE 'N' END AS origine_departement,
  CASE WHEN nom_region_naissance = nom_region_deces THEN 'O' ELSE 'N' END AS origine_region,
  CASE WHEN nom_region_naissance = 'EUROPE' THEN 'O' ELSE 'N' END AS origine_nationale,
  {AGE_CLASS} AS classe_age,
  round_even({HAVERSINE}, 0) AS distance
  FROM joined)
"""

BASELINE = """, baseline AS (SELECT avg(ln(1 + distance)) AS moy, stddev_samp(ln(1 + distance)) AS std FROM persons)
"""


def sector_sql(keys: list[str], flag: str) -> str:
    """Aggregated sectors of one level as a query on ``persons``."""
    names = ", ".join(keys)
    return f"""SELECT {names}, count(idligne) AS deces,
  count(*) FILTER (WHERE {flag} = 'N') AS nb_exogene, count(*) FILTER (WHERE {flag} = 'O') AS nb_natif,
  coalesce(sum(distance) FILTER (WHERE {flag} = 'N'), 0) AS distance_exogene,
  coalesce(sum(distance) FILTER (WHERE {flag} = 'O'), 0) AS distance_natif,
  median(distance) FILTER (WHERE {flag} = 'N') AS med_distance_exogene,
  median(distance) FILTER (WHERE {flag} = 'O') AS med_distance_natif,
  sum(ln(1 + distance)) AS log_distance FROM persons GROUP BY {names}"""


def indices_sql(moy: str = "b.moy", std: str = "b.std") -> str:
    return f"""nb_natif / CAST(nullif(nb_natif + nb_exogene, 0) AS DOUBLE) AS t, log_distance / deces AS m,
  {moy} AS moy_distance, {std} AS std_distance"""


def scored_sql(columns: str, source: str) -> str:
    """Indices and rounding over a query that yields sectors with ``t``, ``m`` and the baseline."""
    return f"""SELECT {columns}, deces, nb_exogene, nb_natif, distance_exogene, distance_natif,
  med_distance_exogene, med_distance_natif,
  round_even(moy_distance, 6) AS moy_distance, round_even(std_distance, 6) AS std_distance,
  round_even(t, 3) AS "TAFV", round_even(m, 3) AS mobilite_secteur,
  round_even((moy_distance - round_even(m, 3)) / std_distance, 3) AS "IMD" FROM ({source})"""
