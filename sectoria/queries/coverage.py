"""Measurement series, coverage and outliers on orders seen as city measurements."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coverage as V
from ..operators import quantiles as Q
from ..plans import climate
from .base import iso, rounded, table
from .registry import query


def measurements(spark, folder):
    """One measurement per order; customers of one city are its sensors."""
    k = F.col("c_custkey")
    city = k % 60
    sensors = table(spark, folder, "customer").select(
        "c_custkey",
        F.concat(F.lit("C"), city.cast("string")).alias("CITY"),
        F.concat(F.lit("P"), (city % 8).cast("string")).alias("CN"),
        F.concat(F.lit("Pays "), (city % 8).cast("string")).alias("CN_NAME"),
        F.when(city % 9 == 0, "O").otherwise("N").alias("CAPITALE"),
        ((k * 37) % 140 - 70).cast("double").alias("LAT_degre"),
        ((k * 53) % 360 - 180).cast("double").alias("LON_degre"),
        (k % 300).cast("double").alias("HGHT_num"),
        F.when((city != 7) | (k % 2 == 0), (k % 1000).cast("double")).alias("NB_HAB"),
    )
    day = F.col("o_orderdate")
    return (
        table(spark, folder, "orders")
        .join(sensors, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "CITY",
            "CN",
            "CN_NAME",
            "CAPITALE",
            "LAT_degre",
            "LON_degre",
            "HGHT_num",
            "NB_HAB",
            (F.col("o_totalprice") * 0.1).alias("TEMPERATURE"),
            day.cast("date").alias("DATE_dt"),
            F.date_format(day, "yyyy").alias("DATE_str_YEAR"),
            F.date_format(day, "MM").alias("DATE_str_MONTH"),
        )
    )


_RAW = """WITH raw AS (SELECT 'C' || CAST(c_custkey % 60 AS VARCHAR) AS "CITY", 'P' || CAST(c_custkey % 60 % 8 AS VARCHAR) AS "CN",
    'Pays ' || CAST(c_custkey % 60 % 8 AS VARCHAR) AS "CN_NAME", CASE WHEN c_custkey % 60 % 9 = 0 THEN 'O' ELSE 'N' END AS "CAPITALE",
    CAST((c_custkey * 37) % 140 - 70 AS DOUBLE) AS "LAT_degre", CAST((c_custkey * 53) % 360 - 180 AS DOUBLE) AS "LON_degre",
    CAST(c_custkey % 300 AS DOUBLE) AS "HGHT_num",
    CASE WHEN c_custkey % 60 <> 7 OR c_custkey % 2 = 0 THEN CAST(c_custkey % 1000 AS DOUBLE) END AS "NB_HAB",
    o_totalprice * 0.1 AS "TEMPERATURE", CAST(o_orderdate AS DATE) AS "DATE_dt",
    strftime(o_orderdate, '%Y') AS "DATE_str_YEAR", strftime(o_orderdate, '%m') AS "DATE_str_MONTH"
    FROM orders JOIN customer ON o_custkey = c_custkey)
"""
_DAYS = (
    _RAW
    + """, place AS (SELECT "CITY", "CN", "CN_NAME", "CAPITALE", round_even(avg("LAT_degre"), 9) AS "LAT_degre",
    round_even(avg("LON_degre"), 9) AS "LON_degre", round_even(avg("HGHT_num"), 9) AS "HGHT_num" FROM raw GROUP BY ALL),
  days AS (SELECT r."CITY", r."CN", r."CN_NAME", r."CAPITALE", "DATE_dt", round_even(avg("TEMPERATURE"), 6) AS "TEMPERATURE",
    round_even(avg("NB_HAB"), 6) AS "NB_HAB", any_value(p."LAT_degre") AS "LAT_degre", any_value(p."LON_degre") AS "LON_degre",
    any_value(p."HGHT_num") AS "HGHT_num" FROM raw r JOIN place p USING ("CITY", "CN", "CN_NAME", "CAPITALE")
    GROUP BY r."CITY", r."CN", r."CN_NAME", r."CAPITALE", "DATE_dt")
"""
)


def _days(spark, folder):
    days = V.city_days(measurements(spark, folder))
    return days.withColumns({c: rounded(c, 6) for c in ("TEMPERATURE", "NB_HAB")})


_ISO = """strftime("DATE_dt", '%Y-%m-%d') AS "DATE_dt\""""


@query("A17", _DAYS + f"SELECT * REPLACE ({_ISO}) FROM days")
def city_days(spark, folder):
    return _days(spark, folder).withColumn("DATE_dt", iso("DATE_dt"))


@query(
    "J11 A17",
    _DAYS
    + f"""SELECT * REPLACE ({_ISO}, round_even("LAT_degre", 5) AS "LAT_degre", round_even("LON_degre", 5) AS "LON_degre") FROM days
  WHERE ("CITY", "CN", "CN_NAME") NOT IN (SELECT ("CITY", "CN", "CN_NAME") FROM days WHERE "NB_HAB" IS NULL)""",
)
def days_with_population(spark, folder):
    return V.without_population_gaps(_days(spark, folder)).withColumn("DATE_dt", iso("DATE_dt"))


_COVERAGE = """SELECT "DATE_str_YEAR" AS "Annee", count("DATE_dt") AS nb_enreg, count(DISTINCT "DATE_str_MONTH") AS "nb_Mois",
  count(DISTINCT "CITY") AS "nb_City", count(DISTINCT "CN") AS "nb_CN" FROM raw GROUP BY 1"""


@query("A18", _RAW + _COVERAGE)
def yearly_coverage(spark, folder):
    return V.yearly_coverage(measurements(spark, folder))


def _run_sql(source: str, label: str, measure: str) -> str:
    return f"""SELECT '{measure}' AS variable, min(l) AS debut, max(l) AS fin, count(*) AS longueur FROM (
    SELECT l, position - row_number() OVER (ORDER BY position) AS island FROM (
      SELECT "{label}" AS l, row_number() OVER (ORDER BY "{label}") AS position,
        "{measure}" >= (SELECT median("{measure}") FROM ({source})) AS above FROM ({source})) WHERE above)
    GROUP BY island ORDER BY longueur DESC, debut LIMIT 1"""


@query(
    "W3 A18",
    _RAW
    + " UNION ALL ".join(
        f"SELECT * FROM ({_run_sql(_COVERAGE, 'Annee', m)})" for m in ("nb_enreg", "nb_City", "nb_CN")
    ),
)
def coverage_runs(spark, folder):
    return climate.coverage_runs(measurements(spark, folder))


@query(
    "W3",
    _run_sql("SELECT strftime(o_orderdate, '%Y-%m') AS mois, count(*) AS nb FROM orders GROUP BY 1", "mois", "nb"),
)
def longest_month_run(spark, folder):
    months = (
        table(spark, folder, "orders")
        .groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("mois"))
        .agg(F.count(F.lit(1)).alias("nb"))
    )
    return V.longest_run(months, "mois", "nb")


_CITY = '"CITY", "CN_NAME", "CN", "CAPITALE"'
_CITY_COVERAGE = f"""SELECT {_CITY}, min(y) AS "Annee_min", max(y) AS "Annee_max",
    count(*) FILTER (WHERE m = 12) AS nb_annee, CAST(sum(m) FILTER (WHERE m = 12) AS BIGINT) AS nb_mois,
    CAST(sum(n) FILTER (WHERE m = 12) AS BIGINT) AS nb_enreg
  FROM (SELECT {_CITY}, "DATE_str_YEAR" AS y, count(DISTINCT "DATE_str_MONTH") AS m, count("DATE_dt") AS n FROM raw
    WHERE "DATE_str_YEAR" BETWEEN '1995' AND '2000' GROUP BY ALL) GROUP BY ALL
  HAVING count(*) FILTER (WHERE m = 12) > 0"""


@query("A19", _RAW + _CITY_COVERAGE)
def city_year_coverage(spark, folder):
    return V.city_year_coverage(measurements(spark, folder), "1995", "2000")


_SELECTED = f"""SELECT * FROM ({_CITY_COVERAGE}) WHERE "Annee_min" = '1995' AND "Annee_max" = '2000' AND nb_annee >= 6
  AND nb_mois >= 72"""


@query("A20", _RAW + _SELECTED)
def selected_cities(spark, folder):
    coverage = V.city_year_coverage(measurements(spark, folder), "1995", "2000")
    return V.select_cities(coverage, "1995", "2000", years=6, months=72)


@query(
    "J12 A20",
    _RAW
    + f"""SELECT "CITY", "CN", {_ISO}, round_even("TEMPERATURE", 4) AS "TEMPERATURE" FROM raw
  WHERE "DATE_str_YEAR" BETWEEN '1995' AND '2000' AND ("CITY", "CN") IN (SELECT ("CITY", "CN") FROM ({_SELECTED}))""",
)
def selected_measurements(spark, folder):
    chosen = climate.selected_measurements(measurements(spark, folder), "1995", "2000", years=6, months=72)
    return chosen.select("CITY", "CN", iso("DATE_dt"), rounded("TEMPERATURE", 4))


@query(
    "W4",
    """WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
  SELECT event_id, value FROM events, q WHERE value > b + 1.5 * (b - a) OR value < a - 1.5 * (b - a)""",
)
def iqr_outliers(spark, folder):
    return Q.iqr_outliers(table(spark, folder, "events").select("event_id", "value"), "value")


@query(
    "W5",
    """SELECT o_orderkey, round_even((o_totalprice - m) / s, 6) AS zscore FROM orders,
  (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)""",
)
def zscores(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return Q.with_zscore(orders, "o_totalprice").select("o_orderkey", rounded("zscore", 6))


_LINES = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "W6",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, CAST({p} AS DOUBLE) AS probability,
  round_even(quantile_cont({c}, {p}), 4) AS value FROM lineitem"""
        for c in _LINES
        for p in (0.45, 0.5)
    ),
)
def reference_lines(spark, folder):
    lines = Q.reference_lines(table(spark, folder, "lineitem"), list(_LINES), [0.45, 0.5])
    return lines.withColumn("value", rounded("value", 4))


@query(
    "W6",
    """SELECT l_returnflag, round_even(quantile_cont(l_extendedprice, 0.25), 4) AS q25,
  round_even(quantile_cont(l_extendedprice, 0.5), 4) AS q50, round_even(quantile_cont(l_extendedprice, 0.75), 4) AS q75
  FROM lineitem GROUP BY 1""",
)
def group_quartiles(spark, folder):
    found = Q.quantiles(table(spark, folder, "lineitem"), "l_extendedprice", [0.25, 0.5, 0.75], by=["l_returnflag"])
    return found.select(
        "l_returnflag",
        *[F.rint(F.element_at("quantiles", i) * 10000).alias(f"q{p}") / 10000 for i, p in ((1, 25), (2, 50), (3, 75))],
    ).toDF("l_returnflag", "q25", "q50", "q75")


@query(
    "W6",
    "SELECT p_type, median(p_size) AS mediane FROM part GROUP BY 1",
)
def group_medians(spark, folder):
    """Median of a column with few distinct values."""
    found = Q.small_domain_quantiles(table(spark, folder, "part"), "p_size", [0.5], by=["p_type"])
    return found.select("p_type", F.element_at("quantiles", 1).alias("mediane"))
