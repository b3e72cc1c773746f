"""Cleaning, contracts, gates, repairs, ids and fixed classes on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, text
from ..functions.classes import harmonise, national_flag
from ..functions.numeric import haversine_km, round_even
from ..operators import cleaning as C
from ..operators.coverage import class_from_table, with_city_details, with_date_parts
from ..operators.positions import with_position
from ..operators.quantiles import with_quantile_class
from ..session import small_table
from .base import iso, rounded, table
from .registry import query


@query("P1", "SELECT p_partkey AS code, p_type AS genre, p_name AS nom FROM part")
def arranged_columns(spark, folder):
    part = table(spark, folder, "part").toDF(*[c.upper() for c in table(spark, folder, "part").columns])
    renamed = C.arranged(part, {"P_PARTKEY": "CODE", "P_NAME": "NOM", "P_TYPE": "GENRE"}, lower=True)
    return renamed.select("code", "genre", "nom")


@query(
    "P2",
    """SELECT s_suppkey, lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(3, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS code_3,
  lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(5, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS code_5 FROM supplier""",
)
def padded_codes(spark, folder):
    raw = F.concat(F.col("s_suppkey").cast("string"), F.lit(".0"))
    code = text.strip_decimal_suffix(raw)
    return table(spark, folder, "supplier").select(
        "s_suppkey", text.pad_code(code, 3).alias("code_3"), text.pad_code(code, 5).alias("code_5")
    )


@query(
    "P3",
    "SELECT doc_id, md5(translate(text, 'éèêîïôö', 'eeeiioo')) AS plain, upper(translate(source, 'é', 'e')) AS source FROM documents",
)
def folded_accents(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        F.md5(text.fold_accents(F.col("text"))).alias("plain"),
        F.upper(text.fold_accents(F.col("source"))).alias("source"),
    )


@query(
    "P4",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(year(o_orderdate) AS VARCHAR) END AS annee,
  CAST(o_custkey AS VARCHAR) AS population FROM orders""",
)
def parenthesised_years(spark, folder):
    note = F.when(F.col("o_orderstatus") == "P", " (rec.)").otherwise(
        F.concat(F.lit(" ("), F.year("o_orderdate").cast("string"), F.lit(")"))
    )
    value = F.concat(F.col("o_custkey").cast("string"), note)
    return table(spark, folder, "orders").select(
        "o_orderkey", text.parenthesised_year(value).alias("annee"), text.drop_parentheses(value).alias("population")
    )


@query(
    "P5 P6",
    """SELECT n_nationkey, CASE n_nationkey WHEN 3 THEN 'PARIS' WHEN 5 THEN 'LYON' ELSE n_name END AS n_name,
  CASE n_nationkey WHEN 3 THEN 48.86 WHEN 5 THEN 45.75 WHEN 7 THEN 43.3 ELSE 0.0 END::DOUBLE AS latitude, n_regionkey
  FROM nation""",
)
def keyed_overrides(spark, folder):
    nation = table(spark, folder, "nation").withColumn("latitude", F.lit(0.0))
    fixed = small_table(
        spark, [(3, "PARIS", 48.86), (5, "LYON", 45.75), (7, None, 43.3)], "n_nationkey int, n_name string, latitude double"
    )
    return C.with_overrides(nation, "n_nationkey", fixed)


@query(
    "P7 A31",
    """SELECT CASE WHEN event_type IN ('view', 'click') THEN 'visit' ELSE event_type END AS event_type, count(*) AS nb
  FROM events GROUP BY 1""",
)
def harmonised_events(spark, folder):
    kind = harmonise(F.col("event_type"), {"view": "visit", "click": "visit"})
    return table(spark, folder, "events").groupBy(kind.alias("event_type")).agg(F.count(F.lit(1)).alias("nb"))


@query(
    "P8",
    """SELECT p_partkey, CAST(replace(p_brand, 'Brand#', '') AS DOUBLE) AS brand FROM part
  WHERE p_brand NOT IN ('Brand#13', 'Brand#7')""",
)
def numbers_without_sentinels(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey", F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("brand")
    )
    return C.to_number(part, "brand", ["13", "7"])


@query(
    "P9",
    """SELECT o_orderkey, c_name, c_mktsegment FROM orders
  LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
  WHERE c_name IS NOT NULL AND c_mktsegment IS NOT NULL AND o_orderpriority <> '5-LOW'""",
)
def complete_rows(spark, folder):
    solvent = table(spark, folder, "customer").where("c_acctbal > 0")
    joined = table(spark, folder, "orders").join(solvent, F.col("o_custkey") == F.col("c_custkey"), "left")
    complete = C.complete_rows(joined, ["c_name", "c_mktsegment"], {"o_orderpriority": "5-LOW"})
    return complete.select("o_orderkey", "c_name", "c_mktsegment")


_CUSTOMER_RULES = [
    C.Rule("c_name", pattern=r"^Customer#\d*[02468]$"),
    C.Rule("c_mktsegment", allowed=("BUILDING", "FURNITURE", "HOUSEHOLD")),
    C.Rule("balance"),
    C.Rule("country", default="FRANCE"),
]


def _customer_records(spark, folder):
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    country = F.when(F.col("c_nationkey") > 3, F.col("c_nationkey").cast("string"))
    return table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", balance.alias("balance"), country.alias("country")
    )


def _customers(spark, folder):
    return C.with_contract(_customer_records(spark, folder), _CUSTOMER_RULES)


_CHECKED_CUSTOMERS = """WITH checked AS (SELECT c_custkey, CASE WHEN c_nationkey > 3 THEN CAST(c_nationkey AS VARCHAR)
    ELSE 'FRANCE' END AS country,
  NOT regexp_matches(c_name, '^Customer#[0-9]*[02468]$') AS e1,
  c_mktsegment NOT IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD') AS e2, c_acctbal < 0 AS e3 FROM customer) """


@query("P10", _CHECKED_CUSTOMERS + "SELECT c_custkey, country FROM checked WHERE NOT (e1 OR e2 OR e3)")
def contract_valid_rows(spark, folder):
    return C.valid_rows(_customer_records(spark, folder), _CUSTOMER_RULES).select("c_custkey", "country")


@query(
    "P10",
    _CHECKED_CUSTOMERS
    + """SELECT c_custkey, CAST(e1::INT + e2::INT + e3::INT AS INTEGER) AS nb, concat_ws(',',
  CASE WHEN e1 THEN 'c_name:string_pattern_mismatch' END, CASE WHEN e2 THEN 'c_mktsegment:literal_error' END,
  CASE WHEN e3 THEN 'balance:missing' END) AS detail FROM checked WHERE e1 OR e2 OR e3""",
)
def contract_rejected_rows(spark, folder):
    labels = F.transform("erreurs", lambda e: F.concat(e["champ"], F.lit(":"), e["type"]))
    return C.rejected_rows(_customers(spark, folder)).select(
        "c_custkey", F.size("erreurs").alias("nb"), F.array_join(labels, ",").alias("detail")
    )


@query(
    "A28 P10",
    _CHECKED_CUSTOMERS
    + """SELECT * FROM (SELECT 'c_name' AS champ, count(*) FILTER (WHERE e1) AS nb_erreurs FROM checked
  UNION ALL SELECT 'c_mktsegment', count(*) FILTER (WHERE e2) FROM checked
  UNION ALL SELECT 'balance', count(*) FILTER (WHERE e3) FROM checked)""",
)
def contract_error_counts(spark, folder):
    return C.error_counts(_customers(spark, folder))


_DATE_TEXT = """CASE WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%Y%m') || '00'
  WHEN o_orderkey % 11 = 0 THEN strftime(o_orderdate, '%Y') || '0015' WHEN o_orderkey % 13 = 0 THEN '00000101'
  ELSE strftime(o_orderdate, '%Y%m%d') END"""


def _date_text():
    day = F.col("o_orderdate")
    return (
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.date_format(day, "yyyyMM"), F.lit("00")))
        .when(F.col("o_orderkey") % 11 == 0, F.concat(F.date_format(day, "yyyy"), F.lit("0015")))
        .when(F.col("o_orderkey") % 13 == 0, F.lit("00000101"))
        .otherwise(F.date_format(day, "yyyyMMdd"))
    )


@query(
    "P11",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN 'ko'
    ELSE 'ok' END AS zero, CASE WHEN substr(d, 1, 4) <> '1997' THEN 'ko' ELSE 'ok' END AS year_1997, 'ok' AS year_any
  FROM (SELECT o_orderkey, {_DATE_TEXT} AS d FROM orders)""",
)
def date_flags(spark, folder):
    d = F.col("d")
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", _date_text().alias("d"))
        .select(
            "o_orderkey",
            dates.zero_part_flag(d).alias("zero"),
            dates.file_year_flag(d, "1997").alias("year_1997"),
            dates.file_year_flag(d, "0000").alias("year_any"),
        )
    )


_GATED = """WITH e AS (SELECT *, user_id % 40 = 0 AS f0, event_type = 'error' AS f1, value < 0.5 AS f2 FROM events),
  r0 AS (SELECT round_even(100.0 * count(*) FILTER (WHERE f0) / count(*), 2) AS r FROM e),
  g0 AS (SELECT * FROM e WHERE NOT f0 OR (SELECT r FROM r0) >= 5),
  r1 AS (SELECT round_even(100.0 * count(*) FILTER (WHERE f1) / count(*), 2) AS r FROM g0),
  g1 AS (SELECT * FROM g0 WHERE NOT f1 OR (SELECT r FROM r1) >= 5),
  r2 AS (SELECT round_even(100.0 * count(*) FILTER (WHERE f2) / count(*), 2) AS r FROM g1),
  g2 AS (SELECT * FROM g1 WHERE NOT f2 OR (SELECT r FROM r2) >= 5) """


def _event_flags():
    def flag(condition):
        return F.when(condition, "ko").otherwise("ok")

    return [flag(F.col("user_id") % 40 == 0), flag(F.col("event_type") == "error"), flag(F.col("value") < 0.5)]


@query("P12", _GATED + "SELECT event_id, event_type, value FROM g2")
def gated_rows(spark, folder):
    """Three gates: some flags are rare enough to be removed, one is not."""
    kept = C.through_gates(table(spark, folder, "events"), _event_flags(), "event_id")
    return kept.select("event_id", "event_type", "value")


@query(
    "P12",
    _GATED
    + """SELECT r0.r AS taux_0, r1.r AS taux_1, r2.r AS taux_2, r0.r < 5 AS retire_0, r1.r < 5 AS retire_1,
  r2.r < 5 AS retire_2 FROM r0, r1, r2""",
)
def gate_rates(spark, folder):
    return C.gate_decisions(table(spark, folder, "events"), _event_flags(), "event_id")


@query(
    "P13",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 1) THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders""",
)
def lenient_dates(spark, folder):
    """Dates outside the range and impossible days become null."""
    given = (
        F.when(F.col("o_orderkey") % 5 == 0, "16450513")
        .when(F.col("o_orderkey") % 5 == 1, "19950230")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    return table(spark, folder, "orders").select("o_orderkey", dates.lenient_date(given).alias("d")).select("o_orderkey", iso("d"))


_PLAIN_LINES = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_suppkey"]


@query("P14", f"SELECT DISTINCT {', '.join(_PLAIN_LINES)} FROM lineitem")
def distinct_rows(spark, folder):
    return table(spark, folder, "lineitem").select(*_PLAIN_LINES).dropDuplicates()


@query(
    "P14",
    f"SELECT {', '.join(_PLAIN_LINES)}, count(*) - 1 AS nb_doublons FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_report(spark, folder):
    return C.duplicate_report(table(spark, folder, "lineitem").select(*_PLAIN_LINES))


@query(
    "P15",
    """SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k = 1""",
)
def first_per_key(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    first = C.first_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.withColumn("o_orderdate", iso("o_orderdate"))


_BEGINNINGS = ["DEPARTEMENT ", "ANCIEN ", "SUD ", "ANCIENNE ", ""]
_ENDINGS = [word for _, words, _, _ in C.BIRTH_PLACE_RULES for word in words] + ["NIGERIA", "LYON"]


def _picked_sql(words: list[str], number: str) -> str:
    listed = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
    return f"list_extract([{listed}], CAST({number} % {len(words)} + 1 AS BIGINT))"


def _repair_sql(target: int, default: str) -> str:
    def mentions(words):
        return "(" + " OR ".join(f"contains(ville, '{w}')" for w in words) + ")"

    cases = " ".join(
        f"WHEN {mentions(a)} AND {mentions(b)} THEN '{(country, code)[target].replace(chr(39), chr(39) * 2)}'"
        for a, b, country, code in reversed(C.BIRTH_PLACE_RULES)
    )
    return f"CASE {cases} ELSE {default} END"


@query(
    "P16",
    f"""SELECT p_partkey, ville, {_repair_sql(0, "'FRANCE'")} AS pays, {_repair_sql(1, "'00000'")} AS code
  FROM (SELECT p_partkey, {_picked_sql(_BEGINNINGS, "p_size")} || {_picked_sql(_ENDINGS, "p_partkey")} AS ville FROM part)""",
)
def repaired_places(spark, folder):
    def picked(words, number):
        return F.element_at(F.array(*[F.lit(w) for w in words]), (number % len(words) + 1).cast("int"))

    cities = table(spark, folder, "part").select(
        "p_partkey",
        F.concat(picked(_BEGINNINGS, F.col("p_size")), picked(_ENDINGS, F.col("p_partkey"))).alias("ville"),
        F.lit("FRANCE").alias("pays"),
        F.lit("00000").alias("code"),
    )
    return C.repaired_places(cities, city="ville", country="pays", code="code")


@query(
    "P17 J10",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(greatest(floor(
    (CAST(l_shipdate AS DATE) - (CAST(o_orderdate AS DATE) - CAST(l_quantity * 500 AS INTEGER))) / 365), 0) AS INTEGER) AS age
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def ages(spark, folder):
    born = F.date_sub(F.col("o_orderdate").cast("date"), (F.col("l_quantity") * 500).cast("int"))
    return (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            dates.age_in_years(born, F.col("l_shipdate").cast("date")).alias("age"),
        )
    )


@query(
    "P18 X1",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS annee, CAST(year(o_orderdate) * 10000000000
    + row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS idligne
  FROM orders""",
)
def yearly_ids(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderdate", F.year("o_orderdate").cast("string").alias("annee")
    )
    return C.with_yearly_ids(orders, "annee", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "X1",
    """SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber,
  l_partkey) AS position FROM lineitem""",
)
def global_positions(spark, folder):
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"]
    return with_position(table(spark, folder, "lineitem").select(*order), order).drop("l_extendedprice")


@query(
    "P20",
    """SELECT p_partkey, CAST(coalesce(r_regionkey + 1, 0) AS INTEGER) AS classe FROM part LEFT JOIN region
  ON p_size > r_regionkey * 10 AND p_size <= r_regionkey * 10 + 8""",
)
def classes_from_table(spark, folder):
    ranges = table(spark, folder, "region").select(
        (F.col("r_regionkey") + 1).alias("la_borne"),
        (F.col("r_regionkey") * 10).alias("borne_inf_strict"),
        (F.col("r_regionkey") * 10 + 8).alias("borne_sup_egale"),
    )
    return class_from_table(table(spark, folder, "part"), "p_size", ranges).select("p_partkey", "classe")


def _thousands(value: str) -> str:
    return f"replace(format('{{:,}}', CAST(round_even({value}, 0) AS BIGINT)), ',', ' ')"


@query(
    "P21",
    f"""WITH q AS (SELECT quantile_cont(l_extendedprice, [0, 1/3.0, 2/3.0, 1]) AS e FROM lineitem)
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(k AS INTEGER) AS classe_ordre,
    ']' || {_thousands("e[k]")} || ',' || {_thousands("e[k + 1]")} || ']' AS classe
  FROM (SELECT *, CASE WHEN l_extendedprice <= e[2] THEN 1 WHEN l_extendedprice <= e[3] THEN 2 ELSE 3 END AS k
    FROM lineitem, q)""",
)
def quantile_classes(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return with_quantile_class(lines, "l_extendedprice", 3, "classe").drop("l_extendedprice")


@query(
    "P23 P24",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS "DATE_dt", strftime(o_orderdate, '%Y') AS "DATE_str_YEAR",
  strftime(o_orderdate, '%m') AS "DATE_str_MONTH", strftime(o_orderdate, '%d') AS "DATE_str_DAY",
  round_even(o_totalprice * 0.1, 4) AS "TEMPERATURE", CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'hiver'
    WHEN month(o_orderdate) IN (3, 4, 5) THEN 'printemps' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'ete'
    ELSE 'automne' END AS "Saison" FROM orders""",
)
def date_parts(spark, folder):
    raw = table(spark, folder, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("DATE"),
        F.col("o_totalprice").alias("TX"),
    )
    parts = with_date_parts(raw).drop("DATE", "TX")
    return parts.withColumns({"TEMPERATURE": rounded("TEMPERATURE", 4), "DATE_dt": iso("DATE_dt")})


@query(
    "P25 J16",
    """SELECT c_custkey, round_even(CASE WHEN d < 0 THEN d - m / 60.0 - s / 3600.0 ELSE d + m / 60.0 + s / 3600.0 END, 4)
    AS "LAT_degre", round_even(k % 90 + m / 60.0 + s / 3600.0, 4) AS "LON_degre", CASE k % 3 WHEN 0 THEN 'France'
    WHEN 1 THEN 'Italie' ELSE 'inconnu' END AS "CN_NAME",
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'O' ELSE 'N' END AS "CAPITALE"
  FROM (SELECT *, c_custkey AS k, CAST(c_custkey % 120 - 60 AS DOUBLE) AS d, c_custkey % 60 AS m, c_custkey % 47 AS s
    FROM customer)""",
)
def city_details(spark, folder):
    """Degrees and lookups; half of the latitudes are negative."""
    k = F.col("c_custkey")

    def dms(degrees):
        return F.concat_ws(":", degrees.cast("string"), (k % 60).cast("string"), (k % 47).cast("string"))

    country = F.when(k % 3 == 0, "FR").when(k % 3 == 1, "IT").otherwise("??")
    raw = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", "PARIS").otherwise(F.col("c_mktsegment")).alias("CITY"),
        country.alias("CN"),
        dms(k % 120 - 60).alias("LAT"),
        dms(k % 90).alias("LON"),
    )
    return with_city_details(raw).select("c_custkey", "LAT_degre", "LON_degre", "CN_NAME", "CAPITALE")


@query(
    "P26",
    """SELECT event_id, CAST(trunc(h) AS INTEGER) AS heure,
  CAST(CAST(trunc(h) AS INTEGER) AS VARCHAR) || 'h' || CAST(CAST(trunc((h - trunc(h)) * 60) AS INTEGER) AS VARCHAR) AS texte
  FROM (SELECT event_id, (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 86400.0::DOUBLE * 24 AS h FROM events)""",
)
def clock_labels(spark, folder):
    fraction = (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")) / F.lit(86400.0)
    return table(spark, folder, "events").select(
        "event_id", text.clock_hour(fraction).alias("heure"), text.clock_label(fraction).alias("texte")
    )


@query(
    "P27 P28",
    """SELECT o_orderkey, CASE WHEN n_name = 'NATION_6' THEN 'O' ELSE 'N' END AS origine_nationale,
  strftime(o_orderdate, '%b') AS month_deces, CAST(day(o_orderdate) AS INTEGER) AS day_deces
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def national_flags(spark, folder):
    placed = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return (
        table(spark, folder, "orders")
        .join(placed, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "o_orderkey",
            national_flag(F.col("n_name"), home="NATION_6").alias("origine_nationale"),
            dates.month_label(F.col("o_orderdate")).alias("month_deces"),
            F.dayofmonth("o_orderdate").alias("day_deces"),
        )
    )


@query(
    "P29",
    """SELECT c_custkey, round_even(2 * 6371 * asin(least(sqrt(power(sin((radians(b1) - radians(a1)) / 2), 2)
    + cos(radians(a1)) * cos(radians(b1)) * power(sin((radians(b2) - radians(a2)) / 2), 2)), 1.0)), 0) AS distance
  FROM (SELECT c_custkey, CAST((c_custkey * 37) % 140 - 70 AS DOUBLE) AS a1, CAST((c_custkey * 53) % 360 - 180 AS DOUBLE) AS a2,
    CAST((c_nationkey * 11) % 140 - 70 AS DOUBLE) AS b1, CAST((c_nationkey * 17) % 360 - 180 AS DOUBLE) AS b2 FROM customer)""",
)
def distances(spark, folder):
    k, n = F.col("c_custkey"), F.col("c_nationkey")

    def coordinate(key, factor, span):
        return ((key * factor) % span - span / 2).cast("double")

    km = haversine_km(coordinate(k, 37, 140), coordinate(k, 53, 360), coordinate(n, 11, 140), coordinate(n, 17, 360))
    return table(spark, folder, "customer").select("c_custkey", round_even(km).alias("distance"))


@query(
    "P35 A1",
    """SELECT event_type, count(*) AS nb, round_even(avg(value), 4) AS moyenne FROM events
  WHERE value < 100 AND ts >= TIMESTAMP '2024-01-10' GROUP BY event_type""",
)
def filtered_by_category(spark, folder):
    """The subset of every category in one grouping instead of one pass per category."""
    chosen = table(spark, folder, "events").where((F.col("value") < 100) & (F.col("ts") >= "2024-01-10"))
    return chosen.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("nb"), round_even(F.avg("value"), 4).alias("moyenne")
    )


@query(
    "K2",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def load_types(spark, folder):
    orders = table(spark, folder, "orders").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 10 == 0, float("nan")).otherwise(F.col("o_totalprice"))
    )
    loaded = C.load_types(orders, drop=["o_custkey", "o_orderstatus", "o_orderpriority", "absent"])
    return loaded.withColumn("o_orderdate", iso("o_orderdate"))
