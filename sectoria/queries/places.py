"""Place lists, code chains and the lookup of persons' places."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import places as L
from ..operators.summaries import distinct_values, top_groups
from ..sources.tables import publish_view, read_table, replace_table
from .base import table
from .registry import query


def _code(key, width=5):
    return F.lpad(key.cast("string"), width, "0")


def _lists(spark, folder):
    """Customers as main list, suppliers as yearly list; the keys overlap in part."""
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    main = table(spark, folder, "customer").select(
        _code(k, 9).alias("num_insee"),
        F.col("c_name").alias("nom_commune_postal"),
        F.when(k % 4 > 0, _code(k % 1000)).alias("code_postal"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("latitude"),
        F.col("c_acctbal").alias("longitude"),
        (k % 100).cast("string").alias("code_commune"),
        F.when(k % 3 > 0, F.when(k % 3 == 1, "098").otherwise(_code(F.col("c_nationkey"), 3))).alias(
            "code_departement"
        ),
        F.col("c_mktsegment").alias("nom_departement"),
        F.when(k % 5 > 0, (k % 5).cast("string")).alias("code_region"),
        F.when(k % 7 > 0, F.concat(F.lit("R"), (k % 7).cast("string"))).alias("nom_region"),
    )
    yearly = table(spark, folder, "supplier").select(
        _code(s * 20, 9).alias("num_insee"),
        F.col("s_name").alias("nom_commune"),
        F.col("s_acctbal").alias("latitude"),
        F.lit(0.0).alias("longitude"),
        F.lit("SC").alias("code_commune"),
        F.when(s % 2 == 0, "S2").alias("code_departement"),
        F.lit("SUP").alias("nom_departement"),
        F.when(s % 2 == 1, "SR").alias("code_region"),
        F.lit("REGION").alias("nom_region"),
    )
    return main, yearly


_LISTS = """WITH main AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS num_insee, c_name AS nom_commune_postal,
    CASE WHEN c_custkey % 4 > 0 THEN lpad(CAST(c_custkey % 1000 AS VARCHAR), 5, '0') END AS code_postal,
    CASE WHEN c_acctbal > 0 THEN c_acctbal END AS latitude, c_acctbal AS longitude,
    CAST(c_custkey % 100 AS VARCHAR) AS code_commune,
    CASE c_custkey % 3 WHEN 1 THEN '098' WHEN 2 THEN lpad(CAST(c_nationkey AS VARCHAR), 3, '0') END AS code_departement,
    c_mktsegment AS nom_departement, CASE WHEN c_custkey % 5 > 0 THEN CAST(c_custkey % 5 AS VARCHAR) END AS code_region,
    CASE WHEN c_custkey % 7 > 0 THEN 'R' || CAST(c_custkey % 7 AS VARCHAR) END AS nom_region FROM customer),
  yearly AS (SELECT lpad(CAST(s_suppkey * 20 AS VARCHAR), 9, '0') AS num_insee, s_name AS nom_commune,
    s_acctbal AS latitude, 0.0::DOUBLE AS longitude, 'SC' AS code_commune,
    CASE WHEN s_suppkey % 2 = 0 THEN 'S2' END AS code_departement, 'SUP' AS nom_departement,
    CASE WHEN s_suppkey % 2 = 1 THEN 'SR' END AS code_region, 'REGION' AS nom_region FROM supplier),
  merged AS (SELECT coalesce(m.num_insee, y.num_insee) AS num_insee,
    coalesce(m.nom_commune_postal, y.nom_commune) AS nom_commune_postal, coalesce(m.code_postal, '') AS code_postal,
    coalesce(m.latitude, y.latitude) AS latitude, coalesce(m.longitude, y.longitude) AS longitude,
    coalesce(m.code_commune, y.code_commune) AS code_commune,
    coalesce(m.code_departement, y.code_departement, '') AS code_departement,
    coalesce(m.nom_departement, y.nom_departement) AS nom_departement,
    coalesce(m.code_region, y.code_region, '') AS code_region, coalesce(m.nom_region, y.nom_region) AS nom_region
    FROM yearly y FULL OUTER JOIN main m ON m.num_insee = y.num_insee)
"""


@query("J1", _LISTS + "SELECT * FROM merged")
def merged_place_lists(spark, folder):
    return L.merge_place_lists(*_lists(spark, folder))


def _merged(spark, folder):
    main, yearly = _lists(spark, folder)
    return L.merge_place_lists(main.withColumn("code_departement", F.coalesce("code_departement", F.lit("nan"))), yearly)


def _places(spark, folder, merged=None):
    o, c = F.col("n_nationkey"), F.col("r_regionkey")
    overseas = table(spark, folder, "nation").select(
        _code(o * 999, 9).alias("num_insee"),
        F.col("n_name").alias("commune"),
        F.lit("OUTRE-MER").alias("nom_departement"),
        F.lit("OUTRE-MER").alias("nom_region"),
        F.lit(-21.123889).alias("latitude"),
        F.lit(165.846901).alias("longitude"),
    )
    countries = table(spark, folder, "region").select(
        F.concat(F.lit("99"), _code(c, 7)).alias("num_insee"),
        F.lower("r_name").alias("nom_pays_fr"),
        c.cast("double").alias("latitude"),
        (-c).cast("double").alias("longitude"),
    )
    return L.all_places(_merged(spark, folder) if merged is None else merged, overseas, countries)


_PLACES = (
    _LISTS.replace("  merged AS", "  nan_main AS (SELECT * REPLACE (coalesce(code_departement, 'nan') AS code_departement) FROM main),\n  merged AS").replace(
        "FULL OUTER JOIN main m", "FULL OUTER JOIN nan_main m"
    )
    + """, overseas AS (SELECT lpad(CAST(n_nationkey * 999 AS VARCHAR), 9, '0') AS num_insee, n_name AS commune FROM nation),
  countries AS (SELECT '99' || lpad(CAST(r_regionkey AS VARCHAR), 7, '0') AS num_insee, lower(r_name) AS nom_pays_fr,
    CAST(r_regionkey AS DOUBLE) AS latitude, CAST(-r_regionkey AS DOUBLE) AS longitude FROM region),
  step AS (SELECT DISTINCT coalesce(m.num_insee, o.num_insee) AS num_insee,
    coalesce(m.nom_commune_postal, o.commune) AS nom_commune_postal,
    CASE WHEN m.num_insee IS NULL THEN 'OUTRE-MER' ELSE coalesce(m.nom_departement, CASE WHEN o.num_insee IS NOT NULL THEN 'OUTRE-MER' END) END AS nom_departement,
    CASE WHEN m.nom_region IS NULL AND o.num_insee IS NOT NULL THEN 'OUTRE-MER' ELSE m.nom_region END AS nom_region,
    CASE WHEN m.latitude IS NULL AND o.num_insee IS NOT NULL THEN -21.123889 ELSE m.latitude END AS latitude,
    CASE WHEN m.longitude IS NULL AND o.num_insee IS NOT NULL THEN 165.846901 ELSE m.longitude END AS longitude,
    CASE WHEN m.code_departement IN ('nan', '098') THEN '988' ELSE m.code_departement END AS code_departement,
    CASE WHEN m.code_region = 'nan' THEN '98' ELSE m.code_region END AS code_region
    FROM overseas o FULL OUTER JOIN merged m ON o.num_insee = m.num_insee),
  places AS (SELECT DISTINCT coalesce(s.num_insee, p.num_insee) AS num_insee,
    coalesce(s.nom_commune_postal, p.nom_pays_fr) AS nom_commune_postal,
    coalesce(s.nom_departement, p.nom_pays_fr) AS nom_departement, coalesce(s.nom_region, p.nom_pays_fr) AS nom_region,
    coalesce(s.latitude, p.latitude) AS latitude, coalesce(s.longitude, p.longitude) AS longitude,
    s.code_departement, s.code_region FROM countries p FULL OUTER JOIN step s ON s.num_insee = p.num_insee)
"""
)


@query("J2 U2", _PLACES + "SELECT * FROM places")
def all_places(spark, folder):
    return _places(spark, folder)


def _changes(spark, folder):
    """Each part's code becomes that of half its key; some go back, which closes a cycle."""
    k = F.col("p_partkey")
    half = F.floor(k / 2).cast("bigint")
    back = F.struct(half.alias("a"), k.alias("b"), F.concat(F.lit("retour "), "p_name").alias("n"))
    forth = F.struct(k.alias("a"), half.alias("b"), F.col("p_name").alias("n"))
    edges = F.when(k % 97 == 0, F.array(forth, back)).otherwise(F.array(forth))
    return (
        table(spark, folder, "part")
        .select(F.explode(edges).alias("e"))
        .select(
            _code(F.col("e.a"), 9).alias("num_insee_avant"),
            F.col("e.n").alias("nom_commune_en_clair_avant"),
            _code(F.col("e.b"), 9).alias("num_insee_apres"),
            F.upper("e.n").alias("nom_commune_en_clair_apres"),
        )
    )


def _chains_sql(depth: str = "") -> str:
    """``depth`` limits the number of changes."""
    return f"""edges AS (SELECT DISTINCT lpad(CAST(a AS VARCHAR), 9, '0') AS avant, n AS nom_avant,
    lpad(CAST(b AS VARCHAR), 9, '0') AS apres, upper(n) AS nom_apres FROM (
    SELECT p_partkey AS a, p_partkey // 2 AS b, p_name AS n FROM part
    UNION ALL SELECT p_partkey // 2, p_partkey, 'retour ' || p_name FROM part WHERE p_partkey % 97 = 0)),
  chains AS (SELECT avant AS origine, nom_avant AS nom_origine, apres AS actuel, nom_apres AS nom_actuel, 1 AS niveau,
      [avant, apres] AS chemin FROM edges
    UNION ALL SELECT c.origine, c.nom_origine, e.apres, e.nom_apres, c.niveau + 1, list_append(c.chemin, e.apres)
      FROM chains c JOIN edges e ON e.avant = c.actuel WHERE {depth} NOT list_contains(c.chemin, e.apres)),
  latest AS (SELECT origine AS num_insee_invalide, nom_origine AS nom_invalide, actuel AS num_insee_valide,
      nom_actuel AS nom_valide FROM (SELECT *, row_number() OVER (PARTITION BY origine
        ORDER BY niveau DESC, actuel, nom_actuel, nom_origine) AS k FROM chains) WHERE k = 1)
"""


_CHAINS = _chains_sql()


@query(
    "J3 U2",
    f"WITH RECURSIVE {_CHAINS} SELECT DISTINCT * REPLACE (array_to_string(chemin, '>') AS chemin) FROM chains",
)
def code_chains(spark, folder):
    chains = L.code_chains(_changes(spark, folder))
    return chains.withColumn("chemin", F.array_join("chemin", ">"))


@query("J3", f"WITH RECURSIVE {_chains_sql('c.niveau < 5 AND')} SELECT DISTINCT * REPLACE (array_to_string(chemin, '>') AS chemin) FROM chains")
def code_chains_of_five(spark, folder):
    """The bound of five changes that the analysed scripts set."""
    chains = L.code_chains(_changes(spark, folder), max_depth=5)
    return chains.withColumn("chemin", F.array_join("chemin", ">"))


@query("J4 J3", f"WITH RECURSIVE {_CHAINS} SELECT * FROM latest")
def latest_codes(spark, folder):
    return L.latest_of_changes(_changes(spark, folder))


_SEARCH = (
    _PLACES.replace("WITH main", "WITH RECURSIVE main")
    + ", "
    + _CHAINS
    + """, codes AS (SELECT coalesce(num_insee, num_insee_invalide) AS num_insee_search,
    coalesce(num_insee, num_insee_valide) AS num_insee_valide, coalesce(nom_commune_postal, nom_valide) AS commune_valide,
    CASE WHEN num_insee IS NULL THEN 'PR' ELSE 'MV' END AS origine
    FROM places FULL OUTER JOIN latest ON num_insee = num_insee_invalide)
  SELECT num_insee_search, num_insee_valide, upper(commune_valide) AS commune_valide, origine, latitude, longitude,
    code_departement, upper(nom_departement) AS nom_departement, code_region, upper(nom_region) AS nom_region
  FROM codes LEFT JOIN places ON num_insee_valide = num_insee"""
)


@query("J5 K4", _SEARCH)
def search_table(spark, folder):
    return L.search_table(_places(spark, folder), L.latest_of_changes(_changes(spark, folder)))


@query("K1 K4 S10 J1 J2 J5", _SEARCH)
def table_chain(spark, folder):
    """The search table as a chain of stored tables and a view, each read from the ones before; one is rebuilt from itself."""
    replace_table(_merged(spark, folder), "listes_fusionnees")
    replace_table(_places(spark, folder, spark.table("listes_fusionnees")), "lieux")
    replace_table(spark.table("lieux").where("num_insee IS NOT NULL"), "lieux")
    replace_table(L.latest_of_changes(_changes(spark, folder)), "codes_actuels")
    publish_view(L.search_table(spark.table("lieux"), spark.table("codes_actuels")), "recherche")
    return read_table(spark, "recherche", L.SEARCH_COLUMNS)


def _facts(spark, folder):
    """Order lines with a birth code (supplier) and a death code (customer)."""

    def code(nation, key):
        district = F.when(F.col(key) % 11 == 0, F.lit(99)).otherwise(F.col(key) % 5)
        return F.concat(F.when(F.col(nation) == 24, "99").otherwise("00"), _code(F.col(nation) * 100 + district))

    births = table(spark, folder, "supplier").select("s_suppkey", code("s_nationkey", "s_suppkey").alias("b"))
    deaths = table(spark, folder, "customer").select("c_custkey", code("c_nationkey", "c_custkey").alias("d"))
    orders = table(spark, folder, "orders").join(deaths, F.col("o_custkey") == F.col("c_custkey"))
    return (
        table(spark, folder, "lineitem")
        .join(births, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("idligne"),
            F.col("b").alias("num_insee_naissance"),
            F.lit("INCONNUE").alias("ville_naissance"),
            F.concat(F.lit("PAYS "), F.substring("b", 1, 4)).alias("pays_naissance"),
            F.col("d").alias("num_insee_deces"),
            F.lit("").alias("ville_deces"),
        )
    )


def _search(spark, folder):
    """Several places per code: one per customer of the code."""
    nation, k = F.col("c_nationkey"), F.col("c_custkey")
    code = F.concat(F.when(nation == 24, "99").otherwise("00"), _code(nation * 100 + k % 5))
    return table(spark, folder, "customer").select(
        code.alias("num_insee_search"),
        F.concat(code, F.when(k % 2 == 0, "x").otherwise("")).alias("num_insee_valide"),
        F.col("c_name").alias("commune_valide"),
        F.lit("MV").alias("origine"),
        F.col("c_acctbal").alias("latitude"),
        (-F.col("c_acctbal")).alias("longitude"),
        nation.cast("string").alias("code_departement"),
        F.when(nation % 6 > 0, F.concat(F.lit("D"), nation.cast("string"))).alias("nom_departement"),
        (nation % 5).cast("string").alias("code_region"),
        F.when(nation % 7 > 0, F.concat(F.lit("R"), (nation % 5).cast("string"))).alias("nom_region"),
    )


def _located_sql(lookup: str) -> str:
    def code(nation: str, key: str) -> str:
        return f"""CASE WHEN {nation} = 24 THEN '99' ELSE '00' END
      || lpad(CAST({nation} * 100 + CASE WHEN {key} % 11 = 0 THEN 99 ELSE {key} % 5 END AS VARCHAR), 5, '0')"""

    def side(name: str, alias: str, fallback: str) -> str:
        return f"""coalesce({alias}.num_insee_valide, f.num_insee_{name}) AS num_insee_{name},
      coalesce({alias}.commune_valide, '{fallback}') AS ville_{name}, {alias}.latitude AS latitude_{name},
      {alias}.longitude AS longitude_{name}, {alias}.code_departement AS code_departement_{name},
      {alias}.nom_departement AS nom_departement_{name}, {alias}.code_region AS code_region_{name},
      {alias}.nom_region AS nom_region_{name}"""

    return f"""WITH facts AS (SELECT l_orderkey * 10 + l_linenumber AS idligne,
    {code("s_nationkey", "s_suppkey")} AS num_insee_naissance, {code("c_nationkey", "c_custkey")} AS num_insee_deces
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey),
  search AS (SELECT CASE WHEN c_nationkey = 24 THEN '99' ELSE '00' END
      || lpad(CAST(c_nationkey * 100 + c_custkey % 5 AS VARCHAR), 5, '0') AS num_insee_search,
    CASE WHEN c_nationkey = 24 THEN '99' ELSE '00' END || lpad(CAST(c_nationkey * 100 + c_custkey % 5 AS VARCHAR), 5, '0')
      || CASE WHEN c_custkey % 2 = 0 THEN 'x' ELSE '' END AS num_insee_valide,
    c_name AS commune_valide, c_acctbal AS latitude, -c_acctbal AS longitude, CAST(c_nationkey AS VARCHAR) AS code_departement,
    CASE WHEN c_nationkey % 6 > 0 THEN 'D' || CAST(c_nationkey AS VARCHAR) END AS nom_departement,
    CAST(c_nationkey % 5 AS VARCHAR) AS code_region,
    CASE WHEN c_nationkey % 7 > 0 THEN 'R' || CAST(c_nationkey % 5 AS VARCHAR) END AS nom_region FROM customer),
  lookup AS ({lookup}),
  located AS (SELECT *, CASE WHEN ville_naissance = ville_deces THEN 'O' ELSE 'N' END AS origine_ville,
    CASE WHEN nom_departement_naissance = nom_departement_deces THEN 'O' ELSE 'N' END AS origine_departement,
    CASE WHEN nom_region_naissance = nom_region_deces THEN 'O' ELSE 'N' END AS origine_region
    FROM (SELECT f.idligne, 'PAYS ' || substr(f.num_insee_naissance, 1, 4) AS pays_naissance,
      {side("naissance", "b", "INCONNUE")}, {side("deces", "d", "")}
      FROM facts f LEFT JOIN lookup b ON f.num_insee_naissance = b.num_insee_search
      LEFT JOIN lookup d ON f.num_insee_deces = d.num_insee_search)),
  analysis AS (SELECT * REPLACE (coalesce(nom_departement_naissance, pays_naissance) AS nom_departement_naissance,
      coalesce(nom_region_naissance, pays_naissance) AS nom_region_naissance),
    CASE WHEN substr(num_insee_deces, 1, 2) <> '99' THEN 'FRANCE' ELSE nom_region_deces END AS pays_deces FROM located)
"""


_ONE = """SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY num_insee_search
    ORDER BY latitude, longitude, commune_valide) AS k FROM search) WHERE k = 1"""
_LOCATED = _located_sql(_ONE)


@query("J6 J7", _LOCATED + "SELECT * FROM located")
def located_persons(spark, folder):
    return L.locate_persons(_facts(spark, folder), _search(spark, folder))


@query(
    "J6 J7",
    _located_sql("SELECT * FROM search")
    + """SELECT origine_ville, origine_departement, origine_region, count(*) AS nb FROM located GROUP BY ALL""",
)
def located_persons_all_matches(spark, folder):
    """Every birth match with every death match, counted by flags."""
    return L.count_all_matches(_facts(spark, folder), _search(spark, folder))


@query("J8", _LOCATED + "SELECT * FROM analysis")
def analysis_view(spark, folder):
    return L.analysis_view(L.locate_persons(_facts(spark, folder), _search(spark, folder)))


@query(
    "J9",
    _LOCATED
    + """SELECT idligne, ville_deces, pays_deces, (SELECT count(*) FROM analysis WHERE pays_deces <> 'FRANCE'
    OR pays_deces IS NULL) AS nb_hors_france FROM analysis WHERE pays_deces IN ('FRANCE', 'MONACO')""",
)
def home_deaths(spark, folder):
    view = L.analysis_view(L.locate_persons(_facts(spark, folder), _search(spark, folder)))
    return L.home_deaths_with_excluded(view).select("idligne", "ville_deces", "pays_deces", "nb_hors_france")


@query(
    "J11",
    """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders
  WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""",
)
def customers_without_urgent(spark, folder):
    urgent = table(spark, folder, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    return customers.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query(
    "J12",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer
  WHERE c_mktsegment = 'BUILDING')""",
)
def orders_of_selected(spark, folder):
    chosen = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return orders.join(chosen, F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@query(
    "U1",
    """SELECT c_nationkey AS nation, c_name AS nom FROM customer UNION ALL SELECT s_nationkey, s_name FROM supplier""",
)
def union_of_lists(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("nom"))
    suppliers = table(spark, folder, "supplier").select(F.col("s_name").alias("nom"), F.col("s_nationkey").alias("nation"))
    return customers.unionByName(suppliers)


@query(
    "O2 O1",
    """SELECT o_custkey, round_even(sum(o_totalprice), 2) AS valeur FROM orders GROUP BY o_custkey
  ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_customers(spark, folder):
    top = top_groups(table(spark, folder, "orders"), "o_custkey", F.sum("o_totalprice"), 10)
    return top.withColumn("valeur", F.rint(F.col("valeur") * 100) / 100)


@query("U3 O1", "SELECT DISTINCT p_brand FROM part ORDER BY 1")
def sorted_brands(spark, folder):
    return distinct_values(table(spark, folder, "part"), "p_brand")


@query("U3", "SELECT DISTINCT p_type FROM part WHERE p_type IN ('SMALL', 'MEDIUM', 'LARGE', 'HUGE')")
def listed_types(spark, folder):
    return distinct_values(table(spark, folder, "part"), "p_type", order=["SMALL", "MEDIUM", "LARGE", "HUGE"])
