"""Readers, writers and whole pipelines on files that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.cleaning import error_counts
from ..operators.places import one_row_per_code
from ..plans import climate, mortality, place_tables, survey
from ..session import cut_lineage, shared_folder
from ..sources import documents as D
from ..sources import files, tables
from .base import PERSONS, iso, persons, rounded, table
from .registry import query

# ---------------------------------------------------------------- fixed-position lines


def _padded(value, width):
    return F.rpad(value, width, " ")


def death_lines(spark, folder):
    """One fixed-position line per order line, with accents, foreign births and faulty fields."""
    people = persons(spark, folder, first_names=True)
    k = F.col("idligne")
    birth = F.date_format(F.date_sub("date_deces_dt", F.col("age") * 366 + 10), "yyyyMMdd")
    birth = F.when(k % 41 == 0, F.concat(F.substring(birth, 1, 6), F.lit("00"))).otherwise(birth)
    birth = F.when(k % 53 == 0, "1960x101").otherwise(birth)
    sex = F.when(k % 67 == 0, "3").otherwise(F.col("sex"))
    country = F.when(k % 5 == 0, F.concat(F.lit("PAYS "), "code_departement_naissance")).otherwise("")
    city = F.when(k % 31 == 0, "ANCIEN DEPARTEMENT ALGER").otherwise(F.upper("ville_naissance"))
    names = F.concat(F.lit("É"), k.cast("string"), F.lit("*"), F.upper("prenom"), F.lit("/"))
    head = F.concat(sex, birth, "num_insee_naissance", city)
    line = F.concat(
        _padded(names, 80),
        _padded(head, 44),
        _padded(country, 30),
        F.date_format("date_deces_dt", "yyyyMMdd"),
        "num_insee_deces",
        F.lit("   12345"),
    )
    return people.select("annee", line.alias("value"))


_LINES_SQL = """, lines AS (SELECT annee, CAST(idligne AS VARCHAR) AS k, idligne,
    'É' || CAST(idligne AS VARCHAR) AS nom, upper(prenom) AS prenom,
    CASE WHEN idligne % 67 = 0 THEN '3' ELSE sex END AS sex,
    CASE WHEN idligne % 53 = 0 THEN '1960x101' WHEN idligne % 41 = 0
      THEN strftime(date_deces_dt - CAST(age * 366 + 10 AS INTEGER), '%Y%m') || '00'
      ELSE strftime(date_deces_dt - CAST(age * 366 + 10 AS INTEGER), '%Y%m%d') END AS date_naissance,
    num_insee_naissance, CASE WHEN idligne % 31 = 0 THEN 'ANCIEN DEPARTEMENT ALGER' ELSE upper(ville_naissance) END AS ville_naissance,
    CASE WHEN idligne % 5 = 0 THEN 'PAYS ' || code_departement_naissance ELSE 'FRANCE' END AS pays_naissance,
    strftime(date_deces_dt, '%Y%m%d') AS date_deces, num_insee_deces FROM persons)
"""


_WRITTEN: dict[tuple[str, str], str] = {}


def written_lines(spark, folder):
    """The lines as Latin-1 text files, one folder per year, read back with the year of the folder.

    They are written once for a session and folder, and then read by every query that starts from lines; packed, since half of
    a line is padding. A file holds the lines of one task and year.
    """
    written = (spark.sparkContext.applicationId, folder)
    if written not in _WRITTEN:
        path = shared_folder(spark, "lignes")
        lines = death_lines(spark, folder).write.partitionBy("annee")
        lines.options(encoding="ISO-8859-1", sep="\u0001", quote="", compression="gzip").csv(path)
        _WRITTEN[written] = path
    return files.read_lines(spark, _WRITTEN[written], keep=("annee",))


@query(
    "S1 S2",
    PERSONS
    + _LINES_SQL
    + """SELECT annee, nom, prenom, sex, date_naissance, num_insee_naissance, ville_naissance, pays_naissance, date_deces,
  num_insee_deces FROM lines""",
)
def parsed_lines(spark, folder):
    return files.parse_death_lines(written_lines(spark, folder), keep=("annee",))


_VALID_SQL = """, valid AS (SELECT * FROM lines WHERE sex IN ('1', '2') AND regexp_full_match(date_naissance, '[0-9]{8}'))
"""


@query(
    "P10 A28 S2",
    PERSONS
    + _LINES_SQL
    + """SELECT * FROM (SELECT 'sex' AS champ, count(*) FILTER (WHERE sex = '3') AS nb_erreurs FROM lines
  UNION ALL SELECT 'date_naissance', count(*) FILTER (WHERE date_naissance = '1960x101') FROM lines)""",
)
def line_errors(spark, folder):
    return error_counts(mortality.checked_records(written_lines(spark, folder)))


_PEOPLE_SQL = (
    _VALID_SQL
    + """, rates AS (SELECT annee, round_even(100.0 * count(*) FILTER (WHERE substr(date_naissance, 7, 2) = '00') / count(*), 2) AS r
    FROM valid GROUP BY annee),
  dated AS (SELECT DISTINCT annee, nom, prenom, sex, date_naissance, num_insee_naissance, ville_naissance, pays_naissance,
      date_deces, num_insee_deces, try_strptime(date_naissance, '%Y%m%d') AS b, strptime(date_deces, '%Y%m%d') AS d
    FROM valid JOIN rates USING (annee) WHERE (substr(date_naissance, 7, 2) <> '00' OR r >= 5)
      AND try_strptime(date_naissance, '%Y%m%d') IS NOT NULL),
  people AS (SELECT nom, prenom, sex, CAST(b AS DATE) AS date_naissance_dt,
    CASE WHEN ville_naissance = 'ANCIEN DEPARTEMENT ALGER' THEN '99352' ELSE num_insee_naissance END AS num_insee_naissance,
    ville_naissance, CASE WHEN ville_naissance = 'ANCIEN DEPARTEMENT ALGER' THEN 'ALGERIE' ELSE pays_naissance END AS pays_naissance,
    CAST(d AS DATE) AS date_deces_dt, num_insee_deces, '' AS ville_deces,
    CAST(greatest(floor((CAST(d AS DATE) - CAST(b AS DATE)) / 365), 0) AS INTEGER) AS age, annee, 'FRANCE' AS pays_deces FROM dated)
"""
)


@query("P10 P11 P12 P13 P14 P16 P17 P18 P6", PERSONS + _LINES_SQL + _PEOPLE_SQL + """SELECT * REPLACE (
  strftime(date_naissance_dt, '%Y-%m-%d') AS date_naissance_dt, strftime(date_deces_dt, '%Y-%m-%d') AS date_deces_dt)
  FROM people""")
def death_people(spark, folder):
    """Clean person table from the lines (ids are checked by ``yearly_ids``)."""
    people = mortality.death_people(written_lines(spark, folder)).drop("idligne")
    return people.withColumns({c: iso(c) for c in ("date_naissance_dt", "date_deces_dt")})


@query(
    "P10 A28",
    PERSONS
    + _LINES_SQL
    + _PEOPLE_SQL
    + """SELECT annee, 'rejete' AS statut, champs, count(*) AS nb FROM (SELECT annee, concat_ws('+', CASE WHEN sex = '3' THEN 'sex' END,
    CASE WHEN date_naissance = '1960x101' THEN 'date_naissance' END) AS champs FROM lines) WHERE champs <> '' GROUP BY ALL
  UNION ALL SELECT annee, 'garde', '', count(*) FROM people GROUP BY annee""",
)
def refresh_with_rejects(spark, folder):
    """Rows kept and rejected by one parse of the lines, by year and faulty fields."""
    people, rejected = mortality.refresh(written_lines(spark, folder))
    faulty = rejected.withColumn("champs", F.array_join("erreurs.champ", "+")).groupBy("annee", "champs")
    kept = people.groupBy("annee").agg(F.lit("").alias("champs"), F.count(F.lit(1)).alias("nb"))
    both = faulty.agg(F.count(F.lit(1)).alias("nb")).select("annee", F.lit("rejete").alias("statut"), "champs", "nb")
    return both.unionByName(kept.select("annee", F.lit("garde").alias("statut"), "champs", "nb"))


def _code_places(spark, folder):
    """One place per code, from the customers' nations."""
    nation, k = F.col("c_nationkey"), F.col("c_custkey")
    placed = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), nation == F.col("n_nationkey")
    ).join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    code = F.lpad((nation * 5 + k % 5).cast("string"), 5, "0")
    return one_row_per_code(
        placed.select(
            code.alias("num_insee_search"),
            code.alias("num_insee_valide"),
            F.concat_ws(" ", "n_name", (k % 5).cast("string")).alias("commune_valide"),
            F.lit("MV").alias("origine"),
            (nation * 3 - 40).cast("double").alias("latitude"),
            ((k % 5) * 20 - 40).cast("double").alias("longitude"),
            nation.cast("string").alias("code_departement"),
            F.col("n_name").alias("nom_departement"),
            F.col("n_regionkey").cast("string").alias("code_region"),
            F.col("r_name").alias("nom_region"),
        )
    )


@query(
    "J6 J7 J8 P9 P28 P29 A2 K5",
    PERSONS
    + _LINES_SQL
    + _PEOPLE_SQL
    + """, places AS (SELECT DISTINCT lpad(CAST(c_nationkey * 5 + c_custkey % 5 AS VARCHAR), 5, '0') AS code,
    n_name || ' ' || CAST(c_custkey % 5 AS VARCHAR) AS ville, CAST(c_nationkey * 3 - 40 AS DOUBLE) AS lat,
    CAST((c_custkey % 5) * 20 - 40 AS DOUBLE) AS lon, n_name AS dep, r_name AS reg
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  located AS (SELECT p.annee, p.num_insee_deces, p.age, p.sex, b.ville = d.ville AS v, b.dep = d.dep AS e, b.reg = d.reg AS r,
    round_even(2 * 6371 * asin(least(sqrt(power(sin((radians(d.lat) - radians(b.lat)) / 2), 2) + cos(radians(b.lat))
      * cos(radians(d.lat)) * power(sin((radians(d.lon) - radians(b.lon)) / 2), 2)), 1.0)), 0) AS distance
    FROM people p JOIN places b ON p.num_insee_naissance = b.code JOIN places d ON p.num_insee_deces = d.code)
  SELECT annee, num_insee_deces, count(*) AS nb_deces, round_even(sum(distance), 1) AS distance_tot,
    count(*) FILTER (WHERE v) AS nb_origine_ville, count(*) FILTER (WHERE e) AS nb_origine_departement,
    count(*) FILTER (WHERE r) AS nb_origine_region, count(*) FILTER (WHERE sex = '2') AS nb_woman,
    count(*) FILTER (WHERE age >= 90 AND age < 130) AS nb_deces_plus_90 FROM located GROUP BY ALL""",
)
def yearly_refresh(spark, folder):
    """The whole yearly refresh: lines to clean persons, places, distances and yearly profiles, stored by year."""
    profiles = mortality.yearly_profiles(mortality.death_people(written_lines(spark, folder)), _code_places(spark, folder))
    path = shared_folder(spark, "profils")
    # Stored, since the years are counted before they are written.
    tables.replace_years(cut_lineage(profiles), path)
    return (
        spark.read.parquet(path)
        .withColumn("annee", F.col("annee").cast("string"))
        .select(
            "annee",
            "num_insee_deces",
            "nb_deces",
            "distance_tot",
            "nb_origine_ville",
            "nb_origine_departement",
            "nb_origine_region",
            "nb_woman",
            "nb_deces_plus_90",
        )
    )


# ---------------------------------------------------------------- delimited files


@query(
    "S3 K3",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END AS o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, CASE WHEN o_orderkey % 7 > 0 THEN '"' || o_orderpriority || '", x' END AS o_orderpriority
  FROM orders""",
)
def csv_round_trip(spark, folder):
    """Dates, nulls, quotes and separators through a file; an empty text comes back as null."""
    path = shared_folder(spark, "csv")
    k = F.col("o_orderkey")
    orders = table(spark, folder, "orders").withColumns(
        {
            "o_orderdate": F.col("o_orderdate").cast("date"),
            "o_orderstatus": F.when(k % 5 > 0, F.col("o_orderstatus")),
            "o_orderpriority": F.when(k % 7 > 0, F.concat(F.lit('"'), "o_orderpriority", F.lit('", x'))).otherwise(""),
        }
    )
    tables.replace_csv(orders, path, escape='"')
    back = files.read_delimited(spark, path, orders.schema, escape='"')
    return back.withColumn("o_orderdate", iso("o_orderdate"))


@query("S4", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def zipped_csv(spark, folder):
    """Parts as zip archives of a thousand keys each, written by the tasks and read back."""
    import io
    import zipfile

    def archive(pdf):
        text = pdf[["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]].to_csv(index=False)
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as target:
            target.writestr("part.csv", text)
        return pdf.head(1)[["lot"]].assign(content=[buffer.getvalue()])

    path = shared_folder(spark, "zip")
    part = table(spark, folder, "part")
    columns = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    lots = part.withColumn("lot", F.floor(F.col("p_partkey") / 1000).cast("bigint"))
    packed = lots.groupBy("lot").applyInPandas(archive, "lot bigint, content binary")
    packed.write.parquet(f"{path}/packed")

    return files.unzip_rows(spark.read.parquet(f"{path}/packed").select("content"), columns)


@query(
    "S5 U1",
    "SELECT n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS pays FROM nation",
)
def file_family(spark, folder):
    """One file per region, united with the key from the path."""
    path = shared_folder(spark, "pays")
    table(spark, folder, "nation").write.partitionBy("n_regionkey").csv(path, header=True)
    return files.read_family(spark, f"{path}/*", "n_nationkey int, n_name string", r"n_regionkey=(\d+)", "pays")


@query(
    "S5 U1",
    """SELECT c_custkey, c_name, CASE WHEN c_nationkey % 3 = 2 THEN NULL ELSE c_acctbal END AS c_acctbal,
  CAST(c_nationkey AS VARCHAR) AS pays FROM customer""",
)
def shuffled_family(spark, folder):
    """Customers in files of three layouts: in order, turned round with a further column, and without the balance."""
    path = shared_folder(spark, "pays")
    customers = table(spark, folder, "customer")
    layouts = [["c_custkey", "c_name", "c_acctbal"], ["c_mktsegment", "c_acctbal", "c_name", "c_custkey"], ["c_name", "c_custkey"]]
    for k, columns in enumerate(layouts):
        part = customers.where(F.col("c_nationkey") % 3 == k).select(*columns, "c_nationkey")
        part.repartition("c_nationkey").write.partitionBy("c_nationkey").mode("append").csv(path, header=True)
    schema = "c_custkey bigint, c_name string, c_acctbal double"
    return files.read_family(spark, f"{path}/*", schema, r"c_nationkey=(\d+)", "pays")


# ---------------------------------------------------------------- documents


def _catalogues(spark, folder):
    """One catalogue document per order: a foreign title and a yearly file, some without address."""
    k = F.col("o_orderkey")
    title = F.concat(F.lit("deces-"), F.date_format("o_orderdate", "yyyy"), F.lit(".txt"))
    latest = F.when(k % 3 == 0, F.concat(F.lit("latest/"), k.cast("string"))).when(k % 3 == 1, "")
    url = F.when(k % 4 > 0, F.concat(F.lit("url/"), k.cast("string")))
    foreign = F.struct(
        F.lit("deces-1999-T1.txt").alias("title"), F.lit("x").alias("latest"), F.lit("y").alias("url")
    )
    listed = F.array(foreign, F.struct(title.alias("title"), latest.alias("latest"), url.alias("url")))
    return table(spark, folder, "orders").select("o_custkey", F.to_json(F.struct(listed.alias("resources"))).alias("doc"))


_FILES = """WITH listed AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS annee_file,
    'deces-' || CAST(year(o_orderdate) AS VARCHAR) || '.txt' AS nom_fichier, CASE WHEN o_orderkey % 3 = 0
      THEN 'latest/' || CAST(o_orderkey AS VARCHAR) WHEN o_orderkey % 4 > 0 THEN 'url/' || CAST(o_orderkey AS VARCHAR)
      ELSE '' END AS url_file FROM orders),
  files AS (SELECT o_custkey, annee_file, nom_fichier, min(url_file) AS url_file FROM listed GROUP BY ALL)
"""


@query("S6 P15", _FILES + "SELECT * FROM files")
def catalogue_files(spark, folder):
    return D.yearly_files(_catalogues(spark, folder), "doc", by=("o_custkey",))


@query("S6", """SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS nb FROM events GROUP BY 1""")
def event_documents(spark, folder):
    parsed = table(spark, folder, "events").select(F.from_json("props", "k int")["k"].alias("k"))
    return parsed.groupBy("k").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "S7",
    """WITH files AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS annee_file, min(o_orderkey) AS k FROM orders GROUP BY 1),
  asked AS (SELECT DISTINCT CAST(year(l_shipdate) + l_linenumber AS VARCHAR) AS annee FROM lineitem)
  SELECT annee, coalesce(f.annee_file, d.annee_file) AS annee_file, f.annee_file IS NULL AS used_default,
    'deces-' || CAST(coalesce(f.annee_file, d.annee_file) AS VARCHAR) || '.txt' AS nom_fichier,
    'url/' || CAST(coalesce(f.k, d.k) AS VARCHAR) AS url_file
  FROM asked LEFT JOIN files f ON CAST(annee AS INTEGER) = f.annee_file, (SELECT * FROM files WHERE annee_file = 2000) d""",
)
def default_files(spark, folder):
    """File of every asked year; years without a file take the default year."""
    files_by_year = (
        table(spark, folder, "orders")
        .groupBy(F.year("o_orderdate").alias("annee_file"))
        .agg(F.min("o_orderkey").alias("k"))
        .select(
            "annee_file",
            F.concat(F.lit("deces-"), F.col("annee_file").cast("string"), F.lit(".txt")).alias("nom_fichier"),
            F.concat(F.lit("url/"), F.col("k").cast("string")).alias("url_file"),
        )
    )
    asked = table(spark, folder, "lineitem").select(
        (F.year("l_shipdate") + F.col("l_linenumber")).cast("string").alias("annee")
    )
    return D.with_default_file(asked.distinct(), files_by_year, default=2000)


@query(
    "S8",
    r"""SELECT page_id, CAST(i - 1 AS INTEGER) AS ligne, regexp_extract(r, '(?s)<a href="([^"]*)">(.*?)</a>', 2) AS nom,
  regexp_extract(r, '(?s)<a href="([^"]*)">(.*?)</a>', 1) AS lien
  FROM (SELECT page_id, unnest(rows) AS r, generate_subscripts(rows, 1) AS i
    FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS rows FROM pages))""",
)
def html_rows(spark, folder):
    """List items of whole pages as rows (the pages hold lists, not tables, and no header row)."""
    pages = table(spark, folder, "pages")
    return D.html_rows(
        pages,
        "html",
        {"lien": 0, "nom": 1},
        keep=("page_id",),
        table="",
        row=r"(?s)<li>(.*?)</li>",
        cell=r'(?s)(?:<a href="|">)(.*?)(?="|</a>)',
        skip=0,
    )


@query(
    "S8",
    r"""SELECT n_name AS page, c_custkey AS cle, c_name || ' & <' || c_mktsegment || '>' AS nom,
  CASE WHEN c_custkey % 3 = 0 THEN 'oui é détail ' || c_name || ' fin' ELSE '' END AS note FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def html_tables(spark, folder):
    """Customers in a page for each nation: tables inside of cells, references, cells without end tags, other tables before."""
    name = F.concat("c_name", F.lit(" &amp; &lt;"), "c_mktsegment", F.lit("&#62;"))
    inner = F.concat(F.lit("oui &eacute; <table class='wikitable'><tr><td>d&#xe9;tail<td>"), "c_name", F.lit("</td></tr></table> fin"))
    note = F.when(F.col("c_custkey") % 3 == 0, inner).otherwise("")
    row = F.concat(F.lit("<TR class=x><td> "), F.col("c_custkey").cast("string"), F.lit("\n<th>"), name, F.lit("</th>\n<td>"), note)
    closed = F.concat(row, F.when(F.col("c_custkey") % 2 == 0, "</td></tr>").otherwise("<!-- </table> -->"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", closed.alias("h")))), lambda r: r["h"]), "\n")
    head = "<html></table><table><tr><td>autre</td><td>table</td></tr></table><p>x</p><table class='a wikitable'><tr><th>cle</th><th>nom</th></tr>"
    pages = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("page"))
        .agg(F.concat(F.lit(head), rows, F.lit("</table><table class='wikitable'><tr><td>a<td>b</table>")).alias("html"))
    )
    found = D.html_table_rows(pages, "html", {"cle": 0, "nom": 1, "note": 2}, keep=("page",))
    return found.select("page", F.col("cle").cast("bigint").alias("cle"), "nom", "note")


@query(
    "S9",
    """SELECT c_mktsegment AS groupe, n_name AS nom, CAST(n_nationkey AS VARCHAR) AS code, count(*) AS nb
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN
  (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA') GROUP BY ALL""",
)
def geojson_features(spark, folder):
    """Features of one document per market segment, kept when a nation of ASIA bears their name."""
    nations = table(spark, folder, "nation")
    properties = F.struct(F.col("n_name").alias("nom"), F.col("n_nationkey").cast("string").alias("code"))
    point = F.struct(F.lit("Point").alias("type"), F.array(F.col("c_acctbal"), F.lit(0.0)).alias("coordinates"))
    feature = F.struct(properties.alias("properties"), point.alias("geometry"))
    docs = (
        table(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_mktsegment", F.to_json(F.struct(F.array(feature).alias("features"))).alias("doc"))
    )
    asia = nations.join(
        table(spark, folder, "region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    kept = D.features_named(D.geojson_features(docs, "doc", keep=("c_mktsegment",)), asia, "n_name")
    return kept.groupBy(F.col("c_mktsegment").alias("groupe"), "nom", "code").agg(F.count(F.lit(1)).alias("nb"))


# ---------------------------------------------------------------- tables


@query("S10 K1 K4", "SELECT c_nationkey, count(*) AS nb, round_even(sum(c_acctbal), 2) AS solde FROM customer GROUP BY 1")
def stored_table(spark, folder):
    """A table replaced twice and read back with two of its columns."""
    path = shared_folder(spark, "table")
    customers = table(spark, folder, "customer")
    tables.replace_folder(customers.where("c_acctbal > 0"), path)
    tables.replace_folder(customers, path)
    tables.publish_view(spark.read.parquet(path), "clients_enregistres")
    stored = tables.read_table(spark, "clients_enregistres", ["c_nationkey", "c_acctbal"])
    totals = stored.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("nb"), F.sum("c_acctbal").alias("solde"))
    return totals.withColumn("solde", rounded("solde", 2))


@query(
    "K5",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, count(*) AS nb, count(*) FILTER (WHERE year(o_orderdate) = 1997)
  AS nb_revu FROM orders GROUP BY 1""",
)
def replaced_years(spark, folder):
    """All years stored, then one year replaced; the others stay."""
    path = shared_folder(spark, "annees")
    orders = table(spark, folder, "orders").withColumn("annee", F.year("o_orderdate"))
    tables.replace_years(orders.withColumn("revu", F.lit(0)), path)
    tables.replace_years(orders.where("annee = 1997").withColumn("revu", F.lit(1)), path)
    stored = spark.read.parquet(path)
    return stored.groupBy("annee").agg(F.count(F.lit(1)).alias("nb"), F.count_if(F.col("revu") == 1).alias("nb_revu"))


# ---------------------------------------------------------------- climate and survey pipelines


@query("S5 P24 P23 P25 J16 A17 J11 P21 A33 T5")
def climate_tests(spark, folder):
    """Raw weather rows to city-days, quantile classes and the independence tests of the population class."""
    k = F.col("c_custkey")

    def dms(degrees):
        return F.concat_ws(":", degrees.cast("string"), (k % 60).cast("string"), (k % 47).cast("string"))

    raw = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == k)
        .select(
            F.concat(F.lit("V"), (k % 200).cast("string")).alias("CITY"),
            F.element_at(F.array(F.lit("FR"), F.lit("IT"), F.lit("SE")), (k % 200 % 3 + 1).cast("int")).alias("CN"),
            dms(k % 200 % 120 - 60).alias("LAT"),
            dms(k % 200 % 90).alias("LON"),
            F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("DATE"),
            (F.col("o_totalprice") / 1000).alias("TX"),
            (k % 3000).cast("double").alias("HGHT_num"),
            ((k % 200) * 1000).cast("double").alias("NB_HAB"),
        )
    )
    return climate.population_tests(climate.city_classes(climate.city_measurements(raw)))


@query(
    "P7 P8 P26 P1 A1",
    """SELECT substr(CAST(ts AS VARCHAR), 1, 10) AS "Jour", CAST(sum(user_id) AS BIGINT) AS individus, count(*) AS groupes,
  round_even(sum(user_id) / CAST(count(*) AS DOUBLE), 0) AS individus_par_groupe FROM events
  WHERE event_type NOT IN ('error', 'view') AND event_id % 10 <> 0 GROUP BY 1""",
)
def survey_groups(spark, folder):
    """Events as survey observations: cleaned, then summed up per day."""
    boat = F.when(F.col("event_type") == "error", "Aucun").when(F.col("event_type") == "view", "None")
    raw = table(spark, folder, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("Jour"),
        ((F.hour("ts") * 60 + F.minute("ts")) / F.lit(1440.0)).alias("Instant"),
        F.col("value").alias("Distance"),
        F.col("value").alias("Vitesse de nage Km/h"),
        F.col("user_id").alias("Nombre d'individus"),
        boat.when(F.col("event_type") == "click", "Tourism").otherwise("Crevetier").alias("Categorie Type Bateau"),
        F.when(F.col("event_id") % 10 == 0, "NONE").otherwise(F.col("value").cast("string")).alias("Indice de Linearite"),
        F.lit("Sociabilization").alias("Comportement"),
    )
    return survey.groups_per_day(survey.clean_observations(raw))


@query("P1 P2 P3 P4 P5 P6 P13 P14 S3 J1 J2 J3 J4 J5 J10")
def searchable_codes(spark, folder):
    """Raw code lists derived from parts, suppliers, nations and regions to the search table."""
    p, s, n = F.col("p_partkey"), F.col("s_suppkey"), F.col("n_nationkey")
    main = table(spark, folder, "part").select(
        p.cast("string").alias("code_commune_INSEE"),
        F.col("p_name").alias("nom_commune_postal"),
        (p % 900).cast("string").alias("code_postal"),
        (p % 90).cast("double").alias("latitude"),
        (p % 180).cast("double").alias("longitude"),
        F.concat((p % 100).cast("string"), F.lit(".0")).alias("code_commune"),
        (p % 95).cast("string").alias("code_departement"),
        F.concat(F.lit("Dépôt "), "p_type").alias("nom_departement"),
        F.concat((p % 13).cast("string"), F.lit(".0")).alias("code_region"),
        F.concat(F.lit("Île "), "p_brand").alias("nom_region"),
    )
    yearly = table(spark, folder, "supplier").select(
        F.lpad(s.cast("string"), 5, "0").alias("com"),
        F.lit("COM").alias("typecom"),
        (s % 13).cast("string").alias("reg"),
        (s % 95).cast("string").alias("dep"),
        F.lit("1").alias("arr"),
        F.upper("s_name").alias("ncc"),
        F.col("s_name").alias("nccenr"),
        F.lit("01").alias("can"),
    )
    changes = table(spark, folder, "part").where(p > 0).select(
        F.lit(32).alias("MOD"),
        F.lit("2019-01-01").alias("DATE_EFF"),
        F.concat(F.lit("X"), p.cast("string")).alias("ID_COMMUNE_AVANT"),
        F.col("p_name").alias("NCC_AVANT"),
        F.lpad(F.floor(p / 2).cast("string"), 5, "0").alias("ID_COMMUNE_APRES"),
        F.col("p_name").alias("NCC_APRES"),
    )
    overseas = table(spark, folder, "nation").select(
        F.concat(F.lit("988"), n.cast("string")).alias("num_insee"),
        F.concat(F.lit("Île "), "n_name").alias("commune"),
        F.concat((n * 100).cast("string"), F.lit(" (2019)")).alias("population"),
    )
    codes = table(spark, folder, "region").select(
        (F.col("r_regionkey") + 99100).alias("COG"),
        F.col("r_name").alias("LIBCOG"),
        F.substring("r_name", 1, 2).alias("CODEISO2"),
    )
    coordinates = table(spark, folder, "region").select(
        F.substring("r_name", 1, 2).alias("country"),
        F.col("r_regionkey").cast("double").alias("latitude"),
        F.col("r_regionkey").cast("double").alias("longitude"),
        F.col("r_name").alias("name"),
    )
    return place_tables.searchable_codes(
        place_tables.main_places(main),
        place_tables.yearly_places(yearly),
        place_tables.code_changes(changes),
        place_tables.overseas_places(overseas),
        place_tables.countries(codes, coordinates),
    )
