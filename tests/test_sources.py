import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from sectoria.operators import coverage as V
from sectoria.sources import documents as D
from sectoria.sources import files, tables


def line(names, head, country="", death="20240131", code="75056"):
    return f"{names:<80}{head:<44}{country:<30}{death}{code}   99"


def test_latin1_lines(spark, tmp_path):
    lines = [
        line("DUPRÉ*JEAN PAUL/", "1193001025012ABÎME LE GRAND"),
        line("LI*ANNA/", "219300102993520RAN", "VIET NAM"),
        line("O*P/", "219300102993520RAN", "REPUBLIQUE DEMOCRATIQUE DU CON"),
    ]
    (tmp_path / "deces.txt").write_bytes("\n".join(lines).encode("latin-1"))
    rows = files.parse_death_lines(files.read_lines(spark, str(tmp_path / "deces.txt"))).collect()
    first = rows[0]
    assert (first["nom"], first["prenom"], first["sex"], first["date_naissance"]) == ("DUPRÉ", "JEAN PAUL", "1", "19300102")
    assert (first["num_insee_naissance"], first["ville_naissance"], first["pays_naissance"]) == ("5012A", "BÎME LE GRAND", "FRANCE")
    assert (first["date_deces"], first["num_insee_deces"]) == ("20240131", "75056")
    assert [r["pays_naissance"] for r in rows[1:]] == ["VIET NAM", "REPUBLIQUE DEMOCRATIQUE DU CON"]
    assert rows[2]["date_deces"] == "20240131"


def test_zip_reads_the_first_member(spark, tmp_path):
    for name, text in (("a", "k,v\n01,x\n,\n"), ("b", "v,k\ny,2\n")):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            archive.writestr("one.csv", text)
            archive.writestr("two.csv", "k,v\n9,z\n")
        (tmp_path / f"{name}.zip").write_bytes(buffer.getvalue())
    rows = files.read_zipped(spark, str(tmp_path / "*.zip"), "k int, v string").collect()
    assert sorted((tuple(r) for r in rows), key=str) == [(1, "x"), (2, "y"), (None, None)]


def test_family_key_comes_from_the_file(spark, tmp_path):
    for country in ("FR", "IT"):
        (tmp_path / f"meteo_{country}.csv").write_text(f"k\n{len(country)}\n")
    rows = files.read_family(spark, str(tmp_path), "k int", r"meteo_([A-Z]+)\.csv", "CN").collect()
    assert {tuple(r) for r in rows} == {(2, "FR"), (2, "IT")}


def test_family_is_united_by_names(spark, tmp_path):
    files_ = {
        "FR": "b,a\n1,x\n2,\n",
        "IT": "a,b\ny,3\n",
        "ES": "other,b\nq,4\n",
        "PT": "b,b,a\n5,6,z\n",
        "SE": "",
    }
    for country, text in files_.items():
        (tmp_path / f"meteo_{country}.csv").write_text(text)
    rows = files.read_family(spark, str(tmp_path), "a string, b int", r"meteo_([A-Z]+)\.csv", "CN").collect()
    wanted = [("x", 1, "FR"), (None, 2, "FR"), ("y", 3, "IT"), (None, 4, "ES"), ("z", 5, "PT")]
    assert sorted(map(tuple, rows), key=str) == sorted(wanted, key=str)


def test_catalogue_and_default(spark):
    doc = """{"resources": [{"title": "deces-2023.txt", "latest": "", "url": "u23"}, {"title": "deces-2024.txt", "latest": "l24", "url": "u24"},
      {"title": "deces-2023.txt", "latest": "again"}, {"title": "deces-2024-m01.txt", "url": "no"}, {"title": "deces-2022.txt"}]}"""
    listed = D.yearly_files(spark.createDataFrame([(doc,)], "doc string"), "doc")
    assert {r["annee_file"]: r["url_file"] for r in listed.collect()} == {2022: "", 2023: "u23", 2024: "l24"}
    asked = spark.createDataFrame([("2023",), ("1999",), ("abc",)], "annee string")
    rows = {r["annee"]: (r["annee_file"], r["used_default"]) for r in D.with_default_file(asked, listed).collect()}
    assert rows == {"2023": (2023, False), "1999": (2024, True), "abc": (2024, True)}


def test_html_table(spark):
    page = """<table class="other"><tr><td>no</td></tr></table><table class="wikitable sortable">
      <tr><th>Commune</th></tr><tr><th><a href="x"> Bourail </a></th><td>98803</td><td>a</td><td>b</td><td>5 531 (2019)</td></tr>
      <tr><td>alone</td></tr></table>"""
    rows = D.html_rows(
        spark.createDataFrame([(page,)], "html string"), "html", {"commune": 0, "num_insee": 1, "population": 4}
    ).collect()
    assert [tuple(r)[1:] for r in rows] == [("Bourail", "98803", "5 531 (2019)")]


def test_html_tables_with_nesting_and_references(spark):
    pages = {
        "nested": """<table class="wikitable"><tr><th>h<th>i</tr><tr><td>a<table><tr><td>x</td><td>y</td></tr></table>z</td><td>b</td></tr></table>""",
        "open ends": "<TABLE class='wikitable'><tbody><tr><td>h<td>i<tr><th>a<td>b &amp;lt; c<td>d<tr><td>alone</tbody></table><td>after<td>after",
        "second": "<table><tr><td>no</td><td>no</td></tr></table></table><table id=1 class='x wikitable y'><tr><td>h</td><td>i</td></tr><tr><td><!-- <td> -->a</td><td></td></tr></table>",
        "references": "<table class=wikitable><tr></tr><tr><td>&eacute;&#233;&#xE9;&euro;&#128512;</td><td>&unknown; &#xD800; 5 < 6 & 7&nbsp;</td></tr>",
        "breaks": "<table class=wikitable><tr><td>h<td>i</tr><tr><td> a<br>b\n\tc </td><td><b>d</b>e</td></tr>",
        "none": "<p>no table</p>",
        "null": None,
        "empty": "",
    }
    df = spark.createDataFrame(list(pages.items()), "page string, html string")
    found = {}
    for r in D.html_table_rows(df, "html", {"a": 0, "b": 1, "c": 2}, keep=("page",)).collect():
        found.setdefault(r.page, []).append((r.ligne, r.a, r.b, r.c))
    assert found == {
        "nested": [(1, "a x y z", "b", None)],
        "open ends": [(1, "a", "b &lt; c", "d")],
        "second": [(1, "a", "", None)],
        "references": [(1, "ééé€\U0001f600", "&unknown; &#xD800; 5 < 6 & 7", None)],
        "breaks": [(1, "a b c", "de", None)],
    }


def test_geojson(spark):
    doc = """{"features": [{"properties": {"nom": "Ain", "code": "01"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
      {"properties": {"nom": "Var"}, "geometry": null}]}"""
    features = D.geojson_features(spark.createDataFrame([(doc,)], "d string"), "d")
    kept = D.features_named(features, spark.createDataFrame([("Ain",), ("Ain",)], "dep string"), "dep").collect()
    assert [(r["nom"], r["code"]) for r in kept] == [("Ain", "01")] and '"Point"' in kept[0]["geometry"]


def test_database_round_trip(spark):
    url, driver = "jdbc:derby:memory:sectoria;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    tables.replace_database_table(spark.range(10).withColumn("v", F.col("id") * 2), url, "places", driver)
    tables.replace_database_table(spark.range(6).withColumn("v", F.col("id") * 3), url, "places", driver)
    read = tables.read_database(spark, url, "places", ["v"], driver, split=("ID", 0, 6, 3))
    assert sorted(r[0] for r in read.collect()) == [0, 3, 6, 9, 12, 15] and read.rdd.getNumPartitions() == 3


def test_replace_years_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "years")
    tables.replace_years(spark.createDataFrame([(1, "2023"), (2, "2024")], "k int, annee string"), path)
    tables.replace_years(spark.createDataFrame([(9, "2024")], "k int, annee string"), path)
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [1, 9]
    many = spark.range(5000).selectExpr("CAST(id AS INT) AS k", "CAST(2020 + id % 3 AS STRING) AS annee").repartition(40)
    tables.replace_years(many, path)
    written = [f for y in (2020, 2021, 2022) for f in (tmp_path / "years" / f"annee={y}").glob("*.parquet")]
    assert len(written) == 3
    assert spark.read.parquet(path).where("annee < 2023").count() == 5000


def test_files_of_a_year_follow_its_rows(spark, tmp_path):
    path = tmp_path / "years"
    sizes = {"2020": 4000, "2021": 400, "2022": 1, None: 40}
    rows = [(i, y) for y, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "k int, annee string").repartition(7)
    tables.replace_years(df, str(path), rows_per_file=500)
    folders = {p.name: list(p.glob("*.parquet")) for p in path.iterdir() if p.is_dir()}
    # A task may hold several shares of one year, but writes no more than twice the rows in a file.
    assert 2 <= len(folders["annee=2020"]) <= 8 and len(folders["annee=2021"]) == len(folders["annee=2022"]) == 1
    assert len(folders["annee=__HIVE_DEFAULT_PARTITION__"]) == 1
    assert all(spark.read.parquet(str(f)).count() <= 1000 for f in folders["annee=2020"])
    assert spark.read.parquet(str(path)).count() == len(rows)


def test_a_table_is_rebuilt_from_itself_or_left_as_it_was(spark):
    spark.range(5).withColumn("v", F.col("id") * 2).write.mode("overwrite").saveAsTable("versions_essai")
    tables.replace_table(spark.table("versions_essai").where("id > 0"), "versions_essai")
    tables.replace_table(spark.table("versions_essai").withColumn("w", F.lit("x")), "versions_essai")
    before = spark.table("versions_essai")
    failing = spark.table("versions_essai").withColumn("v", F.when(F.col("id") > 3, F.raise_error(F.lit("stop"))).otherwise(1))
    with pytest.raises(Exception, match="stop"):
        tables.replace_table(failing, "versions_essai")
    assert sorted(map(tuple, spark.table("versions_essai").collect())) == [(i, 2 * i, "x") for i in range(1, 5)]
    tables.replace_table(spark.table("versions_essai").drop("w").limit(0), "versions_essai")
    assert spark.table("versions_essai").columns == ["id", "v"] and spark.table("versions_essai").count() == 0
    # Who has begun to read keeps the version of that time.
    assert before.count() == 4
    spark.sql("DROP VIEW versions_essai")


@pytest.mark.parametrize(
    "values, expected",
    [
        ([9, 9, 1, 9, 9, 9, 1], (2003, 2005, 3)),
        ([9, 9, 1, 9, 9, 1, 1], (2000, 2001, 2)),
        ([5, 5, 5], (2000, 2002, 3)),
        ([1, 1, 1, 9, 9, 9, 9], (2003, 2006, 4)),
    ],
)
def test_longest_run(spark, values, expected):
    df = spark.createDataFrame([(2000 + i, v) for i, v in enumerate(values)], "y int, v int")
    assert tuple(V.longest_run(df, "y", "v").first())[1:] == expected


def test_class_table(spark):
    classes = spark.createDataFrame([(1, 0, 10), (2, 10, 20)], "la_borne int, borne_inf_strict int, borne_sup_egale int")
    df = spark.createDataFrame([(0,), (1,), (10,), (11,), (21,), (None,)], "x int")
    assert [r["classe"] for r in V.class_from_table(df, "x", classes).collect()] == [0, 1, 1, 2, 0, 0]


@pytest.mark.parametrize("frequent", [2, 1000])
def test_overlapping_classes(spark, monkeypatch, frequent):
    """Of overlapping ranges the last class wins; empty ranges and missing bounds hold nothing."""
    monkeypatch.setattr(V, "FREQUENT", frequent)
    rng = random.Random(4)
    ranges = [(rng.randrange(9), *sorted((rng.randrange(60), rng.randrange(60)))) for _ in range(25)]
    ranges += [(50, 5, 5), (51, None, 9), (52, 30, 20), (8, 40, 41), (8, 40, 42)]
    classes = spark.createDataFrame(ranges, "la_borne int, borne_inf_strict int, borne_sup_egale int")
    values = [rng.choice([7, 7, rng.randrange(-2, 63), None]) for _ in range(200)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x int")
    found = {r.i: r.classe for r in V.class_from_table(df, "x", classes).collect()}

    def plain(v):
        held = [r for r in ranges if None not in (v, *r) and r[1] < v <= r[2]]
        return max(held)[0] if held else 0

    assert found == {i: plain(v) for i, v in enumerate(values)}


def test_many_classes(spark):
    """100,000 classes, with a wide one below them all."""
    classes = spark.range(100_000).selectExpr("id + 2 AS la_borne", "id * 3 AS borne_inf_strict", "id * 3 + 2 AS borne_sup_egale")
    classes = classes.unionByName(spark.createDataFrame([(1, -10, 200_000)], classes.schema))
    df = spark.range(-20, 300_020).select(F.col("id").alias("x"))
    found = V.class_from_table(df, "x", classes)
    inside = (F.col("x") > 0) & (F.col("x") < 300_000) & (F.col("x") % 3 != 0)
    wide = (F.col("x") > -10) & (F.col("x") <= 200_000)
    wanted = F.when(inside, F.floor(F.col("x") / 3) + 2).when(wide, 1).otherwise(0)
    assert found.where(wanted != F.col("classe")).count() == 0 and found.count() == 300_040
    assert V.class_from_table(df, "x", classes.where("false")).where("classe <> 0").count() == 0
