import random

import pytest
from pyspark.sql import functions as F

from sectoria.operators import places as L


def changes(spark, edges):
    rows = [(a, a.lower(), b, b.lower()) for a, b in edges]
    return spark.createDataFrame(
        rows,
        "num_insee_avant string, nom_commune_en_clair_avant string, num_insee_apres string, nom_commune_en_clair_apres string",
    )


CHAIN = [(f"C{i}", f"C{i + 1}") for i in range(7)]
CYCLE = [("A", "B"), ("B", "A")]
BRANCH = [("X", "Z"), ("X", "Y"), ("SELF", "SELF")]


def test_chains_equal_the_recursive_query(spark):
    df = changes(spark, CHAIN + CYCLE + BRANCH + CHAIN)
    df.createOrReplaceTempView("mouvements")
    recursive = spark.sql(
        """WITH RECURSIVE chaines(origine, nom_origine, actuel, nom_actuel, niveau, chemin) AS (
        SELECT DISTINCT num_insee_avant, nom_commune_en_clair_avant, num_insee_apres, nom_commune_en_clair_apres, 1,
          array(num_insee_avant, num_insee_apres) FROM mouvements
        UNION ALL SELECT c.origine, c.nom_origine, e.num_insee_apres, e.nom_commune_en_clair_apres, c.niveau + 1,
          array_append(c.chemin, e.num_insee_apres) FROM chaines c JOIN mouvements e ON e.num_insee_avant = c.actuel
          WHERE c.niveau < 5 AND NOT array_contains(c.chemin, e.num_insee_apres))
        SELECT DISTINCT * FROM chaines"""
    )
    assert {(*r[:5], tuple(r[5])) for r in L.code_chains(df, max_depth=5).collect()} == {
        (*r[:5], tuple(r[5])) for r in recursive.collect()
    }


def test_latest_code_depth_cycle_and_ties(spark):
    latest = L.latest_codes(L.code_chains(changes(spark, CHAIN + CYCLE + BRANCH)))
    got = {r["num_insee_invalide"]: r["num_insee_valide"] for r in latest.collect()}
    assert got["C0"] == "C7" and got["C6"] == "C7"
    assert got["A"] == "B" and got["B"] == "A"
    assert got["X"] == "Y" and got["SELF"] == "SELF"


@pytest.mark.parametrize("seed", range(4))
def test_latest_without_listing_chains(spark, seed):
    """Random graphs with loops, cycles, branches, several names for a change and changes to nothing."""
    rng = random.Random(seed)
    codes = [f"c{i:02}" for i in range(24)]
    rows = [
        (a, rng.choice("pqr"), rng.choice([*codes, a, None]) if rng.random() < 0.5 else codes[codes.index(a) // 2], rng.choice(["x", "y", None]))
        for a in rng.sample(codes, 20) + rng.sample(codes, 4 * seed)
    ]
    df = changes(spark, []).unionByName(spark.createDataFrame(rows, changes(spark, []).schema))
    listed = L.latest_codes(L.code_chains(df)).collect()
    assert sorted(L.latest_of_changes(df).collect(), key=str) == sorted(listed, key=str) and listed


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """1,000 changes in a row, with a cycle and a branch beside them: rounds grow with the logarithm."""
    stored = []
    cut = L.cut_lineage
    monkeypatch.setattr(L, "cut_lineage", lambda df: stored.append(1) or cut(df))
    long = [(f"L{i}", f"L{i + 1}") for i in range(1000)]
    latest = {r["num_insee_invalide"]: r["num_insee_valide"] for r in L.latest_of_changes(changes(spark, long + CYCLE + BRANCH)).collect()}
    assert all(latest[f"L{i}"] == "L1000" for i in range(1000))
    assert latest["A"] == "B" and latest["X"] == "Y" and latest["SELF"] == "SELF"
    assert len(stored) <= 20


def test_chains_double(spark, monkeypatch):
    stored = []
    cut = L.cut_lineage
    monkeypatch.setattr(L, "cut_lineage", lambda df: stored.append(1) or cut(df))
    long = [(f"L{i:02}", f"L{i + 1:02}") for i in range(40)]
    chains = L.code_chains(changes(spark, long))
    assert chains.count() == 40 * 41 // 2 and len(stored) <= 8
    assert L.code_chains(changes(spark, long), max_depth=7).agg(F.max("niveau")).first()[0] == 7


def test_search_table_flags_and_completion(spark):
    places = spark.createDataFrame(
        [("P", "Paris", "Dep", "Reg", 1.0, 2.0, "75", "11"), ("S", "Seul", None, None, None, None, None, None)],
        "num_insee string, nom_commune_postal string, nom_departement string, nom_region string, "
        "latitude double, longitude double, code_departement string, code_region string",
    )
    latest = spark.createDataFrame(
        [("OLD", "vieux", "P", "paris"), ("S", "seul", "P", "paris")],
        "num_insee_invalide string, nom_invalide string, num_insee_valide string, nom_valide string",
    )
    rows = {r["num_insee_search"]: r for r in L.search_table(places, latest).collect()}
    assert (rows["OLD"]["origine"], rows["OLD"]["num_insee_valide"], rows["OLD"]["latitude"]) == ("PR", "P", 1.0)
    assert (rows["P"]["origine"], rows["P"]["commune_valide"]) == ("MV", "PARIS")
    assert (rows["S"]["num_insee_valide"], rows["S"]["latitude"]) == ("S", None)


def persons(spark):
    return spark.createDataFrame(
        [(1, "A", "inconnue", "ITALIE", "B", ""), (2, "A", "x", "FRANCE", "A", ""), (3, "Q", "quoi", "CHILI", "99100", "")],
        "idligne int, num_insee_naissance string, ville_naissance string, pays_naissance string, "
        "num_insee_deces string, ville_deces string",
    )


def search(spark):
    rows = [
        ("A", "A", "ALPHA", 2.0, 2.0, "1", "D1", "1", "R1"),
        ("A", "A2", "ALEPH", 1.0, 9.0, "1", "D1", "1", "R1"),
        ("B", "B", "BETA", 3.0, 3.0, "2", "D2", "1", "R1"),
        ("99100", "99100", "ROME", 4.0, 4.0, None, None, None, None),
    ]
    return spark.createDataFrame(
        rows,
        "num_insee_search string, num_insee_valide string, commune_valide string, latitude double, longitude double, "
        "code_departement string, nom_departement string, code_region string, nom_region string",
    )


def test_one_place_per_code_or_all(spark):
    located = {r["idligne"]: r for r in L.locate_persons(persons(spark), search(spark)).collect()}
    assert len(located) == 3 and located[1]["ville_naissance"] == "ALEPH"
    assert (located[1]["origine_ville"], located[1]["origine_departement"], located[1]["origine_region"]) == ("N", "N", "O")
    assert located[2]["origine_ville"] == "O"
    assert (located[3]["ville_naissance"], located[3]["origine_region"]) == ("quoi", "N")
    fan_out = L.locate_persons(persons(spark), search(spark), keep_all=True).groupBy("idligne").count().collect()
    assert {r[0]: r[1] for r in fan_out} == {1: 2, 2: 4, 3: 1}


def test_analysis_view_and_excluded_count(spark):
    view = L.analysis_view(L.locate_persons(persons(spark), search(spark)))
    rows = {r["idligne"]: r for r in view.collect()}
    assert (rows[3]["nom_departement_naissance"], rows[3]["pays_deces"]) == ("CHILI", None)
    kept = L.home_deaths_with_excluded(view).collect()
    assert {(r["idligne"], r["nb_hors_france"]) for r in kept} == {(1, 1), (2, 1)}


def test_all_places_fills_only_the_main_list(spark):
    schema = (
        "num_insee string, nom_commune_postal string, code_postal string, latitude double, longitude double, "
        "code_commune string, code_departement string, nom_departement string, code_region string, nom_region string"
    )
    main = spark.createDataFrame(
        [("1", "UN", "", 1.0, 1.0, "1", None, "D", None, "R"), ("2", "DEUX", "", 1.0, 1.0, "1", "098", "D", "9", "R")], schema
    )
    overseas = spark.createDataFrame(
        [("3", "TROIS", "NC", "NC", 0.0, 0.0)],
        "num_insee string, commune string, nom_departement string, nom_region string, latitude double, longitude double",
    )
    countries = spark.createDataFrame(
        [("4", "CHILI", 5.0, 6.0), ("1", "IGNORE", 7.0, 8.0)],
        "num_insee string, nom_pays_fr string, latitude double, longitude double",
    )
    rows = {r["num_insee"]: r for r in L.all_places(main, overseas, countries).collect()}
    assert {k: (r["code_departement"], r["code_region"]) for k, r in rows.items()} == {
        "1": ("988", "98"),
        "2": ("988", "9"),
        "3": (None, None),
        "4": (None, None),
    }
    assert rows["4"]["nom_region"] == "CHILI" and rows["1"]["nom_commune_postal"] == "UN"


def test_chains_of_no_changes(spark):
    none = changes(spark, []).where("num_insee_avant = 'x'")
    assert L.latest_of_changes(none).collect() == [] and L.code_chains(none).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_counted_matches_equal_the_listed_ones(spark, seed):
    """Codes with several, equal, nameless and no places; persons without code or city."""
    rng = random.Random(seed)
    codes, names = ["a", "b", "c", "d", "none", None], ["x", "y", None]
    people = [
        (i, rng.choice(codes), rng.choice(["x", "q", "", None]), "P", rng.choice(codes), rng.choice(["x", "y", ""])) for i in range(60)
    ]
    places = [
        (rng.choice("abcd"), "v", rng.choice(names), 1.0, 1.0, "1", rng.choice(names), "1", rng.choice(names)) for _ in range(12)
    ]
    facts = spark.createDataFrame(people, persons(spark).schema)
    found = spark.createDataFrame(places, search(spark).schema)
    flags = ["origine_ville", "origine_departement", "origine_region"]
    listed = L.locate_persons(facts, found, keep_all=True).groupBy(*flags).count().collect()
    assert sorted(map(tuple, L.count_all_matches(facts, found).collect())) == sorted(map(tuple, listed))


def _join_rows(plan):
    """Rows that the joins of an executed plan put out, one number each."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _join_rows(plan.executedPlan())
    children = plan.children()
    below = [plan.plan()] if "QueryStage" in plan.nodeName() else [children.apply(i) for i in range(children.size())]
    found = [n for child in below for n in _join_rows(child)]
    return found + ([plan.metrics().get("numOutputRows").get().value()] if "Join" in plan.nodeName() else [])


def test_all_matches_of_codes_with_many_places(spark):
    """Names of one code are not brought to all codes that go with it."""
    codes, places = 12, 50
    persons = spark.range(codes * codes).select(
        F.concat(F.lit("c"), F.col("id") % codes).alias("num_insee_naissance"),
        F.concat(F.lit("c"), (F.col("id") / codes).cast("int")).alias("num_insee_deces"),
        F.lit("A").alias("ville_naissance"),
        F.lit("B").alias("ville_deces"),
    )
    search = spark.range(codes * places).select(
        F.concat(F.lit("c"), F.col("id") % codes).alias("num_insee_search"),
        F.concat(F.lit("v"), "id").alias("commune_valide"),
        F.concat(F.lit("d"), F.col("id") % codes).alias("nom_departement"),
        F.concat(F.lit("r"), F.col("id") % codes % 3).alias("nom_region"),
    )
    counts = L.count_all_matches(persons, search)
    found = {(r.origine_ville, r.origine_departement, r.origine_region): r.nb for r in counts.collect()}
    pair, same, near = places * places, codes, codes * codes // 3
    assert found == {
        ("O", "O", "O"): same * places,
        ("N", "O", "O"): same * (pair - places),
        ("N", "N", "O"): (near - same) * pair,
        ("N", "N", "N"): (codes * codes - near) * pair,
    }
    assert max(_join_rows(counts._jdf.queryExecution().executedPlan())) < codes * codes * places


def _broadcast_rows(plan):
    """Rows of the broadcasts of an executed plan, one number each."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _broadcast_rows(plan.executedPlan())
    children = plan.children()
    below = [plan.plan()] if "QueryStage" in plan.nodeName() else [children.apply(i) for i in range(children.size())]
    found = [n for child in below for n in _broadcast_rows(child)]
    return found + ([plan.metrics().get("numOutputRows").get().value()] if plan.nodeName() == "BroadcastExchange" else [])


def test_names_of_places_are_not_broadcast(spark, monkeypatch):
    """40,000 places of different names, stored in a few bytes each: their rows do not go through the driver."""
    codes, places = 20, 40_000
    persons = spark.range(codes * codes).select(
        F.concat(F.lit("c"), F.col("id") % codes).alias("num_insee_naissance"),
        F.concat(F.lit("c"), (F.col("id") / codes).cast("int")).alias("num_insee_deces"),
        F.lit("A").alias("ville_naissance"),
        F.lit("B").alias("ville_deces"),
    )
    search = spark.range(places).select(
        F.concat(F.lit("c"), F.col("id") % codes).alias("num_insee_search"),
        F.concat(F.lit("v"), "id").alias("commune_valide"),
        F.concat(F.lit("d"), F.col("id") % codes).alias("nom_departement"),
        F.lit("r").alias("nom_region"),
    )
    executed = []
    cut = L.cut_lineage

    def stored(df):
        df.collect()
        executed.append(df)
        return cut(df)

    monkeypatch.setattr(L, "cut_lineage", stored)
    counts = L.count_all_matches(persons, search)
    found = {(r.origine_ville, r.origine_departement, r.origine_region): r.nb for r in counts.collect()}
    each = places // codes
    assert found == {
        ("O", "O", "O"): places,
        ("N", "O", "O"): codes * each * (each - 1),
        ("N", "N", "O"): codes * (codes - 1) * each * each,
    }
    rows = [n for df in [*executed, counts] for n in _broadcast_rows(df._jdf.queryExecution().executedPlan())]
    assert rows and max(rows) < places // 10


def test_persons_do_not_move_for_few_places(spark):
    """Few places counted from many rows: the persons meet them without an exchange."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50000")
    try:
        found = search(spark)
        many = found.crossJoin(spark.range(20_000)).drop("id")
        plan = L.locate_persons(persons(spark), many)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        # Stored places give the same rows.
        assert sorted(map(str, L.locate_persons(persons(spark), many).collect())) == sorted(
            map(str, L.locate_persons(persons(spark), found).collect())
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
