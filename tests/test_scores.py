import math

import pytest
from pyspark.sql import functions as F

from sectoria.operators import profiles as P
from sectoria.operators import scores as S
from sectoria.operators.association import spearman
from sectoria.plans.dashboard import sector_pages

FLAGS = ["origine_ville", "origine_departement", "origine_region", "origine_nationale"]


@pytest.fixture(scope="module")
def people(spark):
    """Two departments, three cities; city C has no native."""
    rows = [
        ("D1", "A", 70, 0.0, "O"),
        ("D1", "A", 95, 0.0, "O"),
        ("D1", "A", 71, 100.0, "N"),
        ("D1", "B", 10, 10.0, "N"),
        ("D1", "B", 72, 0.0, "O"),
        ("D2", "C", 73, 500.0, "N"),
        ("D2", "C", 40, 300.0, "N"),
    ]
    df = spark.createDataFrame(rows, "nom_departement_deces string, ville_deces string, age int, distance double, o string")
    df = df.withColumns({flag: F.col("o") for flag in FLAGS})
    from sectoria.functions.classes import age_class

    return df.withColumns(
        {
            "idligne": F.monotonically_increasing_id(),
            "pays_deces": F.lit("FRANCE"),
            "nom_region_deces": F.lit("R"),
            "classe_age": age_class(F.col("age")),
        }
    )


def test_sector_scores_by_hand(people):
    scores = {r["ville_deces"]: r for r in S.sector_scores(people, "ville_deces").collect()}
    a = scores["A"]
    assert (a["deces"], a["nb_natif"], a["nb_exogene"]) == (3, 2, 1)
    assert (a["distance_natif"], a["distance_exogene"]) == (0.0, 100.0)
    assert (a["med_distance_natif"], a["med_distance_exogene"]) == (0.0, 100.0)
    assert a["TAFV"] == 0.667 and a["mobilite_secteur"] == round(math.log(101) / 3, 3)
    logs = [math.log1p(d) for d in (0, 0, 100, 10, 0, 500, 300)]
    mean = sum(logs) / 7
    std = math.sqrt(sum((x - mean) ** 2 for x in logs) / 6)
    assert a["moy_distance"] == pytest.approx(mean) and a["std_distance"] == pytest.approx(std)
    assert a["IMD"] == pytest.approx((mean - a["mobilite_secteur"]) / std, abs=6e-4)
    assert (scores["C"]["TAFV"], scores["C"]["med_distance_natif"], scores["C"]["med_distance_exogene"]) == (0.0, None, 400.0)
    # Cities B and C share ranks 2 and 3: the average 2.5 is cut to 2.
    assert {k: r["rang_deces"] for k, r in scores.items()} == {"A": 1, "B": 2, "C": 2}
    assert S.sectors_without_natives(S.sector_scores(people, "ville_deces")).first()[0] == 1


def test_own_and_given_baseline_agree(people):
    own = S.sector_scores(people, "nom_departement_deces", by_age=True).drop("moy_distance", "std_distance")
    given = S.sector_scores(people, "nom_departement_deces", S.age_baseline(people), by_age=True).drop(
        "moy_distance", "std_distance"
    )
    assert sorted(map(str, own.collect())) == sorted(map(str, given.collect()))


def test_all_levels_contain_each_level_and_add_up(people):
    rows = S.all_level_scores(people).collect()
    assert {r["niveau"] for r in rows} == set(S.LEVELS[1:])
    for level in S.LEVELS[1:]:
        assert sum(r["deces"] for r in rows if r["niveau"] == level) == 7
    assert all(r["nb_natif"] + r["nb_exogene"] == r["deces"] for r in rows)
    single = {r["ville_deces"]: r["IMD"] for r in S.sector_scores(people, "ville_deces").collect()}
    assert {r["ville_deces"]: r["IMD"] for r in rows if r["niveau"] == "ville_deces"} == single


def test_shuffled_rows_change_nothing(people):
    first = S.all_level_scores(people.repartition(1)).collect()
    second = S.all_level_scores(people.repartition(9)).collect()
    strip = lambda rows: sorted(str([v for k, v in r.asDict().items() if k not in ("moy_distance", "std_distance")]) for r in rows)
    assert strip(first) == strip(second)


def test_pages_and_extremes(people):
    matrix = sector_pages(people, "ville_deces", by_age=True)
    assert {r["page"] for r in matrix.collect()} == {1}
    cells = S.extreme_cells(matrix, "ville_deces", "TAFV").orderBy("rang").collect()
    assert [(c["ville_deces"], c["classe_age"], c["TAFV"]) for c in cells[:2]] == [("A", "90+", 1.0), ("B", "65-90", 1.0)]
    assert len(cells) == 5
    lines = S.extreme_lines(matrix, "ville_deces", "TAFV").first()
    assert (lines["classe_extreme"], lines["secteur_extreme"]) == ("65-90", "A")
    ranked = people.sparkSession.range(1, 101).select(F.col("id").alias("rang_deces"))
    assert S.pages(ranked).count() == 100 and S.pages(ranked, max_pages=3).count() == 60


def test_states(spark):
    def state(values, measure="TAFV"):
        return S.overall_state(spark.createDataFrame([(v,) for v in values], f"{measure} double"), measure).first()["etat"]

    assert state([0.9, 0.1, 0.8]) == "originaire" and state([0.1, 0.2]) == "exogene"
    assert state([0.9, 0.1]) == "neutre" and state([0.5, 0.5, 0.9]) == "neutre"
    assert state([1.0], "IMD") == "inertie" and state([-1.0, -2.0, 1.0], "IMD") == "mobile"


def test_profile_ties_and_missing_names(spark):
    rows = [("2024", "1", "1", "Zoe", 0.0, 20), ("2024", "1", "1", "Abe", 5.0, 95), ("2024", "1", "2", None, 7.0, 130)]
    df = spark.createDataFrame(
        rows, "annee string, num_insee_deces string, sex string, prenom string, distance double, age int"
    ).withColumns(
        {"idligne": F.lit(1), "date_deces_dt": F.lit("2024-02-03").cast("date"), **{f: F.lit("O") for f in FLAGS}}
    )
    row = P.commune_year_profile(df).first()
    assert (row["name_man"], row["name_woman"]) == ("Abe", None)
    assert (row["nb_deces"], row["nb_woman"], row["distance_tot"], row["Feb"], row["Jan"]) == (3, 1, 12.0, 3, 0)
    assert (row["nb_deces_0_30"], row["nb_deces_plus_90"], row["distance_tot_plus_90"]) == (1, 1, 5.0)


def test_statistics_and_shares(people):
    row = P.sector_statistics(people, "origine_ville").first()
    assert (row["pct_originaire"], row["pct_exogene"], row["ind_TAFV"]) == (42.86, 57.14, 0.4)
    assert (row["distance_med_originaire"], row["distance_med_exogene"]) == (0.0, 200.0)
    shares = P.class_shares(people, "classe_age").collect()
    assert sum(r["pourcentage"] for r in shares) == pytest.approx(100, abs=0.01)


def test_selection_summary(spark):
    cube = spark.createDataFrame([(1.0, 2.0, 30), (3.0, 4.0, 20)], "lat double, lon double, nb_deces int")
    row = P.selection_summary(cube, F.lit(5)).first()
    assert tuple(row) == (50, True, 10.0, 2.0, 3.0)


def test_pairs_leave_out_missing_values(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None)], "a int, b int")
    assert [r["effectif"] for r in spearman(df, [("a", "b")]).collect()] == [2]
