import re

import pytest
from pyspark.sql import functions as F

from sectoria.operators import cleaning as C


def person(**changes):
    row = {
        "nom": "A",
        "prenom": "B",
        "sex": "1",
        "date_naissance": "19500101",
        "num_insee_naissance": "75056",
        "ville_naissance": "PARIS",
        "pays_naissance": "FRANCE",
        "date_deces": "20240101",
        "num_insee_deces": "2A004",
    }
    return tuple((row | changes).values())


SCHEMA = ", ".join(f"{r.field} string" for r in C.PERSON_CONTRACT)


def test_contract_lists_every_failure(spark):
    rows = [
        person(),
        person(sex="3", date_naissance="1950"),
        person(nom=None),
        person(pays_naissance=None),
        person(num_insee_deces="7505"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    checked = C.with_contract(df, C.PERSON_CONTRACT)
    assert C.valid_rows(df, C.PERSON_CONTRACT).count() == 2
    assert C.valid_rows(df, C.PERSON_CONTRACT).where("pays_naissance = 'FRANCE'").count() == 2
    failures = sorted([(e["champ"], e["type"]) for e in r["erreurs"]] for r in C.rejected_rows(checked).collect())
    assert failures == [
        [("nom", "missing")],
        [("num_insee_deces", "string_pattern_mismatch")],
        [("sex", "literal_error"), ("date_naissance", "string_pattern_mismatch")],
    ]
    assert {r[0]: r[1] for r in C.error_counts(checked).collect()} == {
        "nom": 1,
        "num_insee_deces": 1,
        "sex": 1,
        "date_naissance": 1,
    }


@pytest.mark.parametrize("bad, kept", [(4, 96), (5, 100)])
def test_gate_removes_flagged_rows_only_when_rare(spark, bad, kept):
    df = spark.range(100).withColumn("flag", F.when(F.col("id") < bad, "ko").otherwise("ok"))
    assert C.through_gates(df, [F.col("flag")], "id").count() == kept


def test_later_gate_sees_the_rows_left_by_the_earlier_one(spark):
    # 4 of 100 rows go first; 5 of the remaining 96 are flagged next, which is 5.21 percent: they stay.
    df = spark.range(100).select(
        "id",
        F.when(F.col("id") < 4, "ko").otherwise("ok").alias("a"),
        F.when(F.col("id").between(2, 8), "ko").otherwise("ok").alias("b"),
    )
    row = C.gate_decisions(df, [F.col("a"), F.col("b")], "id").first()
    assert (row["taux_0"], row["retire_0"], row["taux_1"], row["retire_1"]) == (4.0, True, 5.21, False)
    assert C.through_gates(df, [F.col("a"), F.col("b")], "id").count() == 96


def test_gates_decide_per_year(spark):
    df = spark.range(200).select(
        (F.col("id") % 2).cast("string").alias("year"),
        "id",
        F.when((F.col("id") < 3) | (F.col("id") % 20 == 1), "ko").otherwise("ok").alias("a"),
    )
    left = {r[0]: r[1] for r in C.through_gates(df, [F.col("a")], "id", by=["year"]).groupBy("year").count().collect()}
    assert left == {"0": 98, "1": 100}


def test_checked_dates(spark):
    rows = [person(), person(), person(date_naissance="16450513"), person(date_naissance="20230230")]
    checked = C.checked_dates(spark.createDataFrame(rows, SCHEMA), "2024")
    assert [str(r["date_deces_dt"]) for r in checked.collect()] == ["2024-01-01"]


def test_repair_rules(spark):
    cities = {
        "ANCIEN DEPARTEMENT ORAN": ("ALGERIE", "99352"),
        "ANCIEN NIGERIA": ("NIGER", "99337"),
        "ANCIENNE COTE D IVOIRE": ("COTE D'IVOIRE", "99326"),
        "DEPARTEMENT ALGER ANCIEN TOGO": ("TOGO", "99345"),
        "SUD HONGRIE": ("FRANCE", "0"),
        "ORAN": ("FRANCE", "0"),
        None: ("FRANCE", "0"),
    }
    df = spark.createDataFrame([(c, "FRANCE", "0") for c in cities], "v string, p string, n string")
    got = {r["v"]: (r["p"], r["n"]) for r in C.repaired_places(df, city="v", country="p", code="n").collect()}
    assert got == cities


def test_first_per_key_and_duplicates(spark):
    rows = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q"), ("b", 5, "r")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert sorted(tuple(r) for r in C.first_per_key(df, ["k"], ["o"]).collect()) == [("a", 1, "y"), ("b", None, "q")]
    report = C.duplicate_report(spark.createDataFrame([(1, None)] * 3 + [(2, 2)], "a int, b int")).collect()
    assert [tuple(r) for r in report] == [(1, None, 2)]


def test_yearly_ids_of_small_and_large_years(spark):
    df = spark.createDataFrame([("2023", 5), ("2024", 9), ("2024", 7)], "annee string, k int")
    ids = {r["k"]: r["idligne"] for r in C.with_yearly_ids(df, "annee", ["k"]).collect()}
    assert ids == {5: 20230000000000, 7: 20240000000000, 9: 20240000000001}
    large = spark.range(1_000_001).select(F.lit("2022").alias("annee"), F.col("id").cast("int").alias("k"))
    both = C.with_yearly_ids(df.unionByName(large), "annee", ["k"])
    assert {r["k"]: r["idligne"] for r in both.where("annee > '2022'").collect()} == ids
    row = both.where("annee = '2022'").agg(F.min("idligne"), F.max("idligne")).first()
    assert tuple(row) == (20220000000000, 20220001000000)


def test_gates_and_ids_deal_no_rows_by_year(spark):
    rows = [(y, "ok" if i % 50 else "ko", i) for y in ("2001", "2002", None) for i in range(200)]
    df = spark.createDataFrame(rows, "year string, flag string, id int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        gated = C.through_gates(df, [F.col("flag")], "id", by=["year"])
        numbered = C.with_yearly_ids(df, "year", ["id"])
        for result in (gated, numbered):
            result.collect()
            plan = result._jdf.queryExecution().executedPlan().toString()
            final = plan.split("Initial Plan")[0]
            # Rows are never dealt by the year alone, only its counts are: those shuffles hold no "id".
            by_year = [line for line in final.splitlines() if re.search(r"hashpartitioning\(year#\d+, ", line)]
            assert len(by_year) <= (1 if result is gated else 2)
        assert "Join" not in gated._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert gated.where("year is null").count() == 196
    kept = C.through_gates(df, [F.when(F.col("id") % 2 == 0, "ko").otherwise("ok")], "id", by=["year"])
    assert kept.where("year is null").count() == 200


def test_overrides_sentinels_and_missing(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    fixed = spark.createDataFrame([(2, "B", 9)], "k int, v string, extra int")
    assert sorted(tuple(r) for r in C.with_overrides(df, "k", fixed).collect()) == [(1, "a", None), (2, "B", 9)]
    numbers = C.to_number(spark.createDataFrame([("1.5",), ("NONE",), (None,)], "x string"), "x", ["NONE"])
    assert sorted([r["x"] for r in numbers.collect()], key=str) == [1.5, None]
    rows = [("COMMUNE FICTIVE", 1.0, 1.0, "1", "1"), (None, 1.0, 1.0, None, "1"), ("X", 1.0, None, "1", "1")]
    people = spark.createDataFrame(
        rows,
        "ville_naissance string, latitude_naissance double, latitude_deces double, "
        "code_departement_naissance string, code_departement_deces string",
    ).withColumn("date_deces_dt", F.lit("2024-02-03").cast("date"))
    assert C.located_only(people).count() == 0
    kept = C.located_only(people, strict=False).collect()
    assert [(r["month_deces"], r["day_deces"]) for r in kept] == [("Feb", 3)]


def test_load_types(spark):
    df = spark.createDataFrame([(1, float("nan"), "x"), (2, 1.5, None)], "k int, v double, t string").withColumn(
        "d", F.lit("2024-02-03 10:00:00").cast("timestamp")
    )
    loaded = C.load_types(df, drop=["t", "absent"])
    assert dict(loaded.dtypes) == {"k": "int", "v": "double", "d": "date"}
    assert sorted([r["v"] for r in loaded.collect()], key=str) == [1.5, None]


def test_dates_are_read_once_for_all_their_conditions(spark):
    rows = [("2001", "A", "19500102", "20010304"), ("2001", "B", "19501340", "20010304"), ("2001", "C", "19500102", "16000101"), ("2001", "D", None, "20010305")]
    df = spark.createDataFrame(rows, "annee string, nom string, date_naissance string, date_deces string")
    found = C.dated_rows(df, "0000").withColumn("age", F.datediff("date_deces_dt", "date_naissance_dt"))
    assert [(r.nom, str(r.date_naissance_dt), str(r.date_deces_dt), r.age) for r in found.collect()] == [("A", "1950-01-02", "2001-03-04", 18689)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Each of the two texts once; a date is named twice in the plan of its one reading.
    assert plan.count("gettimestamp(date_") + plan.count("try_to_timestamp(date_") <= 4
