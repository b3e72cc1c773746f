"""Properties of the physical plans that matter on large tables."""

import re

import pytest
from pyspark.sql import functions as F

from sectoria.operators import cleaning as C
from sectoria.operators import scores as S
from sectoria.queries import REGISTRY
from sectoria.queries.base import persons, table
from sectoria.operators import positions
from sectoria.plans import mortality
from sectoria.session import cut_lineage


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["territory_scores", "age_scores", "commune_year_profile", "located_persons", "search_table", "gated_rows", "cube_base"]
)
def test_no_product_and_no_python(spark, folder, name):
    plan = plan_of(REGISTRY[name].run(spark, folder))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan


def test_scan_reads_only_the_needed_columns(spark, folder):
    plan = plan_of(S.all_level_scores(persons(spark, folder)))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lines = [s for s in scans if "l_orderkey" in s]
    assert lines and all(set(re.findall(r"(l_\w+):", s)) == {"l_orderkey", "l_suppkey", "l_linenumber"} for s in lines)
    assert not any("o_totalprice" in s or "c_name" in s for s in scans)


def test_filters_reach_the_scan(spark, folder):
    plan = plan_of(C.complete_rows(table(spark, folder, "orders"), ["o_custkey"], {"o_orderpriority": "5-LOW"}))
    pushed = re.search(r"PushedFilters: \[(.*?)\], Read", plan).group(1)
    assert "IsNotNull(o_custkey)" in pushed and "Not(EqualTo(o_orderpriority,5-LOW))" in pushed


def test_scores_count_persons_before_the_medians(spark, folder):
    """The percentile aggregate stands above the counted cells, not above the persons."""
    plan = plan_of(S.sector_scores(persons(spark, folder), "ville_deces"))
    assert re.search(r"percentile\(.*_when|percentile\(CASE", plan)
    assert "count(idligne" in plan


def test_position_has_no_single_partition_over_rows(spark):
    from sectoria.operators.positions import with_position

    plan = plan_of(with_position(spark.range(1000).withColumn("v", F.col("id") % 7), ["v", "id"]))
    for block in plan.split("Exchange SinglePartition")[1:]:
        assert "_slice" in block.splitlines()[1]


def test_quantiles_order_no_rows(spark, folder, monkeypatch):
    """Brackets hold so few values that nothing is put into a global order."""
    from sectoria.operators import quantiles as Q

    def refuse(*_, **__):
        raise AssertionError("all rows are ordered")

    monkeypatch.setattr(Q, "with_running_total", refuse)
    for name in ("quantile_classes", "iqr_outliers", "describe"):
        plan = plan_of(REGISTRY[name].run(spark, folder))
        assert "rangepartitioning" not in plan and "CartesianProduct" not in plan


def test_duplicates_go_without_an_exchange_of_their_own(spark):
    """Equal records are dropped where ids are given; records that only a repair makes equal both stay."""
    columns = "nom prenom sex date_naissance num_insee_naissance ville_naissance pays_naissance date_deces num_insee_deces annee".split()
    city = "ANCIEN DEPARTEMENT ALGER"
    rows = [("A", "B", "1", "19500101", code, city, country, "20200102", "75056", "2020") for code, country in (
        ("91352", "ALGERIE"), ("99352", "ALGERIE"), ("99352", "FRANCE"), ("99352", "FRANCE"), ("91352", "ALGERIE"))]
    rows += [("C", "D", "2", "19400101", "13055", "MARSEILLE", "FRANCE", "20200102", "75056", "2020")] * 3
    records = cut_lineage(spark.createDataFrame(rows, columns))
    people = mortality.people_of(records).collect()
    assert sorted((p.idligne % 10**10, p.nom, p.num_insee_naissance, p.pays_naissance) for p in people) == [
        (0, "A", "99352", "ALGERIE"), (1, "A", "99352", "ALGERIE"), (2, "A", "99352", "ALGERIE"), (3, "C", "13055", "FRANCE")
    ]
    ranged = spark.createDataFrame(rows, columns).repartitionByRange("annee", "nom")
    once = ranged.dropDuplicates().drop("sex").sortWithinPartitions("annee", "nom")
    assert plan_of(once).split("Initial Plan")[0].count("Exchange") == 1


def test_ids_and_duplicates_share_one_exchange(spark, monkeypatch):
    """Neither the stored slices of the numbered persons nor anything before them is exchanged a second time."""
    stored = []
    monkeypatch.setattr(positions, "cut_lineage", lambda df: stored.append(plan_of(df)) or cut_lineage(df))
    columns = "nom prenom sex date_naissance num_insee_naissance ville_naissance pays_naissance date_deces num_insee_deces annee".split()
    row = ("A", "B", "1", "19500101", "13055", "MARSEILLE", "FRANCE", "20200102", "75056", "2020")
    mortality.people_of(cut_lineage(spark.createDataFrame([row, row], columns))).collect()
    assert "rangepartitioning" in stored[0]
    assert "hashpartitioning(nom" not in stored[0]
