import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectoria.operators import quantiles as Q
from sectoria.operators import summaries as U
from sectoria.operators.positions import with_position, with_running_total


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belongs to one group, and a third to one value."""
    rng = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"g{rng.randrange(40)}", rng.choice([7, rng.randrange(500)]), i) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "g string, v int, i int").repartition(6)


def test_position_is_the_global_order(skewed):
    rows, df = skewed
    got = {r["i"]: r["position"] for r in with_position(df, ["v", "i"]).collect()}
    expected = {i: k for k, (_, _, i) in enumerate(sorted(rows, key=lambda r: (r[1], r[2])), start=1)}
    assert got == expected


def test_position_restarts_in_each_group(skewed):
    rows, df = skewed
    got = {r["i"]: r["position"] for r in with_position(df, ["v", "i"], by=["g"]).collect()}
    expected = {}
    for group in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == group), key=lambda r: (r[1], r[2]))
        expected |= {r[2]: k for k, r in enumerate(members, start=1)}
    assert got == expected


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, v int")
    got = {r["v"]: r["position"] for r in with_position(df, ["v"], by=["g"]).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_running_totals(skewed):
    _, df = skewed
    counts = df.groupBy("g", "v").agg(F.count("i").alias("n"), F.sum("i").alias("s"))
    local = {(r["g"], r["v"]): (r["n"], r["s"]) for r in counts.collect()}
    for row in with_running_total(counts, ["v"], ["n", "s"], by=["g"], totals=True).collect():
        before = [x for (g, v), x in local.items() if g == row["g"] and v < row["v"]]
        group = [x for (g, _), x in local.items() if g == row["g"]]
        assert row["before_n"] == sum(n for n, _ in before) and row["before_s"] == sum(s for _, s in before)
        assert row["total_n"] == sum(n for n, _ in group) and row["total_s"] == sum(s for _, s in group)


def test_quantiles_match_linear_interpolation(skewed):
    rows, df = skewed
    levels = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    assert Q.quantiles(df, "v", levels).first()[0] == pytest.approx(np.quantile([r[1] for r in rows], levels))
    for row in Q.quantiles(df, "v", levels, by=["g"]).collect():
        assert row["quantiles"] == pytest.approx(np.quantile([r[1] for r in rows if r[0] == row["g"]], levels))


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_by_every_path(spark, monkeypatch, seed):
    """Brackets that hold few, many or none of the values, groups of one value, null keys and odd numbers."""
    rng = random.Random(seed)
    rows = [("many", rng.gauss(0, 1)) for _ in range(5000)] + [("ties", float(rng.randint(0, 3))) for _ in range(500)]
    rows += [("one", 7.0), ("two", -1.0), ("two", 5.0), (None, 2.0), (None, 4.0), (None, None), ("none", None)]
    rows += [("edge", x) for x in (math.inf, -math.inf, 0.0, -0.0, 1e300)]
    df = spark.createDataFrame(rows, "g string, v double")
    levels = [0.0, 0.1, 1 / 3, 0.5, 0.9995, 1.0]
    plain = {}
    for g, v in rows:
        plain.setdefault(g, []).append(v)
    for accuracy, near in ((1000, 100_000), (1000, 2), (10, 50), (10, 0)):
        monkeypatch.setattr(Q, "ACCURACY", accuracy)
        monkeypatch.setattr(Q, "NEAR", near)
        found = {r["g"]: r["quantiles"] for r in Q.quantiles(df, "v", levels, by=["g"]).collect()}
        assert set(found) == {"many", "ties", "one", "two", "edge", None}
        for g in ("many", "ties", "one", "two", None):
            assert found[g] == pytest.approx(np.quantile([v for v in plain[g] if v is not None], levels))
        assert found["edge"][0] == -math.inf and found["edge"][3] == 0.0 and found["edge"][5] == math.inf


def test_quantiles_whose_brackets_miss(spark, monkeypatch):
    """Approximate quantiles of another column: every rank lies outside its bracket."""
    df = spark.range(2000).select(F.col("id").cast("double").alias("v"))
    monkeypatch.setattr(Q.F, "percentile_approx", lambda c, p, a: F.first(F.transform(p, lambda x: x * 10)))
    assert Q.quantiles(df, "v", [0.25, 0.5]).first()[0] == pytest.approx([499.75, 999.5])


def test_quantiles_without_values(spark):
    none = spark.createDataFrame([(None, "a")], "v double, g string")
    assert Q.quantiles(none, "v", [0.5]).collect()[0][0] == [None]
    assert Q.quantiles(none, "v", [0.5], by=["g"]).collect() == []


def test_both_quantile_paths_agree(skewed):
    _, df = skewed
    small = {r["g"]: r["quantiles"] for r in Q.small_domain_quantiles(df, "v", [0.3, 0.5], by=["g"]).collect()}
    large = {r["g"]: r["quantiles"] for r in Q.quantiles(df, "v", [0.3, 0.5], by=["g"]).collect()}
    assert small.keys() == large.keys()
    for group, found in small.items():
        assert found == pytest.approx(large[group])


def test_quantile_classes_cover_all_rows(spark):
    df = spark.createDataFrame([(float(i * 1000),) for i in range(10)] + [(None,)], "x double")
    rows = Q.with_quantile_class(df, "x", 3, "classe").orderBy("x").collect()
    assert [r["classe_ordre"] for r in rows] == [None, 1, 1, 1, 1, 2, 2, 2, 3, 3, 3]
    assert rows[1]["classe"] == "]0,3 000]" and rows[-1]["classe"] == "]6 000,9 000]"


def test_outliers_and_zscore(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 100]], "x double")
    assert [r["x"] for r in Q.iqr_outliers(df, "x").collect()] == [100.0]
    scores = [r["zscore"] for r in Q.with_zscore(df, "x").collect()]
    assert sum(scores) == pytest.approx(0) and sum(s * s for s in scores) == pytest.approx(6)


def test_automatic_bins_and_density(spark):
    """The larger number of bins of numpy's two rules, the curve against the sum over all values, and columns without spread."""
    rng = random.Random(4)
    for values in ([rng.gauss(5, 2) for _ in range(400)], [1.0] * 30 + [2.0, 9.0], [rng.expovariate(1) for _ in range(50)]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        rules = ["sturges", "fd"] if np.ptp(np.quantile(values, [0.25, 0.75])) else ["sturges"]
        counts, edges = max((np.histogram(values, bins=rule) for rule in rules), key=lambda h: len(h[0]))
        rows = U.histogram(df, "v", bins=None).orderBy("classe").collect()
        assert [r.effectif for r in rows] == counts.tolist()
        assert [r.debut for r in rows] == pytest.approx(edges[:-1].tolist())
        width = np.std(values, ddof=1) / len(values) ** 0.2
        for r in U.density_curve(df, "v", points=20).collect():
            exact = np.exp(-(((r.x - np.array(values)) / width) ** 2) / 2).sum() / (len(values) * width * math.sqrt(2 * math.pi))
            assert r.densite == pytest.approx(exact, abs=1e-3)
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [tuple(r) for r in U.histogram(same, "v", bins=None).collect()] == [(1, 3.0, 3.0, 2)]
    assert U.density_curve(same, "v").collect() == [] == U.histogram(same.where("false"), "v", bins=None).collect()


def test_rows_do_not_move_for_the_parts_of_groups(spark):
    """The parts are few, and known to be: they are sent to the rows even if the rows are beyond the broadcast limit."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50000")
    try:
        df = spark.range(200_000).select((F.col("id") % 3).cast("string").alias("g"), F.xxhash64("id").alias("v"))
        plan = with_position(df, ["v"], by=["g"])._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
