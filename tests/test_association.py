import itertools
import math
import random
from fractions import Fraction
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from sectoria.operators import association as A
from sectoria.operators.lookups import look_up


def sign(x):
    return (x > 0) - (x < 0)


def brute_kendall(rows):
    score = free_x = free_y = 0
    for (a, b), (c, d) in itertools.combinations(rows, 2):
        score += sign(a - c) * sign(b - d)
        free_x += a != c
        free_y += b != d
    return score / math.sqrt(free_x * free_y)


def test_kendall_equals_all_pairs(spark):
    """Few values with many ties, more values, a missing value, a column against itself turned round."""
    rng = random.Random(2)
    rows = [
        (i, float(rng.randrange(4)), float(rng.randrange(3)), float(rng.randrange(200)), -i, None if i == 5 else i % 7)
        for i in range(120)
    ]
    names = ["i", "few", "fewer", "many", "opposite", "gap"]
    df = spark.createDataFrame(rows, "i int, few double, fewer double, many double, opposite int, gap int")
    pairs = [("few", "fewer"), ("fewer", "few"), ("many", "few"), ("i", "many"), ("i", "opposite"), ("gap", "many")]
    found = {(r["variable_x"], r["variable_y"]): r for r in A.kendall(df, pairs).collect()}
    for a, b in pairs:
        both = [(r[names.index(a)], r[names.index(b)]) for r in rows]
        expected = brute_kendall([p for p in both if None not in p])
        assert found[a, b]["coefficient"] == pytest.approx(expected, abs=1e-12)
    assert found["i", "opposite"]["coefficient"] == -1.0 and found["i", "opposite"]["p_value"] < 1e-10
    assert found["gap", "many"]["effectif"] == 119


def test_kendall_exact_p_of_small_samples(spark):
    """Against all orders of up to 8 values; ties and larger samples take the normal approximation."""
    rng = random.Random(6)

    def inversions(order):
        return sum(order[i] > order[j] for i in range(len(order)) for j in range(i + 1, len(order)))

    counts = {n: [inversions(p) for p in itertools.permutations(range(n))] for n in range(2, 9)}
    samples = {f"n{n}_{k}": rng.sample(range(n), n) for n in range(2, 9) for k in range(3)}
    for name, order in samples.items():
        found = inversions(order)
        n, fewer = len(order), min(found, len(order) * (len(order) - 1) // 2 - found)
        samples[name] = (order, min(1.0, 2 * sum(c <= fewer for c in counts[n]) / len(counts[n])))
    # Columns of different lengths in one table: each has nulls where the others go on.
    df = spark.createDataFrame(
        [tuple(float(o[i]) if i < len(o) else None for o, _ in samples.values()) + (float(i),) for i in range(9)],
        ", ".join(f"{n} double" for n in [*samples, "place"]),
    )
    result = {r.variable_x: r for r in A.kendall(df, [(n, "place") for n in samples]).collect()}
    for name, (order, p) in samples.items():
        assert result[name].p_value == pytest.approx(p, rel=1e-12), name
        assert result[name].coefficient == pytest.approx(brute_kendall(list(enumerate(order))), abs=1e-12)

    def p_of(order):
        rows = [(float(i), float(v)) for i, v in enumerate(order)]
        return A.kendall(spark.createDataFrame(rows, "a double, b double"), [("a", "b")]).first().p_value

    def normal(score, n):
        return math.erfc(abs(score) / math.sqrt(n * (n - 1) * (2 * n + 5) / 18) / math.sqrt(2))

    order = rng.sample(range(34), 34)
    score = 34 * 33 // 2 - 2 * inversions(order)
    assert p_of(order) == pytest.approx(normal(score, 34))
    # Known values: 33 in order but for one exchange, and 40 wholly in order.
    assert p_of([1, 0, *range(2, 33)]) == pytest.approx(2 / math.factorial(32))
    assert p_of(range(40)) == pytest.approx(2 / math.factorial(40))


def test_columns_are_ordered_once(spark, monkeypatch):
    """However many pairs: one order of all columns; pairs with nulls add rankings of their columns only."""
    calls = []
    running = A.with_running_total
    monkeypatch.setattr(A, "with_running_total", lambda *a, **k: calls.append(a[1]) or running(*a, **k))
    rng = random.Random(9)
    rows = [tuple(rng.choice([None, *range(9)]) if c > 2 else rng.random() for c in range(5)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d int, e int")
    pairs = A.all_pairs(list("abcde"))
    found = {(r.variable_x, r.variable_y): r for r in A.spearman(df, pairs).collect()}
    assert len(calls) == 1
    ranking = A._ranking(df, pairs)
    # a, b and c alone, each among the rows of d and of e, and d and e alone and among those of each other.
    assert len(set(sum(ranking.sides, ()))) == 3 + 6 + 2 + 2
    for a, b in pairs:
        both = [(r["abcde".index(a)], r["abcde".index(b)]) for r in rows]
        both = [p for p in both if None not in p]

        def ranks(values):
            return [sum(w < v for w in values) + (sum(w == v for w in values) + 1) / 2 for v in values]

        x, y = ranks([p[0] for p in both]), ranks([p[1] for p in both])
        mean = (len(both) + 1) / 2
        top = sum((u - mean) * (v - mean) for u, v in zip(x, y))
        bottom = math.sqrt(sum((u - mean) ** 2 for u in x) * sum((v - mean) ** 2 for v in y))
        assert found[a, b].effectif == len(both) and found[a, b].coefficient == pytest.approx(top / bottom)


def test_frequent_values_and_rare_ones(spark, monkeypatch):
    monkeypatch.setattr(A, "FREQUENT", 4)
    monkeypatch.setattr(A, "_SLICE", 7)
    rng = random.Random(1)
    rows = [(float(rng.choice([0, 0, 0, rng.randrange(50)])), float(rng.randrange(30))) for _ in range(150)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert A.kendall(df, [("a", "b")]).first().coefficient == pytest.approx(brute_kendall(rows), abs=1e-12)
    assert A.kendall(df.where("false"), [("a", "b")]).collect() == A.spearman(df.where("false"), [("a", "b")]).collect() == []


def test_large_tables_keep_their_digits(spark):
    """Nearly independent classes of 10^12 rows: the statistic is small beside the number of rows."""
    n = 10**12
    table = {("a", "x"): n // 4 + 10**6, ("a", "y"): n // 4, ("a", "z"): n // 4, ("b", "x"): n // 12, ("b", "y"): n // 12, ("b", "z"): n // 12}
    total = sum(table.values())
    exact = 0
    for (r, c), o in table.items():
        row = sum(v for (a, _), v in table.items() if a == r)
        column = sum(v for (_, b), v in table.items() if b == c)
        exact += Fraction((o * total - row * column) ** 2, row * column * total)
    cells = spark.createDataFrame([("p", "q", r, c, o) for (r, c), o in table.items()], "variable_x string, variable_y string, x string, y string, o long")
    found = A._tested(cells).first()
    assert found.khi2 == pytest.approx(float(exact), rel=1e-9) and found.ddl == 2


def test_spearman_uses_average_ranks(spark):
    rows = [(1.0, 2.0), (2.0, 1.0), (2.0, 3.0), (4.0, 3.0), (5.0, None)]
    row = A.spearman(spark.createDataFrame(rows, "a double, b double"), [("a", "b")]).first()
    rank_a, rank_b = [1, 2.5, 2.5, 4], [2, 1, 3.5, 3.5]
    mean = 2.5
    top = sum((x - mean) * (y - mean) for x, y in zip(rank_a, rank_b))
    bottom = math.sqrt(sum((x - mean) ** 2 for x in rank_a) * sum((y - mean) ** 2 for y in rank_b))
    assert row["effectif"] == 4 and row["coefficient"] == pytest.approx(top / bottom)


def test_spearman_p_value_of_a_known_table(spark):
    # rho = -29/165 over ten rows; the two-sided p-value comes from t with 8 degrees.
    x = [106, 86, 100, 101, 99, 103, 97, 113, 112, 110]
    y = [7, 0, 27, 50, 28, 29, 20, 12, 6, 17]
    row = A.spearman(spark.createDataFrame(list(zip(x, y)), "a int, b int"), [("a", "b")]).first()
    assert row["coefficient"] == pytest.approx(-29 / 165)
    assert row["p_value"] == pytest.approx(0.627188, abs=1e-5)


def test_matrix_has_both_triangles_and_the_diagonal(spark):
    df = spark.createDataFrame([(i, i * i, 7) for i in range(9)], "a int, b int, c int")
    for method in ("spearman", "kendall"):
        cells = {(r[0], r[1]): r[2] for r in A.correlation_matrix(df, ["a", "b", "c"], method).collect()}
        assert cells["a", "b"] == cells["b", "a"] == pytest.approx(1.0)
        assert cells["a", "a"] == 1.0 and cells["a", "c"] is None and ("c", "c") not in cells


def test_normal_quantile(spark):
    points = [1e-12, 1e-5, 0.02, 0.075, 0.3, 0.5, 0.9, 0.999999]
    df = spark.createDataFrame([(p,) for p in points], "p double")
    for p, z in df.select("p", A.normal_quantile(F.col("p"))).collect():
        assert z == pytest.approx(NormalDist().inv_cdf(p), abs=1e-9)


def test_shapiro(spark):
    """The published example, the smallest samples, a normal, a skewed and one beyond the published range."""
    rng = random.Random(3)
    samples = {
        "published": [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236],
        "three": [1.0, 2.0, 4.0],
        "four": [1.0, 2.0, 4.0, 4.5],
        "five": [1.0, 2.0, 4.0, 4.5, 9.0],
        "normal": [rng.gauss(0, 1) for _ in range(300)],
        "skewed": [rng.expovariate(1) for _ in range(300)],
        "large": list(range(5001)),
    }
    rows = [(name, float(x)) for name, sample in samples.items() for x in sample]
    df = spark.createDataFrame(rows, "name string, x double").select(
        *[F.when(F.col("name") == n, F.col("x")).alias(n) for n in samples]
    )
    found = {r["variable"]: r for r in A.shapiro_wilk(df, list(samples)).collect()}
    assert {n: r["n"] for n, r in found.items()} == {n: len(s) for n, s in samples.items()}
    assert all(0 < r["W"] <= 1 for r in found.values())
    assert found["published"]["W"] == pytest.approx(0.788815, abs=1e-5)
    assert found["published"]["p_value"] == pytest.approx(0.006704, abs=1e-5)
    # For three values W = (x3 - x1)^2 / (2 SS) and p = 6/pi (asin sqrt W - asin sqrt 3/4).
    w = 9 / 2 / (14 / 3)
    assert found["three"]["W"] == pytest.approx(w)
    assert found["three"]["p_value"] == pytest.approx(6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    assert found["normal"]["p_value"] > 0.001 > found["skewed"]["p_value"]
    assert found["large"]["p_value"] < 0.001
    assert {n for n, r in found.items() if r["extrapolated"]} == {"large"}


def test_chi_square(spark):
    cells = {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 30, ("b", "y"): 5}
    rows = [key for key, n in cells.items() for _ in range(n)]
    row = A.chi_square(spark.createDataFrame(rows, "r string, c string"), "r", "c").first()
    total, statistic = 65, 0.0
    for (r, c), n in cells.items():
        expected = sum(v for (a, _), v in cells.items() if a == r) * sum(v for (_, b), v in cells.items() if b == c) / total
        statistic += (abs(n - expected) - 0.5) ** 2 / expected
    assert row["khi2"] == pytest.approx(statistic) and row["ddl"] == 1
    assert row["p_value"] == pytest.approx(math.erfc(math.sqrt(statistic / 2)))


def test_expected_counts_include_empty_cells(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "y"), (None, "y")], "r string, c string")
    cells = {(r[0], r[1]): (r[2], r[3]) for r in A.expected_counts(df, "r", "c").collect()}
    assert cells["a", "y"] == (0, pytest.approx(2 / 3)) and len(cells) == 4


def test_decisions(spark):
    df = spark.createDataFrame([(0.01,), (0.05,), (None,)], "p double")
    assert [r[0] for r in df.select(A.decision(F.col("p"), "rejet", "non")).collect()] == ["rejet", "non", None]


def test_chi_squares_equal_the_whole_table(spark):
    """Statistic, degrees and small cells against the expected counts of every cell, empty ones included."""
    rng = random.Random(12)
    rows = [
        ("abcde"[min(4, int(rng.expovariate(0.7)))], "uvwxyz"[min(5, int(rng.expovariate(0.5)))], rng.random() < 0.4, "one")
        for _ in range(240)
    ] + [(None, "u", True, "one")]
    df = spark.createDataFrame(rows, "a string, b string, c boolean, d string").withColumn("e", F.col("b") < "v")
    pairs = [("a", "b"), ("c", "e"), ("b", "c"), ("a", "d")]
    found = {(r.variable_x, r.variable_y): r for r in A.chi_squares(df, pairs).collect()}
    assert set(found) == set(pairs)
    for (x, y), r in found.items():
        table = A.expected_counts(df, x, y).collect()
        ddl = (len({t[0] for t in table}) - 1) * (len({t[1] for t in table}) - 1)
        gaps = [(abs(t.observe - t.attendu), t.attendu) for t in table]
        statistic = sum((g - (min(g, 0.5) if ddl == 1 else 0)) ** 2 / e for g, e in gaps)
        assert (r.ddl, r.effectif) == (ddl, sum(t.observe for t in table))
        assert r.khi2 == pytest.approx(statistic, abs=1e-9)
        assert r.nb_cellules_inf5 == sum(t.attendu < 5 for t in table)


def test_rows_without_a_rare_value_are_spread(spark):
    """Rows whose value was found among the frequent ones, or is missing, do not meet in one task of the join."""
    rows = spark.range(4000).select("id", F.when(F.col("id") % 3 > 0, (F.col("id") % 2).cast("double")).alias("x"))
    values = spark.range(1500).select(
        F.col("id").cast("double").alias("value"), (F.col("id") * 10).alias("code"), (F.col("id") < 2).alias("frequent")
    )
    kept = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = look_up(rows, F.col("x"), values, ["code"]).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert sorted((r.id, r.code) for r in found) == [(i, i % 2 * 10 if i % 3 else None) for i in range(4000)]
    held = [sum(r.task == t for r in found) for t in {r.task for r in found}]
    assert max(held) < len(found) / 2


def test_values_that_are_all_frequent_move_no_row(spark):
    rows = spark.range(100).select((F.col("id") % 5).alias("a"), (F.col("id") % 7).alias("b"))
    ranking = A._ranking(rows, [("a", "b")])
    assert "SortMergeJoin" not in ranking.rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in ranking.rows._jdf.queryExecution().executedPlan().toString()
    assert {r.rank_0 for r in ranking.rows.collect()} == {-40.0, -20.0, 0.0, 20.0, 40.0}
