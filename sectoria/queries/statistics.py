"""Summaries and tests on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import round_even
from ..operators import association as A
from ..operators import summaries as U
from .base import rounded, table
from .registry import query


@query(
    "A1",
    """SELECT l_returnflag, l_linestatus, count(*) AS nb, round_even(sum(l_quantity), 2) AS quantite,
  round_even(avg(l_extendedprice), 3) AS moyenne, min(l_discount) AS mini, max(l_tax) AS maxi,
  count(DISTINCT l_suppkey) AS fournisseurs FROM lineitem GROUP BY ALL""",
)
def group_summary(spark, folder):
    measures = [
        F.count(F.lit(1)).alias("nb"),
        round_even(F.sum("l_quantity"), 2).alias("quantite"),
        round_even(F.avg("l_extendedprice"), 3).alias("moyenne"),
        F.min("l_discount").alias("mini"),
        F.max("l_tax").alias("maxi"),
        F.count_distinct("l_suppkey").alias("fournisseurs"),
    ]
    return U.group_summary(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"], measures)


@query(
    "A5",
    """SELECT l_linenumber, round_even(avg(l_quantity) FILTER (WHERE l_returnflag = 'A'), 4) AS "A",
  round_even(avg(l_quantity) FILTER (WHERE l_returnflag = 'N'), 4) AS "N",
  round_even(avg(l_quantity) FILTER (WHERE l_returnflag = 'R'), 4) AS "R", 0.0::DOUBLE AS "X" FROM lineitem GROUP BY 1""",
)
def pivot_table(spark, folder):
    mean = round_even(F.avg("l_quantity"), 4)
    return U.pivot_table(
        table(spark, folder, "lineitem"), ["l_linenumber"], "l_returnflag", ["A", "N", "R", "X"], mean, fill=0.0
    )


@query(
    "A15",
    """SELECT l_returnflag, l_linestatus, count(*) AS n,
  round_even(count(*) / CAST(sum(count(*)) OVER (PARTITION BY l_returnflag) AS DOUBLE), 9) AS part
  FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def share_in_category(spark, folder):
    shares = U.share_in_category(table(spark, folder, "lineitem"), "l_returnflag", "l_linestatus")
    return shares.withColumn("part", rounded("part", 9))


def _number_sql(c: str) -> str:
    return f"""SELECT '{c}' AS variable, count({c}) AS count, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top,
  CAST(NULL AS BIGINT) AS freq, round_even(avg({c}), 3) AS mean, round_even(stddev_samp({c}), 3) AS std,
  CAST(min({c}) AS DOUBLE) AS min, round_even(quantile_cont({c}, 0.25), 3) AS q25,
  round_even(quantile_cont({c}, 0.5), 3) AS q50, round_even(quantile_cont({c}, 0.75), 3) AS q75,
  CAST(max({c}) AS DOUBLE) AS max FROM part"""


def _text_sql(c: str) -> str:
    return f"""SELECT '{c}', CAST(sum(n) AS BIGINT), count(*), min_by({c}, (-n, {c})), max(n), NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM (SELECT {c}, count(*) AS n FROM part WHERE {c} IS NOT NULL GROUP BY 1)"""


@query(
    "A29",
    " UNION ALL ".join([_number_sql(c) for c in ("p_partkey", "p_size", "p_retailprice")] + [_text_sql(c) for c in ("p_brand", "p_type", "p_name")]),
)
def describe(spark, folder):
    found = U.describe(table(spark, folder, "part"), ["p_partkey", "p_size", "p_retailprice"], ["p_brand", "p_type", "p_name"])
    return found.withColumns({c: rounded(c, 3) for c in ("mean", "std", "q25", "q50", "q75")})


_ORDER_COLUMNS = ("o_orderkey", "o_totalprice", "c_name", "c_acctbal")
_SOLVENT = "orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey"


@query(
    "A30",
    " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count(*) - count({c}) AS manquants, count({c}) AS presents FROM {_SOLVENT}"
        for c in _ORDER_COLUMNS
    ),
)
def missing_profile(spark, folder):
    solvent = table(spark, folder, "customer").where("c_acctbal > 0")
    joined = table(spark, folder, "orders").join(solvent, F.col("o_custkey") == F.col("c_custkey"), "left")
    return U.missing_profile(joined.select(*_ORDER_COLUMNS))


@query(
    "A31",
    """SELECT 'p_type' AS variable, p_type AS value, count(*) AS effectif FROM part GROUP BY p_type
  UNION ALL SELECT 'p_brand', p_brand, count(*) FROM part GROUP BY p_brand""",
)
def value_counts(spark, folder):
    return U.value_counts(table(spark, folder, "part"), ["p_type", "p_brand"]).orderBy("variable", F.desc("effectif"))


@query(
    "A32",
    """WITH e AS (SELECT min(value) AS low, max(value) AS high FROM events),
  counts AS (SELECT least(floor((value - low) / ((high - low) / 20)), 19) AS k, count(*) AS n FROM events, e GROUP BY 1)
  SELECT CAST(i + 1 AS INTEGER) AS classe, round_even(low + i * ((high - low) / 20), 6) AS debut,
    round_even(low + (i + 1) * ((high - low) / 20), 6) AS fin, coalesce(n, 0) AS effectif
  FROM e, range(20) AS r(i) LEFT JOIN counts ON k = i""",
)
def histogram(spark, folder):
    found = U.histogram(table(spark, folder, "events"), "value", bins=20)
    return found.select("classe", rounded("debut", 6), rounded("fin", 6), "effectif")


@query(
    "A32",
    """WITH e AS (SELECT min(value) AS low, max(value) AS high, count(value) AS n,
    quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM events),
  w AS (SELECT low, high, CAST(ceil((high - low) / CASE WHEN iqr > 0 THEN least(2 * iqr / cbrt(n), (high - low) / (log2(n) + 1))
    ELSE (high - low) / (log2(n) + 1) END) AS INTEGER) AS k FROM e),
  counts AS (SELECT least(floor((value - low) / ((high - low) / k)), k - 1) AS i, count(*) AS n FROM events, w GROUP BY 1)
  SELECT CAST(r.i + 1 AS INTEGER) AS classe, round_even(low + r.i * ((high - low) / k), 6) AS debut,
    round_even(low + (r.i + 1) * ((high - low) / k), 6) AS fin, coalesce(n, 0) AS effectif
  FROM (SELECT low, high, k, unnest(range(k)) AS i FROM w) r LEFT JOIN counts c ON c.i = r.i""",
)
def automatic_histogram(spark, folder):
    found = U.histogram(table(spark, folder, "events"), "value", bins=None)
    return found.select("classe", rounded("debut", 6), rounded("fin", 6), "effectif")


@query(
    "A32",
    """WITH m AS (SELECT min(value) AS low, max(value) AS high, stddev_samp(value) / power(count(value), 0.2) AS h, count(value) AS n
    FROM events),
  cells AS (SELECT least(floor((value - low) / ((high - low) / 4096)), 4095) AS cell, count(*) AS c FROM events, m GROUP BY 1)
  SELECT round_even(low + i * ((high - low) / 199), 6) AS x,
    round_even(sum(c * exp(-power((low + i * ((high - low) / 199) - (low + (cell + 0.5::DOUBLE) * ((high - low) / 4096))) / h, 2) / 2)
      / (n * h * sqrt(2 * pi()))), 9) AS densite
  FROM cells, m, range(200) AS r(i) GROUP BY low, high, i""",
)
def density_curve(spark, folder):
    curve = U.density_curve(table(spark, folder, "events"), "value")
    return curve.select(rounded("x", 6), rounded("densite", 9))


@query(
    "A33",
    """SELECT p_type, count(*) FILTER (WHERE p_size <= 10) AS petit, count(*) FILTER (WHERE p_size > 10) AS grand,
  CAST(0 AS BIGINT) AS vide FROM part GROUP BY 1""",
)
def contingency(spark, folder):
    part = table(spark, folder, "part").withColumn("taille", F.when(F.col("p_size") <= 10, "petit").otherwise("grand"))
    return U.contingency(part, "p_type", "taille", ["petit", "grand", "vide"])


# ---------------------------------------------------------------- tests


def _simpson(f: str, start: str, width: float, steps: int = 4000) -> str:
    """Integral of ``f`` (an expression of u) from ``start`` on by Simpson's rule, in SQL."""
    h = width / steps
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    body = f.replace("<u>", f"({start} + i * {h!r}::DOUBLE)")
    return f"({h / 3!r}::DOUBLE * list_sum(list_transform(range({steps + 1}), lambda i: {weight} * {body})))"


def _normal_tail(z: str) -> str:
    return _simpson("exp(-<u> * <u> / 2) / sqrt(2 * pi())", z, 14.0)


def _student_tail(t: str, degrees: str) -> str:
    """Upper tail for many degrees, beyond which nothing is left after 40."""
    density = f"""exp(lgamma(({degrees} + 1) / 2) - lgamma({degrees} / 2) - ({degrees} + 1) / 2 * ln(1 + <u> * <u> / {degrees}))
      / sqrt({degrees} * pi())"""
    return _simpson(density, t, 40.0, 8000)


def _chi_tail(x: str, degrees: str) -> str:
    """Upper tail of the root of chi-square."""
    return _simpson(f"power(2, 1 - {degrees} / 2) * power(<u>, {degrees} - 1) * exp(-<u> * <u> / 2) / gamma({degrees} / 2)", f"sqrt({x})", 14.0)


def _horner(coefficients, x: str) -> str:
    value = repr(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        value = f"({value} * {x} + {float(c)!r}::DOUBLE)"
    return value


_QUANTILE = f"""CASE WHEN abs(q) <= 0.425 THEN q * {_horner(A._CENTRE_UP, "r")} / {_horner(A._CENTRE_DOWN, "r")}
  WHEN s <= 5 THEN sign(q) * {_horner(A._NEAR_UP, "(s - 1.6)")} / {_horner(A._NEAR_DOWN, "(s - 1.6)")}
  ELSE sign(q) * {_horner(A._FAR_UP, "(s - 5.0)")} / {_horner(A._FAR_DOWN, "(s - 5.0)")} END"""


def _shapiro_sql(column: str, source: str, digits: int = 7) -> str:
    return f"""SELECT '{column}' AS variable, n, round_even(power(an * (h1 - l1) + ap * (h2 - l2)
      + (mx - m1 * (h1 - l1) - m2 * (h2 - l2)) / sqrt((s2 - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * an * an - 2 * ap * ap)), 2)
      / spread, {digits}) AS "W"
  FROM (SELECT *, {_horner([0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056], "u")} + m1 / sqrt(s2) AS an,
      {_horner([0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633], "u")} + m2 / sqrt(s2) AS ap
    FROM (SELECT n, 1 / sqrt(n) AS u, sum(m * m) AS s2, sum(m * x) AS mx, var_pop(x) * n AS spread,
        max(m) FILTER (WHERE i = n) AS m1, max(m) FILTER (WHERE i = n - 1) AS m2,
        max(x) FILTER (WHERE i = n) AS h1, max(x) FILTER (WHERE i = n - 1) AS h2,
        max(x) FILTER (WHERE i = 1) AS l1, max(x) FILTER (WHERE i = 2) AS l2
      FROM (SELECT x, i, n, {_QUANTILE} AS m FROM (SELECT *, 0.180625 - q * q AS r, sqrt(-ln(least(p, 1 - p))) AS s
        FROM (SELECT *, p - 0.5 AS q FROM (SELECT CAST({column} AS DOUBLE) AS x, n, i, (i - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS p
          FROM (SELECT {column}, row_number() OVER (ORDER BY {column}) AS i, count(*) OVER () AS n FROM {source}))))) GROUP BY n))"""


@query("T1", _shapiro_sql("o_totalprice", "orders") + " UNION ALL " + _shapiro_sql("o_custkey", "orders"))
def shapiro_statistics(spark, folder):
    found = A.shapiro_wilk(table(spark, folder, "orders"), ["o_totalprice", "o_custkey"])
    return found.select("variable", "n", rounded("W", 7))


_SHAPIRO_Z = f"""(ln(1 - "W") - {_horner([-1.5861, -0.31082, -0.083751, 0.0038915], "ln(n)")})
  / exp({_horner([-0.4803, -0.082676, 0.0030302], "ln(n)")})"""


@query(
    "T1 T6",
    f"""SELECT variable, n, round_even("W", 7) AS "W", round_even(p, 6) AS p_value, n > 5000 AS extrapolated,
  CASE WHEN p < 0.05 THEN 'non normale' ELSE 'normale' END AS decision
  FROM (SELECT *, CASE WHEN z < 0 THEN 1 - {_normal_tail("(-z)")} ELSE {_normal_tail("z")} END AS p
    FROM (SELECT *, {_SHAPIRO_Z} AS z FROM ({" UNION ALL ".join(_shapiro_sql(c, "part", 12) for c in ("p_size", "p_retailprice"))})))""",
)
def shapiro_tests(spark, folder):
    found = A.shapiro_wilk(table(spark, folder, "part"), ["p_size", "p_retailprice"])
    decided = found.withColumn("decision", A.decision(F.col("p_value"), "non normale", "normale"))
    return decided.withColumns({"W": rounded("W", 7), "p_value": rounded("p_value", 6)})


_LINE_PAIRS = [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax"), ("l_linenumber", "l_extendedprice")]


def _rank_sql(c: str) -> str:
    return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}"


def _spearman_sql(pairs, source: str) -> str:
    names = sorted({c for pair in pairs for c in pair})
    ranked = f"(SELECT {', '.join(_rank_sql(c) for c in names)} FROM {source})"
    return " UNION ALL ".join(
        f"SELECT '{a}' AS variable_x, '{b}' AS variable_y, round_even(corr({a}, {b}), 8) AS coefficient FROM {ranked}"
        for a, b in pairs
    )


@query("T2", _spearman_sql(_LINE_PAIRS, "lineitem"))
def spearman_coefficients(spark, folder):
    found = A.spearman(table(spark, folder, "lineitem"), _LINE_PAIRS)
    return found.select("variable_x", "variable_y", rounded("coefficient", 8))


def _with_decision(found):
    return found.withColumns(
        {
            "decision": A.decision(F.col("p_value"), "correlation monotone", "pas de correlation monotone"),
            "sens": A.direction(F.col("coefficient")),
        }
    )


def _rounded_test(found):
    return found.withColumns({"coefficient": rounded("coefficient", 8), "p_value": rounded("p_value", 6)})


_DECISION = """CASE WHEN p < 0.05 THEN 'correlation monotone' ELSE 'pas de correlation monotone' END AS decision,
  CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS sens"""


@query(
    "T2 T6",
    f"""SELECT variable_x, variable_y, effectif, round_even(r, 8) AS coefficient, round_even(p, 6) AS p_value, {_DECISION}
  FROM (SELECT *, 2 * {_student_tail("abs(r * sqrt((effectif - 2) / (1 - r * r)))", "(effectif - 2.0::DOUBLE)")} AS p FROM ({" UNION ALL ".join(
      f"SELECT '{a}' AS variable_x, '{b}' AS variable_y, count(*) AS effectif, corr({a}, {b}) AS r FROM (SELECT {_rank_sql(a)}, {_rank_sql(b)} FROM lineitem)"
      for a, b in _LINE_PAIRS)}))""",
)
def spearman_tests(spark, folder):
    return _rounded_test(_with_decision(A.spearman(table(spark, folder, "lineitem"), _LINE_PAIRS)))


_PART_MEASURES = """(SELECT p_size, p_retailprice, p_partkey % 37 AS reste, length(p_name) AS lettres,
  CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS marque FROM part)"""
_PART_COLUMNS = ["p_size", "p_retailprice", "reste", "lettres", "marque"]


def _part_measures(spark, folder):
    return table(spark, folder, "part").select(
        "p_size",
        "p_retailprice",
        (F.col("p_partkey") % 37).alias("reste"),
        F.length("p_name").alias("lettres"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("int").alias("marque"),
    )


def _kendall_sql(pairs, source: str) -> str:
    names = sorted({c for pair in pairs for c in pair})
    sums = [f"sum(sign(a.{x} - b.{x}) * sign(a.{y} - b.{y})) AS s_{x}_{y}" for x, y in pairs]
    frees = [f"sum(abs(sign(a.{c} - b.{c}))) AS f_{c}" for c in names]
    pairs_sql = f"""WITH t AS {source}, p AS (SELECT {", ".join(sums + frees)} FROM t a, t b) """
    return pairs_sql + " UNION ALL ".join(
        f"""SELECT '{x}' AS variable_x, '{y}' AS variable_y,
  round_even(s_{x}_{y} / (sqrt(f_{x}::DOUBLE) * sqrt(f_{y}::DOUBLE)), 8) AS coefficient FROM p"""
        for x, y in pairs
    )


@query("T3", _kendall_sql([("p_size", "p_retailprice"), ("lettres", "marque")], _PART_MEASURES))
def kendall_coefficients(spark, folder):
    found = A.kendall(_part_measures(spark, folder), [("p_size", "p_retailprice"), ("lettres", "marque")])
    return found.select("variable_x", "variable_y", rounded("coefficient", 8))


def _kendall_test_sql(a: str, b: str, source: str) -> str:
    """Tau and its normal deviate from running counts over the grid of both columns' values."""

    def ties(c: str) -> str:
        return f"""(SELECT sum(t * (t - 1)) AS p, sum(CAST(t AS DOUBLE) * (t - 1) * (t - 2)) AS c,
      sum(CAST(t AS DOUBLE) * (t - 1) * (2 * t + 5)) AS v FROM (SELECT count(*) AS t FROM {source} GROUP BY {c}))"""

    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""SELECT '{a}' AS variable_x, '{b}' AS variable_y, n AS effectif,
    s / (sqrt((CAST(n AS DOUBLE) * (n - 1) - x.p) / 2) * sqrt((CAST(n AS DOUBLE) * (n - 1) - y.p) / 2)) AS r,
    s / sqrt((CAST(n AS DOUBLE) * (n - 1) * (2 * n + 5) - x.v - y.v) / 18 + CAST(x.p AS DOUBLE) * y.p / (2 * CAST(n AS DOUBLE) * (n - 1))
      + x.c * y.c / (9 * CAST(n AS DOUBLE) * (n - 1) * (n - 2))) AS z
    FROM (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * (coalesce(low, 0) - coalesce(high, 0))) AS DOUBLE) AS s FROM (
      SELECT n, sum(less) OVER (PARTITION BY {a} ORDER BY {b} {before}) AS low, sum(less) OVER (PARTITION BY {a} ORDER BY {b} DESC {before}) AS high
      FROM (SELECT {a}, {b}, n, sum(n) OVER (PARTITION BY {b} ORDER BY {a} {before}) AS less FROM (
        SELECT g.{a}, g.{b}, coalesce(c.n, 0) AS n FROM (SELECT * FROM (SELECT DISTINCT {a} FROM {source}), (SELECT DISTINCT {b} FROM {source})) g
        LEFT JOIN (SELECT {a}, {b}, count(*) AS n FROM {source} GROUP BY ALL) c ON c.{a} = g.{a} AND c.{b} = g.{b})))) t, {ties(a)} x, {ties(b)} y"""


@query(
    "T3 T6",
    f"""SELECT variable_x, variable_y, effectif, round_even(r, 8) AS coefficient, round_even(p, 6) AS p_value, {_DECISION}
  FROM (SELECT *, 2 * {_normal_tail("abs(z)")} AS p FROM ({" UNION ALL ".join(_kendall_test_sql(a, b, "lineitem") for a, b in _LINE_PAIRS)}))""",
)
def kendall_tests(spark, folder):
    return _rounded_test(_with_decision(A.kendall(table(spark, folder, "lineitem"), _LINE_PAIRS)))


_SMALL_SAMPLES = """(SELECT sum(p_partkey) AS cles, sum(p_partkey * p_size) AS tailles, sum(p_partkey * p_partkey) AS carres
    FROM part GROUP BY p_brand)"""


@query(
    "T3 T6",
    f"""WITH RECURSIVE s AS {_SMALL_SAMPLES}, orders_of AS (SELECT 1 AS k, [CAST(1 AS HUGEINT)] AS ways
    UNION ALL SELECT k + 1, list_transform(range(CAST((k + 1) * k // 2 + 1 AS BIGINT)), lambda i: CAST(list_sum(list_transform(range(k + 1),
      lambda j: coalesce(ways[i - j + 1], CAST(0 AS HUGEINT)) * CAST(i >= j AS INTEGER))) AS HUGEINT)) FROM orders_of WHERE k < 25),
  pairs AS ({" UNION ALL ".join(
      f"SELECT 'cles' AS variable_x, '{c}' AS variable_y, sum((a.{c} > b.{c})::INT) AS d, (SELECT count(*) FROM s) AS n FROM s a, s b WHERE a.cles < b.cles"
      for c in ("tailles", "carres"))})
  SELECT variable_x, variable_y, n AS effectif, round_even(1 - 4.0::DOUBLE * d / (n * (n - 1)), 8) AS coefficient,
    round_even(least(1, 2 * CAST(list_sum(ways[1:CAST(least(d, n * (n - 1) // 2 - d) + 1 AS BIGINT)]) AS DOUBLE) / CAST(list_sum(ways) AS DOUBLE)), 12) AS p_value
  FROM pairs JOIN orders_of ON k = n""",
)
def kendall_small_samples(spark, folder):
    """Totals of the brands, few rows without ties: the exact distribution."""
    k = F.col("p_partkey")
    totals = [F.sum(k).alias("cles"), F.sum(k * F.col("p_size")).alias("tailles"), F.sum(k * k).alias("carres")]
    brands = table(spark, folder, "part").groupBy("p_brand").agg(*totals)
    found = A.kendall(brands, [("cles", "tailles"), ("cles", "carres")])
    return found.withColumns({"coefficient": rounded("coefficient", 8), "p_value": rounded("p_value", 12)})


_ALL = [(a, b) for a in _PART_COLUMNS for b in _PART_COLUMNS]


@query("T4 T2", _spearman_sql(_ALL, _PART_MEASURES))
def spearman_matrix(spark, folder):
    matrix = A.correlation_matrix(_part_measures(spark, folder), _PART_COLUMNS, "spearman")
    return matrix.withColumn("coefficient", rounded("coefficient", 8))


@query("T4 T3", _kendall_sql(_ALL, _PART_MEASURES))
def kendall_matrix(spark, folder):
    matrix = A.correlation_matrix(_part_measures(spark, folder), _PART_COLUMNS, "kendall")
    return matrix.withColumn("coefficient", rounded("coefficient", 8))


_TABLES = [("l_returnflag", "l_linestatus"), ("l_linestatus", "grande"), ("l_linenumber", "l_returnflag")]
_BIG = "(SELECT *, CASE WHEN l_quantity > 25 THEN 'O' ELSE 'N' END AS grande FROM lineitem)"


def _expected_sql(a: str, b: str) -> str:
    return f"""SELECT r.{a}, c.{b}, coalesce(o.n, 0) AS observe, r.n * c.n / CAST(t.n AS DOUBLE) AS attendu
    FROM (SELECT {a}, count(*) AS n FROM {_BIG} GROUP BY 1) r CROSS JOIN (SELECT {b}, count(*) AS n FROM {_BIG} GROUP BY 1) c
    CROSS JOIN (SELECT count(*) AS n FROM {_BIG}) t
    LEFT JOIN (SELECT {a}, {b}, count(*) AS n FROM {_BIG} GROUP BY ALL) o ON o.{a} = r.{a} AND o.{b} = c.{b}"""


def _chi_square_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS x, '{b}' AS y, CAST(sum(observe) AS BIGINT) AS effectif,
  (count(DISTINCT {a}) - 1) * (count(DISTINCT {b}) - 1) AS ddl, round_even(CASE WHEN (count(DISTINCT {a}) - 1) * (count(DISTINCT {b}) - 1) = 1
    THEN sum(power(abs(observe - attendu) - least(0.5, abs(observe - attendu)), 2) / attendu)
    ELSE sum(power(observe - attendu, 2) / attendu) END, 7) AS khi2, count(*) FILTER (WHERE attendu < 5) AS nb_cellules_inf5
  FROM ({_expected_sql(a, b)})"""


def _big_lines(spark, folder):
    return table(spark, folder, "lineitem").withColumn("grande", F.when(F.col("l_quantity") > 25, "O").otherwise("N"))


def _chi_squares(spark, folder):
    lines = _big_lines(spark, folder)
    found = A.chi_squares(lines, _TABLES)
    return found.withColumnsRenamed({"variable_x": "x", "variable_y": "y"})


@query("T5", " UNION ALL ".join(_chi_square_sql(a, b) for a, b in _TABLES))
def chi_square_statistics(spark, folder):
    return _chi_squares(spark, folder).drop("p_value").withColumn("khi2", rounded("khi2", 7))


# Upper 5 % points of chi-square by degrees of freedom.
_CRITICAL = {1: 3.841458820694124, 2: 5.991464547107979, 3: 7.814727903251179, 4: 9.487729036781154, 6: 12.591587243743977}


@query(
    "T5 T6",
    f"""SELECT x, y, ddl, CASE WHEN khi2 > CASE ddl {" ".join(f"WHEN {d} THEN {v!r}::DOUBLE" for d, v in _CRITICAL.items())} END
  THEN 'variables dependantes' ELSE 'variables independantes' END AS decision
  FROM ({" UNION ALL ".join(_chi_square_sql(a, b) for a, b in _TABLES)})""",
)
def chi_square_decisions(spark, folder):
    """Decisions by p-value; the SQL takes them by the critical value."""
    return _chi_square_tests(spark, folder).select("x", "y", "ddl", "decision")


def _chi_square_tests(spark, folder):
    return _chi_squares(spark, folder).withColumn(
        "decision", A.decision(F.col("p_value"), "variables dependantes", "variables independantes")
    )


@query(
    "T5 T6",
    f"""SELECT x, y, effectif, round_even(khi2, 7) AS khi2, ddl, round_even(p, 6) AS p_value, nb_cellules_inf5,
  CASE WHEN p < 0.05 THEN 'variables dependantes' ELSE 'variables independantes' END AS decision
  FROM (SELECT *, {_chi_tail("khi2", "CAST(ddl AS DOUBLE)")} AS p FROM ({" UNION ALL ".join(_chi_square_sql(a, b) for a, b in _TABLES)}))""",
)
def chi_square_tests(spark, folder):
    return _chi_square_tests(spark, folder).withColumns({"khi2": rounded("khi2", 7), "p_value": rounded("p_value", 6)})


@query(
    "T5 A33",
    f"""SELECT l_linenumber, l_returnflag, observe, round_even(attendu, 6) AS attendu
  FROM ({_expected_sql("l_linenumber", "l_returnflag")})""",
)
def expected_counts(spark, folder):
    found = A.expected_counts(table(spark, folder, "lineitem"), "l_linenumber", "l_returnflag")
    return found.withColumn("attendu", rounded("attendu", 6))
