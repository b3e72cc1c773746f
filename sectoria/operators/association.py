"""Normality, rank correlation and independence tests.

The counting runs in Spark over data of any size. The last step, from a
statistic to its p-value, runs on the few result rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conditions import all_present
from ..functions.inference import (
    chi_square_upper,
    inversions_two_sided,
    normal_two_sided,
    normal_upper,
    student_two_sided,
)
from ..session import cut_lineage, small_table
from .lookups import FREQUENT, look_up
from .positions import with_running_total

ALPHA = 0.05
PAIR = ["variable_x", "variable_y"]
# Kendall's test without ties takes the exact distribution for at most so many rows.
EXACT = 33
_CHUNK = 65_536
# Distinct values whose running sums one task forms.
_SLICE = 16_384
_DIGIT_BITS = 2
_DIGITS = 2**_DIGIT_BITS


def _polynomial(coefficients: Sequence[float], x: Column) -> Column:
    """Polynomial with the coefficients in rising order."""
    value = F.lit(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        value = value * x + float(c)
    return value


def _within_one(value: Column) -> Column:
    """Cut rounding noise beyond -1 and 1; null stays null."""
    return F.when(value > 1.0, 1.0).when(value < -1.0, -1.0).otherwise(value)


# Published rational approximation of the normal quantile (algorithm AS 241), rising order.
_CENTRE_UP = [
    3.3871328727963666080e0,
    1.3314166789178437745e2,
    1.9715909503065514427e3,
    1.3731693765509461125e4,
    4.5921953931549871457e4,
    6.7265770927008700853e4,
    3.3430575583588128105e4,
    2.5090809287301226727e3,
]
_CENTRE_DOWN = [
    1.0,
    4.2313330701600911252e1,
    6.8718700749205790830e2,
    5.3941960214247511077e3,
    2.1213794301586595867e4,
    3.9307895800092710610e4,
    2.8729085735721942674e4,
    5.2264952788528545610e3,
]
_NEAR_UP = [
    1.42343711074968357734e0,
    4.63033784615654529590e0,
    5.76949722146069140550e0,
    3.64784832476320460504e0,
    1.27045825245236838258e0,
    2.41780725177450611770e-1,
    2.27238449892691845833e-2,
    7.74545014278341407640e-4,
]
_NEAR_DOWN = [
    1.0,
    2.05319162663775882187e0,
    1.67638483018380384940e0,
    6.89767334985100004550e-1,
    1.48103976427480074590e-1,
    1.51986665636164571966e-2,
    5.47593808499534494600e-4,
    1.05075007164441684324e-9,
]
_FAR_UP = [
    6.65790464350110377720e0,
    5.46378491116411436990e0,
    1.78482653991729133580e0,
    2.96560571828504891230e-1,
    2.65321895265761230930e-2,
    1.24266094738807843860e-3,
    2.71155556874348757815e-5,
    2.01033439929228813265e-7,
]
_FAR_DOWN = [
    1.0,
    5.99832206555887937690e-1,
    1.36929880922735805310e-1,
    1.48753612908506148525e-2,
    7.86869131145613259100e-4,
    1.84631831751005468180e-5,
    1.42151175831644588870e-7,
    2.04426310338993978564e-15,
]


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution as a Catalyst expression."""
    q = p - 0.5
    r = 0.180625 - q * q
    centre = q * _polynomial(_CENTRE_UP, r) / _polynomial(_CENTRE_DOWN, r)
    s = F.sqrt(-F.log(F.least(p, 1.0 - p)))
    near = _polynomial(_NEAR_UP, s - 1.6) / _polynomial(_NEAR_DOWN, s - 1.6)
    far = _polynomial(_FAR_UP, s - 5.0) / _polynomial(_FAR_DOWN, s - 5.0)
    tail = F.when(s <= 5.0, near).otherwise(far)
    return F.when(F.abs(q) <= 0.425, centre).when(q < 0, -tail).otherwise(tail)


def _ordered_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every value of each column with its position ``i`` in ascending order, the size ``n`` and the mean.

    Only counted distinct values are put in order. The positions of equal
    values are generated afterwards, in chunks spread over all tasks, so a
    value that a third of the rows hold is no burden for one of them.
    """
    long = df.unpivot([], [F.col(f"`{c}`").cast("double").alias(c) for c in columns], "variable", "x")
    counts = long.where(F.col("x").isNotNull()).groupBy("variable", "x").agg(F.count(F.lit(1)).alias("t"))
    running = with_running_total(counts.withColumn("s", F.col("x") * F.col("t")), ["x"], ["t", "s"], by=["variable"], totals=True)
    first = F.col("before_t") + F.col("chunk") * _CHUNK + 1
    chunks = running.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("t") - 1) / _CHUNK).cast("int")))
    ).select(
        "variable",
        "x",
        F.col("total_t").alias("n"),
        (F.col("total_s") / F.col("total_t")).alias("mean"),
        first.alias("first"),
        F.least(first + _CHUNK - 1, F.col("before_t") + F.col("t")).alias("last"),
    )
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(tasks, "variable", "first")
    return spread.select("variable", "x", "n", "mean", F.explode(F.sequence("first", "last")).alias("i"))


def shapiro_wilk(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """W and p per column; ``extrapolated`` tells that the formula of p is used beyond its published range of 5,000 values."""
    placed = _ordered_values(df, columns)
    scored = placed.withColumn("m", normal_quantile((F.col("i") - 0.375) / (F.col("n") + 0.25)))

    def at(name: str, index: Column) -> Column:
        return F.max(F.when(F.col("i") == index, F.col(name)))

    n = F.col("n")
    row = scored.groupBy("variable", "n").agg(
        F.sum(F.col("m") * F.col("m")).alias("s"),
        F.sum(F.col("m") * F.col("x")).alias("mx"),
        F.sum(F.pow(F.col("x") - F.col("mean"), F.lit(2.0))).alias("spread"),
        at("m", n).alias("m1"),
        at("m", n - 1).alias("m2"),
        at("x", n).alias("high1"),
        at("x", n - 1).alias("high2"),
        at("x", F.lit(1)).alias("low1"),
        at("x", F.lit(2)).alias("low2"),
    )
    # Published polynomials for the end weights and for the normalised statistic (AS R94).
    u = 1.0 / F.sqrt(n)
    root = F.sqrt("s")
    a1 = _polynomial([0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056], u) + F.col("m1") / root
    a2 = _polynomial([0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633], u) + F.col("m2") / root
    m1, m2 = F.col("m1"), F.col("m2")
    phi_two = (F.col("s") - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * F.col("a1") ** 2 - 2 * F.col("a2") ** 2)
    phi_one = (F.col("s") - 2 * m1 * m1) / (1 - 2 * F.col("a1") ** 2)
    outer, inner = F.col("high1") - F.col("low1"), F.col("high2") - F.col("low2")
    ends_one = F.col("a1") * outer + (F.col("mx") - m1 * outer) / F.sqrt("phi")
    ends_two = F.col("a1") * outer + F.col("a2") * inner + (F.col("mx") - m1 * outer - m2 * inner) / F.sqrt("phi")
    slope = F.when(n == 3, F.lit(0.5).cast("double") ** 0.5 * outer).when(n <= 5, ends_one).otherwise(ends_two)
    tested = (
        row.where(n >= 3)
        .withColumn("a1", a1)
        .withColumn("a2", a2)
        .withColumn("phi", F.when(n > 5, phi_two).when(n > 3, phi_one).otherwise(F.lit(1.0)))
        .withColumn("W", _within_one(F.try_divide(slope * slope, F.col("spread"))))
    )
    x = F.log(n.cast("double"))
    size = n.cast("double")
    y = F.log(1 - F.col("W"))
    small = -F.log(_polynomial([-2.273, 0.459], size) - y)
    z_small = (small - _polynomial([0.544, -0.39978, 0.025054, -6.714e-4], size)) / F.exp(
        _polynomial([1.3822, -0.77857, 0.062767, -0.0020322], size)
    )
    z_large = (y - _polynomial([-1.5861, -0.31082, -0.083751, 0.0038915], x)) / F.exp(
        _polynomial([-0.4803, -0.082676, 0.0030302], x)
    )
    p_three = F.greatest(
        F.lit(0.0), 6 / F.pi() * (F.asin(F.sqrt("W")) - F.asin(F.sqrt(F.lit(0.75)))).cast("double")
    )
    z = F.when(n <= 11, z_small).otherwise(z_large)
    return tested.select(
        "variable",
        "n",
        "W",
        F.when(n == 3, p_three).otherwise(normal_upper(F.when(n > 3, z))).alias("p_value"),
        (n > 5000).alias("extrapolated"),
    )


@dataclass(frozen=True)
class _Ranking:
    """Rows of a data set with the codes and ranks of their values, for pairs of columns.

    A pair is numbered; its columns are ranked among the rows in which both are present. Columns that lose no row to
    their partner share one ranking, whatever the number of pairs. ``sides`` holds the rankings of each pair, ``rows`` has
    ``code_<ranking>`` (from 0, dense) and ``rank_<ranking>`` (average rank less its mean), ``ranks`` the distinct values of all
    rankings with their rows ``t``, and ``sizes`` the number of distinct values of each ranking.
    """

    pairs: list[tuple[str, str]]
    sides: list[tuple[int, int]]
    rows: DataFrame
    ranks: DataFrame
    sizes: dict[int, int]

    def names(self) -> DataFrame:
        """The pairs and their rankings, a row each."""
        table = [(i, *pair, *side) for i, (pair, side) in enumerate(zip(self.pairs, self.sides, strict=True))]
        kind = "pair int, variable_x string, variable_y string, ranking_x int, ranking_y int"
        return small_table(self.rows.sparkSession, table, kind)

    def of_pairs(self, fields: Callable[[int], dict[str, Column]]) -> DataFrame:
        """A row for every row and pair that is present; ``fields`` gives its columns, null ones stand for no row."""
        structs = [
            F.struct(F.lit(i).alias("pair"), *[c.alias(n) for n, c in fields(i).items()]) for i in range(len(self.pairs))
        ]
        names = list(fields(0))
        return self.rows.select(F.explode(F.array(*structs)).alias("p")).select("p.*").where(all_present(names))


def _ranking(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> _Ranking:
    """Every column put in order once, and its ranks brought back to the rows."""
    columns = sorted({c for pair in pairs for c in pair})
    place = {c: f"v{i}" for i, c in enumerate(columns)}
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(v) for c, v in place.items()])

    def both(a: str, b: str) -> Column:
        return F.col(place[a]).isNotNull() & F.col(place[b]).isNotNull()

    present = values.agg(
        *[F.count(place[c]).alias(place[c]) for c in columns],
        *[F.count_if(both(a, b)).alias(f"p{i}") for i, (a, b) in enumerate(pairs)],
    ).first()
    # A column loses rows to a partner that is missing where the column is present.
    rankings: dict[tuple[str, str], int] = {}
    sides = []
    for i, (a, b) in enumerate(pairs):
        keys = [(c, c if present[f"p{i}"] == present[place[c]] else d) for c, d in ((a, b), (b, a))]
        sides.append(tuple(rankings.setdefault(key, len(rankings)) for key in keys))
    ranked = {n: F.when(both(c, d), F.col(place[c])) for (c, d), n in rankings.items()}

    structs = [F.struct(F.lit(n).alias("ranking"), value.alias("value")) for n, value in ranked.items()]
    long = values.select(F.explode(F.array(*structs)).alias("r")).select("r.*").where(F.col("value").isNotNull())
    counts = long.groupBy("ranking", "value").agg(F.count(F.lit(1)).alias("t")).withColumn("one", F.lit(1))
    running = with_running_total(counts, ["value"], ["t", "one"], by=["ranking"], totals=True)
    rank = F.col("before_t") + (F.col("t") + 1) / 2 - (F.col("total_t") + 1) / 2
    ranks = cut_lineage(
        running.select(
            "ranking",
            "value",
            "t",
            F.col("before_one").cast("long").alias("code"),
            rank.alias("rank"),
            (F.col("t") * FREQUENT > F.col("total_t")).alias("frequent"),
        )
    )
    counted = ranks.groupBy("ranking").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("frequent")).alias("rare")).collect()
    sizes, rare = {r.ranking: r.n for r in counted}, {r.ranking: r.rare for r in counted}
    rows = values.select(*values.columns, *[value.alias(f"value_{n}") for n, value in ranked.items()])
    for n in ranked:
        found = ranks.where(F.col("ranking") == n).withColumnsRenamed({"code": f"code_{n}", "rank": f"rank_{n}"})
        rows = look_up(rows, F.col(f"value_{n}"), found, [f"code_{n}", f"rank_{n}"], rare.get(n, 0) > 0).drop(f"value_{n}")
    return _Ranking(list(pairs), sides, rows, ranks, sizes)


def spearman(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rank correlation with average ranks, and its p-value, for each pair of columns.

    Pairs without a row that has both values have no row in the result.
    """
    ranking = _ranking(df, pairs)
    moments = ranking.of_pairs(
        lambda i: {"rx": F.col(f"rank_{ranking.sides[i][0]}"), "ry": F.col(f"rank_{ranking.sides[i][1]}")}
    )
    rx, ry = F.col("rx"), F.col("ry")
    sums = (
        moments.groupBy("pair")
        .agg(
            F.count(F.lit(1)).alias("effectif"),
            F.sum(rx * ry).alias("xy"),
            F.sum(rx * rx).alias("xx"),
            F.sum(ry * ry).alias("yy"),
        )
        .join(F.broadcast(ranking.names()), "pair")
    )
    rho = F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy"))
    degrees = F.col("effectif") - 2
    t = F.col("coefficient") * F.sqrt(F.try_divide(degrees.cast("double"), 1 - F.pow("coefficient", F.lit(2.0))))
    exact = F.abs("coefficient") >= 1.0
    return sums.withColumn("coefficient", _within_one(rho)).select(
        *PAIR,
        "effectif",
        "coefficient",
        F.when(exact & (degrees > 0), 0.0).otherwise(student_two_sided(F.when(~exact, t), degrees)).alias("p_value"),
    )


def _discordant_pairs(cells: DataFrame, places: Sequence[int]) -> DataFrame:
    """Number of discordant pairs of observations, counted digit by digit.

    Two observations with different y differ first in one base-4 digit of the
    code of y: they share all higher digits, and the larger y has the
    larger digit there. The pair is discordant if the larger y comes with the
    smaller x. So, for every digit place and every value of the higher digits,
    each observation counts the larger digits at smaller x; a cell is
    repeated once per digit, never per partner. ``places`` holds the number of
    digits of each pair's y, whose column should be the one with fewer values.

    Codes of x are dense, so ``x div _SLICE`` cuts their order into even slices without a sort of all rows: one exchange, running sums
    inside the slices, and then over the slices' totals.
    """
    last = F.array(*[F.lit(n - 1) for n in places])[F.col("pair")]

    def shifted(by: Column) -> Column:
        return F.call_function("shiftright", F.col("y"), by)

    names = [f"d{d}" for d in range(_DIGITS)]
    lower = range(_DIGITS - 1)
    group = ["pair", "place", "prefix"]
    digit = shifted(F.col("place") * _DIGIT_BITS) % _DIGITS
    coded = cells.withColumn("place", F.explode(F.sequence(F.lit(0), last))).select(
        "pair",
        "place",
        shifted((F.col("place") + 1) * _DIGIT_BITS).alias("prefix"),
        F.floor(F.col("x") / _SLICE).alias("slice"),
        "x",
        *[F.when(digit == d, F.col("n")).otherwise(0).alias(names[d]) for d in range(_DIGITS)],
    )
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    levels = (
        coded.repartition(tasks, *group, "slice")
        .groupBy(*group, "slice", "x")
        .agg(*[F.sum(n).alias(n) for n in names])
    )

    def exact(name: str) -> Column:
        return F.col(name).cast("decimal(19,0)")

    def with_sums_before(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
        earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({f"before_{n}": F.coalesce(F.sum(n).over(earlier), F.lit(0)) for n in names[1:]})

    def met() -> Column:
        """Rows of each digit times the rows of larger digits before."""
        larger = [[exact(f"before_{names[e]}") for e in range(d + 1, _DIGITS)] for d in lower]
        return reduce(add, [exact(names[d]) * reduce(add, larger[d]).cast("decimal(19,0)") for d in lower])

    inside = with_sums_before(levels, [*group, "slice"], "x")
    slices = inside.groupBy(*group, "slice").agg(F.sum(met()).alias("met"), *[F.sum(n).alias(n) for n in names])
    across = with_sums_before(slices, group, "slice")
    return across.groupBy("pair").agg(F.sum(F.col("met") + met()).cast("decimal(38,0)").alias("discordant"))


def _tie_sums(counts: DataFrame, key: str) -> DataFrame:
    """Sums over the groups of ``t`` equal values: rows, pairs and the terms of the variance."""
    t = F.col("t").cast("decimal(19,0)")
    d = F.col("t").cast("double")
    return counts.groupBy(key).agg(
        F.sum("t").alias("sum"),
        F.sum(t * (t - 1)).cast("decimal(38,0)").alias("pairs"),
        F.sum(d * (d - 1) * (d - 2)).alias("cube"),
        F.sum(d * (d - 1) * (2 * d + 5)).alias("var"),
    )


def kendall(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Tau-b of each pair of columns and its p-value.

    Without ties, the p-value of at most ``EXACT`` rows, or of at most one discordant or concordant pair, is that of the
    exact distribution; otherwise it is the tie-corrected normal approximation. Pairs with fewer than two rows have no row.
    """
    ranking = _ranking(df, pairs)
    short = [min(sides, key=lambda r: ranking.sizes.get(r, 0)) for sides in ranking.sides]
    long = [a if s == b else b for s, (a, b) in zip(short, ranking.sides, strict=True)]
    cells = cut_lineage(
        # The count is the same with x and y exchanged; the column with fewer values needs fewer digits.
        ranking.of_pairs(lambda i: {"x": F.col(f"code_{long[i]}"), "y": F.col(f"code_{short[i]}")})
        .groupBy("pair", "x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    places = [max(1, -(-(max(1, ranking.sizes.get(s, 0)) - 1).bit_length() // _DIGIT_BITS)) for s in short]
    discordant = _discordant_pairs(cells, places)
    of_columns = cut_lineage(_tie_sums(ranking.ranks, "ranking"))

    def side(name: str) -> DataFrame:
        renamed = of_columns.drop("sum").withColumnsRenamed({c: f"{c}_{name}" for c in ("pairs", "cube", "var")})
        return renamed.withColumnRenamed("ranking", f"ranking_{name}")

    ties = _tie_sums(cells.withColumnRenamed("n", "t"), "pair").select(
        "pair", F.col("sum").alias("effectif"), F.col("pairs").alias("pairs_xy")
    )
    table = (
        ties.join(discordant, "pair")
        .join(F.broadcast(ranking.names()), "pair")
        .join(F.broadcast(side("x")), "ranking_x")
        .join(F.broadcast(side("y")), "ranking_y")
    )
    size = F.col("effectif").cast("decimal(19,0)")
    everything = (size * (size - 1)).cast("decimal(38,0)")
    # Every count of pairs is doubled here, so all of them stay whole numbers.
    balance = (
        everything - F.col("pairs_x") - F.col("pairs_y") + F.col("pairs_xy") - 4 * F.col("discordant")
    ).cast("double")
    free_x, free_y = (everything - F.col("pairs_x")).cast("double"), (everything - F.col("pairs_y")).cast("double")
    n = F.col("effectif").cast("double")
    m = n * (n - 1)
    variance = (
        (m * (2 * n + 5) - F.col("var_x") - F.col("var_y")) / 18
        + F.col("pairs_x").cast("double") * F.col("pairs_y").cast("double") / (2 * m)
        + F.coalesce(F.try_divide(F.col("cube_x") * F.col("cube_y"), 9 * m * (n - 2)), F.lit(0.0))
    )
    z = F.try_divide(balance / 2, F.sqrt(variance))
    tau = _within_one(F.try_divide(balance, F.sqrt(free_x) * F.sqrt(free_y)))
    fewest = F.least(F.col("discordant"), everything / 2 - F.col("discordant"))
    is_exact = (F.col("pairs_x") == 0) & (F.col("pairs_y") == 0) & ((F.col("effectif") <= EXACT) | (fewest <= 1))
    asked = F.when(is_exact, F.col("discordant").cast("long"))
    exact_p = inversions_two_sided(asked, F.when(is_exact, F.col("effectif")))
    return table.where(F.col("effectif") > 1).select(
        *PAIR,
        "effectif",
        tau.alias("coefficient"),
        F.when(is_exact, exact_p).otherwise(normal_two_sided(z)).alias("p_value"),
    )


def all_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]


def correlation_matrix(df: DataFrame, columns: Sequence[str], method: str) -> DataFrame:
    """Full matrix in long form: both triangles and the diagonal."""
    test = {"spearman": spearman, "kendall": kendall}[method]
    upper = test(df, all_pairs(columns)).select(*PAIR, "coefficient")
    both = F.array(
        F.struct(F.col("variable_x").alias("a"), F.col("variable_y").alias("b")),
        F.struct(F.col("variable_y").alias("a"), F.col("variable_x").alias("b")),
    )
    mirrored = upper.select(F.explode(both).alias("p"), "coefficient").select(
        F.col("p.a").alias("variable_x"), F.col("p.b").alias("variable_y"), "coefficient"
    )
    present = df.agg(*[(F.min(f"`{c}`") < F.max(f"`{c}`")).alias(c) for c in columns])
    diagonal = present.unpivot([], columns, "variable_x", "varies").where("varies").select(
        "variable_x", F.col("variable_x").alias("variable_y"), F.lit(1.0).alias("coefficient")
    )
    return mirrored.unionByName(diagonal)


def _class_cells(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Counts of the filled cells of the contingency tables of all pairs, from one pass over the rows."""
    structs = [
        F.struct(
            F.lit(a).alias("variable_x"),
            F.lit(b).alias("variable_y"),
            F.col(f"`{a}`").cast("string").alias("x"),
            F.col(f"`{b}`").cast("string").alias("y"),
        )
        for a, b in pairs
    ]
    long = df.select(F.explode(F.array(*structs)).alias("p")).select("p.*").where(all_present(["x", "y"]))
    return cut_lineage(long.groupBy(*PAIR, "x", "y").agg(F.count(F.lit(1)).alias("o")))


def expected_counts(df: DataFrame, rows: str, column: str) -> DataFrame:
    """Observed and expected count of every cell of a contingency table, empty cells included.

    The whole table is the result, so each row class meets each column class here; the test does without.
    """
    cells = cut_lineage(
        df.where(all_present([rows, column])).groupBy(rows, column).agg(F.count(F.lit(1)).alias("observe"))
    )
    total = cells.agg(F.sum("observe")).scalar()
    by_row = cells.groupBy(rows).agg(F.sum("observe").alias("_r"))
    by_column = cells.groupBy(column).agg(F.sum("observe").alias("_c"))
    grid = by_row.crossJoin(by_column).withColumn("attendu", F.col("_r").cast("double") * F.col("_c") / total)
    return grid.join(cells, [rows, column], "left").select(
        rows, column, F.coalesce("observe", F.lit(0)).alias("observe"), "attendu"
    )


def _small_expected(totals: DataFrame) -> DataFrame:
    """Cells of each pair whose expected count is below 5, from the totals of rows and columns.

    ``totals`` has the pair, ``side`` (x or y), ``t`` and the pair's ``n``. A row class of total r has its small cells
    in the column classes of at most (5n - 1) div r, which one running count over the sorted totals finds.
    """
    limit = F.expr("(5 * n - 1) div t")
    marks = totals.select(
        *PAIR,
        F.when(F.col("side") == "y", F.col("t")).otherwise(limit).alias("place"),
        F.when(F.col("side") == "y", 0).otherwise(1).alias("asks"),
    )
    counted = marks.groupBy(*PAIR, "place", "asks").agg(F.count(F.lit(1)).alias("classes"))
    columns = F.when(F.col("asks") == 0, F.col("classes")).otherwise(0)
    ranked = with_running_total(counted.withColumn("columns", columns), ["place", "asks"], ["columns"], by=PAIR)
    return ranked.where("asks = 1").groupBy(*PAIR).agg(
        F.sum(F.col("classes") * F.col("before_columns")).alias("nb_cellules_inf5")
    )


def chi_squares(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Tests of independence of pairs of columns: statistic (Yates-corrected for one degree), p, degrees, small cells.

    The filled cells are summed up; an empty one adds its expected count, and those of a row class together follow from the
    rows that its filled column classes leave, a whole number. In a table of two by two classes all gaps between observed and
    expected counts are equal, and the corrected statistic follows from one of them.
    """
    return _tested(_class_cells(df, pairs))


def _tested(cells: DataFrame) -> DataFrame:
    """The tests of the filled cells: pair, classes ``x`` and ``y``, rows ``o``."""
    sides = [
        cells.groupBy(*PAIR, F.col(s).alias("k")).agg(F.sum("o").alias("t")).withColumn("side", F.lit(s)) for s in ("x", "y")
    ]
    totals = cut_lineage(sides[0].unionByName(sides[1]))
    sizes = totals.where("side = 'x'").groupBy(*PAIR).agg(F.sum("t").alias("n"))

    def side(name: str, total: str) -> DataFrame:
        return totals.where(F.col("side") == name).select(*PAIR, F.col("k").alias(name), F.col("t").alias(total))

    joined = cells.join(side("x", "r"), [*PAIR, "x"]).join(side("y", "c"), [*PAIR, "y"]).join(F.broadcast(sizes), list(PAIR))
    o, r, c, n = (F.col(k).cast("double") for k in "orcn")
    expected = r * c / n
    of_rows = joined.groupBy(*PAIR, "x", "r", "n").agg(
        F.sum(F.pow(o - expected, F.lit(2.0)) / expected).alias("filled"),
        (F.col("n") - F.sum("c")).alias("left"),
        F.max(F.abs(o - expected)).alias("gap"),
    )
    sums = of_rows.groupBy(*PAIR, "n").agg(
        F.sum(F.col("filled") + r * F.col("left") / n).alias("sum"), F.max("gap").alias("gap")
    )
    classes = totals.groupBy(*PAIR).agg(
        ((F.count_if(F.col("side") == "x") - 1) * (F.count_if(F.col("side") == "y") - 1)).alias("ddl"),
        F.sum(F.when(F.col("side") == "x", 1.0 / F.col("t"))).alias("rows_inverse"),
        F.sum(F.when(F.col("side") == "y", 1.0 / F.col("t"))).alias("columns_inverse"),
    )
    small = _small_expected(totals.join(F.broadcast(sizes), list(PAIR)))
    corrected = F.col("gap") - F.least("gap", F.lit(0.5))
    yates = corrected * corrected * F.col("n") * F.col("rows_inverse") * F.col("columns_inverse")
    statistic = F.when(F.col("ddl") == 1, yates).otherwise(F.col("sum"))
    tested = sums.join(F.broadcast(classes), list(PAIR)).join(F.broadcast(small), list(PAIR)).withColumn("khi2", statistic)
    return tested.select(
        *PAIR,
        F.col("n").alias("effectif"),
        "khi2",
        "ddl",
        chi_square_upper(F.col("khi2"), F.col("ddl")).alias("p_value"),
        "nb_cellules_inf5",
    )


def chi_square(df: DataFrame, rows: str, column: str) -> DataFrame:
    """Test of independence of one pair of columns; see :func:`chi_squares`."""
    return chi_squares(df, [(rows, column)]).drop(*PAIR)


def decision(p_value: Column, rejected: str, kept: str, alpha: float = ALPHA) -> Column:
    """Decision text of a test; null without a p-value."""
    return F.when(p_value < alpha, rejected).when(p_value >= alpha, kept)


def direction(coefficient: Column) -> Column:
    return F.when(coefficient > 0, "positive").when(coefficient <= 0, "negative")


