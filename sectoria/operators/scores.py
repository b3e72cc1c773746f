"""National baseline, territory scores, ranks, pages and the matrix extremes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classes import AGE_CLASSES_7, class_rank
from ..functions.conditions import all_present
from ..functions.numeric import imd, log_distance, rate, round_even

# Death-place hierarchy from the widest level to the closest, with its native flag.
LEVELS = ["pays_deces", "nom_region_deces", "nom_departement_deces", "ville_deces"]
LEVEL_FLAGS = {
    "nom_region_deces": "origine_region",
    "nom_departement_deces": "origine_departement",
    "ville_deces": "origine_ville",
}
PAGE_SIZE = 20


def log_moments(weight: Column | None) -> list[Column]:
    """Mean and sample deviation of ln(1+distance), each row counted ``weight`` times."""
    log = log_distance(F.col("distance"))
    if weight is None:
        return [F.avg(log).alias("moy_distance"), F.stddev_samp(log).alias("std_distance")]
    weight = F.when(F.col("distance").isNotNull(), weight)
    n, total, squares = F.sum(weight), F.sum(weight * log), F.sum(weight * log * log)
    spread = F.greatest(squares - total * total / n, F.lit(0.0))
    return [
        F.try_divide(total, n).alias("moy_distance"),
        F.sqrt(F.try_divide(spread, (n - 1).cast("double"))).alias("std_distance"),
    ]


def national_baseline(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """One row: mean and sample deviation of ln(1+distance) and the extremes of the native distances.

    ``weight`` is the number of persons of each row when the rows are counted cells.
    """
    department = F.col("origine_departement") == "O"
    return df.agg(
        *log_moments(weight),
        F.min(F.when(department, F.col("distance"))).alias("distance_dep_min"),
        F.max(F.when(department, F.col("distance"))).alias("distance_dep_max"),
        F.max(F.when(F.col("origine_nationale") == "O", F.col("distance"))).alias("distance_nat_max"),
    )


def age_baseline(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """Mean and sample deviation of ln(1+distance) of each age class."""
    return df.groupBy("classe_age").agg(*log_moments(weight))


def level_keys(level: str) -> list[str]:
    return LEVELS[: LEVELS.index(level) + 1]


def distance_cells(df: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Count the persons of equal keys, flags and distance.

    Distances are whole kilometres, so a sector has at most about 20,000 of
    them: every later aggregate of a sector, medians included, works on a
    bounded number of rows even if one sector holds most persons.
    """
    return df.groupBy(*keys, *flags, "distance").agg(F.count("idligne").alias("n"))


def _score_columns(flag: Column) -> list[Column]:
    n, distance = F.col("n"), F.col("distance")
    native, outsider = flag == "O", flag == "N"

    def total(condition: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))

    return [
        F.sum(n).alias("deces"),
        total(outsider, n).alias("nb_exogene"),
        total(native, n).alias("nb_natif"),
        total(outsider, n * distance).cast("double").alias("distance_exogene"),
        total(native, n * distance).cast("double").alias("distance_natif"),
        F.percentile(F.when(outsider, distance), 0.5, n).alias("med_distance_exogene"),
        F.percentile(F.when(native, distance), 0.5, n).alias("med_distance_natif"),
        F.sum(n * log_distance(distance)).alias("log_distance"),
    ]


def _with_indices(sectors: DataFrame) -> DataFrame:
    return (
        sectors.withColumn("TAFV", rate(F.col("nb_natif"), F.col("nb_natif") + F.col("nb_exogene"), 3))
        .withColumn("mobilite_secteur", rate(F.col("log_distance"), F.col("deces"), 3))
        .withColumn("IMD", imd(F.col("moy_distance"), F.col("std_distance"), F.col("mobilite_secteur"), 3))
        .drop("log_distance")
    )


def _with_baseline(sectors: DataFrame, baseline: DataFrame, by_age: bool) -> DataFrame:
    if by_age:
        return sectors.join(baseline.select("classe_age", "moy_distance", "std_distance"), "classe_age", "left")
    moments = baseline.select(F.struct("moy_distance", "std_distance").alias("m")).scalar()
    columns = [F.col(f"_m.{c}").alias(c) for c in ("moy_distance", "std_distance")]
    return sectors.withColumn("_m", moments).select(*sectors.columns, *columns)


def _own_baseline(cells: DataFrame, by_age: bool) -> DataFrame:
    """Baseline of the counted cells themselves, so the persons are read once for both."""
    moments = log_moments(F.col("n"))
    return cells.groupBy("classe_age").agg(*moments) if by_age else cells.agg(*moments)


def sector_scores(
    df: DataFrame, level: str, baseline: DataFrame | None = None, by_age: bool = False
) -> DataFrame:
    """Score of every sector of a level: deaths, natives and outsiders, distances, TAFV, mobility and IMD.

    ``baseline`` is :func:`national_baseline`, or :func:`age_baseline` when the
    score is split by age class; without it, the given persons are their own
    baseline. ``rang_deces`` ranks the sectors by deaths over all ages.
    """
    keys = level_keys(level)
    flag = LEVEL_FLAGS[level]
    groups = [*keys, "classe_age"] if by_age else keys
    cells = distance_cells(df, groups, [flag])
    baseline = _own_baseline(cells, by_age) if baseline is None else baseline
    sectors = cells.groupBy(*groups).agg(*_score_columns(F.col(flag)))
    scored = _with_indices(_with_baseline(sectors, baseline, by_age))
    if not by_age:
        return with_death_rank(scored, [])
    return with_rank_over_ages(scored, keys).where(all_present(keys))


def all_level_scores(df: DataFrame, baseline: DataFrame | None = None) -> DataFrame:
    """Scores of all levels from one reading of the persons.

    The persons are counted once at the closest level; the wider levels are
    roll-ups of these cells, each with the native flag of its own level.
    """
    levels = LEVELS[1:]
    flags = [LEVEL_FLAGS[level] for level in levels]
    cells = distance_cells(df, LEVELS, flags)
    baseline = _own_baseline(cells, by_age=False) if baseline is None else baseline
    views = []
    for depth, level in enumerate(levels, start=2):
        names = [F.col(c).alias(c) if i < depth else F.lit(None).cast("string").alias(c) for i, c in enumerate(LEVELS)]
        views.append(F.struct(F.lit(level).alias("niveau"), *names, F.col(LEVEL_FLAGS[level]).alias("origine")))
    rolled = cells.select(F.explode(F.array(*views)).alias("v"), "distance", "n").select("v.*", "distance", "n")
    rolled = rolled.groupBy("niveau", *LEVELS, "origine", "distance").agg(F.sum("n").alias("n"))
    sectors = rolled.groupBy("niveau", *LEVELS).agg(*_score_columns(F.col("origine")))
    return with_death_rank(_with_indices(_with_baseline(sectors, baseline, by_age=False)), ["niveau"])


def with_death_rank(sectors: DataFrame, by: Sequence[str], name: str = "rang_deces") -> DataFrame:
    """Rank by deaths, descending; ties share their average rank, cut to a whole number.

    Works on aggregated sectors only: their number is that of the places of
    one level, not that of the persons.
    """
    first = F.rank().over(Window.partitionBy(*by).orderBy(F.desc("deces")))
    tied = F.count(F.lit(1)).over(Window.partitionBy(*by, "deces"))
    return sectors.withColumn(name, (first + (tied - 1) / 2).cast("bigint"))


def with_rank_over_ages(scored: DataFrame, keys: Sequence[str], name: str = "rang_deces") -> DataFrame:
    """The rank of :func:`with_death_rank` for rows split by age class: that of the sector's deaths over all ages.

    One row of each sector stands for it in the counts, so no join back is needed.
    """
    sector = Window.partitionBy(*keys)
    counted = scored.withColumn("_total", F.sum("deces").over(sector)).withColumn(
        "_one", (F.row_number().over(sector.orderBy("classe_age")) == 1).cast("int")
    )
    down = Window.orderBy(F.desc("_total")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reached, tied = F.sum("_one").over(down), F.sum("_one").over(Window.partitionBy("_total"))
    return counted.withColumn(name, (reached - tied + 1 + (tied - 1) / 2).cast("bigint")).drop("_total", "_one")


def pages(scored: DataFrame, page_size: int = PAGE_SIZE, max_pages: int | None = None) -> DataFrame:
    """Number the pages of ranked sectors; ``max_pages`` limits the report, ``None`` keeps all."""
    paged = scored.withColumn("page", F.ceil(F.col("rang_deces") / page_size).cast("int"))
    return paged if max_pages is None else paged.where(F.col("page") <= max_pages)


def sectors_without_natives(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count_if(F.col("nb_natif") == 0).alias("nb_secteurs_sans_natif"))


def overall_state(scored: DataFrame, measure: str = "TAFV", by: Sequence[str] = ()) -> DataFrame:
    """Majority state of a set of sectors, by TAFV around 0.5 or by IMD around 0."""
    middle, high, low, neutral = {
        "TAFV": (0.5, "originaire", "exogene", "neutre"),
        "IMD": (0.0, "inertie", "mobile", "neutre"),
    }[measure]
    counts = scored.groupBy(*by).agg(
        F.count_if(F.col(measure) > middle).alias("nb_sup"),
        F.count_if(F.col(measure) < middle).alias("nb_inf"),
        F.count_if(F.col(measure) == middle).alias("nb_neutre"),
    )
    neutral_leads = (F.col("nb_neutre") > F.col("nb_sup")) & (F.col("nb_neutre") > F.col("nb_inf"))
    state = (
        F.when(neutral_leads | (F.col("nb_inf") == F.col("nb_sup")), neutral)
        .when(F.col("nb_sup") > F.col("nb_inf"), high)
        .otherwise(low)
    )
    return counts.withColumn("etat", state)


def extreme_cells(
    matrix: DataFrame, sector: str, measure: str, largest: bool = True, by: Sequence[str] = ("page",), top: int = 5
) -> DataFrame:
    """The most extreme cells of each page's sector by age-class matrix, ranked from 1.

    At most ``top`` of them, and always two fewer than the matrix has cells.
    Ties go to the first sector, then the first class. A page is a bounded
    report (its sectors by seven classes).
    """
    order = F.desc(measure) if largest else F.asc(measure)
    ranked = Window.partitionBy(*by).orderBy(order, F.asc(sector), class_rank(F.col("classe_age"), AGE_CLASSES_7))
    sizes = matrix.groupBy(*by).agg(
        (F.count_distinct(sector) * F.count_distinct("classe_age") - 2).alias("_room")
    )
    return (
        matrix.where(F.col(measure).isNotNull())
        .withColumn("rang", F.row_number().over(ranked))
        .join(sizes, list(by))
        .where(F.col("rang") <= F.least(F.lit(top), F.col("_room")))
        .select(*by, sector, "classe_age", measure, "rang")
    )


def extreme_lines(
    matrix: DataFrame, sector: str, measure: str, largest: bool = True, by: Sequence[str] = ("page",)
) -> DataFrame:
    """Age class with the extreme sum and sector with the extreme mean of each page's matrix."""
    sign = -1 if largest else 1

    def best(lines: DataFrame, label: str, score: Column, tie: Column, name: str) -> DataFrame:
        # Ties go to the first label, so the order of the label runs against the pick.
        return lines.groupBy(*by).agg(
            F.min_by(label, F.struct((score * sign).alias("s"), tie.alias("t"))).alias(name),
            (F.max(score) if largest else F.min(score)).alias(f"{name}_valeur"),
        )

    by_class = matrix.groupBy(*by, "classe_age").agg(F.coalesce(F.sum(measure), F.lit(0.0)).alias("s"))
    by_sector = (
        matrix.groupBy(*by, sector).agg(F.avg(measure).alias("s")).where(F.col("s").isNotNull())
    )
    classes = best(
        by_class.withColumn("s", round_even(F.col("s"), 6)),
        "classe_age",
        F.col("s"),
        class_rank(F.col("classe_age"), AGE_CLASSES_7),
        "classe_extreme",
    )
    sectors = best(
        by_sector.withColumn("s", round_even(F.col("s"), 6)), sector, F.col("s"), F.col(sector), "secteur_extreme"
    )
    return classes.join(sectors, list(by))


def ratio_scores(df: DataFrame, level: str, variant: str) -> DataFrame:
    """The two older composite scores of a level.

    ``distance``: native rate, native share of the distance (0 without native
    distance). ``mediane``: outsider rate, ratio of the medians (null without
    native median; its normalised value is then 1). Both weigh the min-max
    normalised counts and outsider distance 0.6 / 0.2 / 0.1.
    """
    keys = level_keys(level)
    flag = LEVEL_FLAGS[level]
    cells = distance_cells(df, keys, [flag])
    sectors = cells.groupBy(*keys).agg(*_score_columns(F.col(flag))).drop("log_distance", "deces")
    people = F.col("nb_natif") + F.col("nb_exogene")
    if variant == "distance":
        total = F.col("distance_exogene") + F.col("distance_natif")
        ratio = F.when(F.col("distance_natif") == 0, 0.0).otherwise(rate(F.col("distance_natif"), total, 2))
        tafv, missing = rate(F.col("nb_natif"), people, 3), F.lit(None).cast("double")
    else:
        ratio = F.when(
            F.col("med_distance_natif") != 0, rate(F.col("med_distance_exogene"), F.col("med_distance_natif"), 2)
        )
        tafv, missing = rate(F.col("nb_exogene"), people, 3), F.lit(1.0)
    sectors = sectors.withColumn("TAFV", tafv).withColumn("IMD", ratio)
    measures = {
        "IMD": "IMD_nor",
        "nb_exogene": "exogene_nor",
        "nb_natif": "natif_nor",
        "distance_exogene": "distance_exogene_nor",
    }
    ends = sectors.agg(
        F.struct(
            *[F.min(c).alias(f"{c}_min") for c in measures], *[F.max(c).alias(f"{c}_max") for c in measures]
        ).alias("ends")
    ).scalar()
    result = sectors.withColumn("_e", ends)
    for measure, name in measures.items():
        low, high = F.col(f"_e.{measure}_min"), F.col(f"_e.{measure}_max")
        result = result.withColumn(name, rate(F.col(measure) - low, high - low))
    result = result.withColumn("IMD_nor", F.when(F.col("IMD").isNull(), missing).otherwise(F.col("IMD_nor")))
    score = 0.6 * F.col("natif_nor") + 0.2 * F.col("exogene_nor") + 0.1 * (1 - F.col("distance_exogene_nor"))
    return result.withColumn("score", score).drop("_e")
