"""Row contracts, date gates, duplicates, overrides, repairs and ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import all_present
from ..functions import dates
from .positions import with_position

# ---------------------------------------------------------------- columns

# Ten digits for the rows of a year: no year of any file reaches them, and year * YEAR_FACTOR stays far within 64 bits.
YEAR_FACTOR = 10**10


def arranged(df: DataFrame, renames: Mapping[str, str], keep: Sequence[str] | None = None, lower: bool = False) -> DataFrame:
    """Rename, optionally lower-case all names, keep and order the listed columns."""
    df = df.withColumnsRenamed(dict(renames))
    if lower:
        df = df.toDF(*[c.lower() for c in df.columns])
    return df if keep is None else df.select(*keep)


def with_overrides(df: DataFrame, key: str, overrides: DataFrame) -> DataFrame:
    """Replace values by those of a small override table (same column names) for its keys.

    A column that only the override table has is added. Null overrides change nothing.
    """
    columns = [c for c in overrides.columns if c != key]
    renamed = overrides.select(F.col(key), *[F.col(c).alias(f"_o_{c}") for c in columns])
    joined = df.join(renamed, key, "left")
    for c in columns:
        value = F.coalesce(F.col(f"_o_{c}"), F.col(c)) if c in df.columns else F.col(f"_o_{c}")
        joined = joined.withColumn(c, value)
    return joined.drop(*[f"_o_{c}" for c in columns])


def to_number(df: DataFrame, column: str, sentinels: Sequence[str]) -> DataFrame:
    """Drop the rows holding a sentinel text, then read the column as a number.

    A missing text is no sentinel: its row stays, with a null number.
    """
    keep = F.col(column).isNull() | ~F.col(column).isin(*sentinels)
    return df.where(keep).withColumn(column, F.col(column).try_cast("double"))


def complete_rows(df: DataFrame, required: Sequence[str], not_equal: Mapping[str, str] | None = None) -> DataFrame:
    """Rows with every required column; ``not_equal`` excludes a fixed value (a missing value is kept)."""
    for column, value in (not_equal or {}).items():
        df = df.where(F.col(column).isNull() | (F.col(column) != value))
    return df.where(all_present(required))


# The strict and the relaxed list of columns a located person must have.
STRICT_PLACE = ["latitude_naissance", "latitude_deces", "code_departement_naissance", "code_departement_deces"]
RELAXED_PLACE = ["latitude_naissance", "latitude_deces"]
FICTITIOUS = {"ville_naissance": "COMMUNE FICTIVE"}


def located_only(df: DataFrame, strict: bool = True) -> DataFrame:
    """Persons with usable places, plus the month and day of death."""
    kept = complete_rows(df, STRICT_PLACE if strict else RELAXED_PLACE, FICTITIOUS)
    return kept.withColumn("month_deces", dates.month_label(F.col("date_deces_dt"))).withColumn(
        "day_deces", F.dayofmonth("date_deces_dt")
    )


# ---------------------------------------------------------------- contract


@dataclass(frozen=True)
class Rule:
    """One field of a row contract; ``pattern`` must match the whole text."""

    field: str
    pattern: str | None = None
    allowed: tuple[str, ...] = ()
    default: str | None = None

    def checks(self) -> list[tuple[Column, str]]:
        """Conditions under which the field fails, with the kind of failure; the first one that holds counts."""
        value = F.col(self.field)
        found = [] if self.default is not None else [(value.isNull(), "missing")]
        if self.pattern is not None:
            found.append((~value.rlike(self.pattern), "string_pattern_mismatch"))
        if self.allowed:
            found.append((~value.isin(*self.allowed), "literal_error"))
        return found

    def failure(self) -> Column:
        """Struct describing the failure, null when the field is valid."""
        report = F.lit(None).cast("struct<champ:string,type:string>")
        for condition, kind in reversed(self.checks()):
            named = F.struct(F.lit(self.field).alias("champ"), F.lit(kind).alias("type"))
            report = F.when(condition, named).otherwise(report)
        return report


# Contract of a parsed death record.
PERSON_CONTRACT = [
    Rule("nom"),
    Rule("prenom"),
    Rule("sex", allowed=("1", "2")),
    Rule("date_naissance", pattern=r"^\d{8}$"),
    Rule("num_insee_naissance", pattern=r"^[A-Za-z0-9]{5}$"),
    Rule("ville_naissance"),
    Rule("pays_naissance", default="FRANCE"),
    Rule("date_deces", pattern=r"^\d{8}$"),
    Rule("num_insee_deces", pattern=r"^[A-Za-z0-9]{5}$"),
]


def with_defaults(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.fillna({r.field: r.default for r in rules if r.default is not None})


def with_contract(df: DataFrame, rules: Sequence[Rule], name: str = "erreurs") -> DataFrame:
    """Fill the defaults and list all failures of each row (empty for a valid row)."""
    return with_defaults(df, rules).withColumn(name, F.array_compact(F.array(*[r.failure() for r in rules])))


def valid_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that meet every rule, defaults filled; plain predicates, no list of failures is built."""
    kept = with_defaults(df, rules)
    for rule in rules:
        for condition, _ in rule.checks():
            kept = kept.where(~condition)
    return kept


def rejected_rows(checked: DataFrame, name: str = "erreurs") -> DataFrame:
    return checked.where(F.size(name) > 0)


def error_counts(checked: DataFrame, name: str = "erreurs") -> DataFrame:
    """Number of failures per field."""
    return (
        checked.select(F.explode(name).alias("e")).groupBy("e.champ").agg(F.count(F.lit(1)).alias("nb_erreurs"))
    )


# ---------------------------------------------------------------- gates


def gate_decisions(
    df: DataFrame, flags: Sequence[Column], counted: str, limit: float = 5.0, by: Sequence[str] = ()
) -> DataFrame:
    """``taux_<i>`` and ``retire_<i>`` for each of the gates, taken in order; one row per group of ``by``.

    Gate ``i`` sees the rows left by the gates before it; it removes its
    flagged rows only if they are less than ``limit`` percent (rounded to 2).
    All combinations of flags are counted in one pass, so the input is read
    once for all gates.
    """
    gates = range(len(flags))
    masks = range(2 ** len(flags))
    mask = reduce(lambda a, b: a + b, [F.when(f == "ko", 2**i).otherwise(0) for i, f in enumerate(flags)])
    marked = df.select(*by, mask.alias("_mask"), F.col(counted).isNotNull().alias("_counted"))
    row = marked.groupBy(*by).agg(
        *[F.count_if(F.col("_mask") == m).alias(f"_n{m}") for m in masks],
        *[F.count_if((F.col("_mask") == m) & F.col("_counted")).alias(f"_c{m}") for m in masks],
    )

    def total(prefix: str, gate: int, chosen: Sequence[int]) -> Column:
        """Sum over the combinations that no earlier gate has removed."""
        parts = []
        for m in chosen:
            left = F.lit(True)
            for j in range(gate):
                if m >> j & 1:
                    left = left & ~F.col(f"retire_{j}")
            parts.append(F.when(left, F.col(f"{prefix}{m}")).otherwise(0))
        return reduce(lambda a, b: a + b, parts)

    for i in gates:
        flagged = total("_c", i, [m for m in masks if m >> i & 1])
        row = row.withColumn(f"taux_{i}", F.bround(F.try_divide(100.0 * flagged, total("_n", i, masks)), 2)).withColumn(
            f"retire_{i}", F.coalesce(F.col(f"taux_{i}") < limit, F.lit(False))
        )
    return row.select(*by, *[f"taux_{i}" for i in gates], *[f"retire_{i}" for i in gates])


def through_gates(
    df: DataFrame, flags: Sequence[Column], counted: str, limit: float = 5.0, by: Sequence[str] = ()
) -> DataFrame:
    """Rows that pass the gates of :func:`gate_decisions`; ``by`` is for a few groups such as file years."""
    decisions = gate_decisions(df, flags, counted, limit, by)
    answer = F.struct(*[c for c in decisions.columns if c not in by]).alias("_gate")
    if by:
        # One row per group: all decisions fit in one map, which every task looks up without a shuffle of the rows.
        table = decisions.select(F.map_from_entries(F.collect_list(F.struct(_group_key(by), answer)))).scalar()
        kept = df.withColumn("_gate", F.element_at(table, _group_key(by)))
    else:
        kept = df.withColumn("_gate", decisions.select(answer).scalar())
    for i, flag in enumerate(flags):
        kept = kept.where((flag == "ok") | ~F.coalesce(F.col(f"_gate.retire_{i}"), F.lit(False)))
    return kept.drop("_gate")


def _group_key(by: Sequence[str]) -> Column:
    """Text that tells groups apart, a null from any value too."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in by]
    return F.concat_ws("\x1f", *parts)


def date_flags(year: Column | str) -> list[Column]:
    """The three date checks of a death record, in order."""
    return [
        dates.zero_part_flag(F.col("date_naissance")),
        dates.zero_part_flag(F.col("date_deces")),
        dates.file_year_flag(F.col("date_deces"), year),
    ]


def checked_dates(df: DataFrame, year: Column | str, limit: float = 5.0, by: Sequence[str] = ()) -> DataFrame:
    """Gates, dates, rows with both dates, no duplicates."""
    return dated_rows(df, year, limit, by).dropDuplicates()


def dated_rows(df: DataFrame, year: Column | str, limit: float = 5.0, by: Sequence[str] = ()) -> DataFrame:
    """Gates, dates, rows with both dates; duplicates are still there."""
    kept = through_gates(df, date_flags(year), "nom", limit, by)
    # One-element inline: each text is read as a date once, not for every condition and result that looks at the date.
    texts = ["date_naissance", "date_deces"]
    read = F.inline(F.array(F.struct(*[dates.parsed_date(F.col(c)).alias(f"{c}_dt") for c in texts])))
    named = [f"{c}_dt" for c in texts]
    return (
        kept.drop(*named)
        .select("*", read)
        .withColumns({c: dates.plausible_date(F.col(c)) for c in named})
        .where(all_present(named))
    )


# ---------------------------------------------------------------- duplicates


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with the number of surplus copies."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") > 1).withColumn("nb_doublons", F.col("_n") - 1).drop("_n")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key in ``order``, the remaining columns breaking ties.

    An aggregate, not a window: each map task keeps one row per key, so a
    frequent key does not gather its rows in one place.
    """
    rest = [c for c in df.columns if c not in keys]
    tie = [c for c in rest if c not in order]
    best = F.min_by(F.struct(*rest), F.struct(*order, *tie)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


# ---------------------------------------------------------------- repair

# Fixed values: (city contains one of these, and one of these, country, code); a later line wins.
BIRTH_PLACE_RULES = [
    (
        ["DEPARTEMENT", "SUD", "ANCIEN"],
        ["ALGER", "CONSTANTINE", "ORAN", "OUENZA", "SEBAA", "SETIF", "TREAT"],
        "ALGERIE",
        "99352",
    ),
    (["DEPARTEMENT"], ["HONGRIE"], "HONGRIE", "99112"),
    (["DEPARTEMENT", "ANCIENNE"], ["IVOIRE"], "COTE D'IVOIRE", "99326"),
    (["DEPARTEMENT"], ["ROUMANI", "HIDA", "BLAJ"], "ROUMANIE", "99114"),
    (["DEPARTEMENT"], ["CHILLAN"], "CHILI", "99417"),
    (["DEPARTEMENT"], ["VIET NAM", "VIETNAM"], "VIETNAM", "99243"),
    (["DEPARTEMENT"], ["SUEDE"], "SUEDE", "99104"),
    (["DEPARTEMENT"], ["ETATS-UNIS"], "ETATS-UNIS", "99404"),
    (["DEPARTEMENT", "ANCIEN"], ["MBAM", "CAMEROUN"], "CAMEROUN", "99322"),
    (["DEPARTEMENT"], ["ALLEMAGNE"], "ALLEMAGNE", "99109"),
    (["DEPARTEMENT"], ["GRECE"], "GRECE", "99126"),
    (["DEPARTEMENT"], ["ESPAGNE"], "ESPAGNE", "99134"),
    (["DEPARTEMENT"], ["URUGUAY"], "URUGUAY", "99423"),
    (["ANCIEN"], ["BELGIQUE"], "BELGIQUE", "99131"),
    (["ANCIEN"], ["GUINEE"], "GUINEE", "99330"),
    (["ANCIEN"], ["GABON"], "GABON", "99328"),
    (["ANCIEN"], ["MADAGASCAR"], "MADAGASCAR", "99333"),
    (["ANCIEN"], ["NIGER"], "NIGER", "99337"),
    (["ANCIEN"], ["SENEGAL"], "SENEGAL", "99341"),
    (["ANCIEN"], ["TCHAD"], "TCHAD", "99344"),
    (["ANCIEN"], ["TOGO"], "TOGO", "99345"),
]


def repaired_places(
    df: DataFrame,
    rules: Sequence[tuple[Sequence[str], Sequence[str], str, str]] = BIRTH_PLACE_RULES,
    city: str = "ville_naissance",
    country: str = "pays_naissance",
    code: str = "num_insee_naissance",
) -> DataFrame:
    """Set country and code from words in the city name; the last matching rule wins.

    The rules are one array value; only cities with a word that opens some rule look into it.
    """

    def words(listed: Sequence[str]) -> Column:
        return F.array(*[F.lit(w) for w in listed])

    table = F.array(
        *[
            F.struct(
                words(first).alias("first"), words(second).alias("second"), F.lit(name).alias("country"), F.lit(number).alias("code")
            )
            for first, second, name, number in rules
        ]
    )

    def mentioned(listed: Column) -> Column:
        return F.exists(listed, lambda word: F.contains(F.col(city), word))

    openers = sorted({word for first, _, _, _ in rules for word in first})
    opens = reduce(lambda a, b: a | b, [F.col(city).contains(w) for w in openers])
    matching = F.filter(table, lambda rule: mentioned(rule["first"]) & mentioned(rule["second"]))
    return (
        df.withColumn("_target", F.when(opens, F.try_element_at(matching, F.lit(-1))))
        .withColumn(country, F.coalesce("_target.country", country))
        .withColumn(code, F.coalesce("_target.code", code))
        .drop("_target")
    )


# ---------------------------------------------------------------- ids and load types


def with_yearly_ids(
    df: DataFrame, year: str, order: Sequence[str], name: str = "idligne", once: Sequence[str] | None = None
) -> DataFrame:
    """Ids ``year * YEAR_FACTOR + position`` (position from 0 inside the year).

    The factor is the same for all data, so a year keeps its ids whatever the other years hold. The reference width of
    six digits would let a year of more than a million rows run into the next one. ``once`` drops duplicates on the way, see
    :func:`with_position`.
    """
    numbered = with_position(df, order, name="_position", by=[year], once=once)
    first = F.col(year).cast("bigint") * YEAR_FACTOR
    return numbered.withColumn(name, first + F.col("_position") - 1).drop("_position")


def load_types(df: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """Types for a table load: timestamps become dates, NaN becomes null, listed columns go if present."""
    df = df.drop(*drop)
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = value.cast("date")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        columns.append(value.alias(field.name))
    return df.select(*columns)
