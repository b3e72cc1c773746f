import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from sectoria.functions import classes, dates, inference, numeric, text


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_rounding_is_half_even_by_scaling(spark):
    got = values(spark, [(0.5,), (1.5,), (2.5,), (-0.5,)], "x double", numeric.round_even(F.col("x")))
    assert got == [0.0, 2.0, 2.0, 0.0]
    assert values(spark, [(0.0125,), (1.015,)], "x double", numeric.round_even(F.col("x"), 3)) == [0.012, 1.015]


def test_rate_without_whole_is_null(spark):
    assert values(spark, [(1, 0), (1, 4)], "a int, b int", numeric.rate(F.col("a"), F.col("b"))) == [None, 0.25]


def test_haversine(spark):
    rows = [(48.86, 2.35, 45.75, 4.85), (0.0, 0.0, 0.0, 180.0), (10.0, 10.0, 10.0, 10.0), (None, 1.0, 1.0, 1.0)]
    got = values(
        spark, rows, "a double, b double, c double, d double", numeric.haversine_km(*[F.col(c) for c in "abcd"])
    )
    assert got[0] == pytest.approx(393.6, abs=1.0)
    assert got[1] == pytest.approx(math.pi * 6371, rel=1e-9)
    assert got[2:] == [0.0, None]


def test_codes_and_text(spark):
    assert values(spark, [("1",), ("123456",), ("-1",), (None,)], "c string", text.pad_code(F.col("c"), 5)) == [
        "00001",
        "123456",
        "-0001",
        None,
    ]
    assert values(spark, [("12.0",)], "c string", text.strip_decimal_suffix(F.col("c"))) == ["12"]
    assert values(spark, [("Îlê dôme",)], "c string", text.fold_accents(F.col("c"))) == ["Île dome"]
    got = values(spark, [("Île",)], "c string", text.fold_accents(F.col("c"), text.COUNTRY_NAMES))
    assert got == ["ile"]
    note = [("1 234 (2019)",), ("55",)]
    assert values(spark, note, "c string", text.parenthesised_year(F.col("c"))) == ["2019", None]
    assert values(spark, note, "c string", text.drop_parentheses(F.col("c"))) == ["1 234", "55"]
    assert values(spark, [(1234567.5,)], "c double", text.group_thousands(F.col("c"))) == ["1 234 568"]
    cities = [("PARIS 06",), ("LYON 3E ARRDT",), ("BORDEAUX NORD",)]
    assert values(spark, cities, "c string", text.agglomeration(F.col("c"))) == ["PARIS", "LYON", "BORDEAUX NORD"]


def test_degrees_and_clock(spark):
    rows = [("48:51:36",), ("-0:30:00",), ("bad",)]
    assert values(spark, rows, "c string", text.dms_to_degrees(F.col("c"))) == [48.86, -0.5, None]
    assert values(spark, [("-10:30:00",)], "c string", text.dms_to_degrees(F.col("c"), legacy_sign=True)) == [-9.5]
    assert values(spark, [(0.5,), (0.40625,)], "x double", text.clock_label(F.col("x"))) == ["12h0", "9h45"]
    assert values(spark, [(0.40625,)], "x double", text.clock_hour(F.col("x"))) == [9]


def test_dates(spark):
    given = [("20240229",), ("20230229",), ("16450513",), ("23000101",), ("x",), (None,)]
    expected = [dt.date(2024, 2, 29), None, None, None, None, None]
    assert values(spark, given, "d string", dates.lenient_date(F.col("d"))) == expected
    flags = [("19500012",), ("19501200",), ("00001212",), ("19501212",)]
    assert values(spark, flags, "d string", dates.zero_part_flag(F.col("d"))) == ["ko", "ko", "ko", "ok"]
    assert values(spark, [("20231231",)], "d string", dates.file_year_flag(F.col("d"), "2024")) == ["ko"]
    assert values(spark, [("20231231",)], "d string", dates.file_year_flag(F.col("d"), "0000")) == ["ok"]
    born = [(dt.date(2000, 1, 1), dt.date(2001, 1, 1)), (dt.date(2001, 1, 2), dt.date(2001, 1, 1)), (None, None)]
    assert values(spark, born, "b date, d date", dates.age_in_years(F.col("b"), F.col("d"))) == [1, 0, None]
    assert values(spark, [(dt.date(2001, 2, 1),)], "d date", dates.month_label(F.col("d"))) == ["Feb"]
    months = [("12",), ("05",), ("08",), ("09",), ("13",)]
    assert values(spark, months, "m string", dates.season(F.col("m"))) == ["hiver", "printemps", "ete", "automne", ""]


def test_age_classes(spark):
    ages = [(0,), (1,), (19,), (64,), (65,), (90,), (129,), (130,), (-1,), (None,)]
    got = values(spark, ages, "a int", classes.age_class(F.col("a")))
    assert got == ["0-1", "1-20", "1-20", "50-65", "65-90", "90+", "90+", None, None, None]
    got = values(spark, [(29,), (30,), (90,)], "a int", classes.age_class(F.col("a"), classes.AGE_CLASSES_4))
    assert got == ["0-30", "30-60", "90+"]


def test_mobility_class(spark):
    rows = [
        ("O", "N", "N", "N"),
        ("N", "O", "N", "N"),
        ("N", "N", "O", "N"),
        ("N", "N", "N", "O"),
        ("N", "N", "N", "N"),
        (None, "O", "O", "O"),
    ]
    got = values(
        spark, rows, "v string, d string, r string, n string", classes.mobility_class(*[F.col(c) for c in "vdrn"])
    )
    assert got == [*classes.MOBILITY_LABELS, "Internationale"]


@pytest.mark.parametrize(
    "function, arguments, expected",
    [
        (inference.normal_two_sided, (1.959963984540054,), 0.05),
        (inference.normal_upper, (1.6448536269514722,), 0.05),
        (inference.student_two_sided, (2.2281388519649385, 10), 0.05),
        (inference.student_two_sided, (12.706204736432095, 1), 0.05),
        (inference.student_two_sided, (1.9599640, 10_000_000), 0.05),
        (inference.chi_square_upper, (3.841458820694124, 1), 0.05),
        (inference.chi_square_upper, (18.307038053275146, 10), 0.05),
        (inference.chi_square_upper, (1.0, 2), math.exp(-0.5)),
        (inference.chi_square_upper, (5.0, 0), 1.0),
    ],
)
def test_tails(spark, function, arguments, expected):
    columns = [F.lit(float(a)) if i == 0 else F.lit(a) for i, a in enumerate(arguments)]
    assert spark.range(1).select(function(*columns)).first()[0] == pytest.approx(expected, rel=1e-5)
