"""Counts and verdicts against SQL and a plain version."""

import random
import re

from pyspark.sql import functions as F

from sectoria.llm.cascade import COUNTS, Rule, judged, ordered_rules, quality_rules, text_counts, verdict
from sectoria.llm.queries import SQL, op5_quality_rules

from .brute import WORD
from .sqlcheck import check_sql


def plain_counts(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def texts():
    rng = random.Random(6)
    yield from ("", None, " \n\t ", "a", "a b", "a b c", "a b c a b c", " a b c", "x x x x x x", "#* $% <|>\n#* $% <|>\n\n", "a\xa0b é c")
    yield "say it again " * 300
    for _ in range(40):
        yield " ".join(rng.choice("ab c dé\nf g\t".split(" ")) for _ in range(rng.randrange(90)))


def test_counts_equal_a_plain_version(documents):
    rows = list(enumerate(texts()))
    found = {r.doc_id: tuple(r[c] for c in COUNTS) for r in text_counts(documents(*rows)).collect()}
    assert found == {i: plain_counts(t) for i, t in rows}


def test_query_equals_its_sql(spark, folder):
    check_sql(spark, folder, op5_quality_rules, SQL["op5_quality_rules"])


def test_order_changes_no_verdict(documents):
    counted = text_counts(documents(*enumerate(texts())))
    rules = quality_rules()
    both = counted.select(verdict(rules).alias("x"), verdict(rules[::-1]).alias("y")).collect()
    assert all(r.x == r.y for r in both) and {r.x for r in both} == {True, False}


def test_rules_are_ordered_by_rejections_for_their_cost(spark):
    rows = spark.range(20000)
    costly = F.size(F.filter(F.sequence(F.lit(1), F.lit(300)), lambda x: x % 7 == F.col("id") % 7)) > 0
    rules = [Rule("costly", costly), Rule("rare", F.col("id") < 2), Rule("common", F.col("id") % 2 == 0)]
    assert [r.name for r in ordered_rules(rows, rules)][0] == "common"


def test_nulls_repeats_clashing_columns_and_no_rows(documents):
    good = " ".join(f"word{i} goes here" for i in range(30))
    docs = documents((1, good), (1, good), (None, good), (2, None)).withColumns({"words": F.lit(1), "windows": F.lit("x")})
    rows = sorted((r.doc_id or 0, r.base_failed, r.kept) for r in judged(docs).collect())
    assert rows == [(0, False, True), (1, False, True), (1, False, True), (2, True, False)]
    assert judged(docs.where("false")).collect() == []


def test_plan_has_no_python(spark, folder):
    plan = op5_quality_rules(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
