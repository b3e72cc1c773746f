"""Collapsed conversations against SQL and a plain version."""

import random
import re

from pyspark.sql import functions as F

from sectoria.llm.chats import rendered_chats
from sectoria.llm.queries import SQL, op1_chats

from .sqlcheck import check_sql

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    talks = {}
    for conv, turn, role, text in set(rows):
        if conv is not None:
            talks.setdefault(conv, []).append((turn is not None, turn or 0, "unknown" if role is None else role, text or ""))
    talks = {c: tuple((r, t) for _, _, r, t in sorted(set(turns))) for c, turns in talks.items()}
    result = {}
    for conv, said in talks.items():
        longer = any(len(o) > len(said) and o[: len(said)] == said for o in talks.values())
        equal = [c for c, o in talks.items() if o == said]
        if not longer and conv == min(equal):
            chat = "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in said)
            result[conv] = (len(said), len(equal), chat)
    return result


def check(spark, rows):
    found = rendered_chats(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert {r.conv_id: (r.n_turns, r.n_copies, r.chat) for r in found} == plain(rows) and len(found) == len(plain(rows))


def test_query_equals_its_sql(spark, folder):
    check_sql(spark, folder, op1_chats, SQL["op1_chats"])


def test_snapshots_of_growing_chats(spark):
    rng = random.Random(2)
    rows, conv = [], 0
    for _ in range(12):
        said = [(("user", "assistant")[i % 2], rng.choice(("hi", "yes", "no", f"text {rng.random()}"))) for i in range(9)]
        for _ in range(rng.randrange(1, 6)):
            conv += 1
            rows += [(conv, i, r, t) for i, (r, t) in enumerate(said[: rng.randrange(1, 10)])]
    rng.shuffle(rows)
    check(spark, rows)


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "a"),
        (1, 0, "user", "a"),
        (2, 0, "user", "a"),
        (2, 1, None, None),
        (3, None, "user", "a"),
        (3, 0, "user", "a"),
        (4, 5, "", ""),
        (5, 7, "user", "a"),
        (5, 7, "assistant", "b"),
        (None, 0, "user", "a"),
        (6, 0, "user", ""),
        (7, 0, "use", "r"),
        (8, 0, "long", "x" * 100_000),
    ]
    check(spark, rows)


def test_clashing_columns_and_no_rows(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a")], SCHEMA).withColumns({"place": F.lit("x"), "new": F.lit(1), "hash_a": F.lit(0)})
    assert [tuple(r) for r in rendered_chats(turns).collect()] == [(1, 1, 1, "<|im_start|>user\na<|im_end|>\n")]
    assert rendered_chats(turns.where("false")).collect() == []


def test_plan_has_no_python(spark, folder):
    plan = op1_chats(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
