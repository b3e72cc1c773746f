"""Quality rules as a cascade that stops at the first rejection; DataFrame functions only.

Every rule is timed alone on a sample, where also the share of rows that it rejects is counted. Rules then run in the
order of rejected rows per second: what a rule rejects, no later rule looks at. The order changes the work, never the
verdict, which is that no rule rejects.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

SAMPLE_ROWS = 2000
# White space between words, and the symbols that are counted.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARACTERS = " \t\n\x0b\x0c\r"
NO_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for rows that the rule turns down; null counts as false."""

    name: str
    rejects: Column


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions read as values: the optimizer does not copy their expressions into them."""
    made = F.explode_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_made")
    return df.select(*df.columns, made).select(*df.columns, "_made.*")


def _repeated_words(windows: Column) -> Column:
    """Words in windows of three whose hash stands there twice or more, from the hashes in text order.

    The hashes are sorted with their places; equal neighbours mark both places, and a marked place covers three words.
    """
    placed = F.zip_with(windows, F.sequence(F.lit(0), F.size(windows) - 1), lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def covered(ordered: Column) -> Column:
        equal = F.zip_with(
            ordered, F.slice(ordered, 2, F.size(ordered)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
        )
        marked = F.array_distinct(F.flatten(F.filter(equal, lambda x: x.isNotNull())))
        return F.size(F.array_distinct(F.flatten(F.transform(marked, lambda i: F.array(i, i + 1, i + 2)))))

    counted = F.transform(F.array(F.sort_array(placed)), covered)[0]
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(counted)


def text_counts(docs: DataFrame) -> DataFrame:
    """Counts of every whole text beside its words and lines: ``doc_id``, ``text``, ``words``, ``lines`` and ``COUNTS``.

    Lines are those with a word. Null text counts as empty.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    trimmed = F.btrim("text", F.lit(SPACE_CHARACTERS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(NO_SPACE))
    split = _once(texts, words=words, lines=lines)
    n_words = F.size("words")
    zipped = F.arrays_zip(
        F.col("words").alias("a"), F.slice("words", 2, n_words).alias("b"), F.slice("words", 3, n_words).alias("c")
    )
    windows = F.when(
        n_words > 2, F.transform(F.slice(zipped, 1, n_words - 2), lambda x: F.xxhash64(x["a"], x["b"], x["c"]))
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = _once(split, windows=windows)
    return _once(
        hashed,
        n_words=F.size("words").cast("long"),
        word_chars=F.length(F.array_join("words", "")).cast("long"),
        n_symbols=F.regexp_count("text", F.lit(SYMBOLS)).cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        n_repeat_words=_repeated_words(F.col("windows")).cast("long"),
    ).drop("windows")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def quality_rules() -> list[Rule]:
    """Rules for running text; each looks at a share, so long and short texts are judged alike."""
    n_words, n_lines = F.col("n_words"), F.size("lines")
    letters = F.regexp_count("text", F.lit(r"\p{L}"))
    lettered = F.size(F.filter("words", lambda w: w.rlike(r"\p{L}")))
    dotted = F.size(F.filter("lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))
    listed = F.size(F.filter("lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]")))
    return [
        Rule("word_length", (F.col("word_chars") < n_words * 3) | (F.col("word_chars") > n_words * 10)),
        Rule("symbols", F.col("n_symbols") * 10 > n_words),
        Rule("repeated_lines", F.col("n_dup_lines") * 2 > n_lines),
        Rule("upper_case", F.regexp_count("text", F.lit(r"\p{Lu}")) * 2 > letters),
        Rule("words_without_letters", lettered * 10 < n_words * 8),
        Rule("unfinished_lines", dotted * 10 > n_lines * 3),
        Rule("lists", listed * 10 > n_lines * 9),
    ]


def ordered_rules(rows: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """Rules by rejected rows per second on ``rows``, a stored sample; equal ones keep their order."""

    def seconds(*columns: Column) -> tuple[float, int]:
        start = time.perf_counter()
        counted = rows.agg(*[F.count_if(c).alias(str(i)) for i, c in enumerate(columns)]).first()
        return time.perf_counter() - start, counted[0]

    seconds(F.lit(True))
    idle = min(seconds(F.lit(True))[0] for _ in range(2))
    worth = {}
    for rule in rules:
        took, rejected = seconds(F.coalesce(rule.rejects, F.lit(False)))
        worth[rule.name] = rejected / max(took - idle, 0.001)
    return sorted(rules, key=lambda r: -worth[r.name])


def verdict(rules: Sequence[Rule]) -> Column:
    """True if no rule rejects; rules behind the first that does are not evaluated."""
    chain = reduce(lambda c, r: c.when(r.rejects, False), rules[1:], F.when(rules[0].rejects, False))
    return chain.otherwise(True)


def judged(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts and verdict of every document: ``doc_id``, ``COUNTS``, ``base_failed`` and ``kept``.

    A document that fails the base counts is not kept; all others go through the cascade, whose order comes from about
    ``sample_rows`` rows. Null and blank texts have no words and fail. A null doc_id stays null, repeated rows get a row
    each, further columns are not looked at.
    """
    rules = list(rules or quality_rules())
    total = docs.count()
    sample = docs.sample(fraction=min(1.0, sample_rows / total), seed=1) if total else docs
    counted = cut_lineage(text_counts(sample).where(~base_failed()))
    order = ordered_rules(counted, rules)
    return text_counts(docs).select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"), F.when(base_failed(), False).otherwise(verdict(order)).alias("kept")
    )


JUDGED_SQL = r"""WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM texts)),
repeated AS (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM repeated GROUP BY doc_id),
counts AS (SELECT doc_id, text, words, lines, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM texts LEFT JOIN covered USING (doc_id)),
based AS (SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed
  OR word_chars < n_words * 3 OR word_chars > n_words * 10 OR n_symbols * 10 > n_words OR n_dup_lines * 2 > len(lines)
  OR length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) * 2 > length(regexp_replace(text, '[^\p{L}]+', '', 'g'))
  OR len(list_filter(words, lambda w: regexp_matches(w, '\p{L}'))) * 10 < n_words * 8
  OR len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) * 10 > len(lines) * 3
  OR len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) * 10 > len(lines) * 9) AS kept
FROM based"""
