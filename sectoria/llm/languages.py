"""Language of texts by fusing independent evidence in Bayes' rule.

Four kinds of evidence add up as logarithms for every language:

- the text: hashed byte trigrams under one distribution for each language, counted over all rows that declare it;
- the declared language: how often texts of a language, as the text alone decides, carry this declaration;
- the address suffix: how often texts of a language stand under it;
- the host: languages of its texts, smoothed towards its domain, which is smoothed towards the whole corpus.

A background of evenly spread trigrams stands against the languages: texts of other languages and texts of none are more
likely under it than under any language, and get none.

The last three are grouped counts of the decisions that the text alone gives. They settle short texts; long ones speak for
themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .bytetext import LOWER, byte_column, released, text_chunks

BUCKETS = 1 << 14
# Every byte stands in three trigrams, so a third of their sum is taken as independent.
TEXT_SCALE = 1 / 3
# A declared code needs this many trigrams of text in all rows together to be modelled as a language.
LEAST_TRIGRAMS = 256
# Share of the rows that the background is given beforehand.
BACKGROUND = 0.001
SMOOTHING = 20.0
LEAST_CONFIDENCE = 0.5
EVIDENCE = ("declared", "suffix", "host")

IS_LETTER = np.zeros(256, dtype=np.int64)
IS_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0xC3, 0x100)]] = 1


def trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bucket of the three bytes from each place on, lower case; ``BUCKETS`` where a text ends before."""
    lowered = LOWER[data].astype(np.uint32)
    codes = np.full(len(data), BUCKETS, dtype=np.int32)
    if len(data) > 2:
        joined = lowered[:-2] | lowered[1:-1] << np.uint32(8) | lowered[2:] << np.uint32(16)
        codes[:-2] = (joined * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)
    ends = offsets[1:][np.diff(offsets) > 0]
    codes[ends - 1] = BUCKETS
    codes[np.maximum(ends - 2, 0)] = BUCKETS
    return codes


def declared_code(column: Column) -> Column:
    """Primary subtag in lower case; null for anything else than a code of two or three letters."""
    code = F.lower(F.regexp_extract(column, r"^\s*([A-Za-z]{2,3})(?:[-_][A-Za-z0-9_-]*)?\s*$", 1))
    return F.when(code != "", code)


def host_of(url: Column) -> Column:
    """Host of an address in lower case, without user and port."""
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def suffix_of(host: Column) -> Column:
    suffix = F.regexp_extract(host, r"\.([a-z]{2,})\.?$", 1)
    return F.when(suffix != "", suffix)


def domain_of(host: Column) -> Column:
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+)\.?$", 1)
    return F.when(domain != "", domain)


def _counts(languages: list[str]):
    number = {language: i for i, language in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS + 1), dtype=np.int64)
        for batch in batches:
            data, offsets = byte_column(batch.column("text"))
            owner = np.array([number.get(x, -1) for x in batch.column("declared").to_pylist()])
            for first, last in text_chunks(offsets):
                low, high = int(offsets[first]), int(offsets[last])
                places = offsets[first : last + 1] - low
                codes = trigrams(data[low:high], places)
                for language in np.unique(owner[first:last][owner[first:last] >= 0]):
                    inside = np.repeat(owner[first:last] == language, np.diff(places))
                    total[language] += np.bincount(codes[inside], minlength=BUCKETS + 1)
        language, bucket = np.nonzero(total[:, :BUCKETS])
        yield pa.RecordBatch.from_arrays(
            [pa.array(language), pa.array(bucket), pa.array(total[language, bucket])], names=["language", "bucket", "n"]
        )

    return run


def text_model(items: DataFrame, languages: list[str]) -> np.ndarray:
    """Log probability of every bucket in every language, add-one smoothed; the last bucket weighs nothing."""
    declared = items.where(F.col("declared").isin(languages)).select("text", "declared")
    counts = (
        declared.mapInArrow(released(_counts(languages)), "language long, bucket long, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    table = np.ones((len(languages), BUCKETS))
    table[counts["language"].to_numpy(), counts["bucket"].to_numpy()] += counts["n"].to_numpy()
    logs = np.log(table / table.sum(axis=1, keepdims=True))
    return np.vstack([logs.T, np.zeros(len(languages))]).astype(np.float32)


def _likelihoods(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.value
        for batch in batches:
            data, offsets = byte_column(batch.column("text"))
            sums = np.zeros((batch.num_rows, table.shape[1]))
            letters = np.zeros(batch.num_rows, dtype=np.int64)
            places = np.maximum(np.diff(offsets) - 2, 0).astype(np.int64)
            full = np.diff(offsets) > 0
            for first, last in text_chunks(offsets):
                low, high = int(offsets[first]), int(offsets[last])
                rows = first + np.flatnonzero(full[first:last])
                if not len(rows):
                    continue
                codes = trigrams(data[low:high], offsets[first : last + 1] - low)
                starts = offsets[rows] - low
                letters[rows] = np.add.reduceat(IS_LETTER[data[low:high]], starts)
                for language in range(table.shape[1]):
                    sums[rows, language] = np.add.reduceat(table[codes, language].astype(np.float64), starts)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * table.shape[1]
            columns = {n: batch.column(n) for n in batch.schema.names if n != "text"}
            columns |= {"letters": pa.array(letters), "trigrams": pa.array(places)}
            columns |= {"texts_log": pa.ListArray.from_arrays(ends, sums.ravel())}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def declared_languages(items: DataFrame) -> list[str]:
    """Declared codes with at least ``LEAST_TRIGRAMS`` trigrams of text."""
    trigrams = F.greatest(F.octet_length(F.coalesce("text", F.lit(""))) - 2, F.lit(0)).cast("long")
    counts = items.where(F.col("declared").isNotNull()).groupBy("declared").agg(F.sum(trigrams).alias("n")).collect()
    return sorted(r.declared for r in counts if r.n >= LEAST_TRIGRAMS)


def _votes(size: int) -> Column:
    return F.array(*[F.sum((F.col("decided") == i).cast("double")) for i in range(size)]).alias("votes")


def _smoothed(votes: Column, prior: Column, weight: float) -> Column:
    """Shares of the votes, as if ``weight`` more had been cast by ``prior``."""
    total = F.aggregate(votes, F.lit(0.0), lambda a, x: a + x) + F.lit(weight)
    return F.zip_with(votes, prior, lambda v, p: (v + p * F.lit(weight)) / total)


def _logs(shares: Column) -> Column:
    return F.transform(shares, lambda x: F.log(x))


def evidence_tables(decided: DataFrame, size: int) -> tuple[list[float], DataFrame, DataFrame, DataFrame]:
    """Share of each language, and the logarithms that a declaration, a suffix and a host add to the languages."""
    rows = decided.where(F.col("decided").isNotNull()).withColumn("declared", F.when(F.col("modelled"), F.col("declared")))
    overall = rows.agg(_votes(size)).first().votes or [0.0] * size
    totals = [(n or 0.0) + 1.0 for n in overall]
    shares = [n / sum(totals) for n in totals]
    prior = F.array(*[F.lit(s) for s in shares])

    def likelihood(column: str) -> DataFrame:
        """P(value | language) as share of the language among the value's rows over its share in all, by Bayes' rule."""
        votes = rows.where(F.col(column).isNotNull()).groupBy(column).agg(_votes(size))
        lifted = F.zip_with(_smoothed(F.col("votes"), prior, SMOOTHING), prior, lambda s, p: F.log(s / p))
        return votes.select(column, lifted.alias(f"{column}_log"))

    hosts = rows.where(F.col("host").isNotNull()).groupBy("host", "domain").agg(_votes(size))
    hosts = cut_lineage(hosts)
    each = F.array(*[F.sum(F.col("votes")[i]) for i in range(size)]).alias("votes")
    domains = hosts.where(F.col("domain").isNotNull()).groupBy("domain").agg(each)
    domains = domains.select("domain", _smoothed(F.col("votes"), prior, SMOOTHING).alias("shares"))
    host_shares = _smoothed(F.col("votes"), F.coalesce("shares", prior), SMOOTHING)
    priors = hosts.join(domains, "domain", "left").select("host", _logs(host_shares).alias("host_log"))
    return shares, likelihood("declared"), likelihood("suffix"), priors


def fused_languages(items: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Language of every row of ``items``: columns ``ids``, ``text``, ``declared``, ``suffix``, ``host``.

    Returns ``ids``, ``declared`` (as a code, null if it is none), ``modelled`` (whether that code has
    ``LEAST_TRIGRAMS`` trigrams of text, null without a code), ``language``, ``confidence`` (posterior share of the
    language) and ``kept``. A row without any letter, or of no language with at least ``LEAST_CONFIDENCE``, is not kept.
    The language is null and the confidence 0 without letters and where the background is more likely than every language.
    A code that is not modelled counts as no declaration: text, suffix and host decide. Null evidence adds nothing, null
    text has no letters. If no code is modelled, no language is known and no row is kept. Ties go to the first language in
    alphabetical order.
    """
    spark = items.sparkSession
    items = items.select(
        *ids,
        "text",
        declared_code(F.col("declared")).alias("declared"),
        F.col("suffix").cast("string").alias("suffix"),
        F.col("host").cast("string").alias("host"),
    )
    languages = declared_languages(items)
    modelled = F.col("declared").isin(languages).alias("modelled")
    if not languages:
        return items.select(
            *ids,
            "declared",
            F.when(F.col("declared").isNotNull(), False).alias("modelled"),
            F.lit(None).cast("string").alias("language"),
            F.lit(0.0).alias("confidence"),
            F.lit(False).alias("kept"),
        )
    model = spark.sparkContext.broadcast(text_model(items, languages))
    schema = items.drop("text").schema.add("letters", T.LongType()).add("trigrams", T.LongType())
    schema = schema.add("texts_log", T.ArrayType(T.DoubleType()))
    scored = items.mapInArrow(released(_likelihoods(model)), schema)
    best = (F.array_position("texts_log", F.array_max("texts_log")) - 1).cast("int")
    background = F.col("trigrams") * F.lit(-math.log(BUCKETS) * TEXT_SCALE) + F.lit(math.log(BACKGROUND))
    speaks = (F.col("letters") > 0) & (F.array_max("texts_log") * F.lit(TEXT_SCALE) >= background)
    decided = cut_lineage(
        scored.withColumns(
            {"decided": F.when(speaks, best), "domain": domain_of(F.col("host")), "modelled": modelled}
        )
    )
    size = len(languages)
    shares, declared, suffixes, hosts = evidence_tables(decided, size)
    # Declarations are codes of two or three letters, so at most 26^2 + 26^3 rows go to every task.
    known = (
        decided.join(F.broadcast(declared), "declared", "left")
        .join(suffixes, "suffix", "left")
        .join(hosts, "host", "left")
    )
    nothing = F.array(*[F.lit(0.0)] * size)
    overall = F.array(*[F.lit(math.log(s)) for s in shares])
    parts = [
        F.transform("texts_log", lambda x: x * F.lit(TEXT_SCALE)),
        F.coalesce("declared_log", nothing),
        F.coalesce("suffix_log", nothing),
        F.coalesce("host_log", overall),
    ]
    fused = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), parts)
    top = F.array_max("fused")
    told = (F.col("letters") > 0) & (F.col("top") >= F.col("background"))
    names = F.array(*[F.lit(x) for x in languages])
    share = F.lit(1.0) / F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    return (
        known.select(*ids, "declared", "modelled", "letters", background.alias("background"), fused.alias("fused"))
        .withColumn("top", top)
        .select(
            *ids,
            "declared",
            "modelled",
            F.when(told, F.element_at(names, F.array_position("fused", F.col("top")).cast("int"))).alias("language"),
            F.when(told, share).otherwise(0.0).alias("confidence"),
        )
        .withColumn("kept", F.col("language").isNotNull() & (F.col("confidence") >= LEAST_CONFIDENCE))
    )


def document_items(docs: DataFrame) -> DataFrame:
    """Documents as items: the language column is the declaration, the source stands for the host."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.col("lang").alias("declared"),
        F.lit(None).cast("string").alias("suffix"),
        F.col("source").alias("host"),
    )


def page_items(pages: DataFrame) -> DataFrame:
    """Pages as items: visible text of the html, language of its root element, suffix and host of its address."""
    html = F.coalesce("html", F.lit(""))
    hidden = F.regexp_replace(html, r"(?is)<(script|style|head)\b.*?</\1\s*>|<!--.*?-->", " ")
    host = host_of(F.col("url"))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(hidden, r"<[^>]*>|&[#A-Za-z0-9]+;", " ").alias("text"),
        F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z0-9_-]+)""", 1).alias("declared"),
        suffix_of(host).alias("suffix"),
        host.alias("host"),
    )
