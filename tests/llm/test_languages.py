"""Languages against a plain version of the fusion and against what the tables declare."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectoria.llm import languages as L
from sectoria.llm.queries import op4_language, page_languages


def plain_fusion(rows):
    """Rows of id, text, declared, suffix, host; all declared values are codes."""
    names = sorted({r[2] for r in rows if r[2]})

    def codes(text):
        data = text.encode()
        data = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
        return [(int.from_bytes(data[i : i + 3], "little") * 0x9E3779B1 % 2**32) >> 18 for i in range(len(data) - 2)]

    counts = {n: Counter() for n in names}
    for _, text, declared, _, _ in rows:
        if declared:
            counts[declared].update(codes(text or ""))
    total = {n: sum(counts[n].values()) + L.BUCKETS for n in names}
    texts = {r[0]: [sum(math.log((counts[n][c] + 1) / total[n]) for c in codes(r[1] or "")) for n in names] for r in rows}
    lettered = {r[0] for r in rows if any(c.isalpha() for c in r[1] or "")}
    decided = {i: int(np.argmax(texts[i])) for i in lettered}
    overall = Counter(decided.values())
    prior = [(overall[k] + 1) / (len(decided) + len(names)) for k in range(len(names))]

    def votes(place):
        found = defaultdict(Counter)
        for r in rows:
            if r[0] in decided and place(r) is not None:
                found[place(r)][decided[r[0]]] += 1
        return found

    def smooth(count, base):
        n = sum(count.values())
        return [(count[k] + L.SMOOTHING * base[k]) / (n + L.SMOOTHING) for k in range(len(names))]

    def domain(r):
        return ".".join(r[4].split(".")[-2:]) if r[4] and "." in r[4] else None

    declared, suffix, host, domains = (votes(p) for p in (lambda r: r[2], lambda r: r[3], lambda r: r[4], domain))
    result = {}
    for r in rows:
        if r[0] not in lettered:
            result[r[0]] = (None, 0.0)
            continue
        score = [x * L.TEXT_SCALE for x in texts[r[0]]]
        for table, value in ((declared, r[2]), (suffix, r[3])):
            if value is not None:
                score = [s + math.log(p / q) for s, p, q in zip(score, smooth(table[value], prior), prior)]
        base = smooth(domains[domain(r)], prior) if domain(r) else prior
        shares = smooth(host[r[4]], base) if r[4] is not None else prior
        score = [s + math.log(p) for s, p in zip(score, shares)]
        top = max(score)
        result[r[0]] = (names[score.index(top)], 1 / sum(math.exp(s - top) for s in score))
    return result


def rows():
    words = {
        "en": "the of and to in is that with are was for this from".split(),
        "fr": "le la les des est une dans pour que avec sur pas".split(),
        "de": "der die das und ist nicht ein eine mit auf den von".split(),
    }
    rng = np.random.default_rng(3)
    made = []
    for i in range(60):
        code = ("en", "fr", "de")[i % 3]
        text = " ".join(rng.choice(words[code], size=int(rng.integers(1, 40))))
        host = f"{('a', 'b', 'c')[i % 3]}{i % 2}.example.{'com' if i % 4 else 'org'}"
        made.append((i, text, code if i % 5 else None, host.split(".")[-1] if i % 7 else None, host if i % 6 else None))
    made += [(100, None, "en", None, None), (101, "12 345 --", "de", "com", None), (102, "", None, None, "a0.example.com")]
    made += [(103, "des", None, "com", "b1.example.com"), (104, "n", None, None, "c0.example.org"), (105, "x", "fr", "org", None)]
    return made


SCHEMA = "doc_id long, text string, declared string, suffix string, host string"


def test_fusion_equals_a_plain_version(spark):
    found = {r.doc_id: r for r in L.fused_languages(spark.createDataFrame(rows(), SCHEMA).repartition(3), ["doc_id"]).collect()}
    wanted = plain_fusion(rows())
    assert set(found) == set(wanted)
    for i, (language, confidence) in wanted.items():
        assert found[i].language == language and found[i].confidence == pytest.approx(confidence, abs=1e-4), i
        assert found[i].kept == (language is not None and confidence >= L.LEAST_CONFIDENCE)


def test_a_wrong_declaration_loses_against_the_text(spark):
    made = [(i, t, "fr" if i == 1 else d, s, h) for i, t, d, s, h in rows()] + [(200, "und der die das nicht ist " * 9, "fr", None, None)]
    found = {r.doc_id: r for r in L.fused_languages(spark.createDataFrame(made, SCHEMA), ["doc_id"]).collect()}
    assert found[200].language == "de" and found[200].declared == "fr"


def test_given_tables(spark, folder):
    docs = op4_language(spark, folder).collect()
    assert len({r.doc_id for r in docs}) == len(docs) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert sum(r.language == r.declared for r in docs) >= 0.98 * len(docs) and sum(r.kept for r in docs) >= 0.99 * len(docs)
    pages = page_languages(spark, folder).collect()
    assert len(pages) == 50 and sum(r.language == r.declared for r in pages) >= 45


def test_no_declarations_no_rows_and_clashing_columns(spark):
    items = spark.createDataFrame(rows(), SCHEMA)
    silent = L.fused_languages(items.withColumn("declared", F.lit("??")), ["doc_id"]).collect()
    assert len(silent) == len(rows()) and not any(r.kept for r in silent)
    assert L.fused_languages(items.where("false"), ["doc_id"]).collect() == []
    clash = items.withColumns({"letters": F.lit(1), "votes": F.lit(2), "domain": F.lit("x"), "top": F.lit(0)})
    assert L.fused_languages(clash.unionAll(clash), ["doc_id"]).count() == 2 * len(rows())


@pytest.mark.parametrize(
    ("url", "host", "suffix", "domain"),
    [
        ("https://www.Example.co.uk:80/a?b", "www.example.co.uk", "uk", "co.uk"),
        ("//user@m.site.fr#x", "m.site.fr", "fr", "site.fr"),
        ("http://localhost/", "localhost", None, None),
        ("nonsense", None, None, None),
        (None, None, None, None),
    ],
)
def test_addresses(spark, url, host, suffix, domain):
    df = spark.createDataFrame([(url,)], "url string").select(L.host_of(F.col("url")).alias("host"))
    row = df.select("host", L.suffix_of(F.col("host")).alias("s"), L.domain_of(F.col("host")).alias("d")).first()
    assert tuple(row) == (host, suffix, domain)


def test_foreign_scripts_and_random_letters_are_of_no_language(spark, folder):
    rng = np.random.default_rng(7)
    russian = "В начале было слово, и это слово знали все люди, которые жили тогда в нашем старом городе у большой реки."
    chinese = "天下大势分久必合合久必分周末七国分争并入于秦及秦灭之后楚汉分争又并入于汉"
    letters = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
    other = [russian, chinese] + ["".join(rng.choice(letters, n)) for n in (50, 200) for _ in range(20)]
    docs = L.document_items(spark.read.parquet(f"{folder}/documents.parquet"))
    made = spark.createDataFrame([(-1 - i, t, None, None, None) for i, t in enumerate(other)], SCHEMA)
    rows = L.fused_languages(docs.unionByName(made), ["doc_id"]).collect()
    foreign = [r for r in rows if r.doc_id < 0]
    assert len(foreign) == len(other) and not any(r.kept or r.language for r in foreign)
    assert all(r.kept for r in rows if r.doc_id >= 0)


def test_rare_declarations_keep_their_language_or_count_as_none(spark):
    """Far fewer than one in a thousand rows declare Finnish; codes with too little text leave the rest to decide."""
    finnish = "ja on ei se että hän oli mutta niin kuin myös vain tämä ovat".split()
    rng = np.random.default_rng(5)
    made = [(1000 + i, t, "en", None, None) for i in range(250) for _, t, d, _, _ in rows()[:60] if d == "en"]
    made += rows() + [(-1 - i, " ".join(rng.choice(finnish, size=60)), "fi", None, None) for i in range(2)]
    english = next(t for _, t, d, _, _ in rows() if d == "en" and t and len(t) > 40)[:200]
    made += [(-9, english, "xx", None, None), (-10, "12 34", "eu", None, None), (-11, english, None, None, None)]
    found = {r.doc_id: r for r in L.fused_languages(spark.createDataFrame(made, SCHEMA), ["doc_id"]).collect()}
    assert all(found[i].language == "fi" and found[i].kept and found[i].modelled for i in (-1, -2))
    assert (found[-9].declared, found[-9].modelled, found[-9].language, found[-9].kept) == ("xx", False, "en", True)
    assert (found[-9].confidence, found[-11].modelled) == (found[-11].confidence, None)
    assert (found[-10].language, found[-10].confidence, found[-10].kept, found[-10].modelled) == (None, 0.0, False, False)
