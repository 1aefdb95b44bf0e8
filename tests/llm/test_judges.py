"""URL filters against a plain version; classifiers and language identification on rows held out."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import stateline.llm.url_filters as filters
from stateline.llm.language_id import host_priors, language_id, trigrams
from stateline.llm.quality_classifier import FEATURES, Discriminant, quality_classifier, statistics
from stateline.llm.queries import URL_RULES
from stateline.llm.toxicity import toxicity
from stateline.llm.url_filters import url_filters

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "https://EXAMPLE.org/es/1?x#y",
    "https://a.b.example.org/en/12",
    "https://a.b.example.org/en/2",
    "ftp://example.org?x/es/",
    "http://myexample.org/es/",
    "http://example.com/fr/",
    "http://EXAMPLE.com/de/x",
    "http://com/de/",
    "http://net/",
    "x://y://example.org/es/",
    "http://example.org/es",
    "http://é.org/ü/\n?",
    "http://.org/",
    "http://a..com/fr/../de/",
]


@pytest.mark.parametrize("most_blocks", [filters.MOST_BLOCKS, 1])
def test_url_filters(spark, rows, monkeypatch, most_blocks):
    monkeypatch.setattr(filters, "MOST_BLOCKS", most_blocks)
    rng = random.Random(3)
    hosts, paths = ["org", "example.org", "a.org", "x.com", "com"], ["/", "/e", "/es/", "/es/1", ""]
    listed = list(URL_RULES) + [(f"h{i}.org/p{i}", "block") for i in range(300)]
    urls = URLS + [f"http://{rng.choice(['', 'a.', 'b.a.'])}{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(40)] + ["http://z.h7.org/p7x", "http://h7.org/p"]
    table = [(None if i == 2 else i, u, "clash", "clash") for i, u in enumerate(urls)] + [(4, URLS[4], "", ""), (4, URLS[4], "", "")]
    pages = spark.createDataFrame(table, "page_id long, url string, host string, rule string").repartition(3)
    rules = spark.createDataFrame([*listed, (None, "block"), ("q/", None), listed[0]], "rule string, verdict string")
    found = url_filters(pages, rules, otherwise="allow")
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    key = lambda r: tuple((v is None, v) for v in r)
    assert rows(found) == sorted(((r[0], *brute.judged(r[1], listed)) for r in table), key=key)


def test_url_filters_without_rows(spark, rows):
    rules = spark.createDataFrame([], "rule string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    assert rows(url_filters(pages, rules, otherwise="block")) == [(1, "a.org", "/x", None, "block")]
    assert rows(url_filters(pages.limit(0), rules)) == []


def prose(rng: random.Random, junk: bool) -> str:
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(rng.randint(20, 90))]
    if junk:
        words = [rng.choice(words[:4]) + rng.choice(["###", "!!", "%%"]) for _ in words]
    return " ".join(words)


def test_quality(spark):
    rng = random.Random(4)
    table, labels = [], []
    for i in range(600):
        junk = rng.random() < 0.3
        table.append((i, prose(rng, junk), 1))
        if i % 3:
            labels.append((i, None if i % 50 == 1 else 0 if junk else 1))
    table += [(601, None, 1), (602, "", 1), (None, "some text", 1), table[0], table[0]]
    labels += [labels[0], (None, 0), (5000, 1)]
    docs = spark.createDataFrame(table, "doc_id long, text string, score int").repartition(4)
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    found = quality_classifier(docs, known)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    result = found.collect()
    assert len(result) == len(table)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in result)
    assert all(r["held_out"] == brute.held_out(r["doc_id"]) for r in result)
    scores = {r["doc_id"]: r["score"] for r in result}
    unseen = [(scores[i], y) for i, y in labels if y is not None and i in scores and brute.held_out(i)]
    good, bad = [s for s, y in unseen if y], [s for s, y in unseen if not y]
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    # Labels that are held out change nothing.
    flipped = known.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality_classifier(docs, flipped).collect()}
    assert all(abs(again[i] - scores[i]) < 1e-9 for i in scores)


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality_classifier(docs, none).collect()} == {0.5}
    assert quality_classifier(docs.limit(0), none).collect() == []


def test_statistics():
    x = statistics(pa.array(["", "Aa bb\nbb bb", "x" * 100_000, "é"]).slice(0))
    assert x.shape == (4, len(FEATURES)) and np.isfinite(x).all()
    alone = np.vstack([statistics(pa.array([t])) for t in ("", "Aa bb\nbb bb", "x" * 100_000, "é")])
    assert np.allclose(x, alone)


def test_discriminant_is_the_density_ratio():
    rng = np.random.default_rng(0)
    x = [rng.normal(size=(500, 3)) @ np.diag([1, 2, 3]), rng.normal(size=(700, 3)) + 2]
    sums = {c: (float(len(v)), v.sum(0), v.T @ v) for c, v in enumerate(x)}
    model = Discriminant.fit(sums, 3, 0.0)
    points = rng.normal(size=(20, 3))

    def log_density(v, own):
        cov, d = np.cov(own.T, bias=True), v - own.mean(0)
        return -0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1] + np.log(len(own))

    difference = log_density(points, x[1]) - log_density(points, x[0])
    assert np.allclose(model.score(points), 1 / (1 + np.exp(-difference / 3)))


def test_toxicity(spark):
    rng = random.Random(6)
    table, labels = [], []
    for i in range(500):
        words = ["".join(rng.choices("etaoinsh", k=rng.randint(2, 7))) for _ in range(rng.randint(10, 60))]
        rude, vile = rng.random() < 0.3, False
        if rude:
            words[rng.randrange(len(words))] = rng.choice(["bozo", "Bozos,", "bozoish"])
            vile = rng.random() < 0.5
            if vile:
                words[rng.randrange(1, len(words))] += " vilest"
        table.append((i, " ".join(words), "clash"))
        labels.append((i, int(rude), int(vile and "bozo" in " ".join(words).lower())))
    table += [(None, "x", ""), (900, None, ""), (901, "", ""), table[3], table[3]]
    truth = {i: (a, b) for i, a, b in labels}
    known = labels[:300] + [labels[0], (None, 1, 1), (2, None, 7)]
    docs = spark.createDataFrame(table, "doc_id long, text string, c0 string").repartition(4)
    frame = spark.createDataFrame(known, "doc_id long, rude int, vile int")
    found = toxicity(docs, frame, ["rude", "vile"])
    assert found.columns == ["doc_id", "p_rude", "p_vile"]
    result = found.collect()
    assert len(result) == len(table)
    unseen = [r for r in result if r["doc_id"] in truth and r["doc_id"] >= 300]
    assert np.mean([(r["p_rude"] >= 0.5) == truth[r["doc_id"]][0] for r in unseen]) > 0.95
    assert np.mean([(r["p_vile"] >= 0.5) == truth[r["doc_id"]][1] for r in unseen]) > 0.9
    small = toxicity(docs, frame, ["rude", "vile"], sample_rows=80).collect()
    assert len(small) == len(table)


def test_toxicity_without_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert len(toxicity(docs, none, ["toxic"]).collect()) == 2
    assert toxicity(docs.limit(0), none, ["toxic"]).collect() == []
    only = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert all(r["p_toxic"] < 0.5 for r in toxicity(docs, only, ["toxic"]).collect())


SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["schr", "ung", "ein", "eit"], "cc": ["ção", "lhe", "ir", "ões"]}


def test_language_id(spark):
    rng = random.Random(8)
    table = []
    for i in range(300):
        language = rng.choice(list(SYLLABLES))
        text = " ".join("".join(rng.choices(SYLLABLES[language], k=rng.randint(1, 4))) for _ in range(rng.randint(8, 60)))
        declared = rng.choice([language] * 18 + [None, "aa"])
        table.append((i, text, declared, f"{language}{i % 4}.example.org", language))
    table += [(400, None, "aa", "aa0.example.org", "x"), (401, "12 34 !", "bb", None, "x"), (402, "wq" * 3000, None, "bb1.example.org", "x")]
    table += [(403, "lo", None, "aa1.example.org", "aa"), (404, "zz zz", None, "bb1.example.org", "x"), (None, table[0][1], None, None, table[0][4]), table[5], table[5]]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, language string").repartition(3)
    found = language_id(docs)
    assert found.columns == ["doc_id", "text_language", "language", "probability", "accepted"]
    result = found.collect()
    assert len(result) == len(table)
    by = {r["doc_id"]: r for r in result}
    assert all(by[i]["language"] == language and by[i]["accepted"] for i, _, _, _, language in table[:300])
    assert by[None]["language"] == table[0][4]
    for i in (400, 401):
        assert by[i]["text_language"] is None and not by[i]["accepted"]
    assert by[402]["language"] == "und" and not by[402]["accepted"]
    assert by[403]["language"] == "aa"


def test_language_id_models_all_declared_languages(spark):
    rng = random.Random(9)
    table = []

    def add(language, n):
        base = 0x400 + 40 * language
        for _ in range(n):
            words = ["".join(chr(base + rng.randrange(30)) for _ in range(rng.randint(3, 8))) for _ in range(12)]
            table.append((len(table), " ".join(words), f"l{language}", None))

    for language in range(90):  # more than 64, and half of them below a share of 0.002
        add(language, 40 if language < 45 else 3)
    table.append((len(table), "ßäß öüö", "rare", None))
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string").repartition(3)
    result = {r["doc_id"]: r for r in language_id(docs).collect()}
    assert len(result) == len(table)
    assert all(result[i]["accepted"] and result[i]["language"] == lang for i, _, lang, _ in table)


def test_host_priors_of_rows_without_host(spark):
    rows = spark.createDataFrame([("a.org", 0)] * 5 + [(None, 0)] * 4 + [(None, 1)], "host string, best int")
    priors, overall = host_priors(rows, 2)
    assert [r["host"] for r in priors.collect()] == ["a.org"]
    shares = spark.range(1).select(overall.alias("p")).first()["p"]
    assert np.allclose(shares, [(9 + 1) / 12, (1 + 1) / 12])


def test_language_id_without_models(spark, rows):
    docs = spark.createDataFrame([(1, "abc", "xx", None), (2, "12", "xx", None), (3, "abc", None, None)], "doc_id long, text string, lang string, source string")
    assert rows(language_id(docs), "doc_id", "language", "accepted") == [(1, "xx", True), (2, "und", False), (3, "und", False)]


def test_language_id_without_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None, None)], "doc_id long, text string, lang string, source string")
    assert [tuple(r) for r in language_id(docs).collect()] == [(1, None, "und", 1.0, False)]
    assert language_id(docs.limit(0)).collect() == []
    assert language_id(docs.limit(0), languages=["aa"]).collect() == []


def test_trigrams_do_not_cross_texts():
    whole, first = trigrams(pa.array(["abc", "", "de", "fgh i"]))
    alone = [trigrams(pa.array([t]))[0].tolist() for t in ("abc", "", "de", "fgh i")]
    assert whole.tolist() == [c for t in alone for c in t]
    assert np.diff(first).tolist() == [len(t) for t in alone]
