"""Near duplicates, repeated runs and contamination against plain versions."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import stateline.llm.ngram_jaccard as jaccard
import stateline.llm.substring_dedup as substring
import stateline.llm.words as words_module
from stateline.llm.components import components
from stateline.llm.decontamination import decontaminate, hit_words, with_matches
from stateline.llm.ngram_jaccard import least_difference, ngram_jaccard, ngram_jaccard_links, signature
from stateline.llm.substring_dedup import COVER, PERIOD, substring_dedup

SCHEMA = "doc_id long, text string, n_words string, cls int"


def changed(rng: random.Random, text: str, share: float) -> str:
    return " ".join(rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in text.split())


def families(seed: int) -> list[tuple]:
    """Documents of a few families of copies and near copies, with a passage that many share, and odd ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts = [None, "", "  \n", "one two", "ONE two", "one two three", "x " * 300, "x " * 400]
    for _ in range(6):
        base = " ".join(rng.choices(vocabulary, k=rng.randint(60, 160)))
        texts += [base, base, base.upper()]
        texts += [changed(rng, base, rng.choice([0.01, 0.02, 0.04, 0.1])) for _ in range(12)]
        texts.append(base + " " + passage)
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(5, 150))) + " " + passage for _ in range(15)]
    rng.shuffle(texts)
    rows = [(i * 3, t, "clash", i) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[7], "", 0), (None, texts[7], "", 0), (rows[9][0], texts[3], "", 1)]
    return rows


@pytest.mark.parametrize("few, hubs, frequent", [(8, 3, 1 << 17), (1, 1, 1 << 17), (2, 1, 0)])
def test_ngram_jaccard(spark, rows, monkeypatch, few, hubs, frequent):
    monkeypatch.setattr(jaccard, "FEW", few)
    monkeypatch.setattr(jaccard, "HUBS", hubs)
    monkeypatch.setattr(jaccard, "MOST_FREQUENT", frequent)
    table = families(few)
    found = ngram_jaccard(spark.createDataFrame(table, SCHEMA).repartition(5))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    expected = brute.components([r[:2] for r in table])
    assert rows(found) == sorted(expected, key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("block", [256, 3])
def test_ngram_jaccard_links_are_all_links(spark, rows, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    table = families(4)
    found = ngram_jaccard_links(spark.createDataFrame(table, SCHEMA).repartition(5))
    held = [brute.shingles(text) for _, text, *_ in table]
    alike = [[bool(x and y) and 100 * len(x & y) >= 75 * len(x | y) for y in held] for x in held]
    key = lambda r: tuple((v is None, v) for v in r)
    components_ = brute.components([r[:2] for r in table])
    expected = [(row[0], len(x), sum(near) - bool(x)) for row, x, near in zip(table, held, alike, strict=True)]
    assert rows(found.documents, "doc_id", "n_shingles", "n_links") == sorted(expected, key=key)
    assert rows(found.documents, "doc_id", "n_shingles", "component_id") == sorted(components_, key=key)
    kinds = list({frozenset(x) for x in held if x})
    pairs = sorted(len(x & y) for i, x in enumerate(kinds) for y in kinds[:i] if 100 * len(x & y) >= 75 * len(x | y))
    assert sorted(r["common"] for r in found.links.collect()) == pairs


def test_ngram_jaccard_of_nothing(spark, rows):
    assert rows(ngram_jaccard(spark.createDataFrame([], SCHEMA))) == []
    assert rows(ngram_jaccard(spark.createDataFrame([(2, None, "", 0), (1, " ", "", 0)], SCHEMA))) == [(1, 0, 1), (2, 0, 2)]


def test_signatures_never_rule_out_too_much(spark):
    rng = random.Random(1)
    table, differences = [], []
    for _ in range(200):
        a = {rng.getrandbits(64) for _ in range(rng.randint(1, 300))}
        b = set(rng.sample(sorted(a), rng.randint(0, len(a)))) | {rng.getrandbits(64) for _ in range(rng.randint(1, 90))}
        x, y = (signature(np.array(sorted(s), np.uint64)).tolist() for s in (a, b))
        table.append((len(table), x, y))
        differences.append(len(a ^ b))
    frame = spark.createDataFrame(table, "i int, x array<long>, y array<long>")
    found = frame.select("i", least_difference(F.col("x"), F.col("y")).alias("least")).collect()
    assert all(r["least"] <= differences[r["i"]] for r in found)
    assert sum(r["least"] > differences[r["i"]] / 3 for r in found) > 100


def test_components(spark, rows):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 40)] + [(100 + rng.randint(0, 30), 100 + rng.randint(0, 30)) for _ in range(20)] + [(7, 7)]
    found = dict(rows(components(spark.createDataFrame(links, "a long, b long"))))
    least = {v: v for link in links for v in link}
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    linked = {v for a, b in links if a != b for v in (a, b)}
    assert found == {v: least[v] for v in linked}
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []


def repeated(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(50)]
    passages = [rng.choices(vocabulary, k=k) for k in (49, 50, 51, 80, 130)]
    texts = [None, "", " \t", "short", "a " * 200, "a " * 120]
    for _ in range(40):
        words = rng.choices(vocabulary, k=rng.randint(0, 150))
        for passage in rng.sample(passages, rng.randint(0, 2)):
            at = rng.randint(0, len(words))
            words[at:at] = passage
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    texts += [texts[-1], texts[-2], texts[-3].upper()]
    rng.shuffle(texts)
    rows = [(i - 5, t, "clash", i) for i, t in enumerate(texts)]
    return [*rows, rows[12], rows[12], (None, texts[20], "", 0), (rows[4][0], texts[21], "", 0), (rows[30][0], texts[2], "", 0)]


@pytest.mark.parametrize("block", [4 << 20, 2000])
def test_substring_dedup(spark, rows, monkeypatch, block):
    monkeypatch.setattr(words_module, "BLOCK_BYTES", block)
    table = repeated(block)
    docs = spark.createDataFrame(table, SCHEMA).repartition(3)
    expected = brute.kept_words([r[:2] for r in table])
    found = substring_dedup(docs, n_removed="removed")
    assert found.columns == ["doc_id", "text", "cls", "n_words", "removed"]
    assert found.schema["n_words"].dataType.simpleString() == "bigint"
    key = lambda r: tuple((v is None, v) for v in r)
    got = sorted(((r["doc_id"], r["n_words"], r["removed"], " ".join(brute.SPACED.findall(r["text"]))) for r in found.collect()), key=key)
    assert got == sorted(expected, key=key)
    assert sum(r[2] > 0 for r in expected) > 10
    # Texts of which nothing is removed stay as they were.
    before = {(r[0], r[1]) for r in table}
    assert all((r["doc_id"], r["text"]) in before or r["text"] == "" for r in found.where("removed = 0").collect())
    digest = substring_dedup(docs.select("doc_id", "text"), digest=True)
    import hashlib

    assert rows(digest, "doc_id", "n_words", "n_removed", "text") == sorted(
        ((a, b, c, hashlib.sha256(t.encode()).hexdigest()) for a, b, c, t in expected), key=key
    )


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_cover():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))
    with pytest.raises(ValueError):
        substring.substring_dedup(None, window=PERIOD)


def test_hot_hash_is_sent_once_from_a_block():
    routed = substring.Routed(np.array([5, 5, 5, 9, 5], np.uint64), np.array([3, 1, 1, 1, 2]))
    assert (routed.key == 5).sum() == 1
    assert routed.later.tolist() == [False, False, True, True, False]
    assert routed.shared.tolist() == [True, True, True, True, False]


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from all of them today"),
    (2, "tiny"),
    (3, None),
    (4, " .. "),
    (5, "a a a a a a a a a a a a a a a"),
    (6, "The quick brown fox jumps over the lazy dog and runs far AWAY"),
    (10, "two-words"),
    (10, "two-words"),
    (11, "été çà et là"),
]
TEXTS = [
    None,
    "",
    "...",
    ITEMS[0][1].upper() + " and more",
    "x " * 30 + "quick brown fox, jumps over the lazy dog and runs far away from " + "y " * 500,
    "a " * 40,
    "a " * 12,
    "tiny tiny",
    "TINY " + "z " * 400,
    "two words",
    "two word",
    "ÉTÉ été çà et là",
    "quick brown fox jumps over the lazy",
]


@pytest.mark.parametrize("test_bytes, block", [(8 << 20, 4 << 20), (60, 40)])
def test_contamination(spark, monkeypatch, test_bytes, block):
    import stateline.llm.decontamination as module

    monkeypatch.setattr(module, "TEST_BYTES", test_bytes)
    monkeypatch.setattr(words_module, "BLOCK_BYTES", block)
    table = [(i, t, "clash", i) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "", 0), (None, TEXTS[5], "", 0)]
    docs = spark.createDataFrame(table, SCHEMA).repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    found = with_matches(docs, items).withColumn("hit", hit_words(F.col("matches"))).collect()
    key = lambda r: tuple((v is None, str(v)) for v in r)
    got = sorted(((r["doc_id"], r["n_words"], r["hit"], {m["item"] for m in r["matches"]}) for r in found), key=key)
    expected = sorted(brute.contamination([r[:2] for r in table], ITEMS), key=key)
    assert got == expected
    clean = decontaminate(docs, items)
    assert clean.columns == docs.columns
    kept = sorted((r["doc_id"] for r in clean.collect()), key=lambda v: (v is None, v))
    assert kept == sorted((r[0] for r in expected if not (r[2] and 20 * r[2] >= r[1])), key=lambda v: (v is None, v))


def test_longest_match_and_place(spark):
    docs = spark.createDataFrame([(1, "x y " + ITEMS[0][1] + " z")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:1], "item_id int, text string")
    (row,) = with_matches(docs, items).collect()
    assert [tuple(m) for m in row["matches"]] == [(1, 0, 2, 18)]


def test_nothing_to_decontaminate(spark):
    items = spark.createDataFrame([], "item_id int, text string")
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [tuple(r) for r in decontaminate(docs, items).collect()] == [(1, "a")]
    assert decontaminate(docs.limit(0), items).collect() == []


def test_a_text_of_equal_words_fits_a_task():
    """100,000 equal words against items that repeat themselves: one match for each place and item, not for each pair of places."""
    import tracemalloc

    from stateline.llm.decontamination import TestSuffixes, shard_matches
    from stateline.llm.words import ALNUM_LOWER, Words

    texts = pa.array(["same " * 100_000, "other " * 13, "x same same"])
    items = pa.array(["same " * 1000] * 30 + ["other " * 20, "same"])
    tests = TestSuffixes(pa.array(range(len(items))), items, 13)
    words = Words(texts, ALNUM_LOWER)
    tracemalloc.start()
    text, item, _, start, length = shard_matches(words, tests, 13)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20
    assert sorted(set(item[text == 0].tolist())) == [*range(30), 31]
    assert set(item[text == 1].tolist()) == {30} and set(item[text == 2].tolist()) == {31}
    covered = np.zeros(100_000, bool)
    for s, n in zip(start[(text == 0) & (item == 7)], length[(text == 0) & (item == 7)], strict=True):
        covered[s : s + n] = True
    assert covered.all()
    assert (np.diff(text) >= 0).all()
