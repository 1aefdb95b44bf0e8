"""The pipeline's stages against plain versions, and the registered queries over the smallest tables."""

from pathlib import Path

import brute
import pytest

import __spark_entry__ as driver
import check
import corpus_pipeline
from stateline.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def db():
    return check.open_tables(FOLDER)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    rows, problems = check.compare(driver.queries()[name](spark, FOLDER), SQL.get(name), db)
    assert not problems
    assert rows


def test_registered():
    names = driver.queries().keys()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in names if name.startswith("op")}
    assert "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard", "substring_dedup", "decontamination", "best_fit_packing"]


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def documents():
    base = " ".join(f"the{i % 7}word and{i % 11}" for i in range(120))
    other = " ".join(f"other{i}text" for i in range(90))
    test = "the answer to this benchmark question is a secret that nobody should ever have seen before today"
    return [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, base + " more", "en", "b", 1),
        (4, other, "en", "b", 1),
        (5, "some beginning words " + " ".join(other.split()[:60]), "en", None, 1),
        (6, "so " + test, None, "b", 1),
        (7, None, "en", "a", None),
        (8, "", "en", "a", 0),
        (None, base, "en", "a", 1),
        (9, "a short text of its own", "en", "c", 23),
        (9, "a short text of its own", "en", "c", 23),
    ], [(1, test), (2, "nothing of the kind")]


@pytest.fixture
def folder(spark, tmp_path):
    docs, items = documents()
    spark.createDataFrame(docs, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_near_duplicates_keep_one_of_each_group(spark, rows, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = stage("ngram_jaccard")(spark, docs, folder)
    assert found.columns == docs.columns
    assert [r[0] for r in rows(found)] == [1, 4, 5, 6, 7, 8, 9]
    plain = brute.components([r[:2] for r in documents()[0] if r[0] is not None])
    assert {r[0] for r in rows(found)} == {component for _, _, component in plain}


def test_substrings(spark, rows, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = stage("substring_dedup")(spark, docs, folder)
    assert found.columns == docs.columns and found.dtypes == docs.dtypes
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in found.collect() if r["doc_id"] != 9}
    for id, _, removed, kept in brute.kept_words([r[:2] for r in documents()[0]]):
        if removed:
            assert texts[id] == (kept, len(kept))
    assert texts[1][0] == documents()[0][0][1]
    assert texts[2] == ("", 0)
    assert texts[5][0] == "some beginning words"


def test_contaminated_documents_go(spark, rows, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = stage("decontamination")(spark, docs, folder)
    assert found.columns == docs.columns
    assert sorted(r[0] for r in rows(found.where("doc_id is not null"))) == [1, 2, 3, 4, 5, 7, 8, 9, 9]


def test_documents_without_a_language_go(spark, rows, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = stage("language_id")(spark, docs, folder)
    assert found.columns == docs.columns
    # 6 has no trigram of the one language here and does not declare it; 7 and 8 have no text.
    assert sorted(r[0] for r in rows(found.where("doc_id is not null"))) == [1, 2, 3, 4, 5, 9, 9]


def test_run(spark, folder):
    found = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in found} == {1, 4, 5, 9}
    assert [r["doc_id"] for r in found].count(9) == 1
    sequences: dict = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length


def test_two_runs_do_not_disturb_each_other(spark, folder):
    """The first result can be read after a second run, and neither leaves the stages' own tables behind."""
    first = corpus_pipeline.run(spark, folder)
    second = corpus_pipeline.run(spark, folder)
    assert first.count() == second.count() > 0
    assert {r["doc_id"] for r in first.collect()} == {r["doc_id"] for r in second.collect()}


def test_short_texts_are_kept(spark, rows, tmp_path):
    """Texts of so few letters that they have no trigram are judged by what they declare."""
    words = "this is a text with enough words in one language to make a model of it and then some more of them"
    docs = [(i, f"{words} {i}", "en", "a", 1) for i in range(20)] + [(100, "Hi", "en", "a", 2), (101, "OK", "en", None, 2), (102, "A -- 1", "en", "b", 6)]
    docs += [(103, "...", "en", "a", 3), (104, "é", "xx", "a", 1)]
    frame = spark.createDataFrame(docs, DOCS)
    found = stage("language_id")(spark, frame, str(tmp_path))
    assert [r[0] for r in rows(found)] == [*range(20), 100, 101, 102, 104]


def test_run_of_nothing(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
