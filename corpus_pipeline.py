"""Documents to training sequences: five stages, each over all that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateline.llm.best_fit_packing import best_fit_packing
from stateline.llm.decontamination import decontaminate
from stateline.llm.language_id import language_id
from stateline.llm.ngram_jaccard import ngram_jaccard
from stateline.llm.scratch import landed
from stateline.llm.substring_dedup import substring_dedup
from stateline.llm.workers import importable
from stateline.session import delete, scratch_noted

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A number for each row, from all its columns: equal rows have equal numbers, whatever their ids.
ROW = "_row"


#: Above this many numbers they are joined by a shuffle; 16 MB of them are broadcast.
MOST_BROADCAST = 2_000_000


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.withColumn(ROW, F.xxhash64(*docs.columns))


def _without(docs: DataFrame, numbers: DataFrame) -> DataFrame:
    """The rows whose number is not among ``numbers``; texts are moved only if there are very many of these."""
    dropped = landed(numbers.distinct(), "dropped")
    dropped = F.broadcast(dropped) if dropped.count() <= MOST_BROADCAST else dropped.hint("merge")
    return _numbered(docs).join(dropped, ROW, "left_anti").select(*docs.columns)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a known language: texts without letters, or that no language explains."""
    judged = language_id(_numbered(docs), id=ROW, declared="lang", host="source")
    return _without(docs, judged.where(~F.col("accepted")).select(ROW))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near duplicates, null ids last.

    Rows that are equal in every column are one group, too, and one of them stays. The join runs on row
    numbers; which row of a group has the smallest doc_id is looked up once, at the end.
    """
    with scratch_noted() as made:
        joined = ngram_jaccard(_numbered(docs), id=ROW).select(ROW, F.col("component_id").alias("group"))
    found = landed(joined, "groups")
    for path in made:  # the join's own tables; nothing after this line reads them
        delete(spark, path)
    ids = landed(_numbered(docs).select(ROW, "doc_id").distinct(), "ids")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col(ROW))
    # Only groups of several rows are looked up; they are pre-aggregated, so a large one is no hot key.
    several = found.groupBy("group").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1).select("group")
    grouped = landed(found.join(several, "group").distinct().join(ids, ROW), "grouped")
    first = landed(grouped.groupBy("group").agg(F.min(rank)[ROW].alias(ROW)).select(ROW), "first")
    kept = _without(docs, grouped.select(ROW).join(first, ROW, "left_anti"))
    again = landed(found.groupBy(ROW).count().where(F.col("count") > 1).select(ROW), "repeated")
    if again.isEmpty():
        return kept
    single = _without(kept, again)
    repeated = _numbered(kept).join(again, ROW, "left_semi").select(*docs.columns)
    return single.unionByName(repeated.dropDuplicates())


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts runs of 50 words that a document with a smaller doc_id has; all documents stay."""
    cut = substring_dedup(docs, window=50, n_words="_n_words", n_removed="_n_removed")
    n_chars = F.when(F.col("_n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more repeats benchmark items."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of what is left into sequences of 2048."""
    return best_fit_packing(docs, capacity=2048, end=0)


def _ready(stage: Stage) -> Stage:
    """The stage, with workers that find the package."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(importable(spark), docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("language_id", _ready(languages)),
    ("ngram_jaccard", _ready(near_duplicates)),
    ("substring_dedup", _ready(substrings)),
    ("decontamination", _ready(benchmark)),
    ("best_fit_packing", _ready(sequences)),
]

#: SQL can express neither trigram models, nor token ids, nor best fit; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the scratch folder and read by the next.

    What a stage left in the scratch folder is deleted once its result is written; what the last one left
    is read by the result, and stays as checkpoints do. Each run knows its own folders only.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left: list[str] = []
    for name, stage in STAGES[:-1]:
        with scratch_noted() as made:
            result = stage(spark, docs, sf_dir)
        with scratch_noted() as output:
            docs = landed(result, name)
        for path in [*left, *made]:
            delete(spark, path)
        left = output
    return STAGES[-1][1](spark, docs, sf_dir)
