"""Language identification by Bayesian evidence fusion (operator 8).

Four pieces of evidence are multiplied: how likely each language makes the text, how often texts of a
language declare what this one declares, the same for the suffix of its address, and how common the
language is on its host. Host priors lean on those of the host's domain, and these on all rows, by
pseudo-counts. All tables are grouped counts over all rows; text models are counts of character
trigrams over all texts that declare a language.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateline.llm.scratch import landed
from stateline.llm.words import SMALL_BLOCK_BYTES, blocks, bytes_of

#: Trigrams are counted in so many classes of their hashes.
CLASSES = 1 << 15
#: A declared language has a model if its texts hold this many trigrams, however rare it is.
LEAST_TRIGRAMS = 200
#: Models go to the workers in blocks of so many languages, 128 KB each; tasks keep as many counts before they pass them on.
LANGUAGES_AT_ONCE = 64
#: Trigrams of a text depend on each other: a text weighs as much as at most this many independent ones.
WEIGHT = 64
#: So much of each language's model is any class whatever: unseen trigrams are unlikely, not impossible.
#: Of small models, a greater part: as much as so many trigrams.
ANY_CLASS = 0.1
ANY_TRIGRAMS = 2000
#: Text that is no language: all classes alike. Its name, and its share before any evidence.
UNKNOWN = "und"
UNKNOWN_SHARE = 0.01
#: Pseudo-counts by which a host leans on its domain, a domain on all rows, and a language on the others.
HOST_LEAN, DOMAIN_LEAN, SMOOTHING = 10.0, 50.0, 1.0
#: A row is accepted if it is at least this probable that its language is known, whichever it is.
LEAST_PROBABILITY = 0.65

#: What a text with letters matches.
LETTERS = r"[A-Za-z\x{80}-\x{10FFFF}]"

# Letters fold to small ones; whatever is no letter parts words.
_SYMBOLS = np.zeros(256, np.uint32)
_SYMBOLS[0x61:0x7B] = np.arange(1, 27)
_SYMBOLS[0x41:0x5B] = np.arange(1, 27)
_SYMBOLS[0x80:] = np.arange(27, 155)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The classes of the trigrams that hold two letters at least, and where each text's begin."""
    data, offsets = bytes_of(texts)
    s = _SYMBOLS[data]
    if len(s) < 3:
        return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    code = (s[:-2] * np.uint32(155) + s[1:-1]) * np.uint32(155) + s[2:]
    letters = s > 0
    good = (letters[:-2].astype(np.int8) + letters[1:-1] + letters[2:]) >= 2
    ends = offsets[1:-1]
    for back in (1, 2):  # trigrams across two texts are none
        good[np.clip(ends - back, 0, len(good) - 1)[(ends >= back) & (ends - back < len(good))]] = False
    at = np.flatnonzero(good)
    classes = ((code[at] * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)
    return classes, np.searchsorted(at, offsets)


def trigram_counts(rows: DataFrame) -> DataFrame:
    """Rows ``declared, cls, n``: counts of all trigram classes over all rows that declare each of the languages.

    Tasks count, Spark adds up; a task holds the counts of at most ``LANGUAGES_AT_ONCE`` languages and a block's.
    """

    def flushed(total):
        for language, counts in total.items():
            cls = np.flatnonzero(counts)
            for at in range(0, len(cls), 10_000):
                part = cls[at : at + 10_000]
                columns = [pa.array([language] * len(part), pa.string()), pa.array(part.astype(np.int32)), pa.array(counts[part])]
                yield pa.RecordBatch.from_arrays(columns, ["declared", "cls", "n"])
        total.clear()

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for block in blocks(batches, "text", SMALL_BLOCK_BYTES):
            classes, first = trigrams(block.column("text"))
            coded = block.column("declared").dictionary_encode()
            code, n = coded.indices.to_numpy(), np.diff(first)
            # Rows of one language after each other, and their trigrams with them.
            order = np.argsort(code, kind="stable")
            ends = np.cumsum(n[order])
            at = np.repeat(first[:-1][order] - ends + n[order], n[order]) + np.arange(len(classes))
            bounds = np.concatenate([[0], ends])[np.searchsorted(code[order], np.arange(len(coded.dictionary) + 1))]
            for k, language in enumerate(coded.dictionary.to_pylist()):
                if bounds[k] < bounds[k + 1]:
                    if language not in total:
                        if len(total) >= LANGUAGES_AT_ONCE:
                            yield from flushed(total)
                        total[language] = np.zeros(CLASSES, np.int64)
                    total[language] += np.bincount(classes[at[bounds[k] : bounds[k + 1]]], minlength=CLASSES)
        yield from flushed(total)

    known = rows.where(F.col("declared").isNotNull()).select("text", "declared")
    counted = known.mapInArrow(count, "declared string, cls int, n bigint")
    return counted.groupBy("declared", "cls").agg(F.sum("n").alias("n"))


def log_shares(counts: DataFrame, languages: Sequence[str]) -> np.ndarray:
    """For each of the languages the logs of the shares of its trigram classes, smoothed."""
    found = np.zeros((len(languages), CLASSES), np.float64)
    place = {language: k for k, language in enumerate(languages)}
    table = counts.where(F.col("declared").isin(list(languages))).toArrow()
    at = np.array([place[x] for x in table.column("declared").to_pylist()], np.int64)
    found[at, table.column("cls").to_numpy()] = table.column("n").to_numpy()
    total = found.sum(1, keepdims=True)
    any_class = np.maximum(ANY_CLASS, ANY_TRIGRAMS / (total + ANY_TRIGRAMS))
    return np.log((1 - any_class) * found / np.maximum(total, 1) + any_class / CLASSES).astype(np.float32)


def text_evidence(rows: DataFrame, counts: DataFrame, languages: Sequence[str]) -> DataFrame:
    """``rows`` without ``text`` but with ``ll``, the weighted log likelihood of each language and of none.

    ``ll`` is null for a text without trigrams. The driver holds one block of languages at a time.
    """
    context = rows.sparkSession.sparkContext
    starts = range(0, len(languages), LANGUAGES_AT_ONCE)
    shared = [context.broadcast(log_shares(counts, languages[at : at + LANGUAGES_AT_ONCE])) for at in starts]
    width = len(languages) + 1
    others = [c for c in rows.columns if c != "text"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*others).schema.fields]

    def measure(batches):
        for block in blocks(batches, "text", SMALL_BLOCK_BYTES):
            classes, first = trigrams(block.column("text"))
            n = np.diff(first)
            some = np.flatnonzero(n)
            ll = np.empty((len(some), width))
            if len(some):
                logs = (log for part in shared for log in part.value)
                for k, log in enumerate(logs):
                    ll[:, k] = np.add.reduceat(log[classes], first[:-1][some], dtype=np.float64)
                ll[:, -1] = -math.log(CLASSES) * n[some]
                ll *= (np.minimum(n[some], WEIGHT) / n[some])[:, None]
            offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, width, 0))]).astype(np.int32)
            values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ll.ravel()), mask=pa.array(n == 0))
            yield pa.RecordBatch.from_arrays([*[block.column(c) for c in others], values], [*others, "ll"])

    return rows.mapInArrow(measure, ", ".join([*fields, "ll array<double>"]))


def domain_of(host: Column) -> Column:
    """The last two labels of a host."""
    labels = F.split(host, r"\.")
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")


def _best(values: Column) -> Column:
    """The place of the largest value, the first of equal ones."""
    return F.array_position(values, F.array_max(values)).cast("int") - 1


def _log_shares(counts: Column, prior: Column | None, lean: float, n: int) -> Column:
    """Smoothed shares of an array of counts, leaning on a prior array of shares or on equal ones."""
    base = prior if prior is not None else F.array_repeat(F.lit(1.0 / n), n)
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) + F.lit(lean)
    return F.zip_with(counts, base, lambda c, p: (c + F.lit(lean) * p) / total)


def _counts(place: str, n: int) -> Column:
    """For a group the rows of each language, as an array."""
    return F.array(*[F.sum((F.col(place) == k).cast("double")) for k in range(n)])


def host_priors(rows: DataFrame, n: int) -> tuple[DataFrame, Column]:
    """``host, prior``: shares of languages by host, smoothed by domain and by all rows; and those of all rows.

    ``rows``: ``host`` and ``best``, the language of the text alone. A frequent host is added up before
    it is moved.
    """
    hosts = rows.where(F.col("best").isNotNull()).groupBy("host").agg(_counts("best", n).alias("counts"))
    hosts = landed(hosts.withColumn("domain", domain_of(F.col("host"))), "hosts")
    added = F.array(*[F.sum(F.col("counts")[k]) for k in range(n)])
    everything = hosts.agg(added.alias("counts")).select(_log_shares(F.coalesce("counts", F.array_repeat(F.lit(0.0), n)), None, SMOOTHING * n, n).alias("prior"))
    total = F.lit(everything.first()["prior"])
    hosts = hosts.where(F.col("host").isNotNull())
    domains = hosts.groupBy("domain").agg(added.alias("own")).select("domain", _log_shares(F.col("own"), total, DOMAIN_LEAN, n).alias("above"))
    return hosts.join(domains, "domain").select("host", _log_shares(F.col("counts"), F.col("above"), HOST_LEAN, n).alias("prior")), total


def declaration_odds(rows: DataFrame, column: str, languages: Sequence[str]) -> np.ndarray:
    """For each language (and none) how often its texts declare each language, another one, or nothing.

    A language's row leans on declaring itself: texts are judged by likelihood alone here, and are few
    where a language is rare.
    """
    n = len(languages)
    place = F.array_position(F.lit(list(languages)), F.col(column)).cast("int")
    said = F.when(F.col(column).isNull(), n + 1).when(place > 0, place - 1).otherwise(n)
    table = rows.where(F.col("best").isNotNull()).groupBy("best", said.alias("said")).count().collect()
    counts = np.full((n + 1, n + 2), SMOOTHING)
    counts[np.arange(n), np.arange(n)] += SMOOTHING * 10
    for row in table:
        counts[row["best"], row["said"]] += row["count"]
    return np.log(counts / counts.sum(1, keepdims=True))


def _with_said(rows: DataFrame, odds: np.ndarray, column: str, languages: Sequence[str]) -> DataFrame:
    """``rows`` with ``odds_<column>``, the log odds of what a row declares, one for each language."""
    place = F.array_position(F.lit(list(languages)), F.col(column)).cast("int")
    said = F.when(F.col(column).isNull(), len(languages) + 1).when(place > 0, place - 1).otherwise(len(languages))
    # A table and not a literal: languages are as many as the corpus has.
    table = pa.table({"_said": pa.array(np.arange(odds.shape[1], dtype=np.int32)), f"odds_{column}": pa.array(odds.T.tolist())})
    known = F.broadcast(rows.sparkSession.createDataFrame(table))
    return rows.withColumn("_said", said).join(known, "_said").drop("_said")


def language_id(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    declared: str | Column | None = "lang",
    suffix: str | Column | None = None,
    host: str | Column | None = "source",
    languages: Sequence[str] | None = None,
    least: float = LEAST_PROBABILITY,
) -> DataFrame:
    """Per row its id, ``text_language``, ``language``, ``probability`` and ``accepted``.

    ``declared``, ``suffix`` and ``host`` are columns or expressions, or None where there is no such
    evidence; a null value is a declaration of nothing, and a null host has the prior of all rows.
    ``languages`` are those to tell apart, by default all that are declared with ``LEAST_TRIGRAMS`` of
    text. ``text_language`` is the likeliest by text alone, ``language`` by all evidence, or ``und`` if
    the text is none of them. By default a row that declares a language with less text, so without a
    model, is accepted, and has that language unless a known one has a probability of ``least`` or more.
    Accepted are rows with a known language if all known ones together have a probability of ``least``
    or more: a text in two languages is in doubt between them, but not rejected. A text whose letters make
    no trigram (``Hi``) has a null ``text_language`` and is judged by the rest. A null, empty or letterless
    text has no language: ``text_language`` is null, ``language`` is what the rest says, and the row is not
    accepted. Without any declared language every row is ``und``. Repeated rows and null
    ids stay, an empty table gives an empty result, other columns are ignored.

    Texts are read twice, to count and to judge, and never moved; hosts are joined to a few numbers per row.
    """

    def column(c) -> Column:
        return F.lit(None).cast("string") if c is None else (F.col(c) if isinstance(c, str) else c).cast("string")

    rows = docs.select(
        F.col(id).alias("id"), F.col(text).alias("text"), column(declared).alias("declared"), column(suffix).alias("suffix"), column(host).alias("host")
    )
    rows = rows.withColumn("lettered", F.coalesce(F.col("text").rlike(LETTERS), F.lit(False)))
    named = languages is not None
    counted = rows.where(F.col("declared").isin(list(languages))) if named else rows.where(F.col("declared") != UNKNOWN)
    counts = landed(trigram_counts(counted), "trigrams")
    if not named:
        totals = counts.groupBy("declared").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TRIGRAMS)
        languages = [r["declared"] for r in totals.orderBy(F.desc("n"), "declared").collect()]
    languages, n = list(languages), len(languages)
    unmodelled = F.lit(False) if named else F.col("declared").isNotNull() & ~F.col("declared").isin([*languages, UNKNOWN])
    if not n:
        taken = unmodelled & F.col("lettered")
        language = F.when(taken, F.col("declared")).otherwise(UNKNOWN)
        nothing = [F.lit(None).cast("string").alias("text_language"), language.alias("language"), F.lit(1.0).alias("probability"), taken.alias("accepted")]
        return rows.select(F.col("id").alias(id), *nothing)

    judged = text_evidence(rows, counts, languages)
    judged = landed(judged.withColumn("best", _best(F.col("ll"))), "evidence")
    ways = [(declaration_odds(judged, c, languages), c) for c, given in (("declared", declared), ("suffix", suffix)) if given is not None]

    priors, overall = host_priors(judged, n + 1)
    joined = judged.join(priors, "host", "left")
    prior = F.zip_with(F.coalesce("prior", overall), F.lit([1 - UNKNOWN_SHARE] * n + [UNKNOWN_SHARE]), lambda p, u: F.log(p) + F.log(u))
    score = F.zip_with(prior, F.coalesce("ll", F.array_repeat(F.lit(0.0), n + 1)), lambda p, x: p + x)
    for odds, c in ways:
        joined = _with_said(joined, odds, c, languages)
        score = F.zip_with(score, F.col(f"odds_{c}"), lambda s, x: s + x)
    fused = joined.withColumn("score", score)
    most = F.array_max("score")
    total = F.aggregate("score", F.lit(0.0), lambda a, s: a + F.exp(s - F.array_max("score")))
    names = F.lit([*languages, UNKNOWN])
    language = F.get(names, _best(F.col("score")))
    probability = 1 / total
    known = 1 - F.exp(F.col("score")[n] - most) / total
    accepted = F.col("lettered") & (unmodelled | ((language != UNKNOWN) & (known >= least)))
    doubtful = (language == UNKNOWN) | (probability < least)
    language = F.when(unmodelled & F.col("lettered") & doubtful, F.col("declared")).otherwise(language)
    return fused.select(
        F.col("id").alias(id),
        F.get(names, F.col("best")).alias("text_language"),
        language.alias("language"),
        probability.alias("probability"),
        accepted.alias("accepted"),
    )
