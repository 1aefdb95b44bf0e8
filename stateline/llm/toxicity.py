"""Toxicity by classifier chains of linear models (operator 7).

Categories are predicted one after the other. A later model sees the probabilities of the earlier
ones; it is trained on probabilities that models gave to rows they had not seen, so that it meets in
use what it met in training. All models are logistic, over the terms that tell the categories apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateline.llm.scratch import landed
from stateline.llm.substring_dedup import word_places
from stateline.llm.words import ALNUM_LOWER, Words, blocks, mix

#: The models are fitted on at most this many labelled rows: for each category and value an equal share,
#: those with the smallest hashes of their ids.
SAMPLE_ROWS = 20_000
TERMS_PER_CATEGORY = 128
LEAST_ROWS_PER_TERM = 3
FOLDS = 5
RIDGE = 0.1
STEPS = 12
#: Beginnings of words, in bytes: inflected forms share them.
STEMS = (4, 5, 6)


def terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words and of the beginnings of longer words, and the text each is from."""
    _, text, _ = word_places(words)
    found, of = [words.hashes], [text]
    size = words.ends - words.starts
    data = np.concatenate([words.data, np.zeros(max(STEMS), np.uint8)])
    for n in STEMS:
        long = np.flatnonzero(size > n)
        packed = np.full(len(long), n, np.uint64)
        for j in range(n):
            byte = ALNUM_LOWER[data[words.starts[long] + j]].astype(np.uint64)
            packed = packed * np.uint64(257) + byte
        found.append(mix(packed ^ np.uint64(0x51ED270B35A2F0C9)))
        of.append(text[long])
    return np.concatenate(found), np.concatenate(of)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights of a ridge logistic model by Newton's steps; the last is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    weights, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (y - p) - penalty * weights
        curvature = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curvature, gradient)
        weights += step
        if np.abs(step).max() < 1e-4:
            break
    return weights


def _probability(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -700, 700)))


def _odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class Chain:
    """``vocabulary`` of sorted term hashes, and a model per category over terms and earlier log odds."""

    vocabulary: np.ndarray
    weights: list[np.ndarray]

    def features(self, hashes: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
        """Which terms of the vocabulary each text has."""
        x = np.zeros((n_texts, len(self.vocabulary)))
        if len(self.vocabulary) and len(hashes):
            at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
            known = self.vocabulary[at] == hashes
            x[text[known], at[known]] = 1
        return x

    def predict(self, x: np.ndarray) -> np.ndarray:
        """A column of probabilities per category."""
        found = []
        for weights in self.weights:
            found.append(_probability(np.column_stack([x, *[_odds(p) for p in found]]), weights))
        return np.column_stack(found)

    @classmethod
    def fit(cls, vocabulary: np.ndarray, x: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> Chain:
        """``x``: a row of features per text; ``labels``: a column per category: 0, 1, or -1 where unknown."""
        chain = cls(vocabulary, [])
        unseen: list[np.ndarray] = []
        for c in range(labels.shape[1]):
            y, known = labels[:, c], labels[:, c] >= 0
            z = np.column_stack([x, *[_odds(p) for p in unseen]])
            p = np.zeros(len(labels))
            for k in np.unique(fold):
                weights = _logistic(z[known & (fold != k)], y[known & (fold != k)])
                p[fold == k] = _probability(z[fold == k], weights)
            unseen.append(p)
            chain.weights.append(_logistic(z[known], y[known]))
        return chain


def vocabulary(rows: DataFrame, names: Sequence[str]) -> np.ndarray:
    """For each category the terms whose share of texts differs most, by chi-squared; sorted.

    ``rows`` has the categories and the distinct ``terms`` of each text. Counting is a grouped
    aggregate; only the chosen terms reach the driver.
    """
    values = [(c, v) for c in names for v in (0, 1)]
    sizes = rows.agg(*[F.count_if(F.col(c) == v).alias(f"{c}_{v}") for c, v in values]).first()
    counted = rows.select(*names, F.explode("terms").alias("term")).groupBy("term")
    counted = landed(counted.agg(*[F.count_if(F.col(c) == v).alias(f"{c}_{v}") for c, v in values]), "terms")
    chosen: set[int] = set()
    for c in names:
        total = F.col(f"{c}_0") + F.col(f"{c}_1")
        share = sizes[f"{c}_1"] / max(sizes[f"{c}_0"] + sizes[f"{c}_1"], 1)
        chi = F.try_divide(F.pow(F.col(f"{c}_1") - total * share, F.lit(2.0)), total * share)
        best = counted.where(total >= LEAST_ROWS_PER_TERM).withColumn("chi", chi).where("chi > 0")
        chosen |= {r["term"] for r in best.orderBy(F.desc("chi"), "term").limit(TERMS_PER_CATEGORY).collect()}
    return np.sort(np.array(sorted(chosen), np.int64).view(np.uint64))


def distinct_terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Each term of a text once."""
    hashes, text = terms(words)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (np.diff(hashes) != 0) | (np.diff(text) != 0)
    return hashes[new], text[new]


def labelled_sample(labels: DataFrame, categories: Sequence[str], most: int) -> DataFrame:
    """At most ``most`` rows ``id, order`` and categories, for each category and value an equal share.

    A row's labels are the largest of its id's. Rows with the smallest hashes of their ids are taken,
    so the sample is the same whatever the layout.
    """
    share = most // (2 * len(categories))
    known = labels.groupBy("id").agg(*[F.max(c).alias(c) for c in categories]).withColumn("order", F.xxhash64("id"))
    parts = [known.where(F.col(c) == v).orderBy("order", "id").limit(share) for c in categories for v in (0, 1)]
    sample = parts[0]
    for part in parts[1:]:
        sample = sample.unionByName(part)
    return sample.distinct()


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Per row of ``docs`` its id and for each category, in chain order, a probability ``p_<category>``.

    ``labels`` has the same id and a column 0 or 1 per category; null and other values are unknown, of
    several rows for an id the largest counts, a null id labels nothing. The models are fitted on a
    sample of at most ``sample_rows`` labelled ids, one row each (the one with the least terms); their texts are found by a broadcast of the sample,
    which that bound bounds, and reduced to a few hundred bits each before they reach the driver. If a category has no rows of some value, its model gives the share there
    is. All texts are scored whole, a null text as an empty one; repeated rows and null ids stay, an
    empty table gives an empty result, other columns are ignored.
    """
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    names = [f"c{i}" for i in range(len(categories))]
    clean = [F.when(F.col(c).isin(0, 1), F.col(c).cast("int")).alias(n) for c, n in zip(categories, names, strict=True)]
    known = labels.where(F.col(id).isNotNull()).select(F.col(id).alias("id"), *clean)
    sample = F.broadcast(labelled_sample(known, names, sample_rows))

    def read(batches):
        for block in blocks(batches, "text"):
            hashes, of = distinct_terms(Words(block.column("text"), ALNUM_LOWER))
            offsets = np.searchsorted(of, np.arange(block.num_rows + 1)).astype(np.int32)
            values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*[block.column(c) for c in ["order", *names]], values], ["order", *names, "terms"])

    columns = ", ".join(f"{c} int" for c in names)
    rows = docs.join(sample, "id").select("order", *names, "text").mapInArrow(read, f"order bigint, {columns}, terms array<bigint>")
    # Of several rows with an id one counts, so the bound of the sample holds for rows, too.
    rows = landed(rows.groupBy("order", *names).agg(F.min("terms").alias("terms")), "sample")
    chain = _fitted(rows, names)
    kind = docs.schema["id"].dataType.simpleString()

    def judge(batches):
        for block in blocks(batches, "text", 1 << 20):
            p = chain.predict(chain.features(*terms(Words(block.column("text"), ALNUM_LOWER)), block.num_rows))
            yield pa.RecordBatch.from_arrays([block.column("id"), *[pa.array(c) for c in p.T.copy()]], ["id", *names])

    scored = docs.mapInArrow(judge, f"id {kind}, " + ", ".join(f"{c} double" for c in names))
    return scored.select(F.col("id").alias(id), *[F.col(n).alias(f"p_{c}") for c, n in zip(categories, names, strict=True)])


def _fitted(rows: DataFrame, names: Sequence[str]) -> Chain:
    """The chain of the sample. Of each row only its terms of the vocabulary reach the driver."""
    chain = Chain(vocabulary(rows, names), [])
    columns = ", ".join(f"{c} int" for c in names)

    def mark(batches):
        for batch in batches:
            lengths = np.diff(batch.column("terms").offsets.to_numpy())
            hashes = batch.column("terms").flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            text = np.repeat(np.arange(len(lengths)), lengths)
            x = chain.features(hashes, text, len(lengths)).astype(bool)
            # Copies of a text are one fold, or the rows not seen would have been seen.
            whole = np.zeros(len(lengths), np.uint64)
            np.add.at(whole, text, mix(hashes))
            bits = [row.tobytes() for row in np.packbits(x, axis=1)]
            fold = (mix(whole) % np.uint64(FOLDS)).astype(np.int32)
            kept = [batch.column(c) for c in ["order", *names]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(fold), pa.array(bits, pa.binary())], ["order", *names, "fold", "bits"])

    table = rows.mapInArrow(mark, f"order bigint, {columns}, fold int, bits binary").toArrow().combine_chunks().sort_by("order")
    packed = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(len(table), -(-len(chain.vocabulary) // 8))
    x = np.unpackbits(packed, axis=1, count=len(chain.vocabulary)).astype(float)
    labels = np.column_stack([table.column(c).fill_null(-1).to_numpy() for c in names])
    return Chain.fit(chain.vocabulary, x, labels, table.column("fold").to_numpy())
