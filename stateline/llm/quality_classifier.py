"""Quality by regularised quadratic discriminant analysis (operator 6).

A text becomes a few transformed statistics. Class means and covariances come from sums that Spark adds
over all labelled rows; covariances are shrunk and factored once. A score is the difference of two
log densities, each a Mahalanobis distance by a cached Cholesky factor.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateline.llm.scratch import landed
from stateline.llm.substring_dedup import word_places
from stateline.llm.words import SMALL_BLOCK_BYTES, SPACED_LOWER, Words, blocks, byte_table, grams, mix

FEATURES = (
    "log_bytes",
    "log_words",
    "word_length",
    "word_length_spread",
    "capitals",
    "digits",
    "punctuation",
    "beyond_ascii",
    "distinct_words",
    "distinct_pairs",
    "commonest_word",
    "word_again",
    "word_ends_in_mark",
    "mark_after_mark",
    "log_line_words",
    "lines_again",
    "short_words",
)
#: Share of the pooled variances in each class covariance.
SHRINKAGE = 0.3
FOLDS = 5

#: Lines are read as words are, parted by line feeds only.
LINES = byte_table([0x0A], lower=False)

_CAPITAL, _DIGIT, _MARK, _BEYOND, _LETTER = 1, 2, 3, 4, 5
_KINDS = np.zeros(256, np.uint8)
_KINDS[0x21:0x7F] = _MARK
_KINDS[0x30:0x3A] = _DIGIT
_KINDS[0x41:0x5B] = _CAPITAL
_KINDS[0x61:0x7B] = _LETTER
_KINDS[0x80:] = _BEYOND


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """A smoothed share on the log-odds scale: near normal, and finite at 0 and 1."""
    return np.log((part + 0.5) / (whole - part + 0.5))


def _repeats(hashes: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of distinct hashes and the count of its commonest."""
    key = hashes ^ mix(text.astype(np.uint64))
    order = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = np.diff(key[order]) != 0
    begins = np.flatnonzero(new)
    of, counts = text[order[begins]], np.diff(begins, append=len(key))
    most = np.zeros(n_texts, np.int64)
    np.maximum.at(most, of, counts)
    return np.bincount(of, minlength=n_texts), most


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each text; an empty text has those of no bytes, words and lines."""
    words = Words(texts, SPACED_LOWER)
    n, text, _ = word_places(words)
    t = len(n)
    data, size = words.data, words.ends - words.starts
    offsets = np.zeros(t + 1, np.int64)
    offsets[1:] = np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False))
    kinds = _KINDS[data]
    sums = []
    for kind in (_CAPITAL, _DIGIT, _MARK, _BEYOND, _LETTER):
        upto = np.concatenate([[0], np.cumsum(kinds == kind)])
        sums.append(upto[offsets[1:]] - upto[offsets[:-1]])
    capitals, digits, marks, beyond, letters = sums
    n_bytes = np.diff(offsets)

    total, squares = np.bincount(text, size, t), np.bincount(text, size.astype(float) ** 2, t)
    mean = total / np.maximum(n, 1)
    spread = np.sqrt(np.maximum(squares / np.maximum(n, 1) - mean**2, 0))
    distinct, most = _repeats(words.hashes, text, t)
    pair_text = text[:-1][text[:-1] == text[1:]]
    pair_hash = grams(words.hashes, 2)[text[:-1] == text[1:]]
    pairs = np.maximum(n - 1, 0)
    distinct_pairs, _ = _repeats(pair_hash, pair_text, t)
    again = np.bincount(text[1:][(text[1:] == text[:-1]) & (words.hashes[1:] == words.hashes[:-1])], minlength=t)
    last = kinds[words.ends - 1] == _MARK if len(words) else np.empty(0, bool)
    before = (kinds[np.maximum(words.ends - 2, 0)] == _MARK) & (size > 1) if len(words) else last
    ends, doubled = np.bincount(text[last], minlength=t), np.bincount(text[last & before], minlength=t)
    short = np.bincount(text[size <= 2], minlength=t)
    lines = Words(texts, LINES)
    n_lines, line_text, _ = word_places(lines)
    distinct_lines, _ = _repeats(lines.hashes, line_text, t)
    return np.column_stack(
        [
            np.log1p(n_bytes),
            np.log1p(n),
            np.log1p(mean),
            np.log1p(spread),
            _share(capitals, capitals + letters),
            _share(digits, n_bytes),
            _share(marks, n_bytes),
            _share(beyond, n_bytes),
            _share(distinct, n),
            _share(distinct_pairs, pairs),
            _share(most, n),
            _share(again, pairs),
            _share(ends, n),
            _share(doubled, n),
            np.log1p(n / np.maximum(n_lines, 1)),
            _share(n_lines - distinct_lines, n_lines),
            _share(short, n),
        ]
    )


def statistics_table(docs: DataFrame) -> DataFrame:
    """``id, x``: the statistics of every text, in one pass."""
    kind = docs.schema["id"].dataType.simpleString()

    def measure(batches):
        for block in blocks(batches, "text", SMALL_BLOCK_BYTES):
            x = statistics(block.column("text"))
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([block.column("id"), values], ["id", "x"])

    return docs.mapInArrow(measure, f"id {kind}, x array<double>")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def class_sums(rows: DataFrame, label: str, width: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """For each label 0 and 1 its rows, the sum of their ``x`` and the sum of its products.

    Tasks add up their rows, Spark adds up the tasks; a few hundred numbers reach the driver.
    """

    def add(batches):
        for batch in batches:
            x, y = _matrix(batch.column("x"), width), batch.column(label).to_numpy()
            for value in np.unique(y):
                own = x[y == value]
                sums = np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sums), value, np.int32)), pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)],
                    ["label", "place", "value"],
                )

    sums = rows.select("x", F.col(label).cast("int").alias(label)).mapInArrow(add, "label int, place int, value double")
    found = sums.groupBy("label", "place").agg(F.sum("value").alias("value")).toArrow()
    result = {}
    for value in (0, 1):
        own = found.filter(pa.compute.equal(found.column("label"), value)).sort_by("place").column("value").to_numpy()
        if len(own):
            result[value] = (own[0], own[1 : 1 + width], own[1 + width :].reshape(width, width))
    return result


@dataclass
class Discriminant:
    """Two normal densities. ``factors`` are inverse Cholesky factors of the shrunk covariances."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]
    constant_score: float | None = None

    @classmethod
    def fit(cls, sums: dict[int, tuple[float, np.ndarray, np.ndarray]], width: int, shrinkage: float) -> Discriminant:
        """Covariances keep 1 - ``shrinkage`` of themselves; the rest is the pooled variance of each statistic.

        Without rows of both classes every score is the smoothed share of label 1.
        """
        if len(sums) < 2:
            n0, n1 = (sums[c][0] if c in sums else 0 for c in (0, 1))
            return cls(np.zeros(width), np.ones(width), [], [], [], (n1 + 1) / (n0 + n1 + 2))
        n = sum(s[0] for s in sums.values())
        means = [sums[c][1] / sums[c][0] for c in (0, 1)]
        scatter = [sums[c][2] - np.outer(sums[c][1], sums[c][1]) / sums[c][0] for c in (0, 1)]
        centre = (sums[0][1] + sums[1][1]) / n
        scale = np.sqrt(np.maximum(np.diag(scatter[0] + scatter[1]) / n, 1e-9))
        factors, constants = [], []
        for c in (0, 1):
            own = scatter[c] / sums[c][0] / np.outer(scale, scale)
            lower = np.linalg.cholesky((1 - shrinkage) * own + shrinkage * np.eye(width))
            factors.append(np.linalg.inv(lower))
            constants.append(np.log(sums[c][0] / n) - np.log(np.diag(lower)).sum())
        return cls(centre, scale, [(m - centre) / scale for m in means], factors, constants)

    def score(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1, higher where label 1 is likelier: the log-density difference per statistic, squashed."""
        if self.constant_score is not None:
            return np.full(len(x), self.constant_score)
        z = (x - self.centre) / self.scale
        logs = [k - 0.5 * (((z - m) @ f.T) ** 2).sum(1) for m, f, k in zip(self.means, self.factors, self.constants, strict=True)]
        difference = (logs[1] - logs[0]) / x.shape[1]
        return 1 / (1 + np.exp(-np.clip(difference, -700, 700)))


def held_out(id: Column, folds: int = FOLDS) -> Column:
    """Whether the CRC-32 of the id as text is a multiple of ``folds``; false for a null id."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def quality_classifier(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    folds: int = FOLDS,
    shrinkage: float = SHRINKAGE,
    threshold: float = 0.3,
) -> DataFrame:
    """Per row of ``docs`` its id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (score >= ``threshold``).

    ``labels`` has the same id and ``label`` 0 or 1. Rows whose id's CRC-32 is a multiple of ``folds`` are
    held out: their labels are never read. All other labelled rows are learned from, a row with two
    labels by both; null and other labels are none. Scores see the text only. A null text counts as
    empty and is scored like any other; a null id is scored, never labelled or held out. Repeated rows
    stay, an empty table gives an empty result, other columns are ignored.

    Texts are read once; a few numbers per row are written to the scratch folder, joined with the labels,
    and scored from there.
    """
    width = len(FEATURES)
    table = landed(statistics_table(docs.select(F.col(id).alias("id"), F.col(text).alias("text"))), "statistics")
    known = labels.select(F.col(id).alias("id"), F.col(label).alias("label")).where(F.col("label").isin(0, 1) & ~held_out(F.col("id"), folds))
    model = Discriminant.fit(class_sums(table.join(known, "id"), "label", width), width, shrinkage)
    kind = table.schema["id"].dataType.simpleString()

    def judge(batches):
        for batch in batches:
            score = model.score(_matrix(batch.column("x"), width))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score)], ["id", "score"])

    scored = table.mapInArrow(judge, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id), held_out(F.col("id"), folds).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
