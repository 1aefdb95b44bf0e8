"""Hard negatives by threshold joins over an inverted index, in the manner of L2AP (operator 13).

Rows are dealt to shards of bounded size, and each shard is indexed by dimension: the dimensions with the
most weight first, and of each row only as many as are needed, since those left out, a suffix, have too
small a norm to reach any asked threshold with any asked anchor. Partial scores are accumulated over the
indexed dimensions; what remains of a score is at most the product of the remaining norms, so most pairs
are ruled out, and the others are computed whole. Thresholds start high and are lowered until every
window of an anchor is full or its lower end is reached.

The same search runs twice. The first finds each anchor's best rows of its own label, its positives. A
positive's score sets a window of scores, and the second finds the best rows of other labels in it. A
shard's rows are moved once for each search, and anchors stream through the shards in batches; only the
best few of an anchor and shard move on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stateline.llm.scratch import landed
from stateline.session import shuffle_partitions

#: Rows of a shard, at least (if the table has as many) and at most.
SHARD_ROWS = (1024, 65536)
#: Dimensions accumulated between two looks at the bounds.
STEP = 8
#: Pairs of an anchor and a row whose bounds, or whose products, are held at once.
CELLS = 1 << 21
#: Norms up to this give scores that a long holds.
LARGEST_NORM = 2.0**31
#: How far, from the highest possible score to the lowest asked, thresholds go down in each round.
ROUNDS = (0.25, 0.5, 0.75, 1.0)
#: Relative room for the rounding of bounds.
SLACK = 1e-9


class Rows:
    """Indexed rows: integers in ``x``, one row of it for each of ``ids``."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.weighty = np.argsort(-(x.astype(float) ** 2).sum(0), kind="stable")

    def index(self, reach: float) -> tuple[np.ndarray, np.ndarray, list[tuple[slice, np.ndarray]], np.ndarray]:
        """Postings for thresholds of ``reach`` or more for an anchor of norm 1.

        Gives the order of rows, those with the most indexed dimensions first; how many dimensions each
        has; the postings of ``STEP`` dimensions at a time, over the first rows of the order; and the norm
        of what is left of each row from each dimension on.
        """
        y = self.x[:, self.weighty].astype(float)
        left = np.sqrt(np.cumsum((y**2)[:, ::-1], 1)[:, ::-1]) * (1 + SLACK)
        left = np.column_stack([left, np.zeros(len(y))])
        indexed = (left >= reach).sum(1) if reach > 0 else np.full(len(y), y.shape[1])
        indexed = np.minimum(indexed, y.shape[1])
        order = np.argsort(-indexed, kind="stable")
        y, left, indexed = y[order], left[order], indexed[order]
        y[np.arange(y.shape[1])[None, :] >= indexed[:, None]] = 0
        steps = [slice(at, min(at + STEP, y.shape[1])) for at in range(0, y.shape[1], STEP)]
        return order, indexed, [(s, y[: np.searchsorted(-indexed, -s.start, "left"), s]) for s in steps], left

    def search(self, q: np.ndarray, labels: np.ndarray | None, own: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """For each anchor and window the best ``k`` rows: numbers of anchors, windows and rows, and scores.

        ``q`` has an anchor in each row, ``low`` and ``high`` its windows, both ends within. Rows with an
        anchor's own id, and with its label (where ``labels`` are given), are passed over.
        """
        found = [np.empty(0, np.int64)] * 4
        if not len(q) or not len(self.ids):
            return tuple(found)
        norms = np.sqrt((q.astype(float) ** 2).sum(1))
        asked = np.where(low <= high, low, np.inf).min(1)
        reach = np.where(norms > 0, asked / np.maximum(norms, 1e-300), np.where(asked > 0, np.inf, 0)).min()
        order, indexed, postings, left = self.index(reach * (1 - SLACK) if reach > 0 else reach)
        many = max(1, CELLS // len(self.ids))
        parts = [
            self._search(q[at : at + many], None if labels is None else labels[at : at + many], own[at : at + many],
                         low[at : at + many], high[at : at + many], k, norms[at : at + many], order, indexed, postings, left, at)
            for at in range(0, len(q), many)
        ]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _search(self, q, labels, own, low, high, k, norms, order, indexed, postings, left, first):
        y = q[:, self.weighty].astype(float)
        rest = np.column_stack([np.sqrt(np.cumsum((y**2)[:, ::-1], 1)[:, ::-1]) * (1 + SLACK), np.zeros(len(y))])
        asked = np.where(low <= high, low, np.inf).min(1)
        room = SLACK * norms[:, None] * left[None, :, 0] + 0.5
        partial = np.zeros((len(q), len(order)))
        open_rows = np.arange(len(order))
        for dims, values in postings:
            here = open_rows[open_rows < len(values)]
            partial[:, here] += y[:, dims] @ values[here].T
            bound = partial[:, open_rows] + rest[:, dims.stop, None] * left[None, open_rows, dims.stop] + room[:, open_rows]
            if dims.stop < y.shape[1]:
                out_of_reach = ~(bound >= asked[:, None]).any(0) & (indexed[open_rows] >= dims.stop)
                partial[:, open_rows[out_of_reach]] = -np.inf
                open_rows = open_rows[~out_of_reach]
        bound = partial + rest[:, indexed] * left[np.arange(len(order)), indexed][None, :] + room

        top = np.minimum(bound.max(1), high.max(1))
        lowest = np.where(asked < np.inf, asked, top)
        done = ~(bound >= asked[:, None]).any(1)
        full = low > high
        seen = np.zeros(bound.shape, bool)
        pairs = [np.empty(0, np.int64)] * 3
        for part in ROUNDS:
            at = np.where(part == 1, lowest, top - (np.where(np.isfinite(lowest), top - lowest, np.inf)) * part)
            new = (bound >= at[:, None]) & ~seen & ~done[:, None]
            seen |= new
            pairs = [np.concatenate(c) for c in zip(pairs, self._scored(q, labels, own, order, *np.nonzero(new)), strict=True)]
            anchor, _, score = pairs
            for w in range(low.shape[1]):
                inside = (score >= np.maximum(at, low[:, w])[anchor]) & (score <= high[anchor, w])
                full[:, w] |= (np.bincount(anchor[inside], minlength=len(q)) >= k) | (at <= low[:, w])
            done |= full.all(1)
            if done.all():
                break

        anchor, row, score = pairs
        result = []
        for w in range(low.shape[1]):
            inside = (score >= low[anchor, w]) & (score <= high[anchor, w])
            a, r, s = anchor[inside], row[inside], score[inside]
            best = np.lexsort((self.ids[r], -s, a))
            a, r, s = a[best], r[best], s[best]
            place = np.arange(len(a)) - np.searchsorted(a, a)
            keep = place < k
            result.append((a[keep] + first, np.full(keep.sum(), w), r[keep], s[keep]))
        return tuple(np.concatenate(c) for c in zip(*result, strict=True))

    def _scored(self, q, labels, own, order, anchor, place):
        """Whole scores of pairs, without those that an anchor may not have."""
        row = order[place]
        allowed = self.ids[row] != own[anchor]
        if labels is not None:
            allowed &= self.labels[row] != labels[anchor]
        anchor, row = anchor[allowed], row[allowed]
        many = max(1, CELLS // max(1, q.shape[1]))
        score = [(q[anchor[at : at + many]] * self.x[row[at : at + many]]).sum(1) for at in range(0, len(row), many)]
        return anchor, row, np.concatenate(score) if score else np.empty(0, np.int64)


def _integers(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def positives_in(rows: Rows, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The best ``k`` rows of an anchor's label: numbers of anchors and rows, and scores.

    The ``k``-th best of a few rows is a threshold that the best ``k`` of all of them reach.
    """
    found = [[np.empty(0, np.int64)] * 3]
    for label in np.unique(labels):
        mine, same = np.flatnonzero(labels == label), np.flatnonzero(rows.labels == label)
        if not len(same):
            continue
        part = Rows(rows.ids[same], rows.labels[same], rows.x[same])
        few = slice(0, 8 * k)
        score = q[mine] @ part.x[few].T
        score = np.where(part.ids[few][None, :] == ids[mine][:, None], -np.inf, score)
        low = np.partition(score, -k, 1)[:, -k] if score.shape[1] >= k else np.full(len(mine), -np.inf)
        anchor, _, row, score = part.search(q[mine], None, ids[mine], low[:, None], np.full((len(mine), 1), np.inf), k)
        found.append([mine[anchor], same[row], score])
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _streamed(dim: int, find, names: list[str]):
    """Searches shard by shard: a shard's rows come first, then its anchors, batch by batch."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, rows = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            numbers = table.column("shard").to_numpy()
            for number in np.unique(numbers):
                mine = table.filter(pa.array(numbers == number))
                if number != shard:
                    shard, held, rows = number, [], None
                asks = mine.column("windows").is_valid()
                held.append(mine.filter(pa.compute.invert(asks)))
                anchors = mine.filter(asks)
                if not anchors.num_rows:
                    continue
                if rows is None:
                    all_rows = pa.concat_tables(held)
                    rows = Rows(all_rows["id"].to_numpy(), all_rows["label"].to_numpy(), _integers(all_rows["vector"], dim))
                    held = []
                found = find(rows, anchors)
                yield from pa.table(found, names=names).to_batches()

    return search


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
) -> DataFrame:
    """``anchor_id, positive_id, rank`` (from 1)``, negative_id, positive_score, negative_score``.

    Vectors hold integers; a row's score is its inner product with the anchor. Rows with a higher score
    come first, ties go to the smaller id. An anchor, a row for which ``anchor`` holds, has as positives
    its first other rows of the same label. For each positive the first rows of other labels are returned
    whose score is at least ``least_percent`` hundredths of the positive's and not above it; a positive
    without such rows, as is every one with a negative score, gives none.

    Ids identify rows: of several rows with an id the least (label, then vector) counts. Rows with a null
    id, label or vector, with a null component, or not of the commonest length take no part; ids and labels are
    integers. Vectors so long that scores may not fit a long fail the job. Empty tables give an empty
    result, other columns are ignored.
    """
    spark = vectors.sparkSession
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    components = F.col(vector).cast("array<bigint>")
    rows = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), components.alias("vector"), F.coalesce(anchor, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("vector", lambda x: x.isNotNull()), F.lit(False)))
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "vector", "asks")).alias("row")).select("id", "row.*")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    checked = F.when(norm < LARGEST_NORM, F.col("vector")).otherwise(F.raise_error(F.lit("vectors are too long for scores in a long")))
    shard = F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("deal")
    rows = landed(rows.select("id", "label", checked.alias("vector"), "asks", shard), "vectors")
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    if lengths is None or not lengths["n"]:
        return empty
    dim, n_rows = lengths["n"], lengths["count"]
    rows = rows.where(F.size("vector") == dim)
    least, most = SHARD_ROWS
    shards = -(-n_rows // max(least, min(most, n_rows // shuffle_partitions(spark))))
    dealt = rows.select((F.col("deal") % shards).cast("int").alias("shard"), "id", "label", "vector", F.lit(None).cast("array<bigint>").alias("windows"))

    def searched(anchors: DataFrame, find, schema: str) -> DataFrame:
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
        asking = anchors.select(everywhere, "id", "label", "vector", "windows")
        both = dealt.unionByName(asking).withColumn("_asks", F.col("windows").isNotNull())
        # Twice as many partitions as shards: fewer of them get two shards by chance.
        sorted_ = both.repartition(2 * shards, "shard").sortWithinPartitions("shard", "_asks").drop("_asks")
        return sorted_.mapInArrow(_streamed(dim, find, [f.split()[0] for f in schema.split(", ")]), schema)

    def find_positives(rows: Rows, anchors: pa.Table) -> list:
        ids = anchors["id"].to_numpy()
        a, r, score = positives_in(rows, ids, anchors["label"].to_numpy(), _integers(anchors["vector"], dim), positives)
        return [pa.array(ids[a]), pa.array(rows.ids[r]), pa.array(score.astype(np.int64))]

    asks = rows.where("asks").withColumn("windows", F.array().cast("array<bigint>"))
    found = searched(asks, find_positives, "anchor_id bigint, positive_id bigint, positive_score bigint")
    first = W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = landed(found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives), "positives")

    def find_negatives(rows: Rows, anchors: pa.Table) -> list:
        ids, labels, q = anchors["id"].to_numpy(), anchors["label"].to_numpy(), _integers(anchors["vector"], dim)
        high = np.full((len(ids), positives), -np.inf)
        sizes = anchors["windows"].combine_chunks().value_lengths().to_numpy()
        scores = anchors["windows"].combine_chunks().flatten().to_numpy()
        high[np.arange(positives)[None, :] < sizes[:, None]] = scores
        low = np.where(np.isfinite(high), -((-least_percent * np.nan_to_num(high, neginf=0).astype(np.int64)) // 100), np.inf)
        a, w, r, score = rows.search(q, labels, ids, low, high, negatives)
        return [pa.array(ids[a]), pa.array((w + 1).astype(np.int32)), pa.array(rows.ids[r]), pa.array(score.astype(np.int64))]

    by_place = F.array_sort(F.collect_list(F.struct("place", "positive_score")))["positive_score"]
    windows = found.groupBy(F.col("anchor_id").alias("id")).agg(by_place.alias("windows"))
    asks = rows.where("asks").join(windows, "id")
    near = searched(asks, find_negatives, "anchor_id bigint, place int, negative_id bigint, negative_score bigint")
    best = W.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return near.join(found, ["anchor_id", "place"]).select(*names)
