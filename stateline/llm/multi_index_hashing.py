"""Approximate nearest neighbours by multi-index hashing (operator 1).

Vectors become binary codes: rotations, learned so that signs keep as much of the vectors as they can, and
the signs under each of them. Codes are split into substrings and each substring is indexed. Two codes that
differ in few bits differ, in some substring, in even fewer (the pigeonhole principle), so a few buckets of
each index hold every code within a Hamming radius. What is found there is ranked by the vectors themselves.

Rows are dealt to shards of bounded size, and move once. A shard is indexed in the memory of one task, and
the queries stream through it in batches; only the best rows of a query and shard move on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stateline.llm.scratch import landed
from stateline.session import shuffle_partitions

#: The rotations and the radius are learned from at most this many vectors, those of the smallest hashes.
SAMPLE_ROWS = 4096
SAMPLE_QUERIES = 512
ROTATION_STEPS = 30
#: Principal axes, and bits of a code: as many rotations of the axes as give these.
MOST_AXES = 64
CODE_BITS = 256
BITS_PER_SUBSTRING = 16
#: The radius holds this share of the true neighbours in the sample.
SHARE_IN_RADIUS = 0.985
#: Buckets to probe are looked up one by one while they hold about this part of a shard; if they hold more
#: of it, all its codes are tested, which finds the same.
PROBED_PART = 0.25
SHARD_ROWS = (1024, 65536)
#: Queries, and pairs of a query and a row, whose distances are held at once.
BLOCK_QUERIES = 16384
CELLS = 1 << 21
#: Farther than any two codes are.
FAR = np.int16(np.iinfo(np.int16).max)


@dataclass
class Codes:
    """How vectors become codes. ``largest`` is the largest norm: longer vectors are nearer by inner
    product, so a coordinate is added that lifts all rows to one length, and queries get 0 there."""

    largest: float
    centre: np.ndarray
    rotations: list[np.ndarray] = field(default_factory=list)
    radius: int = 0

    def _lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        norms = np.linalg.norm(x, axis=1)
        if query:
            return np.column_stack([x / norms[:, None], np.zeros(len(x))])
        rest = np.sqrt(np.maximum(1 - (norms / self.largest) ** 2, 0))
        return np.column_stack([x / self.largest, rest])

    @property
    def bits(self) -> int:
        return sum(r.shape[1] for r in self.rotations)

    def encode(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """For each vector a code, a row of 64-bit words."""
        lifted = self._lifted(x, query) - self.centre
        bits = np.zeros((len(x), -(-max(self.bits, 1) // 64) * 64), np.uint8)
        bits[:, : self.bits] = np.hstack([lifted @ r > 0 for r in self.rotations] or [bits[:, :0]])
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)

    @property
    def substrings(self) -> list[tuple[int, int]]:
        """First bit and number of bits of each; none goes over the end of a word."""
        return [(at, min(BITS_PER_SUBSTRING, self.bits - at)) for at in range(0, self.bits, BITS_PER_SUBSTRING)]

    @classmethod
    def learn(cls, sample: np.ndarray, largest: float, k: int) -> Codes:
        """Principal axes, turned in several ways so that codes and vectors agree best; then the radius of true neighbours."""
        codes = cls(largest, np.zeros(sample.shape[1] + 1))
        lifted = codes._lifted(sample, query=False)
        codes.centre = lifted.mean(0)
        _, _, axes = np.linalg.svd(lifted - codes.centre, full_matrices=False)
        axes = axes[: min(MOST_AXES, sample.shape[1], len(axes))].T
        projected = (lifted - codes.centre) @ axes
        for start in range(-(-CODE_BITS // axes.shape[1])):
            rotation, _ = np.linalg.qr(np.random.default_rng(start).normal(size=(axes.shape[1],) * 2))
            for _ in range(ROTATION_STEPS):
                u, _, v = np.linalg.svd(np.sign(projected @ rotation).T @ projected)
                rotation = v.T @ u.T
            codes.rotations.append(axes @ rotation)

        queries = sample[:SAMPLE_QUERIES]
        scores = queries @ sample.T
        np.fill_diagonal(scores, -np.inf)
        k = min(k, len(sample) - 1)
        if k > 0:
            nearest = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            differ = codes.encode(queries, query=True)[:, None] ^ codes.encode(sample)[nearest]
            codes.radius = int(np.ceil(np.quantile(np.bitwise_count(differ).sum(2, dtype=np.int64), SHARE_IN_RADIUS)))
        return codes


def masks(bits: int, radius: int) -> np.ndarray:
    """All ways to change at most ``radius`` of ``bits`` bits."""
    found = [sum(1 << b for b in chosen) for r in range(min(radius, bits) + 1) for chosen in combinations(range(bits), r)]
    return np.array(found, np.int64)


class Index:
    """The substring indexes of a shard's codes; a code is a 64-bit number or a row of them."""

    def __init__(self, codes: np.ndarray, substrings: list[tuple[int, int]]):
        self.codes, self.substrings, self._tables, self._masks = codes.reshape(len(codes), -1), substrings, {}, {}

    def _table(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows in the order of a substring's buckets, and where each bucket begins."""
        if j not in self._tables:
            at, bits = self.substrings[j]
            value = self._part(self.codes, at, bits)
            order = np.argsort(value, kind="stable")
            self._tables[j] = order, np.searchsorted(value[order], np.arange((1 << bits) + 1))
        return self._tables[j]

    @staticmethod
    def _part(codes: np.ndarray, at: int, bits: int) -> np.ndarray:
        word, shift = divmod(at, 64)
        return ((codes[..., word] >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64)

    def _radii(self, radius: int) -> list[int]:
        """How many bits each substring may differ in, -1 for none of its buckets.

        With m substrings and a radius of m * a + b, one of the first b + 1 differs in at most a bits or
        one of the others in at most a - 1.
        """
        a, b = divmod(radius, len(self.substrings))
        return [a if j <= b else a - 1 for j in range(len(self.substrings))]

    def probed_part(self, radius: int) -> float:
        """The part of random codes that the probed buckets hold, counted in each substring."""
        near = zip(self.substrings, self._radii(radius), strict=True)
        return sum(sum(comb(bits, r) for r in range(min(most, bits) + 1)) / (1 << bits) for (_, bits), most in near)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code differs from ``code`` in at most ``radius`` bits."""
        code = np.asarray(code, np.uint64).reshape(-1)
        hit = np.zeros(len(self.codes), bool)
        for j, near in enumerate(self._radii(radius)):
            if near < 0:
                continue
            at, bits = self.substrings[j]
            if (bits, near) not in self._masks:
                self._masks[bits, near] = masks(bits, near)
            order, first = self._table(j)
            buckets = self._masks[bits, near] ^ self._part(code, at, bits)
            begins, sizes = first[buckets], first[buckets + 1] - first[buckets]
            places = np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            hit[order[places]] = True
        found = np.flatnonzero(hit)
        return found[np.bitwise_count(self.codes[found] ^ code).sum(1, dtype=np.int64) <= radius]

    def distances(self, codes: np.ndarray) -> np.ndarray:
        """Hamming distances of some codes, a row each, to all rows."""
        total = np.zeros((len(codes), len(self.codes)), np.int16)
        for word in range(self.codes.shape[1]):
            total += np.bitwise_count(codes[:, word, None] ^ self.codes[None, :, word])
        return total


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component finite."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Shard:
    """Indexed rows of a shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, codes: Codes):
        self.ids, self.x, self.codes = ids, x, codes
        self.index = Index(codes.encode(x), codes.substrings)
        self.repeats = len(np.unique(ids)) < len(ids)
        self.probing = self.index.probed_part(codes.radius) <= PROBED_PART

    def search(self, ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """The best ``k`` ids found for each query: ids of queries and rows, and scores."""
        many = max(1, min(BLOCK_QUERIES, CELLS // len(self.ids)))
        parts = [self._search(ids[at : at + many], q[at : at + many], k) for at in range(0, len(ids), many)]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _search(self, ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        codes = self.codes.encode(q, query=True)
        if self.probing:
            found = [self.index.within(code, self.codes.radius) for code in codes]
            query, row = np.repeat(np.arange(len(q)), [len(f) for f in found]), np.concatenate(found)
            other = self.ids[row] != ids[query]
            query, row = query[other], row[other]
            thin = np.flatnonzero(self._ids_found(query, row, len(q)) < k)
            kept = ~np.isin(query, thin)
            more = self._nearest_codes(ids[thin], codes[thin], k)
            query, row = np.concatenate([query[kept], thin[more[0]]]), np.concatenate([row[kept], more[1]])
        else:
            query, row = self._nearest_codes(ids, codes, k)
        step = max(1, CELLS // q.shape[1])
        score = [(q[query[at : at + step]] * self.x[row[at : at + step]]).sum(1) for at in range(0, len(row), step)]
        return self._best(ids, query, row, np.concatenate(score) if score else np.empty(0), k)

    def _ids_found(self, query: np.ndarray, row: np.ndarray, queries: int) -> np.ndarray:
        """How many ids are among the rows found for each query."""
        if self.repeats:
            query = np.unique(np.column_stack([query, self.ids[row]]), axis=0)[:, 0]
        return np.bincount(query, minlength=queries)

    def _nearest_codes(self, ids: np.ndarray, codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Queries and rows with codes within the radius, or a wider one where that holds fewer than ``k`` ids."""
        distance = self.index.distances(codes)
        distance[self.ids[None, :] == ids[:, None]] = FAR
        wanted, open_ = min(k, len(self.ids)), np.arange(len(codes))
        queries, rows = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(open_):
            near = distance if len(open_) == len(codes) else distance[open_]
            radius = np.maximum(np.partition(near, wanted - 1, 1)[:, wanted - 1], self.codes.radius)
            query, row = np.nonzero((near <= radius[:, None]) & (near < FAR))
            enough = (self._ids_found(query, row, len(open_)) >= k) | (wanted == len(self.ids)) | (not self.repeats)
            kept = enough[query]
            queries.append(open_[query[kept]]), rows.append(row[kept])
            open_, wanted = open_[~enough], min(4 * wanted, len(self.ids))
        return np.concatenate(queries), np.concatenate(rows)

    def _best(self, ids, query, row, score, k: int) -> tuple[np.ndarray, ...]:
        found = self.ids[row]
        if self.repeats:  # of several rows with an id the best counts
            order = np.lexsort((-score, found, query))
            query, found, score = query[order], found[order], score[order]
            first = np.ones(len(query), bool)
            first[1:] = (query[1:] != query[:-1]) | (found[1:] != found[:-1])
            query, found, score = query[first], found[first], score[first]
        order = np.lexsort((found, -score, query))
        query, found, score = query[order], found[order], score[order]
        best = np.arange(len(query)) - np.searchsorted(query, query) < k
        return ids[query[best]], found[best], score[best]


def streamed(codes: Codes, dim: int, k: int):
    """Searches shard by shard: a shard's rows come first, then its queries, batch by batch."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, shard = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for here in np.unique(batch.column("shard").to_numpy()).tolist():
                mine = table.filter(pc.equal(table["shard"], here))
                if here != number:
                    number, held, shard = here, [], None
                queries = mine.filter(mine["asks"])
                if shard is None:
                    held.append(mine.filter(pc.invert(mine["asks"])))
                    rows = pa.concat_tables(held)
                    if not queries.num_rows or not rows.num_rows:
                        continue
                    shard, held = Shard(rows["id"].to_numpy(), _vectors(rows["vector"], dim), codes), []
                found = shard.search(queries["id"].to_numpy(), _vectors(queries["vector"], dim), k)
                yield from pa.table(list(found), names=["query_id", "vec_id", "score"]).to_batches()

    return search


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 20) -> DataFrame:
    """``query_id, rank`` (from 1)``, vec_id, score``: the ``k`` rows of ``vectors`` found nearest to each query.

    Nearness is the inner product of the original vectors in double precision, ties go to the smaller
    id. Rows with a query's own id are not its neighbours. Vectors that are null, zero, hold a null or
    non-finite component or are not of the commonest length take no part, nor do rows with a null id;
    both ids are integers. Of several query rows with an id the least vector is searched for; of
    several rows with an id the best counts. A query gets fewer rows only if there are fewer. Empty
    tables give an empty result, other columns are ignored.

    Every row is indexed; the rotations and the radius are learned from a bounded sample. No row is
    dropped for being in a crowded bucket.
    """
    spark = vectors.sparkSession
    schema = "query_id bigint, vec_id bigint, score double"
    rows = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(vector).alias("vector")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    ranked = ["query_id", "rank", "vec_id", "score"]
    if length is None:
        return spark.createDataFrame([], schema).withColumn("rank", F.lit(1)).select(*ranked)
    dim = length["n"]
    # Copies of a row say nothing new; those of one id with many vectors are dealt to all shards.
    rows = landed(rows.where(F.size("vector") == dim).distinct(), "vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("largest")).first()
    sample = rows.orderBy(F.xxhash64("id", "vector"), "id").limit(SAMPLE_ROWS).select("vector").toArrow()
    codes = Codes.learn(_vectors(sample.column("vector"), dim), facts["largest"], k)

    least, most = SHARD_ROWS
    shards = -(-facts["n"] // max(least, min(most, facts["n"] // shuffle_partitions(spark))))
    shard = F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int").alias("shard")
    index = rows.select(shard, F.lit(False).alias("asks"), "id", "vector")

    asked = queries.select(F.col(id).cast("bigint").alias("id"), F.col(vector).alias("vector"))
    asked = asked.where(F.col("id").isNotNull() & usable(F.col("vector")) & (F.size("vector") == dim))
    asked = asked.groupBy("id").agg(F.min("vector").alias("vector"))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    both = index.unionByName(asked.select(everywhere, F.lit(True).alias("asks"), "id", "vector"))
    # Twice as many partitions as shards: fewer of them get two shards by chance.
    both = both.repartition(2 * shards, "shard").sortWithinPartitions("shard", "asks")
    found = both.mapInArrow(streamed(codes, dim, k), schema)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(*ranked)
