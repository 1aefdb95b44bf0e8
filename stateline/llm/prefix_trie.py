"""Prefix tries of conversations as double arrays, one for each prefix shard (operator 11).

Conversations become sequences of turn codes (64-bit hashes of role and text), and equal sequences one row
with their number, their smallest id and a digest of their ids. Sequences are dealt to shards by a hash of
their first turns: of one, or of two, four and so on where too many sequences share fewer, so that a first
turn that a third of all conversations share is split, too. A shard numbers its turns densely, packs its
sequences into a trie's BASE and CHECK arrays and walks them for its nodes.

A node at least as deep as its sequences' shard prefix lies in one shard. The upper nodes, above that, are
shared by shards: their parts are summed by the hash of their path, and what hangs below them is added to all
nodes of that path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateline.llm.scratch import landed
from stateline.session import shuffle_partitions

#: Turns of a shard, at least (if there are as many) and about at most, and the part of it that one prefix may fill.
SHARD_TURNS = (1 << 14, 1 << 20)
PREFIX_PART = 4
#: Above this many rows, prefixes and upper nodes are joined by a shuffle; 16 MB of them are broadcast.
MOST_BROADCAST = 1 << 20
#: Free slots looked at, and families tried in them, before children are put behind all others.
SLOTS, FAMILY = 4096, 64
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_sequences(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``id, turns``: each conversation's turns in order as structs ``code, bytes``.

    Turns are ordered by ``turn``, null first; rows with the same one by their code. A null role or text
    counts as empty. Rows with a null id take no part.
    """
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    turns = conversations.where(F.col(id).isNotNull()).select(
        F.col(id).cast("bigint").alias("id"),
        F.struct(F.col(turn).alias("turn"), F.xxhash64(role, text).alias("code"), F.octet_length(text).alias("bytes")).alias("turn"),
    )
    ordered = F.transform(F.array_sort(F.collect_list("turn")), lambda t: F.struct(t["code"].alias("code"), t["bytes"].alias("bytes")))
    return turns.groupBy("id").agg(ordered.alias("turns"))


def _runs(batch: pa.RecordBatch) -> np.ndarray:
    """Where rows of a new sequence start, and the number of rows."""
    a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
    new = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
    return np.concatenate([[0], new, [len(a)]])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with the same sequence as one: the first's, with the ids as text and their number."""
    for batch in batches:
        if batch.num_rows:
            at, ids = _runs(batch), batch.column("id").to_numpy().tolist()
            text = [",".join(map(str, ids[s:e])) for s, e in zip(at[:-1], at[1:], strict=True)]
            first = batch.take(pa.array(at[:-1]))
            yield pa.RecordBatch.from_arrays([*first.columns, pa.array(np.diff(at)), pa.array(text)], [*first.schema.names, "n", "ids"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the same sequence as one: smallest id, number of ids, digest of their text, turns."""

    def closed(rows: pa.RecordBatch, numbers: list[int], digests: list) -> pa.RecordBatch:
        columns = [rows.column("id"), pa.array(numbers), pa.array([d.hexdigest() for d in digests]), rows.column("codes"), rows.column("bytes")]
        return pa.RecordBatch.from_arrays(columns, ["least", "n", "ends", "codes", "bytes"])

    key, held, first, number, digest = None, None, None, 0, None  # the first row of the open sequence is held from batches before
    for batch in batches:
        if not batch.num_rows:
            continue
        at, a, b, ids = _runs(batch).tolist(), *(batch.column(c).to_pylist() for c in ("a", "b", "ids"))
        n, rows, numbers, digests = batch.column("n").to_numpy(), [], [], []
        for s, e in zip(at[:-1], at[1:], strict=True):
            if (a[s], b[s]) == key:
                digest.update(b",")
            else:
                if first is not None:
                    rows.append(first), numbers.append(number), digests.append(digest)
                elif held is not None:
                    yield closed(held, [number], [digest])
                key, held, first, number, digest = (a[s], b[s]), None, s, 0, hashlib.sha256()
            digest.update(",".join(ids[s:e]).encode())
            number += int(n[s:e].sum())
        if rows:
            yield closed(batch.take(pa.array(rows)), numbers, digests)
        if first is not None:
            held, first = batch.slice(first, 1), None
    if held is not None:
        yield closed(held, [number], [digest])


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """``least, n, ends, codes, bytes``: one row for each sequence of turns that rows ``id, turns`` have.

    ``ends`` is the SHA-256 of the ids in ascending order, comma-joined. Ids are sorted by ranges, so that those
    of a sequence with very many are joined to texts by many tasks; one task then reads the texts in order.
    """
    codes, sizes = F.col("turns.code"), F.col("turns.bytes")
    keyed = sequences.select(F.xxhash64(codes).alias("a"), F.xxhash64(F.lit(1), codes).alias("b"), "id", codes.alias("codes"), sizes.alias("bytes"))
    keyed = landed(keyed, "sequences")
    kinds = "a bigint, b bigint, id bigint, codes array<bigint>, bytes array<int>"
    ranged = keyed.repartitionByRange(shuffle_partitions(sequences.sparkSession), "a", "b", "id").sortWithinPartitions("a", "b", "id")
    listed = ranged.mapInArrow(_listed, f"{kinds}, n bigint, ids string")
    together = listed.repartition(shuffle_partitions(sequences.sparkSession), "a", "b").sortWithinPartitions("a", "b", "id")
    return landed(together.mapInArrow(_digested, "least bigint, n bigint, ends string, codes array<bigint>, bytes array<int>"), "distinct")


class DoubleArray:
    """A trie as two arrays: the child of slot s by number c is slot BASE[s] + c, if CHECK of that is s.

    Slot 0 is the root. Numbers start at 1; a base may be negative.
    """

    def __init__(self):
        self.base, self.check, self.used = np.zeros(SLOTS, np.int64), np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, bool)
        self.used[0] = True
        self.low = self.top = 1  # the slots before `low` are taken, those from `top` free

    def _reach(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, 2 * len(self.base)) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            self.used = np.concatenate([self.used, np.zeros(more, bool)])

    def _take(self, slots: np.ndarray) -> np.ndarray:
        self.used[slots] = True
        self.top = max(self.top, int(slots.max()) + 1)
        return slots

    def _free(self, many: int) -> np.ndarray:
        """The first free slots."""
        self._reach(self.top + many)
        free = np.flatnonzero(~self.used[self.low : self.top + many])[:many] + self.low
        self.low = int(free[-1]) + 1
        return self._take(free)

    def _fitting(self, numbers: np.ndarray) -> np.ndarray:
        """Slots for children with these numbers."""
        span = numbers - numbers[0]
        self._reach(self.top + int(span[-1]) + SLOTS)
        if len(numbers) <= FAMILY:
            free = (np.flatnonzero(~self.used[self.low : self.low + SLOTS]) + self.low)[:FAMILY]
            fits = ~self.used[free[:, None] + span[None, :]].any(1)
            if fits.any():
                return self._take(free[fits.argmax()] + span)
        return self._take(self.top + span)

    def add(self, parents: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Slots of all children of some slots, given by parent and, for each parent, by number."""
        starts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        sizes = np.diff(np.append(starts, len(parents)))
        slots = np.empty(len(parents), np.int64)
        for s, size in zip(starts[sizes > 1], sizes[sizes > 1], strict=True):
            slots[s : s + size] = self._fitting(numbers[s : s + size])
        single = starts[sizes == 1]
        if len(single):
            slots[single] = self._free(len(single))
        self._reach(self.top)
        self.base[parents[starts]] = slots[starts] - numbers[starts]
        self.check[slots] = parents
        return slots

    def child(self, slots: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The slots one step down, -1 where there is no such child."""
        found = self.base[slots] + numbers
        inside = (found > 0) & (found < self.top) & (numbers > 0) & (slots >= 0)
        return np.where(inside & (self.check[np.where(inside, found, 0)] == slots), found, -1)


class Trie:
    """Sequences packed into a double array; ``codes`` lie one after the other, ``lengths`` of them for each."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray):
        self.known, which = np.unique(codes, return_inverse=True)
        self.numbers = np.zeros(len(self.known), np.int64)
        self.array, given = DoubleArray(), 0
        self.first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        self.longest_first = np.argsort(-lengths, kind="stable")
        self.longer = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(lengths.max(initial=0)), "right")
        slots = np.zeros(len(lengths), np.int64)
        for depth, many in enumerate(self.longer):
            rows = self.longest_first[:many]
            code = which[self.first[rows] + depth]
            pairs, inverse = np.unique(slots[rows] * (len(self.known) + 1) + code, return_inverse=True)
            parents, code = pairs // (len(self.known) + 1), pairs % (len(self.known) + 1)
            # Turns are numbered as they appear, level by level, so that siblings mostly follow each other.
            new, at = np.unique(np.where(self.numbers[code] == 0, code, -1), return_index=True)
            new = new[np.argsort(at)][new[np.argsort(at)] >= 0]
            self.numbers[new] = np.arange(given + 1, given + 1 + len(new))
            given += len(new)
            order = np.lexsort((self.numbers[code], parents))
            placed = np.empty(len(pairs), np.int64)
            placed[order] = self.array.add(parents[order], self.numbers[code[order]])
            slots[rows] = placed[inverse]

    def walk(self, codes: np.ndarray) -> np.ndarray:
        """The slot that each turn of the packed sequences leads to."""
        number = self.numbers[np.searchsorted(self.known, codes)]
        found, slots = np.empty(len(codes), np.int64), np.zeros(len(self.first), np.int64)
        for depth, many in enumerate(self.longer):
            rows = self.longest_first[:many]
            slots[rows] = self.array.child(slots[rows], number[self.first[rows] + depth])
            found[self.first[rows] + depth] = slots[rows]
        return found

    def find(self, sequence: list[int]) -> int:
        """The slot of a sequence of codes, -1 if it is no node."""
        slot = np.zeros(1, np.int64)
        for code in sequence:
            at = np.searchsorted(self.known, code)
            known = at < len(self.known) and self.known[at] == code
            slot = self.array.child(slot, self.numbers[[at]] if known else np.zeros(1, np.int64))
        return int(slot[0])


def _mixed(key: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The hash of a path from that of its start and its last code."""
    x = (key * np.uint64(0x9E3779B97F4A7C15)) ^ code
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: What a shard says of a node. Upper nodes, those with a path, give parts that are yet to be summed.
NODE = (
    "least bigint, depth bigint, parent bigint, n bigint, children bigint, leaves bigint, saved bigint, ends string, "
    "key bigint, above bigint, size bigint, path array<bigint>"
)
#: The key of the root's path.
ROOT = 1


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def shard_nodes(table: pa.Table) -> pa.Table:
    """The nodes of a shard's sequences ``least, n, ends, codes, bytes, shared``; nodes above ``shared`` are upper ones."""
    codes, lengths = _flat(table["codes"])
    sizes, _ = _flat(table["bytes"])
    least, n, shared = (table[c].to_numpy() for c in ("least", "n", "shared"))
    trie = Trie(codes, lengths)
    walked = trie.walk(codes)
    sequence = np.repeat(np.arange(len(lengths)), lengths)
    depth_of = np.arange(len(codes)) - trie.first[sequence] + 1

    top = trie.array.top
    parent, members, smallest = trie.array.check[:top], np.zeros(top, np.int64), np.full(top, np.iinfo(np.int64).max)
    np.add.at(members, walked, n[sequence])
    np.minimum.at(smallest, walked, least[sequence])
    members[0], smallest[0] = n.sum(), least.min()
    size, depth, code, upper = np.zeros(top, np.int64), np.zeros(top, np.int64), np.zeros(top, np.uint64), np.zeros(top, bool)
    size[walked], depth[walked], code[walked] = sizes, depth_of, codes.view(np.uint64)
    upper[walked], upper[0] = depth_of < shared[sequence], True
    ending = np.full(top, -1)
    ending[np.where(lengths > 0, walked[np.maximum(trie.first + lengths - 1, 0)] if len(walked) else 0, 0)] = np.arange(len(lengths))

    nodes = np.flatnonzero(members > 0)
    nodes = nodes[np.argsort(depth[nodes], kind="stable")]
    levels = np.split(nodes, np.searchsorted(depth[nodes], np.arange(1, depth.max() + 1)))
    key = np.zeros(top, np.uint64)
    key[0] = ROOT
    for level in levels[1:]:
        key[level] = _mixed(key[parent[level]], code[level])
    own = nodes[~upper[nodes]]
    children, leaves = np.zeros(top, np.int64), np.zeros(top, np.int64)
    np.add.at(children, parent[own], 1)
    saved = np.where(upper, 0, (members - 1) * size)
    leaves[own] = children[own] == 0
    for level in reversed(levels[1:]):
        level = level[~upper[level]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])

    paths: dict[int, list[int]] = {}
    signed = key.view(np.int64)
    for node in nodes[upper[nodes]].tolist():
        paths[node] = [*(paths[int(parent[node])] if node else []), int(signed[node])]
    above = np.where(nodes == 0, 0, parent[nodes])
    ends = table["ends"].combine_chunks().take(pa.array(ending[nodes], mask=ending[nodes] < 0))
    columns = [
        smallest[nodes], depth[nodes], pa.array(smallest[above], mask=upper[above]), members[nodes], children[nodes], leaves[nodes],
        saved[nodes], ends, signed[nodes], pa.array(signed[above], mask=(nodes == 0) | ~upper[above]), size[nodes],
        pa.array([paths.get(x) for x in nodes.tolist()], pa.list_(pa.int64())),
    ]
    names = [field.split()[0] for field in NODE.split(", ")]
    return pa.table([c if isinstance(c, pa.Array | pa.ChunkedArray) else pa.array(c, pa.int64()) for c in columns], names=names)


def packed(table: pa.Table) -> pa.Table:
    """A shard's trie as one row: its arrays, and the codes of its turns by number."""
    codes, lengths = _flat(table["codes"])
    trie = Trie(codes, lengths)
    by_number = trie.known[np.argsort(trie.numbers)]
    shard = table["shard"][:1]
    arrays = [pa.array([a.tolist()], pa.list_(pa.int64())) for a in (trie.array.base[: trie.array.top], trie.array.check[: trie.array.top], by_number)]
    return pa.table([shard, *arrays], names=["shard", "base", "check", "codes"])


def _bounded(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= MOST_BROADCAST else rows


def dealt(distinct: DataFrame) -> DataFrame:
    """Sequences with their ``shard`` and ``shared``, the number of first turns that decide about it."""
    weight = F.size("codes") + 1
    facts = distinct.agg(F.sum(weight).alias("turns"), F.max(F.size("codes")).alias("longest")).first()
    least, most = SHARD_TURNS
    per_shard = max(least, min(most, (facts["turns"] or 0) // shuffle_partitions(distinct.sparkSession)))
    shards = -(-(facts["turns"] or 1) // per_shard)
    pieces, pending, shared = [], distinct, 1
    while True:
        prefixed = pending.withColumn("shared", F.lit(shared).cast("bigint")).withColumn("prefix", F.xxhash64(F.lit(shared), F.slice("codes", 1, shared)))
        if shared >= (facts["longest"] or 0):
            break
        heavy = prefixed.groupBy("prefix").agg(F.sum(weight).alias("turns")).where(F.col("turns") > per_shard // PREFIX_PART)
        heavy = landed(heavy.select("prefix"), "heavy")
        if heavy.isEmpty():
            break
        heavy = _bounded(heavy)
        pieces.append(prefixed.join(heavy, "prefix", "left_anti"))
        pending, shared = prefixed.join(heavy, "prefix", "left_semi").select(*distinct.columns), 2 * shared
    whole = prefixed
    for piece in pieces:
        whole = whole.unionByName(piece)
    return whole.withColumn("shard", F.pmod(F.xxhash64("prefix"), F.lit(shards)).cast("int")).drop("prefix")


def double_array_tries(sequences: DataFrame) -> DataFrame:
    """``shard, base, check, codes``: the packed tries themselves. The child of slot s by the turn with the
    code ``codes[c - 1]`` is slot t = ``base[s] + c``, if ``check[t]`` is s; slot 0 is the root."""
    schema = "shard int, base array<bigint>, check array<bigint>, codes array<bigint>"
    return dealt(distinct_sequences(sequences)).groupBy("shard").applyInArrow(packed, schema)


def prefix_nodes(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie of rows ``id, turns`` (see ``turn_sequences``): every distinct sequence of first turns.

    For each node ``conv_id`` (smallest member; members start with the node's turns), ``depth``,
    ``parent_conv_id`` (the parent's ``conv_id``, null for the root), ``n_convs`` (members), ``n_children``,
    ``n_leaves`` (nodes without children in its subtree, itself included), ``saved_tokens`` (over its subtree,
    the bytes of a node's last text for each member but one) and ``ends_sha256`` (of the members that end
    here: their ids, ascending, comma-joined).

    The root is there if there is any row; sequences without turns are its members. Ids are expected once
    each. An empty table gives an empty result. A conversation is one row of 12 bytes a turn, its texts do
    not move on. Turns and paths are compared by 64-bit hashes, whole sequences by two.
    """
    found = dealt(distinct_sequences(sequences)).groupBy("shard").applyInArrow(shard_nodes, NODE)
    found = landed(found, "nodes")
    own, parts = found.where(F.col("path").isNull()), found.where(F.col("path").isNotNull())
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    kept = [F.min(c).alias(c) for c in ("least", "depth", "above", "path")]
    upper = landed(parts.groupBy("key").agg(*sums, *kept, F.max("size").alias("size"), F.max("ends").alias("ends")), "upper")
    below = upper.where(F.col("above").isNotNull()).groupBy(F.col("above").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    upper = upper.join(below, "key", "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0)))
    alone = (F.col("children") == 0).cast("bigint")
    adds = upper.select(F.explode("path").alias("key"), (F.col("leaves") + alone).alias("leaves"), (F.col("saved") + (F.col("n") - 1) * F.col("size")).alias("saved"))
    adds = adds.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    upper = landed(upper.drop("leaves", "saved", "more").join(adds, "key"), "upper")
    parents = _bounded(upper.select(F.col("key").alias("above"), F.col("least").alias("parent")))

    def result(nodes: DataFrame, parent: str = "parent") -> DataFrame:
        long = {"conv_id": "least", "depth": "depth", "parent_conv_id": parent, "n_convs": "n", "n_children": "children", "n_leaves": "leaves", "saved_tokens": "saved"}
        return nodes.select(*[F.col(c).cast("bigint").alias(name) for name, c in long.items()], F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))

    inner = result(own.where(F.col("above").isNull()))
    outer = own.where(F.col("above").isNotNull()).drop("parent").join(parents, "above")
    return inner.unionByName(result(outer)).unionByName(result(upper.join(parents, "above", "left")))


def head_swapped(sequences: DataFrame, family: int, most: int, chosen: Column) -> DataFrame:
    """Sequences whose first ``chosen`` turns (fewer than ``most``) are those of the family's first id, if it exists.

    A family is ``family`` consecutive ids. Shorter heads give what they have; the rest are the sequence's
    own turns behind its first ``chosen``.
    """
    sequences = landed(sequences, "turns")
    heads = sequences.where(F.col("id") % family == 0).select(F.col("id").alias("head_id"), F.slice("turns", 1, most - 1).alias("head"))
    joined = sequences.withColumn("cut", chosen.cast("int")).join(heads, F.col("id") - F.col("id") % family == F.col("head_id"), "left")
    head = F.coalesce(F.slice("head", 1, F.col("cut")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("cut") + 1, F.greatest(F.size("turns") - F.col("cut"), F.lit(0)))
    return joined.select("id", F.concat(head, rest).alias("turns"))
