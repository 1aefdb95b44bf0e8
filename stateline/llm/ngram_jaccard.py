"""Grouped prefix join on word n-grams (operator 2).

A text's set holds the hashes of its distinct n-grams. In one order of all hashes, two sets that are
similar enough share a hash among their first few, their prefixes. Documents with one prefix and size
form a group, prefixes are joined between groups, and what remains is expanded to the members and
verified on whole sets. Any order gives the same links; this one puts the hashes that most documents
share last, so that passages found everywhere stay out of the prefixes.

``ngram_jaccard`` says which documents hang together, not each link. Where many groups share a hash, its
members are therefore compared with a few of them first, and only those still apart with each other.
``ngram_jaccard_links`` gives all links: similar sets are in one component, so each pair of a component
whose sizes allow it is compared, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stateline.llm.components import components
from stateline.llm.scratch import landed
from stateline.llm.substring_dedup import Routed
from stateline.llm.words import SPACED_LOWER, Words, blocks, lists, mix, signed, text_grams

WORDS = 5
#: Two sets link when 100 * intersection >= 75 * union.
PERCENT = 75
#: The hashes that go last in the order: at most this many are broadcast (2 MB), those that most
#: documents share. Which they are influences the work, never a link.
MOST_FREQUENT = 1 << 17
COUNT_BYTES = 8 << 20
#: A hash of more groups than this is first compared through hubs.
FEW = 8
HUBS = 4
#: Ids of at most this many classes are broadcast to find their texts.
MOST_BROADCAST = 200_000
#: Links are looked for between blocks of about so many sets, with so many hashes, columns of a matrix at a time.
BLOCK_SETS, BLOCK_HASHES, COLUMNS = 256, 1 << 17, 2048
#: Words of a short signature of one length for all sets, which rules out most pairs of small sets.
BRIEF = 4


def sets(block: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each text of the block its number and its sorted set of hashes."""
    for i, hashes in text_grams(Words(block.column("text"), SPACED_LOWER), n):
        yield i, np.unique(hashes)


def set_key(hashes: np.ndarray) -> np.uint64:
    """A hash of a set."""
    return mix(np.array([mix(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))]))[0]


def signature(hashes: np.ndarray, bits: int | None = None) -> np.ndarray:
    """A bit for each residue of the hashes, odd counts set, in 64-bit words.

    As many bits as the set is large, or up to twice that. Two sets differ by at least as many hashes
    as their signatures of equal length differ by bits.
    """
    bits = bits or max(64, 1 << (len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def least_difference(x: Column, y: Column) -> Column:
    """At least so many hashes are in one of two sets only; the longer signature is folded onto the shorter."""
    words = F.least(F.size(x), F.size(y))
    differing = F.zip_with(_folded(x, words), _folded(y, words), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(differing, F.lit(0), lambda total, n: total + n)


def _folded(x: Column, words: Column) -> Column:
    def all_at(i: Column) -> Column:
        return F.aggregate(F.sequence(i, F.size(x) - 1, words), F.lit(0).cast("bigint"), lambda done, j: done.bitwiseXOR(F.get(x, j)))

    return F.when(F.size(x) > words, F.transform(F.sequence(F.lit(0), words - 1), all_at)).otherwise(x)


def _likely(sizes: Column, x: Column, y: Column, percent: int) -> Column:
    """Whether signatures leave it open that sets of these sizes together are similar enough.

    With a difference d, 2 * intersection = sizes - d and 2 * union = sizes + d.
    """
    return _allowed(sizes, least_difference(x, y), percent)


def _allowed(sizes: Column, d: Column, percent: int) -> Column:
    return (sizes - d) * 100 >= (sizes + d) * percent


def _briefly(sizes: Column, percent: int) -> Column:
    """The same by the short signatures ``brief`` of ``a`` and ``b``: cheap enough for each pair of a hash."""
    words = [(F.col(f"a.brief{i}"), F.col(f"b.brief{i}")) for i in range(BRIEF)]
    d = F.lit(0)
    for x, y in words:
        d = d + F.bit_count(x.bitwiseXOR(y))
    return _allowed(sizes, d, percent)


class Order:
    """The order of all hashes: most of them by value, then the frequent ones by how many have them."""

    def __init__(self, frequent: np.ndarray):
        self.rank = np.argsort(frequent, kind="stable")
        self.sorted = frequent[self.rank]

    def prefix(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """The first ``length`` of a sorted set."""
        if not len(self.sorted):
            return hashes[:length]
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        frequent = self.sorted[at] == hashes
        rare = hashes[~frequent]
        if len(rare) >= length:
            return rare[:length]
        late = hashes[frequent][np.argsort(self.rank[at[frequent]], kind="stable")]
        return np.concatenate([rare, late[: length - len(rare)]])


def probe_length(size: int, percent: int) -> int:
    """How many first hashes hold one that any similar set has."""
    return size - -(-percent * size // 100) + 1


def frequent_hashes(docs: DataFrame, n: int) -> np.ndarray:
    """The hashes that most documents share, rarest first.

    Hashes are counted in blocks of texts, and those that only one text of a block has are left out
    of its counts: a hash with more documents than there are blocks cannot be missed.
    """

    def count(batches):
        for block in blocks(batches, "text", COUNT_BYTES):
            found = [hashes for _, hashes in sets(block, n)]
            hashes, counts = np.unique(np.concatenate(found), return_counts=True)
            hashes, counts = hashes[counts > 1], counts[counts > 1]
            yield pa.RecordBatch.from_arrays([pa.array(signed(hashes)), pa.array(counts)], ["hash", "n"])

    counted = docs.select("text").mapInArrow(count, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "hash").limit(MOST_FREQUENT)
    table = top.select("hash", "n").toArrow()
    hashes = table.column("hash").to_numpy().astype(np.int64).view(np.uint64)
    return hashes[np.lexsort((hashes, table.column("n").to_numpy()))]


def sketches(docs: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Per row: ``id``, ``size`` of its set, ``cls`` (hash of the set), ``grp`` (of prefix and size), ``prefix``, ``sig``, ``brief``.

    In a block only the first row of a group carries the prefix.
    """
    kind = docs.schema["id"].dataType.simpleString()
    order = docs.sparkSession.sparkContext.broadcast(Order(frequent))

    def sketch(batches):
        for block in blocks(batches, "text"):
            sizes, classes, groups, prefixes, marks, briefs, seen = [], [], [], [], [], [], set()
            for _, hashes in sets(block, n):
                sizes.append(len(hashes))
                classes.append(set_key(hashes))
                marks.append(signature(hashes) if len(hashes) else np.empty(0, np.int64))
                briefs.append(signature(hashes, 64 * BRIEF))
                first = order.value.prefix(hashes, probe_length(len(hashes), percent)) if len(hashes) else hashes
                group = mix(np.array([set_key(first) + np.uint64(len(hashes))]))[0]
                groups.append(group)
                prefixes.append(first if group not in seen else first[:0])
                seen.add(group)
            values = signed(np.concatenate(prefixes)) if prefixes else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("id"),
                    pa.array(np.array(sizes, np.int32)),
                    pa.array(signed(np.array(classes, np.uint64))),
                    pa.array(signed(np.array(groups, np.uint64))),
                    lists(values, np.array([len(p) for p in prefixes])),
                    lists(np.concatenate(marks), np.array([len(m) for m in marks])),
                    lists(np.concatenate(briefs), np.full(len(briefs), BRIEF)),
                ],
                ["id", "size", "cls", "grp", "prefix", "sig", "brief"],
            )

    return docs.mapInArrow(sketch, f"id {kind}, size int, cls bigint, grp bigint, prefix array<bigint>, sig array<bigint>, brief array<bigint>")


def shared_postings(sketched: DataFrame) -> DataFrame:
    """Rows ``hash, grp, size, pos`` of the prefix hashes that two groups or more have, with their place in it."""

    def post(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                hashes = part.column("prefix").flatten().to_numpy().astype(np.int64).view(np.uint64)
                lengths = np.diff(part.column("prefix").offsets.to_numpy())
                size = part.column("size").to_numpy()
                of = np.repeat(np.arange(len(lengths)), lengths)
                place = np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                group = part.column("grp").to_numpy()
                r = Routed(hashes, np.unique(group, return_inverse=True)[1][of])
                of = of[r.order]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(r.key)),
                        pa.array(signed(hashes[r.order]), mask=r.first),
                        pa.array(group[of]),
                        pa.array(size[of]),
                        pa.array(place[r.order].astype(np.int32)),
                        pa.array(r.shared),
                    ],
                    ["key", "hash", "grp", "size", "pos", "known"],
                )

    rows = sketched.where(F.size("prefix") > 0).select("grp", "size", "prefix")
    posted = rows.mapInArrow(post, "key bigint, hash bigint, grp bigint, size int, pos int, known boolean")
    same = W.partitionBy("key")
    posted = posted.withColumns({"least": F.min("grp").over(same), "most": F.max("grp").over(same)})
    posted = posted.where(F.col("known") | (F.col("least") < F.col("most")))
    return posted.select(F.coalesce("hash", "key").alias("hash"), "grp", "size", "pos")


def _sizes(percent: int) -> Column:
    """Whether the sizes of ``a`` and ``b`` allow that they are similar."""
    x, y = F.col("a.size"), F.col("b.size")
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _possible(percent: int) -> Column:
    """Whether the postings ``a`` and ``b`` of a hash can be the first that similar sets have in common."""
    x, y = F.col("a.size"), F.col("b.size")
    # So many hashes sets of these sizes must have in common, so the first is not far from the start.
    common = F.ceil((x + y) * percent / F.lit(100 + percent)).cast("int")
    return _sizes(percent) & (F.col("a.pos") <= x - common) & (F.col("b.pos") <= y - common)


def _band(size: Column, percent: int) -> Column:
    """Similar sets are in one band of sizes or in neighbouring ones."""
    return F.floor(F.log(size) / F.log(F.lit(100 / percent))).cast("int")


def group_pairs(postings: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups to compare first: all of a hash with few groups, else each with its hubs.

    A hub is the group with the smallest of several hashes of its number, among the groups of a hash
    and a band of sizes. ``HUBS`` of them bound the pairs of a posting however many groups share it.
    """
    rows = postings.join(counts, "hash")
    few, many = rows.where(F.col("n") <= FEW), rows.where(F.col("n") > FEW)
    possible = _possible(percent)
    same = (F.col("a.hash") == F.col("b.hash")) & (F.col("a.grp") < F.col("b.grp"))
    small = few.alias("a").join(few.alias("b"), same & possible).select(F.col("a.grp").alias("a"), F.col("b.grp").alias("b"))

    many = many.withColumn("band", _band(F.col("size"), percent))
    chosen = [F.min(F.struct(F.xxhash64("grp", F.lit(k)), "grp", "size", "pos")).alias(f"h{k}") for k in range(HUBS)]
    hubs = many.groupBy("hash", "band").agg(*chosen)
    hubs = hubs.select("hash", "band", F.explode(F.array_distinct(F.array(*[f"h{k}" for k in range(HUBS)]))).alias("hub"))
    hubs = hubs.select("hash", "band", "hub.grp", "hub.size", "hub.pos")
    near = many.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    same = (F.col("a.hash") == F.col("b.hash")) & (F.col("a.band") == F.col("b.band")) & (F.col("a.grp") != F.col("b.grp"))
    # Anything that may link a group to a hub helps, not only the first hash they share.
    large = near.alias("a").join(hubs.alias("b"), same & _sizes(percent))
    large = large.select(F.least("a.grp", "b.grp").alias("a"), F.greatest("a.grp", "b.grp").alias("b"))
    return small.unionByName(large).distinct()


def class_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of classes for pairs of groups, and for groups of several classes.

    Each member is paired with the other group's representative, and with its own.
    """
    heads = members.groupBy("grp").agg(F.min("cls").alias("head"))
    a, b = members.select(F.col("grp").alias("a"), F.col("cls").alias("ca")), members.select(F.col("grp").alias("b"), F.col("cls").alias("cb"))
    ha, hb = heads.select(F.col("grp").alias("a"), F.col("head").alias("ca")), heads.select(F.col("grp").alias("b"), F.col("head").alias("cb"))
    within = members.join(heads, "grp").where(F.col("cls") != F.col("head")).select(F.col("cls").alias("ca"), F.col("head").alias("cb"))
    across = pairs.join(a, "a").join(hb, "b").unionByName(pairs.join(ha, "a").join(b, "b"))
    found = across.select("ca", "cb").unionByName(within)
    return found.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()


def likely(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose signatures do not rule out that the sets are similar enough."""
    a = members.select(F.col("cls").alias("a"), F.col("size").alias("m"), F.col("sig").alias("x"))
    b = members.select(F.col("cls").alias("b"), F.col("size").alias("n"), F.col("sig").alias("y"))
    rows = pairs.join(a, "a").join(b, "b")
    return rows.where(_likely(F.col("m") + F.col("n"), F.col("x"), F.col("y"), percent)).select("a", "b")


def fetched_texts(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """``cls, text`` of the needed classes (``cls, id``), from a document of each.

    Where ids repeat with other texts, a class may get those, too; ``verified`` passes them over.
    """
    same = F.col("d.id").eqNullSafe(F.col("c.id"))
    # Few ids go to the texts; beyond that, texts and ids meet in a shuffle.
    needed = F.broadcast(needed) if needed.count() <= MOST_BROADCAST else needed.hint("merge")
    rows = docs.alias("d").join(needed.alias("c"), same).select("c.cls", "d.text")
    return rows.dropDuplicates(["cls", "text"])


def verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of classes whose whole sets are similar enough.

    Texts are moved, not sets: they are smaller, and the sets of a frequent partner are made once.
    """
    a = texts.select(F.col("cls").alias("a"), F.col("text").alias("x"))
    b = texts.select(F.col("cls").alias("b"), F.col("text").alias("y"))
    rows = pairs.join(a, "a").join(b, "b")

    def set_of(cls: int, text: pa.Array) -> np.ndarray | None:
        """None if the text is not of the class."""
        (_, hashes), = sets(pa.RecordBatch.from_arrays([text], ["text"]), n)
        return hashes if set_key(hashes).astype(np.int64) == cls else None

    def compare(batches):
        last, q = (None, None), None
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                y = batch.column("y").slice(i, 1)
                if last != (b[i], y[0].as_py()):
                    last, q = (b[i], y[0].as_py()), set_of(b[i], y)
                p = set_of(a[i], batch.column("x").slice(i, 1))
                if p is None or q is None:
                    continue
                both = np.concatenate([p, q])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                good[i] = 100 * common >= percent * (len(p) + len(q) - common)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return rows.select("a", "b", "x", "y").mapInArrow(compare, "a bigint, b bigint").distinct()


def open_pairs(postings: DataFrame, counts: DataFrame, members: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The pairs of classes that are still in different components and may be similar, by signature, too."""
    sizes = members.groupBy("grp").agg(F.count(F.lit(1)).alias("classes"))
    rows = postings.join(counts, "hash").join(sizes, "grp")
    partly = rows.groupBy("hash").agg(F.max((F.col("n") > FEW) | (F.col("classes") > 1)).alias("partly")).where("partly").select("hash")
    rows = postings.join(partly, "hash").join(members.select("grp", "cls"), "grp").select("hash", "cls", "size", "pos")
    crowded = sizes.where(F.col("classes") > 1).select("grp")
    alone = members.join(crowded, "grp").select(F.col("grp").alias("hash"), "cls", "size", F.lit(0).alias("pos"))
    rows = rows.unionByName(alone).join(found, F.col("cls") == F.col("vertex"), "left")
    rows = landed(rows.select("hash", "cls", "size", "pos", F.coalesce("component", "cls").alias("component")), "apart")
    # Only rows outside a hash's commonest component look for partners: within it there is nothing to find.
    parts = rows.groupBy("hash", "component").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("hash").agg(F.count(F.lit(1)).alias("parts"), F.max_by("component", "n").alias("main"))
    main = landed(main.where(F.col("parts") > 1).select("hash", "main"), "main")
    rows = rows.join(main, "hash").withColumn("band", _band(F.col("size"), percent))
    # Signatures come last: few rows are left to carry them.
    briefs = [F.col("brief")[i].alias(f"brief{i}") for i in range(BRIEF)]
    rows = landed(rows.join(members.select("cls", "sig", *briefs), "cls"), "open")
    around = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
    seeking = rows.where(F.col("component") != F.col("main")).withColumn("band", around)
    same = (F.col("a.hash") == F.col("b.hash")) & (F.col("a.band") == F.col("b.band")) & (F.col("a.component") != F.col("b.component"))
    sizes = F.col("a.size") + F.col("b.size")
    open_ = _briefly(sizes, percent) & _likely(sizes, F.col("a.sig"), F.col("b.sig"), percent)
    pairs = seeking.alias("a").join(rows.alias("b"), same & _possible(percent) & open_)
    return pairs.select(F.least("a.cls", "b.cls").alias("a"), F.greatest("a.cls", "b.cls").alias("b")).distinct()


class Parts(NamedTuple):
    """Rows of ``sketches``, their classes, and ``vertex, component`` of the classes that link with another."""

    sketched: DataFrame
    members: DataFrame
    found: DataFrame

    def named(self) -> DataFrame:
        """``cls, component_id`` of all classes."""
        labelled = self.members.join(self.found, F.col("cls") == F.col("vertex"), "left")
        labelled = labelled.select("cls", "id", F.coalesce("component", "cls").alias("component"))
        least = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
        return labelled.join(least, "component").select("cls", "component_id")


def parts(docs: DataFrame, n: int, percent: int) -> Parts:
    """What hangs together among the rows ``id, text``."""
    sketched = landed(sketches(docs, n, percent, frequent_hashes(docs, n)), "sketches")
    same = sketched.where(F.col("size") > 0).groupBy("cls", "grp", "size")
    members = landed(same.agg(F.min("id").alias("id"), F.first("sig").alias("sig"), F.first("brief").alias("brief")), "classes")
    postings = landed(shared_postings(sketched), "postings")
    counts = landed(postings.groupBy("hash").agg(F.count(F.lit(1)).alias("n")), "counts")

    def linked(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
        needed = landed(members.join(ends, "cls", "left_semi").select("cls", "id"), "needed")
        return landed(verified(pairs, landed(fetched_texts(docs, needed), "texts"), n, percent), "links")

    pairs = landed(class_pairs(group_pairs(postings, counts, percent), members), "pairs")
    links = linked(landed(likely(pairs, members, percent), "likely"))
    found = components(links)
    more = open_pairs(postings, counts, members, found, percent)
    more = landed(more.join(pairs, ["a", "b"], "left_anti"), "more")
    if not more.isEmpty():
        found = components(links.unionByName(linked(more)))
    return Parts(sketched, members, found)


def _range(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def tiles(vertices: DataFrame, percent: int) -> DataFrame:
    """``cls`` and each ``tile`` it takes part in, on side ``a`` or not: any two classes that may link meet in one tile.

    ``vertices``: ``cls, component, size``. A component's classes are dealt by band of sizes, and within
    a band to blocks; a tile is two blocks of a band or of neighbouring bands. A component that fits
    a block is one tile. How many rows a class becomes is the number of blocks of its bands.
    """
    blocks_ = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("size") / BLOCK_HASHES))
    whole = vertices.groupBy("component").agg(blocks_.alias("whole"))
    rows = vertices.join(whole, "component").withColumn("band", F.when(F.col("whole") > 1, _band(F.col("size"), percent)).otherwise(0))
    dealt = landed(rows.groupBy("component", "band").agg(blocks_.alias("blocks")), "dealt")
    above = dealt.select("component", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    below = dealt.select("component", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    around = dealt.join(above, ["component", "band"], "left").join(below, ["component", "band"], "left").na.fill(0)
    rows = rows.join(around, ["component", "band"]).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    band, block = F.col("band"), F.col("block")

    def tile(band_a: Column, a: Column, band_b: Column, b: Column, first: Column) -> Column:
        return F.struct(band_a.alias("band_a"), a.alias("a"), band_b.alias("band_b"), b.alias("b"), first.alias("first"))

    same = F.transform(_range(F.col("blocks")), lambda j: tile(band, F.least(block, j), band, F.greatest(block, j), block <= j))
    up = F.transform(_range(F.col("above")), lambda j: tile(band, block, band + 1, j, F.lit(True)))
    down = F.transform(_range(F.col("below")), lambda j: tile(band - 1, j, band, block, F.lit(False)))
    return rows.select("cls", "component", F.explode(F.concat(same, up, down)).alias("tile")).select("cls", "component", "tile.*")


def similar(table: pa.Table, percent: int) -> pa.Table:
    """The pairs ``a, b`` of a tile's classes that are similar enough, and ``common``, the hashes they share."""
    table = table.combine_chunks()
    cls, kept = np.unique(table.column("cls").to_numpy(), return_index=True)
    table = table.take(pa.array(kept)).combine_chunks()
    first = table.column("first").to_numpy()
    alone = table.column("a")[0] == table.column("b")[0] and table.column("band_a")[0] == table.column("band_b")[0]
    sets_ = table.column("hashes").chunk(0)
    lengths = np.diff(sets_.offsets.to_numpy())
    of = np.repeat(np.arange(len(cls)), lengths)
    _, column, counts = np.unique(sets_.flatten().to_numpy(), return_inverse=True, return_counts=True)
    shared = counts[column] > 1
    place = (np.cumsum(counts > 1) - 1)[column[shared]]
    order = np.argsort(place, kind="stable")
    place, of = place[order], of[shared][order]
    x, y = (np.arange(len(cls)),) * 2 if alone else (np.flatnonzero(first), np.flatnonzero(~first))
    common = np.zeros((len(x), len(y)))
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        begin, end = np.searchsorted(place, [at, at + COLUMNS])
        has = np.zeros((len(cls), COLUMNS), np.float32)
        has[of[begin:end], place[begin:end] - at] = 1
        common += has[x] @ has[y].T
    good = (common > 0) & (100 * common >= percent * (lengths[x][:, None] + lengths[y][None, :] - common))
    if alone:
        good = np.triu(good, 1)
    i, j = np.nonzero(good)
    a, b = cls[x[i]], cls[y[j]]
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "common": common[i, j].astype(np.int64)})


def all_links(docs: DataFrame, found: Parts, n: int, percent: int) -> DataFrame:
    """``a, b, common``: every two classes that link, once, and how many hashes they share."""
    vertices = found.members.join(found.found, F.col("cls") == F.col("vertex")).select("cls", "component", "size", "id")
    vertices = landed(vertices, "vertices")

    def hashed(batches):
        for block in blocks(batches, "text"):
            wanted, values, kept = block.column("cls").to_numpy(), [np.empty(0, np.uint64)], []
            for i, hashes in sets(block, n):
                if set_key(hashes).astype(np.int64) == wanted[i]:  # where ids repeat, texts of other classes come, too
                    values.append(hashes)
                    kept.append(i)
            held = lists(signed(np.concatenate(values)), np.array([len(v) for v in values[1:]], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(wanted[kept]), held], ["cls", "hashes"])

    texts = landed(fetched_texts(docs, vertices.select("cls", "id")), "texts")
    held = landed(texts.mapInArrow(hashed, "cls bigint, hashes array<bigint>"), "sets")
    rows = tiles(vertices, percent).join(held, "cls")
    found_in = rows.groupBy("component", "band_a", "a", "band_b", "b")
    return found_in.applyInArrow(lambda table: similar(table, percent), "a bigint, b bigint, common bigint")


class Links(NamedTuple):
    """All links.

    ``documents``: per row its id, ``n_shingles``, ``class``, ``n_links`` and ``component_id``. Rows with
    one set are of one class and linked; ``class`` is null for an empty set. ``n_links`` counts the rows
    that a row links with, by its class or another, without itself.
    ``links``: ``a, b, common``, every two classes that link, once, and the size of their intersection.
    """

    documents: DataFrame
    links: DataFrame


def ngram_jaccard_links(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT) -> Links:
    """Every link between rows as ``ngram_jaccard`` defines it; copies are one class, and not expanded into pairs.

    The links between classes are as many as there are: the square of a family where all its texts are similar.
    """
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    found = parts(docs, n, percent)
    links = landed(all_links(docs, found, n, percent), "all_links")
    copies = found.sketched.where(F.col("size") > 0).groupBy("cls").agg(F.count(F.lit(1)).alias("copies"))
    copies = landed(copies, "copies")
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ends.join(copies, F.col("b") == F.col("cls")).groupBy("a").agg(F.sum("copies").alias("others"))
    classes = copies.join(others, F.col("cls") == F.col("a"), "left").join(found.named(), "cls")
    classes = classes.select("cls", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    rows = found.sketched.select("id", F.col("size").cast("bigint").alias("n_shingles"), "cls").join(classes, "cls", "left")
    some = F.col("n_shingles") > 0
    documents = rows.select(
        F.col("id").alias(id),
        "n_shingles",
        F.when(some, F.col("cls")).alias("class"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(some, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )
    return Links(documents, links)


def ngram_jaccard(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Components only. Per row: id, ``n_shingles`` (size of its set) and ``component_id``, the smallest id it hangs together with.

    Texts are lower-cased (A-Z) and split at ASCII white space; a set holds the distinct runs of ``n``
    words, or the whole sequence of fewer. Rows link when 100 * intersection >= ``percent`` * union. A
    null or empty text has an empty set and links with nothing: its component is its own id. Rows
    with one set are linked, whatever their ids; a null id takes part, but names a component only if
    all its ids are null. Repeated rows stay, an empty table gives an empty result, other columns are
    ignored. Sets and n-grams are compared by hashes of 64 bits.
    """
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    found = parts(docs, n, percent)
    result = found.sketched.select("id", F.col("size").cast("bigint").alias("n_shingles"), "cls").join(found.named(), "cls", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return result.select(F.col("id").alias(id), "n_shingles", component.alias("component_id"))
