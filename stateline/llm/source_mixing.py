"""Mixing sources to target weights by pivotal dependent rounding (operator 12).

Each source has a target number of words, and each of its documents the same expected number of copies,
whose whole part is certain. The fractional parts are rounded dependently: two documents meet, one gives
the other words of its expectation, at random but fairly, until one of them is taken whole or not at all,
and the other goes on. Each meeting keeps the words that the two expect together. The one document of a
source that is left at the end is taken if that is nearer to the target, so a source's taken words
differ from its target by at most half a document.

Documents meet in a reduction tree. Rows of a source, longest first, form blocks of 64; each block is
folded into a mask of those taken and the document left over, and these meet in blocks of the next level.
At the top the last document of each source is decided, and decisions go down the tree again. Blocks are
as large for a source with a third of all rows as for any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateline.llm.scratch import landed
from stateline.operators.ids import dense_ids, running_weight
from stateline.session import shuffle_partitions

#: Documents that meet in a block: as many as a mask of a long has bits.
BLOCK = 64


def n_words(text: Column) -> Column:
    """Number of runs of characters other than blanks and the control characters 9 to 13; 0 for null."""
    marked = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("bigint")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _is_set(mask: Column, place: Column) -> Column:
    return mask.bitwiseAND(_bit(place)) != 0


def _uniform(*what: Column | str) -> Column:
    """A number from 0 to below 1, the same whenever the same is asked."""
    return F.shiftrightunsigned(F.xxhash64(*what), 11) * F.lit(2.0**-53)


def _meet(left: Column, item: Column) -> Column:
    """The state after the document left over, ``at, size, mass``, meets one more, ``place, size, mass, chance``.

    ``mass`` is the words expected of a document, between 0 and its size. Without a document left over
    (size and mass 0) nothing can be given, and the item itself goes on.
    """
    up = F.least(left["size"] - left["mass"], item["mass"])
    down = F.least(item["size"] - item["mass"], left["mass"])

    def given(way: Column) -> Column:
        full = F.when(way["up"], way["left"] == left["size"] - left["mass"]).otherwise(way["item"] == item["size"] - item["mass"])
        empty = F.when(way["up"], way["left"] == item["mass"]).otherwise(way["item"] == left["mass"])
        return _let(F.struct(way["up"].alias("up"), F.when(way["up"], way["left"]).otherwise(-way["item"]).alias("gain"), full.alias("full"), empty.alias("empty")), after)

    def after(way: Column) -> Column:
        winner = F.when(way["up"], left["at"]).otherwise(item["place"])
        mask = F.when(way["full"], left["mask"].bitwiseOR(_bit(winner))).otherwise(left["mask"])
        none = way["full"] & way["empty"]
        stays = way["up"] != way["full"]  # the winner goes on unless it is full, then the loser does
        return F.struct(
            mask.alias("mask"),
            F.when(none, -1).when(stays, left["at"]).otherwise(item["place"]).alias("at"),
            F.when(none, 0.0).when(stays, left["size"]).otherwise(item["size"]).alias("size"),
            F.when(none, 0.0).when(stays, left["mass"] + way["gain"]).otherwise(item["mass"] - way["gain"]).alias("mass"),
        )

    return _let(F.struct(up.alias("left"), down.alias("item"), (item["chance"] * (up + down) < down).alias("up")), given)


def _folded(rows: DataFrame, name: str, seed: int, level: int, *facts: str) -> DataFrame:
    """Blocks of rows ``source, at, size, mass``: ``source, block, items, mask, left_at, left_size, left_mass``."""
    rows = rows.withColumn("block", F.floor(F.col("at") / BLOCK)).withColumn("place", (F.col("at") % BLOCK).cast("int"))
    chance = _uniform(F.lit(seed), F.lit(level), "source", "block", "place")
    rest = [c for c in rows.columns if c not in ("source", "at", "block", "place", "size", "mass", *facts)]
    item = F.struct("place", F.col("size").cast("double").alias("size"), "mass", chance.alias("chance"), *rest)
    blocks = rows.groupBy("source", "block", *facts).agg(F.array_sort(F.collect_list(item)).alias("items"))
    none = F.struct(F.lit(0).cast("bigint").alias("mask"), F.lit(-1).alias("at"), F.lit(0.0).alias("size"), F.lit(0.0).alias("mass"))
    blocks = blocks.withColumn("left", F.aggregate("items", none, _meet))
    left = [F.col(f"left.{c}").alias(f"left_{c}") for c in ("at", "size", "mass")]
    return landed(blocks.select("source", "block", *facts, "items", F.col("left.mask").alias("mask"), *left), name)


def targets(sources: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Adds ``number`` and ``target`` to rows ``source, source_size``: one row for each source.

    Sources are numbered by code point, null last, and weigh ``weights`` in turn. ``share`` of all sizes is
    dealt out by weight; a target stops at ``most`` times its source's size and the excess is dealt out
    again. In order of the size for each unit of weight the stopped sources come first, so the level at
    which the others stand follows from sums over the sources before each one.
    """
    numbered = dense_ids(sources.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "number")
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * most
    numbered = numbered.withColumn("_weight", weight).withColumn("_cap", cap).withColumn("_ratio", cap / weight).drop("_null")
    sums = numbered.agg(F.sum("source_size").alias("size"), F.sum("_weight").alias("weight")).first()
    if sums["size"] is None:
        return numbered.select("number", *sources.columns, F.lit(0.0).alias("target"))
    before = running_weight(numbered, ["_ratio", "number"], "_caps", "_cap")
    before = running_weight(before, ["_ratio", "number"], "_weights", "_weight")
    level = (F.lit(share * sums["size"]) - F.col("_caps")) / (F.lit(sums["weight"]) - F.col("_weights"))
    highest = before.agg(F.max(level)).first()[0]
    target = F.least(F.col("_weight") * F.lit(highest), F.col("_cap").cast("double"))
    return numbered.select("number", *sources.columns, target.alias("target"))


def _with_facts(rows: DataFrame, facts: DataFrame, n_rows: int) -> DataFrame:
    """Rows with their source's facts; the rows of large sources, fewer than there are partitions, stay where they are."""
    large = F.col("n") > n_rows // shuffle_partitions(rows.sparkSession)
    hot, cold = F.broadcast(facts.where(large).drop("n")), facts.where(~large).drop("n")

    def joined(rows: DataFrame, facts: DataFrame) -> DataFrame:
        facts = facts.withColumnRenamed("source", "_source")
        return rows.join(facts, F.col("source").eqNullSafe(F.col("_source"))).drop("source", "_source")

    theirs = hot.select(F.col("source").alias("_source"))
    others = rows.join(theirs, F.col("source").eqNullSafe(F.col("_source")), "left_anti")
    return joined(rows, hot).unionByName(joined(others, cold))


def source_mixing(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 0,
) -> DataFrame:
    """``id, size, source_size, target, copies, taken``: how often a mix takes each document.

    ``size`` is a document's number of words, ``source_size`` that of its source, ``target`` the words that
    the mix is to take of the source (see ``targets``), ``copies`` how often the document is taken, ``taken``
    the words of these copies. Copies are the expected number, the same within a source, rounded up or
    down, so never above ``most``; words taken of a source differ from the target by at most half a document.

    Decisions depend on the table's rows and ``seed`` alone, not on their order or partitions; equal rows
    are interchangeable. A null source is a source. Rows with a null id and repeated rows count like others;
    documents without words or text have size 0 and take nothing. An empty table gives an empty result;
    other columns are ignored.
    """
    named = docs.select(F.col(id).alias("id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    sized = landed(named, "sized")
    sources = landed(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), "sources")
    expected = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    facts = targets(sources, weights, share, most).withColumn("whole", F.floor(expected))
    facts = landed(facts.withColumn("part", expected - F.col("whole")).withColumnRenamed("number", "_number"), "targets")

    rows = _with_facts(sized, facts, sized.count()).withColumnRenamed("_number", "source")
    result = [F.col("id").alias(id), F.col("size").cast("bigint").alias("size"), "source_size", "target"]

    def taken(copies: Column) -> list[Column]:
        copies = copies.cast("bigint")
        return [*result, copies.alias("copies"), (copies * F.col("size")).cast("bigint").alias("taken")]

    known = ["source_size", "target", "whole"]
    rounded = (F.col("part") > 0) & (F.col("size") > 0)
    certain = rows.where(~rounded).select(*taken(F.col("whole")))
    longest_first = rows.where(rounded).withColumn("_first", -F.col("size"))
    ranked = running_weight(longest_first, ["source", "_first", "id"], "at", within=["source"])
    ranked = ranked.select("source", "at", "size", (F.col("part") * F.col("size")).alias("mass"), "id", *known)

    levels = [_folded(ranked, "mix-0", seed, 0, *known)]
    while (levels[-1].agg(F.max("block")).first()[0] or 0) > 0:
        left = levels[-1].where(F.col("left_at") >= 0)
        left = left.select("source", F.col("block").alias("at"), F.col("left_size").alias("size"), F.col("left_mass").alias("mass"))
        levels.append(_folded(left, f"mix-{len(levels)}", seed, len(levels)))

    top = levels[-1].where(F.col("left_at") >= 0)
    decided = top.select("source", "block", (F.col("left_mass") * 2 >= F.col("left_size")).alias("decided"))
    for level in reversed(levels[1:]):
        items = level.join(decided, ["source", "block"], "left").select("*", F.explode("items").alias("item"))
        place = F.col("item.place")
        bit = F.when(place == F.col("left_at"), F.col("decided")).otherwise(_is_set(F.col("mask"), place))
        decided = landed(items.select("source", (F.col("block") * BLOCK + place).alias("block"), bit.alias("decided")), "decided")

    items = levels[0].select("source", "block", *known, "mask", "left_at", F.explode("items").alias("item"))
    items = items.select("*", F.col("item.id").alias("id"), F.col("item.size").alias("size"), F.col("item.place").alias("place"))
    settled = items.where(F.col("place") != F.col("left_at")).withColumn("decided", _is_set(F.col("mask"), F.col("place")))
    left = items.where(F.col("place") == F.col("left_at")).join(decided, ["source", "block"])
    rounded_up = F.col("whole") + F.col("decided").cast("int")
    return certain.unionByName(settled.select(*taken(rounded_up))).unionByName(left.select(*taken(rounded_up)))
