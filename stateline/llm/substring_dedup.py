"""Substring dedup by difference-cover anchors (operator 10).

Two equal runs of ``window`` words begin anywhere in their documents. Hashes are taken only at places
that are, modulo a period, in a difference cover: for any two places, some shift below the period brings
both to cover places. So two equal runs always share an anchor at the same distance from their starts,
and only about a fifth of all places has one. A place near an anchor that another document has as well
is then extended: the whole windows around it are compared. Exact copies of a text with a smaller id are
settled by a hash of the whole text, and nothing else is compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from stateline.llm.scratch import landed
from stateline.llm.words import SPACED, Words, blocks, grams, lists, mix, pick, signed

WINDOW = 50
#: The differences of these six residues are all residues modulo 31.
COVER = (1, 5, 11, 24, 25, 27)
PERIOD = 31


class Routed:
    """Where the hashes of a block's documents are sent to meet those of other blocks.

    Sorted by hash and id. ``first``: the first row of a hash; ``later``: rows of a larger id than
    that; ``shared``: rows whose hash two ids have. Only ``first`` rows are sent under their hash.
    What the block knows already needs no company and gets a scattered key, so a hash, however
    frequent, gets one row from a block and never meets in one task as a whole.
    """

    def __init__(self, hashes: np.ndarray, ids: np.ndarray):
        self.order = np.lexsort((ids, hashes))
        h, d = hashes[self.order], ids[self.order]
        self.first = np.ones(len(h), bool)
        self.first[1:] = h[1:] != h[:-1]
        begins = np.flatnonzero(self.first)
        group = np.cumsum(self.first) - 1
        self.later = d > d[begins][group]
        self.shared = np.maximum.reduceat(self.later, begins)[group] if len(h) else self.later
        scattered = mix(np.arange(len(h), dtype=np.uint64) ^ mix(h))
        self.key = np.where(self.first, h, scattered)


def id_ranks(ids: pa.Array) -> np.ndarray:
    """Integers in the order of the ids, equal for equal ids."""
    codes = ids.dictionary_encode()
    ranks = pc.rank(codes.dictionary, tiebreaker="dense").to_numpy(zero_copy_only=False)
    return ranks.astype(np.int64)[codes.indices.to_numpy(zero_copy_only=False)]


def word_places(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, and for each word its text and its place in it."""
    n = words.counts()
    text = np.repeat(np.arange(len(n)), n)
    return n, text, np.arange(len(words)) - words.first[:-1][text]


def whole_texts(words: Words) -> np.ndarray:
    """A hash of each text's whole word sequence."""
    n, _, place = word_places(words)
    value = mix(words.hashes ^ mix(place.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D)))
    total, filled = n.astype(np.uint64), np.flatnonzero(n)
    if len(filled):
        total[filled] += np.add.reduceat(value, words.first[:-1][filled])
    return mix(total)


def anchors(docs: DataFrame, window: int) -> DataFrame:
    """Rows ``key, id, pos, known, whole``: the anchors of each text, and each whole text at -1.

    ``known``: the block has seen that the anchor is shared, or that a smaller id has the whole text.
    ``whole`` is the hash of a whole text, null for anchors.
    """
    length = window - PERIOD + 1
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    kind = docs.schema["id"].dataType.simpleString()
    names = ["key", "id", "pos", "known", "whole"]

    def batch(ids, key, text, pos, known, whole):
        whole = pa.nulls(len(key), pa.int64()) if whole is None else pa.array(signed(whole))
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(key)), ids.take(pa.array(text)), pa.array(pos.astype(np.int32)), pa.array(known), whole], names
        )

    def find(batches):
        for block in blocks(batches, "text"):
            ids = block.column("id")
            ranks, words = id_ranks(ids), Words(block.column("text"), SPACED)
            n, text, place = word_places(words)
            at = np.flatnonzero(cover[place % PERIOD] & (place + length <= n[text]) & (n[text] >= window))
            hashes, of = grams(words.hashes, length)[at], text[at]
            r = Routed(hashes, ranks[of])
            yield batch(ids, r.key, of[r.order], place[at][r.order], r.shared | ~r.first, None)

            long = np.flatnonzero(n >= window)
            hashes = whole_texts(words)[long]
            r = Routed(hashes, ranks[long])
            sent = r.first | r.later
            of = long[r.order][sent]
            yield batch(ids, r.key[sent], of, np.full(len(of), -1), r.later[sent], hashes[r.order][sent])

    return docs.where(F.col("id").isNotNull()).mapInArrow(find, f"key bigint, id {kind}, pos int, known boolean, whole bigint")


def candidates(docs: DataFrame, window: int) -> DataFrame:
    """Per id with any: ``places`` of shared anchors, and ``copies``, hashes of texts a smaller id has."""
    same = W.partitionBy("key")
    rows = anchors(docs, window)
    rows = rows.withColumns({"least": F.min("id").over(same), "most": F.max("id").over(same)})
    shared = F.col("known") | F.when(F.col("pos") < 0, F.col("id") > F.col("least")).otherwise(F.col("least") < F.col("most"))
    place = F.when(F.col("pos") >= 0, F.col("pos"))
    return rows.where(shared).groupBy("id").agg(F.collect_list(place).alias("places"), F.collect_list("whole").alias("copies"))


def joined_words(words: Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of each text, joined by single spaces, and where each text begins in them."""
    n, text, _ = word_places(words)
    chosen = np.flatnonzero(kept)
    inside = np.zeros(len(words.data) + 1, np.int8)
    inside[words.starts[chosen]] = 1
    np.add.at(inside, words.ends[chosen], -1)
    mask = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    # Behind each kept word but a text's last comes a byte that parts words; it becomes the space.
    more = chosen[:-1][text[chosen[:-1]] == text[chosen[1:]]] if len(chosen) else chosen
    data = words.data.copy()
    data[words.ends[more]] = 0x20
    mask[words.ends[more]] = True
    sizes = np.zeros(len(n), np.int64)
    np.add.at(sizes, text[chosen], (words.ends - words.starts)[chosen])
    np.add.at(sizes, text[more], 1)
    return data[mask], np.concatenate([[0], np.cumsum(sizes)])


def _texts(data: np.ndarray, offsets: np.ndarray, digest: bool) -> pa.Array:
    if digest:
        raw = data.tobytes()
        return pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def _ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column in one run, and how many each row has."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), sizes


def window_starts(places: np.ndarray, of: np.ndarray, words: Words, window: int) -> np.ndarray:
    """All word numbers of a block at which a window begins that holds one of the anchors at ``places``.

    ``of``: the text of each place. Places beyond a text are passed over: they may stem from another
    row with the same id.
    """
    n = words.counts()
    last = n[of] - window
    low, high = np.maximum(places - PERIOD + 1, 0), np.minimum(places, last)
    good = low <= high
    first = words.first[:-1][of[good]]
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, first + low[good], 1)
    np.add.at(marks, first + high[good] + 1, -1)
    return np.flatnonzero(np.cumsum(marks)[:-1] > 0)


def extended(docs: DataFrame, hits: DataFrame, window: int, digest: bool) -> DataFrame:
    """Rows of ``docs`` with ``n_words``, ``n_removed`` and, where windows must be compared, those.

    ``starts`` and ``windows`` are the places and hashes of the windows around shared anchors. Rows
    without any are done: ``kept`` is their result. Other rows keep their ``text`` instead.
    """
    rows = docs.join(hits, "id", "left").select("rest", "id", "text", "places", "copies")
    schema = T.StructType(
        [
            *rows.select("rest", "id", "text").schema.fields,
            *[T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")],
            T.StructField("kept", T.StringType()),
            T.StructField("starts", T.ArrayType(T.IntegerType())),
            T.StructField("windows", T.ArrayType(T.LongType())),
        ]
    )

    def extend(batches):
        names = [f.name for f in schema.fields]
        for block in blocks(batches, "text"):
            words = Words(block.column("text"), SPACED)
            n, text, _ = word_places(words)
            copies, sizes = _ragged(block.column("copies"))
            of = np.repeat(np.arange(len(n)), sizes)
            copy = np.zeros(len(n), bool)
            copy[of[copies.astype(np.int64).view(np.uint64) == whole_texts(words)[of]]] = True

            places, sizes = _ragged(block.column("places"))
            of = np.repeat(np.arange(len(n)), sizes)
            starts = window_starts(places[~copy[of]].astype(np.int64), of[~copy[of]], words, window)
            windows = grams(words.hashes, window)[starts]
            per_text = np.bincount(text[starts], minlength=len(n))
            open_ = per_text > 0

            data, offsets = joined_words(words, ~copy[text])
            kept = _texts(data, offsets, digest)
            if not digest:
                kept = pick(copy, kept, block.column("text"))
            n_removed = np.where(copy, n, 0)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("rest"),
                    block.column("id"),
                    pick(open_, block.column("text")),
                    pa.array(n),
                    pa.array(n_removed),
                    pick(~open_, kept),
                    lists((starts - words.first[:-1][text[starts]]).astype(np.int32), per_text),
                    lists(signed(windows), per_text),
                ],
                names,
            )

    return rows.mapInArrow(extend, schema)


def removable(rows: DataFrame) -> DataFrame:
    """Per id with any: ``removed``, the hashes of its windows that a smaller id has, too."""
    kind = rows.schema["id"].dataType.simpleString()

    def claim(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = part.column("id")
                hashes, sizes = _ragged(part.column("windows"))
                of = np.repeat(np.arange(len(sizes)), sizes)
                r = Routed(hashes.astype(np.int64).view(np.uint64), id_ranks(ids)[of])
                sent = r.first | r.later
                value = hashes[r.order][sent]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(r.key[sent])),
                        ids.take(pa.array(of[r.order][sent])),
                        pa.array(value, mask=r.first[sent]),
                    ],
                    ["key", "id", "window"],
                )

    claims = rows.select("id", "windows").mapInArrow(claim, f"key bigint, id {kind}, window bigint")
    # A window with a scattered key is one of a larger id in its block; others follow the least id of all.
    least = F.min("id").over(W.partitionBy("key"))
    found = claims.withColumn("least", least).where(F.col("window").isNotNull() | (F.col("id") > F.col("least")))
    return found.groupBy("id").agg(F.collect_list(F.coalesce("window", "key")).alias("removed"))


def finished(rows: DataFrame, removed: DataFrame, window: int, digest: bool) -> DataFrame:
    """``rest, id, n_words, n_removed, kept`` of the rows whose windows were compared."""
    rows = rows.join(removed, "id", "left").select("rest", "id", "text", "starts", "windows", "removed")
    schema = T.StructType(
        [
            *rows.select("rest", "id").schema.fields,
            *[T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")],
            T.StructField("kept", T.StringType()),
        ]
    )

    def finish(batches):
        for block in blocks(batches, "text"):
            words = Words(block.column("text"), SPACED)
            n, text, _ = word_places(words)
            marks = np.zeros(len(words) + 1, np.int64)
            for i in np.flatnonzero(pc.is_valid(block.column("removed")).to_numpy(zero_copy_only=False)):
                gone = np.isin(block.column("windows")[i].values.to_numpy(), block.column("removed")[i].values.to_numpy())
                starts = words.first[i] + block.column("starts")[i].values.to_numpy()[gone]
                np.add.at(marks, starts, 1)
                np.add.at(marks, starts + window, -1)
            kept = np.cumsum(marks)[:-1] == 0
            n_removed = np.bincount(text[~kept], minlength=len(n))
            result = _texts(*joined_words(words, kept), digest)
            if not digest:
                result = pick(n_removed > 0, result, block.column("text"))
            yield pa.RecordBatch.from_arrays(
                [block.column("rest"), block.column("id"), pa.array(n), pa.array(n_removed), result], [f.name for f in schema.fields]
            )

    return rows.mapInArrow(finish, schema)


def substring_dedup(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    digest: bool = False,
    n_words: str = "n_words",
    n_removed: str = "n_removed",
) -> DataFrame:
    """Removes each word inside a run of ``window`` words that also begins in a row with a smaller id.

    Words are runs of anything but ASCII white space; runs are judged on the input. Returns every row
    with its own columns, ``n_words`` and ``n_removed`` (replacing such columns). ``text`` holds the
    kept words joined by single spaces where any was removed, else the text as it was; with ``digest``
    it holds the SHA-256 of all kept words so joined, and no text is carried along. A null or empty text
    has no words (its ``text`` becomes '' or the digest of ''). A row with a null id is neither smaller
    nor larger than another and stays whole; rows with equal ids do not affect each other. Repeated rows
    stay, an empty table gives an empty result. ``window`` must be above the period of the cover.

    Texts move once, to meet the places of their shared anchors; what must be compared is written to
    the scratch folder and compared by hash.
    """
    if window <= PERIOD:
        raise ValueError(f"window must be above {PERIOD}")
    others = [c for c in docs.columns if c not in (id, text, n_words, n_removed)]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("boolean").alias("none"))
    rows = docs.select(rest.alias("rest"), F.col(id).alias("id"), F.col(text).alias("text"))
    hits = candidates(rows.select("id", "text"), window)

    found = landed(extended(rows, hits, window, digest), "windows")
    open_ = found.where(F.col("kept").isNull())
    done = found.where(F.col("kept").isNotNull()).select("rest", "id", "n_words", "n_removed", "kept")
    result = done.unionByName(finished(open_, removable(open_), window, digest))
    columns = [F.col("id").alias(c) if c == id else F.col("kept").alias(c) if c == text else F.col(f"rest.{c}").alias(c) for c in docs.columns if c not in (n_words, n_removed)]
    return result.select(*columns, F.col("n_words").alias(n_words), F.col("n_removed").alias(n_removed))
