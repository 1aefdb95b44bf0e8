"""Best-fit packing planned over a histogram of lengths (operator 4).

Best fit with falling lengths needs no documents, only how many there are of each length: all free
places of one size are alike, so they are kept as runs of sequences and filled by runs. The plan has a
row per run. A document then takes the place its rank within its length gives it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stateline.llm import encoding
from stateline.llm.scratch import landed
from stateline.llm.words import blocks

#: Ranks are given in groups of rows with one length and one hash class of about this many rows.
ROWS_PER_GROUP = 1000
#: A run of ranks joins documents in steps of this many ranks.
RANKS_PER_STEP = 1024

PIECES = "id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"


def piece_starts(n: int, capacity: int) -> list[int]:
    """Where the pieces of ``n`` ids begin: the first may be shorter, all others are full."""
    return [max(0, n - k * capacity) for k in range(-(-n // capacity), 0, -1)]


def token_pieces(docs: DataFrame, id: str, text: str, capacity: int, end: int, tokenizer: str, ranks: str | None) -> DataFrame:
    """The pieces of every row: ``id, piece, start, length, ids_crc32``; ids themselves stay in the task."""
    narrow = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()

    def cut(batches):
        for block in blocks(batches, "text", encoding.BATCH_BYTES):
            rows = []
            for i, ids in enumerate(encoding.ids_of(block.column("text").to_pylist(), tokenizer, ranks)):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                starts = piece_starts(len(ids), capacity)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    rows.append((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            at, piece, start, length, crc = np.array(rows, np.int64).T
            yield pa.RecordBatch.from_arrays(
                [block.column("id").take(pa.array(at)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)],
                ["id", "piece", "start", "length", "ids_crc32"],
            )

    return narrow.mapInArrow(cut, PIECES.format(kind=kind))


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit over falling lengths: rows ``(length, first_rank, count, first_sequence, offset)``.

    Documents of ``length`` with ranks ``first_rank`` up to ``count`` more go to the sequences from
    ``first_sequence`` on, one each, at ``offset``. A document goes where the least room is left that
    holds it; a new sequence is opened only if none does.
    """
    rooms: list[int] = []  # sizes of free room, sorted
    runs: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, count)
    rows, sequences = [], 0

    def free(room: int, first: int, count: int) -> None:
        if room:
            if room not in runs:
                insort(rooms, room)
                runs[room] = []
            runs[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            place = bisect_left(rooms, length)
            if place < len(rooms):
                room = rooms[place]
                first, count = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[place]
            else:
                # Filling one new sequence after another, as best fit does, makes full ones and at most one more.
                room, first = capacity, sequences
                count = -(-left // (capacity // length))
                sequences += count
                per = capacity // length
                full = left // per
                for k in range(per if full else 0):
                    rows.append((length, rank + k * full, full, first, k * length))
                rank += per * full
                if full:
                    free(capacity - per * length, first, full)
                rest = left - per * full
                for k in range(rest):
                    rows.append((length, rank + k, 1, first + full, k * length))
                if rest:
                    free(capacity - rest * length, first + full, 1)
                left = 0
                continue
            take = min(count, left)
            rows.append((length, rank, take, first, capacity - room))
            free(room - length, first, take)
            if take < count:
                free(room, first + take, count - take)
            rank, left = rank + take, left - take
    return rows


def ranked(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Adds ``name``: 0, 1, … among the rows of each ``key``, in no set order.

    Rows are numbered inside hash classes of a key and the classes follow each other, so a frequent
    key is spread over as many tasks as it needs. ``rows`` is read twice.
    """
    most = rows.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    classes = max(1, -(-most // ROWS_PER_GROUP))
    rows = rows.withColumn("_class", F.pmod(F.xxhash64(*order), F.lit(classes)))
    sizes = rows.groupBy(key, "_class").agg(F.count(F.lit(1)).alias("_n"))
    ahead = W.partitionBy(key).orderBy("_class").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(key, "_class", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset"))
    inside = W.partitionBy(key, "_class").orderBy(*order)
    numbered = rows.withColumn("_inside", F.row_number().over(inside) - 1).join(sizes, [key, "_class"])
    return numbered.withColumn(name, F.col("_inside") + F.col("_offset")).drop("_class", "_inside", "_offset")


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    The histogram has at most ``capacity`` entries; only it comes to the driver. Equal rows may take
    each other's places.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    schema = "length bigint, first_rank bigint, count bigint, first_sequence bigint, offset bigint"
    runs = spark.createDataFrame(plan(histogram, capacity), schema)
    last = F.col("first_rank") + F.col("count") - 1
    step = F.lit(RANKS_PER_STEP).cast("bigint")
    steps = F.sequence(F.floor(F.col("first_rank") / step), F.floor(last / step))
    runs = runs.withColumn("_step", F.explode(steps)).withColumnRenamed("length", "_length")

    rows = ranked(pieces, "length", pieces.columns, "_rank").withColumn("_step", F.floor(F.col("_rank") / step))
    inside = (F.col("_rank") >= F.col("first_rank")) & (F.col("_rank") < F.col("first_rank") + F.col("count"))
    joined = rows.join(runs, (rows["length"] == runs["_length"]) & (rows["_step"] == runs["_step"]) & inside)
    sequence = F.col("first_sequence") + F.col("_rank") - F.col("first_rank")
    return joined.select(*pieces.columns, sequence.alias("sequence_id"), "offset")


def best_fit_packing(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end: int = 0,
    tokenizer: str = encoding.TOKENIZER,
    ranks: str | None = encoding.RANKS,
) -> DataFrame:
    """Packs every row's token ids, each document closed by ``end``, into sequences of ``capacity``.

    Returns a row per piece: id, ``piece`` (from 0), ``start`` in its document, ``length``,
    ``ids_crc32`` of its ids, ``sequence_id`` and ``offset``; sequences are filled without gaps. Only
    documents longer than ``capacity`` are cut, and only their first piece may be short. A null or
    empty text is the one id ``end``. Null ids and repeated rows are packed like others; an empty table
    gives an empty result; other columns are ignored.

    Texts are read once: the pieces, a few numbers each, are written to the scratch folder, and the
    histogram, the ranks and the placed rows are made from there.
    """
    pieces = landed(token_pieces(docs, id, text, capacity, end, tokenizer, ranks), "pieces")
    return place(pieces, capacity).withColumnRenamed("id", id)
