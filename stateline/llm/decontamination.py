"""Benchmark decontamination by suffix arrays over shards of the training texts (operator 9).

Each task cuts its texts into shards and sorts the suffixes of a shard, word by word, into a suffix
array. Only suffixes that begin as some test suffix does are put in; the others could never be found.
Every test suffix is then searched in it by bisection, one word after the other, down to the length
that counts; the ranges found are its verbatim matches. Neighbouring matches on one diagonal are one
longer match, so each match is reported once, with its place and full length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateline.llm.words import ALNUM_LOWER, Words, blocks, grams, mix

WINDOW = 13
#: Suffixes are put into the array if they begin with this many words of a test suffix.
GATE = 3
#: Pairs of a place and an item that are looked at together; one item's places at least.
PAIRS = 1 << 20
#: Test items go to the tasks in blocks of about this many bytes of text; each block is one more pass
#: over the texts inside the same task.
TEST_BYTES = 8 << 20


class TestSuffixes:
    """A block of test items: word hashes, the suffixes long enough to count, and their distinct windows."""

    def __init__(self, items: pa.Array, texts: pa.Array, window: int):
        words = Words(texts, ALNUM_LOWER)
        sizes = words.counts()
        self.items, self.hashes = items, words.hashes
        needs = np.minimum(sizes, window)
        item = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(words)) - words.first[:-1][item]
        good = place <= sizes[item] - needs[item]
        self.at = np.flatnonzero(good)  # where a suffix begins in ``hashes``
        self.item, self.place, self.need = item[good], place[good], needs[item][good]
        # Equal windows are searched for once; an item's first place stands for all it has of one.
        whole = np.zeros(len(self.at), np.uint64)
        for n in np.unique(self.need).tolist():
            mine = self.need == n
            whole[mine] = mix(grams(self.hashes, n)[self.at[mine]] + np.uint64(n))
        _, self.distinct, of = np.unique(whole, return_index=True, return_inverse=True)
        order = np.lexsort((self.place, self.item, of))
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(of[order]) != 0) | (np.diff(self.item[order]) != 0)
        self.occurrence = order[first]
        self.occurs = np.searchsorted(of[self.occurrence], np.arange(len(self.distinct) + 1))
        self.gate = int(min(GATE, needs[needs > 0].min())) if len(self.at) else 0
        self.heads = (grams(self.hashes, self.gate)[self.at] if self.gate else np.empty(0, np.uint64))[self.distinct]
        self.known = np.unique(self.heads)
        # A bit for each value of a head's low bits: most places of a text are passed over by one look.
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.known & np.uint64((1 << 20) - 1)).astype(np.int64)] = True


def _bound(column, low, high, keys, right: bool):
    """For each key where it belongs in the sorted ``column[low:high]``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        value = column[np.minimum(middle, len(column) - 1)]
        beyond = open_ & ((value <= keys) if right else (value < keys))
        low = np.where(beyond, middle + 1, low)
        high = np.where(open_ & ~beyond, middle, high)


def shard_matches(words: Words, tests: TestSuffixes, window: int):
    """The matches in a shard: arrays of text (ascending), item, item_start, start and length.

    Each place of a text is matched with an item once, at the first of the item's places that have its window.
    """
    empty = [np.empty(0, np.int64)] * 5
    heads = grams(words.hashes, tests.gate) if tests.gate else np.empty(0, np.uint64)
    maybe = np.flatnonzero(tests.bits[(heads & np.uint64((1 << 20) - 1)).astype(np.int64)])
    near = np.searchsorted(tests.known, heads[maybe])
    maybe = maybe[tests.known[np.minimum(near, len(tests.known) - 1)] == heads[maybe]] if len(maybe) else maybe
    text = np.searchsorted(words.first, maybe, side="right") - 1
    inside = maybe + tests.gate <= words.first[text + 1] if len(maybe) else np.empty(0, bool)
    at, text = maybe[inside], text[inside]
    if not len(at):
        return empty

    # The suffix array: words of each suffix as columns; 0 stands behind the end of a text.
    end = words.first[text + 1]
    columns = [np.where(at + j < end, words.hashes[np.minimum(at + j, len(words) - 1)], 0).astype(np.uint64) for j in range(window)]
    order = np.lexsort(columns[::-1])

    # Windows of test suffixes whose head the shard has; bisection narrows their ranges word by word.
    chosen = np.flatnonzero(np.isin(tests.heads, heads[at]))
    suffix = tests.distinct[chosen]
    low, high = np.zeros(len(chosen), np.int64), np.full(len(chosen), len(order))
    for j in range(window):
        deeper = np.flatnonzero((tests.need[suffix] > j) & (low < high))
        if not len(deeper):
            break
        column, keys = columns[j][order], tests.hashes[tests.at[suffix[deeper]] + j]
        first = _bound(column, low[deeper], high[deeper], keys, right=False)
        high[deeper] = _bound(column, first, high[deeper], keys, right=True)
        low[deeper] = first

    # Places of texts for each item that has a found window, so many at once: an item has one place for each.
    sizes = np.maximum(high - low, 0)
    chosen, low, sizes = chosen[sizes > 0], low[sizes > 0], sizes[sizes > 0]
    times = tests.occurs[chosen + 1] - tests.occurs[chosen]
    of = np.repeat(np.arange(len(chosen)), times)
    occurrence = tests.occurrence[np.repeat(tests.occurs[chosen] - np.cumsum(times) + times, times) + np.arange(times.sum())]
    by_item = np.argsort(tests.item[occurrence], kind="stable")
    of, occurrence = of[by_item], occurrence[by_item]
    starts = at - words.first[text]
    ends = np.flatnonzero(np.append(np.diff(tests.item[occurrence]) != 0, len(of) > 0)) + 1
    total, parts, begin = np.cumsum(sizes[of]), [empty], 0
    while begin < len(of):
        fits = ends[(ends > begin) & (total[ends - 1] - (total[begin - 1] if begin else 0) <= PAIRS)]
        end = int(fits[-1]) if len(fits) else int(ends[ends > begin][0])
        here = slice(begin, end)
        parts.append(_merged(occurrence[here], low[of[here]], sizes[of[here]], order, text, starts, tests))
        begin = end
    found = [np.concatenate(p) for p in zip(*parts, strict=True)]
    by_text = np.argsort(found[0], kind="stable")
    return [p[by_text] for p in found]


def _merged(occurrence, low, sizes, order, text, starts, tests: TestSuffixes):
    """Matches from windows of items and their ranges of the suffix array: neighbours on a diagonal are one."""
    test = np.repeat(occurrence, sizes)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = order[np.repeat(low, sizes) + within]
    start, text = starts[found], text[found]
    item, place, need = tests.item[test], tests.place[test], tests.need[test]
    sort = np.lexsort((start, start - place, item, text))
    text, item, place, start, need = text[sort], item[sort], place[sort], start[sort], need[sort]
    new = np.ones(len(text), bool)
    new[1:] = (np.diff(text) != 0) | (np.diff(item) != 0) | (np.diff(start - place) != 0) | (np.diff(start) != 1)
    begins = np.flatnonzero(new)
    runs = np.diff(begins, append=len(text))
    return [text[begins], item[begins], place[begins], start[begins], runs - 1 + need[begins]]


def _test_blocks(benchmark: DataFrame, item: str, text: str):
    """The benchmark in blocks of bounded size, each as Arrow arrays on the driver."""
    items = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).where(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // TEST_BYTES))
    for k in range(n):
        found = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        block = found.toArrow()
        yield block.column("item").combine_chunks(), block.column("text").combine_chunks()


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    n_words: str = "n_words",
    matches: str = "matches",
) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words`` and ``matches`` added (replacing such columns).

    Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. ``matches``
    has the verbatim matches of ``window`` words or more with an item, and of whole items of fewer words:
    structs of item, item_start, start and length, in words. They are as long as they can be; where a
    window stands more than once in an item, its first place counts, and a match may end there and go on as
    another. Every word inside a window of an item is in a match with it. A null or empty text has no
    words and no matches; items with null or empty text have none either; repeated items count once;
    an empty benchmark matches nothing. Rows are never moved: no shuffle, repeated rows stay.
    """
    spark = docs.sparkSession
    kind = benchmark.schema[item].dataType
    keep = [c for c in docs.columns if c not in (n_words, matches)]
    found = T.ArrayType(T.StructType([T.StructField("item", kind), *[T.StructField(c, T.IntegerType()) for c in ("item_start", "start", "length")]]))
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(n_words, T.LongType()), T.StructField(matches, found)])
    none = F.array().cast(found)
    rows = docs.select(*keep, F.lit(0).cast("bigint").alias(n_words), none.alias(matches))

    for items, texts in _test_blocks(benchmark, item, item_text):
        tests = spark.sparkContext.broadcast(TestSuffixes(items, texts, window))

        def search(batches, tests=tests):
            from pyspark.sql.pandas.types import to_arrow_schema

            target = to_arrow_schema(schema, prefers_large_types=False)
            struct = target.field(matches).type.value_type
            for batch in batches:
                place = batch.schema.get_field_index(text)
                shards = blocks(iter([pa.RecordBatch.from_arrays([batch.column(place)], ["text"])]), "text")
                at = 0
                for shard in shards:
                    rows = batch.slice(at, shard.num_rows)
                    at += shard.num_rows
                    words = Words(shard.column("text"), ALNUM_LOWER)
                    of, number, item_start, start, length = shard_matches(words, tests.value, window)
                    fields = [tests.value.items.take(pa.array(number)).cast(struct.field(0).type), *[pa.array(x.astype(np.int32)) for x in (item_start, start, length)]]
                    values = pa.StructArray.from_arrays(fields, fields=list(struct))
                    offsets = np.searchsorted(of, np.arange(shard.num_rows + 1)).astype(np.int32)
                    now = pa.ListArray.from_arrays(pa.array(offsets), values)
                    before = rows.column(rows.schema.get_field_index(matches))
                    if len(before.flatten()):
                        both = [(x or []) + (y or []) for x, y in zip(before.to_pylist(), now.to_pylist(), strict=True)]
                        now = pa.array(both, target.field(matches).type)
                    columns = [*rows.columns[:-2], pa.array(words.counts()), now.cast(target.field(matches).type)]
                    yield pa.RecordBatch.from_arrays(columns, names=target.names)

        rows = rows.mapInArrow(search, schema)
    return rows


def hit_words(matches: Column) -> Column:
    """The number of words inside any of the matches."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("start"), (m["start"] + m["length"]).alias("end"))))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def add(done, span):
        fresh = F.greatest(span["end"] - F.greatest(span["start"], done["end"]), F.lit(0))
        return F.struct(F.greatest(done["end"], span["end"]).alias("end"), (done["n"] + fresh).alias("n"))

    return F.aggregate(spans, zero, add, lambda done: done["n"])


def contaminated(n_hit: Column, n_words: Column, one_in: int = 20) -> Column:
    """At least one word in ``one_in`` is hit."""
    return (n_hit > 0) & (n_hit * one_in >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", one_in: int = 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns only."""
    n_words, matches = "_n_words", "_matches"
    found = with_matches(docs, benchmark, text, item, item_text, n_words=n_words, matches=matches)
    clean = found.where(~contaminated(hit_words(F.col(matches)), F.col(n_words), one_in))
    return clean.select(*docs.columns)
