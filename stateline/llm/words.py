"""Words, word hashes and n-gram hashes of Arrow text batches, inside tasks.

A text is read as UTF-8 bytes. Which bytes part words, and which letters fold, is a 256-entry table,
so every pass is a numpy pass over bytes. Hashes have 64 bits; two different words or n-grams count
as equal only if those agree, which is expected less than once in 10^19 comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
#: For passes that keep many numbers for each byte.
SMALL_BLOCK_BYTES = 1 << 20
CHUNK_BYTES = 1 << 20
ASCII_SPACE = (0x20, *range(0x09, 0x0E))


def byte_table(separators, lower: bool) -> np.ndarray:
    """For each byte 0 if it parts words, else the (folded) byte plus one."""
    table = np.arange(1, 257, dtype=np.uint16)
    if lower:
        table[0x41:0x5B] += 32
    table[list(separators)] = 0
    return table


#: Words are runs of anything but ASCII white space.
SPACED = byte_table(ASCII_SPACE, lower=False)
SPACED_LOWER = byte_table(ASCII_SPACE, lower=True)
#: Words are runs of ASCII letters, digits and anything beyond ASCII.
ALNUM_LOWER = byte_table([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)], lower=True)
# Lower-casing comes before splitting: capital letters are letters.
ALNUM_LOWER[0x41:0x5B] = np.arange(0x62, 0x7C)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit integers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = stream(257, 11)
_BYTE[0] = 0
_PLACE = stream(256, 23) | np.uint64(1)


def _places(n: int) -> np.ndarray:
    """Factors of the first ``n`` places in a word."""
    return _PLACE if n <= len(_PLACE) else stream(n, 23) | np.uint64(1)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array in one run, without copying, and where each text begins and ends."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts) or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose ``column`` holds at most ``most`` bytes, or one row; nulls become ''."""
    most = most or BLOCK_BYTES
    for batch in batches:
        place = batch.schema.get_field_index(column)
        texts = batch.column(place)
        if texts.null_count:
            texts = texts.fill_null("")
            batch = batch.set_column(place, column, texts)
        ends = bytes_of(texts)[1][1:]
        at = 0
        while at < len(ends):
            upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
            upto = max(upto, at + 1)
            yield batch.slice(at, upto - at)
            at = upto


class Words:
    """Words of a run of texts: ``hashes``, byte ``starts`` and ``ends``, and ``first`` word of each text."""

    def __init__(self, texts: pa.Array, table: np.ndarray):
        self.data, offsets = bytes_of(texts)
        n, parts, begin = len(self.data), [], 0
        # Chunks end at a separator or between texts, so that temporary arrays stay small.
        while begin < n:
            end = begin + CHUNK_BYTES
            if end < n:
                parting = np.flatnonzero(table[self.data[begin:end]] == 0)
                text_end = offsets[np.searchsorted(offsets, end, side="right") - 1]
                last = begin + int(parting[-1]) if len(parting) else begin
                end = max(last, int(text_end))
                while end <= begin:  # one word longer than a chunk
                    end = self._next_parting(table, offsets, begin)
            end = min(end, n)
            parts.append(self._chunk(table, offsets, begin, end))
            begin = end
        joined = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.empty(0, np.int64)] * 2 + [np.empty(0, np.uint64)]
        self.starts, self.ends, self.hashes = joined
        self.first = np.searchsorted(self.starts, offsets)

    def _next_parting(self, table, offsets, begin: int) -> int:
        end = int(offsets[np.searchsorted(offsets, begin, side="right")])
        for at in range(begin + 1, end, CHUNK_BYTES):
            found = np.flatnonzero(table[self.data[at : min(end, at + CHUNK_BYTES)]] == 0)
            if len(found):
                return at + int(found[0])
        return end

    def _chunk(self, table, offsets, begin: int, end: int):
        code = table[self.data[begin:end]]
        inside = code != 0
        cut = offsets[np.searchsorted(offsets, begin, side="right") : np.searchsorted(offsets, end)] - begin
        fresh = np.empty(len(code), bool)
        fresh[0], fresh[1:] = True, ~inside[:-1]
        fresh[cut] = True
        starts = np.flatnonzero(inside & fresh)
        if not len(starts):
            return starts, starts, np.empty(0, np.uint64)
        last = np.empty(len(code), bool)
        last[-1], last[:-1] = True, ~inside[1:]
        last[cut[cut > 0] - 1] = True
        ends = np.flatnonzero(inside & last) + 1
        place = np.arange(starts[0], len(code)) - np.repeat(starts, np.diff(starts, append=len(code)))
        inside_bytes = inside[starts[0] :]
        place = np.where(inside_bytes, place, 0)
        value = _BYTE[code[starts[0] :]] * _places(int((ends - starts).max()))[place]
        hashes = np.add.reduceat(value, starts - starts[0])
        return starts + begin, ends + begin, mix(hashes)

    def __len__(self):
        return len(self.hashes)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9FB21C651E98DF25) + b * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0xA0761D6478BD642F))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of the ``n`` words from each place on; texts are not minded, the last n - 1 places drop out."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    size, whole, power, powers = 1, None, hashes, 0
    while True:
        if n & size:
            whole, powers = (power, size) if whole is None else _tail(whole, powers, power, size)
        if size * 2 > n:
            return whole[: len(hashes) - n + 1]
        power = _joined(power[:-size], power[size:])
        size *= 2


def _tail(whole, length: int, power, size: int):
    # ``power`` covers the first ``size`` words, ``whole`` the ``length`` words behind them.
    n = min(len(power), len(whole) - size)
    return _joined(power[:n], whole[size : size + n]), length + size


def text_grams(words: Words, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each text its number and the hashes of its ``n``-grams; fewer words make one, none make none."""
    all_grams = grams(words.hashes, n)
    for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
        if b - a >= n:
            yield i, all_grams[a : b - n + 1]
        elif b > a:
            yield i, grams(words.hashes[a:b], int(b - a))
        else:
            yield i, np.empty(0, np.uint64)


def signed(hashes: np.ndarray) -> np.ndarray:
    """As Spark's longs."""
    return hashes.view(np.int64)


def lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """An Arrow list array of runs of ``values``."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, pa.array(values))


def pick(chosen: np.ndarray, yes: pa.Array, no: pa.Array | None = None) -> pa.Array:
    """``yes`` where chosen, else ``no``, or null without it; either may be a slice."""
    at = np.arange(len(chosen))
    if no is None:
        return yes.take(pa.array(at, mask=~chosen))
    return pa.concat_arrays([yes, no]).take(pa.array(np.where(chosen, at, at + len(chosen))))
