"""Token counts and packed ids against the tokenizer library."""

import random
import zlib

import numpy as np
import pytest

from stateline.llm import best_fit_packing as packing
from stateline.llm import encoding
from stateline.llm.best_fit_packing import best_fit_packing, piece_starts, plan
from stateline.llm.token_counts import token_counts

LATIN = [chr(c) for c in (9, 10, 13, *range(32, 127), *range(0xA1, 0xAD), *range(0xAE, 0x250))]
ODD = [chr(c) for c in (0, 0x1C, 0x85, 0xA0, 0xAD, 0x2028, 0x3000, 0x180E, 0x661, 0x4E00, 0x1F600)]
TEXTS = [None, "", " ", "one", "one", "<|endoftext|> a<|endoftext|>", "Ünï 漢字 x", "a " * 5000, "b" * 3000, "don't\n\n  we'll  "]
SCHEMA = "doc_id long, text string, n_tokens string"


def random_text(rng: random.Random, odd: bool) -> str:
    letters = LATIN + [" "] * 60 + list("etaoins") * 8 + ["'s", "'ll"] + (ODD * 15 + ["<|endoftext|>"] if odd else [])
    return "".join(rng.choices(letters, k=rng.randint(0, 60)))


@pytest.mark.parametrize("odd", [False, True])
def test_ids_are_the_library_s(odd):
    rng, library = random.Random(odd), encoding.tokenizer()
    for _ in range(1500):
        text = random_text(rng, odd)
        expected = library.encode(text, add_special_tokens=False).ids
        assert list(next(encoding.ids_of([text]))) == expected
        cut = encoding.parts(text, 5)
        assert "".join(cut) == text
        assert [i for part in cut for i in library.encode(part, add_special_tokens=False).ids] == expected


def test_long_texts_are_encoded_in_parts(monkeypatch):
    monkeypatch.setattr(encoding, "PART_BYTES", 100)
    text = "some words and 漢字 too, " * 200
    for each in (text, text.replace("漢字", "others")):
        assert list(next(encoding.ids_of([each]))) == encoding.tokenizer().encode(each, add_special_tokens=False).ids


@pytest.mark.parametrize("ranks", [encoding.RANKS, None])
def test_token_counts(spark, rows, ranks):
    table = [(None if i == 3 else i, t, "clash") for i, t in enumerate(TEXTS)] + [(7, TEXTS[7], "clash")]
    found = token_counts(spark.createDataFrame(table, SCHEMA).repartition(3), limit=1000, ranks=ranks)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = []
    for id, text, _ in table:
        n = len(encoding.tokenizer().encode(text or "", add_special_tokens=False).ids)
        expected.append((id, len((text or "").encode()), n, n > 1000))
    assert rows(found) == sorted(expected, key=lambda r: tuple((v is None, v) for v in r))


def test_token_counts_of_nothing(spark):
    assert token_counts(spark.createDataFrame([], SCHEMA)).collect() == []


def best_fit(histogram: dict[int, int], capacity: int) -> int:
    rooms: list[int] = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [i for i, r in enumerate(rooms) if r >= length]
            if fits:
                rooms[min(fits, key=lambda i: rooms[i])] -= length
            else:
                rooms.append(capacity - length)
    return len(rooms)


def test_plan_is_best_fit():
    rng = random.Random(5)
    for _ in range(200):
        capacity = rng.choice([5, 16, 64])
        histogram = {rng.randint(1, capacity): rng.randint(1, 20) for _ in range(rng.randint(0, 8))}
        sequences: dict[int, list] = {}
        ranks: dict[int, list] = {length: [] for length in histogram}
        for length, rank, count, first, offset in plan(histogram, capacity):
            for i in range(count):
                sequences.setdefault(first + i, []).append((offset, length))
                ranks[length].append(rank + i)
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
        for placed in sequences.values():
            at = 0
            for offset, length in sorted(placed):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(sequences) == best_fit(histogram, capacity)


def test_piece_starts():
    assert piece_starts(1, 4) == [0]
    assert piece_starts(8, 4) == [0, 4]
    assert piece_starts(9, 4) == [0, 1, 5]


@pytest.mark.parametrize("per_group", [1000, 2])
def test_best_fit_packing(spark, monkeypatch, per_group):
    monkeypatch.setattr(packing, "ROWS_PER_GROUP", per_group)
    monkeypatch.setattr(packing, "RANKS_PER_STEP", 3)
    table = [(None if i == 3 else i, t, "clash") for i, t in enumerate(TEXTS)] + [(20 + i, "a b c", "") for i in range(30)]
    found = best_fit_packing(spark.createDataFrame(table, SCHEMA).repartition(3), capacity=64).collect()
    sequences: dict[int, list] = {}
    pieces: dict = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    lengths: dict[int, int] = {}
    for id, text, _ in table:
        ids = np.array([*encoding.tokenizer().encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        starts = piece_starts(len(ids), 64)
        expected = []
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            expected.append((k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            lengths[b - a] = lengths.get(b - a, 0) + 1
        assert sorted(pieces[id]) == expected
    assert len(sequences) == best_fit(lengths, 64)


def test_packing_of_nothing(spark):
    assert best_fit_packing(spark.createDataFrame([], SCHEMA)).collect() == []
