"""Words and n-grams against regular expressions, whatever the chunks and slices."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

import stateline.llm.words as words_module
from stateline.llm.words import ALNUM_LOWER, SPACED, SPACED_LOWER, Words, blocks, grams, pick

SMALL = str.maketrans("ABZ", "abz")
KINDS = [
    (SPACED, "[^\x20\x09-\x0d]+", False),
    (SPACED_LOWER, "[^\x20\x09-\x0d]+", True),
    (ALNUM_LOWER, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", True),
]


def some_texts(rng: random.Random) -> list[str]:
    letters = [*"aAbBzZ \t\n\x00\x1f-|é漢0 ", "  "]
    return ["".join(rng.choices(letters, k=rng.choice([0, 1, 5, 40]))) for _ in range(rng.randint(0, 8))]


@pytest.mark.parametrize("chunk", [1 << 20, 1, 7, 30])
@pytest.mark.parametrize("table, pattern, lower", KINDS)
def test_words_and_grams(monkeypatch, chunk, table, pattern, lower):
    monkeypatch.setattr(words_module, "CHUNK_BYTES", chunk)
    rng = random.Random(chunk)
    for _ in range(40):
        texts = some_texts(rng)
        found = Words(pa.array(["zz", *texts], pa.string()).slice(1), table)
        expected = [re.findall(pattern, t.translate(SMALL) if lower else t) for t in texts]
        flat = [w for text in expected for w in text]
        assert list(found.counts()) == [len(w) for w in expected]
        spans = [bytes(found.data[a:b]).decode() for a, b in zip(found.starts, found.ends, strict=True)]
        assert [s.translate(SMALL) if lower else s for s in spans] == flat
        for n in (1, 2, 3, 5, 13):
            hashes = grams(found.hashes, n)
            runs = [tuple(flat[i : i + n]) for i in range(len(flat) - n + 1)]
            assert len(set(zip(runs, hashes.tolist(), strict=True))) == len(set(runs)) == len(set(hashes.tolist()))


def test_blocks_keep_rows_and_order():
    texts = ["a" * n for n in (3, 0, 9, 1, 1, 1)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["id", "text"])
    cut = list(blocks(iter([batch]), "text", 4))
    assert [r for b in cut for r in b.column("id").to_pylist()] == list(range(7))
    assert [r for b in cut for r in b.column("text").to_pylist()] == [*texts[:-1], ""]
    assert all(sum(map(len, b.column("text").to_pylist())) <= 4 or b.num_rows == 1 for b in cut)


def test_pick_from_slices():
    yes, no = pa.array(["x", "a", "b"]).slice(1), pa.array(["y", "c", None]).slice(1)
    assert pick(np.array([True, False]), yes, no).to_pylist() == ["a", None]
    assert pick(np.array([False, True]), yes).to_pylist() == [None, "b"]
