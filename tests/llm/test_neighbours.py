"""Nearest neighbours against all inner products."""

import numpy as np
import pytest

import stateline.llm.multi_index_hashing as hashing
from stateline.llm.multi_index_hashing import Index, nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, code string"


def exact(table: list[tuple], queries: set[int], k: int) -> dict[int, list[tuple[int, float]]]:
    good = [(i, np.array(v, float)) for i, v, _ in table if i is not None and usable(v)]
    result = {}
    for i, v in good:
        if i in queries:
            near = sorted((-float((v * w).sum()), j) for j, w in good if j != i)
            result[i] = [(j, -s) for s, j in near[:k]]
    return result


def usable(v) -> bool:
    return v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)


def vectors(seed: int, n: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 16))
    table = []
    for i in range(n):
        v = centres[i % 6] + 0.5 * rng.normal(size=16)
        v *= rng.uniform(0.5, 2)
        table.append((i, np.float32(v).tolist(), "clash"))
    hot = table[3][1]
    table += [(n + i, hot, "") for i in range(40)]
    bad = [None, [0.0] * 16, [1.0] * 15 + [None], [1.0] * 15 + [float("nan")], [1.0] * 15 + [float("inf")], [1.0] * 3, []]
    return table + [(2 * n + 20 * i, v, "") for i, v in enumerate(bad)] + [(None, hot, "")]


@pytest.mark.parametrize("shard_rows, block", [((8192, 65536), 16384), ((50, 50), 7)])
def test_recall(spark, monkeypatch, shard_rows, block):
    monkeypatch.setattr(hashing, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(hashing, "BLOCK_QUERIES", block)
    table = vectors(1, 400)
    frame = spark.createDataFrame(table, SCHEMA).repartition(3)
    found = nearest_neighbours(frame, frame.where("vec_id % 20 = 0"), k=10)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    expected = exact(table, set(range(0, 10_000, 20)), 10)
    got: dict = {}
    for r in found.collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert got.keys() == expected.keys()
    hits = []
    for q, near in expected.items():
        mine = [got[q][r] for r in sorted(got[q])]
        assert sorted(got[q]) == list(range(1, 11))
        assert mine == sorted(mine, key=lambda x: (-x[1], x[0]))
        hits.append(len({j for j, _ in near} & {j for j, _ in mine}) / 10)
        scores = dict(near)
        assert all(abs(scores[j] - s) < 1e-9 for j, s in mine if j in scores)
    assert np.mean(hits) >= 0.9


def test_few_rows(spark, rows):
    frame = spark.createDataFrame([(0, [1.0, 0.0], ""), (1, [2.0, 0.0], ""), (2, [2.0, 0.0], ""), (3, [-1.0, 0.0], "")], SCHEMA)
    found = nearest_neighbours(frame, frame.where("vec_id = 0"), k=20)
    assert rows(found) == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 3, -1.0)]
    assert rows(nearest_neighbours(frame.where("vec_id = 0"), frame, k=20), "query_id", "vec_id") == [(1, 0), (2, 0), (3, 0)]
    assert rows(nearest_neighbours(frame, frame.limit(0))) == []
    assert rows(nearest_neighbours(frame.limit(0), frame.limit(0))) == []


@pytest.mark.parametrize("radius", [0, 1, 5, 11, 30, 64])
def test_every_code_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    codes = rng.integers(0, 2**63, 300, dtype=np.uint64)
    codes[:100] = codes[100] ^ (np.uint64(1) << rng.integers(0, 64, 100, dtype=np.uint64))
    for substrings in ([(at, 8) for at in range(0, 64, 8)], [(0, 8), (8, 8), (16, 3)]):
        mask = np.uint64(2**64 - 1) if len(substrings) == 8 else np.uint64(2**19 - 1)
        index = Index(codes & mask, substrings)
        for code in codes[95:105] & mask:
            expected = np.flatnonzero(np.bitwise_count((codes & mask) ^ code) <= radius)
            assert index.within(code, radius).tolist() == expected.tolist()


@pytest.mark.parametrize("radius", [0, 9, 40, 100])
def test_codes_of_several_words(radius):
    rng = np.random.default_rng(radius)
    codes = rng.integers(0, 2**63, (300, 3), dtype=np.uint64)
    for i in range(100):
        codes[i] = codes[100]
        for bit in rng.integers(0, 180, rng.integers(0, 60)):
            codes[i, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    index = Index(codes, [(at, 16) for at in range(0, 192, 16)])
    distances = index.distances(codes[95:105])
    for code, distance in zip(codes[95:105], distances, strict=True):
        expected = np.bitwise_count(codes ^ code).sum(1, dtype=int)
        assert distance.tolist() == expected.tolist()
        assert index.within(code, radius).tolist() == np.flatnonzero(expected <= radius).tolist()


@pytest.mark.parametrize("shard_rows", [(8192, 65536), (30, 30)])
def test_an_id_with_many_vectors_is_one_neighbour(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(hashing, "SHARD_ROWS", shard_rows)
    rng = np.random.default_rng(3)
    table = [(i, np.float32(rng.normal(size=16)).tolist(), "") for i in range(100)]
    table += [(7, np.float32(0.1 * rng.normal(size=16) + 9 * np.array(table[0][1])).tolist(), "") for _ in range(60)]
    table += [(8, table[8][1], "")] * 50
    frame = spark.createDataFrame(table, SCHEMA)
    found = nearest_neighbours(frame, frame.where("vec_id = 0"), k=20).orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(1, 21))
    assert len({r["vec_id"] for r in found}) == 20
    best: dict = {}
    for i, v, _ in table[1:]:
        best[i] = max(best.get(i, -np.inf), float(np.array(table[0][1], float) @ np.array(v, float)))
    assert found[0]["vec_id"] == 7
    assert all(r["score"] == pytest.approx(best[r["vec_id"]]) for r in found)
    assert len({r["vec_id"] for r in found} & set(sorted(best, key=lambda i: -best[i])[:20])) >= 18


@pytest.mark.parametrize("part", [0.0, 1e9])
def test_probing_and_testing_all_codes_find_the_same(spark, monkeypatch, part):
    """Near copies, so that the radius is small; buckets are probed, or all codes tested."""
    monkeypatch.setattr(hashing, "PROBED_PART", part)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    table = [(i, np.float32(centres[i % 40] + 0.02 * rng.normal(size=16)).tolist(), "") for i in range(1200)]
    frame = spark.createDataFrame(table, SCHEMA)
    got: dict = {}
    for r in nearest_neighbours(frame, frame.where("vec_id % 100 = 0"), k=10).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    expected = exact(table, set(range(0, 1200, 100)), 10)
    assert np.mean([len(got[q] & {j for j, _ in near}) / 10 for q, near in expected.items()]) >= 0.95
