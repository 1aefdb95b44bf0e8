"""Hard negatives against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import stateline.llm.hard_negatives as mining
from stateline.llm.hard_negatives import Rows, hard_negatives

SCHEMA = "vec_id long, embedding array<long>, label int, rank string"
RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def exact(table: list[tuple], every: int, positives: int, negatives: int, percent: int) -> list[tuple]:
    by_id: dict = {}
    for i, v, label, _ in table:
        if i is not None and label is not None and v is not None and None not in v:
            by_id[i] = min(by_id.get(i, (label, v)), (label, v))
    lengths = [len(v) for _, v in by_id.values()]
    common = max(set(lengths), key=lambda n: (lengths.count(n), -n), default=0)
    rows = {i: r for i, r in by_id.items() if len(r[1]) == common and common}
    result = []
    for a, (label, v) in rows.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, other == label) for i, (other, w) in rows.items() if i != a)
        for p, j, _ in [s for s in scored if s[2]][:positives]:
            window = [s for s in scored if not s[2] and percent * -p <= 100 * -s[0] <= 100 * -p]
            result += [(a, j, rank, i, -p, -n) for rank, (n, i, _) in enumerate(window[:negatives], 1)]
    return sorted(result)


def vectors(seed: int, n: int, spread: float) -> list[tuple]:
    """Clusters, a vector that many rows have, zeros, and rows that take no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 24)) * np.linspace(3, 0.1, 24)
    table = []
    for i in range(n):
        v = 40 * (centres[i % 5] + spread * rng.normal(size=24)) * rng.uniform(0.2, 2)
        table.append((i, v.astype(int).tolist(), int(rng.integers(0, 4)), "clash"))
    table += [(n + i, table[3][1], i % 3, "") for i in range(60)]
    table += [(5, table[9][1], 0, ""), (10, [0] * 24, 1, ""), (10, [1] * 24, 1, ""), (2 * n, [0] * 24, 2, "")]
    bad = [(1, None, 1, ""), (2, [None] * 24, 1, ""), (3, [1] * 23 + [None], 1, ""), (4, [1] * 23, 1, ""), (6, [], 1, "")]
    return table + [(3 * n + 10 * i, v, label, r) for i, v, label, r in bad] + [(None, [1] * 24, 1, ""), (4 * n, [1] * 24, None, "")]


@pytest.mark.parametrize("spread", [0.05, 1.0])
@pytest.mark.parametrize("shard_rows, cells", [((1024, 65536), 1 << 21), ((40, 40), 500)])
def test_negatives(spark, monkeypatch, spread, shard_rows, cells):
    monkeypatch.setattr(mining, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(mining, "CELLS", cells)
    table = vectors(1, 300, spread)
    frame = spark.createDataFrame(table, SCHEMA).repartition(3)
    found = hard_negatives(frame, F.col("vec_id") % 10 == 0)
    assert found.columns == RESULT
    expected = exact(table, 10, 5, 5, 80)
    assert len(expected) > 50
    assert sorted(map(tuple, found.collect())) == expected


def test_other_bounds(spark):
    table = vectors(2, 120, 0.3)
    frame = spark.createDataFrame(table, SCHEMA)
    found = hard_negatives(frame, F.col("vec_id") % 7 == 0, positives=2, negatives=9, least_percent=30)
    assert sorted(map(tuple, found.collect())) == exact(table, 7, 2, 9, 30)


def test_few_rows(spark, rows):
    frame = spark.createDataFrame([(0, [2, 0], 1, ""), (1, [1, 0], 1, ""), (2, [1, 5], 2, ""), (3, [1, 7], 2, ""), (4, [3, 0], 2, ""), (5, [-1, 0], 1, "")], SCHEMA)
    anchor = F.col("vec_id") == 0
    assert rows(hard_negatives(frame, anchor)) == [(0, 1, 1, 2, 2, 2), (0, 1, 2, 3, 2, 2)]
    assert rows(hard_negatives(frame, F.lit(False))) == []
    assert rows(hard_negatives(frame.where("label = 1"), anchor)) == []
    assert hard_negatives(frame.limit(0), anchor).columns == RESULT
    assert rows(hard_negatives(frame.limit(0), anchor)) == []


def test_too_long(spark):
    frame = spark.createDataFrame([(0, [2**40], 1, "")], SCHEMA)
    with pytest.raises(Exception, match="too long"):
        hard_negatives(frame, F.lit(True)).collect()


@pytest.mark.parametrize("reach", [0.0, 5.0, 60.0, np.inf])
def test_omitted_dimensions_cannot_reach(reach):
    """What the index leaves out of a row has too small a norm; postings hold the rest."""
    rng = np.random.default_rng(0)
    x = rng.integers(-40, 40, (50, 20)) * np.linspace(1, 0.05, 20)
    rows = Rows(np.arange(50), np.zeros(50), x.astype(np.int64))
    order, indexed, postings, _ = rows.index(reach)
    y = rows.x[order][:, rows.weighty].astype(float)
    held = np.zeros_like(y)
    for dims, values in postings:
        held[: len(values), dims] += values
    left_out = y * (np.arange(20) >= indexed[:, None])
    assert (held + left_out == y).all()
    assert (np.linalg.norm(left_out, axis=1) < reach).all() or reach == 0
    assert (np.diff(indexed) <= 0).all()
