"""Prefix tries against dictionaries of prefixes."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import stateline.llm.prefix_trie as tries
from stateline.llm.prefix_trie import DoubleArray, Trie, double_array_tries, head_swapped, prefix_nodes, turn_sequences

SCHEMA = "conv_id long, turn long, role string, text string, id string"


def plain(rows: list[tuple]) -> dict[int, list[tuple]]:
    """Turns of each conversation as (role, text)."""
    found: dict[int, list] = {}
    for conv, turn, role, text, _ in rows:
        if conv is not None:
            found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(r, t) for *_, r, t in sorted(turns, key=lambda x: x[:2])] for conv, turns in found.items()}


def nodes(sequences: dict[int, list[tuple]]) -> list[tuple]:
    members: dict[tuple, list[int]] = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children: dict[tuple, int] = {}
    for path in members:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    result = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        leaves = sum(p not in children for p in below)
        result.append((min(convs), len(path), parent, len(convs), children.get(path, 0), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(result, key=lambda r: (r[0], r[1]))


def conversations(seed: int) -> list[tuple]:
    """A third begin with the same turns, some are copies; odd turns, nulls and one long conversation."""
    rng = random.Random(seed)
    rows = []
    for conv in range(90):
        n = rng.randint(1, 7) if conv != 33 else 60
        shared = conv % 3 == 0
        for t in range(n):
            text = f"hot {t}" if shared and t < 4 else rng.choice(["ok", "yes", "é", "", None, f"own {conv} {t}"])
            rows.append((conv, t, rng.choice(["user", None]) if not shared else "user", text, "clash"))
    rows += [(100 + c, t, "user", f"hot {t}", "") for c in range(20) for t in range(3)]
    rows += [(200, None, "user", "first", ""), (200, 0, "user", "second", ""), (200, -1, "user", "between", "")]
    return rows + [(None, 0, "user", "hot 0", "")]


def found(frame) -> list[tuple]:
    return sorted(map(tuple, frame.collect()), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("turns, partitions", [((1 << 14, 1 << 20), 3), ((8, 8), 5), ((2, 2), 1)])
def test_nodes(spark, monkeypatch, turns, partitions):
    monkeypatch.setattr(tries, "SHARD_TURNS", turns)
    rows = conversations(1)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    result = prefix_nodes(turn_sequences(frame))
    assert result.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert found(result) == nodes(plain(rows))


@pytest.mark.parametrize("turns", [(1 << 14, 1 << 20), (4, 4)])
def test_swapped_heads(spark, monkeypatch, turns):
    """With conversations that lose all turns, and families without a first."""
    monkeypatch.setattr(tries, "SHARD_TURNS", turns)
    rows = [r for r in conversations(2) if r[0] not in (5, 10, 45)]
    frame = spark.createDataFrame(rows, SCHEMA)
    swapped = head_swapped(turn_sequences(frame), family=5, most=9, chosen=F.col("id") * 7 % 9)
    own = plain(rows)
    expected = {c: own.get(c - c % 5, [])[: c * 7 % 9] + turns[c * 7 % 9 :] for c, turns in own.items()}
    assert any(not turns for turns in expected.values())
    assert found(prefix_nodes(swapped)) == nodes(expected)


def test_small_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_nodes(turn_sequences(empty)).collect() == []
    assert double_array_tries(turn_sequences(empty)).collect() == []
    one = spark.createDataFrame([(7, None, None, None, None)], SCHEMA)
    assert found(prefix_nodes(turn_sequences(one))) == nodes({7: [("", "")]})
    bare = spark.createDataFrame([(4, []), (3, [])], "id long, turns array<struct<code: bigint, bytes: int>>")
    assert found(prefix_nodes(bare)) == nodes({4: [], 3: []})


def test_many_ids_of_one_sequence(spark):
    """Their digest is that of all of them in order, whatever batches and ranges they come in."""
    frame = spark.range(30000).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("hot").alias("text")).repartition(7)
    root, node = found(prefix_nodes(turn_sequences(frame)))
    digest = hashlib.sha256(",".join(map(str, range(30000))).encode()).hexdigest()
    assert node == (0, 1, 0, 30000, 0, 1, 29999 * 3, digest)
    assert root[3:7] == (30000, 1, 1, 29999 * 3)


def test_double_array():
    """Every sequence's turns are found, nothing else is, and siblings keep their places."""
    rng = np.random.default_rng(0)
    for codes in (5, 50, 10**6):
        sequences = {tuple(rng.integers(-codes, codes, rng.integers(0, 9)).tolist()) for _ in range(400)}
        ordered = sorted(sequences)
        flat = np.array([c for s in ordered for c in s], np.int64)
        trie = Trie(flat, np.array([len(s) for s in ordered]))
        paths = {s[:d] for s in ordered for d in range(len(s) + 1)}
        slots = {path: trie.find(list(path)) for path in paths}
        assert len(set(slots.values())) == len(paths) and min(slots.values()) == 0
        assert trie.walk(flat).tolist() == [slots[s[: d + 1]] for s in ordered for d in range(len(s))]
        for path in list(paths)[:50]:
            assert trie.find([*path, codes + 1]) == -1
            assert all((trie.find([*path, c]) >= 0) == ((*path, c) in paths) for c in range(-5, 5))
        assert trie.array.used.sum() == len(paths)


def test_slots_of_spread_families():
    """Children far apart share the slots between them with others."""
    array = DoubleArray()
    family = np.array([1, 5000])
    slots = array.add(np.repeat(array.add(np.zeros(300, np.int64), np.arange(1, 301)), 2), np.tile(family, 300))
    assert len(set(slots.tolist())) == 600
    assert array.top < 12000


def test_packed_tries(spark, monkeypatch):
    monkeypatch.setattr(tries, "SHARD_TURNS", (40, 40))
    rows = conversations(3)
    sequences = turn_sequences(spark.createDataFrame(rows, SCHEMA))
    shards = double_array_tries(sequences).collect()
    assert len(shards) > 1
    for row in sequences.collect():
        codes, reached = [t["code"] for t in row["turns"]], 0
        for shard in shards:
            slot, depth = 0, 0
            for code in codes:
                step = shard["base"][slot] + shard["codes"].index(code) + 1 if code in shard["codes"] else -1
                if not 0 < step < len(shard["check"]) or shard["check"][step] != slot:
                    break
                slot, depth = step, depth + 1
            reached = max(reached, depth)
        assert reached == len(codes)
