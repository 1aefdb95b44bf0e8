"""Source mixing against the same meetings in plain code, and against what a mix must keep."""

import pytest
from pyspark.sql import functions as F

from stateline.llm.source_mixing import BLOCK, n_words, source_mixing

SCHEMA = "doc_id long, text string, source string, size string"
RESULT = ["doc_id", "size", "source_size", "target", "copies", "taken"]


def documents(n: int = 900) -> list[tuple]:
    """A source with a third of the rows, a null source, one of one very long text, one without words."""
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else ["b", None, "a", "é", "z"][i % 5]
        rows.append((i, "w " * ((i * 7919) % 97), source, "clash"))
    rows += [(n, "word\t" * 5000, "long", ""), (n + 1, "", "bare", ""), (n + 2, None, "bare", ""), (None, "a b c", "b", "")]
    return rows + [(5, "one two", "a", "")] * 200


def expected_targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2) -> dict:
    """Shares by weight, again and again over the sources that are below their stop."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_sources, target = share * sum(sizes.values()), set(order), {}
    while open_sources:
        level = left / sum(weight[s] for s in open_sources)
        stopped = {s for s in open_sources if weight[s] * level >= most * sizes[s]}
        if not stopped:
            return target | {s: weight[s] * level for s in open_sources}
        for s in stopped:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_sources -= stopped
    return target


@pytest.mark.parametrize("partitions", [1, 5])
def test_mix(spark, partitions):
    rows = documents()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    found = source_mixing(frame)
    assert found.columns == RESULT
    taken = sorted(map(tuple, found.collect()), key=str)
    assert len(taken) == len(rows)

    words = [(i, len((t or "").split()), s) for i, t, s, _ in rows]
    sizes: dict = {}
    for _, n, s in words:
        sizes[s] = sizes.get(s, 0) + n
    targets = expected_targets(sizes)
    assert sorted(map(str, ((i, n, sizes[s]) for i, n, s in words))) == sorted(map(str, (r[:3] for r in taken)))
    source_of = {i: s for i, _, s in words if i != 5 and i is not None}
    of_source: dict = {}
    for i, size, source_size, target, copies, words_taken in taken:
        source = "a" if i == 5 and size == 2 else source_of.get(i, "b")
        assert target == pytest.approx(targets[source], rel=1e-12)
        assert words_taken == copies * size <= 2 * size
        exact = target / source_size if source_size else 0
        assert abs(copies - exact) < 1 or not size
        of_source.setdefault(source, []).append((size, words_taken))
    for source, of in of_source.items():
        assert abs(sum(t for _, t in of) - targets[source]) <= max(n for n, _ in of) / 2
    assert sorted(map(tuple, source_mixing(frame.repartition(3)).collect()), key=str) == taken


def test_meetings(spark):
    """The tree of meetings, block by block, in plain code."""
    n = 3 * BLOCK * BLOCK // 2
    frame = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") * 31 % 53 + 1).cast("int")).alias("text"), F.lit("s").alias("source"))
    got = {r["doc_id"]: r["copies"] for r in source_mixing(frame, weights=(1,), share=0.3, most=2).collect()}
    sizes = {i: i * 31 % 53 + 1 for i in range(n)}
    part = 0.3 * sum(sizes.values()) / sum(sizes.values())

    chances = spark.sql("select explode(sequence(0, 2)) as level").join(spark.range(n).withColumnRenamed("id", "at"), F.lit(True))
    chances = chances.where(F.col("at") * F.pow(F.lit(BLOCK), "level") < n)
    hashed = F.xxhash64(F.lit(0), "level", F.lit(0).cast("bigint"), F.floor(F.col("at") / BLOCK), (F.col("at") % BLOCK).cast("int"))
    chance = {(r[0], r[1]): (r[2] % 2**64 >> 11) * 2.0**-53 for r in chances.select("level", "at", hashed).collect()}

    copies: dict[int, int] = {}
    items = [(at, i, sizes[i], part * sizes[i]) for at, i in enumerate(sorted(sizes, key=lambda i: (-sizes[i], i)))]
    level = 0
    while len(items) > 1 or level == 0:
        left_over = []
        for block in sorted({at // BLOCK for at, *_ in items}):
            left = None
            for at, i, size, mass in [x for x in items if x[0] // BLOCK == block]:
                if left is None:
                    left = (i, size, mass)
                    continue
                j, left_size, left_mass = left
                up, down = min(left_size - left_mass, mass), min(size - mass, left_mass)
                if chance[level, at] * (up + down) < down:
                    a, b, gained = (j, left_size, left_mass + up), (i, size, mass - up), up
                    full, empty = up == left_size - left_mass, up == mass
                else:
                    a, b, gained = (i, size, mass + down), (j, left_size, left_mass - down), down
                    full, empty = down == size - mass, down == left_mass
                assert gained >= 0 and (full or empty)
                copies |= {a[0]: 1} if full else {}
                copies |= {b[0]: 0} if empty else {}
                left = None if full and empty else b if full else a
            if left:
                left_over.append((block, *left))
        items, level = left_over, level + 1
    for _, i, size, mass in items:
        copies[i] = int(2 * mass >= size)
    assert got == copies


def test_every_document_may_be_taken(spark):
    """Over seeds, documents are taken about as often as expected, long and short ones."""
    frame = spark.createDataFrame([(i, "w " * (1 + i * i % 41), "s") for i in range(40)], "doc_id long, text string, source string")
    counts = dict.fromkeys(range(40), 0)
    for seed in range(6):
        for r in source_mixing(frame, weights=(1,), share=0.5, most=2, seed=seed).collect():
            counts[r["doc_id"]] += r["copies"]
    assert 6 * 40 * 0.35 < sum(counts.values()) < 6 * 40 * 0.65
    assert sum(0 < c < 6 for c in counts.values()) >= 32


def test_small_tables(spark, rows):
    empty = spark.createDataFrame([], SCHEMA)
    assert source_mixing(empty).columns == RESULT
    assert rows(source_mixing(empty)) == []
    bare = spark.createDataFrame([(1, None, None, ""), (2, " \t", None, "")], SCHEMA)
    assert rows(source_mixing(bare)) == [(1, 0, 0, 0.0, 0, 0), (2, 0, 0, 0.0, 0, 0)]
    one = spark.createDataFrame([(1, "a b", "s", "")], SCHEMA)
    assert rows(source_mixing(one)) == [(1, 2, 2, 3.0, 2, 4)]


def test_words(spark, rows):
    texts = ["a b", "  a\tb\n", "", None, "\x0b\x0c\r", "é b x y", "x" * 100000 + " y", "a\x1cb"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert rows(frame.select("i", n_words(F.col("t")))) == [(0, 2), (1, 2), (2, 0), (3, 0), (4, 0), (5, 2), (6, 2), (7, 1)]


def test_native(spark):
    """No Python in the plan, no cross join."""
    plan = source_mixing(spark.createDataFrame(documents(30), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
