"""The quality classifier against statistics counted one by one and densities from inverse covariances."""

import math
import random
import re
from collections import Counter

import brute
import numpy as np
import pytest

from stateline.llm.quality_classifier import SHRINKAGE, quality_classifier

CAPITALS, DIGITS, LETTERS = (set(range(*r)) for r in ((0x41, 0x5B), (0x30, 0x3A), (0x61, 0x7B)))
MARKS = set(range(0x21, 0x7F)) - CAPITALS - DIGITS - LETTERS


def share(part: float, whole: float) -> float:
    return math.log((part + 0.5) / (whole - part + 0.5))


def features(text: str | None) -> list[float]:
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0d]+", data)
    small = [w.lower() for w in words]  # bytes: A-Z only
    pairs = list(zip(small, small[1:]))
    lines = re.findall(rb"[^\n]+", data)
    n, sizes = len(words), [len(w) for w in words]
    mean = sum(sizes) / max(n, 1)
    spread = math.sqrt(max(sum(s * s for s in sizes) / max(n, 1) - mean**2, 0))
    count = {name: sum(b in kind for b in data) for name, kind in (("capital", CAPITALS), ("digit", DIGITS), ("mark", MARKS), ("letter", LETTERS))}
    return [
        math.log1p(len(data)),
        math.log1p(n),
        math.log1p(mean),
        math.log1p(spread),
        share(count["capital"], count["capital"] + count["letter"]),
        share(count["digit"], len(data)),
        share(count["mark"], len(data)),
        share(sum(b >= 0x80 for b in data), len(data)),
        share(len(set(small)), n),
        share(len(set(pairs)), len(pairs)),
        share(max(Counter(small).values(), default=0), n),
        share(sum(a == b for a, b in pairs), len(pairs)),
        share(sum(w[-1] in MARKS for w in words), n),
        share(sum(len(w) > 1 and w[-1] in MARKS and w[-2] in MARKS for w in words), n),
        math.log1p(n / max(len(lines), 1)),
        share(len(lines) - len(set(lines)), len(lines)),
        share(sum(s <= 2 for s in sizes), n),
    ]


def plain(docs: list[tuple], labels: list[tuple]) -> list[tuple]:
    """``(id, held out, score)``."""
    x = {0: [], 1: []}
    for id, text in docs:
        for other, label in labels:
            if id is not None and id == other and label in (0, 1) and not brute.held_out(id):
                x[label].append(features(text))
    both = np.array(x[0] + x[1])
    centre = both.mean(0)
    classes = [np.array(x[c]) for c in (0, 1)]
    scale = np.sqrt(np.maximum(sum(((c - c.mean(0)) ** 2).sum(0) for c in classes) / len(both), 1e-9))
    densities = []
    for c in classes:
        z = (c - c.mean(0)) / scale
        cov = (1 - SHRINKAGE) * z.T @ z / len(c) + SHRINKAGE * np.eye(z.shape[1])
        densities.append(((c.mean(0) - centre) / scale, np.linalg.inv(cov), np.linalg.slogdet(cov)[1], math.log(len(c) / len(both))))
    result = []
    for id, text in docs:
        z = (np.array(features(text)) - centre) / scale
        logs = [prior - 0.5 * (spread + (z - m) @ inverse @ (z - m)) for m, inverse, spread, prior in densities]
        result.append((id, brute.held_out(id), 1 / (1 + math.exp(-(logs[1] - logs[0]) / len(z)))))
    return result


@pytest.mark.parametrize("partitions", [1, 5])
def test_like_the_plain_version(spark, partitions):
    rng = random.Random(5)
    good = "The quick reader, who liked long texts, found 3 words there and Öne more".split()
    docs = []
    for i in range(160):
        words = rng.choices(good, k=rng.randint(5, 80)) if i % 2 else rng.choices(["BUY", "now!!", "$$$", "1", "ok", "ok"], k=rng.randint(3, 60))
        docs.append((i, "".join(w + rng.choice([" ", " ", "\n", "\t"]) for w in words)))
    docs += [(500, None), (501, ""), (502, " \n"), (503, "é"), (None, "a b"), docs[3]]
    labels = [(i, i % 2 if i % 17 else 1 - i % 2) for i in range(0, 160, 2)] + [(i, i % 2) for i in range(1, 160, 3)] + [(7, 5), (None, 1), (9, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions)
    found = sorted(map(tuple, quality_classifier(frame, spark.createDataFrame(labels, "doc_id long, quality int")).collect()), key=str)
    expected = sorted(plain(docs, labels), key=str)
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    for mine, theirs in zip(found, expected, strict=True):
        assert mine[2] == pytest.approx(theirs[2], rel=1e-6)
        assert mine[3] == int(mine[2] >= 0.3)
