"""Language identification against the same evidence counted with dictionaries and loops."""

import math
import random

import numpy as np
import pytest

import stateline.llm.language_id as lid
from stateline.llm.language_id import language_id

SCHEMA = "doc_id long, text string, lang string, source string"


def classes(text: str | None) -> list[int]:
    s = [b - 0x60 if 0x61 <= b <= 0x7A else b - 0x40 if 0x41 <= b <= 0x5A else b - 0x80 + 27 if b >= 0x80 else 0 for b in (text or "").encode()]
    grams = [g for g in zip(s, s[1:], s[2:]) if sum(x > 0 for x in g) >= 2]
    return [(((a * 155 + b) * 155 + c) * 2654435761 % 2**32) >> 17 for a, b, c in grams]


def plain(rows: list[tuple], least: float = lid.LEAST_PROBABILITY) -> list[tuple]:
    """``(id, text language, language, probability, accepted)``."""
    counts: dict[str, dict[int, int]] = {}
    for _, text, said, _ in rows:
        for c in classes(text) if said and said != "und" else []:
            counts.setdefault(said, {}).setdefault(c, 0)
            counts[said][c] += 1
    totals = {x: sum(c.values()) for x, c in counts.items()}
    names = sorted((x for x in totals if totals[x] >= lid.LEAST_TRIGRAMS), key=lambda x: (-totals[x], x))
    n = len(names)

    def share(x: str, c: int) -> np.float32:
        any_class = max(lid.ANY_CLASS, lid.ANY_TRIGRAMS / (totals[x] + lid.ANY_TRIGRAMS))
        return np.float32(math.log((1 - any_class) * counts[x].get(c, 0) / totals[x] + any_class / lid.CLASSES))

    def likelihoods(text: str | None) -> list[float] | None:
        found = classes(text)
        if not found:
            return None
        weight = min(len(found), lid.WEIGHT) / len(found)
        return [weight * sum(float(share(x, c)) for c in found) for x in names] + [-weight * len(found) * math.log(lid.CLASSES)]

    ll = [likelihoods(text) for _, text, _, _ in rows]
    best = [None if x is None else x.index(max(x)) for x in ll]
    said_at = [n + 1 if said is None else names.index(said) if said in names else n for _, _, said, _ in rows]
    odds = [[lid.SMOOTHING * (11 if i == j else 1) for j in range(n + 2)] for i in range(n)] + [[lid.SMOOTHING] * (n + 2)]
    for b, s in zip(best, said_at, strict=True):
        if b is not None:
            odds[b][s] += 1

    def smoothed(own: list[float], above: list[float], lean: float) -> list[float]:
        return [(c + lean * p) / (sum(own) + lean) for c, p in zip(own, above, strict=True)]

    def tally(keep) -> list[float]:
        return [float(sum(b == k and keep(host) for b, (*_, host) in zip(best, rows, strict=True))) for k in range(n + 1)]

    overall = smoothed(tally(lambda _: True), [1 / (n + 1)] * (n + 1), lid.SMOOTHING * (n + 1))

    def domain(host: str) -> str:
        return ".".join(host.split(".")[-2:])

    def prior(host: str | None) -> list[float]:
        if host is None or not sum(tally(lambda h: h == host)):
            return overall
        above = smoothed(tally(lambda h: h is not None and domain(h) == domain(host)), overall, lid.DOMAIN_LEAN)
        return smoothed(tally(lambda h: h == host), above, lid.HOST_LEAN)

    priors = {host: prior(host) for host in {h for *_, h in rows}}
    result = []
    for (id, text, said, host), x, b, s in zip(rows, ll, best, said_at, strict=True):
        rare = [1 - lid.UNKNOWN_SHARE] * n + [lid.UNKNOWN_SHARE]
        score = [math.log(priors[host][k]) + math.log(rare[k]) + (x[k] if x else 0) + math.log(odds[k][s] / sum(odds[k])) for k in range(n + 1)]
        total = sum(math.exp(v - max(score)) for v in score)
        k = score.index(max(score))
        known = 1 - math.exp(score[n] - max(score)) / total
        letters = any(c.isascii() and c.isalpha() or ord(c) >= 0x80 for c in text or "")
        modelless = said is not None and said not in names and said != "und"
        accepted = letters and (modelless or (k < n and known >= least))
        language = said if modelless and letters and (k == n or 1 / total < least) else [*names, "und"][k]
        result.append((id, None if b is None else [*names, "und"][b], language, 1 / total, accepted))
    return result


def texts(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    spoken = {
        "en": "the of and to in that with from this have are for not but they which".split(),
        "de": "der die und das mit nicht ein von zu auf für ist ich sie über grün".split(),
        "ru": "и в не на что это как по но из от для все так".split(),
    }
    rows = []
    for i in range(90):
        language = ("en", "en", "de", "ru")[i % 4]
        said = rng.choice([language, language, language, None, "en", "xx"])
        host = rng.choice(["a.one.org", "b.one.org", "two.de", None, f"{language}.three.net"])
        rows.append((i, " ".join(rng.choices(spoken[language], k=rng.randint(1, 60))), said, host))
    rows += [(200, "Hi", "en", "a.one.org"), (201, "", "de", "two.de"), (202, None, None, None), (203, "1 2 3 ...", "en", "two.de"), (204, "é", None, "two.de")]
    rows += [(205, "zzq xxw qqv " * 20, None, None), (206, "zzq xxw qqv " * 20, "xx", "unseen.org"), (207, "the und и", "de", "en.three.net")]
    return rows + [rows[0], (None, *rows[1][1:])]


@pytest.mark.parametrize("seed, partitions", [(1, 1), (2, 4)])
def test_like_the_plain_version(spark, seed, partitions):
    rows = texts(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    found = sorted(map(tuple, language_id(frame).collect()), key=str)
    expected = sorted(plain(rows), key=str)
    assert len(found) == len(expected)
    for mine, theirs in zip(found, expected, strict=True):
        assert mine[:3] == theirs[:3] and mine[4] == theirs[4]
        assert mine[3] == pytest.approx(theirs[3], rel=1e-4)
