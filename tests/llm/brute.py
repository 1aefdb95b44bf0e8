"""Plain versions of what the operators compute, for small tables."""

from __future__ import annotations

import re
import zlib

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def shingles(text: str | None, n: int = 5) -> set[tuple[str, ...]]:
    words = SPACED.findall((text or "").translate(SMALL))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def components(rows: list[tuple], percent: int = 75) -> list[tuple]:
    """``(id, size, component)`` for rows ``(id, text)``."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                group[root(i)] = root(j)
    least: dict[int, int | None] = {}
    for i, (id, _) in enumerate(rows):
        least[root(i)] = min((x for x in (least.get(root(i)), id) if x is not None), default=None)
    return [(id, len(s), least[root(i)] if s else id) for i, ((id, _), s) in enumerate(zip(rows, sets, strict=True))]


def kept_words(rows: list[tuple], window: int = 50) -> list[tuple]:
    """``(id, words, removed, kept text)`` for rows ``(id, text)``."""
    words = [SPACED.findall(t or "") for _, t in rows]
    least: dict[tuple, int] = {}
    for (id, _), w in zip(rows, words, strict=True):
        for i in range(len(w) - window + 1):
            if id is not None:
                key = tuple(w[i : i + window])
                least[key] = min(least.get(key, id), id)
    result = []
    for (id, _), w in zip(rows, words, strict=True):
        gone: set[int] = set()
        for i in range(len(w) - window + 1):
            if id is not None and least[tuple(w[i : i + window])] < id:
                gone.update(range(i, i + window))
        result.append((id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return result


def contamination(rows: list[tuple], items: list[tuple], window: int = 13) -> list[tuple]:
    """``(id, words, hit words, items found)`` for rows ``(id, text)`` and items ``(item, text)``."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = ALNUM.findall((text or "").translate(SMALL))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    result = []
    for id, text in rows:
        w = ALNUM.findall((text or "").translate(SMALL))
        hit: set[int] = set()
        found: set = set()
        for n in range(1, window + 1):
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        result.append((id, len(w), len(hit), found))
    return result


def held_out(id) -> bool:
    return id is not None and zlib.crc32(str(id).encode()) % 5 == 0


def judged(url: str | None, rules: list[tuple[str, str]], otherwise: str = "allow") -> tuple:
    """``(host, path, rule, verdict)``."""
    host = path = ""
    if url and "://" in url:
        rest = url.partition("://")[2]
        host = re.split("[/?#]", rest)[0].translate(SMALL)
        path = re.split("[?#]", rest[len(re.split("[/?#]", rest)[0]) :])[0]
    fits = []
    for rule, verdict in rules:
        h, p = rule.partition("/")[0], "/" + rule.partition("/")[2]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h), len(p), rule, verdict))
    best = max(fits, default=(0, 0, None, otherwise))
    return host, path, best[2], best[3]
