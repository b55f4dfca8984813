"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, size: int = 3) -> frozenset:
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def roots_of(rows: list[tuple], per_cent: int = 90, size: int = 3) -> list[int]:
    """For each (id, text) the position of its component's root."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            s, t = sets[a], sets[b]
            if s and t and 10 * min(len(s), len(t)) * 10 >= per_cent * max(len(s), len(t)) \
                    and 100 * len(s & t) >= per_cent * len(s | t):
                root[find(a)] = find(b)
    return [find(k) for k in range(len(rows))]


def components_of(rows: list[tuple], per_cent: int = 90, size: int = 3) -> dict:
    """The smallest id of each id's component."""
    roots = roots_of(rows, per_cent, size)
    least: dict = {}
    for (i, t), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return {i: least[r] for (i, _), r in zip(rows, roots) if i is not None}


def bench_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(UPPER))


def hits(text: str | None, items: list[tuple], window: int = 13) -> tuple[int, int, set]:
    """Words, words inside occurring windows, and the items they are from."""
    w = bench_words(text)
    covered, found = set(), set()
    for name, item in items:
        v = bench_words(item)
        if not v:
            continue
        n = min(window, len(v))
        windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in windows:
                covered.update(range(i, i + n))
                found.add(name)
    return len(w), len(covered), found


def contaminated_texts(texts: list, items: list) -> set:
    out = set()
    for t in texts:
        n, hit, _ = hits(t, [(k, x) for k, x in enumerate(items)])
        if hit and 20 * hit >= n:
            out.add(t)
    return out
