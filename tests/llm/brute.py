"""Plain definitions of what the corpus operators return, one document at a time."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FORM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, words in repeated 8-word windows."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows: dict[tuple, list[int]] = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def repeats(docs: list[tuple[int | None, str | None]], size: int) -> list[tuple[int | None, int, int, str]]:
    """(id, words, removed words, hash of what is kept) per document."""
    words = [WORD.findall(t or "") for _, t in docs]
    least: dict[tuple, int] = {}
    for (i, _), w in zip(docs, words, strict=True):
        for k in range(len(w) - size + 1 if i is not None else 0):
            key = tuple(w[k : k + size])
            least[key] = min(least.get(key, i), i)
    out = []
    for (i, _), w in zip(docs, words, strict=True):
        gone = set()
        for k in range(len(w) - size + 1 if i is not None else 0):
            if least[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def leaks(docs, items, size: int = 10):
    """(id, words, hit words, items found, hash of their ids, contaminated) per document."""
    owners: dict[tuple, set[int]] = {}
    for item, text in items:
        w = FORM.findall((text or "").translate(FOLD)) if item is not None else []
        for k in range(max(1, len(w) - size + 1) if w else 0):
            owners.setdefault(tuple(w[k : k + size]), set()).add(item)
    lengths = sorted({len(k) for k in owners})
    out = []
    for i, text in docs:
        w = FORM.findall((text or "").translate(FOLD))
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                ids = owners.get(tuple(w[k : k + n]))
                if ids:
                    hit.update(range(k, k + n))
                    found |= ids
        joined = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)))
    return out


def shingle_set(text: str | None, size: int = 5) -> frozenset:
    w = WORD.findall((text or "").translate(FOLD))
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def groups(docs, size: int = 5, percent: int = 80):
    """(id, set size, smallest id reached) per document; every pair is compared."""
    sets = [(i, shingle_set(t, size)) for i, t in docs]
    parent = {k: k for k in range(len(sets))}

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    where: dict[tuple, list[int]] = {}
    for k, (i, s) in enumerate(sets):
        if i is not None:
            for x in s:
                where.setdefault(x, []).append(k)
    shared: dict[tuple[int, int], int] = {}
    for at in where.values():
        for x in range(len(at)):
            for y in range(x):
                shared[at[y], at[x]] = shared.get((at[y], at[x]), 0) + 1
    for (x, y), both in shared.items():
        if 100 * both >= percent * (len(sets[x][1]) + len(sets[y][1]) - both):
            parent[root(x)] = root(y)
    least: dict[int, int] = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return [(i, len(s), None if i is None else least[root(k)]) for k, (i, s) in enumerate(sets)]
