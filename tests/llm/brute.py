"""Plain Python versions of the text operators, one text or pair at a time."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}
BENCH_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def base_figures(text: str | None) -> tuple:
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 5))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def fingerprint(text: str | None) -> int:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fingerprints: list[int], distance: int = 3) -> list[int]:
    """For each fingerprint, the place of the first that links lead to."""
    parent = list(range(len(fingerprints)))

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(fingerprints):
        for j in range(i):
            if (a ^ fingerprints[j]).bit_count() <= distance:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(parent))]


def bench_words(text: str | None) -> list[str]:
    return BENCH_WORD.findall((text or "").translate(LOWER))


def contamination(text: str | None, benchmark: list[tuple[int | None, str | None]]) -> tuple[int, int, list[str]]:
    """n_words, n_hit, items."""
    words, hit, items = bench_words(text), set(), set()
    for item, passage in benchmark:
        own = bench_words(passage)
        m = min(10, len(own))
        windows = {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if m else set()
        for i in range(len(words) - m + 1):
            if tuple(words[i : i + m]) in windows:
                hit.update(range(i, i + m))
                items.add("" if item is None else str(item))
    return len(words), len(hit), sorted(items)
