"""Vectorised word folding and hashing shared by the text operators.

A word is a maximal run of letters and digits after lower-casing and dropping
combining marks. Whole batches are handled as one code-point array: a lookup
table folds every character, and each word's 64-bit hash is a difference of
prefix sums of a polynomial, so no Python loop runs over words.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

DROP = 0xFFFFFFFF
BASE = 0x9E3779B97F4A7C15
CHUNK = 1_000_000


def _fold(cp: int) -> int:
    kept = [c for c in unicodedata.normalize("NFD", chr(cp).lower()) if not unicodedata.combining(c)]
    if not kept:
        return DROP
    if not kept[0].isalnum():
        return 0
    return ord(kept[0]) if len(kept) == 1 else cp


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    t = np.zeros(0x10000, np.uint32)
    for cp in range(0x10000):
        if not 0xD800 <= cp < 0xE000:
            t[cp] = _fold(cp)
    return t


class _Powers:
    n = 0
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _Powers.n < n:
        size = max(n, 2 * CHUNK)
        inverse = pow(BASE, -1, 1 << 64)
        for name, b in (("up", BASE), ("down", inverse)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            setattr(_Powers, name, np.multiply.accumulate(p))
        _Powers.n = size
    return _Powers.up[:n], _Powers.down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, number of words of every text)."""
    hashes, counts = [], []
    part: list[str] = []
    size = 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1]) + 1
        if size >= CHUNK:
            h, c = _hash(part)
            hashes.append(h)
            counts.append(c)
            part, size = [], 0
    if part:
        h, c = _hash(part)
        hashes.append(h)
        counts.append(c)
    if not counts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def _hash(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    cps = codepoints("\n".join(texts) + "\n")
    low = np.minimum(cps, 0xFFFF)
    f = _table()[low]
    if (cps > 0xFFFF).any():
        at = np.flatnonzero(cps > 0xFFFF)
        values, back = np.unique(cps[at], return_inverse=True)
        f[at] = np.array([_fold(int(v)) for v in values], np.uint32)[back]
    ends = np.cumsum([len(t) + 1 for t in texts])
    if (f == DROP).any():
        keep = f != DROP
        ends = np.cumsum(keep)[ends - 1]
        f = f[keep]
    word = np.concatenate([[False], f > 0])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, stop = edge[::2], edge[1::2]
    up, down = _powers(len(f) + 1)
    total = np.zeros(len(f) + 1, np.uint64)
    np.cumsum(f * up[: len(f)], out=total[1:])
    h = mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))
    counts = np.diff(np.searchsorted(start, ends), prepend=0)
    return h, counts


def words(text: str | None) -> list[str]:
    """The same words as text, for small inputs and exact checks."""
    folded = "".join(
        c for c in unicodedata.normalize("NFD", (text or "").lower()) if not unicodedata.combining(c)
    )
    return "".join(c if c.isalnum() else " " for c in folded).split()
