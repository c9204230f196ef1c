"""Cut oversized texts into overlapping pieces at natural boundaries (problem 10).

A text is encoded once; the tokens that start before each character give every
span its size. It is cut into atomic segments (sentences, lines, paragraphs; words
where a sentence is itself too large, tokens where a word is). Adjacent pairs wait
in a heap by the strength of the boundary between them; the weakest boundary is
merged first while the joined size, with the overlap that a piece after the first
must carry, fits the limit. Each piece then starts with the ``overlap`` tokens
before it, or with the first word among them.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioflow.llm.tokens import TOKENIZERS, encoder, safe_pieces

LIMIT = 2048
OVERLAP = 128
#: A piece may have so many tokens more than its span had in the text, as its ends cut what was encoded together.
SLACK = 6
_LINE = "\n\r\x0b\x0c\x85\u2028\u2029"
_STRONG = re.compile(rf"(?:\r\n|[{_LINE}])\s*|(?<=[.!?])[\"”»')\]]*\s+")
_WEAK = re.compile(r"(?<=[;:,])\s+|\s+")


def count_tokens(text: str, enc, limit: int | None = None) -> int:
    """Number of tokens; stops early only once the bytes left prove it is <= limit."""
    if limit is None or len(text) <= 1000:
        return sum(len(enc.encode_ordinary(p)) for p in safe_pieces(text))
    n = 0
    left = len(text.encode("utf-8", "replace"))
    for piece in safe_pieces(text, 320):
        n += len(enc.encode_ordinary(piece))
        left -= len(piece.encode("utf-8", "replace"))
        if n + left <= limit:
            return n + left
        if n > limit:
            return n
    return n


def _strength(gap: str, before: str) -> int:
    if gap == " ":
        return 3 if before in ".!?" else 2 if before in ";:," else 1
    breaks = sum(gap.replace("\r\n", "\n").count(c) for c in _LINE)
    if breaks >= 2 or "\x0c" in gap:
        return 5
    if breaks == 1:
        return 4
    if before in ".!?":
        return 3
    if before in ";:,":
        return 2
    return 1 if gap else 0


def _cuts(text: str, lo: int, hi: int, boundary: re.Pattern) -> list[tuple[int, int]]:
    """(start, strength) of the segments that begin inside lo..hi after a boundary."""
    out = []
    last = lo
    for m in boundary.finditer(text, lo, hi):
        gap, at = m.group(), m.end()
        s = _strength(gap, text[m.start() - 1] if m.start() else " ")
        # a single blank belongs to the word after it for the tokenizer
        if gap[-1:] == " " and s < 4:
            at -= 1
        if last < at < hi:
            out.append((at, s))
            last = at
    return out


@lru_cache(maxsize=4)
def _token_sizes(enc) -> np.ndarray:
    return np.array([len(b) for b in enc.decode_tokens_bytes(range(enc.n_vocab))], np.int64)


def token_counts(text: str, enc) -> np.ndarray:
    """For every character position up to the end, how many tokens of the text start before it."""
    sizes = _token_sizes(enc)
    ids = [np.array(enc.encode_ordinary(p), np.int64) for p in safe_pieces(text)]
    ends = np.cumsum(sizes[np.concatenate(ids)])
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    at = np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])
    return np.searchsorted(np.concatenate([[0], ends[:-1]]), at, "left")


def _atoms(text: str, counts: np.ndarray, limit: int) -> tuple[list[int], list[int], list[int]]:
    """Starts, token sizes and strengths of the boundary before each atom.

    Atoms are sentences and lines; one that is larger than the limit is cut at
    clauses and words, and an unbroken run that still is every limit / 8 tokens.
    """
    found: list[tuple[int, int, int]] = []
    todo = [(0, len(text), 9, 0)]
    while todo:
        a, b, f, level = todo.pop()
        n = int(counts[b] - counts[a]) if level else limit + 1
        if n <= limit or b - a == 1:
            found.append((a, n, f))
            continue
        if level < 2:
            cuts = _cuts(text, a, b, (_STRONG, _WEAK)[level])
            starts = [(a, f), *cuts]
            todo += [(x, y, g, level + 1) for (x, g), y in zip(starts, [*(c for c, _ in cuts), b])]
            continue
        step = max(1, limit // 8)
        cuts = np.searchsorted(counts[a:b], np.arange(counts[a] + step, counts[b], step)) + a
        starts = sorted({a, *(c for c in cuts.tolist() if a < c < b)})
        found += [(x, int(counts[y] - counts[x]), 0 if x > a else f) for x, y in zip(starts, [*starts[1:], b])]
    found.sort()
    return [x[0] for x in found], [x[1] for x in found], [x[2] for x in found]


def split_text(text: str | None, enc, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int, int]]:
    """[(start, own_start, stop, tokens)] in characters; own_start..stop tile the text.

    A text within the limit gives one piece; null and empty give none.
    """
    if not text:
        return []
    if count_tokens(text, enc, limit) <= limit:
        return [(0, 0, len(text), count_tokens(text, enc))]
    counts = token_counts(text, enc)
    slack = min(SLACK, (limit - overlap) // 4)
    room = limit - overlap - slack
    starts, sizes, force = _atoms(text, counts, room)
    n = len(starts)
    ends = [*starts[1:], len(text)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    size, live = sizes[:], [True] * n
    heap = [(force[i], size[i - 1] + size[i], i) for i in range(1, n)]
    heapq.heapify(heap)
    while heap:
        f, joined, i = heapq.heappop(heap)
        if not live[i]:
            continue
        p = before[i]
        if size[p] + size[i] != joined:
            heapq.heappush(heap, (f, size[p] + size[i], i))
            continue
        if joined > (limit - slack if p == 0 else room):
            continue
        size[p] = joined
        ends[p] = ends[i]
        live[i] = False
        after[p] = after[i]
        if after[i] < n:
            before[after[i]] = p
    out: list[tuple[int, int, int, int]] = []
    for i in range(n):
        if not live[i]:
            continue
        own, stop = starts[i], ends[i]
        start = own if not out else overlap_start(text, counts, out[-1][0], own, enc, overlap)
        tokens = count_tokens(text[start:stop], enc)
        while tokens > limit and start < own:  # the ends cost more than the slack
            start += 1
            tokens = count_tokens(text[start:stop], enc)
        if tokens > limit:
            raise ValueError(f"a piece of {tokens} tokens cannot be brought under {limit}")
        out.append((start, own, stop, tokens))
    return out


_EDGE = re.compile(r"(?<=\S)(?=\s)|(?<=\s)(?=\S)")


def overlap_start(text: str, counts: np.ndarray, lowest: int, own: int, enc, overlap: int) -> int:
    """Where the ``overlap`` tokens before ``own`` begin, or the first word among them does.

    Without a word boundary among them (unbroken text, a run of blanks) the start is
    the earliest character from which at most ``overlap`` tokens lead up to ``own``.
    """
    if overlap <= 0:
        return own
    at = max(lowest, int(np.searchsorted(counts[: own + 1], counts[own] - overlap)))
    if at == lowest and count_tokens(text[at:own], enc) <= overlap:
        return at
    for m in _EDGE.finditer(text, at, own):
        if lowest < m.start() < own and count_tokens(text[m.start() : own], enc) <= overlap:
            return m.start()
    while at < own and count_tokens(text[at:own], enc) > overlap:
        at += 1
    while at > lowest and count_tokens(text[at - 1 : own], enc) <= overlap:
        at -= 1
    return at


def split_oversized(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """Pieces of every text of more than ``limit`` tokens.

    Columns: key, piece (from 1), start, own_start, stop (character positions),
    n_tokens, piece_text. A piece holds at most ``limit`` tokens; pieces after the
    first repeat the ``overlap`` tokens before ``own_start``, less only to start at a
    word boundary (or, in unbroken text, where no cut gives exactly that number). Null, empty and smaller texts give no row. Texts of at most
    ``limit`` UTF-8 bytes are left out by the scan: a token is at least one byte.
    Rows delivered twice give their pieces twice; callers de-duplicate keys.
    """

    def run(frames):
        enc = encoder(name, folder)
        for pdf in frames:
            rows = []
            for k, t in zip(pdf["key"], pdf["text"]):
                if count_tokens(t, enc, limit) <= limit:
                    continue
                for i, (a, own, b, n) in enumerate(split_text(t, enc, limit, overlap), 1):
                    rows.append((k, i, a, own, b, n, t[a:b]))
            yield pd.DataFrame(rows, columns=["key", "piece", "start", "own_start", "stop", "n_tokens", "piece_text"])

    kind = df.schema[key].dataType.simpleString()
    big = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.octet_length("text") > limit)
    out = big.mapInPandas(run, f"key {kind}, piece int, start int, own_start int, stop int, n_tokens int, piece_text string")
    return out.withColumnRenamed("key", key)
