"""Sentence alignment of two rough translations in bitext space (problem 3).

Tokens of the two texts span a plane. Points of correspondence are equal numbers
and names and word pairs of a lexicon that is counted over all articles.

The search starts at the origin. A rectangle anchored at the frontier, the end of
the last chain, grows along the main diagonal sentence by sentence until it holds an
acceptable chain: points one per row and column, freed of those in crowded rows and
columns, near one line whose slope is that of the plane, that cover enough of what a
statement can give. The frontier moves to the chain's end and the search goes on;
what the map leaves uncovered is then searched for inversions, chains anywhere in
the plane. Inside a chain one inversion, two clauses that change places, is followed
along two parallel lines. Points of a chain leave the plane, so the noise they cast
goes with them and a sentence with two statements may chain once more. Chains and
inversions become sentence pairs.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.llm import mojibake
from biblioflow.session import checkpoint

#: A word enters the lexicon when it is in at least this share of the pairs (and 3).
SHARE = 1 / 2000
KEEP = 24
LEAST_GAIN = 0.12
#: Points that a row or column of a rectangle may hold before it counts as crowded, how far from its line a point
#: may lie, and how far apart the lines of an inversion are, in shares of the rectangle.
CROWD = 3
DISPERSAL = 0.5
APART = 0.25
#: A rectangle so many times longer than wide is shrunk, to so many times the length that its other side asks for.
LONG = 1.4
ROOM = 1.4
#: Words of both texts that share so many first letters, and are longer, are cognates.
STEM = 4
COVER = 0.39
#: Pairs of other articles' abstracts reach 0.67 on sf0.1, the best pair of a translation without numbers and names 0.73.
SURE = 0.7
_SENTENCE = re.compile(r"\S.*?(?:[.!?]+(?=\s|$)|$)", re.S)
_SUSPECT = re.compile(mojibake.SUSPECT)
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+")


def split_sentences(text: str | None) -> list[str]:
    """Sentences as stored; one ends at . ! or ? before white space or the end."""
    return [m.group() for m in _SENTENCE.finditer(text or "")]


_CUT = re.compile(r"(?<=\w)(?:[-¬]\s*\n\s*|\xad\s*)(?=\w)")
_APART = re.compile(r"(?<!\w)([^\W\d_](?: [^\W\d_]){3,})(?!\w)")
_MARKS = re.compile(r"[\u0300-\u036f]+")


def _fold(text: str) -> str:
    return text if text.isascii() else _MARKS.sub("", unicodedata.normalize("NFD", text))


def sentence_tokens(text: str | None) -> list[list[str]]:
    """Folded words and numbers (decimal commas as points) of every sentence as stored."""
    text = text or ""
    garbled = bool(_SUSPECT.search(text)) if not text.isascii() or "&" in text or "?" in text else False
    cut = "\n" in text or "\xad" in text or "¬" in text
    out = []
    for s in split_sentences(text):
        if garbled:
            s = mojibake.repair(s)[0]
        if cut:
            s = _CUT.sub("", s)
        s = _APART.sub(lambda m: m.group().replace(" ", ""), s)
        out.append([t.replace(",", ".") if t[0].isdigit() else t for t in _TOKEN.findall(_fold(s.lower()))])
    return out


def sentence_anchors(text: str | None) -> list[list[str]]:
    """Numbers and names (capitalised words after another word) of every sentence as stored."""
    return [sorted(_names(s)) for s in split_sentences(text)]


def same_article(pairs: list[tuple[int, int, float]], left: list[list[str]], right: list[list[str]], lexicon: Lexicon) -> bool:
    """Whether aligned pairs speak for one article, given the anchors of all sentences of both texts.

    Only pairs are asked, so sentences that either text omits or adds do not count. A pair
    agrees when it shares an anchor and differs when both sides have anchors and share none
    (a translated word is no anchor). A decimal or a name in common shows one article,
    other pairs do when one of them is covered for certain, unless more pairs differ.
    """
    agree = differ = strong = 0
    for p, q, _ in pairs:
        x, y = set(left[p - 1]), set(right[q - 1])
        both = x & y
        agree += bool(both)
        strong += any(not t.isdigit() for t in both)
        differ += not both and bool(x - lexicon.table.keys()) and bool(y - lexicon.back.keys())
    return strong > differ or agree >= differ and any(s >= SURE for _, _, s in pairs)


def _names(text: str) -> set[str]:
    flat = _fold(text)
    return {m.group(1).lower() for m in re.finditer(r"(?<=[^\W_.!?]\s)([A-Z][a-z]{3,})", flat)} | {
        m.group().replace(",", ".") for m in re.finditer(r"\d+(?:[.,]\d+)*", flat)
    }


def lexicon(texts: DataFrame, share: float = SHARE) -> dict[str, dict[str, float]]:
    """{word: {translation: weight}} over every row of texts(a, b), arrays of sentences of tokens.

    The weight is how much likelier the right word is where the left word stands than
    elsewhere. At most KEEP translations of at most (mean words / share) words.
    """
    total = texts.count()
    sides = [texts.select(F.lit(k).alias("side"), F.explode(F.array_distinct(F.flatten(c))).alias("word")) for k, c in ((0, "a"), (1, "b"))]
    words = sides[0].unionByName(sides[1]).where(~F.col("word").rlike("^[0-9]")).groupBy("side", "word").agg(F.count("*").alias("n"))
    floor = max(3, share * total)
    vocabulary = words.where(F.col("n") >= floor).orderBy("side", "word").collect()
    ids = [{r["word"]: i for i, r in enumerate(v for v in vocabulary if v["side"] == side)} for side in (0, 1)]
    counts = [np.array([r["n"] for r in vocabulary if r["side"] == side], float) for side in (0, 1)]
    if not ids[0] or not ids[1]:
        return {}
    wide = len(ids[1])
    known = texts.sparkSession.sparkContext.broadcast(ids)

    def together(frames):
        x, y = known.value
        for pdf in frames:
            for lo in range(0, len(pdf), 1000):
                codes = []
                for a, b in zip(pdf["a"][lo : lo + 1000], pdf["b"][lo : lo + 1000]):
                    i = np.array(sorted({x[t] for s in a for t in s if t in x}), np.int64)
                    j = np.array(sorted({y[t] for s in b for t in s if t in y}), np.int64)
                    codes.append((i[:, None] * wide + j[None, :]).reshape(-1))
                u, n = np.unique(np.concatenate(codes), return_counts=True)
                yield pd.DataFrame({"x": u // wide, "y": u % wide, "n": n})

    joint = texts.mapInPandas(together, "x long, y long, n long").groupBy("x", "y").agg(F.sum("n").alias("n"))
    side = texts.sparkSession.createDataFrame(pd.DataFrame({"x": np.arange(len(counts[0])), "nx": counts[0]}))
    other = texts.sparkSession.createDataFrame(pd.DataFrame({"y": np.arange(wide), "ny": counts[1]}))
    gain = F.col("n") / F.col("nx") - F.col("ny") / F.lit(float(total))
    strong = joint.where("n >= 3").join(side, "x").join(other, "y").withColumn("gain", gain).where(F.col("gain") > LEAST_GAIN)
    rank = F.row_number().over(Window.partitionBy("x").orderBy(F.desc("gain"), "y"))
    best = strong.withColumn("rank", rank).where(F.col("rank") <= KEEP).select("x", "y", "gain").collect()
    name_x, name_y = list(ids[0]), list(ids[1])
    out: dict[str, dict[str, float]] = {}
    for r in best:
        out.setdefault(name_x[r["x"]], {})[name_y[r["y"]]] = float(r["gain"])
    return out


def _points(left: list[list[str]], right: list[list[str]], table: dict[str, dict[str, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Weight of correspondence of every left token with every right token, and which are sure: numbers, names, cognates.

    Words of one turn of phrase occur together and translate each other alike in the
    lexicon, so only sure points say where in a sentence a word went.
    """
    a, b = [t for s in left for t in s], [t for s in right for t in s]
    where: dict[str, list[int]] = {}
    for j, t in enumerate(b):
        where.setdefault(t, []).append(j)
    rows: dict[str, list[float]] = {}
    for t in a:
        if t in rows:
            continue
        row = rows[t] = [0.0] * len(b)
        known = table.get(t)
        if t in where and (t[0].isdigit() or (known is None and len(t) > 3)):
            for j in where[t]:
                row[j] = 1.5 if t[0].isdigit() else 1.0
        if known:
            for u in known.keys() & where.keys():
                for j in where[u]:
                    row[j] = max(row[j], known[u])
    w = np.array([rows[t] for t in a], np.float32).reshape(len(a), len(b))
    stems: dict[str, list[int]] = {}
    for j, t in enumerate(b):
        if len(t) > STEM:
            stems.setdefault(t[:STEM], []).append(j)
    sure = w >= 1.0
    for i, t in enumerate(a):
        if len(t) > STEM:
            sure[i, stems.get(t[:STEM], [])] = True
    return w, sure & (w > 0)


def _chain(w: np.ndarray, sure: np.ndarray, slope: float) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(points of the best chain in one rectangle, those and the noise beside them), [] where there are none.

    Of a crowded row or column the points nearest to the rectangle's diagonal are
    kept. The chain takes one point per row and column, sure and strong ones and those
    near the diagonal first; its sure points are then held to one line of the plane's
    slope, or to two where an inversion fits better; those off the lines cover nothing.
    """
    i, j = np.nonzero(w)
    if not len(i):
        return [], []
    off = np.abs(i / max(1, w.shape[0] - 1) - j / max(1, w.shape[1] - 1))
    for line in (i, j):
        if np.bincount(line).max() > CROWD:
            near = np.lexsort((off, line))
            start = np.concatenate([[True], line[near][1:] != line[near][:-1]])
            rank = np.arange(len(near)) - np.maximum.accumulate(np.where(start, np.arange(len(near)), 0))
            keep = np.sort(near[rank < CROWD])
            i, j, off = i[keep], j[keep], off[keep]
            break
    order = np.lexsort((j, i, -(w[i, j] + 0.5 * sure[i, j] - 0.1 * off)))
    rows, columns, out = set(), set(), []
    for k in order.tolist():
        x, y = int(i[k]), int(j[k])
        if x not in rows and y not in columns:
            rows.add(x)
            columns.add(y)
            out.append((x, y))
    out.sort()
    placed = _on_lines([x for x in out if sure[x]], w.shape, slope)
    return [x for x in out if not sure[x]] + placed, out


def _shrunk(w: np.ndarray, slope: float) -> np.ndarray:
    """A rectangle much longer than its other side allows, cut to the stretch that its points crowd into.

    A sentence that merges two statements is as long as both translations; each of
    them fills one stretch of it, and what lies beside that belongs to the other.
    """
    for axis, long, short in ((0, w.shape[0] * slope, w.shape[1]), (1, w.shape[1] / slope, w.shape[0])):
        if long <= LONG * short:
            continue
        size = int(ROOM * (short / slope if axis == 0 else short * slope)) + 1
        if size >= w.shape[axis]:
            continue
        sums = np.convolve(w.max(1 - axis), np.ones(size), "valid")
        start = int(sums.argmax())
        out = np.zeros_like(w)
        part = (slice(start, start + size), slice(None)) if axis == 0 else (slice(None), slice(start, start + size))
        out[part] = w[part]
        return out
    return w


def _on_lines(chain: list[tuple[int, int]], shape: tuple[int, int], slope: float) -> list[tuple[int, int]]:
    """The points of a chain, sorted by x, that keep to one line of the plane's slope or, inverted, to two.

    Displacement is measured across the line in shares of the rectangle's shorter side,
    so a statement that is a part of its sentence keeps to a line as well; both readings
    are tried and the one that keeps more points wins, the single line when equal.
    """
    if len(chain) < 3:
        return chain
    side = max(1.0, min(shape[1], slope * shape[0]))
    d = [(y - slope * x) / side for x, y in chain]
    best = _within(d, range(len(d)))
    if len(best) < len(d):
        for cut in range(1, len(d)):
            head, tail = d[:cut], d[cut:]
            # what comes first in one text comes last in the other
            if sum(head) / cut - sum(tail) / len(tail) < APART:
                continue
            two = _within(d, range(cut)) + _within(d, range(cut, len(d)))
            if len(two) > len(best):
                best = two
    return [chain[k] for k in best]


def _within(d: list[float], part: range) -> list[int]:
    """The points of a part whose displacement lies within DISPERSAL of the median's."""
    middle = sorted(d[k] for k in part)[len(part) // 2]
    return [k for k in part if abs(d[k] - middle) <= DISPERSAL]


def align(original: str | None, english: str | None, table: dict[str, dict[str, float]], cover: float = COVER) -> list[tuple[int, int, float]]:
    """[(sentence number, English sentence number, cover)], numbers from 1."""
    left, known = sentence_tokens(original), Lexicon(table)
    pairs = align_tokens(left, sentence_tokens(english), known, cover)
    return pairs if same_article(pairs, sentence_anchors(original), sentence_anchors(english), known) else []


class Lexicon:
    """Translations of a word, the most each can give, and the most each right word can."""

    def __init__(self, table: dict[str, dict[str, float]]):
        self.table = table
        self.top = {t: max(row.values()) for t, row in table.items()}
        self.back: dict[str, float] = {}
        for row in table.values():
            for u, g in row.items():
                self.back[u] = min(1.0, max(self.back.get(u, 0.0), g))


def align_tokens(left: list[list[str]], right: list[list[str]], lexicon: Lexicon | dict, cover: float = COVER) -> list[tuple[int, int, float]]:
    if not any(left) or not any(right):
        return []
    lexicon = lexicon if isinstance(lexicon, Lexicon) else Lexicon(lexicon)
    table = lexicon.table
    w, sure = _points(left, right, table)
    a0 = np.cumsum([0, *map(len, left)])
    b0 = np.cumsum([0, *map(len, right)])
    a, b = [t for s in left for t in s], [t for s in right for t in s]
    # what a token can give at most; words that translate nothing count for nothing
    top_a = np.array([1.5 if t[0].isdigit() else lexicon.top.get(t, 0.6 if len(t) > 3 else 0.0) for t in a])
    top_b = np.array([1.5 if t[0].isdigit() else lexicon.back.get(t, 0.6 if len(t) > 3 else 0.0) for t in b])
    top_b = np.maximum(top_b, np.minimum(w.max(0), 1.5))
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    # omissions and additions bend the plane, a translation by itself is not more than twice as long
    slope = min(2.0, max(0.5, len(b) / len(a)))

    def measure(p: int, q: int) -> tuple[float, list[tuple[int, int]]]:
        ra, rb = slice(a0[p], a0[p + 1]), slice(b0[q], b0[q + 1])
        part = w[ra, rb] * free_a[ra, None] * free_b[None, rb]
        if not part.size:
            return 0.0, []
        # at least one side is covered; a remainder too small for a statement does not count
        sides = ((top_a[ra], free_a[ra]), (top_b[rb], free_b[rb]))
        needs = [n for n, whole in (((t * f).sum(), t.sum()) for t, f in sides) if n > 0.3 * whole and n > 1.0]
        if not needs or 1.1 * min(part.max(1).sum(), part.max(0).sum()) < cover * min(needs):
            return 0.0, []
        chain, taken = _chain(_shrunk(part, slope), sure[ra, rb], slope)
        best = sum(part[x, y] for x, y in chain) / min(needs)
        numbers_a = {a[k] for k in range(a0[p], a0[p + 1]) if free_a[k] and a[k][0].isdigit()}
        numbers_b = {b[k] for k in range(b0[q], b0[q + 1]) if free_b[k] and b[k][0].isdigit()}
        if numbers_a and numbers_b and not numbers_a & numbers_b:
            best *= 0.4
        elif numbers_a & numbers_b and (numbers_a <= numbers_b or numbers_b <= numbers_a):
            best *= 1.1
        return best, taken

    # what the chain of each rectangle can cover at most, for all rectangles at once
    full_a, full_b = [k for k, s in enumerate(left) if s], [k for k, s in enumerate(right) if s]
    by_b = np.add.reduceat(np.maximum.reduceat(w, b0[full_b], axis=1), a0[full_a], axis=0)
    by_a = np.add.reduceat(np.maximum.reduceat(w, a0[full_a], axis=0), b0[full_b], axis=1)
    need_a, need_b = float(np.add.reduceat(top_a, a0[full_a]).min()), float(np.add.reduceat(top_b, b0[full_b]).min())
    least = np.minimum.outer(np.add.reduceat(top_a, a0[full_a]), np.add.reduceat(top_b, b0[full_b]))
    likely = np.argwhere(1.1 * np.minimum(by_a, by_b) >= cover * least).tolist()
    scores = {(full_a[p], full_b[q]): m for p, q in likely if (m := measure(full_a[p], full_b[q]))[0] >= cover}
    out: list[tuple[int, int, float]] = []
    done: set[tuple[int, int]] = set()

    def accept(p: int, q: int) -> None:
        s, taken = scores.pop((p, q))
        out.append((p + 1, q + 1, round(float(s), 4)))
        done.add((p, q))
        for x, y in taken:
            free_a[a0[p] + x] = False
            free_b[b0[q] + y] = False
        for key in [k for k in scores if k[0] == p or k[1] == q]:
            if (again := measure(*key))[0] >= cover:
                scores[key] = again
            else:
                del scores[key]
        # a sentence with less left to cover may now be covered by another one
        near = []
        for whole, free, others, keys in (
            (top_a[a0[p] : a0[p + 1]], free_a[a0[p] : a0[p + 1]], need_b, [(p, y) for y in range(len(right))]),
            (top_b[b0[q] : b0[q + 1]], free_b[b0[q] : b0[q + 1]], need_a, [(x, q) for x in range(len(left))]),
        ):
            left_over = float((whole * free).sum())
            if left_over > 0.3 * whole.sum() or 1.1 * left_over >= cover * max(1.0, 0.3 * others):
                near += keys
        for key in near:
            if key not in done and key not in scores and (again := measure(*key))[0] >= cover:
                scores[key] = again

    def clear(p: int, q: int) -> bool:
        """No rectangle of the same row or column, on the map or off it, holds a better chain."""
        own = round(scores[p, q][0], 4)
        return all(round(m[0], 4) <= own for k, m in scores.items() if (k[0] == p) != (k[1] == q))

    def reach(p: int, q: int, i: int, j: int) -> tuple[float, int, int]:
        """How far the rectangle anchored at sentences i, j must grow along the main diagonal to take in p, q."""
        return max((a0[p + 1] - a0[i]) / a0[-1], (b0[q + 1] - b0[j]) / b0[-1]), p, q

    i = j = 0
    while ahead := [k for k in scores if k[0] >= i and k[1] >= j and clear(*k)]:
        i, j = min(ahead, key=lambda k: reach(*k, i, j))
        accept(i, j)
    while scores:  # inversions: the strongest first, equal ones nearest to the diagonal of the plane
        accept(*max(scores, key=lambda k: (round(scores[k][0], 4), -abs((a0[k[0]] + a0[k[0] + 1]) / a0[-1] - (b0[k[1]] + b0[k[1] + 1]) / b0[-1]), -k[0], -k[1])))
    return sorted(out)


def align_table(df: DataFrame, key: str, left: str, right: str, cover: float = COVER) -> DataFrame:
    """(key, orig_no, en_no, cover) for every aligned pair of sentences.

    Rows with a null or blank side give nothing; repeated rows of a key count once;
    a sentence may be in no pair or in several. The lexicon is the only thing held
    on the driver and its size is bounded by SHARE and KEEP.
    """
    both = df.select(F.col(key).alias("key"), F.col(left).alias("a"), F.col(right).alias("b"))
    both = both.where(F.col("a").rlike(r"\w") & F.col("b").rlike(r"\w") & F.col("key").isNotNull()).dropDuplicates(["key"])
    kind = df.schema[key].dataType.simpleString()

    def prepare(frames):
        for pdf in frames:
            rows = []
            for k, a, b in zip(pdf["key"], pdf["a"], pdf["b"]):
                rows.append((k, sentence_tokens(a), sentence_tokens(b), sentence_anchors(a), sentence_anchors(b)))
            yield pd.DataFrame(rows, columns=["key", "a", "b", "anchors_a", "anchors_b"])

    # by the row count, so that a task aligns some 2,000 articles however large the table
    parts = max(3 * df.sparkSession.sparkContext.defaultParallelism, df.count() // 2000)
    spread = both.repartition(parts, "key")
    tokens = checkpoint(spread.mapInPandas(prepare, f"key {kind}, a array<array<string>>, b array<array<string>>, anchors_a array<array<string>>, anchors_b array<array<string>>"))
    table = df.sparkSession.sparkContext.broadcast(lexicon(tokens.select("a", "b")))

    def run(frames):
        known = Lexicon(table.value)
        for pdf in frames:
            rows = []
            for k, a, b, x, y in zip(pdf["key"], pdf["a"], pdf["b"], pdf["anchors_a"], pdf["anchors_b"]):
                pairs = align_tokens([list(s) for s in a], [list(s) for s in b], known, cover)
                if same_article(pairs, x, y, known):
                    rows += [(k, *m) for m in pairs]
            yield pd.DataFrame(rows, columns=["key", "orig_no", "en_no", "cover"])

    out = tokens.mapInPandas(run, f"key {kind}, orig_no int, en_no int, cover double")
    return out.withColumnRenamed("key", key)
