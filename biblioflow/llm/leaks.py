"""Evaluation passages inside a corpus, found by winnowing (problem 9).

Of every window of WINDOW consecutive k-grams of words the one with the least
hash is kept. A shared run of K + WINDOW - 1 = SPAN words therefore always shares
a kept k-gram, so joining the kept hashes of both sides misses no such run. Each
hit is then extended word by word on the texts themselves. A test set of checked
size goes to every task, which looks up and extends where a document is read; a
larger one is joined by its hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from biblioflow.llm._text import mix, word_hashes, words
from biblioflow.session import checkpoint

SPAN = 12
K = 6
#: Most fingerprints and characters of the items that are sent to every task (24 MB of hashes, 64 MB of text).
FINGERPRINTS = 2_000_000
CHARACTERS = 16_000_000


def _winnow(h: np.ndarray, counts: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept k-gram hashes and the index of the text each one comes from."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = n - k + 1
    g = np.zeros(m, np.uint64)
    for j in range(k):
        g *= np.uint64(0x9E3779B97F4A7C15)
        g += h[j : j + m]
    g = mix(g)
    doc = np.repeat(np.arange(len(counts)), counts)
    inside = doc[k - 1 :][:m] == doc[:m]
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    g[~inside] = top
    if m < window:
        keep = inside
    else:
        w = m - window + 1
        best = g[:w].copy()
        for j in range(1, window):
            np.minimum(best, g[j : j + w], out=best)
        whole = doc[window - 1 + k - 1 :][:w] == doc[:w]
        keep = np.zeros(m, bool)
        for j in range(window):
            keep[j : j + w] |= whole & (g[j : j + w] == best)
        keep &= inside
    at = np.flatnonzero(keep)
    return g[at], doc[at]


def fingerprints(df: DataFrame, key: str, text: str, span: int = SPAN, k: int = K) -> DataFrame:
    """(key, h): the distinct winnowed k-gram hashes of each text; texts under ``span`` words give none."""

    def run(batches):
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in _slices(texts):
                h, counts = word_hashes(texts[lo:hi])
                g, doc = _winnow(h, counts, k, span - k + 1)
                new = np.ones(len(g), bool)
                new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(doc[new] + lo)), pa.array(g[new].view(np.int64))], ["key", "h"]
                )

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, h bigint")


def _slices(texts: list[str | None], size: int = 2_000_000):
    lo = total = 0
    for i, t in enumerate(texts):
        total += len(t or "")
        if total >= size:
            yield lo, i + 1
            lo, total = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def longest_shared_run(a: list[str], b: list[str], k: int = K) -> int:
    """Words in the longest run that both lists hold in order, or 0 when under k."""
    where: dict[tuple, list[int]] = {}
    for i in range(len(b) - k + 1):
        where.setdefault(tuple(b[i : i + k]), []).append(i)
    best = 0
    runs: dict[int, int] = {}
    for i in range(len(a) - k + 1):
        now = {}
        for j in where.get(tuple(a[i : i + k]), ()):
            now[j] = runs.get(j - 1, k - 1) + 1
            best = max(best, now[j])
        runs = now
    return best


class Items:
    """The items of a test set as a task needs them: sorted hashes with their item, and words on demand."""

    def __init__(self, hashes: np.ndarray, item: np.ndarray, keys: list, texts: list[list[str]]):
        order = np.lexsort((item, hashes))
        self.hashes, self.item = hashes[order], item[order]
        self.keys, self.texts = keys, texts

    def hits(self, g: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
        """Distinct (document, item) numbers that share a hash."""
        lo, hi = np.searchsorted(self.hashes, g, "left"), np.searchsorted(self.hashes, g, "right")
        n = hi - lo
        met = np.flatnonzero(n)
        n, lo = n[met], lo[met]
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(met) else met
        return sorted(set(zip(np.repeat(doc[met], n).tolist(), self.item[at].tolist())))

    def runs(self, texts: list[str | None], span: int, k: int) -> list[tuple[int, int, int]]:
        """(document number, item number, longest shared run) of every pair that shares ``span`` words."""
        out = []
        h, counts = word_hashes(texts)
        pairs = self.hits(*_winnow(h, counts, k, span - k + 1))
        mine, last = [], -1
        for doc, item in pairs:
            if doc != last:
                mine, last = words(texts[doc]), doc
            n = max((longest_shared_run(mine, w, k) for w in self.texts[item]), default=0)
            if n >= span:
                out.append((doc, item, n))
        return out


def leaked(docs: DataFrame, doc_key: str, doc_text: str, items: DataFrame, item_key: str, item_text: str, span: int = SPAN, k: int = K) -> DataFrame:
    """(item, doc) pairs that share at least ``span`` consecutive words, with the longest run.

    Columns: the two keys (as item_key, doc_key) and ``n_words``. Null and empty
    texts, null keys and items under ``span`` words match nothing; repeated rows of
    one key give one row, with the longest run of any of its texts; other columns are
    not read. A test set within FINGERPRINTS and CHARACTERS is sent to the tasks and
    no document leaves the one that reads it; both ways give the same rows.
    """
    one = items.select(F.col(item_key).alias("item"), F.col(item_text).alias("item_text")).where("item is not null and item_text is not null")
    size = one.agg(F.coalesce(F.sum(F.length("item_text")), F.lit(0)).alias("n")).first()["n"]
    mine = fingerprints(one, "item", "item_text", span, k).withColumnRenamed("key", "item").distinct()
    corpus = docs.select(F.col(doc_key).alias("doc"), F.col(doc_text).alias("doc_text")).where("doc is not null")
    kinds = f"item {one.schema['item'].dataType.simpleString()}, doc {corpus.schema['doc'].dataType.simpleString()}, n_words int"
    small = size <= CHARACTERS and mine.limit(FINGERPRINTS + 1).count() <= FINGERPRINTS
    found = _look_up(corpus, one, mine, kinds, span, k) if small else _join(corpus, one, mine, kinds, span, k)
    out = found.groupBy("item", "doc").agg(F.max("n_words").alias("n_words"))
    return out.select(F.col("item").alias(item_key), F.col("doc").alias(doc_key), "n_words")


def _look_up(corpus: DataFrame, one: DataFrame, mine: DataFrame, kinds: str, span: int, k: int) -> DataFrame:
    """Pairs of a test set of checked size, found in the pass that reads the documents."""
    texts: dict = {}
    for r in one.distinct().collect():
        texts.setdefault(r["item"], []).append(words(r["item_text"]))
    keys = list(texts)
    number = {key: i for i, key in enumerate(keys)}
    prints = mine.collect()
    hashes = np.array([r["h"] for r in prints], np.int64).view(np.uint64)
    known = corpus.sparkSession.sparkContext.broadcast(Items(hashes, np.array([number[r["item"]] for r in prints], np.int64), keys, list(texts.values())))

    def run(batches):
        found = known.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in _slices(texts):
                got = found.runs(texts[lo:hi], span, k)
                if got:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([found.keys[i] for _, i, _ in got], item_type), batch.column(0).take(pa.array([d + lo for d, _, _ in got])), pa.array([n for *_, n in got], pa.int32())],
                        ["item", "doc", "n_words"],
                    )

    item_type = to_arrow_type(one.schema["item"].dataType)
    return corpus.mapInArrow(run, kinds)


def _join(corpus: DataFrame, one: DataFrame, mine: DataFrame, kinds: str, span: int, k: int) -> DataFrame:
    """Pairs of a test set of any size: hashes meet first, then the texts of the hits.

    Only hashes that stand in an item leave the first join, so a passage that stands in
    a third of all documents costs one row for each of them; the hits are written,
    and documents without any do not reach the second join.
    """
    theirs = fingerprints(corpus, "doc", "doc_text", span, k).withColumnRenamed("key", "doc")
    hits = checkpoint(theirs.join(mine, "h").select("item", "doc").distinct())
    text = corpus.join(hits.select("doc").distinct(), "doc", "left_semi")
    pairs = text.join(hits, "doc").join(one, "item").select("item", "doc", "doc_text", "item_text")

    def extend(frames):
        last, mine = None, []
        for pdf in frames:
            got = []
            for item, doc, d, t in pdf.itertuples(index=False):
                if d is not last:
                    last, mine = d, words(d)
                n = longest_shared_run(mine, words(t), k)
                if n >= span:
                    got.append((item, doc, n))
            yield pd.DataFrame(got, columns=["item", "doc", "n_words"])

    return pairs.mapInPandas(extend, kinds)
