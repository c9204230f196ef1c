"""Language of titles and abstracts by a string kernel (problem 5).

Texts are compared by which character n-grams (lengths 2 to 4) they contain: the
blended-spectrum presence kernel, normalised by the two set sizes. A Nyström map
on landmark sentences turns it into features, and one-versus-rest kernel ridge
regression scores the languages. A kernel row times the map times the weights is a
product of three matrices; multiplied from the right once, it leaves one weight row
per n-gram, so a batch of sentences is scored by one sparse-by-dense product.

The classifier is fitted on a bounded sample (SAMPLE labelled abstracts of each
language, least hash of the key first) and refitted once on the sentences whose
predicted language is clear, which removes wrong labels. Everything is scored.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.llm import mojibake
from biblioflow.llm._text import mix

LANGUAGES = ("pt", "en", "es", "fr")
SAMPLE = 400
LANDMARKS = 256
RIDGE = 1e-2
SIZE = 1 << 18
GRAMS = (2, 3, 4)
MARGIN = 0.25
# Codes and names under which a label stands for a language.
NAMES = {
    "pt": ("pt", "por", "portugues", "portuguese", "portugais", "portugiesisch", "ptbr", "brazilian portuguese"),
    "en": ("en", "eng", "ingles", "english", "anglais", "englisch"),
    "es": ("es", "spa", "espanol", "espanhol", "spanish", "espagnol", "castellano", "castelhano", "spanisch"),
    "fr": ("fr", "fra", "fre", "frances", "francais", "french", "franzosisch"),
}
OTHER = ("de", "deu", "ger", "german", "it", "ita", "italian", "italiano", "la", "lat", "nl", "ca", "cat", "gl", "glg")


@lru_cache(maxsize=4096)
def fold_label(label: str | None) -> str:
    """The language a label stands for, '' where it is missing or unknown, '?' for another language."""
    text = unicodedata.normalize("NFD", (label or "").strip().lower())
    text = "".join(c for c in text if not unicodedata.combining(c))
    for part in (text, re.split(r"[-_\s(/.,;]", text)[0]):
        for lang, names in NAMES.items():
            if part in names:
                return lang
        if part in OTHER:
            return "?"
    return ""


_SUSPECT = re.compile(mojibake.SUSPECT)
_FURNITURE = re.compile(
    r"\f[^\n]*|^[^\w\n]*(?:p(?:\.|ág(?:ina|\.)?|age|\.)?\s*)?\d+(?:\s*[|/]\s*\d+)?[^\w\n]*$"
    r"|^(?=[^\n]*\b(?:\d{3,4}|[IVXL]{2,})\b)(?:[^\n.!?;]*\s)?[A-ZÁ-Ú][\wÀ-ÿ]+(?:\s+(?:d[aeo]s?|of|on|the|e|y|para|na|no|las|los|et|del)\b|\s+[A-ZÁ-Ú][\wÀ-ÿ]+)*\s*[,–—|-]?\s*\d{4}(?:\s+\d+)?\s*$",
    re.M,
)
_QUOTED = re.compile(r"\"[^\"]*\"|“[^”]*”|«[^»]*»")
_END = re.compile(r"(?<=[.!?])\s+")
_LEAD = re.compile(r"^\s*(?:resumo|abstract|resumen|résumé|resume|summary)\s*[:.—–-]\s*", re.I)


def sentences(text: str) -> list[str]:
    """Whole sentences, without furniture, quoted terms and names inside them."""
    if _SUSPECT.search(text):
        text = mojibake.repair(text)[0]
    text = unicodedata.normalize("NFC", text)
    text = _FURNITURE.sub(" ", text)
    text = re.sub(r"(?<=\w)(?:[-¬]\s*\n\s*|­\s*)(?=\w)", "", text)
    text = re.sub(r"(?<!\w)(\w(?: \w){3,})(?!\w)", lambda m: m.group().replace(" ", ""), text)
    out = []
    for s in _END.split(_LEAD.sub("", text)):
        s = plain(s)
        if len(s) >= 15 and s.count(" ") >= 2:
            out.append(s)
    return out


def plain(s: str) -> str:
    """Lower-case words of a sentence; later capitalised words are names unless all is in capitals."""
    s = _QUOTED.sub(" ", s)
    upper = sum(c.isupper() for c in s) > 0.5 * max(1, sum(c.isalpha() for c in s))
    found = re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)*", s)
    kept = [w for i, w in enumerate(found) if upper or i == 0 or not w[0].isupper() or len(w) == 1]
    return " ".join(kept).lower().replace("’", "'")


def gram_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each distinct n-gram, text index), sorted by text."""
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = "".join(f" {t} \n" for t in texts)
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    line = cps == 10
    text = np.cumsum(line) - line
    codes = []
    for n in GRAMS:
        m = len(cps) - n + 1
        if m < 1:
            continue
        g = np.full(m, n, np.uint64)
        bad = np.zeros(m, bool)
        for j in range(n):
            g = g * np.uint64(0x100000001B3) + cps[j : j + m]
            bad |= line[j : j + m]
        code = (mix(g) >> np.uint64(46)).astype(np.int64)
        codes.append((text[:m][~bad] << 18) | code[~bad])
    both = np.unique(np.concatenate(codes))
    return both & (SIZE - 1), both >> 18


def _dense(code: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.bincount(text, minlength=n).astype(np.float32)
    return code, text, 1.0 / np.sqrt(np.maximum(size, 1))


def fit(texts: list[str], labels: list[int], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> np.ndarray:
    """One weight row (a column per language) for every n-gram bucket."""
    n = len(texts)
    code, text, scale = _dense(*gram_sets(texts), n)
    used, local = np.unique(code, return_inverse=True)
    rng = np.random.Generator(np.random.PCG64(5))
    # landmarks evenly over the languages that occur
    y = np.array(labels)
    pick = np.concatenate([rng.permutation(np.flatnonzero(y == k))[: landmarks // len(LANGUAGES)] for k in range(len(LANGUAGES))])
    where = np.full(n, -1)
    where[pick] = np.arange(len(pick))
    mark = np.zeros((len(pick), len(used)), np.float32)
    mine = where[text] >= 0
    mark[where[text[mine]], local[mine]] = 1
    mark *= scale[pick][:, None]
    start = np.searchsorted(text, np.arange(n))
    kernel = np.zeros((n, len(pick)), np.float32)
    columns = np.ascontiguousarray(mark.T)
    bounds = [*start.tolist(), len(text)]
    for i in range(n):
        kernel[i] = columns[local[bounds[i] : bounds[i + 1]]].sum(0) * scale[i]
    values, vectors = np.linalg.eigh(kernel[pick].astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    phi = kernel.astype(np.float64) @ root
    target = np.where(y[:, None] == np.arange(len(LANGUAGES))[None, :], 1.0, -1.0)
    weight = 1.0 / np.maximum(np.bincount(y, minlength=len(LANGUAGES)), 1)[y]
    weight *= n / weight.sum()
    left = phi.T @ (phi * weight[:, None]) + ridge * n * np.eye(phi.shape[1])
    beta = np.linalg.solve(left, phi.T @ (target * weight[:, None]))
    table = np.zeros((SIZE, len(LANGUAGES)), np.float32)
    table[used] = columns @ (root @ beta)
    return table


def score(texts: list[str], table: np.ndarray) -> np.ndarray:
    """Scores of every text for every language."""
    n = len(texts)
    if not n:
        return np.zeros((0, len(LANGUAGES)), np.float32)
    code, text, scale = _dense(*gram_sets(texts), n)
    out = np.zeros((n, len(LANGUAGES)), np.float32)
    has = np.unique(text)
    if len(has):
        out[has] = np.add.reduceat(table[code], np.searchsorted(text, has))
    return out * scale[:, None]


def train(df: DataFrame, key: str, label: str, text: str, english: str | None = None, sample: int = SAMPLE) -> np.ndarray:
    """Fit on at most ``sample`` labelled texts a language; the sample does not depend on partitioning."""
    code = F.lower(F.regexp_replace(F.coalesce(F.col(label), F.lit("")), r"[-_].*$", ""))
    kind = F.lit(None).cast("string")
    for lang, names in NAMES.items():
        accents = F.translate(code, "áàâãéêíóôõúç" + "ñ", "aaaaeeiooouc" + "n")
        kind = F.when(accents.isin(*names), lang).otherwise(kind)
    tagged = df.select(F.col(key).alias("k"), kind.alias("lang"), F.col(text).alias("text"))
    if english:
        tagged = tagged.unionByName(df.select(F.col(key).alias("k"), F.lit("en").alias("lang"), F.col(english).alias("text")))
    tagged = tagged.where(F.col("lang").isNotNull() & (F.length("text") > 40)).withColumn("h", F.xxhash64("k"))

    def least(frames):
        held = None
        for pdf in frames:
            held = pdf if held is None else pd.concat([held, pdf])
            held = held.drop_duplicates(["k", "lang"]).sort_values(["h", "k"]).groupby("lang").head(sample)
        if held is not None:
            yield held

    few = tagged.mapInPandas(least, tagged.schema).dropDuplicates(["k", "lang"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "k"))
    got = few.withColumn("rank", rank).where(F.col("rank") <= sample).select("lang", "text").collect()
    texts, labels = [], []
    for lang, t in got:
        for s in sentences(t)[:12]:
            texts.append(s)
            labels.append(LANGUAGES.index(lang))
    if len(set(labels)) < 2:
        return np.zeros((SIZE, len(LANGUAGES)), np.float32)
    table = fit(texts, labels)
    s = score(texts, table)
    top = np.sort(s, 1)
    clear = np.flatnonzero(top[:, -1] - top[:, -2] > 0.2)
    if len(set(s[clear].argmax(1).tolist())) < 2:
        return table
    return fit([texts[i] for i in clear], s[clear].argmax(1).tolist())


def languages_of(parts: list[str], scores: np.ndarray, margin: float = MARGIN) -> list[tuple[str, float, int]]:
    """[(language, confidence, sentences)] of one text; doubtful sentences follow the main language."""
    if not len(scores):
        return []
    weight = np.array([len(p) for p in parts], float)
    main = int((scores * weight[:, None]).sum(0).argmax())
    order = np.sort(scores, axis=1)
    clear = order[:, -1] - order[:, -2] > margin
    allowed = np.zeros(scores.shape[1], bool)
    allowed[scores[clear].argmax(1)] = True
    allowed[main] |= not allowed.any()
    best = np.where(allowed[None, :], scores, -np.inf).argmax(1)
    out = []
    for k in np.unique(best):
        mine = best == k
        rest = np.delete(scores[mine], k, axis=1).max(1)
        gap = float((scores[mine, k] - rest).mean())
        out.append((LANGUAGES[k], round(1.0 / (1.0 + float(np.exp(-4.0 * gap))), 4), int(mine.sum())))
    return out


def identify(df: DataFrame, key: str, fields: dict[str, bool], table: np.ndarray, label: str) -> DataFrame:
    """(key, field, lang, confidence, sentences, label_lang): every language that a field is written in.

    label_lang is the language that the row's label stands for ('' for none).
    ``fields`` says for each field whether it is cut into sentences (a title is one).
    Null, empty and blank fields and those without letters give no row. Nothing is
    shuffled; the model has a fixed size (2**18 rows of four numbers).
    """
    model = df.sparkSession.sparkContext.broadcast(table)
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(s).alias("cut"), F.col(f).cast("string").alias("text")) for f, s in fields.items()])
    long = df.select(F.col(key).alias("key"), F.explode(cells).alias("c"), F.col(label).cast("string").alias("label")).where(F.col("c.text").rlike(r"\p{L}"))
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                parts, sizes = [], []
                labels = [fold_label(x) for x in part.column(4).to_pylist()]
                for cut, text in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    if cut:
                        got = sentences(text) or [plain(text)]
                    else:
                        got = [plain(unicodedata.normalize("NFC", mojibake.repair(text)[0] if _SUSPECT.search(text) else text))]
                    sizes.append(len(got))
                    parts += got
                s = score(parts, model.value)
                row, lang, conf, many, at = [], [], [], [], 0
                for i, n in enumerate(sizes):
                    for a, b, c in languages_of(parts[at : at + n], s[at : at + n]):
                        row.append(i), lang.append(a), conf.append(b), many.append(c)
                    at += n
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(lang, pa.string()), pa.array(conf, pa.float64()), pa.array(many, pa.int32()), pa.array([labels[i] for i in row], pa.string())],
                    ["key", "field", "lang", "confidence", "sentences", "label_lang"],
                )

    flat = long.select("key", "c.field", "c.cut", "c.text", "label")
    out = flat.mapInArrow(run, f"key {kind}, field string, lang string, confidence double, sentences int, label_lang string")
    return out.withColumnRenamed("key", key)
