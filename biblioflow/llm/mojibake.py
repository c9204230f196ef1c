"""Round-trip repair of text decoded with the wrong encoding (problem 7).

A suspect text is encoded again under each legacy encoding it may have been
decoded with and strictly decoded as the encoding it was meant to have; the
candidate with the least garbling cost is taken when the cost drops, and the step
repeats for nested layers. Where only a stretch is garbled, the same is done for
each run of non-ASCII characters. Accents torn off their letters are put back.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of the languages at hand, and marks used in print.
LETTERS = "áàâãäçéèêëíîïñóôõöúùûüœæ"
MARKS = "–—‘’“”„«»‹›…•·°ºª¿¡§€™©®±×÷\u00a0\u00ad\u200b\u2009\u202f\u3000\ufeff¬−"
_LETTERS = set(LETTERS + LETTERS.upper())
_MARKS = set(MARKS)
_TORN = "´`ˆ˜¸¨"
_COMBINE = {"´": "\u0301", "`": "\u0300", "ˆ": "\u0302", "˜": "\u0303", "¸": "\u0327", "¨": "\u0308", "~": "\u0303", "^": "\u0302"}
_RUN = re.compile(r"[^\x00-\x7f]+(?:[^\x00-\x7f]| (?=[^\x00-\x7f]))*")
_ENTITY = re.compile(r"&(?:[A-Za-z][A-Za-z0-9]{1,30}|#\d{1,6}|#x[0-9A-Fa-f]{1,5});")
_LOST = re.compile(r"(?<![\w/:.=&?%-])\?{2,}(?=[^\W\d_])|(?<=[^\W\d_])\?+(?=[a-zà-öø-ÿ])|(?<=[a-zà-ÿ])\?{2,}(?![?!])")
_URL = re.compile(r"(?:https?://|www\.)\S+")
_ENCODINGS = ("cp1252", "latin-1", "mac_roman", "cp850", "cp437", "cp1251", "cp1250", "iso8859-15")
_SINGLE = tuple((a, "cp1252") for a in ("cp850", "cp437", "cp1251", "mac_roman", "cp1250")) + (
    ("cp1252", "cp850"), ("cp1252", "mac_roman"), ("latin-1", "cp850"), ("latin-1", "mac_roman"), ("cp1252", "cp437"),
)
#: What no clean text holds: one pass of Arrow's automaton, linear in the text, picks the fields worth a closer look.
SUSPECT = (
    "[^\\x00-\\x7F" + LETTERS + LETTERS.upper() + "–—‘’“”„«»…•·°ºª¿¡§€\u00a0\u00ad\u200b\u3000¬\u0300-\u0304\u0308\u0327]"
    "|[a-zà-öø-ÿ][À-ÖØ-Þ]|[ÃÂ][^A-Za-zÀ-ÿ]|[ÃÂÄÅ][^\\x00-\\x7FÀ-ÿ]|[^\\x00-\\x7F][–—‘’“”„«»…•·°º¿¡§€¬\u00a0\u00ad][^\\s]"
    "|[A-Za-z][°º¿¡§€·«»“„][A-Za-zÀ-ÿ]|(^|[^A-Za-zÀ-ÿ\u0300-\u036f])[\u0300-\u036f]"
    "|&[A-Za-z#][A-Za-z0-9]{1,30};|[`~^][A-Za-z]|[A-Za-zÀ-ÿ]\\?+[A-Za-zÀ-ÿ]|\\?\\?"
)


def garble_cost(text: str) -> float:
    """How unlike clean text the non-ASCII characters stand; 0 for plain ASCII."""
    cost = 0.0
    n = len(text)
    for m in re.finditer(r"[^\x00-\x7f]", text):
        i, c = m.start(), m.group()
        a = text[i - 1] if i else " "
        b = text[i + 1] if i + 1 < n else " "
        if c in _LETTERS:
            if c.isupper() and (a.islower() or (b.islower() and a.isalpha() and not a.isupper())):
                cost += 2
            elif c in "ÃÂ" and not b.isalpha() and not a.isalpha() or c in "ÃÂÄÅ" and not b.isascii() and not b.isalpha():
                cost += 2
            elif c in "äöëïùüœæûîÄÖËÏÙÜŒÆÛÎ":
                cost += 0.25
            continue
        if c in _MARKS:
            if a.isalpha() and b.isalpha() and c not in "’‘\u00ad·\u00a0\u200b–—¬" or not a.isascii() and not b.isspace() and a not in _MARKS | _LETTERS:
                cost += 3
            elif c in "’‘\u00ad·\u00a0¬" and a in "ÃÂÄÅ" or c == "·" and a.isalpha() and b.isalpha():
                cost += 2
            continue
        if unicodedata.combining(c):
            cost += 0 if a.isalpha() or unicodedata.combining(a) else 2
            continue
        if c == "\ufffd" or "\x80" <= c < "\xa0":
            cost += 4
        elif c.isalpha() and "\u00c0" <= c <= "\u024f":
            cost += 1.5
        else:
            cost += 3
    return cost


def _raw(text: str, enc: str) -> bytes | None:
    """Encode; characters a Windows table lacks but a decoder passed through keep their byte."""
    try:
        return text.encode(enc)
    except UnicodeEncodeError:
        if not enc.startswith("cp125"):
            return None
    out = bytearray()
    for c in text:
        try:
            out += c.encode(enc)
        except UnicodeEncodeError:
            if not "\x80" <= c < "\xa0":
                return None
            out.append(ord(c))
    return bytes(out)


def _candidates(text: str, whole: bool):
    for enc in _ENCODINGS:
        raw = _raw(text, enc)
        if raw is None:
            continue
        try:
            yield raw.decode("utf-8"), 0.0
        except UnicodeDecodeError:
            pass
    if whole:
        for a, b in _SINGLE:
            raw = _raw(text, a)
            if raw is not None:
                try:
                    yield raw.decode(b), 0.5
                except UnicodeDecodeError:
                    pass


def _best(text: str, whole: bool) -> str:
    cost = garble_cost(text)
    best, least = text, cost
    single = False
    for got, extra in _candidates(text, whole):
        if extra and best != text and not single:
            break  # a strict multi-byte decoding that helps is never chance
        if got != text and (c := garble_cost(got) + extra) < least:
            best, least, single = got, c, extra > 0
    return best


def _runs(text: str) -> str:
    def fix(m: re.Match) -> str:
        run = m.group()
        a = text[max(0, m.start() - 1) : m.start()]
        b = text[m.end() : m.end() + 1]
        before = garble_cost(a + run + b)
        best, least = run, before
        for variant in (run, run + "\xa0") if b == " " else (run,):
            for got, _ in _candidates(variant, False):
                if got != run and (c := garble_cost(a + got + b)) < least:
                    best, least = got, c
        return best

    return _RUN.sub(fix, text)


_BEFORE = re.compile(rf"([{_TORN}])([A-Za-zı])")
_AFTER = re.compile(rf"([A-Za-zı])([{_TORN}])")


_USUAL = re.compile("ão|õe|ãe")
_ODD = re.compile("aõ|oẽ|oã|aẽ|[aeo]ũ")


def _attach(text: str) -> str:
    """Put torn-off accents back, on the side that gives more real letters."""

    def join(letter: str, mark: str) -> str | None:
        got = unicodedata.normalize("NFC", ("i" if letter == "ı" else letter) + _COMBINE[mark])
        return got if len(got) == 1 and got in _LETTERS else None

    text = re.sub(r"([cC])¸", lambda m: "ç" if m.group(1) == "c" else "Ç", text)
    text = re.sub(r"¸([cC])", lambda m: "ç" if m.group(1) == "c" else "Ç", text)
    ahead = sum(1 for m in _BEFORE.finditer(text) if join(m[2], m[1]))
    behind = sum(1 for m in _AFTER.finditer(text) if join(m[1], m[2]))
    before = _BEFORE.sub(lambda m: join(m[2], m[1]) or m[0], text)
    after = _AFTER.sub(lambda m: join(m[1], m[2]) or m[0], text)
    # where both sides compose, usual vowel pairs decide
    ahead += 2 * len(_USUAL.findall(before)) - 2 * len(_ODD.findall(before))
    behind += 2 * len(_USUAL.findall(after)) - 2 * len(_ODD.findall(after))
    text = before if ahead >= behind else after
    return text.replace("ı", "i")


def _torn(text: str) -> bool:
    return bool(re.search(rf"[{_TORN}][A-Za-zı]|[A-Za-zı][´ˆ˜¸¨]|[A-Za-z]`[A-Za-z]|(?:^|[^\w\u0300-\u036f])[\u0300-\u036f]", text))


def repair(text: str | None) -> tuple[str | None, bool, int]:
    """(restored text, was garbled, layers undone). Null and empty come back as they are."""
    if not text:
        return text, False, 0
    found, layers = False, 0
    if _torn(text):
        fixed = _attach(text)
        found, text = fixed != text or bool(re.search(r"[´ˆ˜¸¨]", text)), fixed
    # every step shortens the text or, at one length, lowers its cost, so this ends
    while True:
        got = text
        if _ENTITY.search(got):
            plain = html.unescape(got)
            undone = _best(plain, True)
            undone = _runs(undone) if undone == plain else undone
            if undone != plain:
                got = undone
        if got == text:
            got = _best(text, True)
        if got == text:
            got = _runs(got)
        if got == text:
            break
        text, found, layers = got, True, layers + 1
    if not found and ("\ufffd" in text or _LOST.search(_URL.sub(" ", text)) or re.search("[\x80-\x9f]", text)):
        found = True
    return text, found, layers


def restore(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, restored, layers) of every garbled field, one row per row and field.

    Texts that a regular expression proves clean are never made into Python strings,
    so the cost follows the number of suspects. Nothing is shuffled. Null and empty
    fields give no row; repeated rows repeat, callers take distinct keys. Text that
    cannot be restored (replacement characters, question marks for letters) is
    reported with what could be repaired.
    """

    def run(batches):
        for batch in batches:
            keys = batch.column(0)
            for at, field in enumerate(fields, 1):
                texts = batch.column(at)
                suspect = pc.fill_null(pc.match_substring_regex(texts, SUSPECT), False)
                got = [repair(t) for t in texts.filter(suspect).to_pylist()]
                if not got:
                    continue
                out = pa.RecordBatch.from_arrays(
                    [keys.filter(suspect), pa.array([field] * len(got), pa.string()), pa.array([g[0] for g in got], pa.string()), pa.array([g[2] for g in got], pa.int32())],
                    ["key", "field", "restored", "layers"],
                )
                yield out.filter(pa.array([g[1] for g in got], pa.bool_()))

    kind = df.schema[key].dataType.simpleString()
    cells = [F.col(f).cast("string").alias(f"text{i}") for i, f in enumerate(fields)]
    out = df.select(F.col(key).alias("key"), *cells).mapInArrow(run, f"key {kind}, field string, restored string, layers int")
    return out.withColumnRenamed("key", key)
