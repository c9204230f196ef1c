"""Repair of text taken from scanned pages (problem 6).

An averaged perceptron edits characters: at every doubtful place it predicts keep,
delete, replace, insert or join, of all five. A second one, fed with where a line stands on
the page and what it looks like, predicts which lines are page furniture; a third
one, fed with the form and the surroundings of proposed spans, does so for furniture
inside a line. All are
trained on clean texts of the table itself that are damaged on purpose, so no
labels are needed; the clean sample is bounded by SAMPLE.

Places are doubtful at every line break, where a cut mark or white space stands
between letters whose joining gives a known word, where letters stand apart, or where
undoing one known misreading turns an unknown token into a known word. An edit is made
when the editor predicts the one that the place allows; a line break that it keeps
is the bound of a paragraph. Elsewhere no evidence for an
edit exists and the text is kept without asking the editor. Known words are counted
over all rows.
"""

from __future__ import annotations

import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 1500
SHARE = 1 / 4000
ROUNDS = 5
#: Headers are far rarer in the table than among the copies made for training, so what a text has of its own
#: weighs more, unless it names a title that recurs and thus may be a header of the table.
OWN = 10
# Characters as printed and as scanners misread them.
CONFUSIONS = (
    ("o", "0"), ("l", "1"), ("i", "1"), ("s", "5"), ("a", "@"), ("e", "c"), ("i", "í"), ("ã", "ä"), ("õ", "ö"), ("m", "rn"), ("u", "ii"),
    ("li", "h"), ("ç", "c,"), ("fi", "ﬁ"), ("fl", "ﬂ"), ("b", "6"), ("g", "9"), ("w", "vv"), ("v", "\\/"), ("l", "|"), ("i", "!"), ("d", "cl"),
    ("ff", "ﬀ"), ("t", "+"), ("z", "2"), ("e", "€"), ("l", "£"), ("c", "¢"),
)
OPS = ("keep", "delete", "replace", "insert", "join")
_L = r"[^\W\d_]"
_MARK = re.compile(rf"(?<={_L})(?:(?:[-¬]|\xad)[^\S\n]*\r?\n\s*|\xad|¬\s*|- (?=[a-zß-öø-ÿ]))(?={_L})")
_GAP = r"(?:[^\S\n]|[^\S\n]?\r?\n[^\S\n]?)"
_SPACED = re.compile(
    rf"(?<![\w'’.-])(?:{_L}{_GAP}(?:[a-zß-öø-ÿ]{_GAP}){{2,}}[a-zß-öø-ÿ]|[A-ZÀ-ÖØ-Þ]{_GAP}(?:[A-ZÀ-ÖØ-Þ]{_GAP}){{2,}}[A-ZÀ-ÖØ-Þ])(?![\w'’.-])"
)
_TOKEN = re.compile(r"\S+")
_CORE = re.compile(rf"^[^\w@|!+£€¢]*(.*?)[^\w@|!+]*$", re.S)
_WORD = re.compile(rf"{_L}+(?:[-'’]{_L}+)*")


def _fold_case(word: str) -> str:
    return word.lower().replace("’", "'")


def known_words(df: DataFrame, columns: list[str], share: float = SHARE) -> dict[str, int]:
    """Counts of the words that stand at least ``share`` times as often as there are texts (and 8 times).

    Counted over all rows; at most (mean words of a text) / share entries.
    """

    def count(frames):
        held: Counter = Counter()
        for pdf in frames:
            for c in columns:
                for t in pdf[c]:
                    if t:
                        held.update(_WORD.findall(t.lower()))
            if len(held) > 1_000_000:
                yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                held = Counter()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    floor = max(8.0, share * len(columns) * df.count())
    counts = df.select(*columns).mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    kept = counts.where(F.col("n") >= floor)
    return {r["word"].replace("’", "'"): r["n"] for r in kept.select("word", "n").collect()}


SECOND = 0x5BD1E995


class Parts:
    """What may be a piece of a known word: two letters of it or more, not all. Two to four bytes a piece; one in a hundred others passes too."""

    LONGEST = 60  # letters; what is longer is no word

    def __init__(self, words):
        seen = {zlib.crc32(w[i:j].encode()) for w in words if len(w) <= self.LONGEST for i in range(len(w)) for j in range(i + 2, len(w) + 1) if j - i < len(w)}
        self.size = 1 << max(10, (16 * len(seen)).bit_length())
        bits = np.zeros(self.size, bool)
        at = np.fromiter(seen, np.int64, len(seen))
        bits[at % self.size] = True
        bits[(at * SECOND >> 16) % self.size] = True
        self.bits = np.packbits(bits, bitorder="little").tobytes()

    def __contains__(self, piece: str) -> bool:
        if len(piece) < 2:
            return False
        code = zlib.crc32(piece.encode("utf-8", "replace"))
        at = code % self.size
        if not self.bits[at >> 3] >> (at & 7) & 1:
            return False
        at = (code * SECOND >> 16) % self.size
        return bool(self.bits[at >> 3] >> (at & 7) & 1)


class Words:
    """Known words, and what each misread form of one stands for."""

    def __init__(self, counts: dict[str, int]):
        self.counts = dict(counts)
        self.misread: dict[str, tuple[str, int, str, str]] = {}
        self.often = 20 * min(counts.values(), default=0)
        for w, n in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0])):
            if len(w) < 4:
                continue
            for good, bad in CONFUSIONS:
                at = w.find(good)
                while at >= 0:
                    seen = w[:at] + bad + w[at + len(good) :]
                    if counts.get(seen, 0) * 40 <= n and seen not in self.misread:
                        self.misread[seen] = (w, at, good, bad)
                        self.counts.pop(seen, None)
                    at = w.find(good, at + 1)

        self.parts = Parts(w for w in self.counts if len(w) > 4)
        self.judged: dict[str, int] = {}

    def judge(self, token: str) -> int:
        """0: known or without any evidence; 1: may be misread or a piece of a torn word; 2: one letter."""
        if len(token) == 1:
            got = 2 if token.isalpha() else 0
        elif token.lower() in self.counts:
            got = 0
        else:
            core = _CORE.match(token).group(1).lower().replace("’", "'")
            tail = core.rpartition("'")[2]
            got = int(core not in self.counts and (core in self.misread or tail in self.misread or core in self.parts))
        if len(self.judged) < 500_000:
            self.judged[token] = got
        return got

    def doubtful(self, text: str) -> tuple[bool, bool]:
        """(whether any token needs a look, whether letters may stand apart)."""
        known, one, singles = self.judged, False, 0
        for t in text.split():
            got = known.get(t)
            if got is None:
                got = self.judge(t)
            if got == 1:
                one = True
            elif got:
                singles += 1
        return one, singles > 2

    def count(self, word: str) -> int:
        return self.counts.get(word, 0)


def _bucket(n: int) -> int:
    return min(6, len(str(n))) if n else 0


def places(text: str, words: Words) -> list[tuple[int, int, str, str, list[str]]]:
    """[(start, stop, edit, new text, features)] of the doubtful places, in order."""
    found: list[tuple[int, int, str, str, list[str]]] = []
    counts = words.counts
    some, apart = words.doubtful(text)
    marked = "\xad" in text or "¬" in text or "- " in text or "-\n" in text or "-\r" in text
    if not (some or apart or marked):
        return found

    def around(a: int, b: int) -> tuple[str, str]:
        left, right = a, b
        while left > 0 and text[left - 1].isalpha():
            left -= 1
        while right < len(text) and text[right].isalpha():
            right += 1
        return text[left:a].lower(), text[b:right].lower()

    def pair_features(kind: str, x: str, y: str) -> list[str]:
        joined = x + y
        return [
            kind, f"{kind} joined {_bucket(words.count(joined))}", f"{kind} apart {x in counts}{y in counts}", f"{kind} compound {x + '-' + y in counts}",
            f"{kind} lengths {min(len(x), 3)}{min(len(y), 3)}",
        ]

    if marked:
        for m in _MARK.finditer(text):
            x, y = around(m.start(), m.end())
            g = m.group()
            kind = ("soft" if "\xad" in g else "not" if "¬" in g else "hyphen") + ("-line" if "\n" in g else "-space" if " " in g else "")
            before = text[m.start() - 1]
            odd = "low" if before.islower() else "plain" if before.isascii() else before
            found.append((m.start(), m.end(), "delete", "", [*pair_features(kind, x, y), f"{kind} after {odd}", f"{kind} after {odd} joined {x + y in counts}"]))
    covered: list[tuple[int, int]] = []
    for m in _SPACED.finditer(text) if apart else ():
        letters = re.sub(r"\s+", "", m.group())
        a, b = m.span()
        # a torn-off tail of the spaced word may follow as ordinary letters
        known = letters.lower() in counts
        if not known and letters[1:].lower() in counts and letters[0] in "aeoyàéAEOY":
            a += len(re.match(r"\S\s+", m.group()).group())
            letters, known = letters[1:], True
        plain = all(c in "aeoyàéóèúu" for c in letters.lower())
        f = ["spaced", f"spaced known {known}", f"spaced plain {plain}", f"spaced length {min(len(letters), 8)}"]
        found.append((a, b, "delete", letters, f))
        covered.append((a, b))
    toks = [(m.start(), m.end(), m.group()) for m in _TOKEN.finditer(text)] if some else []
    bare = []
    for a, b, t in toks:
        low = t.lower()
        if low in counts:
            bare.append((a, b, low, True))
            continue
        m = _CORE.match(t)
        core = m.group(1).lower().replace("’", "'")
        bare.append((a + m.start(1), a + m.start(1) + len(core), core, core in counts))
    spans = iter(covered)
    inside = next(spans, None)
    last = -1
    for i, (a, b, w, known) in enumerate(bare):
        while inside and inside[1] <= a:
            inside = next(spans, None)
        if known or not w or inside and inside[0] <= a < inside[1]:
            continue
        hit = words.misread.get(w)
        if hit is None and "'" in w:
            head, _, tail = w.rpartition("'")
            if hit := words.misread.get(tail):
                hit = (hit[0], hit[1] + len(head) + 1, hit[2], hit[3])
        if hit and hit[3].isalpha() and hit[3].isascii() and text[a].isupper() and words.count(hit[0]) < words.often:
            hit = None  # a capitalised rare token is rather a name than a misread word
        if hit:
            good_word, at, good, bad = hit
            edit = "insert" if len(good) > len(bad) else "replace"
            kind = f"{good}<{bad}"
            odd = not bad.isalpha() or not bad.isascii()
            found.append((a + at, a + at + len(bad), edit, good, [f"misread {kind}", f"odd {odd}", f"word {_bucket(words.count(good_word))}", f"len {min(len(good_word), 8)} {odd}"]))
            continue
        if i <= last or w not in words.parts or not w.isalpha() or text[a].isupper() and not text[a:b].isupper() and w not in counts and len(w) > 6:
            continue
        # pieces of one torn word: two to five neighbours that join into a known word
        for n in (5, 4, 3, 2):
            done = False
            for s in range(max(0, i - n + 1), i + 1):
                part = bare[s : s + n]
                if len(part) < n or any(not p[2].isalpha() for p in part):
                    continue
                joined = "".join(p[2] for p in part)
                if len(joined) < 5 or joined not in counts:
                    continue
                if any(re.search(r"[^\s]", text[p[1] : q[0]]) for p, q in zip(part, part[1:])):
                    continue
                lone = sum(not p[3] for p in part)
                f = ["torn", f"torn {n} lone {lone}", f"torn joined {_bucket(words.count(joined))}", f"torn short {min(min(len(p[2]) for p in part), 4)}"]
                found.append((part[0][0], part[-1][1], "delete", text[part[0][0] : part[-1][1]], f))
                last, done = s + n - 1, True
                break
            if done:
                break
    kinds = Counter(f[0].split()[0] for *_, f in found)
    total = sum(kinds.values())
    for *_, f in found:
        f.append(f"company {min(3, total - 1)} {f[0].split()[0].split('-')[0]}")
    return sorted(found, key=lambda x: (x[0], x[1]))


_BREAK = re.compile(r"[^\S\n\f]*\r?\n[\s\f]*")


def breaks(text: str) -> list[tuple[int, int, str, str, list[str]]]:
    """Every line break between lines as a place of the edit 'join', a blank in its stead."""
    found = []
    widest = max((len(line) for line in text.split("\n")), default=0)
    start = 0
    for m in _BREAK.finditer(text):
        a, b = m.span()
        line = a - start
        start = b
        if a == 0 or b == len(text):
            continue
        last, first = _side(text[a - 1]), _side(text[b])
        many, full = min(2, m.group().count("\n")), line >= 0.7 * widest
        f = [f"break {many}", f"break {many} {last}", f"break {last} {first}", f"break {many} full {full}", f"break {last in ('.', '!', '?')} {first} full {full} {many}"]
        found.append((a, b, "join", " ", f))
    return found


_PAGE = re.compile(r"^\W*(?:p[áa]g(?:ina|\.)?|page|p\.)?\s*\W*\d{1,5}\W*(?:\|\W*\d{1,5}\W*)?$", re.I)
_TITLE = r"[A-ZÀ-Ý][\w'’]+(?:(?: (?:d[aeo]s?|de|del|of|the|on|e|y|in|em|la|las|los|sobre|na|no|para|and|et|des|du))* [A-ZÀ-Ý][\w'’]+)+"
# one roman letter after or before a name is rather an initial, unless a year closes the span
_NUMBER = r"(?:\d{1,5}|[IVXLC]{2,6}(?![\w'’.]))"
_BETWEEN = r"(?:,? +| *[|–—·•/-] *)"
_NAME = r"[A-ZÀ-Ý][\w'’]+"
_HEAD = rf"(?:[A-ZÀ-Ý]{{2,}}(?: [A-ZÀ-Ý]+)+(?![\w'’])|{_TITLE})"
#: What may be furniture inside a line: page numbers in any dress, and title-like runs with a number or a bar.
_PROPOSED = re.compile(
    rf"(?<!\S)(?:\[\d{{1,5}}\]|[–—-] ?\d{{1,5}} ?[–—-]|\d{{1,5}} ?[|/] ?\d{{1,5}}|(?:[Pp][áa]g(?:ina|\.)?|[Pp]age|[Ss]eite|pp?\.) ?\d{{1,5}}"
    rf"|(?:{_HEAD}|(?:{_NAME} (?:e|and|y|et|&) )?{_NAME}) [|·•/] (?:{_HEAD}|{_NAME})(?:{_BETWEEN}{_NUMBER}){{0,2}}"
    rf"|[IVXLC]{{1,6}} {_HEAD},? (?:1[89]|20)\d\d|{_NUMBER}(?: +| *[|–—·•/-] *){_HEAD}(?:{_BETWEEN}{_NUMBER}){{0,2}}|{_HEAD}(?:{_BETWEEN}{_NUMBER}){{1,2}}"
    r")(?![^\s.,;:])"
)
_ATOM = re.compile(r"(?:1[89]|20)\d\d(?!\d)|\d+|[IVXLC]{1,6}(?![\w'’])|[^\W\d_][\w'’]*\.?|\s{3,}|[^\w\s]")


def _side(c: str) -> str:
    return "none" if not c else "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else c


def _variants(text: str, a: int, b: int, titles: frozenset[str]) -> list[tuple[int, int]]:
    """A span, and what is left of it without the words and numbers of the text that it may have taken up."""
    out = {(a, b)}
    if m := re.search(r"(?<=\w) \d{1,5}$", text[a:b]):
        out.add((a, a + m.start()))
    low = text[a:b].lower()
    for t in titles:
        at = low.find(t)
        if at >= 0:
            out.add((a, a + at + len(t)))
            lead = re.search(r"[IVXLC]{1,6} $", text[a : a + at])
            start = a + (lead.start() if lead else at)
            out |= {(start, stop) for _, stop in list(out) if stop > start}
    # a title alone is no furniture
    return sorted(x for x in out if x == (a, b) or re.search(r"\d|[|·•]", text[x[0] : x[1]]))


def inline_proposals(text: str, titles: frozenset[str]) -> list[tuple[int, int, tuple]]:
    """[(start, stop, what the span and its surroundings look like)] of what may be furniture inside a line."""
    found = []
    for a, b in (x for m in _PROPOSED.finditer(text) for x in _variants(text, *m.span(), titles)):
        form, words = [], []
        for t in _ATOM.findall(text[a:b]):
            if t[0].isdigit():
                kind = "Y" if len(t) == 4 and t[:2] in ("18", "19", "20") else "N"
            elif t.isspace():
                kind = "W"
            elif t[0].isalpha():
                kind = "v" if re.fullmatch(r"(?i)v|vol|n|no|num|p|ed", t) else "P" if re.fullmatch(r"(?i)p[áa]g(?:ina|\.)?|page|seite|pp?\.", t) else "R" if re.fullmatch(r"[IVXLC]{1,6}", t) else "U" if len(t) > 1 and t.isupper() else "T"
                words += [t.lower()] if kind in "UT" else []
            else:
                kind = t
            if not (form and form[-1] == kind and kind in "UT"):
                form.append(kind)
        before, after = text[max(0, a - 40) : a].rstrip(), text[b : b + 40].lstrip(" .,")
        tight = text[b : b + 1].strip() != ""
        found.append((a, b, ("".join(form), _side(before[-1:]), ("ed" if after.startswith("ed.") else _side(after[:1])) + "!" * tight, " ".join(words) in titles, min(len(words), 6))))
    return found


def inline_features(key: tuple) -> list[str]:
    form, before, after, known, long = key
    loose = "".join(sorted(set(form)))
    sides = f"{before} {after}"
    flow = f"{before in ('lower', ',', 'digit')} {after in ('lower', 'digit', '(')}"
    return [
        f"form {form}", f"before {before}", f"after {after}", f"sides {sides}", f"form {form} sides {sides}", f"loose {loose} sides {sides}", f"form {form} before {before}",
        f"form {form} after {after}", f"known {known} sides {sides}", f"known {known} flow {flow}", f"volume {'v' in form or after[:2] == 'ed'}", f"flow {flow}", f"form {form} flow {flow}", f"loose {loose} known {known} flow {flow}", f"loose {loose} long {long}", f"numbers {sum(c in 'YNR' for c in form)} sides {sides}",
    ]


def _header(rng: random.Random, title: str, text: str) -> str:
    """A running header or page number: a title that recurs or is made up, a number or a bar, in any order."""
    if rng.random() < 0.5:
        words = [w for w in re.findall(r"[^\W\d_]{4,}", text)] or ["Study"]
        title = " ".join(w.capitalize() for w in rng.choices(words, k=rng.randint(2, 5)))
        if rng.random() < 0.5:
            title = title.replace(" ", rng.choice([" de ", " of ", " e "]), 1)
    n, year = rng.randint(1, 1400), 1980 + rng.randint(0, 44)
    if rng.random() < 0.2:
        title = title.upper()
    gap = rng.choice([" ", ", ", " – ", "    ", " | ", " · ", " - "])
    return rng.choice([
        f"[{n}]", f"- {n} -", f"{n} | {n + 1}", f"p. {n}", f"Página {n}", f"Page {n}", f"{title}{gap}{n}", f"{title}{gap}{year}", f"{title}, {year}", f"{n}{gap}{title}", f"{n}    {title.upper()}", f"{title} – {year}    {n}", f"{rng.choice(['V', 'XI', 'XXII'])} {title} {year}",
        f"{rng.choice(['IV', 'VII', 'XIX'])} {title} {year}", f"{title}{gap}{year}    {n}", f"{title.split()[0]} e {title.split()[-1]} | {title}", f"{title.split()[-1]} | {title}",
    ])


def _inline_examples(text: str, rng: random.Random, titles: list[str], known: frozenset[str]) -> list[tuple[list[str], str, tuple[str, ...]]]:
    """Proposals of a text as stored, and of copies with one header put between two words of a line."""
    kinds = ("text", "furniture")
    own = [(inline_features(k), "text", kinds) for _, _, k in inline_proposals(text, known) for _ in range(1 if k[3] else OWN)]
    gaps = [m.start() + 1 for m in re.finditer(r"(?<=\S) (?=\S)", text)]
    out = own
    for _ in range(1 if gaps else 0):
        at, new = rng.choice(gaps), _header(rng, rng.choice(titles), text)
        damaged = text[:at] + new + " " + text[at:]
        # a span that takes more than the header, or only a part of it, is no example of either kind
        out += [(inline_features(k), "furniture", kinds) for a, b, k in inline_proposals(damaged, known) if (a, b) == (at, at + len(new))]
    return out


def line_features(lines: list[str], i: int) -> list[str]:
    """What a line looks like and where it stands."""
    s = lines[i].strip(" \t\r")
    body = s.lstrip("\f").strip()
    before = lines[i - 1].rstrip() if i else ""
    after = lines[i + 1].lstrip() if i + 1 < len(lines) else ""
    tokens = re.findall(r"[^\W\d_]+", body)
    small = {"de", "da", "do", "das", "dos", "e", "y", "of", "on", "the", "and", "em", "na", "no", "la", "las", "los", "del", "para", "sobre", "et", "des", "du", "a", "in"}
    content = [t for t in tokens if t.lower() not in small]
    capital = sum(t[0].isupper() for t in content) / max(1, len(content))
    page = bool(_PAGE.match(body))
    flow = bool(before) and before[-1] not in ".!?:" and bool(after) and (after[0].islower() or after[0].isdigit())
    year = bool(re.search(r"(?:^|\D)(?:1[89]|20)\d\d(?:\s+\d+)?$", body))
    wide = bool(re.search(r"\d\s{3,}\S|\S\s{3,}\d", body))
    shape = "page" if page else "bar" if " | " in body else "title" if content and capital == 1 and len(content) >= 2 else "text"
    number = year or wide or bool(re.match(r"^(?:[IVXLC]{1,6}|\d{1,5})\s+[A-ZÀ-Ý]", body))
    stop = body[-1:] in ".,;:"
    return [
        f"shape {shape}", f"shape {shape} feed {s.startswith(chr(12))}", f"shape {shape} flow {flow}", f"shape {shape} number {number} stop {stop}",
        f"shape {shape} number {number} stop {stop} first {not i} last {i + 1 == len(lines)}", f"length {min(len(body) // 12, 6)} {shape}", f"feed {s.startswith(chr(12))}",
    ]


class Perceptron:
    """Averaged multi-class perceptron over string features."""

    def __init__(self, classes: tuple[str, ...]):
        self.classes = classes
        self.w: dict[str, np.ndarray] = {}

    def scores(self, features: list[str]) -> np.ndarray:
        out = np.zeros(len(self.classes))
        for f in features:
            if (v := self.w.get(f)) is not None:
                out += v
        return out

    def predict(self, features: list[str], allowed: tuple[str, ...] | None = None) -> str:
        s = self.scores(features)
        if allowed:
            return max(allowed, key=lambda c: (s[self.classes.index(c)], -self.classes.index(c)))
        return self.classes[int(s.argmax())]

    def train(self, data: list[tuple[list[str], str, tuple[str, ...]]], rounds: int = ROUNDS, seed: int = 6) -> None:
        rng = random.Random(seed)
        total: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(self.classes)))
        step = 0
        data = list(data)
        for _ in range(rounds):
            rng.shuffle(data)
            for features, label, allowed in data:
                step += 1
                got = self.predict(features, allowed)
                if got != label:
                    g, t = self.classes.index(got), self.classes.index(label)
                    for f in features:
                        v = self.w.setdefault(f, np.zeros(len(self.classes)))
                        v[t] += 1
                        v[g] -= 1
                        total[f][t] += step
                        total[f][g] -= step
        for f, v in self.w.items():
            self.w[f] = v - total[f] / max(1, step)


def _wrapped(text: str, rng: random.Random) -> str:
    """A text in lines of one width."""
    width = rng.randint(40, 90)
    lines, line = [], ""
    for w in text.split():
        if line and len(line) + len(w) >= width:
            lines.append(line)
            line = w
        else:
            line = f"{line} {w}" if line else w
    return rng.choice(["\n", "\n", "\r\n", " \n"]).join([*lines, line])


def _damage(text: str, rng: random.Random, titles: list[str]) -> tuple[str, list[tuple[int, int]], set[int]]:
    """A damaged copy, the (start, stop) spans of cuts and misreadings, and the furniture lines."""
    kinds = rng.sample(["cut", "space", "torn", "misread", "typo", "wrap", "furniture"], rng.randint(1, 4))
    if rng.random() < 0.15:  # a wrong encoding is no damage of a scan, though it may hold soft hyphens
        for _ in range(rng.choice([1, 1, 2])):
            text = text.encode("utf-8", "replace").decode(rng.choice(["latin-1", "latin-1", "cp1252"]), "ignore")
        return text, [], set()
    out: list[str] = []
    size = 0
    spans: list[tuple[int, int]] = []

    def put(s: str) -> None:
        nonlocal size
        out.append(s)
        size += len(s)

    def mark(s: str) -> None:
        spans.append((size, size + len(s)))
        put(s)

    width = rng.randint(45, 80)
    column = 0
    for m in re.finditer(r"\s+|[^\s]+", text):
        t = m.group()
        if t.isspace():
            if ("wrap" in kinds or "furniture" in kinds) and column > width:
                put("\n")
                column = 0
            else:
                put(" ")
            continue
        column += len(t) + 1
        if len(t) < 5 or not t.strip(".,;:").isalpha() or rng.random() > 0.15:
            put(t)
            continue
        k = rng.randint(2, len(t.strip(".,;:")) - 2)
        kind = rng.choice(kinds)
        if kind == "cut":
            put(t[:k])
            mark(rng.choice(["-\n", "¬\n", "-\r\n", "\xad", "- ", "- \n"]))
            put(t[k:])
        elif kind == "space":
            core = t.rstrip(".,;:")
            mark(" ".join(core))
            put(t[len(core) :])
        elif kind == "torn":
            core = t.rstrip(".,;:")
            cuts = [0, *sorted(rng.sample(range(2, len(core) - 1), min(rng.randint(1, 3), len(core) - 3))), len(core)]
            mark(" ".join(core[x:y] for x, y in zip(cuts, cuts[1:])))
            put(t[len(core) :])
        elif kind == "misread":
            options = [(g, b, t.lower().find(g)) for g, b in CONFUSIONS if g in t.lower()]
            if options:
                g, b, at = rng.choice(options)
                put(t[:at])
                mark(b)
                put(t[at + len(g) :])
            else:
                put(t)
        elif kind == "typo":
            c = rng.choice("abdefghijklmnopqrstuvxz")
            put(rng.choice([t[:k] + c + t[k + 1 :], t[:k] + t[k + 1 :], t[: k - 1] + t[k] + t[k - 1] + t[k + 1 :], t[:k] + t[k] + t[k:]]))
        else:
            put(t)
    damaged = "".join(out)
    lines: set[int] = set()
    if "furniture" in kinds and "\n" in damaged:
        rows = damaged.split("\n")
        at = rng.randint(1, len(rows) - 1)
        n = rng.randint(1, 1400)
        title = rng.choice(titles)
        new = rng.choice(["Página %d" % n, "[%d]" % n, "- %d -" % n, str(n), f"{n} | {n + 1}", f"{title}, {1980 + n % 45}", f"{rng.choice(['V', 'XI', 'XXII'])} {title} {1980 + n % 45}", f"{title} – {1980 + n % 45}    {n}", f"{n}    {title.upper()}", f"{title.split()[0]} e {title.split()[-1]} | {title}"])
        shift = sum(len(r) + 1 for r in rows[:at])
        new = rng.choice(["", "\f"]) + new
        rows.insert(at, new)
        spans = [(a + (len(new) + 1) * (a >= shift), b + (len(new) + 1) * (a >= shift)) for a, b in spans]
        damaged = "\n".join(rows)
        lines = {at}
    return damaged, spans, lines


class Editor:
    """The trained character editor and line classifier with their known words."""

    def __init__(self, words: Words):
        self.words = words
        self.chars = Perceptron(OPS)
        self.lines = Perceptron(("text", "furniture"))
        self.inline = Perceptron(("text", "furniture"))
        self.titles: frozenset[str] = frozenset()
        self.judged: dict[tuple, float] = {}

    def fit(self, clean: list[str], titles: list[str], seed: int = 6, stored: list[str] | None = None) -> Editor:
        """Train on ``clean`` texts; ``stored`` ones, clean or not, show what surrounds page furniture in general."""
        rng = random.Random(seed)
        data, lines = [], []
        for text in clean:
            for copy in range(2):
                damaged, spans, furniture = _damage(text, rng, titles) if copy or rng.random() < 0.5 else (text, [], set())
                for a, b, edit, _, f in places(damaged, self.words):
                    hit = any(x < b and a < y for x, y in spans)
                    data.append((f, edit if hit else "keep", OPS))
                # lines of one text are joined, the bound between two texts is a paragraph's
                bound = rng.choice(["\n\n", "\n\n", "\n", "\r\n\r\n"])
                one = _wrapped(damaged, rng)
                two = one + bound + _wrapped(rng.choice(clean), rng)
                data += [(f, "keep" if len(one) <= a < len(one) + len(bound) else "join", OPS) for a, b, _, _, f in breaks(two)]
                rows = damaged.split("\n")
                if len(rows) > 1:
                    lines += [(line_features(rows, i), "furniture" if i in furniture else "text", ("text", "furniture")) for i in range(len(rows))]
        self.chars.train(data)
        self.lines.train(lines)
        self.titles = frozenset(t.lower() for t in titles)
        rng = random.Random(seed + 1)
        self.inline.train([x for text in stored or clean for x in _inline_examples(text, rng, titles, self.titles)])
        return self

    def _furniture(self, key: tuple) -> float:
        """How much more a proposal looks like furniture than like text."""
        got = self.judged.get(key)
        if got is None:
            text, furniture = self.inline.scores(inline_features(key)).tolist()
            got = furniture - text
            if len(self.judged) < 500_000:
                self.judged[key] = got
        return got

    def repair(self, text: str | None) -> tuple[str | None, int]:
        """(continuous text, number of edits other than joined lines)."""
        if not text:
            return text, 0
        edits = 0
        if "\n" in text:
            rows = text.split("\n")
            kept = []
            for i, row in enumerate(rows):
                if row.strip() and self.lines.predict(line_features(rows, i)) == "furniture":
                    edits += 1
                else:
                    kept.append(row)
            text = "\n".join(kept)
        spans: list[tuple[int, int]] = []
        ranked = [(score, a, b) for a, b, key in inline_proposals(text, self.titles) if (score := self._furniture(key)) > 0]
        for _, a, b in sorted(ranked, key=lambda x: (-x[0], x[1] - x[2], x[1])):
            if all(b <= x or y <= a for x, y in spans):
                spans.append((a, b))
        spans.sort()
        for a, b in reversed(spans):
            edits += 1
            text = text[:a].rstrip(" ") + text[b:] if text[:a].strip() else text[b:].lstrip(" ")
        out, at = [], 0
        for a, b, edit, new, f in places(text, self.words):
            if a < at or self.chars.predict(f) != edit:
                continue
            edits += 1
            if f[0] == "torn":
                new = re.sub(r"\s+", "", new)
            out += [text[at:a], new]
            at = b
        out.append(text[at:])
        whole = "".join(out)
        if not edits or "\n" not in whole:
            return whole.replace("\f", " "), edits
        lines, at = [], 0
        for a, b, edit, new, f in breaks(whole):
            lines += [whole[at:a], new if self.chars.predict(f) == edit else "\n\n"]
            at = b
        return "".join([*lines, whole[at:]]).replace("\f", " "), edits


def train(df: DataFrame, column: str, words: dict[str, int], titles: list[str], sample: int = SAMPLE) -> Editor:
    """Fit on at most ``sample`` different texts without any mark, the least hashes first."""
    marks = "[\\n\\f\\u00ad¬\\ufffd@ÃÂ]|- |\\d[a-z]|[a-z]\\d"
    clean = df.where((F.length(column) > 60) & ~F.col(column).rlike(marks)).select(F.col(column).alias("t"), F.xxhash64(column).alias("h"))
    # the least hashes lie in a narrow range, so a task hands over few rows however many tasks there are
    share = min(1.0, 12 * sample / max(1, df.count()))
    near = clean.where(F.col("h") <= F.lit(int(-(2**63) + share * (2**64 - 1)))) if share < 0.5 else clean
    rows = near.groupBy("h").agg(F.min("t").alias("t")).orderBy("h").limit(sample).select("t").collect()
    known = Words(words)
    texts = [unicodedata.normalize("NFC", r[0]) for r in rows]
    # furniture is rare, so texts as they are stored serve as examples of what is none
    every = df.where(F.length(column) > 60).select(F.col(column).alias("t"), F.xxhash64(column).alias("h"))
    every = every.where(F.col("h") <= F.lit(int(-(2**63) + share * (2**64 - 1)))) if share < 0.5 else every
    stored = every.groupBy("h").agg(F.min("t").alias("t")).orderBy("h").limit(8 * sample).select("t").collect()
    return Editor(known).fit(texts, titles or ["Annals of Study"], stored=[unicodedata.normalize("NFC", r[0]) for r in stored])


def frequent_titles(df: DataFrame, column: str, most: int = 40) -> list[str]:
    """Title-like phrases that recur most (a top-``most`` report); they serve as headers in training."""
    phrase = F.regexp_extract(column, r"(?:[.,:”] |– )(\p{Lu}\p{L}+(?: \p{L}+){2,8}?)(?=[,(]| [(–-])", 1).alias("t")
    counts = df.select(phrase).where("t <> ''").groupBy("t").agg(F.count("*").alias("n"))
    return [r["t"] for r in counts.orderBy(F.desc("n"), "t").limit(most).collect()]


def restore(df: DataFrame, key: str, text: str, editor: Editor) -> DataFrame:
    """(key, restored, edits) for every row whose text was damaged by scanning.

    Broken lines alone do not count. Null and empty texts give no row; repeated rows
    repeat, callers take distinct keys. Texts in any normal form are read composed.
    """
    model = df.sparkSession.sparkContext.broadcast(editor)
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        ed = model.value
        for batch in batches:
            row, new, many = [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                if not t:
                    continue
                if not t.isascii():
                    t = unicodedata.normalize("NFC", t)
                got, n = ed.repair(t)
                if n:
                    row.append(i), new.append(got), many.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(new, pa.string()), pa.array(many, pa.int32())],
                ["key", "restored", "edits"],
            )

    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, restored string, edits int")
    return out.withColumnRenamed("key", key)
