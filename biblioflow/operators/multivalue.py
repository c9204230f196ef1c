"""Several values packed in one field: dialect choice by description length (problem 1).

A dialect says which separator kinds a field uses, whether quotation marks
enclose values and whether a comma between digits separates. Every dialect that a
field's characters allow is parsed, and each parse is priced in bits:

* a value costs log2(total / n) when n other fields hold it, else an escape and its
  characters;
* a mark costs -log2 of how often marks of its kind separate where it separates,
  and -log2 of how often they stand inside values where it is left inside one;
* quotation marks that may enclose a value are one such kind.

The counts come from one reading of all fields in which every mark separates and
quotes enclose; a field's own share is taken off, so no parse pays for itself. The
cheapest parse of each field wins: a mark is left inside a value where the whole is
known or its parts are not worth their codes.
"""

from __future__ import annotations

import math
import re
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioflow.session import checkpoint

# Separator kinds. Slash, hyphen, dash and stop need white space.
SEPARATORS = {
    "line": r"[\n\r\x0b\x0c\x85\u2028\u2029]",
    "tab": r"\t",
    "semicolon": r"[;；]",
    "bar": r"[|¦]",
    "bullet": r"[•·‣▪◦∙●■]",
    "comma": r"(?<!\d),|,(?!\d)|[，、]",
    "slash": r"(?<=\s)/(?=\s)",
    "dash": r"(?<=\s)[-‐‑‒–—―](?=\s)|^\s*[-–—](?=\s)",
    "stop": r"\.(?=\s|$)",
    "mark": r"[!?¡¿…](?=\s|$)",
}
TIGHT = r"(?<=\d),(?=\d)"
QUOTES = {'"': '"', "“": "”", "„": "”", "«": "»", "‹": "›", "‘": "’", "'": "'", "`": "´"}
_QUOTED = re.compile(
    "\"((?:[^\"]|\"\")*)\"|“((?:[^”]|””)*)”|„([^“”]*)[“”]|«((?:[^»]|»»)*)»|‹([^›]*)›|‘([^’]*)’(?!\\w)|'((?:[^']|'')*)'(?!\\w)|”([^”]*)”"
)
_TAIL = re.compile(r"\s*(?:\.\s*)?(?:$|[;；|¦•·‣▪◦∙●■,，、\n\r\t/.!?…\u2028\u2029-]|[‐‑‒–—―])")
_LABEL = re.compile(r"^\s*[^\W\d_][\w\-‐‑ \u00a0]{0,38}\s?[:：](?=\s|[^\w/])\s*")
SPACE = "\u200b\ufeff\u2060"
_KINDS = {k: re.compile(v) for k, v in SEPARATORS.items()}
_TIGHT = re.compile(TIGHT)
NAMES = (*SEPARATORS, "tight")
MARKS = (*NAMES, "quote")
_ALL = _KINDS | {"tight": _TIGHT}
#: A character of each kind, without which no place of it need be looked for.
_HINTS = {k: re.compile(h) for k, h in zip(NAMES, (SEPARATORS["line"], r"\t", "[;；]", "[|¦]", SEPARATORS["bullet"], "[,，、]", "/", "[-‐‑‒–—―]", r"\.", "[!?¡¿…]", ","))}
LITERAL_BITS = 5.0
DIALECT_BITS = 1.0


def _strip(text: str) -> str:
    while True:
        out = text.strip().strip(SPACE)
        if out == text:
            return out
        text = out


def _clean(text: str, quoting: bool) -> str:
    """A value without surrounding white space, closing stop and outer quotes."""
    text = _strip(text)
    if quoting and text and text[0] in QUOTES:
        bare = text[:-1].rstrip() if text.endswith(".") else text
        m = _QUOTED.fullmatch(bare)
        if m:
            inner = next(g for g in m.groups() if g is not None)
            for c in {bare[0], bare[-1]}:
                inner = inner.replace(c + c, c)
            return _strip(inner)
    while text.endswith("."):
        text = _strip(text[:-1])
    return text


class Field:
    """A field's text without its label, with the places of all marks; parses share what they have in common."""

    def __init__(self, text: str):
        m = _LABEL.match(text)
        if m and m.end() < len(text):
            text = text[m.end() :]
        elif m:
            text = ""
        self.text = text
        self.cuts = {k: [m.span() for m in _ALL[k].finditer(text)] if _HINTS[k].search(text) else [] for k in NAMES}
        self.quoted = any(q in text for q in QUOTES)
        self.shield = self._shield() if self.quoted else []
        self.cleaned: dict[tuple[int, int, bool], tuple[str, bool]] = {}

    def _shield(self) -> list[tuple[int, int]]:
        """Spans that quotation marks enclose as whole values."""
        out, at = [], 0
        while m := _QUOTED.search(self.text, at):
            before = self.text[: m.start()]
            opens = not before or not (before[-1].isalnum() or before[-1] in ")]")
            if opens and _TAIL.match(self.text, m.end()):
                out.append(m.span())
                at = m.end()
            else:
                at = m.start() + 1
        return out

    def parse(self, kinds: tuple[str, ...], quoting: bool) -> tuple[list[tuple[str, bool]], list[int]]:
        """([(value, stood in quotes)] without empty ones, how many marks of each of NAMES separate)."""
        shield = self.shield if quoting else []
        values: list[tuple[int, int]] = []
        used = [0] * len(NAMES)
        start = s = 0
        for a, b, k in sorted((a, b, NAMES.index(k)) for k in kinds for a, b in self.cuts[k]):
            while s < len(shield) and shield[s][1] <= a:
                s += 1
            if s < len(shield) and shield[s][0] <= a or a < start:
                continue
            used[k] += 1
            values.append((start, a))
            start = b
        values.append((start, len(self.text)))
        out = []
        for a, b in values:
            got = self.cleaned.get((a, b, quoting))
            if got is None:
                bare = _strip(self.text[a:b])
                value = _clean(bare, quoting)
                got = self.cleaned[a, b, quoting] = (value, quoting and bare[:1] in QUOTES and value != bare)
            if got[0]:
                out.append(got)
        return out, used


def parse(text: str, kinds: tuple[str, ...], quoting: bool, tight: bool) -> list[str]:
    """The values of one dialect; empty values are dropped."""
    return [v for v, _ in Field(text).parse((*kinds, "tight") if tight else kinds, quoting)[0]]


def candidates(text: str) -> list[tuple[str, list[tuple[str, bool]], list[int], list[int]]]:
    """[(dialect, values, marks that separate, marks left inside)] of every different parse of a field.

    The first is the full one: every mark separates and quotes enclose, commas between
    digits excepted. Of dialects with the same parse the shortest name is kept. All
    subsets of the kinds that occur are tried, 2 ** 11 at most, twice with quotes.
    """
    field = Field(text)
    kinds = [k for k in NAMES if field.cuts[k]]
    full = tuple(k for k in kinds if k != "tight")
    subsets = [full, *(c for n in range(len(kinds) + 1) for c in combinations(kinds, n) if c != full)]
    found: dict[tuple, tuple[str, list[int], list[int]]] = {}
    for quoting in (True, False) if field.quoted else (False,):
        # marks inside enclosed values are no choice of the dialect
        quotes = 2 * len(field.shield)
        free = [sum(not any(x <= a < y for x, y in (field.shield if quoting else ())) for a, _ in field.cuts[k]) for k in NAMES]
        for chosen in subsets:
            values, used = field.parse(chosen, quoting)
            name = "+".join([*chosen, *(["quote"] if quoting else [])])
            old = found.get(tuple(values))
            if old is None or name.count("+") < old[0].count("+") and old[1][:-1] == used:
                found[tuple(values)] = (name, [*used, quotes * quoting], [*(f - u for f, u in zip(free, used)), quotes * (not quoting)])
    return [(name, list(values), used, inside) for values, (name, used, inside) in found.items()]


def _expand(batches):
    for batch in batches:
        keys = {n: batch.column(n) for n in ("key", "field")}
        row, number, dialect, pos, value, quoted, own, used, inside = [], [], [], [], [], [], [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            mine: set[str] = set()
            for at, (name, values, separate, left) in enumerate(candidates(text)):
                if not at:
                    mine = {v for v, _ in values}
                for p, (v, whole) in enumerate(values or [(None, False)], 1):
                    row.append(i), number.append(at), dialect.append(name), pos.append(p), value.append(v)
                    quoted.append(whole), own.append(v in mine)
                    used.append(separate if p == 1 else None), inside.append(left if p == 1 else None)
        take = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [keys["key"].take(take), keys["field"].take(take), pa.array(number, pa.int32()), pa.array(dialect, pa.string()), pa.array(pos, pa.int32()), pa.array(value, pa.string()),
             pa.array(quoted, pa.bool_()), pa.array(own, pa.bool_()), pa.array(used, pa.list_(pa.int32())), pa.array(inside, pa.list_(pa.int32()))],
            ["key", "field", "number", "dialect", "pos", "value", "quoted", "own", "used", "inside"],
        )


def _mark_bits(full: DataFrame) -> tuple[list[float], list[float]]:
    """Bits of a mark of each kind that separates, and of one inside a value, by what the full parses and their quoted values show."""
    held = [F.sum(F.when(F.col("pos") <= 1, F.col(c)[i])).alias(f"{c}{i}") for i in range(len(MARKS)) for c in ("used", "inside")]
    shut = [F.sum(F.when(F.col("quoted"), F.size(F.regexp_extract_all("value", F.lit(p), F.lit(0))))).alias(f"shut{i}") for i, p in enumerate((*SEPARATORS.values(), TIGHT))]
    got = full.agg(*held, *shut).first().asDict()
    separate, inside = [], []
    for i in range(len(MARKS)):
        u, n = got[f"used{i}"] or 0, (got[f"inside{i}"] or 0) + (got.get(f"shut{i}") or 0)
        separate.append(-math.log2((u + 1) / (u + n + 2)))
        inside.append(-math.log2((n + 1) / (u + n + 2)))
    return separate, inside


SALT = 8


def split_values(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, pos, value, dialect): one row per value, positions from 1.

    Null, empty and blank fields give no row, nor do values that are empty after
    trimming. Rows with the same key and fields count once; where a key comes with
    different texts the greatest is taken. Case and accents stay. Code lengths are
    counted over all fields of ``df``: values are summed before the shuffle, and
    because a value may be in a third of all rows the join on values is salted. The
    parses are written once and read by the counts and by the choice.
    """
    kind = df.schema[key].dataType.simpleString()
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields])
    one = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(F.struct(*fields)).alias("_r"))
    one = one.select("key", *[F.col("_r")[f].alias(f) for f in fields])
    long = one.select("key", F.explode(cells).alias("c")).select("key", "c.field", "c.text")
    long = long.where(F.col("text").rlike(r"[^\s]"))
    schema = f"key {kind}, field string, number int, dialect string, pos int, value string, quoted boolean, own boolean, used array<int>, inside array<int>"
    rows = checkpoint(long.mapInArrow(_expand, schema))
    full = rows.where("number = 0")
    # a value counts once for each field that holds it
    held = full.where("value is not null").groupBy("key", "field", "value").agg(F.lit(1).alias("_")).groupBy("value").agg(F.count("*").alias("n"))
    counts = checkpoint(held)
    total, once = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") == 1, 1))).first()
    escape = max(1.0, math.log2(max(total, 2) / max(once, 1)))
    separate, inside = _mark_bits(full)
    salted = counts.where("n > 1").select("value", "n", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    marked = rows.withColumn("salt", F.pmod(F.hash("key", "field"), F.lit(SALT)))
    known = marked.join(salted, ["value", "salt"], "left")
    others = F.coalesce("n", F.lit(1)) - F.col("own").cast("int")
    literal = F.lit(escape) + F.lit(LITERAL_BITS) * F.length("value")
    code = F.when(F.col("n").isNotNull() & (others > 0), F.least(literal, F.log2(F.lit(float(max(total, 2))) / others))).otherwise(literal)
    marks = sum((F.col("used")[i] * separate[i] + F.col("inside")[i] * inside[i] for i in range(len(MARKS))), F.lit(0.0))
    names = F.when(F.col("pos") <= 1, F.size(F.filter(F.split("dialect", r"\+"), lambda x: x != ""))).otherwise(0) * DIALECT_BITS
    bits = F.coalesce(code, F.lit(0.0)) + names + F.coalesce(marks, F.lit(0.0))
    parses = known.withColumn("bits", bits).groupBy("key", "field", "number", "dialect").agg(
        F.sum("bits").alias("bits"), F.sort_array(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("pos", "value")))).alias("values")
    )
    # equal prices: the full parse, then the shorter dialects
    best = parses.groupBy("key", "field").agg(F.min(F.struct(F.round("bits", 6).alias("bits"), "number", "dialect", "values")).alias("b"))
    out = best.select("key", "field", F.explode("b.values").alias("v"), F.col("b.dialect").alias("dialect"))
    return out.select(F.col("key").alias(key), "field", F.col("v.pos").alias("pos"), F.col("v.value").alias("value"), "dialect")
