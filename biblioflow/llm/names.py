"""Variant spellings of persons and organisations (problem 4).

A symmetric-delete index finds tokens within one edit of each other: both sides
list every token with each single character removed, and equal entries are joined.
Candidates are then judged by the cheapest assignment of the tokens of one name to
those of the other, in which initials, abbreviations and nicknames may stand for
longer tokens.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioflow.llm._graph import components
from biblioflow.session import checkpoint, release

PARTICLES = frozenset("de da do das dos di del la of the du des".split())
SUFFIXES = {"neto": "neto", "filho": "filho", "junior": "junior", "jr": "junior", "sobrinho": "sobrinho", "neta": "neto"}
# Usual short forms of Portuguese given names.
NICKNAMES = {
    "beto": ("roberto", "alberto", "humberto", "gilberto"), "bia": ("beatriz",), "bela": ("isabela", "isabel"), "bel": ("isabel", "isabela"),
    "cacau": ("claudia",), "caca": ("carlos",), "carlinhos": ("carlos",), "cica": ("cecilia",), "ceci": ("cecilia",), "chico": ("francisco",),
    "dani": ("daniel", "daniela"), "digo": ("rodrigo",), "dudu": ("eduardo",), "du": ("eduardo",), "edu": ("eduardo",), "fe": ("fernanda", "fernando"),
    "guga": ("gustavo",), "juca": ("jose",), "joca": ("joaquim",), "kiko": ("francisco",), "lena": ("helena", "madalena"),
    "lele": ("leonardo", "leticia"), "lulu": ("luisa", "luiza"), "malu": ("marialuisa",), "mane": ("manuel", "manoel"), "manu": ("manuel", "manuela"),
    "nando": ("fernando",), "nanda": ("fernanda",), "paco": ("francisco",), "pepe": ("jose",), "quim": ("joaquim",), "quinho": ("joaquim",),
    "rafa": ("rafael", "rafaela"), "re": ("renata", "renato"), "tata": ("renata",), "teca": ("tereza", "teresa"), "tete": ("tereza", "teresa"),
    "tiao": ("sebastiao",), "tito": ("antonio",), "tonho": ("antonio",), "toninho": ("antonio",), "toni": ("antonio",), "vini": ("vinicius",),
    "vera": ("veronica",), "vero": ("veronica",), "xande": ("alexandre",), "xico": ("francisco",), "ze": ("jose",), "zeca": ("jose",), "zezinho": ("jose",),
    "nana": ("mariana", "ana"), "aninha": ("ana",), "pat": ("patricia",), "pati": ("patricia",), "paty": ("patricia",), "gabi": ("gabriela", "gabriel"), "gaby": ("gabriela",), "leninha": ("helena",), "nena": ("helena",), "ticia": ("patricia", "leticia"), "gui": ("guilherme",), "leo": ("leonardo",),
    "marcinha": ("marcia",), "lipe": ("felipe",), "kadu": ("carlos",), "cadu": ("carlos",),
}


@lru_cache(maxsize=200_000)
def fold(text: str) -> str:
    flat = unicodedata.normalize("NFKD", text)
    return "".join(c for c in flat if not unicodedata.combining(c)).lower()


def tokens(text: str | None) -> list[str]:
    """Folded tokens; dotted capitals such as U.F.X. are one token."""
    flat = fold(text or "")
    flat = re.sub(r"\b(?:\w\.){2,}(?:\w\b)?", lambda m: m.group().replace(".", ""), flat)
    return re.findall(r"[^\W_]+", flat)


def person_tokens(first: str | None, middle: str | None, last: str | None) -> tuple[str, ...]:
    """Tokens of a typed name in typed order, without particles."""
    got = re.findall(r"[^\W_]+", " ".join(p for p in (first, middle, last) if p))
    kept = [t for t in got if fold(t) not in PARTICLES and not (t in ("d", "e") and len(got) > 2)]
    return tuple(SUFFIXES.get(f, f) for f in map(fold, kept))


def readings(first: str | None, middle: str | None, last: str | None, given: frozenset[str]) -> list[tuple[str, str, tuple[str, ...], str]]:
    """[(surname, given name, middle tokens, suffix)] that a typed name allows, likeliest first.

    'Last, First' is turned round; where the last token is a known given name and
    the first is not, the two stand swapped, and only then both orders are read.
    """
    suffix = ""
    if "," in (first or ""):
        a, _, b = (first or "").partition(",")
        got = [*person_tokens(b, None, None), *person_tokens(middle, last, None), *person_tokens(a, None, None)]
    else:
        got = list(person_tokens(first, middle, last))
    tails = [t for t in got if t in SUFFIXES.values()]
    if tails and len(got) > 2:
        suffix = tails[-1]
        got = [t for t in got if t not in tails]
    if not got:
        return []
    if len(got) == 1:
        return [(got[0], "", (), suffix)]
    out = [(got[-1], got[0], tuple(got[1:-1]), suffix)]
    if "," not in (first or "") and len(got[0]) > 1 and (got[-1] in given and got[0] not in given or tails and suffix and got[-1] in given):
        out.insert(0, (got[0], got[-1], tuple(got[1:-1]), suffix))
    if not suffix and len(got) > 2:
        for at in (-1, 1):  # a mistyped 'Neto' at the end, or behind a surname that stands first
            meant = next((t for t in SUFFIXES.values() if distance(got[at], t, 1) <= 1), "")
            if meant:
                rest = got[:-1] if at == -1 else [got[-1], *got[2:-1], got[0]]
                out.append((rest[-1], rest[0], tuple(rest[1:-1]), meant))
    return out


def distance(a: str, b: str, most: int = 2) -> int:
    """Edits (insert, delete, replace, swap of neighbours) between two tokens, or most + 1."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def deletes(token: str) -> list[str]:
    """The token and, from four characters on, the token with each single character removed."""
    if len(token) < 4:
        return [token]
    return list({token, *(token[:i] + token[i + 1 :] for i in range(len(token)))})


@lru_cache(maxsize=500_000)
def person_cost(a: str, b: str) -> float:
    """Cost of two name tokens standing for the same; 9 when they cannot."""
    if a == b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 1:
        return 0.5 if b[0] == a else 9.0
    if b in NICKNAMES.get(a, ()) or a in SUFFIXES.values() or b in SUFFIXES.values():
        return 0.5 if b in NICKNAMES.get(a, ()) else 9.0
    if len(a) >= 2 and len(a) <= len(b) - 2 and len(a) <= 4 and b.startswith(a):
        return 0.6
    d = distance(a, b)
    if d == 1 and len(a) >= 3:
        return 1.0
    if d == 2 and len(a) >= 5:
        return 2.0
    return 9.0


def assign(a: tuple[str, ...], b: tuple[str, ...], cost, below: float = 9.0) -> tuple[float, list[tuple[int, int]]]:
    """The cheapest assignment of all tokens of ``a`` to different tokens of ``b`` (branch and bound), or ``below`` if none costs less."""
    best: list = [below, []]

    def go(i: int, used: int, total: float, made: list[tuple[int, int]]) -> None:
        if total >= best[0]:
            return
        if i == len(a):
            best[0], best[1] = total, made
            return
        for c, j in sorted((cost(a[i], b[j]), j) for j in range(len(b)) if not used >> j & 1):
            if c < 9:
                go(i + 1, used | 1 << j, total + c, [*made, (i, j)])

    go(0, 0, 0.0, [])
    return best[0], best[1]


def least_cost(a: tuple[str, ...], b: tuple[str, ...], cost) -> float:
    """What `assign` costs, by shortest augmenting paths: polynomial, for long lists; ``a`` is not the longer one."""
    n, m = len(a), len(b)
    # an impossible pair costs more than all possible ones together
    costs = [[c if (c := cost(x, y)) < 9 else 9.0 * (n + 1) for y in b] for x in a]
    u, v, owner = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        owner[0], at = i, 0
        least, way, seen = [float("inf")] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while owner[at]:
            seen[at] = True
            row, gap, to = owner[at], float("inf"), 0
            for j in range(1, m + 1):
                if not seen[j]:
                    if (c := costs[row - 1][j - 1] - u[row] - v[j]) < least[j]:
                        least[j], way[j] = c, at
                    if least[j] < gap:
                        gap, to = least[j], j
            for j in range(m + 1):
                if seen[j]:
                    u[owner[j]] += gap
                    v[j] -= gap
                else:
                    least[j] -= gap
            at = to
        while at:
            owner[at] = owner[way[at]]
            at = way[at]
    return min(9.0, round(sum(costs[owner[j] - 1][j - 1] for j in range(1, m + 1) if owner[j]), 9))


def same_person(a: list[tuple], b: list[tuple]) -> bool:
    """Whether any reading of one name may be the same person's as one of the other.

    Surnames agree up to two edits; given names agree, or one is the other's
    initial, abbreviation or nickname; the middle tokens of the shorter name all
    find a place among those of the longer one.
    """
    for sa, ga, ma, xa in a:
        for sb, gb, mb, xb in b:
            if xa and xb and xa != xb:
                continue
            c = person_cost(sa, sb)
            if c not in (0.0, 1.0, 2.0) or min(len(sa), len(sb)) < 3:
                continue
            g = person_cost(ga, gb) if ga and gb else 9.0
            if g >= 9 or c + g > 3.2:
                continue
            short, long = (ma, mb) if len(ma) <= len(mb) else (mb, ma)
            if short and (person_cost(short[0], long[0]) if len(long) == 1 else least_cost(short, long, person_cost)) >= 9:
                continue
            return True
    return False


@lru_cache(maxsize=500_000)
def place_cost(name: str, typed: str) -> float:
    """Cost of a typed token for a token of an official name."""
    if name == typed:
        return 0.0
    if name.startswith(typed) and len(typed) < len(name):
        return 0.15 if len(typed) > 1 else 0.25
    if 3 <= len(typed) < len(name) - 1 and typed[0] == name[0] and typed[-1] == name[-1]:
        it = iter(name)
        if all(c in it for c in typed):
            return 0.3
    d = distance(name, typed)
    return 1.0 if d == 1 and len(name) > 3 else 1.9 if d == 2 and len(name) > 5 else 9.0


def _forms(official: str | None, english: str | None) -> list[tuple[str, ...]]:
    out = []
    for text in (official, english):
        bare = re.sub(r"\([^)]*\)\s*$", "", text or "")
        got = tuple(t for t in tokens(bare) if t not in PARTICLES)
        if got:
            out.append(got)
    return out


def reach(name: str) -> set[str]:
    """Keys of a token of an official name: it shares one with `heard` of every typed token that `place_cost` lets stand for it."""
    got = {f"={name[:i]}" for i in range(1, len(name) + 1)} | {f"<{name[0]}{c}{name[-1]}" for c in name[1:-1]}
    once = set(deletes(name))
    return got | {f"~{v}" for v in once} | {f"~{v[:i]}{v[i + 1 :]}" for v in once if len(name) > 5 for i in range(len(v))}


def heard(typed: str) -> set[str]:
    """Keys of a typed token, see `reach`: as a beginning, as a contraction, and within two edits."""
    once = set(deletes(typed))
    twice = {f"~{v[:i]}{v[i + 1 :]}" for v in once if len(typed) > 3 for i in range(len(v))}
    return {f"={typed}", *([f"<{typed[:2]}{typed[-1]}"] if len(typed) > 2 else []), *(f"~{v}" for v in once)} | twice


def organisation_cost(typed: list[str], forms: list[tuple[str, ...]], acronym: str, rare: set[str], unsaid: frozenset[str] = frozenset()) -> tuple[float, list[int]]:
    """Cost of reading a typed affiliation as one listed institution, 9 when it is not, and the places of the words read as its name.

    ``rare`` are the institution's uncommon tokens that are typed. Where none is,
    ``unsaid`` names them: a form that has any comes after all readings that do not,
    as it is known by its common words and an abbreviation only.
    """
    words = [t for t in typed if t not in PARTICLES]
    has = bool(acronym) and acronym in words
    best, places = 9.0, []
    for form in forms:
        key = [t for t in form if t in rare]
        near = {j for k in key or form for j, w in enumerate(words) if place_cost(k, w) in (0.0, 1.0)}
        if not near:
            continue
        # tokens of one name stand together, with at most one word between them
        n, after = len(form), 3.0 * any(t in unsaid for t in form)
        spans = {(s, n + extra) for at in near for extra in (0, 1) for s in range(max(0, at - n - extra + 1), at + 1)}
        for start, length in spans:
            window = tuple(words[start : start + length])
            if len(window) < n or best == 0:
                continue
            total, made = assign(form, window, place_cost, 2.1)
            if total > 2.0 or any(form[i] in key and place_cost(form[i], window[j]) not in (0.0, 1.0) for i, j in made):
                continue
            total += 0.4 * (length - n)
            if total <= 2.0 and sum(1 for i, j in made if place_cost(form[i], window[j]) >= 1) <= 2 and total + after < best:
                best, places = total + after, sorted(start + j for _, j in made)
    if best <= 2.0:
        return best - 0.5 * has, places
    return (0.6, []) if has else (best, places)


def resolve_organisations(texts: DataFrame, text: str, listed: DataFrame, ident: str, official: str, english: str, acronym: str) -> DataFrame:
    """(text, ident) for every distinct text that names exactly one listed institution best.

    Null and empty texts, texts of unlisted organisations and texts that fit two
    institutions equally well give no row. An institution is met by any token of it
    that is in at most a twentieth of all institutions (or 8). One of which none is
    typed is met too, where every token of one of its names, or its whole acronym, is
    heard in the text: names are looked up by their rarest token, those of common
    tokens only by their two rarest.
    """
    inst = listed.select(
        F.col(ident).alias("inst"), F.col(official).alias("official"), F.col(english).alias("english"), F.col(acronym).alias("acronym")
    ).dropDuplicates(["inst"])

    def index(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            rows = []
            for i, o, e, a in zip(pdf["inst"], pdf["official"], pdf["english"], pdf["acronym"]):
                got = {t for f in _forms(o, e) for t in f} | {"".join(tokens(a))}
                rows += [(i, t) for t in got if t]
            yield pd.DataFrame(rows, columns=["inst", "token"])

    kind = inst.schema["inst"].dataType.simpleString()
    words = inst.mapInPandas(index, f"inst {kind}, token string")
    df = words.groupBy("token").agg(F.count("*").alias("df"))
    n = inst.agg(F.greatest(F.lit(8.0), F.count("*") * F.lit(0.05)).alias("most"))
    rare = words.join(df, "token").crossJoin(F.broadcast(n)).where("df <= most").select("inst", "token")
    own = rare.groupBy("inst").agg(F.collect_set("token").alias("own"))

    def spread(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            rows = [(i, t, v) for i, t in zip(pdf["inst"], pdf["token"]) for v in deletes(t)]
            yield pd.DataFrame(rows, columns=["inst", "token", "key"])

    keys = rare.mapInPandas(spread, f"inst {kind}, token string, key string")

    def typed_keys(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            rows = [(s, v) for s in pdf["text"] for v in {v for t in tokens(s) for v in deletes(t)}]
            yield pd.DataFrame(rows, columns=["text", "key"])

    typed = texts.select(F.col(text).alias("text")).where(F.col("text").rlike(r"\S")).distinct()
    near = typed.mapInPandas(typed_keys, "text string, key string").join(keys, "key").select("text", "inst", "token")

    def shapes(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            rows = []
            for i, o, e, a in zip(pdf["inst"], pdf["official"], pdf["english"], pdf["acronym"]):
                rows += [(i, k, t) for k, f in enumerate(_forms(o, e)) for t in set(f)]
                if short := "".join(tokens(a)):
                    rows.append((i, 2, f"@{short}"))  # only ever typed as it is
            yield pd.DataFrame(rows, columns=["inst", "form", "token"])

    def said(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            yield pd.DataFrame([(s, t) for s in pdf["text"] for t in {*tokens(s)} - PARTICLES], columns=["text", "word"])

    def name_keys(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            rows = [(t, k) for t in pdf["token"] for k in ([f"={t[1:]}"] if t[0] == "@" else reach(t))]
            yield pd.DataFrame(rows, columns=["token", "key"])

    def word_keys(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            yield pd.DataFrame([(w, k) for w in pdf["word"] for k in heard(w)], columns=["word", "key"])

    def fits(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            rows = [(w, t) for w, t in zip(pdf["word"], pdf["token"]) if t == f"@{w}" or t[0] != "@" and place_cost(t, w) < 9]
            yield pd.DataFrame(rows, columns=["word", "token"])

    # which typed words may stand for which tokens is found once a word; longer words than any token by over two fit none
    parts = inst.mapInPandas(shapes, f"inst {kind}, form int, token string")
    spoken = typed.mapInPandas(said, "text string, word string")
    longest = parts.agg(F.max(F.length("token")).alias("longest"))
    vocabulary = spoken.select("word").distinct().crossJoin(F.broadcast(longest)).where(F.length("word") <= F.col("longest") + 2).select("word")
    met = parts.select("token").distinct().mapInPandas(name_keys, "token string, key string").join(vocabulary.mapInPandas(word_keys, "word string, key string"), "key")
    often = df.crossJoin(F.broadcast(n)).where("df > most").select("token", F.col("token").alias("common"))
    stands = met.select("word", "token").distinct().mapInPandas(fits, "word string, token string").join(often, "token", "left")
    texts_heard = spoken.join(stands, "word").groupBy("text").agg(F.collect_set("token").alias("heard"), F.collect_set("common").alias("c"))
    two = F.flatten(F.transform("c", lambda x: F.transform(F.filter("c", lambda y: y >= x), lambda y: F.concat_ws(" ", x, y))))
    probes = texts_heard.select("text", "heard", F.explode(F.concat("heard", two)).alias("key"))
    ranked = parts.join(df, "token", "left").groupBy("inst", "form").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token"))).alias("t"))
    first, second = F.get("t", F.lit(0)), F.coalesce(F.get("t", F.lit(1)), F.get("t", F.lit(0)))
    pair = F.concat_ws(" ", F.least(first["token"], second["token"]), F.greatest(first["token"], second["token"]))
    names = ranked.crossJoin(F.broadcast(n)).select("inst", F.when(first["df"] > F.col("most"), pair).otherwise(first["token"]).alias("key"), F.col("t.token").alias("all"))
    whole = probes.join(names, "key").where(F.size(F.array_except("all", "heard")) == 0).select("text", "inst", F.lit(None).cast("string").alias("token"))
    hits = near.unionByName(whole).groupBy("text", "inst").agg(F.collect_set("token").alias("rare"))
    facts = hits.join(inst.join(own, "inst", "left"), "inst")

    def judge(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            rows = []
            for i, s, r, o, e, a, u in zip(pdf["inst"], pdf["text"], pdf["rare"], pdf["official"], pdf["english"], pdf["acronym"], pdf["own"]):
                short = "".join(tokens(a))
                unsaid = frozenset(() if len(r) or u is None else u)
                got = tokens(s)
                c, places = organisation_cost(got, _forms(o, e), short, set(r) - {short}, unsaid)
                if c < 9:
                    rows.append((s, i, c, places, not len(r) and short not in got))
            yield pd.DataFrame(rows, columns=["text", "inst", "cost", "places", "common"])

    judged = facts.select("inst", "text", "rare", "official", "english", "acronym", "own").mapInPandas(judge, f"text string, inst {kind}, cost double, places array<int>, common boolean")
    # a name of common words only gives way to a longer one that is read from the same words and more
    every = F.collect_list(F.struct("cost", "inst", "places", "common")).alias("every")

    def part(x, y):
        return (y["cost"] <= 2.0) & (F.size(y["places"]) > F.size(x["places"])) & (F.size(F.array_except(x["places"], y["places"])) == 0)

    kept = judged.groupBy("text").agg(every).select("text", F.filter("every", lambda x: ~(x["common"] & F.exists("every", lambda y: part(x, y)))).alias("kept"))
    least = kept.select("text", "kept", F.array_min(F.transform("kept", lambda x: x["cost"])).alias("least"))
    ties = least.select("text", F.filter("kept", lambda x: x["cost"] < F.col("least") + 0.05).alias("t"))
    return ties.where(F.size("t") == 1).select("text", F.get("t", F.lit(0))["inst"].alias("inst"))


def same_persons(people: DataFrame, given: frozenset[str]) -> DataFrame:
    """(node, comp) over rows (node, edition, first, middle, last, org, orcid).

    ``org`` is the institution's id or an unlisted organisation's folded text, null
    where nothing is known. Rows of one edition are linked when their names may be
    one person's and their organisations do not differ; equal ORCIDs link, different
    ones part. Nodes are distinct typed names, so repeated rows cost nothing, and a
    bucket of the index holds one edition's rows with one token and one initial.
    """

    def spread(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            rows = []
            for n, e, a, b, c, o in zip(pdf["node"], pdf["edition"], pdf["first"], pdf["middle"], pdf["last"], pdf["org"]):
                got = person_tokens(a, b, c)
                starts = {t: {t[0], *(x[0] for x in NICKNAMES.get(t, ()))} for t in got}
                keys = set()
                for i, t in enumerate(got):
                    if len(t) < 3 or t in SUFFIXES.values():
                        continue
                    others = {s for j, u in enumerate(got) if j != i and u not in SUFFIXES.values() for s in starts[u]}
                    keys |= {f"{v}|{s}" for v in deletes(t) for s in others}
                rows += [(n, e, k, o) for k in keys]
            yield pd.DataFrame(rows, columns=["node", "edition", "key", "org"])

    slim = people.select("node", "edition", "first", "middle", "last", "org", "orcid")
    # A hot bucket is split by organisation: rows of known organisations meet their own and the unknown ones.
    # Keys travel as 64-bit hashes; two that collide only cost a comparison of names. They are made and written once.
    made = slim.mapInPandas(spread, "node bigint, edition string, key string, org string")
    own = F.when(F.col("org").isNotNull(), F.xxhash64("edition", "key", "org"))
    keys = checkpoint(made.select("node", own.alias("own"), F.xxhash64("edition", "key").alias("any")))
    known = keys.where("own is not null").select(F.col("own").alias("k"), "node")
    close = known.withColumnRenamed("node", "x").join(known.withColumnRenamed("node", "y"), "k").where("x < y").select("x", "y")
    u, v = keys.where("own is null").select(F.col("any").alias("k"), F.col("node").alias("x")), keys.select(F.col("any").alias("k"), F.col("node").alias("y"))
    loose = u.join(v, "k").where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    orcids = slim.where(F.col("orcid").rlike(r"\d")).select("edition", "orcid", "node")
    hub = orcids.groupBy("edition", "orcid").agg(F.min("node").alias("x"))
    by_orcid = orcids.join(hub, ["edition", "orcid"]).select("x", F.col("node").alias("y")).where("x <> y")
    pairs = close.unionByName(loose).distinct()
    left = slim.select(F.col("node").alias("x"), F.struct("first", "middle", "last", "orcid").alias("p"))
    right = slim.select(F.col("node").alias("y"), F.struct("first", "middle", "last", "orcid").alias("q"))
    both = pairs.join(left, "x").join(right, "y").select("x", "y", "p.*", *[F.col(f"q.{c}").alias(c + "_2") for c in ("first", "middle", "last", "orcid")])

    def judge(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            rows = []
            for r in pdf.itertuples(index=False):
                if r[5] and r[9] and r[5] != r[9]:
                    continue
                if same_person(readings(r[2], r[3], r[4], given), readings(r[6], r[7], r[8], given)):
                    rows.append((r[0], r[1]))
            yield pd.DataFrame(rows, columns=["a", "b"])

    edges = both.mapInPandas(judge, "a bigint, b bigint")
    comps = components(edges.unionByName(by_orcid.select(F.col("x").alias("a"), F.col("y").alias("b"))))
    release(keys)
    return comps


def given_names(rows: DataFrame, share: float = 0.01) -> frozenset[str]:
    """Folded first tokens of at least ``share`` of the rows that state a last name; at most 1/share tokens."""
    first = F.lower(F.regexp_extract(F.coalesce("author_first_name", F.lit("")), r"^\s*([\p{L}\p{M}]{3,})", 1))
    stated = rows.where(F.coalesce("author_last_name", F.lit("")) != "").select(F.translate(first, "áàâãäçéèêëíïóôõöúüñ", "aaaaaceeeeiioooouun").alias("t"))
    counts = stated.groupBy("t").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    often = counts.crossJoin(F.broadcast(total)).where((F.col("n") >= F.lit(share) * F.col("total")) & (F.col("t") != ""))
    return frozenset(fold(r["t"]) for r in often.select("t").collect())


def link(authors: DataFrame, institutions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(persons, organisations) of an authors table.

    persons: (author_id, edition, first, middle, last, person) for rows of a person
    with more than one row; organisations: (author_id, inst_id, text). A null name
    part counts as ''. Rows delivered twice count once.
    """
    text = [
        "edition", "author_first_name", "author_middle_name", "author_last_name",
        "author_affiliation", "author_affiliation_en", "author_email", "orcid",
    ]
    rows = authors.where("author_id is not null").select("author_id", *text).dropDuplicates(["author_id"])
    both = rows.select(F.col("author_affiliation").alias("text")).unionByName(rows.select(F.col("author_affiliation_en").alias("text")))
    # both results are read several times: written once to the shared folder instead
    known = checkpoint(resolve_organisations(both, "text", institutions, "inst_id", "official_name", "official_name_en", "acronym"))
    mine = known.select(F.col("text").alias("author_affiliation"), F.col("inst").alias("i1"))
    theirs = known.select(F.col("text").alias("author_affiliation_en"), F.col("inst").alias("i2"))
    short = institutions.select(F.lower("acronym").alias("domain"), F.col("inst_id").alias("i3")).where("domain <> ''").dropDuplicates(["domain"])
    wide = (
        rows.join(mine, "author_affiliation", "left").join(theirs, "author_affiliation_en", "left")
        .withColumn("domain", F.lower(F.regexp_extract(F.coalesce("author_email", F.lit("")), r"@([^@.]+)\.", 1))).join(short, "domain", "left")
    )
    organisations = wide.where("i1 is not null").select("author_id", F.col("i1").alias("inst_id"), F.col("author_affiliation").alias("text"))
    flat = F.trim(F.regexp_replace(F.lower("author_affiliation"), r"[^\p{L}\p{N}]+", " "))
    other = F.when(flat != "", F.translate(flat, "áàâãäçéèêëíïóôõöúüñ", "aaaaaceeeeiioooouun"))
    org = F.coalesce(F.col("i1").cast("string"), F.col("i2").cast("string"), F.col("i3").cast("string"), other)
    named = wide.select(
        "author_id", F.coalesce("edition", F.lit("")).alias("edition"), F.coalesce("author_first_name", F.lit("")).alias("first"),
        F.coalesce("author_middle_name", F.lit("")).alias("middle"), F.coalesce("author_last_name", F.lit("")).alias("last"),
        org.alias("org"), F.when(F.col("orcid").rlike(r"\d"), F.col("orcid")).alias("orcid"),
    )
    nodes = named.withColumn("node", F.xxhash64("edition", "first", "middle", "last", F.coalesce("org", F.lit("\0")), F.coalesce("orcid", F.lit("\0"))))
    nodes = checkpoint(nodes)
    people = nodes.drop("author_id").dropDuplicates(["node"])
    comps = same_persons(people, given_names(rows))
    persons = nodes.join(comps, "node").select("author_id", "edition", "first", "middle", "last", F.col("comp").alias("person"))
    return persons, organisations
