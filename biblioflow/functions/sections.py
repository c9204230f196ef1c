"""Section codes."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

# Configured rules, words that form no initial, named kinds of section.
RULES = (
    {"priority": 1, "type": "keywords", "all": ("concurso", "alexandre", "direne"), "any": ("teses", "dissertações", "tcc", "trabalhos de conclusão"),
     "code": "CTD", "suffixes": ((("doutorado",), "D"), (("mestrado",), "M"), (("trabalhos de conclusão", "graduação", "de curso"), "G"))},
    {"priority": 2, "type": "keywords", "all": ("apps.edu",), "any": (), "code": "APPS", "suffixes": ((("produto",), "-P"), (("protótipo",), "-R"))},
)
STOP_WORDS = ("da", "de", "do", "dos", "das", "e", "o", "a", "os", "as", "em", "para", "no", "na", "nos", "nas")
KINDS = ((("editorial",), "EDT"), (("artigos completos", "full papers"), "ART-C"), (("artigos resumidos", "short papers"), "ART-R"))


def load_rules(path: str) -> tuple[dict, ...]:
    """Rules of a JSON file in priority order (999 when unstated); none for a missing or broken file."""
    try:
        found = json.loads(Path(path).read_text(encoding="utf-8")).get("mappings", [])
    except (OSError, ValueError):
        return ()
    rules = [
        {
            "priority": r.get("priority", 999), "type": r.get("type", ""), "all": tuple(r.get("match", {}).get("all_keywords", ())),
            "any": tuple(r.get("match", {}).get("any_keywords", ())), "code": r.get("base_sigla", ""),
            "suffixes": tuple((tuple(s.get("keywords", ())), s.get("suffix", "")) for s in r.get("suffixes", ())),
        }
        for r in found
    ]
    return tuple(sorted(rules, key=lambda r: r["priority"]))


def _has(name: Column, words: tuple[str, ...], every: bool) -> Column:
    test = F.lit(every)
    for w in words:
        hit = name.contains(w.lower())
        test = (test & hit) if every else (test | hit)
    return test


def mapped_code(name: Column, rules: tuple[dict, ...] = RULES) -> Column:
    """Code of the first rule by priority that a name satisfies, with its first fitting suffix; else null."""
    low = F.lower(name)
    out = None
    for r in sorted((r for r in rules if r["type"] == "keywords"), key=lambda r: r["priority"]):
        test = _has(low, r["all"], True)
        if r["any"]:
            test = test & _has(low, r["any"], False)
        suffix = F.lit("")
        for words, text in reversed(r["suffixes"]):
            suffix = F.when(_has(low, words, False), text).otherwise(suffix)
        code = F.concat(F.lit(r["code"]), suffix)
        out = F.when(test, code) if out is None else out.when(test, code)
    return F.lit(None).cast("string") if out is None else out


def section_code(name: Column, rules: tuple[dict, ...] = RULES) -> Column:
    """Short code of a section name: configured, by kind, its acronym, or initials of up to five words."""
    low = F.lower(name)
    out = F.when(F.coalesce(mapped_code(name, rules), F.lit("")) != "", mapped_code(name, rules))
    for words, code in KINDS:
        out = out.when(_has(low, words, False), code)
    acronym = F.regexp_extract(name, r"\(([A-Z][A-Z0-9-]+)\)", 1)
    words = F.filter(F.split(F.trim(name), r"\s+"), lambda w: (~F.lower(w).isin(*STOP_WORDS)) & (F.length(w) > 2))
    initials = F.array_join(F.transform(F.slice(words, 1, 5), lambda w: F.upper(F.substring(w, 1, 1))), "")
    return out.when(acronym != "", acronym).when(initials != "", initials).otherwise(F.replace(F.upper(F.substring(name, 1, 5)), F.lit(" "), F.lit("")))
