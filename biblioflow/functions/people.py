"""Names and author cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from biblioflow.functions.text import SPACE, strip


def split_name(name: Column) -> tuple[Column, Column, Column]:
    """(first, middle, last); one part is a first name only, a blank name gives ''."""
    parts = F.filter(F.split(F.coalesce(name, F.lit("")), SPACE), lambda p: p != "")
    n = F.size(parts)
    first = F.when(n > 0, F.try_element_at(parts, F.lit(1))).otherwise("")
    middle = F.when(n > 2, F.array_join(F.slice(parts, F.lit(2), F.greatest(n - 2, F.lit(0))), " ")).otherwise("")
    last = F.when(n > 1, F.try_element_at(parts, F.lit(-1))).otherwise("")
    return first, middle, last


def full_name(first: Column, middle: Column, last: Column) -> Column:
    """First, middle where there is one, and last name; an empty last name leaves a blank at the end."""
    a, b, c = (F.coalesce(x, F.lit("")) for x in (first, middle, last))
    return F.when(b != "", F.concat_ws(" ", a, b, c)).otherwise(F.concat(a, F.lit(" "), c))


def author_text(author: Column) -> Column:
    """How an author struct reads: the full name."""
    return full_name(author["authorFirstName"], author["authorMiddleName"], author["authorLastName"])


def reference_text(reference: Column) -> Column:
    """How a reference struct reads: its description."""
    return F.coalesce(reference["description"], F.lit(""))


def author_cell(cell: Column) -> Column:
    """struct(name, affiliation, country) of 'name; affiliation; country[; ...]', null for fewer parts."""
    parts = F.split(cell, ";")
    got = F.struct(*[strip(F.try_element_at(parts, F.lit(i))).alias(n) for i, n in ((1, "name"), (2, "affiliation"), (3, "country"))])
    return F.when(F.size(parts) >= 3, got)


def split_abstract(text: Column) -> tuple[Column, Column]:
    """(original, English) of a text with the markers 'Resumo:' and 'Abstract:'; none gives ('', '')."""
    t = F.coalesce(text, F.lit(""))
    r, a = t.contains("Resumo:"), t.contains("Abstract:")
    before = strip(F.replace(F.split_part(t, F.lit("Abstract:"), F.lit(1)), F.lit("Resumo:"), F.lit("")))
    after = strip(F.split_part(t, F.lit("Abstract:"), F.lit(2)))
    original = F.when(r & a, before).when(r, strip(F.replace(t, F.lit("Resumo:"), F.lit("")))).otherwise("")
    english = F.when(r & a, after).when(a, strip(F.replace(t, F.lit("Abstract:"), F.lit("")))).otherwise("")
    return original, english


def json_part(text: Column) -> Column:
    """The widest object, or else the widest array, in a text; null where there is neither."""
    got = F.regexp_extract(text, r"(?s)\{.*\}|\[.*\]", 0)
    return F.when(got != "", got)
