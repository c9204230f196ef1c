"""Page arrays of a paginated document and page ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from biblioflow.functions.text import SPACE, strip

# Words that mark a first page and a reference list.
INTRODUCTIONS = ("introducao", "introdução", "introduction")
REFERENCES = ("references", "referências", "referencias", "bibliography", "bibliografia", "referência", "referˆencia")


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return F.lower(text).rlike("|".join(words))


def trim_trailing(pages: Column) -> Column:
    """Pages without blank ones at the end; blank pages in between stay."""
    last = F.array_max(F.transform(pages, lambda p, i: F.when(p.rlike(rf"^(?:{SPACE})?$"), F.lit(0)).otherwise(i + 1)))
    return F.slice(pages, F.lit(1), F.coalesce(last, F.lit(0)))


def capped(pages: Column, most: int) -> Column:
    """The first ``most`` pages; 0 and negative numbers mean all."""
    return F.slice(pages, 1, most) if most > 0 else pages


def first_pages(pages: Column) -> Column:
    """Page 1 alone when it introduces the text or is the only one, else pages 1 and 2; no page gives ''."""
    one, two = F.try_element_at(pages, F.lit(1)), F.try_element_at(pages, F.lit(2))
    return F.when(F.size(pages) < 1, "").when((F.size(pages) < 2) | _any(one, INTRODUCTIONS), one).otherwise(F.concat(one, F.lit(", "), two))


def last_pages(pages: Column) -> Column:
    """The last page when it lists references or is the only one, else the last three.

    The third page from the end is '' unless there are more than three pages.
    """
    n = F.size(pages)
    last, second = F.try_element_at(pages, F.lit(-1)), F.try_element_at(pages, F.lit(-2))
    third = F.when(n > 3, F.try_element_at(pages, F.lit(-3))).otherwise("")
    return F.when(n < 1, "").when((n < 2) | _any(last, REFERENCES), last).otherwise(F.concat_ws(" ", third, second, last))


def extract(pages: Column, location: str) -> Column:
    """The first or last pages; another location is an error."""
    if location not in ("first", "last"):
        raise ValueError(f"invalid page location: {location}")
    return first_pages(pages) if location == "first" else last_pages(pages)


def page_range(first: Column, n: Column) -> Column:
    """'first-last' of n pages; a single page or a first page that is no number stays as it is."""
    bare = strip(F.coalesce(first, F.lit("")))
    number = bare.try_cast("bigint")
    digits = bare.rlike("^[0-9]+$")
    last = F.concat(number.cast("string"), F.lit("-"), (number + n - 1).cast("string"))
    return F.when(digits & (n == 1), number.cast("string")).when(digits, last).otherwise(F.coalesce(first, F.lit("")))
