"""DOIs and article identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from biblioflow.functions.text import strip

PREFIX = r"^(10\.\d+/[^/]+\.\d+)\."


def normalize_doi(doi: Column, host: str = "doi.org") -> Column:
    """A DOI without surrounding white space and resolver address; null gives ''."""
    return F.regexp_replace(strip(F.coalesce(doi, F.lit(""))), rf"^https?://(dx\.)?{host.replace('.', chr(92) + '.')}/", "")


def doi_prefix(doi: Column) -> Column:
    """The part up to the last dotted number but one, with its dot; null where there is none."""
    got = F.regexp_extract(doi, PREFIX, 1)
    return F.when(got != "", F.concat(got, F.lit(".")))


def complete_doi(doi: Column, prefix: Column, year: Column, first_page: Column, host: str = "doi.org") -> Column:
    """The normalised DOI, or one made of prefix, year and first page, or ''."""
    own = normalize_doi(doi, host)
    made = F.concat(F.regexp_replace(prefix, "/+$", ""), year, F.lit("."), first_page)
    can = (F.coalesce(prefix, F.lit("")) != "") & (F.coalesce(first_page, F.lit("")) != "")
    return F.when(own != "", own).when(can, made).otherwise("")


def page_key(url: Column) -> Column:
    """Identifier of an article page: last path segment, '.pdf' removed, percent-decoded ('+' stays)."""
    path = F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    segment = F.replace(F.element_at(F.split(path, "/"), -1), F.lit(".pdf"), F.lit(""))
    return F.try_url_decode(F.replace(segment, F.lit("+"), F.lit("%2B")))


def file_name(url: Column) -> Column:
    """Name a download is stored under: last segment as it stands, '.pdf' appended when missing."""
    segment = F.element_at(F.split(url, "/"), -1)
    return F.when(segment.endswith(".pdf"), segment).otherwise(F.concat(segment, F.lit(".pdf")))


def file_key(url: Column) -> Column:
    """Identifier of a stored file: its name without extension."""
    return F.regexp_replace(file_name(url), r"\.[^.]*$", "")


def download_url(url: Column) -> Column:
    return F.replace(url, F.lit("view"), F.lit("download"))


def metadata_url(url: Column) -> Column:
    return F.replace(url, F.lit("article/view"), F.lit("rt/metadata"))
