"""From contents pages, metadata pages and PDF files to the published tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioflow import completion, sinks
from biblioflow.functions import ids, pages, sections, text
from biblioflow.operators import tables
from biblioflow.session import checkpoint
from biblioflow.sources import files, html

Make = Callable[[], completion.Provider]
# Names of the snapshots before and after completion, fields of a record that completion may replace.
SNAPSHOTS = ("articles_metadata_antes_do_field_completion", "articles_metadata_apos_do_field_completion")
FIELDS = ("titleOrig", "titleEn", "abstractOrig", "abstractEn", "keywordsOrig", "keywordsEn")
RECORD = (
    "struct<language:string," + ",".join(f"{f}:string" for f in FIELDS)
    + f",doi:string,authors:array<{completion.AUTHOR}>,references:array<struct<description:string,doi:string,link:string,accessed:string>>>"
)


def site_sections(found: DataFrame, key: str) -> DataFrame:
    """Every heading of contents pages with its code; codes are unique in page order, repeated titles and empty sections included."""
    heads = html.headings(found, key).withColumn("code", sections.section_code(F.col("section")))
    return tables.make_unique(heads, "code", [F.col(key), F.col("head_pos")], "section_abbrev").drop("code")


def section_table(heads: DataFrame, key: str = "page") -> DataFrame:
    """The section table in page order, never limited."""
    return heads.select(
        F.col(key).alias("_page"), "head_pos", F.col("section").alias("sectionTitle"), F.col("section").alias("sectionTitleEn"), F.col("section_abbrev").alias("sectionAbbrev")
    )


def site_articles(found: DataFrame, heads: DataFrame, metadata_pages: DataFrame | None = None, key: str = "page", most: int = -1) -> DataFrame:
    """Entries of contents pages with their section codes and what their metadata pages state.

    metadata_pages(url, markup) is joined by address; an entry without a page has ''.
    The page's title collides with the entry's and is kept as ``title_orig2``.
    """
    toc = html.contents(found, key, most).join(heads.select(key, "head_pos", "section_abbrev"), [key, "head_pos"])
    if metadata_pages is None:
        return toc.withColumns({"title_orig2": F.lit(""), "doi": F.lit(""), "site_authors": F.lit(None).cast("array<string>"), "site_abstract": F.lit("")})
    one = metadata_pages.where("url is not null").groupBy("url").agg(F.max("markup").alias("markup"))
    stated = html.metadata(html.nodes(one, "url", "markup"), "url").select(
        F.col("url").alias("metadata_url"), F.col("title").alias("title_orig2"), "doi", F.col("authors").alias("site_authors"), F.col("abstract_orig").alias("site_abstract")
    )
    return toc.join(stated, "metadata_url", "left").withColumns({c: F.coalesce(c, F.lit("")) for c in ("title_orig2", "doi", "site_abstract")})


def landed_documents(spark: SparkSession, contents_pages: DataFrame, folder: str, most: int = -1, most_pages: int = 11, get=files.fetch, extract=files.extract_pages) -> DataFrame:
    """Documents of the PDF links of contents pages: fetched where absent, then every file of the folder is read."""
    links = html.pdf_links(html.nodes(contents_pages, "page", "markup"), "page", most)
    files.land(links, "url", folder, get)
    return files.documents(spark, folder, most_pages, extract)


def clean_pages(df: DataFrame, column: str, make: Make, prompt: str = "") -> DataFrame:
    """Texts without a sign of a wrong encoding are cleaned, the others go to the repairing client."""
    asked = df.withColumns({"_raw": F.col(column), "_bad": text.has_encoding_error(F.col(column))})
    fixed = completion.repair_text(asked, column, F.col("_bad"), make, prompt)
    # without an answer the basic cleaning is left
    done = F.when(F.col("_bad") & (F.col(column) != F.col("_raw")), F.col(column)).otherwise(text.clean(F.col("_raw")))
    return fixed.withColumn(column, done).drop("_raw", "_bad")


def prefix_of(site: DataFrame, read: DataFrame) -> str:
    """The most common DOI prefix of the entries: the site's DOI before the document's, in page order."""
    both = site.join(read.select("id_jems", F.col("article.doi").alias("_d")), "id_jems", "left")
    pool = both.select("seq", F.posexplode(F.array("doi", "_d")).alias("_s", "_v"))
    pool = pool.select("seq", "_s", ids.doi_prefix(ids.normalize_doi(F.col("_v"))).alias("p"))
    best = tables.most_common(pool, "p", ["seq", "_s"]).first()
    return best["p"] if best else ""


def extract(contents_pages: DataFrame, documents: DataFrame, make: Make, folder: str, metadata_pages: DataFrame | None = None, prefix: str = "", year: str = "", most: int = -1, repair: Make | None = None, prompts: dict[str, str] | None = None) -> DataFrame:
    """Articles as the site and the documents state them, published and written as a snapshot ahead of completion.

    documents(id_jems, text_pages, num_pages[, position or file_name]) is reduced to
    the ids on the site before any model call; of one id the last document counts. The
    document's fields replace the site's; section, first page and a stated DOI stay.
    """
    prompts = prompts or {}
    found = checkpoint(html.nodes(contents_pages, "page", "markup"))
    heads = checkpoint(site_sections(found, "page"))
    site = checkpoint(site_articles(found, heads, metadata_pages, "page", most))
    place = [c for c in ("position", "file_name") if c in documents.columns] or ["text_pages"]
    docs = documents.join(site.select("id_jems").distinct(), "id_jems", "left_semi")
    docs = tables.last_wins(docs.select("id_jems", "text_pages", "num_pages", F.struct(*place).alias("_last")), "id_jems", ["_last"])
    paged = docs.select("id_jems", "num_pages", pages.first_pages(F.col("text_pages")).alias("first"), pages.last_pages(F.col("text_pages")).alias("last"))
    for column in ("first", "last"):
        paged = clean_pages(paged, column, repair or completion.Offline.empty, prompts.get("text_processing", ""))
    read = checkpoint(completion.extract_articles(paged, "first", "last", make, (prompts.get("article_extraction", ""), prompts.get("references_extraction", ""))))
    prefix = prefix or prefix_of(site, read)
    both = site.join(read, "id_jems")
    merged = both.select(
        F.col("seq").alias("_site"), "language", F.col("section_abbrev").alias("sectionAbbrev"), *[F.col("article")[f].alias(f) for f in FIELDS],
        F.col("title_orig2").alias("titleOrig2"), pages.page_range(F.col("first_page"), F.col("num_pages")).alias("pages"), F.col("id_jems").alias("idJEMS"),
        ids.complete_doi(F.col("doi"), F.lit(prefix), F.lit(year), F.col("first_page")).alias("doi"), F.col("article.authors").alias("authors"), F.col("refs").alias("references"),
    )
    before = checkpoint(tables.number_rows(merged, [F.col("_site")], "seq").drop("_site"))
    sinks.write_sections(section_table(heads).orderBy("_page", "head_pos"), folder)
    sinks.write_snapshot(before, str(Path(folder, SNAPSHOTS[0])))
    publish(before, folder, True)
    return before


def finish(before: DataFrame, make: Make, folder: str, prompts: dict[str, str] | None = None) -> DataFrame:
    """Records with an empty field, completed by a model, published and written as a snapshot.

    Every field counts as empty or not, authors, pages and ids included, and the whole
    record is sent. What the answer leaves out is empty afterwards; number, id, section
    and pages stay as they were.
    """
    whole = [c for c in before.columns if c != "titleOrig2"]
    gate = tables.needs_completion(before.select(*whole), ("titleOrig", "titleEn"), "sectionAbbrev")
    payload = F.to_json(F.struct(*whole), {"ignoreNullFields": "false"})
    after = checkpoint(completion.complete_rows(before, gate, payload, RECORD, make, prompt=(prompts or {}).get("field_completion", "")))
    sinks.write_snapshot(after, str(Path(folder, SNAPSHOTS[1])))
    publish(after, folder, False)
    return after


def replay(spark: SparkSession, make: Make, folder: str, schema, prompts: dict[str, str] | None = None) -> DataFrame:
    """The second half of a run from the snapshot of the first."""
    return finish(files.read_snapshot(spark, str(Path(folder, SNAPSHOTS[0] + ".json")), schema), make, folder, prompts)


def correct_affiliations(authors: DataFrame, make: Make, prompt: str = "", size: int = 20) -> DataFrame:
    """Authors with the affiliations that a model gives for chunks of ``size`` rows, sent as a table with its header.

    Distinct answers for one affiliation repeat the author, an affiliation without one becomes null.
    """
    pair = ["authorAffiliation", "authorAffiliationEn"]
    bodies = tables.chunks(authors, [F.col("article"), F.col("order")], sinks.csv_line([F.col(c) for c in pair]), size, ";".join(pair))
    mapping = checkpoint(completion.correct_affiliations(bodies, "body", make, prompt).distinct())
    new = mapping.select(F.col("originalAuthorAffiliation").alias("_k"), *[F.col(c).alias(f"_{c}") for c in pair])
    joined = authors.join(new, F.col("authorAffiliation").eqNullSafe(F.col("_k")), "left")
    return joined.withColumns({c: F.col(f"_{c}") for c in pair}).drop("_k", *[f"_{c}" for c in pair])


def run(contents_pages: DataFrame, documents: DataFrame, make: Make, folder: str, metadata_pages: DataFrame | None = None, prefix: str = "", year: str = "", most: int = -1, repair: Make | None = None, prompts: dict[str, str] | None = None) -> DataFrame:
    """Extract, complete and publish; returns the completed articles."""
    return finish(extract(contents_pages, documents, make, folder, metadata_pages, prefix, year, most, repair, prompts), make, folder, prompts)


def publish(articles: DataFrame, folder: str, before: bool) -> None:
    """The three tables of all articles, and by section."""
    keyed = articles.withColumnRenamed("seq", "article")
    authors = tables.unnest(keyed.where("authors is not null"), "authors", ["article"], "order")
    references = tables.unnest(keyed.where("references is not null"), "references", ["article"], "order")
    sinks.write_tables(articles, authors, references, folder, before)
    sinks.write_by_section(articles, authors, references, folder, before)
