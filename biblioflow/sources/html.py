"""Proceedings pages as tables: nodes of a contents page, cells of a metadata page, links.

Markup is read with the standard library's parser in a Python UDTF, so a page is one
row in and its nodes are rows out; everything after that is relational.
"""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from biblioflow.functions import ids, people
from biblioflow.operators.tables import assign_sections, carry_forward, nest, number_rows

_VOID = {"br", "img", "input", "meta", "link", "hr", "col", "area", "base", "source", "wbr"}


class _Tree(HTMLParser):
    """[(pos, parent, tag, class, href, text, only_string)] of every element in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[list] = []
        self.open: list[int] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        parent = self.open[-1] if self.open else -1
        if parent >= 0:
            self.nodes[parent][6] = False
        self.nodes.append([len(self.nodes), parent, tag, a.get("class") or "", a.get("href"), "", True])
        if tag not in _VOID:
            self.open.append(len(self.nodes) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[i]][2] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        for i in self.open:
            self.nodes[i][5] += data


def parse_nodes(markup: str | None) -> list[tuple]:
    tree = _Tree()
    tree.feed(markup or "")
    tree.close()
    return [tuple(n) for n in tree.nodes]


@udtf(returnType="pos int, parent int, tag string, css string, href string, text string, only_string boolean")
class HtmlNodes:
    """Every element of a page: position, parent, tag, class, link, text, whether it holds text alone."""

    def eval(self, markup: str):
        yield from parse_nodes(markup)


def nodes(pages: DataFrame, key: str, markup: str) -> DataFrame:
    """(key, pos, parent, tag, css, href, text, only_string) of every page; null and empty pages give none."""
    spark = pages.sparkSession
    spark.udtf.register("biblioflow_html_nodes", HtmlNodes)
    name = f"_pages_{abs(hash((key, markup))) % 10**8}"
    pages.select(F.col(key).alias("page"), F.col(markup).alias("markup")).createOrReplaceTempView(name)
    got = spark.sql(f"SELECT p.page, n.* FROM {name} p, LATERAL biblioflow_html_nodes(p.markup) n")
    return got.withColumnRenamed("page", key)


def pdf_links(found: DataFrame, key: str, most: int = -1) -> DataFrame:
    """Download addresses of anchors whose only string is 'PDF', in page order, at most ``most`` a page."""
    links = found.where((F.col("tag") == "a") & (F.col("text") == "PDF") & F.col("only_string") & F.col("href").isNotNull())
    links = links.withColumn("link_no", F.row_number().over(Window.partitionBy(key).orderBy("pos")))
    kept = links.where(F.col("link_no") <= most) if most >= 0 else links
    url = F.col("href")
    return kept.select(key, "link_no", ids.download_url(url).alias("url"), ids.file_name(ids.download_url(url)).alias("file_name"))


def _headings(found: DataFrame) -> DataFrame:
    return found.where((F.col("tag") == "h4") & F.col("css").contains("tocSectionTitle"))


def headings(found: DataFrame, key: str) -> DataFrame:
    """(key, head_pos, section) of every section heading of contents pages, those without entries and repeated ones too."""
    return _headings(found).select(key, F.col("pos").alias("head_pos"), F.trim("text").alias("section"))


def contents(found: DataFrame, key: str, most: int = -1) -> DataFrame:
    """Articles of contents pages: seq, heading, section, title, first page, identifier, metadata address.

    An entry belongs to the heading before it while only tables follow. An entry
    without a PDF link keeps the metadata address of the entry before it. ``most``
    keeps the first so many articles (-1: all).
    """
    # siblings of the headings only: nodes that share a heading's parent
    heads = _headings(found)
    level = heads.select(key, "parent").distinct()
    siblings = found.join(level, [key, "parent"])
    entries = assign_sections(siblings.select(key, "pos", "tag"), key, "pos", "tag")
    titles = headings(found, key)
    inner = found.where(F.col("css").isin("tocTitle", "tocPages") | (F.col("tag") == "a"))
    # an inner node lies in the last entry that starts before it
    marks = entries.select(key, "pos", "head_pos", F.lit("entry").alias("what"), F.lit(None).cast("string").alias("value"))
    what = F.when(F.col("css") == "tocTitle", "title").when(F.col("css") == "tocPages", "first_page").when(F.trim("text") == "PDF", "url")
    parts = inner.select(key, "pos", F.lit(None).cast("int").alias("head_pos"), what.alias("what"), F.coalesce(F.when(what == "url", F.col("href")), F.trim("text")).alias("value"))
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = marks.unionByName(parts.where("what is not null")).withColumn("entry", F.last(F.when(F.col("what") == "entry", F.col("pos")), True).over(w))
    wide = both.where("entry is not null").groupBy(key, "entry").agg(
        F.max("head_pos").alias("head_pos"), *[F.first(F.when(F.col("what") == n, F.col("value")), True).alias(n) for n in ("title", "first_page", "url")]
    )
    rows = wide.join(titles, [key, "head_pos"]).withColumn("meta", ids.metadata_url(F.col("url")))
    rows = carry_forward(rows, "meta", [F.col("entry")], "metadata_url", key)
    rows = number_rows(rows, [F.col(key), F.col("entry")], "seq")
    rows = rows.where(F.col("seq") <= most) if most >= 0 else rows
    return rows.select(
        key, "seq", "head_pos", "section", F.coalesce("title", F.lit("")).alias("title_orig"), F.coalesce("first_page", F.lit("")).alias("first_page"),
        F.coalesce(ids.page_key(F.col("url")), F.lit("No PDF link found")).alias("id_jems"), "metadata_url",
    )


def labelled_cells(found: DataFrame, key: str, labels: dict[str, str]) -> DataFrame:
    """One row per page: for each label the text of the cell after the first one that contains it, else ''."""
    cells = found.where("tag = 'td'")
    after = F.lead("text").over(Window.partitionBy(key, "parent").orderBy("pos"))
    pairs = cells.withColumn("after", after)
    columns: list[Column] = []
    for name, label in labels.items():
        hit = F.when(F.col("only_string") & F.col("text").rlike(label), F.struct("pos", "after"))
        columns.append(F.coalesce(F.trim(F.min(hit)["after"]), F.lit("")).alias(name))
    return pairs.groupBy(key).agg(*columns)


def page_authors(found: DataFrame, key: str) -> DataFrame:
    """Authors of metadata pages: the value two cells after every 'Autor' cell, split at semicolons."""
    cells = found.where("tag = 'td'").select(key, "pos", "parent", "text")
    nxt = F.lead(F.struct("pos", "parent")).over(Window.partitionBy(key).orderBy("pos"))
    sibling = F.lead("text").over(Window.partitionBy(key, "parent").orderBy("pos"))
    wide = cells.withColumn("next", nxt).withColumn("sibling", sibling)
    values = wide.select(key, F.col("pos").alias("vpos"), F.col("sibling").alias("value"))
    hits = wide.where(F.col("text").contains("Autor")).select(key, "pos", F.col("next.pos").alias("vpos"))
    got = hits.join(values, [key, "vpos"]).withColumn("cell", people.author_cell(F.col("value"))).where("cell is not null")
    first, middle, last = people.split_name(F.col("cell.name"))
    order = F.row_number().over(Window.partitionBy(key).orderBy("pos")).cast("bigint")
    return got.select(
        key, order.alias("item_order"), first.alias("author_first_name"), middle.alias("author_middle_name"), last.alias("author_last_name"),
        F.col("cell.affiliation").alias("author_affiliation"), F.col("cell.country").alias("author_country"),
    )


def metadata(found: DataFrame, key: str) -> DataFrame:
    """One row per metadata page: title, DOI, original and English abstract, authors in order; '' and [] where a page has none.

    The English abstract is read but left out of an article, as the site's records have it.
    """
    cells = labelled_cells(found, key, {"title": "Título do documento", "doi": r"Digital Object Identifier \(DOI\)", "text": "Resumo|Abstract"})
    original, english = people.split_abstract(F.col("text"))
    fields = ["author_first_name", "author_middle_name", "author_last_name", "author_affiliation", "author_country"]
    facts = cells.select(key, "title", ids.normalize_doi(F.col("doi")).alias("doi"), original.alias("abstract_orig"), english.alias("abstract_en"))
    return nest(facts, page_authors(found, key), key, ["item_order"], fields, "authors")
