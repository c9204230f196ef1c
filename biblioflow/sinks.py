"""Published CSV tables and JSON snapshots."""

from __future__ import annotations

import csv
import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioflow.operators.tables import number_within, project
from biblioflow.session import checkpoint

# Column order of the published tables.
ARTICLES = ("seq", "language", "sectionAbbrev", "titleOrig", "titleEn", "abstractOrig", "abstractEn", "keywordsOrig", "keywordsEn", "pages", "idJEMS", "doi")
AUTHORS = (
    "article", "authorFirstName", "authorMiddleName", "authorLastName", "authorAffiliation", "authorAffiliationEn", "authorCountry", "authorEmail", "orcid", "order",
)
REFERENCES = ("article", "description", "doi", "link", "accessed", "order")
SECTIONS = ("sectionTitle", "sectionTitleEn", "sectionAbbrev", "blind", "numSubmitted", "numAccepted", "dateSub", "dateResult", "dateReady")
BEFORE = "antes_"


def published(df: DataFrame, headers: tuple[str, ...]) -> DataFrame:
    return project(df, {h: h for h in headers})


def write_csv(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """A distributed CSV table: ';', every cell quoted, quotes doubled, CRLF, a header per file."""
    w = df.write.mode("overwrite").option("sep", ";").option("quoteAll", True).option("escape", '"').option("header", True)
    w = w.option("emptyValue", "").option("nullValue", "").option("lineSep", "\r\n")
    (w.partitionBy(partition_by) if partition_by else w).csv(path)


def write_csv_file(df: DataFrame, path: str, order: list[str]) -> int:
    """One file of exactly this name, rows in order, streamed through the driver a partition at a time."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    n = 0
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, delimiter=";", quoting=csv.QUOTE_ALL)
        writer.writerow(df.columns)
        for row in df.orderBy(*order).toLocalIterator():
            writer.writerow(["" if v is None else v for v in row])
            n += 1
    return n


def write_tables(articles: DataFrame, authors: DataFrame, references: DataFrame, folder: str, before: bool = False) -> None:
    """The article, author and reference tables; ``before`` marks the state ahead of completion."""
    prefix = BEFORE if before else ""
    for df, headers, name in ((articles, ARTICLES, "Artigos"), (authors, AUTHORS, "Autores"), (references, REFERENCES, "Referencias")):
        write_csv(published(df, headers), str(Path(folder, f"{prefix}{name}.csv")))


def load_headers(path: str) -> dict[str, tuple[str, ...]]:
    """Ordered column lists of a JSON file, by table."""
    return {k: tuple(v) for k, v in json.loads(Path(path).read_text(encoding="utf-8")).items()}


def write_by_section(articles: DataFrame, authors: DataFrame, references: DataFrame, folder: str, before: bool = False) -> None:
    """Article, author and reference tables by section, articles numbered from 1 in each; one directory per section.

    Authors and references name their article by its number in the section. Rows
    without a section form the section UNKNOWN.
    """
    known = articles.withColumn("sectionAbbrev", F.coalesce("sectionAbbrev", F.lit("UNKNOWN"))).withColumnRenamed("seq", "_pos")
    own = checkpoint(number_within(known, "sectionAbbrev", [F.col("_pos")]))
    place = own.select(F.col("_pos").alias("article"), "seq", F.col("sectionAbbrev").alias("section"))
    prefix = BEFORE if before else ""
    tables = [(published(own, ARTICLES).withColumn("section", F.col("sectionAbbrev")), "Artigos")]
    for items, headers, name in ((authors, AUTHORS, "Autores"), (references, REFERENCES, "Referencias")):
        mine = items.join(place, "article").drop("article").withColumnRenamed("seq", "article")
        tables.append((project(mine, {h: h for h in (*headers, "section")}), name))
    for table, name in tables:
        write_csv(table, str(Path(folder, "por_workshop", prefix + name)), "section")


def write_sections(sections: DataFrame, folder: str) -> None:
    write_csv(published(sections, SECTIONS), str(Path(folder, "Secoes.csv")))


def write_snapshot(df: DataFrame, path: str) -> None:
    """JSON lines that `sources.files.read_snapshot` reads back; nulls are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path if path.endswith(".json") else path + ".json")


def write_json_file(df: DataFrame, path: str, order: list[str]) -> int:
    """One file with one indented array, rows in order, streamed through the driver a partition at a time; nulls are kept."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    n = 0
    with open(path, "w", encoding="utf-8") as out:
        for row in df.orderBy(*order).toLocalIterator():
            text = json.dumps(row.asDict(recursive=True), ensure_ascii=False, indent=2)
            out.write(("[\n  " if not n else ",\n  ") + text.replace("\n", "\n  "))
            n += 1
        out.write("\n]" if n else "[]")
    return n


def dump_documents(documents: DataFrame, folder: str) -> None:
    """Pages of every document as JSON, for a look at what was read."""
    write_snapshot(documents, str(Path(folder, "text")))


def csv_line(columns: list[Column]) -> Column:
    """One line of a table for a model call: ';' between cells, cells quoted where they need it, '' for null."""
    def cell(c: Column) -> Column:
        t = F.coalesce(c.cast("string"), F.lit(""))
        quoted = F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(t.rlike('[;"\r\n]'), quoted).otherwise(t)

    return F.concat_ws(";", *[cell(c) for c in columns])
