"""Registered queries of the engine's own operators, each beside the SQL that says the same.

Site side: ``articles``, ``authors``, ``bib_references``, ``sections``. Document side:
``documents`` with one page to a line. URLs, cells and marked texts that the tables
lack are made from keys in the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioflow.functions import ids, pages, people, sections, text
from biblioflow.operators import multivalue
from biblioflow.operators import tables as T
from biblioflow.session import spread, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
HOST = "doi.example"


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


@query()
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = spread(table(spark, sf_dir, "articles", "seq", "keywords_orig", "keywords_en"))
    got = multivalue.split_values(articles, "seq", ["keywords_orig", "keywords_en"])
    return got.select("seq", "field", "pos", F.col("value").alias("keyword_text"))


def _lines(column: str = "text"):
    """Pages of a text: its lines."""
    return F.split(F.coalesce(F.col(column), F.lit("")), "\n")


# SQL pieces that several statements share
_SP = r"[\s\x0b\x1c-\x1f\x85\pZ]"
_CLEAN = "trim(regexp_replace(regexp_replace({0}, '" + _SP + r"+', ' ', 'g'), '[\x00-\x1f\x7f]', '', 'g'), ' ')"
_STRIP = "regexp_replace({0}, '^" + _SP + "+|" + _SP + "+$', '', 'g')"
_PAGES = "string_split(coalesce({0}, ''), chr(10))"
_TRIM = (
    "list_slice({0}, 1, coalesce(list_max(list_transform(range(1, len({0}) + 1), lambda i: CASE WHEN regexp_full_match({0}[i], '"
    + _SP + "*') THEN 0 ELSE i END)), 0))"
)
_DOI = "regexp_replace(" + _STRIP.format("coalesce({0}, '')") + r", '^https?://(dx\.)?doi\.example/', '')"
_RANGE = (
    "CASE WHEN regexp_full_match({0}, '[0-9]+') AND {1} = 1 THEN CAST(CAST({0} AS BIGINT) AS VARCHAR) "
    "WHEN regexp_full_match({0}, '[0-9]+') THEN CAST(CAST({0} AS BIGINT) AS VARCHAR) || '-' || CAST(CAST({0} AS BIGINT) + {1} - 1 AS VARCHAR) ELSE {0} END"
)
_ART = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY loaded_at DESC) AS _k FROM articles) WHERE _k = 1)"


def _articles(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return T.last_wins(table(spark, sf_dir, "articles", "seq", "loaded_at", *columns), "seq", ["loaded_at"])


@query(
    "WITH site AS (SELECT id_jems, seq, section_abbrev AS section, title_orig AS title2, split_part(coalesce(pages, ''), '-', 1) AS first_page, doi, edition FROM "
    + _ART + "), docs AS (SELECT id_jems, " + _TRIM.format("p") + " AS p FROM (SELECT id_jems, " + _PAGES.format("text")
    + " AS p FROM (SELECT *, row_number() OVER (PARTITION BY id_jems ORDER BY ingested_at DESC, doc_id DESC) AS k FROM documents WHERE id_jems IS NOT NULL) WHERE k = 1)), "
    "d AS (SELECT id_jems, CASE WHEN len(p) > 0 THEN " + _CLEAN.format("p[1]") + " ELSE '' END AS title_orig, least(len(p), 11) AS n FROM docs) "
    "SELECT site.id_jems, seq, section, title_orig, title2 AS title_orig2, first_page, " + _RANGE.format("first_page", "n")
    + " AS pages, CASE WHEN " + _DOI.format("doi") + " <> '' THEN " + _DOI.format("doi")
    + " WHEN first_page <> '' THEN '10.99999/proc.' || edition || '.' || first_page ELSE '' END AS doi, CAST(n AS BIGINT) AS num_pages FROM site JOIN d ON site.id_jems = d.id_jems"
)
def merge_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: site articles merged with their paginated documents."""
    art = _articles(spark, sf_dir, "id_jems", "section_abbrev", "title_orig", "pages", "doi", "edition")
    site = art.select(
        "id_jems", "seq", F.col("section_abbrev").alias("section"), F.col("title_orig").alias("title2"),
        F.split_part(F.coalesce("pages", F.lit("")), F.lit("-"), F.lit(1)).alias("first_page"), "doi", "edition",
    )
    docs = table(spark, sf_dir, "documents", "id_jems", "text", "ingested_at", "doc_id").where("id_jems is not null")
    # the text itself stays out of the aggregation: only what the merge needs is computed first
    trimmed = pages.trim_trailing(_lines())
    slim = docs.select("id_jems", "ingested_at", "doc_id", F.coalesce(text.basic_clean(F.try_element_at(trimmed, F.lit(1))), F.lit("")).alias("title_orig"), F.least(F.size(trimmed), F.lit(11)).alias("num_pages"))
    one = T.last_wins(slim, "id_jems", ["ingested_at", "doc_id"])
    return T.merge(site, one, HOST, "10.99999/proc.", F.col("edition"))


@query("SELECT doc_id, md5(" + _CLEAN.format("coalesce(text, '')") + ") AS hash, CAST(length(" + _CLEAN.format("coalesce(text, '')") + ") AS BIGINT) AS n FROM documents")
def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    done = text.clean(F.col("text"))
    return docs.select("doc_id", F.md5(done).alias("hash"), F.length(done).cast("bigint").alias("n"))


@query(
    "SELECT seq, coalesce(regexp_matches(title_orig, '´ı|c¸˜a|´o|´e|˜a|˜o|¸c|´a|´i|´u'), false) AS title_flag, "
    "coalesce(regexp_matches(abstract_orig, '´ı|c¸˜a|´o|´e|˜a|˜o|¸c|´a|´i|´u'), false) AS abstract_flag FROM " + _ART
)
def encoding_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    art = _articles(spark, sf_dir, "title_orig", "abstract_orig")
    return art.select("seq", text.has_encoding_error(F.col("title_orig")).alias("title_flag"), text.has_encoding_error(F.col("abstract_orig")).alias("abstract_flag"))


@query(
    "SELECT doc_id, CAST(least(len(p), 11) AS BIGINT) AS num_pages, md5(array_to_string(list_slice(p, 1, 11), '|')) AS hash FROM (SELECT doc_id, "
    + _TRIM.format("p") + " AS p FROM (SELECT doc_id, " + _PAGES.format("text") + " AS p FROM documents))"
)
def paginate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("p", pages.capped(pages.trim_trailing(_lines()), 11))
    return docs.select("doc_id", F.size("p").cast("bigint").alias("num_pages"), F.md5(F.array_join("p", "|")).alias("hash"))


@query(
    "SELECT doc_id, md5(CASE WHEN len(p) < 2 OR regexp_matches(lower(p[1]), 'introducao|introdução|introduction') THEN p[1] ELSE p[1] || ', ' || p[2] END) AS hash FROM (SELECT doc_id, "
    + _PAGES.format("text") + " AS p FROM documents)"
)
def first_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.md5(pages.first_pages(_lines())).alias("hash"))


@query(
    "SELECT doc_id, md5(CASE WHEN len(p) < 2 OR regexp_matches(lower(p[-1]), 'references|referências|referencias|bibliography|bibliografia|referência|referˆencia') THEN p[-1] "
    "ELSE CASE WHEN len(p) > 3 THEN p[-3] ELSE '' END || ' ' || p[-2] || ' ' || p[-1] END) AS hash FROM (SELECT doc_id, "
    + _PAGES.format("CASE WHEN doc_id % 4 = 0 THEN text || ' references' ELSE text END") + " AS p FROM documents)"
)
def last_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit(" references"))).otherwise(F.col("text")))
    return docs.select("doc_id", F.md5(pages.last_pages(_lines())).alias("hash"))


_FIRST = "CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) WHEN 1 THEN '00' || CAST(o_orderkey AS VARCHAR) WHEN 2 THEN 'iv' WHEN 3 THEN '' ELSE '12-20' END"


@query("SELECT o_orderkey, " + _RANGE.format("f", "n") + " AS pages FROM (SELECT o_orderkey, " + _FIRST + " AS f, o_orderkey % 4 + 1 AS n FROM orders)")
def update_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    first = F.when(k % 5 == 0, k.cast("string")).when(k % 5 == 1, F.concat(F.lit("00"), k.cast("string"))).when(k % 5 == 2, "iv").when(k % 5 == 3, "").otherwise("12-20")
    return table(spark, sf_dir, "orders", "o_orderkey").select("o_orderkey", pages.page_range(first, k % 4 + 1).alias("pages"))


@query("SELECT seq, " + _DOI.format("doi") + " AS doi FROM " + _ART)
def doi_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir, "doi").select("seq", ids.normalize_doi(F.col("doi"), HOST).alias("doi"))


@query(
    "SELECT seq, CASE WHEN " + _DOI.format("doi") + " <> '' THEN " + _DOI.format("doi")
    + " WHEN split_part(coalesce(pages, ''), '-', 1) <> '' THEN '10.99999/ab.cd.' || year(loaded_at) || '.' || split_part(coalesce(pages, ''), '-', 1) ELSE '' END AS doi FROM " + _ART
)
def doi_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    art = T.last_wins(table(spark, sf_dir, "articles", "seq", "loaded_at", "doi", "pages").withColumn("at", F.col("loaded_at")), "seq", ["at"])
    first = F.split_part(F.coalesce("pages", F.lit("")), F.lit("-"), F.lit(1))
    return art.select("seq", ids.complete_doi(F.col("doi"), F.lit("10.99999/ab.cd."), F.year("loaded_at").cast("string"), first, HOST).alias("doi"))


@query(
    "SELECT prefix, n FROM (SELECT prefix, count(*) AS n, min(o_orderkey) AS f FROM (SELECT o_orderkey, '10.5753/ab' || (o_orderkey % 3) || '.' || year(o_orderdate) || '.' AS prefix FROM orders WHERE o_orderkey % 7 <> 0) "
    "GROUP BY prefix ORDER BY n DESC, f LIMIT 1)"
)
def doi_prefix_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    made = F.concat(F.lit("https://doi.org/10.5753/ab"), (k % 3).cast("string"), F.lit("."), F.year("o_orderdate").cast("string"), F.lit("."), k.cast("string"))
    doi = F.when(k % 7 == 0, "10.5753/abc.12").otherwise(made)
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").select("o_orderkey", ids.doi_prefix(ids.normalize_doi(doi)).alias("prefix"))
    return T.most_common(orders, "prefix", ["o_orderkey"])


@query(
    "SELECT prefix, n FROM (SELECT prefix, count(*) AS n, min((seq, source, ref)) AS f FROM (SELECT seq, 0 AS source, 0 AS ref, '10.5753/ab' || (seq % 4) || '.2019.' AS prefix FROM " + _ART
    + " WHERE seq % 3 <> 0 UNION ALL SELECT article, 1, ref_id, '10.5753/ab' || (ref_id % 5) || '.2019.' FROM (SELECT DISTINCT article, ref_id FROM bib_references WHERE article IN (SELECT seq FROM articles))) "
    "GROUP BY prefix ORDER BY n DESC, f LIMIT 1)"
)
def doi_pool_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool of a prefix: an article's own DOI, where it has one, comes before those of its documents."""
    def made(k, parts: int):
        return F.concat(F.lit("https://doi.org/10.5753/ab"), (k % parts).cast("string"), F.lit(".2019."), k.cast("string"))

    art = _articles(spark, sf_dir, "id_jems").select("seq", F.lit(0).alias("source"), F.lit(0).cast("bigint").alias("ref"), F.when(F.col("seq") % 3 != 0, made(F.col("seq"), 4)).alias("doi"))
    refs = table(spark, sf_dir, "bib_references", "ref_id", "article").distinct().join(art.select(F.col("seq").alias("article")), "article", "left_semi")
    pool = art.unionByName(refs.select(F.col("article").alias("seq"), F.lit(1).alias("source"), F.col("ref_id").alias("ref"), made(F.col("ref_id"), 5).alias("doi")))
    return T.most_common(pool.withColumn("prefix", ids.doi_prefix(ids.normalize_doi(F.col("doi")))), "prefix", ["seq", "source", "ref"])


_URL = "'http://host.example/index.php/x/article/view/' || doc_id || '/a%20b+' || doc_id || CASE doc_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.pdf?x=1' ELSE '' END"


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    tail = F.when(k % 3 == 0, ".pdf").when(k % 3 == 1, ".pdf?x=1").otherwise("")
    url = F.concat(F.lit("http://host.example/index.php/x/article/view/"), k.cast("string"), F.lit("/a%20b+"), k.cast("string"), tail)
    return table(spark, sf_dir, "documents", "doc_id").select("doc_id", url.alias("url"))


@query("SELECT doc_id, 'a b+' || doc_id AS page_key, CASE doc_id % 3 WHEN 1 THEN 'a%20b+' || doc_id || '.pdf?x=1' ELSE 'a%20b+' || doc_id END AS file_key FROM documents")
def url_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return _urls(spark, sf_dir).select("doc_id", ids.page_key(url).alias("page_key"), ids.file_key(url).alias("file_key"))


@query(f"SELECT doc_id, replace({_URL}, 'view', 'download') AS url FROM documents")
def url_download_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urls(spark, sf_dir).select("doc_id", ids.download_url(F.col("url")).alias("url"))


@query(f"SELECT doc_id, replace({_URL}, 'article/view', 'rt/metadata') AS url FROM documents")
def url_metadata_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urls(spark, sf_dir).select("doc_id", ids.metadata_url(F.col("url")).alias("url"))


@query(
    "SELECT seq, coalesce(last_value(u IGNORE NULLS) OVER (PARTITION BY edition ORDER BY seq ROWS UNBOUNDED PRECEDING), '') AS url FROM "
    "(SELECT seq, coalesce(edition, '') AS edition, CASE WHEN seq % 3 <> 0 THEN 'http://host.example/rt/metadata/' || seq END AS u FROM " + _ART + ")"
)
def carry_forward_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    art = _articles(spark, sf_dir, "edition")
    url = F.when(F.col("seq") % 3 != 0, F.concat(F.lit("http://host.example/rt/metadata/"), F.col("seq").cast("string")))
    rows = art.select("seq", F.coalesce("edition", F.lit("")).alias("edition"), url.alias("u"))
    return T.carry_forward(rows, "u", [F.col("seq")], "url", "edition").select("seq", "url")


@query("SELECT seq, id_jems FROM " + _ART + " a WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.id_jems = a.id_jems AND d.doc_kind = 'full_text')")
def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.missing(_articles(spark, sf_dir, "id_jems"), table(spark, sf_dir, "documents", "id_jems", "doc_kind").where("doc_kind = 'full_text'"), "id_jems").select("seq", "id_jems")


@query("SELECT seq, id_jems FROM " + _ART + " ORDER BY seq LIMIT 5")
def toc_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five entries; the limit is the operator."""
    return _articles(spark, sf_dir, "id_jems").orderBy("seq").limit(5).select("seq", "id_jems")


_NODES = "SELECT l_orderkey AS issue, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS pos, CASE WHEN l_partkey % 4 = 0 THEN 'h4' WHEN l_partkey % 11 = 0 THEN 'div' ELSE 'table' END AS tag FROM lineitem"


@query(
    f"WITH n AS ({_NODES}), h AS (SELECT *, last_value(CASE WHEN tag = 'h4' THEN pos END IGNORE NULLS) OVER (PARTITION BY issue ORDER BY pos ROWS UNBOUNDED PRECEDING) AS head_pos FROM n), "
    "b AS (SELECT *, max(CASE WHEN tag IN ('h4', 'table') THEN 0 ELSE 1 END) OVER (PARTITION BY issue, head_pos ORDER BY pos ROWS UNBOUNDED PRECEDING) AS broken FROM h) "
    "SELECT issue, pos, head_pos FROM b WHERE tag = 'table' AND head_pos IS NOT NULL AND broken = 0"
)
def toc_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", *order)
    tag = F.when(F.col("l_partkey") % 4 == 0, "h4").when(F.col("l_partkey") % 11 == 0, "div").otherwise("table")
    nodes = T.number_within(lines.withColumn("tag", tag), "l_orderkey", [F.col(c) for c in order], "pos")
    return T.assign_sections(nodes.select(F.col("l_orderkey").alias("issue"), "pos", "tag"), "issue", "pos", "tag").select("issue", "pos", "head_pos")


NAMES = (
    "Editorial", "Artigos Completos", "Short Papers", "Workshop de Ciência de Dados Educacionais (WCDE)", "Apps.Edu - Produto", "Apps.Edu - Protótipo", "Apps.Edu",
    "Concurso Alexandre Direne de Teses - Doutorado", "Concurso Alexandre Direne: TCC - Graduação", "Concurso Alexandre Direne",
    "Mostra de Trabalhos em Robótica para a Escola Pública Rural", "de a o", "ab cd",
)
_ALL_NAMES = "(SELECT section_title AS name FROM sections UNION SELECT unnest([" + ", ".join("'" + n.replace("'", "''") + "'" for n in NAMES) + "]) AS name)"
_L = "lower(name)"
_INITIALS = (
    "array_to_string(list_transform(list_slice(list_filter(regexp_split_to_array(trim(name), '\\s+'), lambda w: NOT list_contains(["
    + ", ".join(f"'{w}'" for w in sections.STOP_WORDS) + "], lower(w)) AND length(w) > 2), 1, 5), lambda w: upper(w[1:1])), '')"
)
_CODE = (
    f"CASE WHEN contains({_L}, 'concurso') AND contains({_L}, 'alexandre') AND contains({_L}, 'direne') AND regexp_matches({_L}, 'teses|dissertações|tcc|trabalhos de conclusão') "
    f"THEN 'CTD' || CASE WHEN contains({_L}, 'doutorado') THEN 'D' WHEN contains({_L}, 'mestrado') THEN 'M' WHEN regexp_matches({_L}, 'trabalhos de conclusão|graduação|de curso') THEN 'G' ELSE '' END "
    f"WHEN contains({_L}, 'apps.edu') THEN 'APPS' || CASE WHEN contains({_L}, 'produto') THEN '-P' WHEN contains({_L}, 'protótipo') THEN '-R' ELSE '' END "
    f"WHEN contains({_L}, 'editorial') THEN 'EDT' WHEN regexp_matches({_L}, 'artigos completos|full papers') THEN 'ART-C' WHEN regexp_matches({_L}, 'artigos resumidos|short papers') THEN 'ART-R' "
    f"WHEN regexp_extract(name, '\\(([A-Z][A-Z0-9-]+)\\)', 1) <> '' THEN regexp_extract(name, '\\(([A-Z][A-Z0-9-]+)\\)', 1) WHEN {_INITIALS} <> '' THEN {_INITIALS} "
    "ELSE replace(upper(name[1:5]), ' ', '') END"
)


@query(f"SELECT name, {_CODE} AS code FROM {_ALL_NAMES}")
def section_abbrev(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "sections").select(F.col("section_title").alias("name"))
    all_names = names.unionByName(spark.createDataFrame([(n,) for n in NAMES], "name string")).distinct()
    return all_names.select("name", sections.section_code(F.col("name")).alias("code"))


@query(
    "SELECT seq, CASE WHEN k = 1 THEN base ELSE base || '-' || (k - 1) END AS abbrev FROM (SELECT seq, edition || ':' || coalesce(section_abbrev, '') AS base, "
    "row_number() OVER (PARTITION BY edition || ':' || coalesce(section_abbrev, '') ORDER BY seq) AS k FROM " + _ART + ")"
)
def abbrev_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    art = _articles(spark, sf_dir, "edition", "section_abbrev")
    base = F.concat("edition", F.lit(":"), F.coalesce("section_abbrev", F.lit("")))
    return T.make_unique(art.select("seq", base.alias("base")), "base", [F.col("seq")], "abbrev").select("seq", "abbrev")


SECTION_HEADERS = ("section_title", "section_title_en", "section_abbrev", "blind", "num_submitted", "num_accepted", "date_sub", "date_result", "date_ready")


@query("SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" for c in SECTION_HEADERS) + " FROM sections")
def sections_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.project(table(spark, sf_dir, "sections"), {c: c for c in SECTION_HEADERS})


#: Published article columns and where they come from.
ARTICLE_HEADERS = {
    "language": "article_language", "section_abbrev": "section_abbrev", "title_orig": "title_orig", "title_en": "title_en", "keywords_orig": "keywords_orig",
    "keywords_en": "keywords_en", "pages": "pages", "id_jems": "id_jems", "doi": "doi",
}
_HEADERS = ", ".join(f"coalesce({s}, '') AS {n}" for n, s in ARTICLE_HEADERS.items())


@query(f"SELECT row_number() OVER (ORDER BY seq) AS no, {_HEADERS} FROM {_ART}")
def articles_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    art = T.number_rows(_articles(spark, sf_dir, *ARTICLE_HEADERS.values()), [F.col("seq")], "no")
    return T.project(art, {"no": "no", **ARTICLE_HEADERS}, {"no": F.col("no")})


@query("SELECT section_abbrev, row_number() OVER (PARTITION BY section_abbrev ORDER BY seq) AS no, seq FROM " + _ART)
def articles_by_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.number_within(_articles(spark, sf_dir, "section_abbrev"), "section_abbrev", [F.col("seq")], "no").select("section_abbrev", "no", "seq")


@query("SELECT section_abbrev, count(*) AS n, min(seq) AS first_seq FROM " + _ART + " GROUP BY section_abbrev")
def section_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir, "section_abbrev").groupBy("section_abbrev").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))


_AUT = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY loaded_at DESC) AS _k FROM authors) WHERE _k = 1)"
_REF = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY loaded_at DESC) AS _k FROM bib_references) WHERE _k = 1)"
_NAME_FIELDS = ("author_first_name", "author_middle_name", "author_last_name")


def _authors(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return T.last_wins(table(spark, sf_dir, "authors", "author_id", "loaded_at", *columns), "author_id", ["loaded_at"])


def _by_section(spark: SparkSession, sf_dir: str, items: DataFrame, *columns: str) -> DataFrame:
    """Items of articles under the number that the article has in its section."""
    own = T.number_within(_articles(spark, sf_dir, "section_abbrev"), "section_abbrev", [F.col("seq")], "no")
    place = own.select(F.col("seq").alias("article"), F.col("section_abbrev").alias("section"), "no")
    return items.join(place, "article").select("section", F.col("no").alias("article"), *columns)


_SECTIONED = "(SELECT seq, section_abbrev AS section, row_number() OVER (PARTITION BY section_abbrev ORDER BY seq) AS no FROM " + _ART + ")"


@query(f"SELECT section, no AS article, author_id, author_last_name FROM {_AUT} a JOIN {_SECTIONED} s ON a.article = s.seq")
def authors_by_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_section(spark, sf_dir, _authors(spark, sf_dir, "article", "author_last_name"), "author_id", "author_last_name")


@query(f"SELECT section, no AS article, ref_id, md5(coalesce(description, '')) AS hash FROM {_REF} r JOIN {_SECTIONED} s ON r.article = s.seq")
def references_by_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = T.last_wins(table(spark, sf_dir, "bib_references", "ref_id", "loaded_at", "article", "description"), "ref_id", ["loaded_at"])
    return _by_section(spark, sf_dir, refs.withColumn("hash", F.md5(F.coalesce("description", F.lit("")))), "ref_id", "hash")


@query(
    "SELECT s.section_abbrev AS section, s.section_title, count(a.seq) AS n FROM sections s LEFT JOIN (SELECT seq, section_abbrev FROM "
    + _ART + " ORDER BY seq LIMIT 5) a ON a.section_abbrev = s.section_abbrev GROUP BY ALL"
)
def sections_of_a_limited_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every section with its articles among the first five of a limited run: sections are never limited."""
    first = _articles(spark, sf_dir, "section_abbrev").orderBy("seq").limit(5)
    every = table(spark, sf_dir, "sections", "section_abbrev", "section_title")
    return every.join(first, "section_abbrev", "left").groupBy(F.col("section_abbrev").alias("section"), "section_title").agg(F.count("seq").alias("n"))


@query(
    "SELECT seq, coalesce(last_value(u IGNORE NULLS) OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING), '') AS url FROM "
    "(SELECT seq, CASE WHEN seq % 3 <> 0 THEN 'http://host.example/rt/metadata/' || seq END AS u FROM " + _ART + ")"
)
def carry_forward_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ordered sequence over the whole table, carried on over range partitions."""
    url = F.when(F.col("seq") % 3 != 0, F.concat(F.lit("http://host.example/rt/metadata/"), F.col("seq").cast("string")))
    return T.carry_forward(_articles(spark, sf_dir, "id_jems").select("seq", url.alias("u")), "u", [F.col("seq")], "url").select("seq", "url")


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    aut = _authors(spark, sf_dir, "article", "item_order", *_NAME_FIELDS)
    return T.nest(_articles(spark, sf_dir), aut.withColumnRenamed("article", "seq"), "seq", ["item_order", "author_id"], list(_NAME_FIELDS), "authors")


@query(
    "SELECT seq, coalesce(a.names, '') AS names, coalesce(a.n, 0) AS n FROM " + _ART + " t LEFT JOIN (SELECT article, string_agg(coalesce(author_last_name, ''), '|' ORDER BY item_order, author_id) AS names, count(*) AS n FROM "
    + _AUT + " GROUP BY article) a ON a.article = t.seq"
)
def nest_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array_join(F.transform("authors", lambda a: F.coalesce(a["author_last_name"], F.lit(""))), "|")
    return _nested(spark, sf_dir).select("seq", names.alias("names"), F.size("authors").cast("bigint").alias("n"))


@query(
    "SELECT article, row_number() OVER (PARTITION BY article ORDER BY a.item_order, author_id) AS item_order, " + ", ".join(f"coalesce({c}, '') AS {c}" for c in _NAME_FIELDS)
    + " FROM " + _AUT + " a JOIN " + _ART + " t ON t.seq = a.article"
)
def authors_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = T.unnest(_nested(spark, sf_dir).withColumnRenamed("seq", "article"), "authors", ["article"])
    return flat.select("article", "item_order", *[F.coalesce(c, F.lit("")).alias(c) for c in _NAME_FIELDS])


@query(
    "SELECT article, row_number() OVER (PARTITION BY article ORDER BY item_order, ref_id) AS item_order, coalesce(description, '') AS description, coalesce(doi, '') AS doi, coalesce(link, '') AS link, "
    "coalesce(accessed, '') AS accessed FROM " + _REF
)
def references_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["description", "doi", "link", "accessed"]
    refs = T.last_wins(table(spark, sf_dir, "bib_references", "ref_id", "loaded_at", "article", "item_order", *fields), "ref_id", ["loaded_at"])
    flat = T.number_within(refs.withColumnRenamed("item_order", "typed"), "article", [F.col("typed"), F.col("ref_id")], "item_order")
    return flat.select("article", "item_order", *[F.coalesce(c, F.lit("")).alias(c) for c in fields])


@query("SELECT seq, coalesce(a.n, 0) + 1 AS n, 'New' AS last_first FROM " + _ART + " t LEFT JOIN (SELECT article, count(*) AS n FROM " + _AUT + " GROUP BY article) a ON a.article = t.seq")
def append_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(F.lit("New").alias("author_first_name"), F.lit("").alias("author_middle_name"), F.lit("Name").alias("author_last_name"))
    more = T.append_item(_nested(spark, sf_dir), "authors", item)
    return more.select("seq", F.size("authors").cast("bigint").alias("n"), F.element_at("authors", -1)["author_first_name"].alias("last_first"))


_FULL = "coalesce(author_first_name, '') || ' ' || coalesce(author_last_name, '')"
_PARTS = f"list_filter(regexp_split_to_array({_FULL}, '{_SP}+'), lambda w: w <> '')"


@query(
    "SELECT author_id, CASE WHEN len(w) > 0 THEN w[1] ELSE '' END AS first, CASE WHEN len(w) > 2 THEN array_to_string(list_slice(w, 2, -2), ' ') ELSE '' END AS middle, "
    f"CASE WHEN len(w) > 1 THEN w[-1] ELSE '' END AS last FROM (SELECT author_id, {_PARTS} AS w FROM {_AUT})"
)
def name_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    aut = _authors(spark, sf_dir, *_NAME_FIELDS)
    name = F.concat(F.coalesce("author_first_name", F.lit("")), F.lit(" "), F.coalesce("author_last_name", F.lit("")))
    first, middle, last = people.split_name(name)
    return aut.select("author_id", first.alias("first"), middle.alias("middle"), last.alias("last"))


@query(
    "SELECT author_id, coalesce(author_first_name, '') || ' ' || CASE WHEN coalesce(author_middle_name, '') <> '' THEN author_middle_name || ' ' ELSE '' END || coalesce(author_last_name, '') AS full_name FROM " + _AUT
)
def full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _authors(spark, sf_dir, *_NAME_FIELDS).select("author_id", people.full_name(*[F.col(c) for c in _NAME_FIELDS]).alias("full_name"))


_CELL = "coalesce(author_last_name, '') || ' ; ' || replace(coalesce(author_affiliation, ''), ';', ',') || CASE WHEN author_id % 3 = 0 THEN '' WHEN author_id % 3 = 1 THEN '; ' || coalesce(author_country, '') ELSE '; Brasil; more' END"


@query(
    "SELECT author_id, " + ", ".join(_STRIP.format(f"split_part(c, ';', {i})") + f" AS {n}" for i, n in ((1, "name"), (2, "affiliation"), (3, "country")))
    + f" FROM (SELECT author_id, {_CELL} AS c FROM {_AUT}) WHERE len(string_split(c, ';')) >= 3"
)
def author_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    aut = _authors(spark, sf_dir, "author_last_name", "author_affiliation", "author_country")
    k = F.col("author_id")
    tail = F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("; "), F.coalesce("author_country", F.lit("")))).otherwise("; Brasil; more")
    cell = F.concat(F.coalesce("author_last_name", F.lit("")), F.lit(" ; "), F.replace(F.coalesce("author_affiliation", F.lit("")), F.lit(";"), F.lit(",")), tail)
    return aut.select("author_id", people.author_cell(cell).alias("c")).where("c is not null").select("author_id", "c.*")


_MARKED = "CASE seq % 4 WHEN 0 THEN 'Resumo: ' || a || ' Abstract: ' || b WHEN 1 THEN 'Resumo: ' || a WHEN 2 THEN 'Abstract: ' || b ELSE a END"


@query(
    "SELECT seq, md5(CASE WHEN r AND e THEN " + _STRIP.format("replace(split_part(t, 'Abstract:', 1), 'Resumo:', '')") + " WHEN r THEN " + _STRIP.format("replace(t, 'Resumo:', '')")
    + " ELSE '' END) AS orig, md5(CASE WHEN r AND e THEN " + _STRIP.format("split_part(t, 'Abstract:', 2)") + " WHEN e THEN " + _STRIP.format("replace(t, 'Abstract:', '')")
    + " ELSE '' END) AS en FROM (SELECT seq, t, contains(t, 'Resumo:') AS r, contains(t, 'Abstract:') AS e FROM (SELECT seq, " + _MARKED
    + " AS t FROM (SELECT seq, coalesce(abstract_orig, '') AS a, coalesce(abstract_en, '') AS b FROM " + _ART + ")))"
)
def abstract_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    art = _articles(spark, sf_dir, "abstract_orig", "abstract_en")
    a, b, k = F.coalesce("abstract_orig", F.lit("")), F.coalesce("abstract_en", F.lit("")), F.col("seq") % 4
    marked = F.when(k == 0, F.concat(F.lit("Resumo: "), a, F.lit(" Abstract: "), b)).when(k == 1, F.concat(F.lit("Resumo: "), a)).when(k == 2, F.concat(F.lit("Abstract: "), b)).otherwise(a)
    original, english = people.split_abstract(F.col("t"))
    return art.select("seq", marked.alias("t")).select("seq", F.md5(original).alias("orig"), F.md5(english).alias("en"))


@query("SELECT c_custkey AS article, c_name AS description, '' AS doi, '' AS link, coalesce(c_mktsegment, '') AS accessed FROM customer")
def project_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = {"article": "c_custkey", "description": "c_name", "doi": "no_such", "link": "none", "accessed": "c_mktsegment"}
    return T.project(table(spark, sf_dir, "customer"), headers, {"article": F.col("c_custkey")})


@query("SELECT c_custkey AS id_jems, c_name AS author_name, c_nationkey AS country, c_acctbal, c_mktsegment FROM customer")
def rename_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rename(table(spark, sf_dir, "customer"), {"c_custkey": "id_jems", "c_name": "author_name", "c_nationkey": "country"})


_GATED = ("title_orig", "title_en", "section_abbrev", "abstract_orig", "abstract_en", "doi")
_LACK = "(" + " OR ".join(f"{c} IS NULL OR {c} = ''" for c in _GATED) + ")"
_GATE = f"(coalesce(title_orig, '') <> '' OR coalesce(title_en, '') <> '') AND section_abbrev IS DISTINCT FROM 'EDT' AND {_LACK}"


@query(f"SELECT seq, {_LACK} AS has_empty FROM {_ART}")
def has_empty_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    art = _articles(spark, sf_dir, *_GATED)
    return art.select("seq", T.has_empty_fields(art).alias("has_empty"))


@query(f"SELECT seq, {_GATE} AS gate FROM {_ART}")
def completion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    art = _articles(spark, sf_dir, *_GATED)
    return art.select("seq", T.needs_completion(art, ("title_orig", "title_en"), "section_abbrev").alias("gate"))


@query("SELECT seq, section_abbrev IS DISTINCT FROM 'EDT' AS wants_references FROM " + _ART)
def editorial_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir, "section_abbrev").select("seq", (~F.col("section_abbrev").eqNullSafe("EDT")).alias("wants_references"))


@query(
    f"SELECT seq, '{{\"seq\":' || seq || ',\"section_abbrev\":' || coalesce('\"' || section_abbrev || '\"', 'null') || '}}' AS payload FROM {_ART} WHERE {_GATE}"
)
def completion_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    art = _articles(spark, sf_dir, *_GATED)
    gated = art.where(T.needs_completion(art, ("title_orig", "title_en"), "section_abbrev"))
    return gated.select("seq", F.to_json(F.struct("seq", "section_abbrev"), {"ignoreNullFields": "false"}).alias("payload"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def last_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type")
    return T.last_wins(events.withColumn("_id", F.col("event_id")), "user_id", ["ts", "_id"]).select("user_id", "event_id", "event_type")


@query(
    "SELECT (p - 1) // 20 AS chunk, count(*) AS n, md5(string_agg(line, chr(10) ORDER BY p)) AS hash FROM (SELECT row_number() OVER (ORDER BY author_id) AS p, "
    "author_id || ';' || coalesce(author_affiliation, '') AS line FROM " + _AUT + ") GROUP BY 1"
)
def affiliation_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    aut = _authors(spark, sf_dir, "author_affiliation")
    line = F.concat(F.col("author_id").cast("string"), F.lit(";"), F.coalesce("author_affiliation", F.lit("")))
    return T.chunks(aut, [F.col("author_id")], line).select("chunk", "n", F.md5("body").alias("hash"))


@query(
    "SELECT author_id, new AS author_affiliation FROM " + _AUT + " a LEFT JOIN (SELECT official_name AS k, official_name_en AS new FROM institutions UNION ALL SELECT acronym, official_name FROM institutions "
    "UNION ALL SELECT NULL, 'unknown') m ON a.author_affiliation IS NOT DISTINCT FROM m.k"
)
def affiliation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    inst = table(spark, sf_dir, "institutions")
    mapping = inst.select(F.col("official_name").alias("k"), F.col("official_name_en").alias("new")).unionByName(inst.select(F.col("acronym").alias("k"), F.col("official_name").alias("new")))
    mapping = mapping.unionByName(spark.createDataFrame([(None, "unknown")], "k string, new string"))
    return T.replace_by_mapping(_authors(spark, sf_dir, "author_affiliation"), "author_affiliation", mapping, "k", "new").select("author_id", "author_affiliation")


@query("SELECT DISTINCT author_first_name, author_middle_name, author_last_name, author_affiliation FROM authors")
def distinct_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "authors", *_NAME_FIELDS, "author_affiliation").dropDuplicates()


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The object inside a prose answer."""
    answer = F.concat(F.lit("Here it is:\n"), F.col("props"), F.lit("\nDone."))
    got = F.from_json(people.json_part(answer), "struct<k: bigint>")
    return table(spark, sf_dir, "events", "event_id", "props").select("event_id", got["k"].alias("k"))


@query("SELECT event_id, '{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\"}' AS js FROM events")
def article_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events", "event_id", "event_type").select("event_id", F.to_json(F.struct("event_id", "event_type")).alias("js"))


@query(
    "SELECT (SELECT count(*) FROM " + _ART + ") AS articles, (SELECT count(DISTINCT section_abbrev) FROM " + _ART + ") AS sections, (SELECT count(*) FROM " + _ART
    + " a WHERE EXISTS (SELECT 1 FROM documents d WHERE d.id_jems = a.id_jems)) AS with_document"
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    art = _articles(spark, sf_dir, "section_abbrev", "id_jems")
    has = table(spark, sf_dir, "documents", "id_jems").where("id_jems is not null").distinct().withColumn("has", F.lit(1))
    return art.join(has, "id_jems", "left").agg(F.count("*").alias("articles"), F.countDistinct("section_abbrev").alias("sections"), F.count("has").alias("with_document"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
