"""Registered queries of the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioflow.llm import bitext, chunks, language, leaks, mojibake, names, neardup, scans, tokens
from biblioflow.session import spread
from biblioflow.session import table as read


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spread(read(spark, sf_dir, name, *columns))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of rows in one group, as the result is defined."""
    classes = p2_classes(spark, sf_dir)
    a = classes.select(F.col("ref_id").alias("ref_a"), "class")
    b = classes.select(F.col("ref_id").alias("ref_b"), "class")
    return a.join(b, "class").where("ref_a < ref_b").select("ref_a", "ref_b")


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = table(spark, sf_dir, "bib_references", "ref_id", "description")
    return neardup.near_duplicates(refs, "ref_id", "description")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = table(spark, sf_dir, "articles", "seq", "abstract_orig", "abstract_en")
    return bitext.align_table(articles, "seq", "abstract_orig", "abstract_en").select("seq", "orig_no", "en_no")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    authors = table(spark, sf_dir, "authors")
    institutions = read(spark, sf_dir, "institutions")
    persons, organisations = names.link(authors, institutions)
    a, b = persons.alias("a"), persons.alias("b")
    same = (F.col("a.person") == F.col("b.person")) & (F.col("a.author_id") < F.col("b.author_id"))
    typed = (F.col("a.first") != F.col("b.first")) | (F.col("a.middle") != F.col("b.middle")) | (F.col("a.last") != F.col("b.last"))
    pairs = a.join(b, same & typed).select(F.lit("person").alias("kind"), F.col("a.author_id").alias("key_a"), F.col("b.author_id").alias("key_b"))
    official = institutions.select("inst_id", "official_name")
    named = organisations.join(official, "inst_id").where("text <> official_name")
    return pairs.unionByName(named.select(F.lit("organisation").alias("kind"), F.col("author_id").alias("key_a"), F.col("inst_id").alias("key_b"))).distinct()


def p5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language of every title and abstract with its confidence."""
    articles = table(spark, sf_dir, "articles", "seq", "article_language", "title_orig", "abstract_orig", "abstract_en")
    model = language.train(articles, "seq", "article_language", "abstract_orig", "abstract_en")
    return language.identify(articles, "seq", {"title_orig": False, "abstract_orig": True}, model, "article_language")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_languages(spark, sf_dir).where("lang <> label_lang").select("seq", "field", "lang").distinct()


def p6_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous text of every record damaged by scanning."""
    articles = table(spark, sf_dir, "articles", "seq", "abstract_orig")
    refs = table(spark, sf_dir, "bib_references", "ref_id", "description")
    a = articles.select(F.lit("articles").alias("src"), F.col("seq").alias("rec_id"), F.col("abstract_orig").alias("text"))
    b = refs.select(F.lit("bib_references").alias("src"), F.col("ref_id").alias("rec_id"), F.col("description").alias("text"))
    both = a.unionByName(b)
    known = scans.known_words(both, ["text"])
    editor = scans.train(both, "text", known, scans.frequent_titles(refs, "description"))
    parts = [
        scans.restore(d, "rec_id", "text", editor).select(F.lit(src).alias("src"), "rec_id", "restored", "edits")
        for src, d in (("articles", a), ("bib_references", b))
    ]
    return parts[0].unionByName(parts[1])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_restored(spark, sf_dir).select("src", "rec_id").distinct()


def p7_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = table(spark, sf_dir, "articles", "seq", "title_orig", "abstract_orig")
    refs = table(spark, sf_dir, "bib_references", "ref_id", "description")
    a = mojibake.restore(articles, "seq", ["title_orig", "abstract_orig"])
    b = mojibake.restore(refs, "ref_id", ["description"])
    return (
        a.select(F.lit("articles").alias("src"), F.col("seq").alias("rec_id"), "field", "restored", "layers")
        .unionByName(b.select(F.lit("bib_references").alias("src"), F.col("ref_id").alias("rec_id"), "field", "restored", "layers"))
        .distinct()
    )


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_restored(spark, sf_dir).select("src", "rec_id", "field").distinct()


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return tokens.encode_corpus(docs, "doc_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    items = read(spark, sf_dir, "eval_items", "item_id", "text")
    return leaks.leaked(docs, "doc_id", "text", items, "item_id", "text").select("item_id", "doc_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_pieces(spark, sf_dir).select("doc_id").distinct()


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return chunks.split_oversized(docs, "doc_id", "text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p2_found, p2_classes, p3_found, p4_found, p5_found, p5_languages, p6_found, p6_restored, p7_found, p7_restored, p8_ids, p9_found, p10_found, p10_pieces)}


_WORDS = r"regexp_extract_all(strip_accents(lower({})), '[\p{{L}}\p{{N}}]+')"
# An exact similarity join: two sets that share 0.65 of their union share one of the rarest words of each, as many
# as a set of that size may lack and one more.
_CLASSES = f"""
WITH RECURSIVE s AS (SELECT ref_id, list_sort(list_distinct({_WORDS.format('min(description)')})) AS w FROM bib_references WHERE description IS NOT NULL GROUP BY ref_id),
t AS (SELECT DISTINCT md5(array_to_string(w, ' ')) AS h, w, len(w) AS n FROM s WHERE len(w) > 0),
e AS (SELECT h, n, unnest(w) AS x FROM t),
f AS (SELECT x, count(*) AS df FROM e GROUP BY x),
p AS (SELECT h, x FROM (SELECT h, n, e.x, row_number() OVER (PARTITION BY h ORDER BY df, e.x) AS k FROM e JOIN f USING (x)) WHERE k <= n - ceil(0.65 * n - 1e-6) + 1),
d AS (SELECT DISTINCT a.h AS a, b.h AS b FROM p a JOIN p b ON a.x = b.x AND a.h < b.h),
v AS (SELECT d.a, d.b, len(list_intersect(s.w, u.w)) AS m, s.n AS n1, u.n AS n2 FROM d JOIN t s ON s.h = d.a JOIN t u ON u.h = d.b),
one AS (SELECT a, b FROM v WHERE m >= 0.65 * (n1 + n2 - m) - 1e-9),
l AS (SELECT a, b FROM one UNION ALL SELECT b, a FROM one),
c(h, m) AS (SELECT h, h FROM t UNION SELECT c.h, l.b FROM c JOIN l ON l.a = c.m),
g AS (SELECT h, min(m) AS g FROM c GROUP BY h),
r AS (SELECT s.ref_id, g.g FROM s JOIN g ON md5(array_to_string(s.w, ' ')) = g.h WHERE len(s.w) > 0)
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express: exact similarity join and closure, and shared runs of words."""
    return {
        "p2_found": _CLASSES + "SELECT a.ref_id AS ref_a, b.ref_id AS ref_b FROM r a JOIN r b USING (g) WHERE a.ref_id < b.ref_id",
        "p2_classes": _CLASSES + "SELECT ref_id, class FROM (SELECT ref_id, min(ref_id) OVER (PARTITION BY g) AS class, count(*) OVER (PARTITION BY g) AS n FROM r) WHERE n > 1",
        "p9_found": f"""
WITH i AS (SELECT DISTINCT item_id, {_WORDS.format('text')} AS w FROM eval_items WHERE text IS NOT NULL),
d AS (SELECT DISTINCT doc_id, {_WORDS.format('text')} AS w FROM documents WHERE text IS NOT NULL),
x AS (SELECT DISTINCT item_id, hash(array_to_string(w[k:k + 11], ' ')) AS g FROM i, unnest(generate_series(1, len(w) - 11)) AS s(k)),
y AS (SELECT doc_id, hash(array_to_string(w[k:k + 11], ' ')) AS g FROM d, unnest(generate_series(1, len(w) - 11)) AS s(k))
SELECT DISTINCT item_id, doc_id FROM x JOIN y USING (g)""",
    }
