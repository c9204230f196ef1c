"""Pages, completion, sinks, ingestion, and the whole run on a small issue."""

import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from biblioflow import completion, sinks
from biblioflow.plans import pipeline
from biblioflow.sources import files, html
from biblioflow.streaming import ingest

TOC = """<html><body><div>
<h4 class="tocSectionTitle">Artigos Completos</h4>
<table><tr><td><div class="tocTitle">Title A</div><div class="tocPages">10</div><a href="http://host/index.php/x/article/view/1114/1017">PDF</a></td></tr></table>
<table><tr><td><div class="tocTitle">Title B</div></td></tr></table>
<div>end</div>
<table><tr><td><div class="tocTitle">never</div></td></tr></table>
<h4 class="tocSectionTitle">Editorial</h4>
<h4 class="tocSectionTitle">Artigos Completos</h4>
<table><tr><td><div class="tocTitle">Title C</div><div class="tocPages">iv</div><a href="http://host/index.php/x/article/view/1115/1018">PDF</a></td></tr></table>
</div></body></html>"""
META = """<table><tr><td>1.</td><td>Título do documento</td><td>T &amp; U</td></tr>
<tr><td>2.</td><td>Autor</td><td>Nome</td><td>Ana B. Lima; Univ X; Brasil</td></tr><tr><td>2.</td><td>Autor</td><td>Nome</td><td>Bia; none</td></tr></table>"""


def test_contents(spark):
    found = html.nodes(spark.createDataFrame([(1, TOC), (2, None), (3, "")], "page int, markup string"), "page", "markup")
    got = [tuple(r) for r in html.contents(found, "page").orderBy("seq").select("section", "title_orig", "first_page", "id_jems", "metadata_url").collect()]
    assert [g[:4] for g in got] == [
        ("Artigos Completos", "Title A", "10", "1017"), ("Artigos Completos", "Title B", "", "No PDF link found"), ("Artigos Completos", "Title C", "iv", "1018"),
    ]
    assert got[0][4] == got[1][4] == "http://host/index.php/x/rt/metadata/1114/1017"
    assert [r["title_orig"] for r in html.contents(found, "page", 2).orderBy("seq").collect()] == ["Title A", "Title B"]
    heads = pipeline.site_sections(found, "page").orderBy("head_pos")
    assert [(r["section"], r["section_abbrev"]) for r in heads.collect()] == [("Artigos Completos", "ART-C"), ("Editorial", "EDT"), ("Artigos Completos", "ART-C-1")]
    links = html.pdf_links(found, "page", 1).collect()
    assert [(r["url"], r["file_name"]) for r in links] == [("http://host/index.php/x/article/download/1114/1017", "1017.pdf")]


def test_metadata(spark):
    found = html.nodes(spark.createDataFrame([(1, META)], "page int, markup string"), "page", "markup")
    assert html.labelled_cells(found, "page", {"title": "Título do documento", "doi": "Identifier"}).first().asDict() == {"page": 1, "title": "T & U", "doi": ""}
    whole = html.metadata(found, "page").first()
    assert (whole["title"], whole["doi"], whole["abstract_orig"], [a["author_last_name"] for a in whole["authors"]]) == ("T & U", "", "", ["Lima"])
    got = html.page_authors(found, "page").collect()
    assert [(r["author_first_name"], r["author_middle_name"], r["author_last_name"], r["author_affiliation"]) for r in got] == [("Ana", "B.", "Lima", "Univ X")]


class Flaky:
    def __init__(self, answers):
        self.answers, self.calls = answers, 0

    def complete(self, prompt, as_json=False):
        self.calls += 1
        return self.answers[min(self.calls, len(self.answers)) - 1]


def test_retries():
    assert completion.ask_json(Flaky(["no", "still no", 'x {"a": 1} y']), "p") == ('{"a": 1}', 3)
    assert completion.ask_json(Flaky(["never"]), "p") == ("{}", 4)


def test_answers_are_kept(spark):
    df = spark.createDataFrame([("p",), ("p",), ("q",), ("",), (None,)], "prompt string")
    one = completion.complete(df, "prompt", lambda: completion.Offline({"p": '{"x":1}'}))
    got = {r["prompt"]: (r["answer"], r["calls"]) for r in one.collect()}
    assert got == {"p": ('{"x": 1}', 1), "q": ("{}", 1), "": ("", 0), None: ("", 0)}
    again = completion.complete(df.where("prompt <> ''"), "prompt", lambda: completion.Offline(), known=one)
    assert sum(r["calls"] for r in again.collect()) == 0


def test_completion_replaces_or_overlays(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "y")], "i int, t string, u string")
    make = lambda: completion.Offline(default='{"u": "new"}')
    args = (F.col("u").isNull(), F.col("t"), "struct<t:string,u:string>", make)
    assert [tuple(r) for r in completion.complete_rows(df, *args).orderBy("i").collect()] == [(1, None, "new"), (2, "b", "y")]
    assert [tuple(r) for r in completion.complete_rows(df, *args, overlay=True).orderBy("i").collect()][0] == (1, "a", "new")


@pytest.mark.parametrize("answer", ['{"universidades":[{"originalAuthorAffiliation":"a","authorAffiliation":"A"}]}', '[{"originalAuthorAffiliation":"a","authorAffiliation":"A"}]', '{"originalAuthorAffiliation":"a","authorAffiliation":"A"}'])
def test_affiliation_answers(spark, answer):
    got = completion.correct_affiliations(spark.createDataFrame([("c",)], "body string"), "body", lambda: completion.Offline(default=answer)).collect()
    assert [(r["originalAuthorAffiliation"], r["authorAffiliation"]) for r in got] == [("a", "A")]


def test_csv_format(spark, tmp_path):
    df = spark.createDataFrame([('a"b;c', "", None)], "x string, y string, z string").coalesce(1)
    sinks.write_csv(df, str(tmp_path / "t"))
    body = next((tmp_path / "t").glob("part-*.csv")).read_bytes().decode()
    assert body.endswith('"a""b;c";"";""\r\n')
    assert sinks.write_csv_file(df, str(tmp_path / "f.csv"), ["x"]) == 1
    assert (tmp_path / "f.csv").read_bytes() == b'"x";"y";"z"\r\n"a""b;c";"";""\r\n'
    back = files.read_csv(spark, str(tmp_path / "f.csv"), "x string, y string, z string").first()
    assert back["x"] == 'a"b;c'


def test_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "é")], "a long, b string")
    sinks.write_snapshot(df, str(tmp_path / "s"))
    assert sorted(map(tuple, files.read_snapshot(spark, str(tmp_path / "s.json"), df.schema).collect())) == [(1, None), (2, "é")]


def test_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"a": None, "year": "2019", "output_dir": "o"}))
    c = files.Config.load(str(tmp_path / "c.json"))
    assert c.get("a") is None and c.get("b", 1) == 1 and c.prompt("x") == "" and c.output_path("logs") == "o/2019/logs"
    with pytest.raises(KeyError):
        c.get("b")
    with pytest.raises(ValueError):
        files.Config.load("c.yaml")


def test_ingest_sees_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "7.txt").write_text("one")
    for name in ("", "8"):
        if name:
            (tmp_path / "in" / f"{name}.txt").write_text("two")
        ingest.ingest_new(ingest.landed(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sorted((r["id_jems"], r["text"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("7", "one"), ("8", "two")]


def test_documents_and_download(spark, tmp_path):
    (tmp_path / "1017.pdf").write_bytes(b"p1|p2||")
    docs = files.documents(spark, str(tmp_path), 0, lambda b: b.decode().split("|")).first()
    assert (docs["id_jems"], docs["text_pages"], docs["num_pages"]) == ("1017", ["p1", "p2"], 2)
    urls = spark.createDataFrame([("http://h/1017",), ("http://h/9",)], "u string")
    got = files.download(urls, "u", files.listing(spark, str(tmp_path)), lambda u: u.encode()).collect()
    assert [(r["file_name"], bytes(r["content"])) for r in got] == [("9.pdf", b"http://h/9")]
    landed = sorted(tuple(r) for r in files.land(urls, "u", str(tmp_path), lambda u: u.encode()).collect())
    assert landed == [("http://h/1017", "1017.pdf", False), ("http://h/9", "9.pdf", True)]
    assert (tmp_path / "9.pdf").read_bytes() == b"http://h/9" and (tmp_path / "1017.pdf").read_bytes() == b"p1|p2||"


def test_fetch_reads_an_address(tmp_path):
    (tmp_path / "x").write_bytes(b"body")
    assert files.fetch((tmp_path / "x").as_uri()) == b"body"
    with pytest.raises(OSError):
        files.fetch((tmp_path / "none").as_uri())


def test_landing_and_reading_as_one_flow(spark, tmp_path):
    page = spark.createDataFrame([(1, TOC)], "page int, markup string")
    docs = pipeline.landed_documents(spark, page, str(tmp_path / "pdf"), 1, 1, lambda u: (u + "|two").encode(), lambda b: b.decode().split("|"))
    assert [(r["id_jems"], r["text_pages"], r["num_pages"]) for r in docs.collect()] == [("1017", ["http://host/index.php/x/article/download/1114/1017"], 1)]


def read_rows(folder, name):
    return [r for p in sorted(Path(folder, name).glob("**/part-*.csv")) for r in csv.reader(open(p, newline="", encoding="utf-8"), delimiter=";")]


META_PAGE = META.replace("<table>", '<table><tr><td>0.</td><td>Digital Object Identifier (DOI)</td><td>https://doi.org/10.5753/site.2019.7</td></tr><tr><td>9.</td><td>Resumo</td><td>Resumo: um. Abstract: one.</td></tr>')


def test_metadata_pages_join_the_site(spark):
    found = html.nodes(spark.createDataFrame([(1, TOC)], "page int, markup string"), "page", "markup")
    stated = spark.createDataFrame([("http://host/index.php/x/rt/metadata/1114/1017", META_PAGE), (None, "x")], "url string, markup string")
    got = {r["title_orig"]: r for r in pipeline.site_articles(found, pipeline.site_sections(found, "page"), stated).collect()}
    assert (got["Title A"]["title_orig2"], got["Title A"]["doi"], got["Title A"]["site_abstract"]) == ("T & U", "10.5753/site.2019.7", "um.")
    assert (got["Title C"]["title_orig2"], got["Title C"]["doi"], got["Title C"]["section_abbrev"]) == ("", "", "ART-C-1")


def test_whole_run(spark, tmp_path):
    answer = json.dumps({"titleOrig": "T", "titleEn": "", "abstractOrig": "R", "keywordsOrig": "k", "doi": "10.5753/ab.2019.1", "authors": [{"authorFirstName": "Ana", "authorLastName": "Lima"}], "references": [{"description": "d1"}, {"description": "d2"}]})
    docs = spark.createDataFrame([("1017", ["old", "x", "y"], 3, 1), ("1017", ["a", "b"], 2, 2), ("1018", ["c"], 1, 3), ("9", ["z"], 1, 4)], "id_jems string, text_pages array<string>, num_pages int, position int")
    stated = spark.createDataFrame([("http://host/index.php/x/rt/metadata/1114/1017", META_PAGE)], "url string, markup string")
    make = lambda: completion.Offline(default=answer)
    out = pipeline.run(spark.createDataFrame([(1, TOC)], "page int, markup string"), docs, make, str(tmp_path), stated, year="2019")
    got = {r["idJEMS"]: r for r in out.collect()}
    assert set(got) == {"1017", "1018"}
    assert (got["1017"]["pages"], got["1017"]["sectionAbbrev"], got["1017"]["titleOrig2"]) == ("10-11", "ART-C", "T & U") and got["1018"]["sectionAbbrev"] == "ART-C-1"
    before = files.read_snapshot(spark, str(tmp_path / f"{pipeline.SNAPSHOTS[0]}.json"), out.schema).orderBy("seq").collect()
    # the site's DOI stays, is first in the pool, and gives the prefix of the other
    assert [r["doi"] for r in before] == ["10.5753/site.2019.7", "10.5753/site.2019.2019.iv"]
    for name in ("antes_Artigos.csv", "Artigos.csv", "Autores.csv", "Referencias.csv", "Secoes.csv"):
        assert len(read_rows(tmp_path, name)) > 1
    assert [r[:3] for r in read_rows(tmp_path, "Secoes.csv") if r[0] != "sectionTitle"] == [["Artigos Completos"] * 2 + ["ART-C"], ["Editorial"] * 2 + ["EDT"], ["Artigos Completos"] * 2 + ["ART-C-1"]]
    refs = [r for r in read_rows(tmp_path, "Referencias.csv") if r[0] != "article"]
    assert sorted((r[0], r[1], r[-1]) for r in refs) == [("1", "d1", "1"), ("1", "d2", "2"), ("2", "d1", "1"), ("2", "d2", "2")]
    # in its section every article is the first, and its items name it so
    for name, n in (("Artigos", 1), ("Autores", 1), ("Referencias", 2)):
        for section in ("ART-C", "ART-C-1"):
            rows = [r for r in read_rows(tmp_path, f"por_workshop/{name}/section={section}") if r[0] not in ("seq", "article")]
            assert len(rows) == n and {r[0] for r in rows} == {"1"}
    again = pipeline.replay(spark, make, str(tmp_path), out.schema)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_gate_counts_authors_and_ids(spark):
    schema = "seq int, language string, sectionAbbrev string, titleOrig string, titleEn string, abstractOrig string, abstractEn string, keywordsOrig string, keywordsEn string, pages string, idJEMS string, doi string, authors array<struct<authorFirstName:string>>, references array<string>"
    full = (1, "pt", "S", "t", "t", "a", "a", "k", "k", "1", "i", "d", [("x",)], None)
    df = spark.createDataFrame([full, (*full[:12], [], None)], schema)
    gate = pipeline.tables.needs_completion(df, ("titleOrig", "titleEn"), "sectionAbbrev")
    assert [r[0] for r in df.select(gate).collect()] == [False, True]


def test_pages_with_torn_accents_are_repaired(spark):
    df = spark.createDataFrame([(1, "a  b"), (2, "educac¸˜ao"), (3, "c¸˜ao  x")], "i int, first string")
    make = lambda: completion.Offline({"educac¸˜ao": "educação"}, "")
    assert [r["first"] for r in pipeline.clean_pages(df, "first", make).orderBy("i").collect()] == ["a b", "educação", "c¸˜ao x"]


def test_affiliations_are_sent_with_their_header(spark):
    authors = spark.createDataFrame([(1, 1, "u; v", ""), (1, 2, None, "e"), (2, 1, "z", "")], "article int, `order` int, authorAffiliation string, authorAffiliationEn string")
    body = 'authorAffiliation;authorAffiliationEn\n"u; v";\n;e\nz;'
    answer = '[{"originalAuthorAffiliation":"u; v","authorAffiliation":"U","authorAffiliationEn":"UE"}]'
    got = pipeline.correct_affiliations(authors, lambda: completion.Offline({body: answer})).orderBy("article", "order").collect()
    assert [(r["authorAffiliation"], r["authorAffiliationEn"]) for r in got] == [("U", "UE"), (None, None), (None, None)]


def test_pretty_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(2, "é", [("x",)]), (1, None, [])], "a long, b string, c array<struct<d:string>>")
    path = str(tmp_path / "s.json")
    assert sinks.write_json_file(df, path, ["a"]) == 2
    assert json.loads(Path(path).read_text(encoding="utf-8")) == [{"a": 1, "b": None, "c": []}, {"a": 2, "b": "é", "c": [{"d": "x"}]}]
    assert sorted(map(str, files.read_snapshot(spark, path, df.schema, True).collect())) == sorted(map(str, df.collect()))
    assert sinks.write_json_file(df.limit(0), path, ["a"]) == 0 and json.loads(Path(path).read_text()) == []
    sinks.dump_documents(df, str(tmp_path))
    assert files.read_snapshot(spark, str(tmp_path / "text.json"), df.schema).count() == 2


def test_lists_keep_objects_only(spark):
    df = spark.createDataFrame([("p", "q")], "f string, l string")
    answers = {"p": '{"titleOrig": "T", "authors": [{"authorFirstName": "A"}, null]}', "q": '{"references": [null, {"description": "d"}]}'}
    got = completion.extract_articles(df, "f", "l", lambda: completion.Offline(answers)).first()
    assert [a["authorFirstName"] for a in got["article"]["authors"]] == ["A"] and [r["description"] for r in got["refs"]] == ["d"]


def test_headers_and_prompts(tmp_path):
    (tmp_path / "h.json").write_text('{"articles": ["b", "a"]}')
    assert sinks.load_headers(str(tmp_path / "h.json")) == {"articles": ("b", "a")}
    made = completion.clients(files.Config({}), completion.Offline)
    assert set(made) == set(completion.CLIENTS) and made["article_ai_client"] == (completion.Offline, "")


def test_provider_factory():
    assert isinstance(completion.factory({})(), completion.Offline)
    made = completion.factory({"completion_url": "http://h", "engine": "m"}, {"COMPLETION_KEY": "k"})()
    assert (made.url, made.key, made.model, made.most_tokens) == ("http://h", "k", "m", 4000)
    assert completion.options("o3-mini") == {} and completion.options("m") == {"temperature": 0}
    assert completion.options("m", True)["response_format"] == {"type": "json_object"} and "response_format" not in completion.options("gpt-5-nano-1", True)
