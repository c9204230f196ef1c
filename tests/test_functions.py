"""Every edge case of the scalar functions, with values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from biblioflow.functions import ids, pages, people, sections, text


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_cleaning(spark):
    rows = [("a \x00 b",), ("\x1ca\x00b\x7fc",), ("a 　b",), ("a​b",), ("  x\n y ",), ("",), (None,)]
    got = [r[0] for r in values(spark, rows, "t string", text.clean(F.col("t")))]
    assert got == ["a  b", "abc", "a b", "a​b", "x y", "", ""]


def test_flagged_text_is_repaired_and_left_as_it_is(spark):
    rows = [("c´odigo  x", "código  x"), ("plain  x", "unused")]
    assert values(spark, rows, "t string, r string", text.clean(F.col("t"), F.col("r"))) == [("código  x",), ("plain x",)]
    assert values(spark, [(None,), ("n˜ao",)], "t string", text.has_encoding_error(F.col("t"))) == [(False,), (True,)]


@pytest.mark.parametrize("given,most,want", [(["a", "", "b", " ", "\n"], 0, ["a", "", "b"]), (["", " "], -1, []), ([], 3, []), (["a"] * 12, 11, ["a"] * 11), (None, 2, None)])
def test_pages(spark, given, most, want):
    got = values(spark, [(given,)], "p array<string>", pages.capped(pages.trim_trailing(F.col("p")), most))
    assert got[0][0] == want


def test_first_and_last_pages(spark):
    rows = [(["a"],), (["a", "b"],), (["Introduction a", "b"],), (["a", "b", "c"],), (["a", "b", "c", "d"],), (["a", "b", "References c"],), ([],)]
    got = values(spark, rows, "p array<string>", pages.first_pages(F.col("p")), pages.last_pages(F.col("p")))
    assert got == [
        ("a", "a"), ("a, b", " a b"), ("Introduction a", " Introduction a b"), ("a, b", " b c"), ("a, b", "b c d"), ("a, b", "References c"), ("", ""),
    ]


def test_page_range(spark):
    rows = [("10", 1), ("10", 4), ("007", 2), ("iv", 3), ("", 3), ("12-20", 9), (None, 2)]
    assert [r[0] for r in values(spark, rows, "f string, n int", pages.page_range(F.col("f"), F.col("n")))] == ["10", "10-13", "7-8", "iv", "", "12-20", ""]


def test_doi(spark):
    rows = [("https://doi.org/10.5753/x.2019.1",), (" http://dx.doi.org/10.1/a ",), ("doi:10.1/a",), ("HTTPS://doi.org/10.1/a",), ("",), (None,)]
    assert [r[0] for r in values(spark, rows, "d string", ids.normalize_doi(F.col("d")))] == ["10.5753/x.2019.1", "10.1/a", "doi:10.1/a", "HTTPS://doi.org/10.1/a", "", ""]
    rows = [("10.5753/ab.cd.2019.12",), ("10.5753/ab.cd.2019.1.2",), ("10.5753/abc.12",), ("10.5753/a/b.2019.1",), (None,)]
    assert [r[0] for r in values(spark, rows, "d string", ids.doi_prefix(F.col("d")))] == ["10.5753/ab.cd.2019.", "10.5753/ab.cd.2019.1.", None, None, None]
    rows = [("", "10.5753/ab.cd.", "2019", "7"), ("", "10.5753/ab.cd.2019.", "2019", "7"), ("x", "p", "y", "1"), (None, None, "2019", "7"), ("", "p", "2019", "")]
    got = values(spark, rows, "d string, p string, y string, f string", ids.complete_doi(F.col("d"), F.col("p"), F.col("y"), F.col("f")))
    assert [r[0] for r in got] == ["10.5753/ab.cd.2019.7", "10.5753/ab.cd.2019.2019.7", "x", "", ""]


def test_keys(spark):
    rows = [("http://h/a/view/1/a%20b+c.pdf?x=1",), ("http://h/a/view/1/",), ("http://h/x/77",)]
    got = values(spark, rows, "u string", ids.page_key(F.col("u")), ids.file_name(F.col("u")), ids.download_url(F.col("u")))
    assert got[0] == ("a b+c", "a%20b+c.pdf?x=1.pdf", "http://h/a/download/1/a%20b+c.pdf?x=1")
    assert got[1][:2] == ("", ".pdf")
    assert got[2][:2] == ("77", "77.pdf")


def test_section_codes(spark):
    want = {
        "Editorial": "EDT", "Artigos Completos": "ART-C", "Short Papers": "ART-R", "Workshop de Ciência de Dados Educacionais (WCDE)": "WCDE",
        "Apps.Edu - Produto": "APPS-P", "Apps.Edu - Protótipo": "APPS-R", "Apps.Edu": "APPS", "Concurso Alexandre Direne de Teses - Doutorado": "CTDD",
        "Concurso Alexandre Direne: TCC - Graduação": "CTDG", "Concurso Alexandre Direne": "CAD",
        "Mostra de Trabalhos em Robótica para a Escola Pública Rural": "MTREP", "de a o": "DEA", "ab cd": "ABCD",
    }
    got = dict(values(spark, [(k,) for k in want], "n string", F.col("n"), sections.section_code(F.col("n"))))
    assert got == want


def test_rules_file(tmp_path):
    assert sections.load_rules(str(tmp_path / "none.json")) == ()
    (tmp_path / "r.json").write_text('{"mappings": [{"base_sigla": "B"}, {"priority": 1, "base_sigla": "A"}]}')
    assert [r["code"] for r in sections.load_rules(str(tmp_path / "r.json"))] == ["A", "B"]
    (tmp_path / "r.json").write_text("{")
    assert sections.load_rules(str(tmp_path / "r.json")) == ()


def test_names(spark):
    rows = [("Ana",), ("Ana Lima",), (" Ana B. C. Lima ",), (" ",), (None,)]
    assert values(spark, rows, "n string", *people.split_name(F.col("n"))) == [("Ana", "", ""), ("Ana", "", "Lima"), ("Ana", "B. C.", "Lima"), ("", "", ""), ("", "", "")]
    rows = [("Ana", "", ""), ("Ana", "B.", "Lima"), (None, None, None)]
    assert [r[0] for r in values(spark, rows, "a string, b string, c string", people.full_name(F.col("a"), F.col("b"), F.col("c")))] == ["Ana ", "Ana B. Lima", " "]


def test_author_cells(spark):
    rows = [("Ana Lima; Univ X; Brasil; extra",), ("Ana; Univ X",), (None,)]
    got = [r[0] for r in values(spark, rows, "c string", people.author_cell(F.col("c")))]
    assert got[0] == ("Ana Lima", "Univ X", "Brasil") and got[1:] == [None, None]


def test_abstracts(spark):
    rows = [("Resumo: um. Abstract: one.",), ("Resumo: um.",), ("Abstract: one.",), ("plain",), ("Abstract: one. Resumo: um.",), ("Resumo: a Abstract: b Abstract: c",), (None,)]
    got = values(spark, rows, "t string", *people.split_abstract(F.col("t")))
    assert got == [("um.", "one."), ("um.", ""), ("", "one."), ("", ""), ("", "one. Resumo: um."), ("a", "b"), ("", "")]


def test_json_part(spark):
    rows = [('x [{"a":1},{"a":2}] y',), ("```json\n{\"a\": 1}\n```",), ("no",), (None,)]
    got = [r[0] for r in values(spark, rows, "t string", people.json_part(F.col("t")))]
    assert got == ['[{"a":1},{"a":2}]', '{"a": 1}', None, None]


def test_page_location(spark):
    assert values(spark, [(["a", "b"],)], "p array<string>", pages.extract(F.col("p"), "first"), pages.extract(F.col("p"), "last")) == [("a, b", " a b")]
    with pytest.raises(ValueError):
        pages.extract(F.col("p"), "middle")
