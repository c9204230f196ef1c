"""Packed fields: rules of the format, then behaviour on odd tables."""

import pytest

from biblioflow.operators.multivalue import candidates, parse, split_values

ALL = ("line", "tab", "semicolon", "bar", "bullet", "comma", "slash", "dash", "stop", "mark")


@pytest.mark.parametrize(
    "text,want",
    [
        ("a; b;c", ["a", "b", "c"]), ("Keywords: a | b\nc.", ["a", "b", "c"]), ("TCP/IP / E/S - m-learning", ["TCP/IP", "E/S", "m-learning"]),
        ("Python 3.8. Web 2.0.", ["Python 3.8", "Web 2.0"]), ('"""tutor"" effect, revisited"; x', ['"tutor" effect, revisited', "x"]),
        ("«a; b», “c, d”", ["a; b", "c, d"]), ("• a • b (c)", ["a", "b (c)"]), (" ;; , ", []), ("a　; b", ["a", "b"]), ("Mots-clés : x / y", ["x", "y"]),
    ],
)
def test_full_dialect(text, want):
    assert parse(text, ALL, True, False) == want


def test_dialects_differ():
    names = {name for name, *_ in candidates("a, b; c")}
    assert {"", "comma", "semicolon", "comma+semicolon"} <= {"+".join(sorted(n.split("+"))) if n else "" for n in names}


def test_every_subset_is_tried():
    text = "a; b | c, d / e - f\tg\nh"
    kinds = ("line", "tab", "semicolon", "bar", "comma", "slash", "dash")
    assert {tuple(v for v, _ in values) for _, values, *_ in candidates(text)} == {tuple(parse(text, tuple(k for i, k in enumerate(kinds) if n >> i & 1), False, False)) for n in range(1 << len(kinds))}


def test_counts_change_the_dialect(spark):
    """A whole that other fields quote, and whose parts none knows, is one value; where parts are known it is two."""
    odd = [(100, "alpha, omega; kappa")]
    quoted = [(i, f'"alpha, omega"; word{i}; more{i}') for i in range(20)]
    parted = [(i, f"alpha, word{i}, omega, more{i}") for i in range(20)]
    for others, want in ((quoted, ["alpha, omega", "kappa"]), (parted, ["alpha", "omega", "kappa"])):
        got = split_values(spark.createDataFrame(others + odd, "seq long, k string"), "seq", ["k"])
        assert [r["value"] for r in got.where("seq = 100").orderBy("pos").collect()] == want


def test_table(spark):
    data = [(i, "Web 2.0; IoT; C++", None) for i in range(12)] + [(i, "360° view, IoT", "") for i in range(12, 24)]
    data += [(50, "Web 2.0,360° view", "  "), (50, "Web 2.0,360° view", "  "), (51, None, "x" * 5000 + "; y"), (None, "a; b", "c"), (52, '"broken; IoT', "3,5; IoT")]
    df = spark.createDataFrame(data, "seq long, k string, e string").selectExpr("*", "1 as value", "'q' as field", "0 as pos", "'d' as dialect", "1 as n", "2 as total")
    got = split_values(df, "seq", ["k", "e"]).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["pos"]):
        by.setdefault((r["seq"], r["field"]), []).append(r["value"])
    assert by[(0, "k")] == ["Web 2.0", "IoT", "C++"]
    assert by[(50, "k")] == ["Web 2.0", "360° view"]  # the known values outweigh the decimal comma
    assert by[(51, "e")] == ["x" * 5000, "y"]
    assert by[(52, "k")] == ['"broken', "IoT"] and by[(52, "e")] == ["3,5", "IoT"]
    assert not any(s is None for s, _ in by) and (0, "e") not in by


def test_empty_table(spark):
    assert split_values(spark.createDataFrame([], "seq long, k string"), "seq", ["k"]).collect() == []
