"""Relational operators on small tables."""

from pyspark.sql import functions as F

from biblioflow.operators import tables as T


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "z"), (None, 3, "w"), ("b", 1, None)], "k string, o int, v string")
    assert rows(T.last_wins(df, "k", ["o"]).select("k", "v"), F.col("k").asc_nulls_first()) == [(None, "w"), ("a", "y"), ("b", None)]
    assert rows(T.last_wins(df.limit(0), "k", ["o"])) == []


def test_number_rows_is_global(spark):
    df = spark.range(1000).withColumn("k", -F.col("id")).repartition(7)
    got = rows(T.number_rows(df, [F.col("k")]).select("seq", "k"), "seq")
    assert [s for s, _ in got] == list(range(1, 1001)) and [k for _, k in got] == sorted(k for _, k in got)
    assert rows(T.number_rows(df.limit(0), [F.col("k")])) == []


def test_make_unique(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, "A"), (4, "A")], "p int, n string")
    assert [r[1] for r in rows(T.make_unique(df, "n", [F.col("p")], "u").select("p", "u"), "p")] == ["A", "B", "A-1", "A-2"]


def test_most_common_breaks_ties_by_first(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "a"), (5, None)], "p int, v string")
    assert rows(T.most_common(df, "v", ["p"])) == [("b", 2)]
    assert rows(T.most_common(df.where("v is null"), "v", ["p"])) == []


def test_sections_end_at_the_first_other_node(spark):
    tags = ["table", "h4", "table", "table", "div", "table", "h4", "table"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(tags)], "g int, pos int, tag string")
    assert [tuple(r) for r in T.assign_sections(df, "g", "pos", "tag").select("pos", "head_pos").orderBy("pos").collect()] == [(2, 1), (3, 1), (7, 6)]


def test_nest_and_unnest(spark):
    parents = spark.createDataFrame([(1,), (2,)], "k int")
    children = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (3, 1, "c")], "k int, o int, v string")
    nested = T.nest(parents, children, "k", ["o"], ["v"], "items")
    assert {r["k"]: [x["v"] for x in r["items"]] for r in nested.collect()} == {1: ["a", "b"], 2: []}
    assert rows(T.unnest(nested, "items", ["k"]), "item_order") == [(1, 1, "a"), (1, 2, "b")]
    more = T.append_item(nested, "items", F.struct(F.lit("z").alias("v")))
    assert {r["k"]: len(r["items"]) for r in more.collect()} == {1: 3, 2: 1}


def test_mapping_join_matches_null_and_fans_out(spark):
    left = spark.createDataFrame([(1, "u"), (2, None), (3, "z")], "i int, a string")
    right = spark.createDataFrame([("u", "U1"), ("u", "U2"), (None, "N")], "k string, v string")
    got = sorted(map(str, rows(T.replace_by_mapping(left, "a", right, "k", "v").select("i", "a"))))
    assert got == ["(1, 'U1')", "(1, 'U2')", "(2, 'N')", "(3, None)"]


def test_empty_fields(spark):
    df = spark.createDataFrame([("x", 0, ["a"], None), ("", 1, ["a"], "r"), ("x", 1, [], "r"), (None, 1, ["a"], "r")], "t string, n int, authors array<string>, first_pages string")
    assert [r[0] for r in rows(df.select(T.has_empty_fields(df)))] == [False, True, True, True]


def test_gate(spark):
    df = spark.createDataFrame([("t", None, "S", ""), ("t", None, "EDT", ""), ("", "", "S", ""), ("t", "u", None, "")], "o string, e string, s string, d string")
    assert [r[0] for r in rows(df.select(T.needs_completion(df, ("o", "e"), "s")))] == [True, False, False, True]


def test_project_and_missing(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert rows(T.project(df, {"a": "a", "b": "b", "c": "none"}, {"b": F.lit("k")})) == [("1", "k", "")]
    assert rows(T.missing(spark.createDataFrame([("x",), ("y",)], "k string"), spark.createDataFrame([("x",)], "k string"), "k")) == [("y",)]


def test_chunks(spark):
    df = spark.range(45)
    got = rows(T.chunks(df, [F.col("id")], F.col("id").cast("string")).select("chunk", "n", "body"), "chunk")
    assert [(c, n) for c, n, _ in got] == [(0, 20), (1, 20), (2, 5)] and got[2][2] == "40\n41\n42\n43\n44"
