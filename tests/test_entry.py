"""The driver contract on the smallest tables."""

import importlib.util
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    if importlib.util.find_spec("biblioflow.llm") is None:
        assert not any(n.startswith("p2_") for n in entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["id_jems", "seq", "section"] and df.count() > 0


def test_nothing_outside_imports_the_text_subpackage():
    from pathlib import Path

    root = Path(entry.__file__).parent / "biblioflow"
    for p in root.rglob("*.py"):
        if p.relative_to(root).parts[0] != "llm":
            assert "biblioflow.llm" not in p.read_text(encoding="utf-8"), p


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql()))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from pathlib import Path

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    cursor = con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})")
    assert mine == sorted(map(repr, cursor.fetchall()))
