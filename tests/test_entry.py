import ast
import math
from pathlib import Path

import __spark_entry__ as entry

HOME = Path(__file__).resolve().parent.parent


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_outside_imports_the_subpackage():
    for p in (HOME / "tesserae").rglob("*.py"):
        if "llm" in p.relative_to(HOME).parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith("tesserae.llm") for n in names), p


def test_queries_match_their_sql(spark):
    import duckdb

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for p in Path(d).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    from tesserae.plans import catalogue

    for name in catalogue.SQL:
        df = catalogue.QUERIES[name](spark, d)
        rel = con.sql(catalogue.SQL[name])
        cols = sorted(df.columns)
        assert cols == sorted(rel.columns)
        value = lambda v: float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v
        plain = lambda rows, names: sorted((tuple(value(r[names.index(c)]) for c in cols) for r in rows), key=repr)
        assert plain(df.collect(), df.columns) == plain(rel.fetchall(), rel.columns), name
