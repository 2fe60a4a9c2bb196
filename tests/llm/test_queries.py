from pathlib import Path

import duckdb

from tesserae.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_queries_match_their_sql(spark):
    con = duckdb.connect()
    for p in Path(FOLDER).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    for name, sql in queries.SQL.items():
        df, rel = queries.QUERIES[name](spark, FOLDER), con.sql(sql)
        cols = sorted(df.columns)
        assert cols == sorted(rel.columns), name
        plain = lambda rows, names: sorted((tuple(r[names.index(c)] for c in cols) for r in rows), key=repr)
        assert plain(df.collect(), df.columns) == plain(rel.fetchall(), rel.columns), name


def test_queries_without_sql_run(spark):
    for name in queries.QUERIES.keys() - queries.SQL.keys():
        assert queries.QUERIES[name](spark, FOLDER).columns, name


def test_reports_agree_with_what_they_report(spark):
    placed, report = queries.p7_containers(spark, FOLDER), {r["spec_name"]: r for r in queries.p7_fill(spark, FOLDER).collect()}
    sums: dict[str, dict[int, int]] = {}
    for r in placed.collect():
        own = sums.setdefault(r["spec_name"], {})
        own[r["container_id"]] = own.get(r["container_id"], 0) + r["token_end"] - r["token_start"]
    for spec, own in sums.items():
        r = report[spec]
        assert (r["n_containers"], r["used_tokens"], r["fullest"]) == (len(own), sum(own.values()), max(own.values())) and r["fullest"] <= r["capacity_tokens"]
    chosen: dict[tuple[str, str], int] = {}
    for r in queries.p8_selection(spark, FOLDER).collect():
        chosen[r["mix_name"], r["source"]] = chosen.get((r["mix_name"], r["source"]), 0) + r["tokens"] * r["n_uses"]
    for r in queries.p8_shares(spark, FOLDER).collect():
        whole = sum(n for (mix, _), n in chosen.items() if mix == r["mix_name"])
        assert r["tokens"] == chosen.get((r["mix_name"], r["source"]), 0) and abs(r["actual_share"] - r["tokens"] / whole) < 1e-9
