from datetime import datetime

from tesserae.functions.titles import title_key
from tesserae.operators import orphans as o

PAGE = "page_id long, page_namespace int, page_title string, loaded_at timestamp_ntz, deleted_at timestamp_ntz, live string"
T = [datetime(2024, m, 1) for m in range(1, 7)]


def tables(spark):
    page = spark.createDataFrame(
        [(1, 0, "Haus", T[0], None, "a"), (1, 0, "Haus", T[3], None, "a"), (2, 0, "Baum", T[0], T[2], "a"), (3, 0, "Spät", T[4], None, "a"), (4, 14, "Haus_am_See", T[0], None, "a"), (5, None, None, None, None, None)], PAGE)
    redirect = spark.createDataFrame(
        [(1, 0, ":haus ", T[1]), (9, 0, "Fehlt", T[1]), (9, 0, "Fehlt", T[1]), (2, 0, "baum", T[3]), (3, 0, "Haus_am_See", T[5]), (4, 14, "haus am See", T[1]), (1, 0, None, T[1]), (None, 0, "", None), (1, None, "Haus", T[1])],
        "rd_from long, rd_namespace int, rd_title string, loaded_at timestamp_ntz")
    tagged = spark.createDataFrame(
        [(7, '[["", "Sp\\u00e4t#x", null], ["Haus#a"]]', T[2]), (7, '[["Sp\\u00e4t#x"]]', T[5]), (8, "no json", T[2]), (8, None, T[2]), (8, "[]", T[2]), (7, '[["#nur"]]', T[2])], "page_id long, link_titles string, loaded_at timestamp_ntz")
    return page, redirect, tagged


def test_kinds_and_months(spark):
    page, redirect, tagged = tables(spark)
    got = {tuple(r) for r in o.find_orphans(o.page_references(redirect, tagged), o.page_parents(page)).collect()}
    assert got == {
        ("redirect", "rd_from", 9, "9", "missing", "2024-02"), ("redirect", "rd_title", 9, "Fehlt", "missing", "2024-02"),
        ("redirect", "rd_from", 2, "2", "deleted", "2024-04"), ("redirect", "rd_title", 2, "baum", "deleted", "2024-04"),
        ("redirect", "rd_title", 3, "Haus_am_See", "missing", "2024-06"), ("tagged", "link_titles", 7, "Spät#x", "late", "2024-03"),
    }
    counts = {(r["miss_kind"], r["ref_month"]): r["n_refs"] for r in o.orphan_counts(o.page_references(redirect, tagged), o.page_parents(page)).where("ref_table = 'redirect' and ref_field = 'rd_title'").collect()}
    assert counts[("missing", "2024-02")] == 1


def test_empty_tables(spark):
    page, redirect, tagged = (t.limit(0) for t in tables(spark))
    assert o.find_orphans(o.page_references(redirect, tagged), o.page_parents(page)).collect() == []


def test_hot_missing_key(spark):
    page, redirect, _ = tables(spark)
    refs = o.page_references(spark.range(3_000).selectExpr("id rd_from", "0 rd_namespace", "if(id % 3 = 0, 'Weg', concat('T', id)) rd_title", "timestamp_ntz'2024-01-05' loaded_at"), spark.createDataFrame([], "page_id long, link_titles string, loaded_at timestamp_ntz")).where("ref_field = 'rd_title'")
    assert o.find_orphans(refs, o.page_parents(page), least=100).count() == 3_000


def test_title_key(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(t,) for t in ("_a b ", ":_x", "::x", "", " ", None, "Category:Y", "éa")], "t string")
    assert [r[0] for r in df.select(title_key(F.col("t"))).collect()] == ["A_b", "X", ":x", None, None, None, "Category:Y", "Éa"]
    assert df.select(title_key(F.col("t"), True)).collect()[6][0] == "Y"
