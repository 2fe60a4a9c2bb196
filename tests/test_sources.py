import json
import sqlite3

import pytest

from tesserae.sources import insertdump, sparql, wikixml
from tesserae.sources.sqlite import read_sqlite, write_sqlite

DUMP = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.11/"><siteinfo><sitename>x</sitename></siteinfo>
<page><title>A</title><ns>0</ns><id>1</id><revision><id>5</id><text bytes="3">a &amp; b</text></revision><revision><text>zwei</text></revision></page>
<page><title>B</title><id>2</id><revision><id>6</id></revision></page>
<page><title>C</title><id>3</id><revision><text bytes="0" /></revision></page></mediawiki>"""


def test_xml(spark, tmp_path):
    (tmp_path / "d.xml").write_text(DUMP)
    got = {tuple(r) for r in wikixml.read_pages(spark, str(tmp_path / "d.xml")).collect()}
    assert got == {(1, "A", "a & b"), (3, "C", None)}
    (tmp_path / "e.xml").write_text(DUMP.replace("www.mediawiki.org", "other.example"))
    with pytest.raises(ValueError):
        wikixml.read_pages(spark, str(tmp_path / "e.xml"))


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    pages = spark.createDataFrame([(1, "A", "x"), (20_001, "B", None)], "page_id long, title string, text string")
    wikixml.write_pages(pages, path)
    assert {r["range"] for r in spark.read.parquet(path).collect()} == {0, 2}
    own = spark.read.parquet(path).select("page_id", "title")
    wikixml.replace_table(own, path)
    assert spark.read.parquet(path).columns == ["page_id", "title"] and spark.read.parquet(path).count() == 2


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "x.db")
    with sqlite3.connect(path) as con:
        con.execute('CREATE TABLE t (id INTEGER, name TEXT, "a b" REAL)')
        con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, None if i % 2 else f"n{i}", i / 2) for i in range(10)])
        con.execute("CREATE TABLE leer (id INTEGER)")
    df = read_sqlite(spark, path, "t")
    assert df.columns == ["id", "name", "a b"] and df.count() == 10 and df.where("name is null").count() == 5
    assert read_sqlite(spark, path, "leer").count() == 0


def test_sparql(spark):
    def get(url):
        assert "analytic=true" in url and url.count("?") == 1
        return json.dumps({"results": {"bindings": [{"a": {"value": "1"}}, {"a": {"value": "2"}, "b": {"value": "x"}}]}})

    df = sparql.run_sparql(spark, "q", "http://e/s?x=1", True, get)
    assert [tuple(r) for r in df.orderBy("a").collect()] == [("1", None), ("2", "x")]
    with pytest.raises(ValueError):
        sparql.run_sparql(spark, "q", get=lambda url: json.dumps({"results": {"bindings": []}}))


def test_query_text(tmp_path):
    f = tmp_path / "q"
    f.write_text("l __LANG__ s __SITE__")
    assert sparql.query_text(None, str(f), lang="de", site="x") == "l de s x"
    assert sparql.query_text(None, None, demo=True) == sparql.DEMO
    for args in ((None, None), ("a", str(f))):
        with pytest.raises(ValueError):
            sparql.query_text(*args)


INSERTS = """-- dump
CREATE TABLE `other` (
  `x` int(11) NOT NULL
) ENGINE=InnoDB;
CREATE TABLE `page` (
  `page_id` int(8) unsigned NOT NULL AUTO_INCREMENT,
  `page_title` varbinary(255) NOT NULL DEFAULT '',
  `page_random` double unsigned,
  PRIMARY KEY (`page_id`)
) ENGINE=InnoDB;
INSERT INTO `page` VALUES (1,'A\\'b, (c);\\\\',0.5),(2,NULL,-1e-3),(3,'',NULL);
INSERT INTO `other` VALUES (9);
INSERT INTO `page` VALUES (4,'x\\ny''z',1),(5,0x4142,2);
"""


def test_inserts(spark, tmp_path):
    path = str(tmp_path / "d.sql")
    (tmp_path / "d.sql").write_text(INSERTS)
    got = {tuple(r) for r in insertdump.read_inserts(spark, path, "page").collect()}
    assert got == {(1, "A'b, (c);\\", 0.5), (2, None, -0.001), (3, "", None), (4, "x\ny'z", 1.0), (5, "AB", 2.0)}
    with pytest.raises(ValueError):
        insertdump.read_inserts(spark, path, "none")
    df = spark.createDataFrame([(1, "it's \\ a\nb", None), (None, None, 2.5)], "a long, b string, c double")
    insertdump.write_inserts(df, str(tmp_path / "out"), "t")
    assert {tuple(r) for r in insertdump.read_inserts(spark, str(tmp_path / "out"), "t").collect()} == {tuple(r) for r in df.collect()}


def test_sqlite_sink(spark, tmp_path):
    path = str(tmp_path / "y.db")
    df = spark.range(100).selectExpr("id", "nullif(concat('n', id), 'n3') AS name", "id / 2 AS half").repartition(5)
    write_sqlite(df, path, "t", "overwrite", ("id",))
    write_sqlite(df.where("id < 10"), path, "t")
    with sqlite3.connect(path) as con:
        assert con.execute("SELECT count(*), count(name), sum(half) FROM t").fetchone() == (110, 108, 2475 + 22.5)
        assert {r[0] for r in con.execute("SELECT name FROM sqlite_master")} == {"t", "idx_t_id"}
    write_sqlite(df.limit(0), path, "t", "overwrite")
    assert read_sqlite(spark, path, "t").count() == 0


def test_replaced_table_is_never_missing(spark, tmp_path):
    path = str(tmp_path / "r")
    for n in (1, 2):
        wikixml.replace_table(spark.range(n), path)
        assert spark.read.parquet(path).count() == n and [p.name for p in tmp_path.iterdir()] == ["r"]
