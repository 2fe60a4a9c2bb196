from datetime import datetime

from tesserae.streaming import tagging as t


def test_articles_are_tagged_once(spark, tmp_path):
    page = spark.createDataFrame([(1, 0, "A")], "page_id long, page_namespace int, page_title string")
    ents = spark.createDataFrame([("Neu", "LOC")], "page_title string, ent_type string")
    reds = spark.createDataFrame([], "rd_from_title string, rd_title string, ent_type string")
    src, out, chk = (str(tmp_path / x) for x in ("src", "out", "chk"))
    spark.createDataFrame([(1, "A", "Hier ist [[Neu]].")], "page_id long, title string, text string").write.parquet(src)
    for _ in range(2):
        q = t.tag_stream(t.read_stream(spark, src, "page_id long, title string, text string"), page, ents, reds, out, chk)
        q.processAllAvailable()
        q.stop()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 1 and rows[0]["tags"] == '[["O","O","B-LOC","O"]]'


def test_link_counts(spark, tmp_path):
    src = str(tmp_path / "tagged")
    spark.createDataFrame([(1, '[["A", "A", ""]]', datetime(2024, 1, 1)), (2, '[["B"]]', datetime(2024, 1, 5))], "page_id long, link_titles string, loaded_at timestamp_ntz").write.parquet(src)
    stream = t.read_stream(spark, src, "page_id long, link_titles string, loaded_at timestamp_ntz")
    q = t.link_counts(stream).writeStream.format("memory").queryName("counts").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert {(r["target"], r["n_links"]) for r in spark.table("counts").collect()} == {("A", 2), ("B", 1)}
