"""Golden cases of the knowledge-base operators."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tesserae.functions import scalars as s
from tesserae.operators import apriori as ap, categories as cat, entity_table as et, linking as li, mapping as mp, redirects as rd, split as sp, triples as tr, wikitext as w
from tesserae.operators.closure import closure
from tesserae.operators.ranks import first_by


def one(spark, value, f, type_="string"):
    return spark.createDataFrame([(value,)], f"v {type_}").select(f(F.col("v"))).collect()[0][0]


@pytest.mark.parametrize("coords, lon, lat", [("Point(13.38 52.51)", "13.38", "2.51"), ("Point(-70.1 -33.4)", "-70.1", "33.4"), ("Point(5 6)", None, None), (None, None, None), ("x", None, None)])
def test_points(spark, coords, lon, lat):
    assert (one(spark, coords, s.longitude), one(spark, coords, s.latitude)) == (lon, lat)


def test_strict_points(spark):
    assert one(spark, "Point(5 6)", lambda c: s.latitude(c, True)) == "6"


@pytest.mark.parametrize("tail, title", [("C%2B%2B", "C++"), ("A+B", "A+B"), ("100%zz", "100%zz"), ("%C3%A4%", "ä%"), (None, None)])
def test_titles(spark, tail, title):
    assert one(spark, tail and "https://x/wiki/" + tail, lambda c: s.title_of_sitelink(c, "https://x/wiki/")) == title


def test_ids_dates_anchors(spark):
    assert one(spark, "http://www.wikidata.org/entity/Q64", s.item_id) == "Q64"
    assert one(spark, "t123", s.parse_date) is None and one(spark, "1879-00-00T00:00:00Z", s.parse_date) is None
    assert one(spark, "1500-01-01", s.parse_date) == datetime(1500, 1, 1)
    assert one(spark, "1500-01-01", lambda c: s.parse_date(c, True)) is None
    assert [one(spark, t, s.without_anchor) for t in ("Berlin#G", "#Teil", "a#b#c", "x")] == ["Berlin", "Teil", "a", "x"]


@pytest.mark.parametrize("flags, kind", [((1, 0, 0), "PER"), ((0, 1, 0), "LOC"), ((0, 0, 1), "ORG"), ((1, 1, 0), "PER|LOC"), ((0, 1, 1), "LOC|ORG"), ((1, 0, 1), "ORG"), ((1, 1, 1), "LOC|ORG")])
def test_type_of_flags(spark, flags, kind):
    df = spark.createDataFrame([tuple(map(bool, flags))], "is_per boolean, is_loc boolean, is_org boolean")
    assert et.flagged(df).collect()[0]["ent_type"] == kind


ROW = "wikidata string, coords string, dateofbirth timestamp_ntz, gndid string, inception timestamp_ntz, label string, sitelink string, src_class string, row_ord long, type_ord int"


def rows(spark, *items):
    full = [(q, c, None, g, i, None, link, k, n, 9) for n, (q, c, g, i, link, k) in enumerate(items)]
    return spark.createDataFrame(full, ROW)


def test_entity_table(spark):
    t = datetime(1900, 1, 1)
    df = rows(
        spark,
        ("Q1", None, "late", None, "s/A", "business"), ("Q1", None, "first", t, "s/A", "armed-organization"), ("Q1", "Point(1 22)", None, None, "s/B", "geographic-entity"),
        ("Q2", None, None, None, "s/A", "business"), ("Q3", None, None, None, "s/C", "subject"), ("Q4", None, None, None, "s/D", "person"), (None, None, None, None, "s/E", "business"),
    )
    works = spark.createDataFrame([("Q3",), (None,)], "wikidata string")
    got = {r["page_title"]: r for r in et.entity_table(df, works, "s/").collect()}
    assert set(got) == {"B", "A"}  # Q1 takes the first sitelink by type, Q3 is a work, Q4's class isn't consumed
    assert got["B"]["ent_type"] == "LOC|ORG" and got["B"]["gndid"] == "first" and got["B"]["coords"] == "Point(1 22)" and got["B"]["qid"] == "Q1"
    assert got["A"]["wikidata"] == "Q2"
    assert et.entity_table(df.limit(0), works, "s/").collect() == []


def test_first_by_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", None, 2), ("a", 5, 1), ("a", 5, 0), (None, 1, 1)], "k string, x int, y int")
    assert {tuple(r) for r in first_by(df, ["k"], ["x", "y"]).collect()} == {("a", 5, 0), (None, 1, 1)}


def test_closure(spark):
    edges = spark.createDataFrame([("A", "B"), ("B", "A"), ("B", "C"), ("B", "C"), (None, "D"), ("C", None)], "parent string, child string")
    roots = spark.createDataFrame([("A",), ("Z",), (None,), ("A",)], "root string")
    assert {tuple(r) for r in closure(edges, roots).collect()} == {("A", "A", 0), ("A", "B", 1), ("A", "C", 2), ("Z", "Z", 0)}


def wiki(spark):
    page = spark.createDataFrame([(1, 14, "Org"), (2, 14, "Geo"), (3, 0, "Firma"), (3, 0, "Firma"), (4, 0, "Ort"), (5, 0, "Liste_x"), (6, 0, None), (7, 14, "Sub")], "page_id long, page_namespace int, page_title string")
    links = spark.createDataFrame([(3, "Org"), (4, "Org"), (4, "Geo"), (5, "Org"), (6, "Org"), (7, "Org"), (1, "Sub"), (8, "Sub"), (None, "Org")], "cl_from long, cl_to string")
    return page, links


def test_typed_entities(spark):
    page, links = wiki(spark)
    roles = spark.createDataFrame([("Org", "org"), ("Geo", "geo"), ("None", "notion"), ("None2", "per")], "root string, role string")
    assert {tuple(r) for r in cat.typed_entities(page, links, roles).collect()} == {(3, "Firma", "ORG"), (4, "Ort", "LOC")}
    assert cat.category_pages(page, links, roles.where("role = 'notion'").select("root")).collect() == []


def test_redirects(spark):
    page = spark.createDataFrame([(1, 0, "Alt"), (2, 0, "Neu"), (3, 14, "Kat")], "page_id long, page_namespace int, page_title string")
    redirect = spark.createDataFrame([(1, "Neu"), (1, "Ander"), (3, "Neu"), (2, None), (9, "Neu")], "rd_from long, rd_title string")
    ents = spark.createDataFrame([("Neu", "LOC"), ("Ander", "PER"), ("Alt", "ORG")], "page_title string, ent_type string")
    assert [tuple(r) for r in rd.entity_redirects(page, redirect, ents).collect()] == [("Alt", "Ander", "PER")]
    assert {r[0] for r in rd.resolved_entities(page, redirect, ents).collect()} == {"Neu", "Ander"}


def test_mapping(spark):
    ents = spark.createDataFrame([("A", "PER"), ("B", None)], "page_title string, ent_type string")
    qids = [spark.createDataFrame(r, "page_title string, qid string") for r in ([("A", "Q1"), ("B", "Q2")], [("X", "Q1"), ("Y", "Q1"), ("Z", "Q2")])]
    m = mp.qid_mapping(ents, ["de", "fr"], qids)
    assert m.count() == 3 and {tuple(r) for r in mp.language_entities(m, "fr").collect()} == {("X", "PER"), ("Y", "PER")}
    with pytest.raises(ValueError):
        mp.qid_mapping(ents, ["de", "fr", "en"], qids)


def test_class_extract(spark):
    t = [("x", "P31", "sub", None), ("sub", "P279", "Q178706", None), ("Q178706", "P279", "sub", None), ("x", "label", "L", "de"), ("x", "label", "M", "en"), ("s/de/x", "about", "x", None), ("s/fr/x", "about", "x", None), ("x", "P571", "1", None), ("x", "P571", "2", None)]
    df = spark.createDataFrame(t, "subj string, pred string, obj string, obj_lang string")
    got = tr.class_extract(df, tr.BY_NAME["institution"], "de", "/de/").collect()
    assert sorted((r["organisation"], r["label"], r["sitelink"], r["coords"], r["inception"]) for r in got) == [("x", "L", "s/de/x", None, "1"), ("x", "L", "s/de/x", None, "2")]
    assert len(tr.EXTRACTS) == 15


CLEAN = [
    ("a<!-- x -->b", "a b"), ("a<br/>b", "a b"), ("a<ref>q</ref>b", "a b"), ("{{a{{b}}c}}x", "x"), ("{| a {| b |} c |}x", "x"), ("p == H == q", "p   q"),
    ("x[[Datei:a.jpg|mini|Text]]y", "xy"), ("[[Datei:a.jpg]]", "[[Datei:a.jpg]]"), ("vor\n== Literatur ==\nnach", "vor\n"), ("a&nbsp;b", "a b"), ("[http://x.y z] w", " w"), ("", ""),
    ("{{k" * 9 + "a" + "}}" * 9 + "x", "x"), ("{| a |} {| " + "b" * 30_000 + " |}z", " z"),
]


@pytest.mark.parametrize("raw, clean", CLEAN)
def test_clean_text(spark, raw, clean):
    assert w.cleaned(spark.createDataFrame([(raw,)], "text string")).collect()[0]["clean"] == clean


def test_null_text_is_empty(spark):
    assert w.cleaned(spark.createDataFrame([(None,)], "text string")).collect()[0]["clean"] == ""


def parts(spark, text):
    return [(r["surface"], r["title"]) for r in w.link_parts(spark.createDataFrame([(1, text)], "page_id long, clean string"), ["page_id"]).orderBy("part_no").collect()]


def test_link_parts(spark):
    assert parts(spark, "a [[Berlin]] b") == [("a ", ""), ("Berlin", "Berlin"), (" b", "")]
    assert parts(spark, "[[Bad Homburg|HG]]") == [("", ""), ("HG", "Bad_Homburg"), ("", "")]
    assert parts(spark, "[[Berlin#Geschichte|G]]")[1] == ("G", "Berlin") and parts(spark, "[[#Teil]]")[1] == ("#Teil", "Teil")
    assert parts(spark, "") == [("", "")]


def test_tagging(spark):
    text = spark.createDataFrame([(1, "T", "Er sah [[Alt|Alt Stadt]]. Und [[Fremd]]!"), (1, "T", "Er sah [[Alt|Alt Stadt]]. Und [[Fremd]]!"), (2, "U", None), (3, "V", "x"), (4, "W", "[[Neu]]")], "page_id long, title string, text string")
    page = spark.createDataFrame([(1, 0, "T"), (2, 0, "U"), (3, 14, "V"), (4, 0, "W")], "page_id long, page_namespace int, page_title string")
    ents = spark.createDataFrame([("Neu", "LOC")], "page_title string, ent_type string")
    reds = spark.createDataFrame([("Alt", "Neu", "LOC")], "rd_from_title string, rd_title string, ent_type string")
    got = {r["page_id"]: r for r in w.tagged_documents(text, page, ents, reds).collect()}
    assert set(got) == {1, 2, 4} and got[2]["text"] == []
    assert got[1]["text"] == [["Er", "sah", "Alt", "Stadt", "."], ["Und", "Fremd", "!"]]
    assert got[1]["tags"] == [["O", "O", "B-LOC", "I-LOC", "O"], ["O", "O", "O"]]
    assert got[1]["link_titles"] == [["", "", "Neu", "Neu", ""], ["", "Fremd", ""]]
    assert got[4]["tags"] == [["B-LOC"]]


def test_apriori(spark):
    ents = spark.createDataFrame([("A", 1), ("B", 2)], "page_title string, proba int")
    tagged = spark.createDataFrame([(1, '[["A", "", null], ["A", "C"]]'), (2, None), (3, "x")], "page_id long, link_titles string")
    got = {r["page_title"]: r["proba"] for r in ap.apriori(ents, ap.links_of(tagged)).collect()}
    assert got == {"A": 2 / 3, "B": 0.0}
    assert {r["proba"] for r in ap.apriori(ents, ap.links_of(tagged.limit(0))).collect()} == {None}


def test_split(spark):
    page = spark.range(100).selectExpr("id page_id", "0 page_namespace", "concat('T', id) page_title")
    got = sp.split(page, 0.29, 0.3, 0.41).collect()
    assert sum(r["part"] == "train" for r in got) == 28 and len({r["page_id"] for r in got}) == len(got) == 28 + 30 + 41
    assert {tuple(r) for r in sp.split(page, 0.29, 0.3, 0.41).collect()} == {tuple(r) for r in got}
    assert {r["page_id"] for r in sp.split(page, 0.5, 0.1, 0.1, seed=1).collect()} != {r["page_id"] for r in sp.split(page, 0.5, 0.1, 0.1).collect()}
    for bad in ((0.0, 0.5, 0.5), (0.6, 0.3, 0.2)):
        with pytest.raises(ValueError):
            sp.split(page, *bad)


def test_payload_is_cut_to_the_shortest(spark):
    df = spark.createDataFrame([(1, "P", '[["a", "b", "c"], ["d"]]', '[["O", "O"], ["O"]]', '[["", "x", ""]]')], "page_id long, page_title string, text string, tags string, link_titles string")
    assert [[tuple(t) for t in snt] for snt in li.payload(df).collect()[0]["sentences"]] == [[("a", "O", ""), ("b", "O", "x")]]


def test_linking_run(spark):
    class Stub:
        def parse(self, sentences):
            return {f"{t['word']}-{t['prediction'][2:]}": {"gt": [t["gt"], "other"]} for snt in sentences for t in snt if t["prediction"].startswith("B-")}

        def ned(self, parsed):
            if "skip-PER" in parsed:
                return None
            return {k: {} if k[0] == "n" else {"ranking": []} if k[0] == "e" else {"ranking": [["T", {"wikidata": "Q1", "proba_1": 0.5}]]} for k in parsed}

    rows = [(1, "P", '[["n", "e", "f", "g"]]', '[["B-PER", "B-PER", "B-LOC", "B-LOC|ORG"]]', '[["N", "E", "F", "G"]]'), (2, "Q", '[["f"]]', '[["B-LOC"]]', '[["F"]]'), (3, "R", '[["skip", "f"]]', '[["B-PER", "B-LOC"]]', '[["S", "F"]]')]
    df = spark.createDataFrame(rows, "page_id long, page_title string, text string, tags string, link_titles string")
    got = {tuple(r) for r in li.run(df, Stub, {"PER", "LOC"}, 2).collect()}
    assert got == {("n-PER", "-", "-", 0.0, 1, "P", "N"), ("f-LOC", "T", "Q1", 0.5, 1, "P", "F")}


def test_filter_entities(spark):
    df = spark.createDataFrame([(1, "p", "a-PER", "x"), (1, "p", "b-ORG", "x"), (2, "q", "a-PER", "x"), (2, "q", "c-PER", "x")], "page_id long, page_title string, entity_id string, gt string")
    assert {(r["page_id"], r["entity_id"]) for r in li.filter_entities(df, {"PER"}, 2).collect()} == {(2, "a-PER"), (2, "c-PER")}


def test_begin_tags_at_each_sentence_of_a_link(spark):
    ents = spark.createDataFrame([("St._Ort", "LOC")], "page_title string, ent_type string")
    none = spark.createDataFrame([], "rd_from_title string, rd_title string, ent_type string")
    row = w.tagged_page(5, "T", "Der [[St. Ort|St. Ort am See]] liegt. Ende", ents, none).collect()[0]
    assert row["text"] == [["Der", "St", "."], ["Ort", "am", "See", "liegt", "."], ["Ende"]]
    assert row["tags"] == [["O", "B-LOC", "I-LOC"], ["B-LOC", "I-LOC", "I-LOC", "O", "O"], ["O"]]
    assert row["link_titles"][0] == ["", "St._Ort", "St._Ort"]
    assert w.tagged_page(5, "T", None, ents, none).collect()[0]["text"] == []


def test_hot_titles_and_repeated_texts(spark):
    ents = spark.createDataFrame([("Ort", "LOC")], "page_title string, ent_type string")
    red = spark.createDataFrame([("Alt", "Ort", "LOC")], "rd_from_title string, rd_title string, ent_type string")
    text = spark.createDataFrame([(i % 30, "t", f"[[Ort]] und [[alt|a]] [[Alt]] {i % 30}") for i in range(90)], "page_id long, title string, text string")
    page = spark.range(30).selectExpr("id AS page_id", "0 AS page_namespace", "'x' AS page_title")
    numbers = {}
    got = w.tagged_documents(text, page, ents, red, numbers).collect()
    assert len(got) == 30 and numbers == {"n_pages": 30, "n_redirects": 1}
    assert all(r["link_titles"][0][:4] == ["Ort", "", "alt", "Ort"] and r["tags"][0][:4] == ["B-LOC", "O", "O", "B-LOC"] for r in got)


def test_checked_redirects(spark):
    red = spark.createDataFrame([("a", "x", "LOC"), ("b", "y", None)], "rd_from_title string, rd_title string, ent_type string")
    assert rd.checked(red).count() == 2
    with pytest.raises(Exception, match="several redirects"):
        rd.checked(red.unionByName(red)).collect()


def test_closure_over_several_rounds(spark):
    edges = [(i, i + 1) for i in range(40)] + [(5, 20), (41, 0), (40, 3), (None, 1), (7, None)] + [(100, 100 + i) for i in range(1, 300)]
    got = {(r["root"], r["node"]): r["depth"] for r in closure(spark.createDataFrame(edges, "parent int, child int"), spark.createDataFrame([(0,), (100,), (999,), (None,)], "root int")).collect()}
    want = {(0, i): i if i < 20 else i - 14 for i in range(41)} | {(100, 100): 0, (999, 999): 0} | {(100, 100 + i): 1 for i in range(1, 300)}
    assert got == want
